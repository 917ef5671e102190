"""Tokenization of whole texts by space-separated units with a bounded cache.

The two word tokenizers used here never form a token across a space: one
drops white space, the other lets one space lead the next word.  A text cut
at single spaces therefore gives the same tokens unit by unit, and natural
text repeats its units.  Texts to which that does not safely apply go
through the library whole (cut only between two ASCII letters around a
space when very long).
"""
from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable

#: longest text given to the library in one call; longer ones are cut at safe boundaries
LONG_CHARS = 1 << 16
#: most units that one worker keeps
MAX_UNITS = 400_000
_SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
#: fixed: the word-splitting pattern of the byte-level vocabulary
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def safe_pieces(text: str, longest: int = LONG_CHARS) -> list[str]:
    """Cuts a long text before spaces between ASCII letters; joined they give the text."""
    out, at = [], 0
    while len(text) - at > longest:
        m = _SAFE_CUT.search(text, at + longest)
        if not m:
            break
        out.append(text[at:m.start()])
        at = m.start()
    out.append(text[at:])
    return out


class Units:
    """Token counts, or token ids as little-endian unsigned 32-bit bytes, of whole texts."""

    def __init__(self, path: str, ids: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.ids = ids
        self.leads = type(self.library.pre_tokenizer).__name__ == "ByteLevel"
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cache: dict[str, int | bytes] = {}
        self.ranks = None
        twin = os.path.splitext(path)[0] + ".tiktoken"
        if self.leads and os.path.exists(twin):
            import base64

            import tiktoken
            with open(twin, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranks = tiktoken.Encoding("units", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                                           special_tokens={})

    def _value(self, encoded_ids: list[int]):
        return array("I", encoded_ids).tobytes() if self.ids else len(encoded_ids)

    def _units(self, text: str) -> list[str] | None:
        """The text's units, or None where only the library is sure to be right."""
        if any(s in text for s in self.specials):
            return None
        if not text.isascii() and _BEYOND_LATIN.search(text):
            return None
        if not self.leads:
            return text.replace("\n", " ").split(" ")
        if "  " in text or " \n" in text or "\n " in text or _OTHER_SPACE.search(text):
            return None
        first, *rest = text.split(" ")
        return [first, *[" " + u for u in rest]] if rest else [first]

    def _encode(self, units: list[str]) -> list:
        if self.ranks is not None:
            return [self._value(self.ranks.encode_ordinary(u)) for u in units]
        enc = self.library.encode_batch_fast if hasattr(self.library, "encode_batch_fast") else self.library.encode_batch
        return [self._value(e.ids) for e in enc(units, add_special_tokens=False)]

    def _by_library(self, text: str):
        parts = safe_pieces(text)
        found = [self._value(e.ids) for e in self.library.encode_batch(parts, add_special_tokens=False)]
        return b"".join(found) if self.ids else sum(found)

    def batch(self, texts: Iterable[str]) -> list:
        """One value per text: its number of tokens, or its ids as bytes."""
        cache, out, waiting = self.cache, [], {}
        split = [self._units(t) for t in texts]
        for units in split:
            if units is not None:
                waiting.update(dict.fromkeys(u for u in units if u not in cache))
        new = list(waiting)
        local = dict(zip(new, self._encode(new)))
        room = MAX_UNITS - len(cache)
        if room >= len(local):
            cache.update(local)
            local = {}
        elif room > 0:
            for u in new[:room]:
                cache[u] = local[u]
        for text, units in zip(texts, split):
            if units is None:
                out.append(self._by_library(text))
                continue
            try:
                found = map(cache.__getitem__, units)
                out.append(b"".join(found) if self.ids else sum(found))
            except KeyError:
                found = [cache[u] if u in cache else local[u] for u in units]
                out.append(b"".join(found) if self.ids else sum(found))
        return out


_READY: dict[tuple[str, bool], Units] = {}


def units_for(path: str, ids: bool) -> Units:
    """The worker's tokenizer: loaded once per process, its cache kept between batches."""
    if (path, ids) not in _READY:
        _READY[path, ids] = Units(path, ids)
    return _READY[path, ids]


def by_bytes(texts: list[str], most: int) -> Iterable[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` characters together (one text at least)."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        if i > at and total + len(t) > most:
            yield at, i
            at, total = i, 0
        total += len(t)
    if at < len(texts):
        yield at, len(texts)


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
