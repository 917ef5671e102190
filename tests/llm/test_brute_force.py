"""The trained operators and every pipeline stage against plain Python on a whole small table."""
import math
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pandas as pd
import pytest
import tokenizers
from pyspark.sql import functions as F

from minutebook.llm import op2_token_counts, op4_quality, op5_mixing, op8_language
from minutebook.llm.queries import QUERIES
from test_operators import _lines_by_hand, counter  # this folder is on the path

DIR = "/root/testdata/sf0.001"


def _documents(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def _crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


# ------------------------------------------------------------------ quality

def _stats_by_hand(text):
    words = text.split()
    if not words:
        return [0.0] * 15
    data = list(text.encode())
    size, n = len(data), len(words)
    symbols = set(b"#$%&*+/<=>@[\\]^_`{|}~")
    symbol = sum(b in symbols for b in data) / size
    digit = sum(48 <= b <= 57 for b in data) / size
    upper = sum(65 <= b <= 90 for b in data) / size
    lower = sum(97 <= b <= 122 for b in data) / size
    beyond = sum(b > 127 for b in data) / size
    space = data.count(32) / size
    return [math.log(1 + n), min(sum(len(w) for w in words) / n, 50), min(max(len(w) for w in words), 100) / 100,
            math.log(1 + len(set(words))) / math.log(1 + n), sum(a == b for a, b in zip(words, words[1:])) / n,
            sum(len(w) < 3 for w in words) / n, symbol, digit, upper, min(data.count(46) / n, 2), min(data.count(44) / n, 2),
            min(data.count(10) / n, 2), beyond, max(0.0, 1 - symbol - digit - upper - lower - beyond - space), space]


def _isotonic_by_hand(x, y):
    """The least-squares non-decreasing fit by its min-max formula; equal neighbours are one block."""
    pairs = sorted(zip(x, y))
    totals = [Fraction(0)]
    for _, v in pairs:
        totals.append(totals[-1] + Fraction(v))
    n = len(pairs)
    best = [max(min((totals[b] - totals[a]) / (b - a) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
    centres, values = [], []
    for v in sorted(set(best)):
        centres.append(float(np.mean([pairs[i][0] for i in range(n) if best[i] == v])))
        values.append(float(v))
    return centres, values


def _scores_by_hand(spark):
    """doc_id -> score: plain statistics, a least-squares solve over all learning rows at once, plain calibration."""
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).alias("part")
    docs = _documents(spark).select("doc_id", "text", part).collect()
    stats = {r.doc_id: np.array(_stats_by_hand(r.text or "")) for r in docs}
    marks = {}
    for r in spark.read.parquet(f"{DIR}/labels.parquet").collect():
        if r.quality is not None and r.doc_id in stats and _crc(r.doc_id) % 5 != 0:
            marks.setdefault(r.doc_id, []).append(r.quality)
    learn = [(stats[r.doc_id], float(np.mean(marks[r.doc_id])), r.part) for r in docs if r.doc_id in marks]
    x = np.array([s for s, _, _ in learn])
    spread = x.std(0)
    random_map = op4_quality.Model(x.mean(0), np.where(spread > 1e-9, spread, 1.0))

    def features(s):
        z = np.minimum(np.maximum((s - random_map.mean) / random_map.scale, -6), 6)
        return [math.sqrt(2 / op4_quality.N_FEATURES) * math.cos(v) for v in z @ random_map.w + random_map.b] + [1.0]

    fit = [(features(s), y) for s, y, p in learn if p != 0]
    a, y = np.array([f for f, _ in fit]), np.array([v for _, v in fit])
    ridge = math.sqrt(op4_quality.RIDGE * len(fit) / a.shape[1])
    weights = np.linalg.lstsq(np.vstack([a, ridge * np.eye(a.shape[1])]), np.append(y, np.zeros(a.shape[1])), rcond=None)[0]
    held = [(float(np.dot(features(s), weights)), v) for s, v, p in learn if p == 0]
    assert len(fit) > 20 and len(held) > 5
    centres, values = _isotonic_by_hand([h for h, _ in held], [v for _, v in held])
    return {d: float(np.interp(np.dot(features(s), weights), centres, values)) for d, s in stats.items()}


def test_quality_query_matches_a_direct_solve(spark):
    want = _scores_by_hand(spark)
    got = QUERIES["op4_quality"](spark, DIR).collect()
    assert len(got) == len(want) and len(set(want.values())) > 2
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6)
        assert r.held_out == (_crc(r.doc_id) % 5 == 0) and r.predicted == int(r.score >= 0.3)


# ----------------------------------------------------------------- language

def _grams_by_hand(text):
    """The bucket of every n-gram of 1 to 3 bytes, and the number of places looked at."""
    data = b" " + text.lower().encode() + b" "
    out = Counter()
    for size in (1, 2, 3):
        for i in range(len(data) - size + 1):
            code = int.from_bytes(data[i:i + size], "big") + (size << 24)
            out[(code * 2654435761 % 2 ** 32 >> 17) | 1] += 1
    return out, 3 * len(data)


def test_language_query_matches_a_plain_decoder(spark):
    trust_row = (F.pmod(F.xxhash64("doc_id", F.lit("trust")), F.lit(4)) == 0).alias("t")
    docs = _documents(spark).select("doc_id", "text", "lang", trust_row).collect()
    grams = {r.doc_id: _grams_by_hand(r.text or "") for r in docs}
    learn = [r for r in docs if r.lang is not None and r.text is not None and _crc(r.doc_id) % 3 != 1]
    langs = sorted({r.lang for r in learn})
    counts = np.zeros((len(langs), op8_language.BUCKETS))
    for r in learn:
        for g, n in grams[r.doc_id][0].items():
            counts[langs.index(r.lang), g] += n
    rates = (counts + 0.5) / (counts + 0.5).sum(1)[:, None]
    # every split of the languages in two is a bit
    k = len(langs)
    splits = [[1 if s >> i & 1 else -1 for i in range(k)] for s in range(1, 2 ** (k - 1))]
    weights = []
    for split in splits:
        yes, no = ([rates[i] for i in range(k) if split[i] == side] for side in (1, -1))
        weights.append(np.log(sum(yes) / len(yes)) - np.log(sum(no) / len(no)))

    def margins(doc_id):
        held, places = grams[doc_id]
        return [sum(w[g] * n for g, n in held.items()) / places for w in weights]

    known = [(margins(r.doc_id), langs.index(r.lang)) for r in learn if r.t]
    scale = [4 / np.mean([abs(m[b]) for m, _ in known]) for b in range(len(splits))]
    trust = []
    for b, split in enumerate(splits):
        loss = np.mean([math.log(1 + math.exp(-split[t] * m[b] * scale[b])) for m, t in known])
        trust.append(max(1 - loss / math.log(2), 0.05))
    got = {r.doc_id: r for r in QUERIES["op8_language"](spark, DIR).collect()}
    assert set(got) == set(grams)
    for r in docs:
        have = got[r.doc_id]
        assert have.held_out == (_crc(r.doc_id) % 3 == 1)
        if not any(c.isalpha() for c in r.text or ""):
            assert have.lang_pred == "und"
            continue
        m = margins(r.doc_id)
        losses = [sum(trust[b] * math.log(1 + math.exp(-split[i] * m[b] * scale[b])) for b, split in enumerate(splits)) for i in range(k)]
        order = sorted(range(k), key=lambda i: losses[i])
        assert have.lang_pred == langs[order[0]]
        assert have.score == pytest.approx(1 / sum(math.exp(min(losses) - x) for x in losses), abs=1e-4)
        lead = losses[order[1]] - losses[order[0]] - op8_language.MARGIN * sum(trust)
        assert have.ambiguous == (lead < 0) or abs(lead) < 1e-4


# ----------------------------------------------------------------- pipeline

def _one_of_each_by_hand(rows):
    def shingles(t):
        w = (t or "").lower().split()
        return frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    leader = {d: d for d in sets}

    def top(d):
        while leader[d] != d:
            d = leader[d]
        return d
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                x, y = sorted((top(a), top(b)))
                leader[y] = x
    return {d for d in ids if top(d) == d}


def test_every_stage_of_the_pipeline(spark, tmp_path):
    import corpus_pipeline
    docs = _documents(spark)
    # a near copy, an exact copy and a shared line, so that each stage has something to decide
    some = [r.asDict() for r in docs.orderBy("doc_id").limit(6).collect()]
    some = [{**some[0], "doc_id": 10 ** 6}, {**some[1], "doc_id": 10 ** 6 + 1, "text": some[1]["text"].replace("\n", " ")},
            {**some[2], "doc_id": 10 ** 6 + 2, "text": some[3]["text"] + "\n" + some[2]["text"] + " and more"}]
    docs = docs.unionByName(spark.createDataFrame(some, docs.schema))
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    def done(name, given):
        path = str(tmp_path / name)
        stages[name](spark, given, DIR).write.parquet(path)
        out = spark.read.parquet(path)
        return out, [r.asDict() for r in out.collect()]

    def whole(rows):
        return counter(repr([r[c] for c in columns]) for r in rows)

    scores = _scores_by_hand(spark)
    given = [r.asDict() for r in docs.collect()]
    kept, rows = done("quality", docs)
    # the copies take part in the fit of neither side: they have no labels
    by_text = {r["text"]: scores[r["doc_id"]] for r in given if r["doc_id"] in scores}
    sure = [r for r in given if r["text"] in by_text and abs(by_text[r["text"]] - 0.3) > 1e-6]
    assert len(sure) >= len(given) - 3
    assert whole([r for r in rows if r["text"] in by_text]) == whole([r for r in sure if by_text[r["text"]] >= 0.3])

    cut, after = done("line_dedup", kept)
    gone = _lines_by_hand([(r["doc_id"], r["text"]) for r in rows])
    want = []
    for r in rows:
        out = gone[r["doc_id"], r["text"] or ""]
        left = "\n".join(x for i, x in enumerate((r["text"] or "").split("\n")) if i not in out)
        if not out:
            want.append(r)
        elif left.strip(" "):
            want.append({**r, "text": left, **({"n_chars": len(left)} if "n_chars" in r else {})})
    assert any(gone.values()) and whole(after) == whole(want)

    ones, single = done("near_duplicates", cut)
    stay = _one_of_each_by_hand(after)
    assert whole(single) == whole([r for r in after if r["doc_id"] in stay])

    mixed, copies = done("mixing", ones)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(single, columns=columns))
    taken = con.execute(op5_mixing.ORACLE).df()
    times = {d: round(t / s) if s else 0 for d, s, t in zip(taken["doc_id"], taken["size"], taken["taken"])}
    have = Counter(r["doc_id"] for r in copies)
    assert {d: have.get(d, 0) for d, s in zip(taken["doc_id"], taken["size"]) if s} == {d: times[d] for d, s in zip(taken["doc_id"], taken["size"]) if s}
    assert set(whole(copies)) <= set(whole(single))

    _, pieces = done("packing", mixed)
    tok = tokenizers.Tokenizer.from_file(op2_token_counts.tokenizer_file("byte_bpe_50k.json"))
    ids = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in single}
    total = sum(len(ids[d]) * n for d, n in have.items())
    assert sum(p["length"] for p in pieces) == total
    for p in pieces:
        part = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert len(part) == p["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"]
    for d, n in have.items():
        mine = Counter((p["piece"], p["start"], p["length"]) for p in pieces if p["doc_id"] == d)
        assert set(mine.values()) == {n} and sum(x[2] for x in mine) == len(ids[d])
    places = {}
    for p in pieces:
        places.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    # best fit, longest first, needs no fewer sequences
    room = []
    for length in sorted((p["length"] for p in pieces), reverse=True):
        fits = [i for i, free in enumerate(room) if free >= length]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= length
        else:
            room.append(1024 - length)
    assert len(places) <= len(room)
