"""Ranked search, filter audit and SentencePiece round trip against brute force on odd tables."""
import hashlib
import math
import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from minutebook.llm import op11_sentencepiece, op12_filter_audit, op13_ranked_search
from minutebook.llm.op2_token_counts import tokenizer_file

DOCS = "doc_id long, text string, source string"
PIECES = tokenizer_file("piece_bpe_32k.model")
ODD = ["", " ", "   ", "a", " a", "a ", "  a  b ", "a\n b\t\tc", "▁", "▁x▁", "x ▁ y", "<s> hi </s>", "\x00 \x00a", "ﬁ Ａ 　 é", "\U0001f600 中文  字", "<0x41> <unk>",
       "word " * 30_000, "w" * 5000, " " * 900 + "end"]


def corpus():
    rnd = random.Random(8)
    words = ["Alpha", "beta", "ÉTÉ", "gamma", "d$", "x", "the", "THE", "中文", "a1", "b-2", "nu"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 120))), f"s{i % 3}" if i % 7 else None) for i in range(150)]
    rows += [(i, rows[i % 5][1], "s0") for i in range(200, 260)]
    rows += [(300, None, "s1"), (301, "", "s2"), (302, "   \n", None), (3, rows[3][1], "s1"), (None, rows[2][1], "s1"), (None, "only here", "s1"),
             (400, "the long one " * 20_000, "s2"), (401, "the long one " * 20_000, "s2")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).withColumns({c: F.lit(1) for c in ("mask", "term", "block", "t", "n")}).repartition(5).cache()


def test_pieces_are_those_of_the_library(spark):
    library = SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (3, "a"), (3, "a")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x"))
    got = sorted((r.doc_id, tuple(r.ids), r.decoded) for r in op11_sentencepiece.encode(table, PIECES).collect())
    want = sorted((i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in rows)
    assert got == want
    back = op11_sentencepiece.decode(op11_sentencepiece.encode(table, PIECES), PIECES).collect()
    assert sorted((r.doc_id, r.decoded) for r in back) == sorted((i, d) for i, _, d in want)
    assert op11_sentencepiece.encode(table.limit(0), PIECES).count() == 0
    odd_ids = spark.createDataFrame([(1, None), (2, []), (3, [259, None, 264, 2, 0])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in op11_sentencepiece.decode(odd_ids, PIECES).collect()} == {
        1: "", 2: "", 3: library.decode([259, 264, 2, 0])}


def test_chunk_table_is_bounded(monkeypatch):
    monkeypatch.setattr(op11_sentencepiece, "MAX_CHUNKS", 3)
    table, library = op11_sentencepiece.ChunkTable(PIECES), SentencePieceProcessor(model_file=PIECES)
    for _ in range(2):
        ids, decoded = table.rows(ODD)
        assert [list(memoryview(x).cast("i")) for x in ids] == [library.encode(t) for t in ODD]
        assert len(table.kept) <= 3


def test_pieces_query_digests(spark):
    library = SentencePieceProcessor(model_file=PIECES)
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op11_sentencepiece.op11_sentencepiece(spark, "/root/testdata/sf0.001").collect():
        ids = library.encode(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def audit_by_hand(rows, labels):
    fails = []
    for doc, text, source in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        first = min((d for d, x, _ in rows if (x or "") == t and d is not None), default=None)
        f = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
             "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
             "E": doc is not None and first < doc}
        mine = [x for x in labels if x[0] == doc and doc is not None]
        fails.append((source or "", {k for k, v in f.items() if v}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, {}
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [x for x in own if letter in x[1] and not x[1] & before]
                out[part, order, step] = [sum(not x[1] & (before | {letter}) for x in own), len(gone),
                                          sum(letter in x[1] and bool(x[1] & before) for x in own), sum(x[1] == {letter} for x in own),
                                          sum(x[2] for x in gone), sum(x[3] for x in gone)]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("blocks", [1 << 17, 1])
def test_audit_matches_brute_force(spark, docs, blocks):
    cells = 64 if blocks == 1 else 4096  # crowded cells: every text may repeat
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, 1, 1), (205, 1, 1), (300, None, 1), (401, 1, 0), (None, 1, 1), (999, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in op12_filter_audit.audit(op12_filter_audit.mask_counts(docs, marks, blocks, cells)).collect()}
    assert got == audit_by_hand(corpus(), labels)


def test_audit_of_nothing(spark, docs):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert op12_filter_audit.audit(op12_filter_audit.mask_counts(docs.limit(0), marks)).count() == 0


def test_sketch_clears_most_unique_texts(spark):
    rows = op12_filter_audit.features(spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("s").alias("source")))
    found, blocks = op12_filter_audit.sketch(rows, 3000)
    assert blocks == 8 and sum(bin(x & (2 ** 64 - 1)).count("1") for r in found.collect() for x in r.bits) < 3000


def search_by_hand(rows, items, k):
    def terms(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)
    held = [(doc, terms(t)) for doc, t, _ in rows]
    n_docs, n_words = sum(bool(x) for _, x in held), sum(len(x) for _, x in held)
    df = {}
    for _, x in held:
        for term in set(x):
            df[term] = df.get(term, 0) + 1
    out = []
    for item in {i for i, _ in items}:
        query = [w for i, t in items if i == item for w in terms(t)]
        scores = []
        for doc, x in held:
            m = 75 + 25 * len(x) * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * x.count(w) // (1000 * x.count(w) + 12 * m))
                        for w in query if w in df and w in x)
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, n + 1, doc, -s) for n, (s, _, doc) in enumerate(sorted(scores, key=lambda r: (r[0], r[1], r[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_docs", [4096, 7])
def test_search_matches_brute_force(spark, docs, block_docs):
    items = [(1, "the alpha"), (2, "été ÉTÉ ÉTÉ"), (3, "a1 b 2, nothing"), (3, "Gamma"), (4, ""), (5, None), (6, "unseen"), (7, "中文 x x x long"),
             (None, "beta only"), (8, "only here"), (8, "the THE the")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit("w"))
    for k in (20, 3):
        got = sorted((tuple(r) for r in op13_ranked_search.ranked(docs, table, k, block_docs, item_group=3).collect()), key=repr)
        assert got == search_by_hand(corpus(), items, k)


def test_search_of_nothing(spark, docs):
    items = spark.createDataFrame([(1, "the alpha")], "item_id long, text string")
    assert op13_ranked_search.ranked(docs.limit(0), items).count() == 0
    assert op13_ranked_search.ranked(docs, items.limit(0)).count() == 0
