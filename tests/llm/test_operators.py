"""Each operator against brute force or an exact property, on tables with nulls, empty and long
texts, repeated rows and columns with clashing names."""
import hashlib
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from minutebook.llm import (op1_ngram_join, op2_token_counts, op3_packing, op4_quality, op5_mixing, op6_line_dedup,
                            op7_preferences, op8_language, op9_fingerprint, op10_topk)
from minutebook.llm.common import maybe_in, with_next
from minutebook.llm.queries import ORACLE, QUERIES
from minutebook.llm.units import safe_pieces

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
DIR = "/root/testdata/sf0.001"


def _words(rnd, n):
    return " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "mu", "nu"])
                    + str(rnd.randint(0, 40)) for _ in range(n))


def corpus():
    rnd = random.Random(5)
    base = [_words(rnd, 40) for _ in range(12)]
    rows = [(i, t + "\n" + _words(rnd, 12), "en", f"s{i % 3}", 0) for i, t in enumerate(base)]
    rows += [(100 + i, base[0].replace("alpha1 ", f"x{i} ") + "\nodd " + str(i), "en", None, 0) for i in range(6)]
    rows += [(200, base[1] + "\n" + base[2], "de", "s0", 0), (200, base[1] + "\n" + base[2], "de", "s0", 0)]
    rows += [(300, None, None, None, None), (301, "", "en", "s1", 0), (302, "one two", "fr", "s1", 7), (303, "one two", "fr", "s1", 7)]
    rows += [(400, _words(rnd, 6000), "en", "s2", 0), (401, "a  b \n\n c\t<|endoftext|> d　e Ж", "en", "s2", 0)]
    rows += [(None, "no id here at all today", "en", "s0", 0)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).withColumns({"k": F.lit("x"), "b": F.lit(1), "q": F.lit(2)}).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def counter(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, DIR).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert counter(got[cols].astype(object).values.tolist()) == counter(want[cols].astype(object).values.tolist())


def test_join_matches_brute_force(docs, none):
    got = counter((r.doc_id, r.class_id, r.n_links) for r in op1_ngram_join.near_classes(docs).collect())
    rows = corpus()

    def shingles(t):
        w = (t or "").lower().split()
        return frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    sets = [shingles(r[1]) for r in rows]
    near = [[j for j in range(len(rows)) if j != i and sets[i] and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
            for i in range(len(rows))]
    want = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j), todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        want.append((r[0], min(ids) if ids else None, len(near[i])))
    assert got == counter(want)
    assert op1_ngram_join.near_classes(none).count() == 0


@pytest.mark.parametrize("doc", [None, 5])
def test_one_of_each_tells_texts_of_one_id_apart(spark, doc):
    x, t = "one two three four five six seven", "this other text has nothing of it at all"
    rows = [(1, x), (doc, t), (doc, x), (doc, t), (9, None), (9, ""), (9, None), (10, x + " x")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"c": F.lit("c"), "k": F.lit(1)}).repartition(3)
    got = op1_ngram_join.one_of_each(table)
    assert got.columns == table.columns
    assert counter((r.doc_id, r.text or "") for r in got.collect()) == counter([(1, x), (doc, t), (9, ""), (10, x + " x")])


def test_forest_is_shortened_to_the_links_there_are(spark):
    rnd = random.Random(6)
    new = lambda n: [f"w{rnd.getrandbits(48)}" for _ in range(n)]

    def depth(share):
        rows = []
        for i in range(40):  # pairs that share their first words
            base = new(204)
            rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:share] + new(204 - share)))]
        sets = op1_ngram_join.signed(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("id", F.col("doc_id"))
        links, length, recall = op1_ngram_join.forest_links(sets)
        assert recall >= op1_ngram_join.RECALL or length == op1_ngram_join.DEPTHS[-1]
        return length, {(r.a, r.b) for r in links.collect()}
    close, found = depth(202)
    assert close == 8 and found == {(2 * i, 2 * i + 1) for i in range(40)}
    far, found = depth(182)  # 178 of 222 shingles: just above the threshold
    assert far == 5 and {(2 * i, 2 * i + 1) for i in range(40)} <= found


def test_join_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(op1_ngram_join, "BLOCK", 4)
    rnd = random.Random(1)
    base = _words(rnd, 200).split()
    rows = []
    for i in range(15):
        w = list(base)
        w[rnd.randint(0, 199)] = f"edit{i}"
        rows.append((i, " ".join(w)))
    got = op1_ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 14)}


def test_join_finds_least_links_beside_a_hot_group(spark):
    rnd = random.Random(8)
    new = lambda n: [f"w{rnd.getrandbits(48)}" for _ in range(n)]
    base, rows = new(200), []
    for i in range(2000):  # near copies of one text
        at = rnd.randint(0, 199)
        rows.append((i, " ".join([*base[:at], f"edit{i}", *base[at + 1:]])))
    for i in range(300):  # 80 of 100 shingles shared
        head = new(84)
        rows += [(10000 + 2 * i + j, " ".join(head + new(10))) for j in (0, 1)]
    got = op1_ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    pairs = [r for r in got if r.doc_id >= 10000]
    assert len(pairs) == 600 and [r.doc_id for r in pairs if r.n_links != 1 or r.class_id != r.doc_id - r.doc_id % 2] == []
    assert {r.class_id for r in got if r.doc_id < 10000} == {0}


def test_one_of_each_keeps_columns(docs):
    kept = op1_ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(200) == 1 and 303 not in ids and {300, 301, 302, None} <= set(ids)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_units_match_the_library(name):
    from tokenizers import Tokenizer

    from minutebook.llm.units import Units
    path = op2_token_counts.tokenizer_file(name)
    lib = Tokenizer.from_file(path)
    texts = [r[1] or "" for r in corpus()] + ["x " * 50000, " lead", "trail ", "a\n\nb", "don't we'll I'M", "é é ß 12,345 $5", "\x1c a\x85b",
                                              "<|startoftext|> <|EndOfText|> x", "日本 語 text", "y" * 3000]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert Units(path, ids=False).batch(texts) == [len(w) for w in want]
    got = Units(path, ids=True)
    for _ in range(2):
        assert [list(np.frombuffer(b, np.uint32)) for b in got.batch(texts)] == want


def test_units_beyond_the_cache(monkeypatch):
    from minutebook.llm import units
    path = op2_token_counts.tokenizer_file("word_bpe_49k.json")
    texts = [r[1] or "" for r in corpus()]
    want = units.Units(path, ids=False).batch(texts)
    monkeypatch.setattr(units, "MAX_UNITS", 5)
    assert units.Units(path, ids=False).batch(texts) == want
    long = "word and more " * 20000
    assert "".join(safe_pieces(long)) == long and len(safe_pieces(long)) > 1


def test_token_counts_on_odd_rows(docs, none):
    path = op2_token_counts.tokenizer_file("word_bpe_49k.json")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in op2_token_counts.count_tokens(docs, path).collect()}
    assert got[300] == (0, 0) and got[301] == (0, 0) and got[302][0] == 7
    assert op2_token_counts.count_tokens(none, path).count() == 0


def test_packing_is_whole_and_gapless(docs, none):
    path = op2_token_counts.tokenizer_file("byte_bpe_50k.json")
    packed = op3_packing.pack_documents(docs, path, capacity=64, with_ids=True)
    rows = packed.toPandas().sort_values(["sequence_id", "offset"])
    for _, s in rows.groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 64
    for _, d in rows[rows["doc_id"].notna() & (rows["doc_id"] != 200)].groupby("doc_id"):
        d = d.sort_values("piece")
        assert d["start"].tolist() == [0, *np.cumsum(d["length"])[:-1]] and (d["length"].iloc[1:] == 64).all()
    assert (rows["ids"].map(zlib.crc32) == rows["ids_crc32"]).all()
    assert rows[rows["doc_id"] == 300]["ids"].tolist() == [(2).to_bytes(4, "little")]
    assert (rows["doc_id"] == 200).sum() % 2 == 0
    whole = {r.sequence_id: bytes(r.ids) for r in op3_packing.sequences(packed).collect()}
    assert whole == {k: b"".join(s["ids"]) for k, s in rows.groupby("sequence_id")}
    assert op3_packing.pack_documents(none, path).count() == 0


def test_bins_are_full_and_complete():
    rnd = random.Random(3)
    counts = {rnd.randint(1, 100): rnd.randint(1, 50) for _ in range(40)}
    bins = op3_packing.minimum_bin_slack(counts, 100)
    used = {}
    for times, content in bins:
        assert sum(s * c for s, c in content) <= 100
        for s, c in content:
            used[s] = used.get(s, 0) + times * c
    assert used == counts


def test_a_bin_gets_the_fullest_combination():
    rnd = random.Random(9)
    for _ in range(200):
        supply = {rnd.randint(1, 30): rnd.randint(1, 3) for _ in range(rnd.randint(1, 6))}
        room = rnd.randint(0, 60)
        sums = {0}
        for size, n in supply.items():
            sums = {x + k * size for x in sums for k in range(n + 1)}
        got = op3_packing._fullest(room, supply, sorted(supply, reverse=True))
        assert all(n <= supply[size] for size, n in got.items())
        assert sum(size * n for size, n in got.items()) == max(x for x in sums if x <= room)


def test_bins_near_a_known_best():
    rnd, counts = random.Random(6), {}
    for _ in range(500):  # full sequences cut into three to eight pieces
        cuts = sorted(rnd.sample(range(1, 1024), rnd.randint(2, 7)))
        for a, b in zip([0, *cuts], [*cuts, 1024]):
            counts[b - a] = counts.get(b - a, 0) + 1
    assert 500 <= sum(times for times, _ in op3_packing.minimum_bin_slack(counts, 1024)) <= 505


def test_quality_separates_held_out_rows(spark):
    got = QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().merge(got, on="doc_id")
    held = labels[labels["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() >= 0.95


def test_quality_on_odd_rows(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (302, 0, 0), (302, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = op4_quality.keep_good(spark, docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()  # nothing learned: prior 0.5
    stats = op4_quality.document_stats(docs)
    model = op4_quality.train(stats, labels)
    assert op4_quality.scored(stats, model).count() == docs.count()
    assert op4_quality.keep_good(spark, none, labels).count() == 0


def test_isotonic_is_monotone():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=200)
    _, y = op4_quality.isotonic(x, (x + rnd.normal(size=200) > 0).astype(float))
    assert (np.diff(y) > 0).all()


def test_mixing_on_odd_rows(docs, none):
    got = op5_mixing.mix(op5_mixing.sizes_of(docs)).toPandas()
    assert len(got) == docs.count()
    assert (got["taken"] <= 3 * got["size"]).all()
    assert got.loc[got["doc_id"] == 300, "size"].tolist() == [0]
    for _, s in got.groupby("source_no"):
        assert abs(s["taken"].sum() - s["target"].iloc[0]) <= s["size"].max()
    mixed = op5_mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert op5_mixing.mix(op5_mixing.sizes_of(none)).count() == 0 and op5_mixing.mixed_documents(none).count() == 0


def _inclusion_by_hand(sizes, rest):
    """Probabilities proportional to a root of the size, capped at 1, whose expected words are ``rest``."""
    def root(n):
        step = 1 << max(0, n.bit_length() - 8)
        return int(16 * (n - n % step) ** 0.5)
    certain = set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in certain and sizes[i]]
        load = sum(root(sizes[i]) * sizes[i] for i in open_)
        factor = (rest - sum(sizes[i] for i in certain)) / load if load else 0
        over = {i for i in open_ if factor * root(sizes[i]) > 1}
        if not over:
            return [1.0 if i in certain else factor * root(n) for i, n in enumerate(sizes)]
        # the largest first: only they are certain for sure
        top = max(root(sizes[i]) for i in over)
        certain |= {i for i in over if root(sizes[i]) == top}


def test_mixing_meets_its_inclusion_probabilities(spark):
    # 240 sources of the same documents, half of their words taken: certain large ones, and shares as stated for the others
    sizes = [3000, 900, 300] + [40] * 6 + [7] * 8 + [0, 1]
    rows = [(1000 * s + i, f"s{s:03d}", n) for s in range(240) for i, n in enumerate(sizes)]
    table = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = op5_mixing.mix(table, weights=(3, 1)).toPandas()
    total = sum(sizes)
    for no, share in ((1, 0.5), (0, 0.5)):
        part = got[got["source_no"] % 2 == no]
        want = _inclusion_by_hand(sizes, share * total)
        assert want[0] == 1.0 or max(want) < 1
        i = part["doc_id"] % 1000
        for k, p in enumerate(want):
            mine = part[i == k]
            assert mine["probability"].iloc[0] == pytest.approx(p) and mine["probability"].nunique() == 1
            if p == 1:
                assert (mine["copies"] == mine["whole"] + 1).all()
        # shares are those of the probabilities up to what a sample of whole documents can do
        extra = part["copies"] - part["whole"]
        for n in (7, 40):
            assert abs(extra[part["size"] == n].mean() - want[sizes.index(n)]) < 0.12
    few = spark.createDataFrame([(i, "a" if i % 2 else "b", 10 + i % 5) for i in range(400)], "doc_id long, source string, size long")
    runs = [op5_mixing.mix(few, weights=(3, 1), salt=str(k)).toPandas().sort_values("doc_id") for k in range(6)]
    share = sum(r["copies"].to_numpy() - r["whole"].to_numpy() for r in runs).mean() / 6
    assert abs(share - runs[0]["probability"].mean()) < 0.02
    assert len({tuple(r["copies"]) for r in runs}) == 6


def test_mixed_documents_are_those_of_the_mix(docs):
    want = op5_mixing.mix(op5_mixing.sizes_of(docs)).select("doc_id", "size", "copies").collect()
    got = op5_mixing.mixed_documents(docs).select("doc_id", op5_mixing.words(F.col("text")).alias("size")).collect()
    assert counter(tuple(r) for r in got) == counter((r.doc_id, r["size"]) for r in want for _ in range(r.copies))


def test_targets_by_resharing(docs):
    got = {r.source: (r.source_size, r.target) for r in op5_mixing.targets(op5_mixing.sizes_of(docs)).collect()}
    total, free = sum(s for s, _ in got.values()), dict(got)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(got, key=lambda x: (x is None, x or "")))}
    want, rest = {}, total
    while free:
        w = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w >= 3 * free[s][0]]
        if not over:
            want |= {s: rest * weight[s] / w for s in free}
            break
        for s in over:
            want[s] = 3 * free.pop(s)[0]
        rest = total - sum(want.values())
    assert {s: pytest.approx(t) for s, t in want.items()} == {s: t for s, (_, t) in got.items()}


def _lines_by_hand(rows):
    """Removed line numbers of each different (doc_id, text): every line with a word against all earlier ones."""
    seen, gone = [], {}
    for doc, text in sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, np.int64(np.uint64(xxhash.xxh64(r[1].encode(), seed=42).intdigest())))):
        gone[doc, text] = []
        for i, line in enumerate(text.split("\n")):
            words = frozenset(line.lower().split())
            if words and any(9 * len(words & s) >= 4 * (len(words) + len(s)) for s in seen):
                gone[doc, text].append(i)
            if words:
                seen.append(words)
    return gone


def test_line_dedup_matches_brute_force(docs, none):
    rows = [(r[0], r[1]) for r in corpus()]
    gone = _lines_by_hand(rows)
    got = op6_line_dedup.removed_lines(docs).collect()
    assert counter((r.doc_id, r.removed) for r in got) == counter((d, gone[d, t or ""]) for d, t in rows)
    assert sum(map(bool, gone.values())) > 3
    stay = op6_line_dedup.without_repeats(docs)
    want = []
    for d, t in rows:
        left = [x for i, x in enumerate((t or "").split("\n")) if i not in gone[d, t or ""]]
        if not gone[d, t or ""] or any(x.strip(" ") for x in left):
            want.append((d, "\n".join(left) if gone[d, t or ""] else t))
    assert stay.columns == docs.columns and counter((r.doc_id, r.text) for r in stay.collect()) == counter(want)
    assert op6_line_dedup.removed_lines(none).count() == 0 and op6_line_dedup.without_repeats(none).count() == 0


@pytest.mark.parametrize("first, second", [("A", "B"), ("B", "A")])
@pytest.mark.parametrize("doc", [None, 7])
def test_line_dedup_of_shared_and_missing_ids(spark, doc, first, second):
    a, b = "alpha beta gamma delta eps zeta", "one two three four five six"
    rows = [(doc, a if first == "A" else b), (doc, a if second == "A" else b), (9, b), (10, a), (11, a + "\nown words here"), (11, a + "\nown words here")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = counter((r.doc_id, r.removed) for r in op6_line_dedup.removed_lines(table).collect())
    assert got == counter([(doc, []), (doc, []), (9, [0]), (10, [0]), (11, [0]), (11, [0])])


def test_line_dedup_of_every_line(spark):
    title, body = "Board minutes", "the board met at seven and heard the report"
    rows = [(1, f"{title}\n{body}\nShare this page\na b c d"), (2, f"{title}\n{body}"), (3, "share THIS page\n会議は七時に始まった\n\nna na na"),
            (4, "会議は七時に始まった\nd c b a e\nShare this\nna"), (5, "a b c x\nplain words of this document only"), (None, "na\n")]
    gone = _lines_by_hand(rows)
    assert {d: g for (d, _), g in gone.items() if g} == {2: [0, 1], 3: [0, 3], 4: [0, 1, 3]}
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.removed for r in op6_line_dedup.removed_lines(table).collect()} == {d: g for (d, _), g in gone.items()}
    left = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, t]) for d, t in rows}
    assert {r.doc_id: r.text for r in op6_line_dedup.without_repeats(table).collect()} == {d: x for d, x in left.items() if d != 2}


def test_key_filter_loses_no_match(spark):
    keys = spark.range(0, 5000, 7).select(F.xxhash64("id").alias("h"))
    left = maybe_in(spark.range(5000).withColumn("kept", F.lit(1)), F.xxhash64("id"), keys, F.col("h"))
    assert left.columns == ["id", "kept"]
    got = {r.id for r in left.collect()}
    assert set(range(0, 5000, 7)) <= got and len(got) < 900
    assert maybe_in(spark.range(5000), F.xxhash64("id"), keys.limit(0), F.col("h")).count() == 0


def test_preferences_on_odd_rows(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes <|end|>"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (2, None, None, None),
             (3, 0, "user", "only"), (None, 0, "user", "lost"), (2, 0, "user", "hi")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    convs = op7_preferences.conversations(table).cache()
    got = {r.conv_id: r for r in op7_preferences.preference_examples(op7_preferences.with_other_answer(convs)).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1].prompt == "<|user|>\nhi<|end|>\n" and got[1].chosen == "<|assistant|>\nyes < |end|><|end|>\n"
    assert got[1].rejected == "<|assistant|>\nno<|end|>\n" and got[3].chosen == "" and got[3].n_prompt_turns == 1
    for r in got.values():
        assert sum(s.length for s in r.chosen_mask) == len(r.chosen) and sum(s.length for s in r.rejected_mask) == len(r.rejected)
    assert [s.trained for s in got[1].chosen_mask] == [False, True]
    assert op7_preferences.preference_examples(op7_preferences.with_other_answer(op7_preferences.conversations(table.limit(0)))).count() == 0


def test_language_on_held_out_rows(spark):
    got = QUERIES["op8_language"](spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas().merge(got, on="doc_id")
    held = truth[truth["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() >= 0.95 and got["score"].between(0, 1).all()


def test_language_on_odd_rows(docs, none):
    model = op8_language.fit(op8_language.learning_rows(docs, lambda c: F.lit(True)))
    got = {r.doc_id: (r.lang_pred, r.score) for r in op8_language.identify(docs, model).collect()}
    assert got[300] == ("und", 0.0) and got[301] == ("und", 0.0) and got[302][0] in ("en", "de", "fr")
    nothing = op8_language.fit(op8_language.learning_rows(none, lambda c: F.lit(True)))
    assert {r.lang_pred for r in op8_language.identify(docs, nothing).collect()} == {"und"}
    assert op8_language.identify(none, model).count() == 0


def test_codewords_are_apart():
    for n in (2, 4, 6, 9, 30):
        code = op8_language.codewords(n)
        assert len({tuple(r) for r in code}) == n and (np.abs(code.sum(0)) < n).all()


def test_margins_do_not_depend_on_the_batch(monkeypatch):
    counts = np.arange(2 * op8_language.BUCKETS, dtype=float).reshape(2, -1) % 7
    model = op8_language.Model(["a", "b"], counts)
    texts = ["short", "a longer text, with more", "", "ünïcode" * 50]
    one = np.vstack([model.margins([t]) for t in texts])
    monkeypatch.setattr(op8_language, "CHUNK", 37)
    assert np.allclose(model.margins(texts), one)


def test_fingerprints_on_odd_rows(docs, none):
    rows = op9_fingerprint.with_edit(op9_fingerprint.fingerprints(docs)).collect()
    texts = sorted(((r[0], r[1] or "") for r in corpus()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (doc, t) in enumerate(texts):
        n = len(t) // 3
        want.append((doc, t[:len(t) - n] + texts[(i + 1) % len(texts)][1][:n]))
    assert counter((r.doc_id, r.edited) for r in rows) == counter(want)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text, set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len({min(v) for v in by_text.values()}) == len(by_text)
    assert op9_fingerprint.fingerprints(none).count() == 0
    assert op9_fingerprint.with_edit(op9_fingerprint.fingerprints(none)).count() == 0


def _edits_by_hand(a, b):
    """removed, added and moved paragraph numbers: equal ends passed over, then n-th occurrence against n-th."""
    x, y = a.split("\n"), b.split("\n")
    lead = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    tail = next((i for i, (p, q) in enumerate(zip(x[::-1], y[::-1])) if p != q), min(len(x), len(y)))
    tail = min(tail, min(len(x), len(y)) - lead)

    def places(lines):
        seen, out = {}, {}
        for i in range(lead, len(lines) - tail):
            seen[lines[i]] = seen.get(lines[i], 0) + 1
            out[lines[i], seen[lines[i]]] = i
        return out
    px, py = places(x), places(y)
    kept = [py[k] for k in sorted(px.keys() & py.keys(), key=px.get)]
    return (",".join(str(px[k]) for k in sorted(px.keys() - py.keys(), key=px.get)), ",".join(str(py[k]) for k in sorted(py.keys() - px.keys(), key=py.get)),
            ",".join(str(i) for i in sorted(i for i, j in zip(kept, sorted(kept)) if i != j)))


def test_edits_are_located(spark):
    lines = [f"paragraph number {i}." for i in range(30)]
    a = "\n".join(lines)
    known = {"\n".join(lines[:17] + ["seventeen"] + lines[18:]): ("17", "17", ""),
             "\n".join(lines[:5] + lines[6:]): ("5", "", ""),                                  # a deletion
             "\n".join(lines[:9] + [lines[2]] + lines[10:]): ("9", "9", ""),                   # overwritten by a copy
             "\n".join(lines[:3] + [lines[4], lines[3]] + lines[5:]): ("", "", "3,4"),         # two in another order
             a + "\n" + lines[0]: ("", "30", ""), a: ("", "", "")}
    rnd = random.Random(11)
    pairs = [(a, b) for b in known] + [("", ""), ("", "x"), ("x\ny", ""), ("\n" * 9000, "\n" * 8000 + "z"), ("z\n" + "same\n" * 5000, "same\n" * 5001)]
    for _ in range(200):
        x = [rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 40))]
        y = list(x)
        for _ in range(rnd.randint(0, 4)):
            i = rnd.randrange(len(y) + 1)
            y[i:i + rnd.randint(0, 3)] = [rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 3))]
        pairs.append(("\n".join(x), "\n".join(y)))
    df = spark.createDataFrame(pairs, "a string, b string")
    df = df.select("a", "b", op9_fingerprint.fingerprint(F.col("a")).alias("fa"), op9_fingerprint.fingerprint(F.col("b")).alias("fb"))
    rows = op9_fingerprint.with_edits(df, "fa", "fb").withColumn("s", op9_fingerprint.likeness(F.col("fa"), F.col("fb"))).collect()
    for r in rows:
        assert (r.removed, r.added, r.moved) == _edits_by_hand(r.a, r.b), (r.a[:200], r.b[:200])
    for r in rows[:len(known)]:
        assert (r.removed, r.added, r.moved) == known[r.b]
    assert rows[0].s > 0.8 and rows[5].s == 1


def test_next_row_over_many_ranges(spark):
    rnd = random.Random(2)
    ids = [rnd.randint(0, 50) * 7 for _ in range(300)] + [None, None]
    rows = [(i, f"t{n:03d}") for n, i in enumerate(ids)]
    for down in (True, False):
        got = with_next(spark.createDataFrame(rows, "id long, t string"), "id", ["t"], ["t"], down, rows_per_range=10).collect()
        order = sorted(rows, key=lambda r: (r[0] is None, (-r[0] if down else r[0]) if r[0] is not None else 0, r[1]))
        assert counter((r.id, r.t, r.next_t) for r in got) == counter((*r, order[(n + 1) % len(order)][1]) for n, r in enumerate(order))


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op10_topk, "RANGE_ROWS", 50)
    monkeypatch.setattr(op10_topk, "QUERIES_PER_PART", 3)
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rnd.normal(size=8)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 460)]
    rows += [(500, None), (550, [float("nan")] * 8), (600, [float("inf")] + [0.0] * 7), (650, [None] * 8), (700, []), (None, [1.0] * 8), (750, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rng", F.lit(1))
    got = counter(tuple(r) for r in op10_topk.top_k(table, F.col("vec_id") % 50 == 0).collect())
    good = {i: np.floor(256 * np.array((v + [0.0] * 8)[:8])).astype(int) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for i, q in good.items():
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in good.items() if j != i)[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert got == counter(want)
    assert op10_topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "mixing", "packing"]
    docs = corpus_pipeline.read(spark, DIR, "documents")
    out = corpus_pipeline.run(spark, DIR).toPandas()
    assert out.groupby("sequence_id")["length"].sum().max() <= 1024
    assert set(out["doc_id"]) <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_edited_hash(spark):
    got = QUERIES["op9_fingerprint"](spark, DIR).select("doc_id", "n_chars", "edited_sha256").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(os.path.join(DIR, "documents.parquet")).select("doc_id", "text").collect()}
    order = sorted(texts, reverse=True)
    for r in got:
        t, n = texts[r.doc_id], len(texts[r.doc_id]) // 3
        after = texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - n] + after[:n]).encode()).hexdigest()


def test_line_dedup_lower_cases_once(spark):
    """The written words hold their number, and no text is lower-cased once for every mention of it."""
    words = op6_line_dedup.line_words(spark.createDataFrame([(1, "B a\tA b\n\nc")], "doc_id int, text string"))
    assert sorted((r.line_no, r.n, len(r.h)) for r in words.collect()) == [(0, 2, 2), (1, 0, 0), (2, 1, 1)]
    plain = spark.createDataFrame([("a",)], "low string").select(op6_line_dedup._plain(F.col("low")))
    assert "lower" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_line_dedup_cuts_each_text_once(spark, monkeypatch):
    """The step that writes words lower-cases and cuts a text once: no count and no filter of its own does so again."""
    plans = []
    kept = op6_line_dedup.saved
    monkeypatch.setattr(op6_line_dedup, "saved", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or kept(df, *a))
    words = op6_line_dedup.line_words(spark.createDataFrame([(1, "B a\nc"), (2, None), (3, "")], "doc_id int, text string"))
    assert sorted((r.doc_id, r.line_no, r.n_lines, r.n) for r in words.collect()) == [(1, 0, 2, 2), (1, 1, 2, 1), (2, 0, 0, 0), (3, 0, 0, 0)]
    assert plans[0].count("lower(") == 1 and "replace(" not in plans[0]


def test_line_dedup_bounds_of_a_shared_word(spark):
    """An index row's most words are those of the length and positional filters, for every size and place."""
    lines = [(n, n, 0, 0, [0] * (n - -(-4 * n // 5) + 1)) for n in range(1, 40)]
    index = op6_line_dedup._index(spark.createDataFrame(lines, "id long, n int, s1 long, s2 long, prefix array<int>")).collect()
    at = {}
    for r in index:
        at.setdefault(r.id, []).append(r.nm & 0xFFFFFFFF)
        assert r.nm >> 32 == r.id
    assert set(at) == set(range(4, 40))
    for n, most in at.items():
        for i, m in enumerate(sorted(most, reverse=True)):
            fits = [k for k in range(1, 200) if 9 * (n - i) >= 4 * (n + k) and 4 * k <= 5 * n]
            assert m == max(fits)


def test_line_dedup_of_long_lines(spark):
    """Near lines on both sides of 64 words, where the sketch gets its second half, and just below 4/5."""
    rows, rng = [], np.random.default_rng(3)
    for g, n in enumerate([50, 63, 64, 65, 72, 100, 150, 300]):
        words = [f"g{g}w{i}" for i in range(n)]
        kept = [words[:-(-4 * n // 5)], words[:-(-4 * n // 5) - 1], words + [f"g{g}x{i}" for i in range(n // 4)],
                words + [f"g{g}y{i}" for i in range(n // 4 + 1)], words]
        rows += [(10 * g + k, " ".join(rng.permutation(w))) for k, w in enumerate(kept)]
    gone = _lines_by_hand(rows)
    got = op6_line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.removed for r in got} == {d: g for (d, _), g in gone.items()}
    assert 0 < sum(map(bool, gone.values())) < len(rows) - 8


def test_line_dedup_reads_no_text_for_its_report(spark):
    """Line counts and rows come from the written words, 64 lines of a document are one number; also over 64 lines."""
    long = "\n".join(f"w{i} x{i}" if i % 5 else "" for i in range(200))
    rows = [(1, long), (2, f"w7 x7\nown\n{long}"), (3, None), (3, ""), (3, ""), (4, "\n"), (5, "Own\r\n\nalone\n"), (None, long), (1, long)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = op6_line_dedup.removed_lines(table)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan and "split(" not in plan
    gone = _lines_by_hand(rows)
    want = counter((d, len(t.split("\n")) if t else 0, gone[d, t or ""]) for d, t in rows)
    assert counter((r.doc_id, r.n_lines, r.removed) for r in got.collect()) == want
    assert max(map(len, gone.values())) > 128
