import math
import random
import re

import pytest

from minutebook.operators import qc

REC = "file string, stem string, kind string, duration_s double"


def test_checks_and_report(spark):
    rec = spark.createDataFrame([
        ("a.wav", "a", "wav", 100.0), ("a.mp3", "a", "mp3", 103.0), ("a.txt", "a", "transcript", None),
        ("b.wav", "b", "wav", 0.0), ("b.mp3", "b", "mp3", 0.5), ("b.txt", "b", "transcript", None),
        ("b.summary.txt", "b", "summary", None),
        ("c.wav", "c", "wav", 10.0), ("c.mp3", "c", "mp3", 10.0), ("c.txt", "c", "transcript", None),
        ("c.summary.txt", "c", "summary", None),
    ], REC)
    issues = [qc.check_complete(rec), qc.check_durations(rec), qc.check_readable(rec)]
    got = sorted((r.file, r.check) for i in issues for r in i.collect())
    assert got == [("a.wav", "duration_mismatch"), ("a.wav", "missing_summary"), ("b.wav", "unreadable")]
    rep = qc.qc_report(issues, rec.select("file")).collect()
    assert len(rep) == rec.count()                      # one verdict per file
    status = {r.file: r.status for r in rep}
    assert status["a.wav"] == "fail" and status["c.wav"] == "pass" and status["a.mp3"] == "pass"


def test_repeats_terms_support(spark):
    docs = spark.createDataFrame([(1, "The the cat sat"), (2, "one two")], "doc_id int, text string")
    assert {r.file: r.detail for r in qc.check_repeats(docs).collect()} == {"1": "1"}
    terms = spark.createDataFrame([("cat",), ("dog",)], "term string")
    got = {r.file: r.detail for r in qc.check_terms(docs, terms).collect()}
    assert got == {"1": "dog", "2": "cat,dog"}
    sup = spark.createDataFrame([(1, "paid 120 and 98765", "paid 120 dollars")], "doc_id int, summary string, transcript string")
    assert qc.check_support(sup).first().detail == "98765"
    sup = spark.createDataFrame([
        (1, "$1,250 on June 12, 1975 by 5 votes", "$9,250 on May 12, 1975 by 3 votes"),
        (2, "In 1975 and on MAY 12, 1975: $9,250", "$9,250 on May 12, 1975 by 3 votes"),
        (3, None, "5"), (4, "", None)], "doc_id int, summary string, transcript string")
    assert {r.file: r.detail for r in qc.check_support(sup).collect()} == {"1": "$1,250;5;june 12, 1975"}


def test_fixed_formatting(spark):
    df = spark.createDataFrame([(15.625,), (-1.5,), (0.0,), (2.0,), (-0.004,)], "x double")
    got = [r[0] for r in df.select(qc.fixed("x", 2)).collect()]
    assert got == ["15.62", "-1.50", "0.00", "2.00", "-0.01"]


def test_durations_many_files_per_stem(spark):
    # a stem with several WAVs and MP3s: one issue per WAV (no pair rows),
    # flagged when some MP3 is off by more than the tolerance
    wavs = [("h1.wav", "h", "wav", 100.0), ("h2.wav", "h", "wav", 102.0), ("h3.wav", "h", "wav", 101.0)]
    mp3s = [("h%d.mp3" % i, "h", "mp3", d) for i, d in enumerate([100.5, 101.0, 101.5, 102.5])]
    rec = spark.createDataFrame(wavs + mp3s + [("k.wav", "k", "wav", None), ("k.mp3", "k", "mp3", 9.0)], REC)
    got = {r.file: r.detail for r in qc.check_durations(rec, tol_s=1.0).collect()}
    want = {}
    for f, _, _, w in wavs:
        diffs = [m - w for *_, m in mp3s]
        if any(abs(d) > 1.0 for d in diffs):
            want[f] = "%.3f" % max(diffs, key=lambda d: (abs(d), d))
    assert got == want == {"h1.wav": "2.500", "h2.wav": "-1.500", "h3.wav": "1.500"}


def test_names_against_brute_force(spark):
    # names inside longer words, with marks at their ends, of one bare run, with inner runs, twice in the roster
    rng = random.Random(3)
    pieces = ["ann", "lee", "Smithson", "O'Neil", "Jo", "de la", "Groß", "(Ray", "Kurt)", "x", "Mary-Jane", "St. John"]
    names = [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 3))) for _ in range(60)] + ["", " ", None, "Ann Lee", "ann lee"]
    members = [(str(1970 + rng.randint(0, 2)), n) for n in names]
    texts = [(f"m{i}", str(1970 + i % 4) if i % 7 else None,
              None if i == 5 else "".join(rng.choice(pieces + [" ", " ", "Joann leeds", "\n", "SMITHSON "]) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    got = qc.check_names(spark.createDataFrame(texts, "meeting string, year string, transcript string"),
                         spark.createDataFrame(members, "year string, name string"), by="year").collect()
    want = sorted((m, n) for m, y, t in texts for z, n in members if y == z and n is not None and n.upper() not in (t or "").upper())
    assert sorted((r.file, r.detail) for r in got) == want and len(want) > 100
    none = spark.createDataFrame([], "year string, name string")
    assert qc.check_names(spark.createDataFrame(texts, "meeting string, year string, transcript string"), none, by="year").count() == 0


def test_names_of_a_meeting_in_several_lists(spark):
    names = spark.createDataFrame([("y", f"A {i} B") for i in range(50)], "y string, name string")
    texts = spark.createDataFrame([("m", "y", " ".join(f"A {i} B" for i in range(0, 60, 2)))], "m string, y string, t string")
    got = {r.name for r in qc.named_in(texts, names, "y", "m", "t", per_row=7).collect()}
    assert got == {f"A {i} B" for i in range(0, 50, 2)}


def test_evidence_against_brute_force(spark):
    rows = [(1, "The budget passed. Zebras flew over Paris! ...", "the Budget was read and passed by all"),
            (2, "Nobody spoke", None), (3, None, "the roll was called"), (4, "", "a"),
            (5, "The roll was called? The roll was called by zebras.", "the roll was called at noon")]
    got = {(r.file, r.detail) for r in qc.check_evidence(spark.createDataFrame(rows, "doc_id int, summary string, transcript string")).collect()}

    def words(t):
        return set(re.findall("[a-z]+", (t or "").lower()))
    held = {k: words(t) for k, _, t in rows}

    def weight(w):
        return math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * sum(w in h for h in held.values()) + 1)))
    want = set()
    for k, s, _ in rows:
        for i, ws in enumerate([words(x) for x in re.split("[.!?\n]+", s or "") if words(x)], 1):
            have, every = sum(weight(w) for w in ws & held[k]), sum(map(weight, ws))
            if 100 * have < 60 * every:
                want.add((str(k), f"{i}: {100 * have // every}"))
    assert got == want and {k for k, _ in want} == {"1", "2", "5"}


@pytest.mark.parametrize("least, most", [(60, 1), (60, 1 << 19), (101, 9)])
def test_evidence_in_batches(spark, monkeypatch, least, most):
    """Whatever the batches: shared and null keys, an empty transcript, sigma at a sentence's end, and one text that repeats
    its sentences, whose words are written once."""
    rows = [(1, "The budget passed. The zebra left.", "the budget passed"), (1, "The motion was read. The budget passed.", "the"),
            (None, "A B.C", "a"), (None, "A B.C d", "c"), (2, "\u039f\u03a3.\u0391 no", "\u03bf\u03c2 \u03b1"), (3, "x. y", ""),
            (4, "one two lost. " * 300, "one two " * 300), (5, "all here", "here all")]
    written, stored = [], qc.stored

    def kept(df, name):
        written.append(stored(df, name))
        return written[-1]
    monkeypatch.setattr(qc, "stored", kept)
    monkeypatch.setattr(qc, "BATCH_WORDS", most)
    df = spark.createDataFrame(rows, "doc_id int, summary string, transcript string")
    got = sorted((r.file or "", r.detail) for r in qc.check_evidence(df, least=least).collect())

    def words(t):
        return set(re.findall("[a-z\u03b1-\u03c9]+", (t or "").lower()))
    held = [words(t) for _, _, t in rows]
    weight = {w: math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * sum(w in h for h in held) + 1)))
              for w in set().union(*held, *(words(s) for _, s, _ in rows))}
    sums = {}
    for (k, s, _), h in zip(rows, held):
        for i, ws in enumerate([words(x) for x in re.split("[.!?\n]+", s) if words(x)], 1):
            have, every = sums.get((k, i), (0, 0))
            sums[k, i] = have + sum(weight[w] for w in ws & h), every + sum(weight[w] for w in ws)
    assert got == sorted((str(k or ""), f"{i}: {100 * a // b}") for (k, i), (a, b) in sums.items() if 100 * a < least * b)
    assert sum(r.w.count("lost") for r in written[0].selectExpr("words AS w").collect()) == 1
