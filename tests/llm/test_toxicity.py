"""Toxicity: automaton against edit distance, context, learning, odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import toxicity as tx

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score string, c0 long, s double"


def distance(a, b):
    """Insertions, deletions, changes and swaps of neighbours."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def model_of(entries, weights=None):
    chars, table, out = tx.compile_automaton(entries)
    w = np.array(weights or [-3.0, 2, 1, 0, 0, 0])
    return tx.ToxicityModel(chars, table, out[0], out[1], out[2], out[3], w, entries)


def hits(model, words):
    text = " ".join(words) + "\n"
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    _, _, exact, fuzzy = tx._hits(model, model.classes(), cps)
    return [(float(e), float(f)) for e, f in zip(exact, fuzzy, strict=True)]


def test_automaton_equals_edit_distance():
    rnd = random.Random(1)
    terms = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(2, 10))) for _ in range(14)]
    model = model_of([(t, False, 1.0) for t in terms])
    words = ["".join(rnd.choice("abcéx") for _ in range(rnd.randint(1, 11))) for _ in range(2000)]
    for t in terms:  # near ones too
        for _ in range(60):
            w = list(t)
            for _ in range(rnd.randint(1, 3)):
                k = rnd.randrange(len(w) + 1)
                w[k:k + rnd.randint(0, 2)] = rnd.choice(["", "a", "x", "".join(reversed(w[k:k + 2]))])
            words.append("".join(w) or "b")
    for w, (e, f) in zip(words, hits(model, words), strict=True):
        assert (e > 0) == (w in terms)
        near = any(distance(w, t) <= tx.edits_of(len(t)) for t in terms)
        assert (f > 0) == (near and w not in terms), w


def test_misspellings_are_found():
    model = model_of([("idiot", False, 1.0), ("scum", False, 1.0), ("worthless", False, 1.0), ("abc", False, 1.0)])
    near = ["idoit", "id1ot", "1diot", "jdiot", "diot", "sccum", "scvm", "csum", "worthles", "w0rthle5s", "wrthlss", "wortlhess", "id*ot", "i.diot"]
    far = ["idoti5", "scv", "cm", "w0r7hl3ss", "wrthls", "abd", "ab", "id", "ot", "***", "12", "idi ot"]
    score = lambda w: tx.features(model, model.classes(), [f"so {w} then"])[0]
    assert [w for w in near if score(w)[2] == 0 and w != "i.diot"] == []
    assert [w for w in far if score(w)[1:3].any()] == []
    assert score("you!!!idiot")[1] > 0 and score("you!!!idiot")[2] == 0     # an exact word behind signs stays one
    assert score("IDIOT!")[2] == 0 and score("idiot123")[1] > 0


def test_misspellings_weigh_as_the_texts_say(spark):
    """An entry whose misspellings are as often harmless gets none of its weight."""
    rows = [(f"you idiot {i}", 1) for i in range(60)] + [(f"such trash {i}", 1) for i in range(60)]
    rows += [(f"a crash and a bash {i}", 0) for i in range(60)] + [(f"calm words {i}", 0) for i in range(60)]
    df = spark.createDataFrame(rows, "text string, toxic int")
    entries = [("idiot", False, 4.0), ("trash", False, 4.0)]
    idiot, trash = tx.misspelled_weights(df, entries)
    assert 0.9 * 4 * tx.SOFT < idiot <= 4 * tx.SOFT and trash == 0.0
    model = tx.fit(df)
    got = tx.score(spark.createDataFrame([(1, "you idoit there"), (2, "calm words"), (3, "you idiot there")], "id int, text string"), model)
    by = {r.id: r.score for r in got.collect()}
    assert by[2] < 0.1 and by[1] > tx.THRESHOLD and by[3] >= by[1]


def test_stems_match_beginnings_with_an_edit():
    model = model_of([("stupid", True, 2.0), ("abc", False, 1.0)])
    assert hits(model, ["stupidity", "stupd", "stxpidly", "tupid", "abc", "abcd", "stu"]) == [
        (2, 0), (0, 2), (0, 2), (0, 2), (1, 0), (0, 0), (0, 0)]


def test_quoted_hits_count_apart():
    model = model_of([("stupid", False, 3.0)])
    plain, quoted, none = tx.features(model, model.classes(), ["you are stupid ok", 'they said "stupid" is a bad word', "fine"])
    assert plain[1] > 0 and plain[3] == 0
    assert quoted[1] == 0 and quoted[3] > 0
    assert none[1:].tolist() == [0] * 5


def test_crowded_hits_score_higher():
    model = model_of([("stupid", False, 3.0)])
    near = "stupid stupid " + "calm " * 60
    far = "stupid " + "calm " * 59 + "stupid"
    a, b = tx.features(model, model.classes(), [near, far])
    assert a[4] > b[4]


def test_learns_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.fit(tx.labelled_sample(docs, labels, lambda c: F.expr(f"crc32(cast({c} AS string)) % 4 != 2")))
    rows = (tx.score(docs.select("doc_id", "text"), model).join(labels, "doc_id")
            .filter("crc32(cast(doc_id AS string)) % 4 = 2").select("toxic", "score").collect())
    bad = [r.score >= tx.THRESHOLD for r in rows if r.toxic == 1]
    good = [r.score >= tx.THRESHOLD for r in rows if r.toxic == 0]
    assert np.mean(bad) > 0.88 and np.mean(good) < 0.02


def test_odd_rows_and_clashing_columns(spark):
    model = model_of([("stupid", False, 3.0)])
    rows = [(1, None, "x", None, None), (2, "", "x", 1, 0.5), (None, "stupid", None, 1, None), (4, "stupid " * 50_000, "x", 1, 1.0),
            (5, "😀 stupid", "x", 1, 1.0), (5, "😀 stupid", "x", 1, 1.0)]
    out = tx.score(spark.createDataFrame(rows, SCHEMA), model)
    assert out.columns == ["doc_id", "text", "c0", "s", "score", "quoted_weight"]
    got = out.collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] < by[None] and by[4] > by[2] and by[5] == by[None]


def test_empty_tables_and_one_kind_of_label(spark):
    none = spark.createDataFrame([], "text string, toxic int")
    model = tx.fit(none)
    assert tx.score(spark.createDataFrame([], SCHEMA), model).collect() == []
    one = tx.fit(spark.createDataFrame([("a b", 0), ("c", 0), (None, None)], "text string, toxic int"))
    got = tx.score(spark.createDataFrame([(1, "a", "", 1, 1.0)], SCHEMA), one).first()
    assert got.score < 1e-6


def test_sample_is_bounded_in_rows(spark, monkeypatch):
    """Hundreds of texts under one id: the driver sees SAMPLE feature rows."""
    monkeypatch.setattr(tx, "SAMPLE", 60)
    taken = []
    real = tx._logistic
    monkeypatch.setattr(tx, "_logistic", lambda x, y: taken.append(len(y)) or real(x, y))
    docs = spark.range(500).selectExpr("7L AS doc_id", "concat('you idiot number ', id) AS text").union(
        spark.range(200).selectExpr("8L AS doc_id", "concat('a kind word number ', id) AS text"))
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, toxic int")
    tx.fit(tx.labelled_sample(docs, labels, lambda c: F.lit(True)))
    assert taken == [60]
