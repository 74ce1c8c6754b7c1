"""Language identification: probabilities by the definition, held-out accuracy,
odd rows."""

from collections import Counter

import numpy as np
import pytest

from quarry.llm import langid

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, accepted long"


def windows(text):
    out = []
    t = "".join(c if c.isalpha() else " " for c in text.lower())
    t = "   " + t + "   "
    for i in range(3, len(t)):
        if t[i] != " " or t[i - 1] != " ":
            out.append(t[i - 3:i + 1])
    return out


def code(w):
    return sum(ord(c) << (16 * i) for i, c in enumerate(reversed(w)))


def test_codes_by_definition():
    texts = ["Ab, cd!", "", "É 12 x", "  z"]
    grams, off = langid.gram_codes(texts)
    for i, t in enumerate(texts):
        assert grams[off[i]:off[i + 1]].tolist() == [code(w) for w in windows(t)]


def brute_probability(counts, w):
    """Interpolated Kneser-Ney from full-order counts, by the definition."""
    tables = {4: counts}
    for m in (3, 2, 1):
        tables[m] = Counter(g[1:] for g in tables[m + 1])
    p = 1 / (len(tables[1]) + 1)
    for m in (1, 2, 3, 4):
        ones, twos = (sum(1 for v in tables[m].values() if v == k) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones else 0.5
        g = w[-m:]
        same = {k: v for k, v in tables[m].items() if k[:-1] == g[:-1]}
        total = sum(same.values())
        if total:
            p = max(tables[m].get(g, 0) - d, 0) / total + sum(min(v, d) for v in same.values()) / total * p
    return p


def test_probabilities_match_brute_force():
    counts = Counter(w for t in ("banana bandana", "an apple a day", "ban the band") for w in windows(t))
    grams = np.array([code(g) for g in counts], np.uint64)
    levels, floor = langid.kneser_ney(grams, np.array(list(counts.values())))
    models = langid.LanguageModels(["x"], [levels], [floor])
    wanted = ["bana", " ban", "   q", "zzzz", "anan", "nana", "e a ", "y   "]
    got = np.exp(models.slow(np.array([code(w) for w in wanted], np.uint64)))[:, 0]
    assert got == pytest.approx([brute_probability(counts, w) for w in wanted])
    seen = sorted({g[:-1] for g in counts})
    letters = sorted({g[-1] for g in counts})
    for h in seen:  # a distribution over letters, but for the unseen letter
        p = np.exp(models.slow(np.array([code(h + c) for c in [*letters, "q"]], np.uint64)))[:, 0]
        assert p.sum() == pytest.approx(1.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = "crc32(cast(doc_id as string)) % 3 = 1"
    models = langid.fit(docs.filter(f"not ({held})"))
    rows = langid.predict(docs, models).join(docs.filter(held).select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert np.mean([r.accepted for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", "", 1), (2, "der hund und die katze", "de", "", 1), (3, None, "en", "", 1),
            (4, "", None, "", 1), (5, "123 !?", "de", "", 1), (None, "the dog", "en", "", 1), (6, "und die " * 40_000, None, "", 1),
            (7, "漢字 😀", None, "", 1), (7, "漢字 😀", None, "", 1), (8, "𠀀𠀁", None, "", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    models = langid.fit(df)
    got = langid.predict(df, models).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert (by[1].lang_pred, by[2].lang_pred, by[6].lang_pred, by[None].lang_pred) == ("en", "de", "de", "en")
    assert [by[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and by[3].score == 0
    assert by[7].lang_pred in ("en", "de") and not by[7].accepted and by[8].lang_pred in ("en", "de")
    none = langid.fit(spark.createDataFrame([], SCHEMA))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}
    assert langid.predict(df.limit(0), models).collect() == []


def test_large_models_stay_whole(spark, monkeypatch):
    """Tables instead of a broadcast, few values ahead: the same results."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(10 ** 9 + i, t, None) for i, t in enumerate(("漢字 qqzz", "", None, "abc " * 9))], docs.schema)
    docs = docs.unionByName(extra)
    train = docs.filter("crc32(cast(doc_id as string)) % 3 <> 1")
    small = langid.fit(train)
    want = {r.doc_id: r for r in langid.predict(docs, small).collect()}
    monkeypatch.setattr(langid, "MOST_GRAMS", 100)
    monkeypatch.setattr(langid, "MOST_VALUES", 500)
    large = langid.fit(train)
    assert large.tables is not None and 0 < len(large.table) <= 500
    got = langid.predict(docs, large).collect()
    assert len(got) == len(want) and large.limits == pytest.approx(small.limits)
    for r in got:
        w = want[r.doc_id]
        assert (r.lang_pred, r.accepted) == (w.lang_pred, w.accepted) and r.score == pytest.approx(w.score, abs=1e-9)


def test_rare_languages_get_a_rejection_limit(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 20)
    words = ["the cat and the dog", "a dog is in the house", "we read the books"]
    rows = [(i, f"{words[i % 3]} {words[i % 2]}", "en", "", 1) for i in range(400)]
    rows += [(1000 + i, "zq" + c * 3 + " wj" + c * 2, f"x{c}", "", 1) for i, c in enumerate("bfgkpv")]
    models = langid.fit(spark.createDataFrame(rows, SCHEMA))
    assert len(models.limits) == 7 and np.isfinite(models.limits).all()


def test_every_training_row_counts_for_limits_and_temperature(spark):
    """More rows a language than the old samples of 2,000: limits and temperature
    are those of all rows, worked out by hand."""
    rng = np.random.default_rng(5)
    letters = {"en": "abcdefg", "de": "defghij"}
    rows = [(i, " ".join("".join(rng.choice(list(letters[lang]), rng.integers(1, 7))) for _ in range(rng.integers(1, 4))), lang)
            for lang, n in (("en", 6000), ("de", 3000)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    models = langid.fit(df)
    h = np.concatenate([-s / np.maximum(n, 1)[:, None] for s, n, *_ in [models.sums([t for _, t, _ in rows])]])
    own = h[np.arange(len(rows)), [models.languages.index(lang) for *_, lang in rows]]
    for i, name in enumerate(models.languages):
        values = np.sort(own[[lang == name for *_, lang in rows]])
        exact = values[int(np.ceil(0.995 * len(values))) - 1]
        assert exact - 1e-9 <= models.limits[i] - 0.25 < exact + 0.0011
    heats = (1.0, 2.0, 5.0, 10.0, 20.0, 40.0)
    losses = [(np.log(np.exp(-t * h).sum(1)) + t * own).sum() for t in heats]
    assert models.temperature == heats[int(np.argmin(losses))]
