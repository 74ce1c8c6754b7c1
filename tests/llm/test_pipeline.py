"""The pipeline against brute-force stages on whole documents."""

import hashlib

import pytest

import corpus_pipeline as cp
from quarry.llm import toxicity
from tests.llm.test_dedup import brute_components
from tests.llm.test_packing import check_layout
from tests.llm.test_substring_dedup import brute

SF = "/root/testdata/sf0.01"


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        seen[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = seen[name][1]
        if name != "packing":
            assert docs.columns == columns

    was, now = (d.collect() for d in seen["toxicity"])
    assert 0.8 * len(was) < len(now) < len(was)
    assert not any("worthless idiot" in (r.text or "").lower() for r in now)

    was, now = (d.collect() for d in seen["exact_dedup"])
    keep = {}
    for r in was:
        keep[r.text] = max(keep.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in now) == sorted(keep.values())

    was, now = (d.collect() for d in seen["near_dedup"])
    groups = brute_components([(r.doc_id, r.text) for r in was])
    assert sorted(r.doc_id for r in now) == sorted({c for _, c in groups.values()})

    was, now = (d.collect() for d in seen["substring_dedup"])
    want = {r[0]: r[3] for r in brute([(r.doc_id, r.text) for r in was], 35)}
    got = {r.doc_id: hashlib.sha256(" ".join(r.text.encode().decode().split()).encode()).hexdigest() for r in now}
    assert sorted(got) == sorted(want)
    same = {r.doc_id: r.text for r in was}
    assert all(len(r.text) == r.n_chars for r in now if r.text != same[r.doc_id])
    plain = [i for i in got if not any(c in same[i] for c in "\x1c\x1d\x1e\x1f\x85\xa0  　")]
    assert len(plain) > 0.5 * len(got) and all(got[i] == want[i] for i in plain)

    was, now = (d.collect() for d in seen["packing"])
    assert {r.doc_id for r in now} == {r.doc_id for r in was}
    check_layout(now)


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "word " * 30_000, None, "s", None),
            (3, "same text", "en", None, 9), (3, "same text", "en", None, 9), (4, "same text", "de", "s", 9)]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = df
        for name, stage in cp.STAGES:
            docs, _ = cp.materialize(stage(spark, docs, SF), "test")
        assert (docs.count() > 0) == (df.count() > 0)
        assert docs.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.mark.parametrize("bad", [[], [("t", 1)]])
def test_toxicity_without_both_labels(spark, bad):
    model = toxicity.fit(spark.createDataFrame(bad, "text string, toxic int"))
    assert len(model.entries) == 0
