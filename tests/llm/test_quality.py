"""Quality: recovered accuracies, agreement with labels never seen, odd rows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import quality

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, votes string, score string, kept long"


def test_accuracies_are_recovered_without_labels():
    rnd = random.Random(2)
    wrong_good = [.05, .1, .02, .03, .08, .05, .1, .04]
    patterns, good = Counter(), {}
    for _ in range(30_000):
        kind = rnd.choices(range(5), [.7, .1, .1, .05, .05])[0]
        p = "".join("-" if rnd.random() < .2 else
                    "0" if rnd.random() < (.85 if kind and j in quality.KINDS[kind - 1] else wrong_good[j]) else "1" for j in range(8))
        patterns[p] += 1
        good.setdefault(p, []).append(kind == 0)
    model = quality.estimate_accuracies(patterns)
    assert model.share[0] == pytest.approx(.7, abs=.05)
    assert model.says_bad[0] == pytest.approx(wrong_good, abs=.04)
    assert model.says_bad[1][list(quality.KINDS[0])] == pytest.approx([.85] * 3, abs=.07)
    # as right as the true parameters would be
    true = np.array([wrong_good] + [[.85 if j in kind else w for j, w in enumerate(wrong_good)] for kind in quality.KINDS])
    best = quality.LabelModel(np.array([.7, .1, .1, .05, .05]), true)
    got, most = (np.mean([(m.posterior(p) >= .5) == g for p, gs in good.items() for g in gs]) for m in (model, best))
    assert got > most - .01


def test_scores_agree_with_quality_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > .97 and np.mean(bad) < .15
    ranks = sorted(rows, key=lambda r: r.score)
    n_bad, below, auc = len(bad), 0, 0
    for r in ranks:
        if r.quality == 0:
            below += 1
        else:
            auc += below
    assert auc / (n_bad * len(good)) > .97


def test_votes_by_case():
    assert quality.votes("word " * 100)[:2] == "00"
    assert quality.votes("a | b | c | d | e | f")[2] == "0" and quality.votes("a | b | c | d | e | f")[6] == "0"
    assert quality.votes("ALL CAPITAL LETTERS HERE NOW")[3] == "0"
    assert quality.votes("x y\nx y\nx y\nx y")[4] == "0"
    assert quality.votes("") == "-------0" and quality.votes(" \n") == "-------0"


def test_tokens_do_not_depend_on_neighbours():
    texts = ["a a b", "", "b Ab 12", "漢字 x"]
    together, first = quality.hashed_tokens(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        alone, _ = quality.hashed_tokens(pa.array([t], pa.large_string()))
        assert together[first[i]:first[i + 1]].tolist() == alone.tolist()


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "some words in a row"), (3, "w " * 100_000), (4, "same"), (4, "same"), (5, "😀 漢字")]
    df = spark.createDataFrame([(i, t, "v", "s", 0) for i, t in rows], SCHEMA)
    got = quality.classify(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1][1:] == by[2][1:]
    assert quality.classify(df.limit(0)).collect() == []


def test_sample_is_bounded_in_rows(spark, monkeypatch):
    """Hundreds of texts under one id: the driver sees SAMPLE rows."""
    monkeypatch.setattr(quality, "SAMPLE", 50)
    taken = []
    real = quality.train_scorer
    monkeypatch.setattr(quality, "train_scorer", lambda rows, targets: taken.append((len(rows), len(targets))) or real(rows, targets))
    df = spark.range(400).selectExpr("7L AS doc_id", "concat('text number ', id, ' of one id') AS text")
    assert len(quality.classify(df).collect()) == 400 and taken == [(50, 50)]


def brute_em(patterns, rounds=200):
    """The same mixture, pattern by pattern and labeller by labeller."""
    model = quality.estimate_accuracies({}, rounds=0)
    share, says = model.share.tolist(), model.says_bad.tolist()
    total = sum(patterns.values())

    def posterior(p):
        weight = []
        for c, s in enumerate(share):
            for k, v in enumerate(p):
                s *= says[c][k] if v == quality.BAD else 1 - says[c][k] if v == quality.GOOD else 1
            weight.append(s)
        return [w / sum(weight) for w in weight]
    for _ in range(rounds):
        q = {p: posterior(p) for p in patterns}
        new_share = [(sum(n * q[p][c] for p, n in patterns.items()) + 1) / (total + len(share)) for c in range(len(share))]
        new_says = []
        for c in range(len(share)):
            bad = [sum(n * q[p][c] for p, n in patterns.items() if p[k] == quality.BAD) for k in range(8)]
            told = [sum(n * q[p][c] for p, n in patterns.items() if p[k] != quality.NONE) for k in range(8)]
            new_says.append([(b + 2 * s) / (t + 2) for b, t, s in zip(bad, told, model.says_bad[c], strict=True)])
        change = max(abs(a - b) for x, y in zip([new_share, *new_says], [share, *says], strict=True) for a, b in zip(x, y, strict=True))
        share, says = new_share, new_says
        if change < 1e-7:
            break
    return {p: posterior(p) for p in patterns}


def test_posteriors_match_brute_force():
    rng = np.random.default_rng(11)
    patterns = {}
    for _ in range(3000):
        bad = rng.random() < 0.3
        p = "".join("-" if rng.random() < 0.3 else quality.BAD if rng.random() < (0.7 if bad else 0.1) else quality.GOOD for _ in range(8))
        patterns[p] = patterns.get(p, 0) + 1
    model, want = quality.estimate_accuracies(patterns), brute_em(patterns)
    for p in patterns:
        assert model.posterior(p) == pytest.approx(want[p][0], abs=1e-4)
