"""URL filter: hosts, paths and rules against plain Python, models against a
brute-force Witten-Bell, odd rows."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import url_filter as uf

SF = "/root/testdata/sf0.1"
SCHEMA = "page_id long, url string, host string, salt string, score long"


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    rule = None
    for r in sorted((r for r, _ in uf.RULES), key=len):
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            rule = r
    return host, path, rule


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = uf.judge(pages)
    got = {r.page_id: r for r in out.collect()}
    verdict = dict(uf.RULES)
    named = re.compile(r"(^|[.-])(" + "|".join(uf.REJECT_WORDS) + r")([.-]|$)")
    wrong, judged = 0, 0
    for r in pages.collect():
        host, path, rule = plain(r.url)
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule)
        if rule:
            assert g.verdict == verdict[rule]
        else:
            judged += 1
            wrong += g.verdict != ("block" if named.search(host) else "allow")
    assert judged > 500 and wrong <= 0.02 * judged
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_odd_rows(spark):
    urls = [None, "", "no scheme/path", "http://", "HTTP://A.NET", "x://Éa.ORG/fr/x?y", "a://b://c.net/en/", "http://example.net?q/en/",
            "http://example.net/en/", "http://notexample.net/en/1", "http://fr.org/fr/", "http://x.example.com/de/#a", "http://h/" + "p/" * 20_000,
            "http://same.com/a", "http://same.com/a"]
    rows = [(i if i != 3 else None, u, "h", "s", 1) for i, u in enumerate(urls)] + [(13, "http://same.com/a", None, None, None)]
    out = uf.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    want = {r[0]: plain(r[1]) for r in rows}
    assert all((r.host, r.path, r.rule) == want[r.page_id] for r in out)
    assert all(r.verdict in ("allow", "block") for r in out)
    assert uf.judge(spark.createDataFrame([], SCHEMA)).collect() == []


def brute_ratio(texts):
    """Witten-Bell by the definition, all orders, per window."""
    cuts = Counter()
    for text, a, r in texts:
        p = "^" * (uf.ORDER - 1) + text + "$"
        for i in range(len(text) + 1):
            for side, k in (("a", a), ("r", r)):
                cuts[(side, p[i:i + uf.ORDER])] += k
    windows = {w for _, w in cuts}
    kinds = len({w[-1] for w in windows})

    def prob(side, w):
        p = 1 / kinds
        for m in range(1, uf.ORDER + 1):
            g, head = w[-m:], w[len(w) - m:-1]
            same = Counter()
            for (s, x), k in cuts.items():
                if s == side and (m == 1 or x[-m:-1] == head):
                    same[x[-1]] += k
            total, follow = sum(same.values()), sum(1 for v in same.values() if v)
            p = p if total == 0 else (same[g[-1]] + follow * p) / (total + follow)
        return p
    return {w: math.log(prob("a", w)) - math.log(prob("r", w)) for w in windows}


def test_models_match_brute_force(spark):
    texts = [("good.com/a", 3, 0), ("bad-x.com/b", 0, 2), ("go.org/aa", 1, 0), ("bad.net", 0, 1), ("mixed", 1, 1)]
    rows = []
    for t, a, r in texts:
        p = "^" * (uf.ORDER - 1) + t + "$"
        rows += [(p[i:i + uf.ORDER], a, r) for i in range(len(t) + 1)]
    df = spark.createDataFrame(rows, "window string, a long, r long").groupBy("window").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    got = {r.window: r.ratio for r in uf._counted(df).collect()}
    want = brute_ratio(texts)
    assert got.keys() == want.keys()
    assert all(got[w] == pytest.approx(want[w], abs=1e-9) for w in want)


@pytest.mark.parametrize("spam", [f"http://{w}.{d}.com/" for w in ("casino", "porn", "pills", "spam") for d in ("lucky", "best", "q7")][::3])
def test_one_rejected_text_is_enough(spark, spam):
    """A third of the rows is one host whose paths differ in digits only."""
    urls = [f"http://news{i % 7}.{n}.org/{n}/page/{i}" for i in range(20) for n in ("daily", "garden", "music", "school", "travel")]
    rows = [(i, u, "", "", 0) for i, u in enumerate([*urls, *[f"{spam}{i}" for i in range(50)]])]
    got = {r.page_id: r.verdict for r in uf.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {got[i] for i in range(len(urls), len(rows))} == {"block"}
    assert sum(got[i] != "allow" for i in range(len(urls))) <= 0.03 * len(urls)
