"""Main text of pages: whole-table check, hand-written pages, cuts by brute force."""

import random
import re
from html import unescape
from itertools import product

import pytest

from quarry.llm import html_text as ht

SF = "/root/testdata/sf0.001"
LONG = "This is a paragraph of the article that says one thing at some length, and then another. "


def table_text(html):
    """The article of the given tables' template, by patterns of that template."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    lines = [" ".join(unescape(re.sub(r"<br>|</?b>", " ", s)).split()) for s in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(s for s in lines if s)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: (r.url, table_text(r.html)) for r in pages.collect()}
    got = ht.extract(pages).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(want)


def test_energy_of_the_cut_is_least():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 9)
        scores = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 6)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def energy(keep):
            lost = sum(s for s, k in zip(scores, keep, strict=True) if s > 0 and not k)
            lost -= sum(s for s, k in zip(scores, keep, strict=True) if s < 0 and k)
            return lost + sum(c for a, b, c in edges if keep[a] != keep[b])
        cut = ht.minimum_cut(scores, edges)
        best = min(energy(k) for k in product([False, True], repeat=n))
        assert energy(cut) == best
        smallest = [k for k in product([False, True], repeat=n) if energy(k) == best]
        assert all(not c or all(k[i] for k in smallest) for i, c in enumerate(cut))  # the cut nearest the source


def test_a_cut_over_a_long_chain():
    n = 20_000
    scores = [5 if k % 7 else -8 for k in range(n)]
    assert all(ht.minimum_cut(scores, [(k, k + 1, 100) for k in range(n - 1)]))


def page(body, head="<title>T &amp; U</title>"):
    return f"<!DOCTYPE html><html><head>{head}<style>p{{x:'<p>'}}</style></head><body class='has-cookie-notice'>{body}</body></html>"


P = [f"{k} {LONG * 2}".strip() for k in range(4)]
PARAS = "".join(f"<p>{p}</p>" for p in P)

CASES = {
    "semantic": (page(f"<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><main><article><h1>Head</h1>{PARAS}"
                      f"<aside>{LONG}</aside></article></main><aside><p>{LONG * 3}</p></aside><footer><p>{LONG}</p></footer>"),
                 ["Head", *P]),
    "named divs": (page(f"<div id='top-menu'><a href=/a>A</a> | <a href=/b>B</a></div><div class='post-content'>{PARAS}</div>"
                        f"<div class='comments'><article><p>{LONG * 4}</p></article></div><div class='sidebar'><p>{LONG}</p></div>"
                        f"<div role=contentinfo>{LONG}</div>"), P),
    "no landmarks": (page("<div><a href=/a>One</a> <a href=/b>Two</a> <a href=/c>Three</a></div>"
                          f"<div>{''.join(f'<div>{p}</div>' for p in P)}</div><div><a href=/x>Next</a></div>"), P),
    "header in article": (page(f"<article><header><h1>Title</h1></header>{PARAS}<footer>By somebody</footer></article>"), ["Title", *P]),
    "forms and buttons": (page(f"<article><form><label>Name</label><input name=a><select><option>x<option>y</select></form>{PARAS}"
                               f"<p>{P[0]} <button>Share</button></p></article><form><p>{LONG}</p></form>"), [*P, P[0]]),
    "never closed": (page(f"<article><p><b>{P[0]}<br><p>{P[1]}<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>"),
                     [P[0], P[1], "one", "two", "a", "b", "c"]),
    "scripts": (page(f"<script>var a='<article>';</script><!-- <p>no</p> --><article>{PARAS}<script>if (a<b) x('</p>')</SCRIPT ><noscript>"
                     "<p>no</p></noscript><svg><text>no</text></svg></article><script>open"), P),
    "references": (page(f"<article><p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#x41; &copy  x&nbsp;y\n\t z {P[0]}</p><p>{P[1]}</p></article>"),
                   [f"a <b> &amp; éé" + f"A © x y z {P[0]}", P[1]]),
    "inline": (page(f"<article><p>{P[0]} <em>in</em>side <a href='x>y'>li<b>n</b>k</a>, and\n  more.</p>{P[1]}</article>"),
               [f"{P[0]} inside link, and more.", P[1]]),
    "quotes": (page(f"""<article title="a > b" data-x='<p>' lang=en><p class="x>{P[0]}</p>"><i title='"'>{P[1]}</i></p><p a=">{P[2]}</article>"""),
               [P[1], P[2]]),   # a quote that never ends is no quote
    "comment section": (page(f"<article>{PARAS}<section id=reader-comments><p>{LONG * 5}</p><p>{LONG}</p></section></article>"), P),
    "notice": (page(f"<div class='cookie-banner'><p>{LONG * 2}</p></div><article>{PARAS}</article><div class=adBox><p>{LONG * 2}</p></div>"), P),
    "stray ends": (page(f"</div></p></article><article></span>{PARAS}</section></article></article>"), P),
    "plain text": (LONG * 3, [(LONG * 3).strip()]),
    "less than": (page(f"<article><p>a < b and b > c <3 {P[0]}</p><p>{P[1]}</article>"), [f"a < b and b > c <3 {P[0]}", P[1]]),
    "only frames": (page(f"<nav>{LONG}</nav><footer>{LONG}</footer>"), []),
    "cut short": (f"<html><body><article><p>{P[0]}</p><p>{P[1]} <a href=\"x", P[:2]),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    html, want = CASES[name]
    assert ht.main_text(html).split("\n") == ([" ".join(w.split()) for w in want] or [""])


def test_odd_rows_and_columns(spark):
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", CASES["semantic"][0], 3), (1, "u", CASES["semantic"][0], 3),
            (2, None, "<div>" * 20_000 + LONG * 4, 4), (3, "v", f"<article>{'<p>' + LONG} " * 8_000, 5), (4, "w", "<", 6),
            (5, "x", "<!--", 7), (6, "y", "<p a=\"" * 20_000, 8), (7, "z", "\x00 &#0; &#xD800;", 9)]
    schema = "page_id long, url string, html string, text int"
    df = spark.createDataFrame(rows, schema)
    out = ht.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert sorted(r.text for r in got if r.page_id == 1) == sorted(["", *["\n".join(["Head", *(" ".join(p.split()) for p in P)])] * 2])
    assert next(r for r in got if r.page_id == 3).text.count("\n") == 7_999
    assert [r.text for r in got if r.page_id is None] == [""]
    assert ht.extract(spark.createDataFrame([], schema)).collect() == []


def test_sample_is_bounded_under_one_hash(spark, monkeypatch):
    monkeypatch.setattr(ht, "SAMPLE_PAGES", 20)
    df = spark.range(500).selectExpr("1L AS page_id", "'u' AS url", "concat('<article><p>text ', id, '</article><nav>x</nav>') AS html")
    taken = []
    monkeypatch.setattr(ht, "logistic", lambda x, y: taken.append(len(x)) or ht.UNTRAINED)
    ht.fit(df)
    assert taken == [20 * 2 * 2]


def test_learned_weights_keep_landmarks_first(spark):
    w = ht.fit(spark.read.parquet(f"{SF}/pages.parquet"))
    for name in ("semantic", "named divs", "no landmarks", "notice", "comment section"):
        html, want = CASES[name]
        assert ht.main_text(html, w).split("\n") == [" ".join(x.split()) for x in want]
