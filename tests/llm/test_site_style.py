import html
import math
import random
import re
import time

import pytest

from herdflow.llm.markup import Page
from herdflow.llm.queries import op5_main_text
from herdflow.llm.site_style import main_text


def article(page):
    """The given pages' article, by plain patterns: headings and paragraphs in order."""
    inner = re.search(r"<article>(.*)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    texts = (" ".join(html.unescape(re.sub(r"<br>", " ", x).replace("<b>", "").replace("</b>", "")).split()) for x in parts)
    return "\n\n".join(t for t in texts if t)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()}
    rows = op5_main_text(spark, f"/root/testdata/{sf}").collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html), r.page_id
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def text(page):
    return [t for _, _, t in Page(page).blocks]


CASES = [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p><b>a<br>b<p>c</p>", ["a b", "c"]),
    ("<div>x <span>y</span>z</div>w", ["x yz", "w"]), ("a &lt;b&gt; &amp;amp; &#233; &nbsp; &eacute;", ["a <b> &amp; é é"]),
    ("<ul><li>1<li>2</ul><p>3", ["1", "2", "3"]), ("<script>var t='</p>';<p>no</script><p>yes", ["yes"]),
    ("<style>p{}</style><!-- <p>no</p> --><p>yes<!-- open <p>no", ["yes"]),
    ("<a title='x > y'>link</a> 1 < 2 <b", ["link 1 < 2 <b"]), ("<P CLASS=Ad>no</P><p>yes</p>", ["yes"]),
    ("<div class='left-sidebar'><p>no</p></div><p>yes", ["yes"]), ("<div id=comments><div>no</div></div>yes", ["yes"]),
    ("<header>no</header><article><header><h1>T</h1></header><p>x</article><footer>no", ["T", "x"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("<p>a</div></p>b</b></i>", ["a", "b"]),
    ("<form><input><label>no</label></form><div>\n\t two \n words\r\n</div>", ["two words"]),
    ("<p>shade of a road, adding</p><div class='shade road'>ok</div>", ["shade of a road, adding", "ok"]),
    ("<a \"unclosed>x</a> y", ["x y"]),
    ("<body class='single has-sidebar'><article><p>x</p></article><aside>no</aside>", ["x"]),
    ("<body><form id=aspnetForm><nav>no</nav><article><p>x</p><form>no</form></article></form>", ["x"]),
    ("<article class='post comments-open'><p>x</p><section id=comments><article class=comment>no</article></section></article>", ["x"]),
    ("<div class='sidebar page'><article class=comment><p>x</p></article></div><div class=menu>no</div>", ["x"]),
    ("<main><p>x</p><section class=comments><article>no</article></section></main>", ["x"]),
    ("<main><form><article>x</article></form></main>", ["x"]),
    ("<div class=widget-page><p>all there is</p><nav>no</nav></div>", ["all there is"]),
    ("<article>x<span class=share-buttons>no</span>y</article>", ["xy"]),
    ("<script>a<b</SCRIPT >x<style>never closed <p>no", ["x"]),
    ("<p title='a>b' class=x>one</p><p title=\"never closed>two</p><p title='c>d'>three</p>", ["one", "two", "d'>three"]),
]


@pytest.mark.parametrize(("page", "blocks"), CASES)
def test_blocks(page, blocks):
    assert text(page) == blocks


def test_repeated_branches_are_cut(spark):
    """Branches without telling names go by their spread over the host's pages."""
    def page(i, body):
        return (i, f"http://a.example/{i}", f"<html><body><div class=x1>Welcome to our site</div><div class=x2><p>{body}</p>"
                   f"<p>tail of {i}</p></div><div class=x3><p>All rights {i % 3}</p></div></body></html>", "n")
    rows = [page(i, f"story {i} told once" if i % 4 else "a story told again") for i in range(60)]
    rows += [(100 + i, "http://b.example/", "<article><p>same article everywhere</p></article>", "n") for i in range(5)]
    rows += [(200, None, "<p>no host</p>", "n"), (201, "http://c.example/", None, "n"), (202, "", "", "n"), (None, "u", "<p>x", "n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in main_text(df).collect()}
    assert len(got) == len(rows)
    for i in range(60):
        assert got[i] == (f"story {i} told once" if i % 4 else "a story told again") + f"\n\ntail of {i}"
    assert all(got[100 + i] == "same article everywhere" for i in range(5))
    assert (got[200], got[201], got[202], got[None]) == ("no host", "", "", "x")
    assert main_text(df.limit(0)).collect() == []


def test_copies_keep_their_text(spark):
    """Copies count as one page, on one host or on several, with and without an article element."""
    def pages(name, n, inside, hosts=1):
        body = f"<p>the long story of {name}</p><p>and its end</p>"
        body = f"<article>{body}</article>" if inside else f"<div class={name}>{body}</div>"
        return [(f"http://{name}{i % hosts}.example/{i}", f"<!-- {i} --><body><nav>menu {i % 3}</nav>{body}</body>", name) for i in range(n)]
    copies = [p for n in (2, 8, 1000) for inside in (True, False) for p in pages(f"{'in' if inside else 'out'}{n}", n, inside)]
    copies += pages("spread", 8, False, hosts=8) + pages("twice", 9, True, hosts=3)
    other = [(f"http://o.example/{i}", f"<body><div class=x1>Welcome</div><div class=x2><p>news {i}</p></div></body>", None) for i in range(60)]
    for rows in (copies, copies + other, pages("out", 8, False), pages("in", 2, True)):
        rows = [(i, *r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
        got = {r.page_id: r.text for r in main_text(df).collect()}
        for i, url, _, name in rows:
            assert got[i] == (f"the long story of {name}\n\nand its end" if name else f"news {url.rpartition('/')[2]}"), url


@pytest.mark.parametrize("part", ["<a ", "<a \">", "<a '>", "<b>", "<x>", "</b>", "<b></i>", "<p><b>", "<div class=a>", "<li><b>", "<!-", "<", "<i><b></i>",
                                  "<form>", "<article>", "<form><article>", "<td></td>", "<div class=menu><article>"])
def test_broken_markup_takes_linear_time(part):
    """A megabyte of one broken or nested thing; ten times the page takes about ten times as long."""
    def took(n):
        t = time.process_time()
        Page(part * (n // len(part)) + "<p>end")
        return time.process_time() - t
    took(1000)
    small, large = took(100_000), took(1_000_000)
    assert large < 30 * max(small, 0.02)
    assert Page(part * 1000 + "</" + "<p>end").blocks is not None


def plain_importance(pages):
    """The importance of every content path of one host's distinct pages, by the formulas, a path at a time."""
    seen = {tuple(sorted((p, t) for p, _, t in x.blocks) + sorted(x.containers)): x for x in pages}.values()
    m = len(seen)
    out = {}
    for path in {p for x in seen for p, _, _ in x.blocks}:
        texts = [{t for p, _, t in x.blocks if p == path} for x in seen]
        spread = [sum(t in of for of in texts) for t in set().union(*texts)]
        content = sum(1 - min(1, math.log(n) / math.log(max(2, m))) for n in spread) / len(spread)
        parent = next(x.parents[path] for x in seen if path in x.parents)
        kinds = [{k for p, k in x.containers if p == parent} for x in seen]
        each = [sum(k in of for of in kinds) for k in set().union(*kinds)]
        shown = -sum(n / sum(each) * math.log(n / sum(each)) for n in each) / math.log(max(2, m)) if each else 0
        out[path] = 0.9 * content + 0.1 * min(1, max(0, shown))
    return out


def test_importance_and_cuts_by_a_plain_version(spark):
    """Blocks outside articles stay exactly where the plain importance of their path reaches one half."""
    rng = random.Random(3)
    def page(i):
        parts = [f"<div class=c{j}><p>{rng.choice(['always', 'often', f'text {i}', f'text {i}', f'group {i % j if j else 0}'])}</p>"
                 + "<ul><li>x</ul>" * (rng.random() < 0.5) + "</div>" for j in range(7)]
        return "<body>" + "".join(parts) + "</body>"
    html_of = [page(i) for i in range(40)]
    read = [Page(h) for h in html_of]
    value = plain_importance(read)
    df = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(html_of)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(df).collect()}
    assert 0 < sum(v < 0.5 for v in value.values()) < len(value)
    for i, x in enumerate(read):
        assert got[i] == "\n\n".join(t for p, _, t in x.blocks if value[p] >= 0.5)
