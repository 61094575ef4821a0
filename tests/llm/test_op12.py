import random

import pytest
from pyspark.sql import types as T

from quire.llm import op12_html_extraction as op

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                       T.StructField("a.b", T.StringType()), T.StructField("host", T.StringType())])
WORDS = "stone river light under quiet market seven green window paper cold morning bridge letter".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(n)) + "."


def semantic(rnd, k):
    """A page with every kind of thing beside the article, and its text."""
    title, paras = prose(rnd, 4), [prose(rnd, rnd.randrange(5, 40)) for _ in range(rnd.randrange(1, 6))]
    body = "".join(f"<p>{p.replace('.', ' &amp; x.')}</p>" if k % 3 else f"<p><b>{p.replace('.', ' &amp; x.')}<br>" for p in paras)
    html = (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<header><h2>Site {k % 2}</h2></header><nav><ul>{''.join(f'<li><a href=/{i}>{prose(rnd, 1)}</a></li>' for i in range(k % 5))}"
            f"</ul></nav><!-- ad {k} --><div class=\"ad\">{prose(rnd, 6)}</div><div class='cookie-notice'>We use cookies {k}</div>"
            f"<article><h1>{title}</h1>{body}<div class=ad>{prose(rnd, 3)}</div><form><input name=q><button>Send {k}</button></form></article>"
            f"<section id=\"comments\"><p>{prose(rnd, 9)}</p></section><aside>{prose(rnd, 5)}</aside>"
            f"<footer>&copy; {prose(rnd, 3)}</footer></body></html>")
    return html, " ".join([title, *[p.replace(".", " & x.") for p in paras]])


def plain(rnd, k):
    """A page of a template without telling names: its fixed texts, known from
    the other pages only, go."""
    paras = [prose(rnd, 12) for _ in range(3)]
    html = (f"<html><body><div>Welcome to our site</div><table><tr><td><a href=/a>{prose(rnd, 1)}</a></td></tr></table>"
            f"<div id=x>{''.join(f'<p>{p}</p>' for p in paras)}</div><div>All rights kept by us</div></body></html>")
    return html, " ".join(paras)


@pytest.fixture(scope="module")
def pages():
    rnd, rows = random.Random(5), []
    for k in range(90):
        html, text = semantic(rnd, k)
        rows.append((k, f"http://big.example.org/{k}", html, text))
    for k in range(90, 102):
        html, text = plain(rnd, k)
        rows.append((k, f"https://Plain.example.org/p?{k}", html, text))
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)
    out = op.extract_text(df, **more)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    return out.collect()


def test_main_text(spark, pages):
    got = {r["page_id"]: r for r in run(spark, [p[:3] for p in pages])}
    for i, u, _, text in pages:
        assert got[i]["text"] == text and got[i]["url"] == u and got[i]["n_chars"] == len(text)


def test_the_template_tells_fixed_texts(pages):
    """Alone, a page of the nameless template keeps its fixed texts; they go
    as tokens of the equivalence class that its cohort shares."""
    own = [op.Page(h) for i, _, h, _ in pages if i >= 90]
    deduced = op.template(own)
    assert {k[0] for k in deduced} >= {"", "table", "td"}
    assert op.main_text(own[0], op.template(own[:1]), False).startswith("Welcome to our site")
    assert op.main_text(own[0], deduced, False) == pages[90][3]


def test_classes_out_of_order_or_gap_are_no_template():
    pages = [op.Page(f"<i>{k}</i><b>one</b><u>two</u>" if k % 2 else f"<i>{k}</i><u>two</u><b>one</b>") for k in range(6)]
    keys = [k for k in op.template(pages) if k[0] in ("b", "u")]
    assert len(keys) < 2


def test_edges(spark, pages):
    html = pages[0][2]
    cut = html[:html.index("</p>") - 5] + "&am"
    rows = [(1, None, None), (2, "no host", ""), (None, "http://a.b/", "<p>x&nbsp;&#65;&lt;y</p> z <"), (4, "http://a.b/", "plain text"),
            (5, "http://c.d/", cut), (5, "http://c.d/", html), (5, "http://c.d/", html), (6, "http://e.f/", "<script>x<p>never</p>"),
            (7, "http://g.h/", "<article>" + "<p>word  \n word</p>" * 50_000 + "</article>"), (8, "http://i.j/", "<p>a<!-- open <p>b</p>")]
    got = run(spark, rows)
    assert len(got) == len(rows)
    text = {}
    for r in got:
        assert r["n_chars"] == len(r["text"])
        text.setdefault(r["page_id"], []).append(r["text"])
    assert text[1] == text[2] == text[6] == [""] and text[4] == ["plain text"] and text[8] == ["a"]
    assert text[None] == ["x A<y z <"] and text[7] == [" ".join(["word word"] * 50_000)]
    assert sorted(map(len, text[5]))[1:] == [len(pages[0][3])] * 2 and text[5].count(pages[0][3]) == 2
    assert run(spark, []) == []


def test_copies_and_cohorts(spark, pages):
    """A page that a host has a thousand times keeps its text, however the
    cohorts fall."""
    rows = [(k, f"http://same.example.org/{k}", pages[0][2]) for k in range(300)] + [p[:3] for p in pages[:40]]
    for r in run(spark, rows, cohort=16):
        want = pages[0][3] if "same" in r["url"] else pages[r["page_id"]][3]
        assert r["text"] == want


def test_whole_table(spark):
    """Against a plain reading of the table's one article tag."""
    import html
    import re
    sf = "/root/testdata/sf0.01"
    raw = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op.query(spark, sf).collect()
    assert len(got) == len(raw)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", raw[r["page_id"]], re.S).group(1)
        blocks = re.sub(r"<[^>]*(>|\Z)", "", re.sub(r"</?(?:p|h1|br)>", "\0", inner)).split("\0")
        assert r["text"] == " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
