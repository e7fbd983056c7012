import html
import re

import pytest
from pyspark.sql import functions as F

from tallyhour.llm import html_consensus as hc
from tallyhour.llm.entry_queries import op11_html_consensus

P1 = "The council met on Tuesday evening, and after a long debate it agreed to rebuild the old bridge."
P2 = "Work starts in spring; the road stays open for bicycles, and buses take the northern route instead."
P3 = "Costs are shared by both towns, which had argued about the plan, its price and its use for years."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


ARTICLE = f"<h1>Bridge</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p>"
WANT = f"Bridge\n{P1}\n{P2}\n{P3}"
CHROME = ('<header><div>Daily News</div></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li></ul></nav>'
          '<div class="cookie-notice"><p>We use cookies, as all pages do, to know you better and better.</p></div>')
COMMENTS = ('<section id="comments"><h3>Comments</h3><article class="comment"><p>I like bridges, all of them, and I wrote this long '
            'remark to say so, at length, again and again, until nobody reads it any more.</p></article></section>')


def reference(source):
    """The given table's pages: blocks of the article element, cut at its paragraph tags."""
    inner = re.search(r"<article>(.*)</article>", source, re.S).group(1)
    out = []
    for block in re.split(r"</?(?:p|h1)>", inner):
        text = " ".join(html.unescape(re.sub(r"<(?:b|br)>", lambda m: " " if m.group() == "<br>" else "", block)).split())
        if text:
            out.append(text)
    return "\n".join(out)


def test_query_equals_reference_on_the_table(spark, sf_small):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    rows = op11_html_consensus(spark, sf_small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == reference(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])
        assert r["by_host"] and r["path"] == "html/body/article"


@pytest.mark.parametrize("body", [
    CHROME + f"<article>{ARTICLE}</article>" + COMMENTS + "<footer>(c)</footer>",
    CHROME + f'<div class="layout has-sidebar"><main><div class="post">{ARTICLE}</div></main>'
             f'<div class="sidebar"><p>{P3} {P2}</p></div></div>' + COMMENTS,
    CHROME + f'<div id="wrap"><div class="col-8">{ARTICLE}</div><div class="col-4"><ul><li><a href="x">{P1}</a></li></ul></div></div>',
    CHROME + f'<div class="story">{ARTICLE}<div class="ad">Buy now, cheap, cheap!</div><form><p>Sign up here</p></form>'
             f'<div class="share-buttons">Share</div></div>' + COMMENTS,
    CHROME + f"<article><header><h1>Bridge</h1></header><section><p>{P1}</section><section><p>{P2}<p>{P3}</section>"
             "<footer>By A. Writer</footer></article>",
    f"<table><tr><td class=side><a href=1>one</a> <a href=2>two</a></td><td class=text>{ARTICLE}</td></tr></table>",
    CHROME + f"<DIV CLASS='story'>{ARTICLE.replace('</p>', '').upper().replace(P1.upper(), P1).replace(P2.upper(), P2).replace(P3.upper(), P3).replace('BRIDGE', 'Bridge')}</DIV>",
])
def test_layouts(body):
    assert hc.main_text(page(body), None)[0] == WANT
    assert hc.main_text(page(body), max(hc.votes_of(page(body)).items(), key=lambda x: x[1])[0])[0] == WANT


def test_parsing():
    text = lambda body: hc.main_text(body, None)[0]
    assert text("<p>a &amp; b&nbsp;c &lt;p&gt; &#65;&eacute;&copy</p>") == "a & b c <p> Aé©"
    assert text("<p>one<br>two<br/>three</p>") == "one two three"
    assert text("<p>x<script>var t = '</p><p>no</p>';</script>y</p>") == "xy"
    assert text("<p title='a > b' class=\"c\">in <b>bold <i>both</b> out</i></p>") == "in bold both out"
    assert text("<p>1 < 2 and 3 > 2</p><!-- <p>no</p> --><p>end") == "1 < 2 and 3 > 2\nend"
    assert text("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == "a\nb\nc\nd"
    assert text("<table><tr><td>a<td>b<tr><td>c</table>") == "a\nb\nc"
    assert text("<div>loose<p>par</p>tail</div>") == "loose\npar\ntail"
    assert text("a</p>b</div></b>c") == "a\nbc"
    assert text("<p>seen</p><!-- never closed <p>lost</p>") == "seen"
    assert text("<p>seen</p><style>p{}") == "seen" and text("<p>seen</p><a href='x") == "seen"
    assert text("<p>half <a b=\"c>d</a> e</p>") != "" and text("just text") == "just text"
    assert text("<div hidden><p>no</p></div><p style='display: none'>no</p><p>yes</p>") == "yes"
    assert text("<div class='notice'><p>only this</p></div>") == "only this"
    assert text("<svg/><p>a</p><svg><path d='x'/><text>no</text></svg><p>b</p>") == "a\nb"
    assert text("<p>a<span class='ad-label'>no</span> b <button>no</button>c") == "a b c"
    assert text("<![CDATA[raw]]>") == "raw" and text("<p></p> <div></div>") == "" and text("") == ""


def test_pathological_pages_end():
    deep = "<div>" * 20000 + "<p>deep</p>"
    assert hc.main_text(deep, None)[0] == "deep" and max(map(len, hc.votes_of(deep))) < 400
    assert hc.main_text("<div><a \"" * 20000 + "<p>x</p>", None)[0] is not None
    assert hc.main_text("</b>" * 50000 + "<b>" * 50000 + "</i>" * 50000 + "z", None)[0] == "z"
    assert hc.main_text("<p>" + "word " * 300000, None)[0] == ("word " * 300000).strip()


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, host string")


def test_hosts_agree_on_a_path(spark):
    """Pages whose own best container is another one follow their host; other hosts are left alone."""
    common = [(i, f"https://News.example.com:443/{i}", page(CHROME + f'<div class="c{i} body">{ARTICLE}</div><div class="more">{P1[:40]}</div>'))
              for i in range(8)]
    odd = (90, "http://news.example.com/odd", page(
        f'<div class="c9 body"><h1>Bridge</h1><p>{P1}</p><p>{P2}</p></div><div class="more"><p>{P3[:60]}</p></div>'))
    alone = (91, "http://other.example.com/odd", odd[2])
    no_host = [(92, None, odd[2]), (93, "not a url", odd[2])]
    out = {r["page_id"]: r for r in hc.extract(rows_of(spark, [*common, odd, alone, *no_host])).collect()}
    for i in range(8):
        assert out[i]["text"] == WANT and out[i]["by_host"] and out[i]["path"] == "html/body/div.body.c#"
    assert out[90]["by_host"] and out[90]["text"] == f"Bridge\n{P1}\n{P2}"
    assert not out[92]["by_host"] and not out[93]["by_host"] and out[92]["text"] == out[93]["text"] == out[91]["text"]
    paths = {r["host"]: r for r in hc.host_paths(rows_of(spark, [*common, odd, alone])).collect()}
    assert set(paths) == {"news.example.com", "other.example.com"} and paths["news.example.com"]["pages"] == 9


def test_page_without_the_host_path_is_cut_at_its_own(spark):
    common = [(i, "http://a.example.com/x", page(f"<article>{ARTICLE}</article>")) for i in range(5)]
    other = (9, "http://a.example.com/y", page(f'<div class="video"><h1>Bridge</h1><p>{P1}</p></div>'))
    out = {r["page_id"]: r for r in hc.extract(rows_of(spark, [*common, other])).collect()}
    assert out[9]["text"] == f"Bridge\n{P1}" and not out[9]["by_host"] and out[0]["by_host"]


def test_shuffled_paths_give_the_same(spark, sf_small, monkeypatch):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    monkeypatch.setattr(hc, "HOT_ONE_IN", 20)
    want = sorted(map(tuple, hc.extract(pages).collect()))
    assert sorted(map(tuple, hc.extract(pages, broadcast_bytes=0).collect())) == want


def test_edge_rows(spark):
    rows = [(1, "http://h.example.com", None), (2, "http://h.example.com", ""), (None, None, None), (3, "", "<p>x</p>"), (3, "", "<p>x</p>"),
            (4, "http://[::1]:80/x", "<p>y</p>")]
    out = sorted((tuple(r) for r in hc.extract(rows_of(spark, rows)).select("page_id", "url", "text", "n_chars").collect()), key=repr)
    assert out == sorted([(1, rows[0][1], "", 0), (2, rows[1][1], "", 0), (None, None, "", 0), (3, "", "x", 1), (3, "", "x", 1),
                          (4, rows[5][1], "y", 1)], key=repr)
    assert hc.extract(rows_of(spark, [])).count() == 0
    hosts = spark.createDataFrame([("HTTP://User:p@Www.Example.com:8080/a",), ("//x.org?q",), ("http://[::1]:80/",), ("mailto:a@b",), (None,)], "u string")
    assert [r[0] for r in hosts.select(hc.host_of(F.col("u"))).collect()] == ["www.example.com", "x.org", "[::1]", None, None]
