"""Main text of pages against pages whose text is known."""

from __future__ import annotations

import html
import re

from tillflow.llm import html_templates


def page(k, host="a.example", share="", tail="</body></html>"):
    text = [f"Title {k}", f"First  paragraph {k} &amp; more\n text.", f"Second <i>one</i> of {k}."]
    body = (
        f"<html><head><title>no</title><style>p{{}}</style></head><body><header>Top</header>"
        f"<nav><ul><li><a href='/x'>Menu {k}</a></ul></nav><!-- no --><div class='ad box'>Buy {k}</div>"
        f"<article><h1>{text[0]}</h1><p><b>{text[1]}<p>{text[2]}<br>{share}"
        f"<section id='comments'><p>Reader {k}</p></section></article>"
        f"<aside>Side</aside><form>Send {k}<input></form><div class='cookie-notice'>OK?</div>"
        f"<footer>&copy; {k}</footer><script>var t='</p>';</script>{tail}"
    )
    plain = [" ".join(html.unescape(re.sub("<[^>]*>", "", t)).split()) for t in text]
    return (k, f"https://{host}/p{k}", body), "\n".join(plain)


def ours(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: (r.text, r.n_chars) for r in html_templates.extracted(df).collect()}


def test_known_text(spark):
    made = [page(k) for k in range(8)] + [page(k, "b.example", tail="") for k in range(8, 10)]
    got = ours(spark, [row for row, _ in made])
    assert got == {row[0]: (text, len(text)) for row, text in made}


def test_fixed_text_in_articles_goes(spark):
    made = [page(k, share="<div>Share this article</div>") for k in range(8)]
    got = ours(spark, [row for row, _ in made])
    assert got == {row[0]: (text, len(text)) for row, text in made}


def test_copies_of_one_article_stay(spark):
    (row, text) = page(1)
    got = ours(spark, [(k, *row[1:]) for k in range(9)])
    assert set(got.values()) == {(text, len(text))}


def test_pages_without_an_article_element(spark):
    rows = [
        (k, "http://c.example/", f"<body><div class=menu><a href=/>Home</a></div><div><p>Long text {k} of it.<p>More {k}.</div>")
        for k in range(7)
    ]
    assert ours(spark, rows)[3][0] == "Long text 3 of it.\nMore 3."


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no url", "just text &lt;b&gt; &amp &#233;"), (3, "no url", "a < b"),
            (None, "http://x/", "<p>unclosed <a href='x"), (5, "http://x/", "<article></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in html_templates.extracted(df).collect()), key=repr)
    assert [r[2] for r in got] == ["", "", "a < b", "just text <b> & é", "", "unclosed"]


def test_pages_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    got = ours(spark, rows)
    for page_id, _, source in rows:
        inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("<p>|</p>|</h1>", inner)]
        assert got[page_id][0] == "\n".join(x for x in parts if x)


def test_all_slots_without_an_article_element(spark):
    """Heading, intro and body in divs of their own, long class lists, a neighbour that is no article."""
    long = " ".join(f"utility-class-{x:03d}" for x in range(12))
    rows = [
        (k, "http://d.example/", f"<body><div class='{long}'><div class='{long}'><div class='{long}'><div>Fixed line of the site that is longer than the rest</div>"
         f"<div class=lead><h1>Title {k}</h1></div><div class=text>Intro {k}<section><p>Long text {k} of it, more than others.</p>"
         f"<p><a href=/>Linked {k}</a></p></section></div><div class=sidebar>Side {k}</div></div></div></div>")
        for k in range(7)
    ]
    want = "Title 3\nIntro 3\nLong text 3 of it, more than others.\nLinked 3"
    assert ours(spark, rows)[3][0] == want


def test_deep_paths_differ():
    deep = "<div class='" + "c" * 200 + "'>"
    blocks = html_templates.read(f"{deep * 4}<p>one</p><h2>two</h2><div><p>three</p></div>").blocks
    assert len({b.path for b in blocks}) == 3


def visible(source):
    return [b.text for b in html_templates.read(source).blocks if not b.away]


def test_hidden_elements_without_an_end_tag():
    rest = "<article><p>One</p><p>Two</p></article><footer><svg><text>no</text></svg><button>B</button></footer>"
    for start in ("<svg/>", "<svg class='i' />", "<svg>", "<div><svg></div>", "<button>Menu", "<object data=x>no", "<video src=/a/>",
                  "<datalist><option value=a><option>b</datalist>", "<head><title>t</title>", "<head><title>t</title><body>",
                  "<title>t", "<textarea>t", "<iframe src='x'/>", "<select><option>a<option>b</select>"):
        assert visible(start + rest) == ["One", "Two"], start


def test_hidden_elements_with_an_end_tag():
    for inner in ("<svg><path d=''/><text>no</text></svg>", "<video><p>no</p></video>", "<noscript><div>no</div></noscript>",
                  "<template><p>no</p></template>", "<button><b>no</b></button>", "<script>'<p>'</script>",
                  "<object><object>no</object>no</object>", "<title>no</title >"):
        assert visible(f"<div><p>One {inner} and</p><p>two</p></div>") == ["One and", "two"], inner


def test_empty(spark):
    assert ours(spark, []) == {}
