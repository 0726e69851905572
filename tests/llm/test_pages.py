import html as library
import re
import time

from pyspark.sql import functions as F

from narrakin.llm import html, urls
from narrakin.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_documents_pages_against_a_plain_reading(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    got = html.extract(spark, table(spark, SF, "pages")).collect()
    assert len(got) == len(pages)
    for row in got:
        article = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        blocks = [" ".join(library.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"<p>|</p>|</?h1>", article)]
        assert row["text"] == "\n".join(b for b in blocks if b)
        assert row["n_chars"] == len(row["text"])


def test_what_is_left_out_of_a_page():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
    <body><header class=top>Site</header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <main><article><header><h1>The&nbsp;title</h1></header><p>One <b>bold</b>
      &lt;word&gt;<br>line</p><!-- <p>hidden</p> --><div class="ad">Buy</div><p>Two<p>Three</article>
    <section id="comments"><article class="comment"><p>First!</p></article></section></main>
    <aside>More</aside><form><label>Mail</label><input name=x></form><footer>&copy; me</footer></body></html>"""
    assert html.read_page(page)[0] == "The title\nOne bold <word> line\nTwo\nThree"


def test_pages_without_article_and_broken_pages():
    assert html.read_page("<body><nav>menu</nav><div>Text <i>here</i></div><p>and here")[0] == "Text here\nand here"
    assert html.read_page("plain &amp; simple")[0] == "plain & simple"
    assert html.read_page("") == ("", [])
    assert html.read_page("a < b <p class='x>y' title=\"a>b\">c</p>")[0] == "a < b\nc"
    assert html.read_page("<form><article><p>wrapped</p></article></form>")[0] == "wrapped"
    assert html.read_page("<ul><li>1<li>2<ul><li>3</ul></ul>")[0] == "1\n2\n3"
    assert html.read_page("<!-- open <p>x")[0] == ""
    assert html.read_page("<p>" * 5000 + "deep")[0] == "deep"


def test_long_and_malformed_pages_take_time_by_their_length():
    """A megabyte of each kind that makes a reader look ahead or back again and again."""
    pages = {
        "deep": "<div>" * 100_000 + "text" + "</div>" * 80_000, "deep lists": "<ul><li>" * 60_000, "open tags": "<p <b " * 180_000, "no end": "<a" * 500_000,
        "open quotes": "<p class=\"x>a</p>" * 62_501, "odd quotes": "<p \">x\"y " * 100_001, "comments": "<!-- <!- " * 110_000, "ends only": "</div></b>" * 100_000,
        "ends beside": "<div>" * 50_000 + "</section></b></p>" * 40_000, "inline": "<b><i>" * 80_000 + "</b><p>" * 70_000, "articles": "<div><article>" * 70_000,
        "outside": "<aside>" * 40_000 + "<article>x</article>" * 35_000, "scripts": "<script>" * 120_000, "brackets": "<" * 1_000_000, "marks": "<!" * 500_000,
    }
    for name, page in pages.items():
        begin = time.perf_counter()
        html.read_page(page)
        assert time.perf_counter() - begin < 8, name


def test_broken_pages_keep_their_text():
    assert html.read_page("<div>" * 3000 + "deep" + "</div>" * 2000 + "after")[0] == "deep\nafter"
    assert html.read_page("<p class=\"x>lost</p><p>kept</p><p title='a>b'>b")[0].endswith("kept\nb'>b")
    assert html.read_page("<b>x</p>y</b><p>z</b>w")[0] == "x\ny\nzw"
    assert html.read_page("tail < 3 and <b")[0] == "tail < 3 and <b"


def test_hashes_tell_subtrees_apart_by_structure_and_words():
    marks = lambda page: html.read_page(page)[1]
    one = marks("<div class=a><p>Read  our</p> <b>letter</b></div>")
    assert one == marks("<div id=b>\n<p>Read our</p><b> letter</b>\n</div>") and len(one) == 1
    others = ["<div><p>Read our letter</p></div>", "<div><p>Read our</p><i>letter</i></div>", "<div><b>letter</b><p>Read our</p></div>",
              "<section><p>Read our</p><b>letter</b></section>", "<div><p>Read our<b>letter</b></p></div>"]
    assert len({tuple(marks(o)) for o in others} | {tuple(one)}) == 6
    assert marks("<div><ul><li>x</ul></div>") == [*marks("<ul><li>x</ul>"), marks("<div><ul><li>x</ul></div>")[-1]]
    assert marks("<div><section><article>a</article></section><div>b</div></div>") == marks("<div>b</div>")


def test_subtrees_repeated_on_a_site_go(spark):
    box = "<div><div>Read our letter</div> every week</div>"
    rows = [(i, f"http://a.example/{i}", f"<body>{box}<p>text number {i}</p></body>") for i in range(8)]
    rows += [(20 + i, f"http://b.example/{i}", f"<body>{box if i == 0 else ''}<p>other {i}</p></body>") for i in range(8)]
    rows += [(40 + i, f"http://c.example/{i}", "<body><div><p>the same page</p></div></body>") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("marks", F.lit(2))
    got = {r["page_id"]: r["text"] for r in html.extract(spark, pages).collect()}
    assert all(got[i] == f"text number {i}" for i in range(8))
    assert got[20] == "Read our letter\nevery week\nother 0"
    assert all(got[40 + i] == "the same page" for i in range(8))


def test_names_of_wrappers_do_not_hide_an_article():
    names = "has-sidebar no-sidebar comments-open with-banner withComments layout_sidebar_right sidebar social share banner cookie-notice".split()
    for name in names:
        for tag in ("div", "section", "span", "td"):
            for inner in ("article", "main"):
                page = f"<body><{tag} class='page {name}'><div id={name}><{inner}><h1>Title</h1><p>Text</{inner}></div></{tag}><p>beside</body>"
                assert html.read_page(page)[0] == "Title\nText"
    assert html.read_page("<article><div class='comments-open'>Kept</div><div class='ad'>Buy</div></article>")[0] == "Kept"
    assert html.read_page("<main><h1>Title</h1><div class=social><article>Text</article></div></main>")[0] == "Title\nText"
    assert html.read_page("<div class='cookie-notice'>We use cookies</div><div class=siteHeader>Text</div>")[0] == "Text"


def test_articles_that_stay_outside():
    own = "<article><p>Text</p></article>"
    for other in ("<section id=comments><article>First!</article></section>", "<aside><article>teaser</article></aside>",
                  "<div class=sidebar><aside><article>teaser</article></aside></div>", "<div class=banner hidden><article>no</article></div>"):
        assert html.read_page(f"<main>{own}{other}</main>")[0] == "Text"
    assert html.read_page("<article><p>Text</p><div class=comments><article>First!</article></div></article>")[0] == "Text"
    assert html.read_page(f"<div class=promo>{own}</div>{own}")[0] == "Text\nText"
    assert html.read_page(f"<main><form>{own}</form>{own}</main>")[0] == "Text\nText"


def test_near_copies_of_an_article_keep_what_they_share(spark):
    shared = "<table><tr><td>a</td><td>1</td></tr></table><div><ul><li>first</li><li>second</li></ul></div>"
    rows = [(i, f"http://a.example/{i}", f"<body><nav><ul><li>Home</li></ul></nav><article><p>version {i}</p>{shared}</article></body>") for i in range(6)]
    rows += [(10 + i, f"http://b.example/{i}", f"<body><main><p>version {i}</p>{shared}</main></body>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(spark, pages).collect()}
    assert all(got[at + i] == f"version {i}\na\n1\nfirst\nsecond" for i in range(6) for at in (0, 10))


def test_templates_take_the_same_share_of_hosts_of_every_size(spark):
    rows = [(host, f"<div>{'seldom' if i % 25 == 0 else i}</div><ul><li>{'often' if i % 10 == 0 else i}</li></ul><p>{i}</p>")
            for host, pages in (("small", 250), ("large", 3000)) for i in range(1, pages + 1)]
    found = {r["host"]: r["marks"] for r in html.templates(spark.createDataFrame(rows, "host string, html string")).collect()}
    assert found["small"] == found["large"] == html.read_page("<ul><li>often</li></ul>")[1]


def test_odd_pages(spark):
    rows = [(1, None, "<p>a</p>"), (2, "http://x.example/", None), (None, "nohost", "<p>b</p>"), (2, "http://x.example/", None), (3, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.extract(spark, pages).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in got) == [(0, "b"), (1, "a"), (2, ""), (2, ""), (3, "")]
    assert html.extract(spark, pages.limit(0)).count() == 0
    judged = urls.judge(spark, pages).collect()
    assert sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"], r["verdict"]) for r in judged) == [
        (0, "", "", None, "allow"), (1, "", "", None, "allow"), (2, "x.example", "/", None, "allow"), (2, "x.example", "/", None, "allow"),
        (3, "", "", None, "allow")]
    assert urls.judge(spark, pages.limit(0)).count() == 0


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


def test_rules(spark):
    samples = [
        "http://A.Example.ORG/es/1?x#y", "https://example.org/en/12", "https://example.org/en/2", "http://org/", "http://org", "http://xorg/es/",
        "http://sub.example.com/fr/", "http://example.com/fr", "http://example.com/de/x/fr/", "http://notexample.org/es/", "ftp://com/de/#a?b",
        "http://example.net/de/", "http://example.org?/es/", "x://y://example.org/es/", "http://example.org./es/", "http:/example.org/es/", "",
    ]
    pages = spark.createDataFrame(list(enumerate(samples)), "page_id long, url string").withColumn("html", F.lit("")).withColumn("rule", F.lit(0))
    for r in urls.judge(spark, pages).collect():
        url = samples[r["page_id"]]
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        rule = plain_rule(host.lower(), path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host.lower(), path, rule and rule[0], rule[1] if rule else "allow")


def test_blocks_reach_aliases_but_not_allowed_urls(spark):
    link = lambda u: f"<head><link rel='canonical' href='{u}'></head>"
    rows = [
        (1, "http://a.example.net/x", link("http://b.example.net/y")),
        (2, "https://b.example.net/y#top", "<meta http-equiv=refresh content=\"0; url=/z\">"),
        (3, "http://b.example.net/z", link("http://example.com/de/1")),
        (4, "http://c.example.com/fr/2", link("http://example.com/de/1")),
        (5, "http://d.example.net/", link("http://example.com/fr/9")),
        (6, "http://e.example.net/", link("#") + link("mailto:x@y") + link("/")),
        (7, "http://f.example.net/q?a=1&b=2", link("http://g.example.net/")),
        (8, "http://h.example.net/", link("http://f.example.net/q?a=1&amp;b=2")),
        (9, "http://g.example.net", link("http://example.org/es/5")),
    ]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "block"}
