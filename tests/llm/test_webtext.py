import random
import re
import time
from html.parser import HTMLParser

import pyarrow.parquet as pq

from tessera.llm import webtext
from tessera.llm.queries import QUERIES
from tessera.llm.webtext import Page, main_text

SCHEMA = "page_id long, url string, html string, path string, host string"


def text_of(html, winners=None):
    return main_text(Page(html), winners)[0]


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(parts)
    return {r.page_id: r for r in webtext.extract(df).collect()}


def test_one_page():
    html = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
    <body><header>Site <a href="/">home</a></header><nav><ul><li><a href=x>Menu</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><!-- <p>hidden</p> -->
    <article class="post-17"><header><h1>Head &lt;line&gt;</h1></header><p>One  two<br>three<b> bold</b>, <i>it</i>alic.<p><b>Four
    &eacute; &#233;&nbsp;x</p><ul><li>a<li>b</ul><form>Search</form><aside>More</aside>
    <table><tr><td>c1<td>c2</table><div class="share">Share</div></article>
    <section id="comments"><p>First!</p></section><footer>&copy; us</footer></body></html>"""
    assert text_of(html) == "\n\n".join(["Head <line>", "One two three bold, italic.", "Four é é x", "a", "b", "c1", "c2"])


def test_defined_cases():
    assert text_of("") == "" and text_of("plain < text & more") == "plain < text & more"
    assert text_of("<nav>only a menu</nav><script>x") == "" and text_of("<p>a<p>b<div") == "a\n\nb"
    assert text_of("<p title='a>b' class=it's>x</p>don't") == "x\n\ndon't"
    assert text_of("<p>x<!-- never closed <p>y") == "x" and text_of("</p></div><p>q</b></section>r</p>s") == "qr\n\ns"
    assert text_of("<div hidden>no</div><div style='display: none'>no</div><p>yes") == "yes"
    assert text_of("<h1>Head</h1><div class=top></div><div class=text><p>" + "word " * 50 + "</p></div>").startswith("Head\n\nword")


def test_any_page_takes_linear_time():
    for piece in ("<div>", "<b>", "<p><b>", "</div>", "<a b='", "<", "<!--", "<script>", "&amp", "<td><li>", " ", "<p class=\"", "<h1>", "=\"", "<x =",
                  "<table><td>", "<div class=" + "c" * 500 + ">t"):
        start = time.process_time()
        Page(piece * (1_000_000 // len(piece)))
        assert time.process_time() - start < 20, piece


def test_hosts_agree_on_a_path(spark):
    """A page whose side column outweighs its article follows its host; one alone cannot."""
    rng = random.Random(1)

    def words(n):
        return " ".join(f"w{rng.randrange(900)}" for _ in range(n))

    def page(article, column, k):
        return f'<body><div class="col-left">{column}</div><div class="body-{k}"><p>{article}</p></div></body>'

    rows = [(k, f"http://A.example.com/{k}", page(f"story{k} {words(80)}", f"column {words(20)}", k)) for k in range(30)]
    rows += [(100, "http://a.EXAMPLE.com/x?y", page(f"short {words(30)}", f"column {words(300)}", 5))]
    rows += [(101, None, page(f"short {words(30)}", f"column {words(300)}", 5)), (102, "http://b.example.com/", page("", "", 1))]
    rows += [(103, "http://a.example.com/other", f"<body><main><p>{words(40)}</p></main></body>"), (104, "http://a.example.com/", None)]
    rows += [(104, "http://a.example.com/", None)]
    got = run(spark, rows)
    assert all(got[k].text.startswith(f"story{k}") and "column" not in got[k].text for k in range(30))
    assert got[100].text.startswith("short") and "column" not in got[100].text      # the host's path
    assert got[101].text.startswith("column")                                       # no host: its own
    assert got[102].text == "" and got[104].text == "" and got[104].n_chars == 0 and got[103].text
    assert got[100].n_chars == len(got[100].text) and got[100].url == "http://a.EXAMPLE.com/x?y"
    votes = {r.host: r.winners for r in webtext.winning_paths(
        spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).select(webtext.host_of().alias("host"), "html")).collect()}
    assert votes == {"a.example.com": [">body>div.body-#"]}
    assert run(spark, []) == {}


class Article(HTMLParser):
    """Blocks of the article element of the given pages, whose only inner blocks are h1 and p."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag in ("p", "h1"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_given_pages_against_the_article_element(spark, small_dir):
    got = {r.page_id: r for r in QUERIES["op13_html_extraction"](spark, small_dir).collect()}
    pages = pq.read_table(f"{small_dir}/pages.parquet").to_pylist()
    assert len(got) == len(pages)
    for p in pages:
        reader = Article()
        reader.feed(p["html"])
        reader.close()
        expected = "\n\n".join(b for b in (re.sub(r"\s+", " ", b).strip() for b in reader.blocks) if b)
        assert got[p["page_id"]].text == expected and got[p["page_id"]].n_chars == len(expected)
