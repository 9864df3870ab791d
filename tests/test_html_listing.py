"""HTML -> text against a stdlib html.parser oracle; listing extraction round trips."""

import itertools

from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from calforge.operators import html as HT
from calforge.operators import listing as L
from calforge.plans import fixtures as FX
from calforge.sources import pages as P
from tests.conftest import SF01, rows

NOISE = {"script", "style", "nav", "footer", "header"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class TextNodes(HTMLParser):
    """Text nodes outside noise subtrees, as a DOM get_text(separator='\\n') sees them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], []

    def handle_starttag(self, tag, attrs):
        if tag in NOISE:
            self.skip.append(tag)
        self.out.append(None)

    def handle_endtag(self, tag):
        if self.skip and tag == self.skip[-1]:
            self.skip.pop()
        self.out.append(None)

    def handle_comment(self, data):          # a comment is its own node: it separates text
        self.out.append(None)

    def handle_decl(self, decl):
        self.out.append(None)

    def handle_pi(self, data):
        self.out.append(None)

    def handle_data(self, data):
        if not self.skip:
            if self.out and isinstance(self.out[-1], str):
                self.out[-1] += data
            else:
                self.out.append(data)


def agrees(html: str, got: str) -> bool:
    """The page text holds the visible characters of the text nodes in their order, no piece
    runs over the end of a node, and no piece is blank, padded or has a double blank."""
    p = TextNodes()
    p.feed(html)
    p.close()
    nodes = ["".join(x.split()) for x in p.out if isinstance(x, str)]
    ends = set(itertools.accumulate(len(n) for n in nodes))
    pieces = got.splitlines()
    cuts = set(itertools.accumulate(len("".join(x.split())) for x in pieces))
    return ("".join(nodes) == "".join(got.split()) and (ends - {0}) <= cuts
            and all(x and x == x.strip() and "  " not in x for x in pieces))


def test_page_text_matches_parser_oracle(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    got = dict(pages.select("page_id", HT.page_text("html").alias("t")).collect())
    mism = [pid for pid, html in pages.select("page_id", "html").collect() if not agrees(html, got[pid])]
    assert not mism, mism[:5]


def test_hard_strings(spark):
    cases = {
        "<p>a &amp;lt; b</p><!-- c --><script>x</script>d": "a &lt; b\nd",
        "<div>Tom &amp; Jerry&nbsp;</div>\t<b> x  y </b>": "Tom & Jerry\nx\ny",
        "<header>h</header><title>T</title><br>z": "T\nz",
    }
    df = spark.createDataFrame(list(cases.items()), "h string, e string")
    assert [tuple(r) for r in df.select(HT.page_text("h"), "e").collect()] == [(e, e) for e in cases.values()]


def test_line_dedup_consecutive(spark):
    df = spark.createDataFrame([("a\na\nb\na\nb\nb",)], "t string")
    assert df.select(HT.line_dedup_consecutive("t")).first()[0] == "a\nb\na\nb"


def test_cards_round_trip(spark):
    """Cards extracted from rendered listing pages equal the relation they came from."""
    cards = L.listing_cards(FX.fx3_card_pages(spark, SF01))
    got = cards.select((F.col("page") * 100 + F.col("card_idx")).alias("event_id"), "title", "date", "venue")
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    want = ev.select(
        "event_id", F.concat("event_type", (F.col("user_id") % 50).cast("string")).alias("title"),
        F.date_format("ts", "dd.MM.yyyy HH:mm").alias("date"),
        F.when(F.col("user_id") % 3 == 0, "Stadthalle Braunschweig").when(F.col("user_id") % 3 == 1, "Hannover")
         .otherwise("Unbekannter Ort").alias("venue"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert L.listing_filter_place(cards).count() == 3354


def test_items_positions_and_defaults(spark):
    items = L.listing_items(FX.fx3_item_pages(spark, SF01))
    assert items.count() == 10000
    by = {r.item_idx % 4: r for r in items.where("page = 0").collect()}
    assert by[0].location == "Unknown Location" and by[0].time == "Unknown Time"
    assert by[1].location.startswith("Halle") and by[1].time == "Unknown Time"
    assert by[2].time.endswith("Uhr")
    assert by[0].date.endswith(" ab") and " " in by[0].date


def test_frame_resolution_counts(spark):
    res = P.frame_resolve(FX.fx2_framed_pages(spark, SF01))
    n = {r[0]: r[1] for r in res.groupBy(
        F.when(F.col("frame_url").isNull(), "own").when(F.col("html") == "", "empty").otherwise("frame")
    ).count().collect()}
    assert n == {"own": 225, "frame": 20, "empty": 5}


def test_registry_fixture(spark):
    reg = FX.fx1_registry(spark, SF01)
    assert reg.count() == 58 and reg.where("enabled").count() == 37
    assert rows(reg, "rank") == [(i,) for i in range(58)]


WORDS = ["Konzert", "a", "b c", "x  y", "\ttab", " lead", "trail ", " ", "&amp;", "&lt;", "&gt;", "&quot;",
         "&nbsp;", "&copy;", "&middot;", "　z", "line\r\nbreak", "ü", "&amp;lt;"]
INLINE = ["p", "b", "div", "span", "li", "h1", "a href=\"/x\"", "title"]
NOISE_BLOCKS = ["<script>var t=\"</p>\";x()</script>", "<style>p{margin:0}</style>", "<nav><a>Menu</a> x</nav>",
                "<header><h1>Head</h1></header>", "<footer>&copy; f</footer>", "<!-- note -->", "<br>", "<hr/>"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(WORDS), st.sampled_from(INLINE).map(lambda t: ("open", t)),
                                   st.sampled_from(INLINE).map(lambda t: ("close", t.split()[0])),
                                   st.sampled_from(NOISE_BLOCKS).map(lambda b: ("raw", b))),
                         max_size=25), min_size=1, max_size=20))
def test_page_text_random_html(spark, docs):
    def render(tokens):
        out = []
        for t in tokens:
            if isinstance(t, str):
                out.append(t)
            elif t[0] == "open":
                out.append(f"<{t[1]}>")
            elif t[0] == "close":
                out.append(f"</{t[1]}>")
            else:
                out.append(t[1])
        return "".join(out)

    htmls = [render(d) for d in docs]
    df = spark.createDataFrame(list(enumerate(htmls)), "i int, html string")
    got = [r[0] for r in df.orderBy("i").select(HT.page_text("html")).collect()]
    assert all(agrees(h, t) for h, t in zip(htmls, got, strict=True))


def test_main_content_respects_nesting(spark):
    html = ('<html><body><nav>n</nav><div id="content"><div class="a"><p>one</p></div>'
            '<DIV><div>two</div></DIV><p>three</p></div><div>outside</div><main>m</main></body></html>')
    df = spark.createDataFrame([(html,), ('<main><p>x</p></main>',), ('<p>plain</p>',),
                                ('<div id="content"><div>open <p>to the end',)], "h string")
    got = [r[0] for r in df.select(HT.main_content("h")).collect()]
    assert got[0] == '<div class="a"><p>one</p></div><DIV><div>two</div></DIV><p>three</p>'
    assert got[1] == "<p>x</p>" and got[2] == "<p>plain</p>"
    assert got[3] == "<div>open <p>to the end"


def test_frame_url_rules(spark):
    cases = [
        ('<iframe src="https://x.org/a"></iframe>', "https://site.de/p", "https://x.org/a"),
        ('<IFRAME class="f" SRC="/cal?x=1"></IFRAME>', "https://site.de/p/q", "https://site.de/cal?x=1"),
        ('<iframe src="cal.html"></iframe>', "http://site.de:8080/p", "http://site.de:8080/cal.html"),
        ('<iframe src=""></iframe><iframe src="/second"></iframe>', "https://site.de/", None),
        ('<iframe title="no src"></iframe><iframe src="/second"></iframe>', "https://site.de/", None),
        ("<p>no frame</p>", "https://site.de/", None),
    ]
    df = spark.createDataFrame([(h, u) for h, u, _ in cases], "html string, url string")
    got = [r.frame_url for r in P.with_frame_url(df).collect()]
    assert got == [e for _, _, e in cases]


def test_whole_tag_names_and_any_number_of_tags(spark):
    from calforge.functions import html as H
    cases = ["<nav-item>a</nav-item>b<nav class='x'>c</nav>d", "<b>x</b> " + "<i></i>" * 100_000 + "y"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, html string").orderBy("i")
    assert df.select(HT.page_text("html")).first()[0] == "a\nb\nd"
    assert [r[0] for r in df.select(H.get_text_strip("html", " ")).collect()][1] == "x y"


# -- frames without moving html (SC6) ------------------------------------------------------

def test_frames_move_no_html_of_other_pages(spark, tmp_path):
    n = 400
    rows = [(i, f"https://a.de/{i}", f'<iframe src="/{i + 1}"></iframe>' if i % 40 == 0 else f"<p>{'own ' * 50}{i}</p>") for i in range(n)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        results = {}
        for most in (1_000_000, 0):
            df = P.frame_resolve(pages, most=most).select("page_id", "frame_url", "html")
            results[most] = sorted(map(tuple, df.collect()), key=str)
            nodes = _exchange_rows(df)
            assert any(moved for _, moved, _ in nodes), nodes
            assert all(moved <= 40 for _, moved, cols in nodes if "html" in cols), nodes
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = [(i, f"https://a.de/{i + 1}" if i % 40 == 0 else None, rows[i + 1][2] if i % 40 == 0 else rows[i][2]) for i in range(n)]
    assert results[1_000_000] == results[0] == sorted(want, key=str)


def _exchange_rows(df):
    """(node, rows written, columns) of every shuffle of an executed plan."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage")):
            return walk(node.plan())
        if name == "Exchange":
            written = node.metrics().apply("shuffleRecordsWritten").value()
            found.append((name, written, node.output().mkString(",")))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_rows_with_keys_by_bitmaps_are_the_same_rows(spark):
    from calforge.session import stored_table
    from calforge.sources.lookup import rows_with_keys
    df = spark.range(-3000, 3000).selectExpr("id", "concat('u', id % 977) AS url", "IF(id % 5 = 0, NULL, id) AS maybe")
    for key, keys in (("id", "id * 7"), ("maybe", "id * 7"), ("url", "concat('u', id % 50)"), ("id", "CAST(NULL AS bigint)")):
        wanted = stored_table(spark.range(500).selectExpr(f"{keys} AS k").distinct(), "keys")
        want = sorted(r.id for r in df.join(wanted, df[key] == wanted["k"], "left_semi").collect())
        for most in (10**6, 0):
            assert sorted(r.id for r in rows_with_keys(df, key, wanted, most).collect()) == want, (key, most)


def test_first_end_tag_nesting_and_marks(spark):
    """Elements with text around the mark the patterns use, nested, empty, unclosed and with odd end tags."""
    from calforge.functions import html as H
    rests = {"a</b>c</b>": "a", "</b>x": "", "a<b>n</b>t</B >z": "a<b>n</b>t", "open": "open", "": "", "a</b x>c</b>d": "a</b x>c",
             "\x01q</b>": "\x01q", "a</B>b</b>": "a", "<b>n</b>": "<b>n</b>"}
    df = spark.createDataFrame([(k, v) for k, v in rests.items()] + [(None, None)], "rest string, want string")
    for r in df.withColumn("got", H.inner_of_rest(F.col("rest"), "b")).collect():
        assert r.got == r.want, (r.rest, r.got)
    texts = ["  plain\t", "a <i>b</i>&amp;<br/> c", "x\x01\x01 y", "&lt;i&gt; ", "\x01", "<!-- c -->", "", "1 < 2", "\x01&amp;\x01b"]
    want = ["plain", "a|b|&|c", "x|y", "<i>", "", "", "", "1 < 2", "&|b"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", H.get_text_strip(F.col("t"), "|").alias("x")).collect()
    assert [r.x for r in sorted(got)] == want
    cut = spark.createDataFrame([("a1b22c",), ("\x01a1b",), ("1",), ("",), ("none",)], "s string").select(
        F.expr(H.pieces("s", "[0-9]+")).alias("new"), F.split("s", "[0-9]+").alias("old")).collect()
    assert all(r.new == r.old for r in cut)
