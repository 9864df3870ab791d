"""Pages as sites write them: any quoting, '>' in attributes, nesting, comments, references."""

import html as stdlib_html
import html.entities
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from calforge.functions import html as H
from calforge.operators import html as HT
from calforge.operators import listing as L
from calforge.plans import gather as G
from calforge.sources import pages as P


def each(spark, cases, column):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_page_text_of_hard_pages(spark):
    cases = {
        '<p data-x="() => 1">hello</p>': "hello",
        "<p data-x='a > b' hidden>hello</p>": "hello",
        '<nav-item>a</nav-item>b<nav class="x">gone</nav>c': "a\nb\nc",
        '<nav data-a="x>y">gone</nav>c': "c",
        "<p>it's</p> 5 < 6 <b title=don't>x</b>": "it's\n5 < 6\nx",
        "a<script>if (1 < 2) { '</p>' }": "a",
        "a<SCRIPT type='x'>1</SCRIPT >b<style>c": "a\nb",
        '<p title="open>text</p>': "text",
        "": "",
    }
    assert each(spark, cases, HT.page_text) == list(cases.values())


def test_references_as_the_standard_library_reads_them(spark):
    cases = ["&bdquo;Caf&eacute;&ldquo;", "&#8211;&#x27;&#X1F600;", "&amp;lt; &amp;amp;", "&unknown; & &;", "&#150;&#0;",
             "&#xD800;&#1114112;", "&CounterClockwiseContourIntegral;&NotEqualTilde;", "no refs", "&euro;5&nbsp;x&uuml;"]
    assert each(spark, cases, H.decode_entities) == [stdlib_html.unescape(c) for c in cases]
    assert each(spark, [None], H.decode_entities) == [None]


def test_content_element_by_whole_names_and_any_quoting(spark):
    cases = {
        '<div data-id="content">no</div><div id="content">yes</div>': "yes",
        "<div class='a' id='content'>yes</div>": "yes",
        "<div id=content>yes</div>": "yes",
        '<div title="a>b" id = "content" x>a<div>b</div>c</div>d': "a<div>b</div>c",
        '<divider id="content">no</divider><main>m</main>': "m",
        '<div id="contents">no</div>': '<div id="contents">no</div>',
        '<div id="content"></div>x': "",
        '<div id="content">open<div>x</div>': "open<div>x</div>",
    }
    assert each(spark, cases, HT.main_content) == list(cases.values())


def test_cards_and_items_with_nested_and_quoted_fields(spark):
    card = ("<div data-k='1>0' class='event-card big'><h3 class=event-card-title>T<span>!</span></h3>"
            "<span class='x event-card-date'><i></i><span>01.02.2030</span> 20:00</span>"
            "<span class=\"event-card-venue\"><span class=icon>i</span><span>Stadthalle</span> Braunschweig</span></div>"
            '<div class="event-cards"><h3 class="event-card-title">none</h3></div>'
            '<div data-class="event-card">none</div>')
    df = spark.createDataFrame([(0, card)], "page int, html string")
    assert [tuple(r) for r in L.listing_filter_place(L.listing_cards(df)).collect()] == [
        (0, 0, "T!", "01.02.2030" + "20:00", "iStadthalleBraunschweig")]
    assert df.select(G.card_text("html")).first()[0] == "Event: T! | Datum: 01.02.203020:00 | Ort: iStadthalleBraunschweig"
    item = ("<div class='event-list__item'><h2 class='event-list__headline'>A</h2>"
            "<span class='event-list__info-item'><span></span>Halle <b>1</b></span>"
            "<span class=event-list__info-item><span>19:30</span> Uhr</span></div>")
    df = spark.createDataFrame([(0, item), (1, "")], "page int, html string")
    assert [tuple(r) for r in L.listing_items(df).collect()] == [(0, 0, "A", "Unknown Date", "Halle 1", "19:30 Uhr")]
    assert [r[0] for r in df.orderBy("page").select(G.items_text("html", F.lit("s"))).collect()] == [
        "Source: s\n\nEvent: A\nDate: Unknown Date\nTime: 19:30 Uhr\nLocation: Halle 1", "No events found on s."]


def test_frame_source(spark):
    cases = {
        '<iframe data-src="no" src="/yes">': "/yes",
        "<iframe title='a>b' src='/y?a=1&amp;b=2'>": "/y?a=1&b=2",
        '<!-- <iframe src="/old"> --><iframe src=/new width=3>': "/new",
        '<iframe data-src="x"></iframe><iframe src="/second">': None,
        '<iframe src="">': None, "<iframes src='x'>": None, "none": None,
    }
    assert each(spark, cases, P.iframe_src) == list(cases.values())


def test_pages_of_very_many_tags_and_attributes(spark):
    many = "<b>" * 100_000 + "x" + "</b>" * 100_000
    wide = "<div " + " ".join(f'a{i}="{i}"' for i in range(20_000)) + ' id="content">y</div>'
    deep = '<div id="content">' + "<div>" * 5_000 + "z" + "</div>" * 5_000 + "</div>t"
    assert each(spark, [many, wide, deep], HT.page_text) == ["x", "y", "z\nt"]
    assert each(spark, [many], lambda c: H.get_text_strip(c)) == ["x"]
    got = each(spark, [wide, deep], HT.main_content)
    assert got[0] == "y" and got[1].count("<div>") == 5_000 and got[1].endswith("</div>")


# -- noise elements end where a parser ends them -------------------------------------------

class OpenElements(HTMLParser):
    """Text nodes outside noise elements, by the open elements of the standard parser."""

    def __init__(self, noise):
        super().__init__()
        self.noise, self.open, self.nodes, self.run = noise, [], [], ""

    def end_node(self):
        if not any(n in self.noise for n in self.open) and self.run:
            self.nodes.append(self.run)
        self.run = ""

    def handle_starttag(self, tag, attrs):
        self.end_node()
        if tag not in H.VOID_TAGS:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.end_node()

    def handle_endtag(self, tag):
        self.end_node()
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        self.run += data

    def handle_comment(self, data):
        self.end_node()

    handle_decl = handle_pi = unknown_decl = handle_comment


def lines_by_parser(page, noise=H.NOISE_TAGS):
    p = OpenElements(noise)
    p.feed(page)
    p.close()
    p.end_node()
    pieces = [x.strip() for line in "\n".join(p.nodes).splitlines() for x in line.strip().split("  ")]
    return "\n".join(x for x in pieces if x)


def random_page(rng):
    names = ["nav", "header", "footer", "aside", "div", "p", "ul", "li", "b", "NAV", "nav-item", "br", "img", "x:y"]
    parts = []
    for i in range(rng.randint(1, 40)):
        name = rng.choice(names)
        parts.append(rng.choice([
            f"<{name}>", f"<{name}>", f"</{name}>", f"</{name} >", f"<{name} class='a>b' x>", f'<{name} title="</nav>">', f"<{name}/>",
            f"t{i}", f" t{i}  u ", "&amp;", "&copy 2026", "&notit;", "5 < 6", "<!-- <nav> -->", "<!DOCTYPE html>",
            "<script>'</nav>'</script>", "<style>p</style>", "</ >", "\n"]))
    return "".join(parts)


def test_nested_and_unclosed_noise_as_the_standard_parser_reads_it(spark):
    cases = ["<nav>x<nav>y</nav>LEAK</nav>z", "<div><header>a</div>b", "a<nav>b", "</nav>a<nav></div>b</nav>c", "<p><nav><p>a</nav>b</p>c",
             "<nav/>a", "<div><nav><div></div></div>a</nav>b", "<header><nav>a</header>b</nav>c", "<nav><br></br>a</nav>b", ""]
    rng = random.Random(11)
    cases += [random_page(rng) for _ in range(400)]
    assert each(spark, cases, HT.page_text) == [lines_by_parser(c) for c in cases]
    wider = [c.replace("  ", " ") for c in cases]
    assert each(spark, wider, lambda c: HT.text_normalise(H.text_nodes(c, H.CONTENT_NOISE_TAGS))) == [
        lines_by_parser(c, H.CONTENT_NOISE_TAGS) for c in wider]
    # the page without its noise reads like the page
    assert each(spark, cases, lambda c: HT.text_normalise(HT.html_to_text(HT.strip_blocks(c)))) == [lines_by_parser(c) for c in cases]


def test_stripped_pages(spark):
    cases = {"a<nav>x<nav>y</nav>z</nav>b": "a\nb", "<p>a<script>1</script>b</p>": "<p>a\nb</p>", "<div><footer>a</div>b": "<div>\n</div>b",
             "<p>none</p>": "<p>none</p>", "a<style>b": "a\n", "x<header>y": "x\n"}
    assert each(spark, cases, HT.strip_blocks) == list(cases.values())
    assert each(spark, ["a<meta x>b<nav>c</nav>"], lambda c: HT.strip_blocks(c, H.CONTENT_NOISE_TAGS, H.VOID_NOISE_TAGS)) == ["a\nb\n"]
    assert each(spark, [None], HT.strip_blocks) == [None]


def test_references_without_a_semicolon(spark):
    cases = ["&copy 2026", "&amp Co", "&copy2026", "&notit; &notin; &notinva", "&AMP&lt&gt", "&a &ampersand; &xyz &", "&#65 &#x41g &#65;", "&#0065 &#00000000000000000065;",
             "&#99999999999999999999;", "&#x110000 &#xFFFE &#1; &#12; &#13; &#127; &#129;", "&" + "a" * 40 + ";", "&Auml" * 5, "&frac12 &frac1", "&#x;&#;&;&&amp;"]
    rng = random.Random(3)
    names = list(stdlib_html.entities.html5)
    cases += ["&" + rng.choice(names)[:rng.randint(2, 9)] + rng.choice(["", ";", " ", "x", "="]) for _ in range(600)]
    assert each(spark, cases, H.decode_entities) == [stdlib_html.unescape(c) for c in cases]
