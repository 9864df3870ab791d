"""Listing pages -> event cards / list items -> text for extraction.

An element is located by a whole-token class match. A page is cut at every start
tag of the repeated element (``split``); each piece is one card/item and its fields
are the first matching child element inside the piece. All row-local expressions.

The card profile keeps the *set* of formatted card lines of a source over all its
listing URLs. The set is a distinct aggregate (combined map-side, so a source with a
third of all cards is fine). Its text is cut per page unit instead of being glued
into one string per source: every distinct line is assigned to the first page it
occurs on, and lines are concatenated per (source, page). The reference's line order
within the set is arbitrary; here it is the sorted line order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.functions import html as H

# Element classes, defaults and line formats of the two listing kinds.
CARD_CLASS, CARD_TITLE, CARD_DATE, CARD_VENUE = "event-card", "event-card-title", "event-card-date", "event-card-venue"
CARD_DEFAULTS = ("Unbekannter Titel", "Unbekanntes Datum", "Unbekannter Ort")
ITEM_CLASS, ITEM_HEADLINE, ITEM_DATE, ITEM_INFO = ("event-list__item", "event-list__headline", "event-list__date",
                                                   "event-list__info-item")
ITEM_DEFAULTS = ("Unknown Title", "Unknown Date", "Unknown Location", "Unknown Time")
DEFAULT_PLACE = "braunschweig"
EMPTY_ITEMS_TEXT = "No events found on {name}."


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _field(seg: Column, tag: str, token: str, default: str, sep: str = "") -> Column:
    """Text of the first such element of a piece, or the default."""
    inner = H.inner_html(seg, tag, H.start_tag_re(tag, token))
    return F.coalesce(H.get_text_strip(inner, sep), F.lit(default))


def _field_sql(seg: str, tag: str, token: str, default: str, sep: str = "") -> str:
    pat = H.element_inner_re_sql(tag, token)
    return (f"CASE WHEN regexp_matches({seg}, '{pat}') "
            f"THEN {H.get_text_strip_sql(f'regexp_extract({seg}, {chr(39)}{pat}{chr(39)}, 1)', sep)} "
            f"ELSE '{default}' END")


def _pieces(html: Column, tag: str, token: str) -> Column:
    # everything after the first start tag; slice past the end is just shorter
    return F.slice(H.applied(F.coalesce(html, F.lit("")), "s", H.pieces("s", H.start_tag_re(tag, token))), 2, 1 << 30)


# -- H7/H8/H9 ------------------------------------------------------------------------

def page_cards(html, place: str | None = None) -> Column:
    """The cards of one page, in order: array of (title, date, venue). With ``place`` only those whose
    venue mentions it (H8); the other fields of the rest are not looked for."""
    cards = F.transform(_pieces(_c(html), "div", CARD_CLASS), lambda seg: F.struct(
        seg.alias("seg"), _field(seg, "span", CARD_VENUE, CARD_DEFAULTS[2]).alias("venue")))
    if place is not None:
        cards = F.filter(cards, lambda c: F.lower(c["venue"]).contains(place.lower()))
    return F.transform(cards, lambda c: F.struct(
        _field(c["seg"], "h3", CARD_TITLE, CARD_DEFAULTS[0]).alias("title"),
        _field(c["seg"], "span", CARD_DATE, CARD_DEFAULTS[1]).alias("date"), c["venue"].alias("venue")))


def listing_cards(pages: DataFrame, html_col: str = "html", keep=("page",)) -> DataFrame:
    """H7: one row per card: ``card_idx`` (position on the page), title, date, venue.
    Fields are computed inside the generator, so a later filter on them (the place
    filter) cannot be pushed below and re-run the extraction regexes."""
    return (pages.select(*keep, F.posexplode(page_cards(html_col)).alias("card_idx", "_c"))
            .select(*keep, "card_idx", "_c.title", "_c.date", "_c.venue"))


def listing_cards_sql(pages_sql: str, html_col: str = "html", keep=("page",)) -> str:
    k = ", ".join(keep)
    seg = "seg"
    return f"""
SELECT {k}, card_idx, {_field_sql(seg, 'h3', CARD_TITLE, CARD_DEFAULTS[0])} AS title,
       {_field_sql(seg, 'span', CARD_DATE, CARD_DEFAULTS[1])} AS date,
       {_field_sql(seg, 'span', CARD_VENUE, CARD_DEFAULTS[2])} AS venue
FROM (SELECT {k}, CAST(generate_subscripts(parts, 1) - 2 AS INTEGER) AS card_idx, unnest(parts) AS seg
      FROM (SELECT {k}, string_split_regex(coalesce({html_col}, ''), '{H.start_tag_re_sql('div', CARD_CLASS)}') AS parts
            FROM ({pages_sql}) pg) x) y
WHERE card_idx >= 0"""


def listing_filter_place(cards: DataFrame, place: str = DEFAULT_PLACE) -> DataFrame:
    """H8: keep cards whose venue mentions the place (case-insensitive)."""
    return cards.where(F.lower(F.col("venue")).contains(place.lower()))


def card_line(title="title", date="date", venue="venue") -> Column:
    return F.concat(F.lit("Event: "), _c(title), F.lit(" | Datum: "), _c(date), F.lit(" | Ort: "), _c(venue))


def listing_lines(cards: DataFrame, source_cols=("source_rank", "source_name"), unit_col: str = "page") -> DataFrame:
    """H9: the distinct card lines of each source, each with the first unit (page)
    it occurs on. Map-side combined aggregate."""
    return (cards.select(*source_cols, unit_col, card_line().alias("line"))
            .groupBy(*source_cols, "line").agg(F.min(unit_col).alias(unit_col)))


def listing_text(lines: DataFrame, source_cols=("source_rank", "source_name"), unit_col: str = "page") -> DataFrame:
    """Card-profile text per (source, unit): its lines in sorted order joined by
    '\\n'. A group is bounded by one page's cards."""
    text = F.expr("listagg(line, '\\n') WITHIN GROUP (ORDER BY line)")
    return lines.groupBy(*source_cols, unit_col).agg(text.alias("text"))


# -- H10/H11 -------------------------------------------------------------------------

def page_items(html) -> Column:
    """The list items of one page, in order: array of (title, date, location, time). Info
    spans are taken by position (0 location, 1 time, the rest ignored)."""
    def item(seg):
        spans = F.transform(_pieces(seg, "span", ITEM_INFO),
                            lambda rest: H.get_text_strip(H.inner_of_rest(rest, "span"), " "))
        return H.let(spans, lambda infos: F.struct(
            _field(seg, "h2", ITEM_HEADLINE, ITEM_DEFAULTS[0]).alias("title"),
            _field(seg, "p", ITEM_DATE, ITEM_DEFAULTS[1], " ").alias("date"),
            F.coalesce(F.get(infos, 0), F.lit(ITEM_DEFAULTS[2])).alias("location"),
            F.coalesce(F.get(infos, 1), F.lit(ITEM_DEFAULTS[3])).alias("time")))

    return F.transform(_pieces(_c(html), "div", ITEM_CLASS), item)


def listing_items(pages: DataFrame, html_col: str = "html", keep=("page",)) -> DataFrame:
    """One row per list item."""
    return (pages.select(*keep, F.posexplode(page_items(html_col)).alias("item_idx", "_i"))
            .select(*keep, "item_idx", "_i.title", "_i.date", "_i.location", "_i.time"))


def listing_items_sql(pages_sql: str, html_col: str = "html", keep=("page",)) -> str:
    k = ", ".join(keep)
    info_pat = H.element_inner_re_sql("span", ITEM_INFO)
    infos = (f"list_transform(regexp_extract_all(seg, '{info_pat}', 1), "
             f"lambda x: {H.get_text_strip_sql('x', ' ')})")
    return f"""
SELECT {k}, item_idx, {_field_sql('seg', 'h2', ITEM_HEADLINE, ITEM_DEFAULTS[0])} AS title,
       {_field_sql('seg', 'p', ITEM_DATE, ITEM_DEFAULTS[1], ' ')} AS date,
       coalesce({infos}[1], '{ITEM_DEFAULTS[2]}') AS location,
       coalesce({infos}[2], '{ITEM_DEFAULTS[3]}') AS time
FROM (SELECT {k}, CAST(generate_subscripts(parts, 1) - 2 AS INTEGER) AS item_idx, unnest(parts) AS seg
      FROM (SELECT {k}, string_split_regex(coalesce({html_col}, ''), '{H.start_tag_re_sql('div', ITEM_CLASS)}') AS parts
            FROM ({pages_sql}) pg) x) y
WHERE item_idx >= 0"""


def item_block(title="title", date="date", time="time", location="location") -> Column:
    return F.concat(F.lit("Event: "), _c(title), F.lit("\nDate: "), _c(date), F.lit("\nTime: "), _c(time),
                    F.lit("\nLocation: "), _c(location))


def listing_blocks(pages: DataFrame, items: DataFrame, source_name_col: str = "source_name",
                   unit_cols=("source_rank", "source_name", "page")) -> DataFrame:
    """Per page: 'Source: <name>' then one 4-line block per item, blank-line
    separated; a page without items gives the 'no events' sentinel, which is
    non-empty and does go on to extraction. Group = one page's items (bounded)."""
    blocks = (items.select(*unit_cols, "item_idx", item_block().alias("block"))
              .groupBy(*unit_cols)
              .agg(F.expr("listagg(block, '\\n\\n') WITHIN GROUP (ORDER BY item_idx)").alias("_blocks")))
    sentinel = F.replace(F.lit(EMPTY_ITEMS_TEXT), F.lit("{name}"), F.col(source_name_col))
    text = F.when(F.col("_blocks").isNull(), sentinel).otherwise(
        F.concat(F.lit("Source: "), F.col(source_name_col), F.lit("\n\n"), F.col("_blocks")))
    return (pages.select(*unit_cols).join(blocks, list(unit_cols), "left")
            .select(*unit_cols, text.alias("text")))


# -- H12 -----------------------------------------------------------------------------

def upcoming_only(df: DataFrame, date_col: str, as_of) -> DataFrame:
    """Source-side date bound; a plain predicate that Catalyst pushes into the
    Parquet scan (visible as PushedFilters)."""
    import datetime as _dt
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return df.where(F.col(date_col) >= F.lit(as_of))
