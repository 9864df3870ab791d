"""Compositions: gather site texts, and listing pages -> calendar lines.

``site_texts``: registry -> enabled -> profile -> newest page of each source's host
-> profile text. Per-source work is one page, so it is row-local after the
``current_page`` aggregate; frame pages go through the frame lookup join.

``listing_events``: listing pages of sources -> cards -> distinct lines per source
(text cut per page unit) -> envelope -> chunks -> native extraction -> candidates.
Chunk order inside a source is (unit, local chunk), held in one decimal: the unit (any
64-bit id) times 2^31 plus the local index (a position in an array, so below 2^31).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.functions import html as H
from calforge.operators import chunks as C
from calforge.operators import extract as X
from calforge.operators import html as HT
from calforge.operators import listing as L
from calforge.session import evenly, scratch_path
from calforge.sources import pages as P
from calforge.sources import registry as R

CHUNK_STRIDE = 1 << 31


# -- per-row profile texts ------------------------------------------------------------

def card_text(html, place: str = L.DEFAULT_PLACE) -> Column:
    """Card profile on one page: cards -> place filter -> distinct sorted lines."""
    lines = F.transform(L.page_cards(html, place), lambda c: L.card_line(c["title"], c["date"], c["venue"]))
    return F.array_join(F.array_sort(F.array_distinct(lines)), "\n")


def items_text(html, name) -> Column:
    """Item profile on one page: 'Source: name' + blocks, or the sentinel."""
    n = F.col(name) if isinstance(name, str) else name
    blocks = F.transform(L.page_items(html), lambda i: L.item_block(i["title"], i["date"], i["time"], i["location"]))
    return H.let(blocks, lambda b: F.when(
        F.size(b) == 0, F.replace(F.lit(L.EMPTY_ITEMS_TEXT), F.lit("{name}"), n)).otherwise(
        F.concat(F.lit("Source: "), n, F.lit("\n\n"), F.array_join(b, "\n\n"))))


def site_texts(registry: DataFrame, profiles: DataFrame, pages: DataFrame,
               override: DataFrame | None = None, place: str = L.DEFAULT_PLACE,
               listings: DataFrame | None = None, keep_url: bool = False) -> DataFrame:
    """Gather: ``(source_rank, source_name, profile, page_id, [url,] text)`` per enabled
    source that has a page, one row for each page. A source with rows in ``listings``
    ``(source_name, url)`` takes the newest copy of every url listed there, another one the
    newest page of its host. Frame pages are resolved against the whole page table."""
    srcs = R.source_profile(R.enabled_sources(registry, override), profiles)
    srcs = srcs.select(F.col("rank").alias("source_rank"), F.col("name").alias("source_name"), "profile",
                       P.url_host("url").alias("host"))
    # source pruning: only pages of the selected sources' hosts go on (semi-join with
    # the small host set, which AQE broadcasts after measuring it)
    fetched = pages.where(F.coalesce(F.col("html"), F.lit("")) != "").withColumn("host", P.url_host("url"))
    wanted = fetched.join(srcs.select("host").distinct(), "host", "left_semi")
    if listings is None:
        joined = srcs.join(P.current_page(wanted), "host", "inner")
    else:
        urls = listings.where("source_name is not null and url is not null").select("source_name", "url").distinct()
        copies = P.newest_copies(fetched.drop("host").join(urls.select("url").distinct(), "url", "left_semi"))
        listed = P.multi_page_union(srcs.join(urls, "source_name"), copies)
        other = srcs.join(urls, "source_name", "left_anti").join(P.current_page(wanted), "host", "inner")
        joined = other.unionByName(listed)
    # html of the selected sources, written once and split by profile: each branch below reads
    # its own part, with the patterns of one profile only
    path = scratch_path(pages.sparkSession, "site-pages")
    joined.select("source_rank", "source_name", "profile", "page_id", "url", "html").write.partitionBy("profile").parquet(path)
    stored = pages.sparkSession.read.schema(joined.select("source_rank", "source_name", "page_id", "url", "html", "profile").schema).parquet(path)

    def of(*names):
        return evenly(stored.where(F.col("profile").isin(*names)), "source_name", "page_id")

    def texts(rows, text):
        return rows.select("source_rank", "source_name", "profile", "page_id", *(("url",) if keep_url else ()), text.alias("text"))

    framed = P.frame_resolve(stored.where("profile = 'frame'"), pages).drop("frame_url")
    generic = evenly(stored.where(~F.col("profile").isin("cards", "items", "lines", "frame")).unionByName(framed), "source_name", "page_id")
    lines = of("lines").withColumn("_lines", HT.content_lines("html"))
    return P.union_all([texts(of("cards"), card_text("html", place)), texts(of("items"), items_text("html", "source_name")),
                        texts(lines, HT.line_dedup_consecutive("_lines")), texts(generic, HT.page_text("html"))])


# -- listing sources -> candidates ----------------------------------------------------

def listing_units(card_pages: DataFrame, place: str = L.DEFAULT_PLACE,
                  source_cols=("source_rank", "source_name")) -> DataFrame:
    """Card listing pages of sources -> text units (source, page, text)."""
    cards = L.listing_filter_place(L.listing_cards(card_pages, keep=(*source_cols, "page")), place)
    return L.listing_text(L.listing_lines(cards, source_cols, "page"), source_cols, "page")


def units_to_chunks(units: DataFrame, unit_col: str = "page", max_chars: int = C.MAX_CHARS, halo: int = 0) -> DataFrame:
    """Envelope every unit's text (X1) and chunk it (X2) with source-wide chunk order; ``halo``
    lines of the neighbouring chunks go along for extraction."""
    env = units.select("source_rank", "source_name", unit_col,
                       C.site_envelope(F.col("source_name"), F.col("text")).alias("text"))
    ch = C.chunk_lines(env, "text", keep=["source_rank", "source_name", unit_col], max_chars=max_chars, halo=halo)
    return ch.select("source_rank", "source_name",
                     (F.col(unit_col).cast("decimal(20,0)") * F.lit(CHUNK_STRIDE).cast("decimal(10,0)")
                      + F.col("chunk_idx")).cast("decimal(30,0)").alias("chunk_idx"),
                     "chunk", *(("before", "after") if halo else ()))


def listing_events(card_pages: DataFrame, place: str = L.DEFAULT_PLACE) -> DataFrame:
    """Candidate events of card listing sources (native extraction)."""
    return X.extract_native(units_to_chunks(listing_units(card_pages, place), halo=X.HALO))
