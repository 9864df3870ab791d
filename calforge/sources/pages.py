"""Page scans (SC3-SC6): the fetched-page table replaces live fetching.

Pages: ``page_id BIGINT, url STRING, html STRING``; a NULL or '' html means the
fetch failed and the page is skipped. A source's pages are the pages of its host.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.functions import html as H
from calforge.session import spread, stored_table
from calforge.sources.lookup import MOST_SENT, few, rows_with_keys

URL_HOST_RE = r"\A[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)"
URL_ROOT_RE = r"\A([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
IFRAME_TAG_RE = rf"(?is)<iframe(?:[\s/]{H.ATTRS})?>"


def url_host(col) -> Column:
    return F.regexp_extract(F.col(col) if isinstance(col, str) else col, URL_HOST_RE, 1)


def page_scan(spark: SparkSession, path: str, columns=("page_id", "url", "html"),
              spread_rows: bool = False) -> DataFrame:
    """SC3: Parquet page table; only the needed columns are read (ReadSchema) and the
    'fetch failed' filter is a plain predicate next to the scan. ``spread_rows`` for
    heavy per-row work right after the scan of small files (see ``session.spread``)."""
    pages = (spark.read.parquet(path).select(*columns)
             .where(F.col("html").isNotNull() & (F.col("html") != "")))
    return spread(pages) if spread_rows else pages


def page_scan_landing(spark: SparkSession, path: str) -> DataFrame:
    """SC3, landing-folder form: one raw html file per page (whole file per row)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
            .where(F.col("html") != ""))


def current_page(pages: DataFrame) -> DataFrame:
    """SC4: the newest snapshot (highest page_id) of every source host.

    Two steps so page html never goes through an aggregate: ``max(page_id)`` per
    host is a hash aggregate on fixed-width values (combined map-side, one row per
    host), then the pages are semi-joined on (host, page_id). When the host table is
    small AQE broadcasts it after measuring it, and the page table is filtered in
    place without a shuffle."""
    hosted = pages if "host" in pages.columns else pages.withColumn("host", url_host("url"))
    newest = hosted.groupBy("host").agg(F.max("page_id").alias("page_id"))
    return hosted.join(newest, ["host", "page_id"], "left_semi").select("host", "page_id", "url", "html")


def newest_copies(pages: DataFrame) -> DataFrame:
    """The newest copy (highest page_id) of every url; as in ``current_page``, html never
    goes through an aggregate."""
    newest = pages.groupBy("url").agg(F.max("page_id").alias("page_id"))
    return pages.join(newest, ["url", "page_id"], "left_semi")


def multi_page_union(source_urls: DataFrame, pages: DataFrame) -> DataFrame:
    """SC5: a source made of several listing URLs: one scan joined to the
    (source, url) table; missing pages simply have no row."""
    return source_urls.join(pages, "url", "inner").select(*source_urls.columns, "page_id", "html")


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def iframe_src(html) -> Column:
    """The src attribute of the first ``<iframe>`` outside comments, references decoded;
    NULL when there is no iframe, no src or an empty one."""
    h = F.col(html) if isinstance(html, str) else html
    tag = F.regexp_extract(F.regexp_replace(h, H.COMMENT_RE, ""), IFRAME_TAG_RE, 0)
    return H.let(tag, lambda t: F.when(t != "", F.nullif(H.attribute(t, "src"), F.lit(""))))


def resolve_src(src, page_url) -> Column:
    """Absolute if it starts with 'http', else the page's site root plus the path
    (adding '/' when needed)."""
    s = F.col(src) if isinstance(src, str) else src
    u = F.col(page_url) if isinstance(page_url, str) else page_url
    root = F.regexp_extract(u, URL_ROOT_RE, 1)
    return (F.when(s.startswith("http"), s)
             .when(s.startswith("/"), F.concat(root, s))
             .when(s.isNotNull(), F.concat(root, F.lit("/"), s)))


def frame_url(html: str = "html", url: str = "url") -> Column:
    """SC6 url part: where a page's frame points, NULL without a frame. The patterns are only
    tried where the html holds the word."""
    src = F.when(F.lower(html).contains("<iframe"), iframe_src(html))
    return H.let(src, lambda s: resolve_src(s, url))


def with_frame_url(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    return pages.withColumn("frame_url", frame_url(html, url))


def frame_refs(pages: DataFrame) -> DataFrame:
    """``page_id, frame_url`` of the pages that embed a frame. The url comes out of a generator,
    which no filter can pass, so the frame patterns run once for each page."""
    found = F.filter(F.array(frame_url()), lambda u: u.isNotNull())
    return pages.select("page_id", F.explode(found).alias("frame_url"))


def frame_resolve(pages: DataFrame, lookup: DataFrame | None = None, most: int = MOST_SENT) -> DataFrame:
    """SC6: a page that embeds a frame is replaced by the framed page's html, even
    when that is missing (-> ''); pages without a frame keep their html. Adds ``frame_url``.

    The references are found first and stored (ids and urls, no html). The newest copy
    (highest page_id, unique in the table) of every wanted url is chosen on urls and ids alone,
    of the wanted urls only. Then html is read in place: of the targets, by their ids, and of
    the pages without a frame, by the ids of those with one. The only html that is shuffled is
    that of targets, and of pages the tables of ids are too long to be sent for."""
    lookup = pages if lookup is None else lookup
    refs = stored_table(frame_refs(pages).distinct(), "frame-refs")
    urls = stored_table(refs.select("frame_url").distinct(), "frame-urls")
    newest = rows_with_keys(lookup.select("url", "page_id"), "url", urls, most).groupBy(F.col("url").alias("frame_url")).agg(
        F.max("page_id").alias("_frame_id"))
    targets = stored_table(newest, "frame-targets")
    html = rows_with_keys(lookup.select("page_id", "html"), "page_id", targets.select("_frame_id"), most).select(
        F.col("page_id").alias("_frame_id"), F.col("html").alias("_frame_html"))
    framed = pages.drop("html").join(refs, "page_id")
    resolved = (framed.join(targets, "frame_url", "left").join(html, "_frame_id", "left")
                .withColumn("html", F.coalesce(F.col("_frame_html"), F.lit(""))).drop("_frame_html", "_frame_id"))
    no_url = F.lit(None).cast("string")
    if few(refs, most):
        own = pages.join(F.broadcast(refs.select("page_id")), "page_id", "left_anti").withColumn("frame_url", no_url)
    else:      # too many to send: look again, rather than shuffle the html of all pages
        own = pages.where(frame_url().isNull()).withColumn("frame_url", no_url)
    return own.unionByName(resolved)
