"""Pages -> plain text (H1-H6). Row-local expressions only: no shuffle, no Python.

``page_text`` is the generic profile (drop noise subtrees, text nodes joined by line
breaks, blank-normalised lines). ``content_text`` is the content-node profile: take
the first content element, drop a wider noise set, strip lines (no two-blank split)
and collapse consecutive repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.functions import html as H
from calforge.functions.text import normalise_lines, normalise_lines_sql

# Content elements tried in order (tag, id); the whole page otherwise.
CONTENT_ELEMENTS: tuple[tuple[str, str | None], ...] = (("div", "content"), ("main", None))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- H1/H2/H3/H4 ---------------------------------------------------------------------

def strip_blocks(col, tags=H.NOISE_TAGS, void_tags=()) -> Column:
    """H1: drop whole noise subtrees, nested and unclosed ones as a parser ends them (each
    becomes a line break)."""
    return H.strip_blocks(_c(col), tags, void_tags)


def html_to_text(col) -> Column:
    """H2: comments/tags -> line breaks, entities decoded (not yet normalised)."""
    return H.tags_to_breaks(_c(col))


def text_normalise(col, split_double_space: bool = True) -> Column:
    """H3: splitlines -> strip -> split on two blanks -> strip -> drop empty."""
    return normalise_lines(_c(col), split_double_space)


def page_text(col) -> Column:
    """H4 = H3 . H2 . H1 in one pass over the page's tokens; NULL/'' html -> ''."""
    return text_normalise(H.text_nodes(F.coalesce(_c(col), F.lit(""))))


def page_text_sql(expr: str) -> str:
    return normalise_lines_sql(H.tags_to_breaks_sql(H.strip_blocks_sql(f"coalesce({expr}, '')")))


# -- H5/H6 ---------------------------------------------------------------------------

def element_inner(col, tag: str, elem_id: str | None = None) -> Column:
    """Inner html of the first ``<tag [id=...]>``, nesting respected; NULL without one."""
    return H.inner_html(col, tag, H.start_id_re(tag, elem_id))


def main_content(col, elements=CONTENT_ELEMENTS) -> Column:
    """H5: inner html of the first matching content element (nesting respected),
    else the whole page."""
    c = _c(col)
    out = c
    for tag, elem_id in reversed(elements):
        out = F.coalesce(element_inner(c, tag, elem_id), out)
    return out


def main_content_sql(expr: str, elements=CONTENT_ELEMENTS) -> str:
    """Oracle form, flat (up to the first closing tag): equal to ``main_content``
    whenever the element contains no element of the same name, as in the fixture
    pages; nesting itself is covered by a unit test."""
    out = expr
    for tag, elem_id in reversed(elements):
        pat = H.start_id_re_sql(tag, elem_id) + rf"(.*?)</{tag}\s*>"
        out = f"CASE WHEN regexp_matches({expr}, '{pat}') THEN regexp_extract({expr}, '{pat}', 1) ELSE {out} END"
    return out


def line_dedup_consecutive(col) -> Column:
    """H6: keep a line only if it differs from the line before it (lines already
    stripped and non-empty, so 'previous kept' = 'previous'). The line array is
    compared with itself shifted by one (``zip_with``); dropped lines become NULL,
    which ``array_join`` skips."""
    lines = F.split(_c(col), "\n")
    prev = F.concat(F.array(F.lit(None).cast("string")), F.slice(lines, 1, F.size(lines) - 1))
    kept = F.zip_with(lines, prev, lambda x, p: F.when(p.isNull() | (x != p), x))
    return F.array_join(kept, "\n")


def line_dedup_consecutive_sql(expr: str) -> str:
    return (f"array_to_string(list_filter(string_split({expr}, chr(10)), "
            f"lambda x, i: i = 1 OR x <> string_split({expr}, chr(10))[i - 1]), chr(10))")


def content_text(col, elements=CONTENT_ELEMENTS) -> Column:
    """Content-node profile: H5 -> wider H1 -> H2 -> strip lines -> H6. Inside a
    bigger projection prefer ``with_content_text`` (the collapse reads its input
    three times)."""
    return line_dedup_consecutive(content_lines(col, elements))


def content_text_sql(expr: str, elements=CONTENT_ELEMENTS) -> str:
    c = main_content_sql(f"coalesce({expr}, '')", elements)
    c = H.strip_blocks_sql(c, H.CONTENT_NOISE_TAGS, H.VOID_NOISE_TAGS)
    return line_dedup_consecutive_sql(normalise_lines_sql(H.tags_to_breaks_sql(c), split_double_space=False))


def content_lines(col, elements=CONTENT_ELEMENTS) -> Column:
    """Content-node profile before the repeat collapse (stripped, non-empty lines)."""
    c = main_content(F.coalesce(_c(col), F.lit("")), elements)
    return text_normalise(H.text_nodes(c, H.CONTENT_NOISE_TAGS), split_double_space=False)


def with_page_text(df: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    return df.withColumn(out, page_text(html_col))


def with_content_text(df: DataFrame, html_col: str = "html", out: str = "text",
                      elements=CONTENT_ELEMENTS) -> DataFrame:
    """Content-node profile as two projections: the line collapse reads its input
    three times, so the input is a column of its own (computed once per row)."""
    return (df.withColumn("_content_lines", content_lines(html_col, elements))
            .withColumn(out, line_dedup_consecutive("_content_lines")).drop("_content_lines"))
