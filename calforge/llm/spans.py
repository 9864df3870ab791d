"""Positions of regular-expression matches as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from calforge.llm.common import let

BLOCK = 64
SPAN = "array<struct<s:int,e:int,m:string>>"


def _running(values: Column) -> Column:
    """Sums of all values up to each one, within one short array."""
    grow = F.aggregate(values, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    return let(grow, lambda g: F.slice(g, F.lit(2), F.size(g)))


def running_sums(values: Column) -> Column:
    """Inclusive running sums of a non-empty int array. Done in blocks, and then over the
    blocks, so that the array that grows stays short however many values there are."""
    def whole(v):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                             lambda i: _running(F.slice(v, i * BLOCK + 1, F.lit(BLOCK))))
        return let(blocks, lambda bs: let(
            _running(F.transform(bs, lambda b: F.element_at(b, -1))),
            lambda ends: F.flatten(F.zip_with(bs, ends, lambda b, end: F.transform(
                b, lambda x: x + end - F.element_at(b, -1))))))
    return let(values, whole)


def find_spans(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches of a pattern that never matches nothing, as
    ``array<struct<s, e, m>>`` in code points. The pieces between matches (``split``) and
    the matches alternate, so running sums of their lengths are the positions. The second
    scan happens only where there is a match."""
    def placed(ms):
        gaps = F.split(text, pattern, -1)
        both = F.zip_with(gaps, ms, lambda g, m: F.struct(
            (F.length(g) + F.coalesce(F.length(m), F.lit(0))).alias("n"), m.alias("m")))
        return let(F.slice(both, F.lit(1), F.size(ms)), lambda xs: F.zip_with(
            running_sums(F.transform(xs, lambda x: x["n"])), xs,
            lambda end, x: F.struct((end - F.length(x["m"])).alias("s"), end.alias("e"), x["m"].alias("m"))))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda ms: F.when(F.size(ms) > 0, placed(ms)).otherwise(F.array().cast(SPAN)))
