"""Category rules: first rule with any keyword contained in the lowered, stripped label.

The rule list is a parameter; the default reproduces the reference's behaviour.
Quirks that follow from substring matching and rule order (pinned in tests):
'Tanztheater' -> party, 'Musiktheater' -> theater, 'Opera'/'Kooperation' -> theater,
'Discovery' -> party. A NULL label (non-string in the source) -> the fallback.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from calforge.functions.text import ustrip, ustrip_sql

# Ordered (category, keywords) rules and the fallback category.
DEFAULT_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("party", ("party", "disco", "club", "tanz")),
    ("theater", ("theater", "comedy", "kabarett", "oper", "musical", "schauspiel", "bühne", "hypnose")),
    ("musik", ("musik", "konzert", "live", "band", "tribute", "show")),
    ("kultur", ("kultur", "ausstellung", "lesung", "vortrag", "museum", "führung", "markt", "messe",
                "slam", "leseflair")),
)
FALLBACK = "sonstiges"

# The calendar buckets in output order (rank = position).
CATEGORIES: tuple[str, ...] = ("party", "kultur", "musik", "theater", "sonstiges")


def label(col) -> Column:
    """The text the rules look at: lowered and stripped."""
    return F.lower(ustrip(F.col(col) if isinstance(col, str) else col))


def _sql_quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def classify_label(label_col, rules=DEFAULT_RULES, fallback: str = FALLBACK) -> Column:
    """Rules over an already lowered/stripped label. Keep the label a column of its
    own (``withColumn``) so the strip runs once per row, not once per keyword. For a
    named column the rule chain is one SQL expression (one call to build it)."""
    if isinstance(label_col, str):
        ref = "`" + label_col.replace("`", "``") + "`"
        whens = " ".join(
            "WHEN " + " OR ".join(f"contains({ref}, {_sql_quote(kw)})" for kw in kws) + f" THEN {_sql_quote(cat)}"
            for cat, kws in rules)
        return F.expr(f"coalesce(CASE {whens} ELSE {_sql_quote(fallback)} END, {_sql_quote(fallback)})")
    lab = label_col
    expr = None
    for category, keywords in rules:
        cond = None
        for kw in keywords:
            hit = lab.contains(kw)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return F.coalesce(expr.otherwise(F.lit(fallback)), F.lit(fallback))


def classify(col, rules=DEFAULT_RULES, fallback: str = FALLBACK) -> Column:
    return classify_label(label(col), rules, fallback)


def classify_sql(expr: str, rules=DEFAULT_RULES, fallback: str = FALLBACK) -> str:
    label = f"lower({ustrip_sql(expr)})"
    whens = []
    for category, keywords in rules:
        cond = " OR ".join(f"contains({label}, '{kw}')" for kw in keywords)
        whens.append(f"WHEN {cond} THEN '{category}'")
    return f"coalesce(CASE {' '.join(whens)} ELSE '{fallback}' END, '{fallback}')"


def category_rank(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, cat in enumerate(CATEGORIES):
        expr = F.when(c == cat, F.lit(i)) if expr is None else expr.when(c == cat, F.lit(i))
    return expr


def category_rank_sql(expr: str) -> str:
    whens = " ".join(f"WHEN {expr} = '{cat}' THEN {i}" for i, cat in enumerate(CATEGORIES))
    return f"(CASE {whens} END)"


def bucket(col) -> Column:
    """Calendar bucket: ``lower(category)`` if it names a bucket, else the fallback
    (not stripped; NULL/missing -> fallback)."""
    low = F.lower(F.col(col) if isinstance(col, str) else col)
    return F.when(low.isin(*CATEGORIES), low).otherwise(F.lit(FALLBACK))


def bucket_sql(expr: str) -> str:
    cats = ", ".join(f"'{c}'" for c in CATEGORIES)
    return f"(CASE WHEN lower({expr}) IN ({cats}) THEN lower({expr}) ELSE '{FALLBACK}' END)"
