"""File sinks (SC7, SC8). Paths live in the shared folder (``spark.checkpoint.dir``)
or wherever the caller points; never a machine-local temp folder on a cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.operators.feed import LINE_COLS, event_lines, ics_envelope
from calforge.operators.ordinal import dense_index
from calforge.session import stored_table

#: Events of one calendar.
EVENTS_PER_CALENDAR = 10_000
SORT_COLS = ("category", "part", "source_rank", "chunk_idx", "event_idx", "line_no")


def source_key(name_col: str = "source_name"):
    """File key of a source: blanks become '_'."""
    return F.replace(F.col(name_col), F.lit(" "), F.lit("_"))


def text_sink(site_text: DataFrame, path: str, name_col: str = "source_name") -> None:
    """SC7: every cleaned text, one folder per source, replaced on each run (dynamic
    partition overwrite: sources not in this run keep their last dump)."""
    (site_text.select(source_key(name_col).alias("source_key"), "text")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source_key").text(path))


def read_text_sink(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")


def with_pieces(body: DataFrame, events: int = EVENTS_PER_CALENDAR, pieces: int | None = None) -> DataFrame:
    """Adds ``at`` and ``piece``: the events of a month (``build_months``) cut into as many calendars
    as hold ``events`` events each (or into ``pieces`` calendars), in the order of their starts.

    ``at`` is an event's position in the order of all events (month, start, place), from one range
    partitioning (``dense_index``), so that a start shared by a third of all events is cut as well
    and calendars of a month differ by one event at most, however many there are. What is sent
    to every task is one row for each category and month: its size and first position."""
    body = stored_table(body, "month-events")    # read for the ranges' samples and for its rows
    placed = dense_index(body, ("category", "month", "start", "source_rank", "chunk_idx", "event_idx"), "at")
    sizes = placed.groupBy("category", "month").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    wanted = F.ceil(F.col("_n") / events) if pieces is None else F.lit(pieces).cast("bigint")
    piece = F.expr("(at - _first) * _wanted div _n").cast("int")
    return (placed.join(F.broadcast(sizes.withColumn("_wanted", wanted)), ["category", "month"])
            .withColumn("piece", piece).drop("_first", "_n", "_wanted"))


def ics_sink(lines: DataFrame, path: str, single_file: bool = False, pieces: int | None = None,
             events: int = EVENTS_PER_CALENDAR) -> None:
    """SC8: valid calendars as ``.ics`` files, in one layout at every size.

    Takes the events of ``build_months`` and writes the calendars of each category and month
    (``category=<name>/month=<yyyyMM>/piece=<n>``), each with its own header and footer. A month
    has as many as its events need (``with_pieces``), one after the other in the order of the
    events' starts, and so are the events within each. Events are shuffled as rows of their
    fields and become lines where their calendar is written.

    ``single_file`` takes the lines of ``build_feed`` and writes the one file per category of
    a small run (``category=<name>``): a choice of the caller, since one task then writes a
    whole category. Categories (months) absent from this run keep their previous files
    (dynamic overwrite). Every line ends with '\\n' (the reference file has no final newline)."""
    if single_file:
        calendar, order = ["category"], SORT_COLS
        dealt = lines.repartition(*calendar)
    else:
        calendar, order = ["category", "month", "piece"], ("part", "at", "line_no")
        cut = with_pieces(lines, events, pieces)
        around = ics_envelope(cut, calendar).select(*calendar, "part", "line_no", "line")
        dealt = cut.withColumn("part", F.lit(1)).unionByName(around, allowMissingColumns=True).repartition(*calendar)
        block = F.when(F.col("part") == 1, event_lines(F.col("start"), F.col("dtstamp"))).otherwise(F.array("line"))
        dealt = (dealt.select(*calendar, "part", "at", F.col("line_no").alias("_no"), F.posexplode(block).alias("_i", "line"))
                 .withColumn("line_no", F.coalesce("_no", "_i")))
    (dealt.sortWithinPartitions(*calendar, *order).select(*calendar, "line")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*calendar)
     .options(extension="ics", sep="\u0001", quote="\u0000", escape="\u0000", emptyValue="",
              ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
     .csv(path))


def read_ics_sink(spark: SparkSession, path: str) -> DataFrame:
    """Read back: one row per line with its calendar (category, and month and piece where the
    folder has them) and file name."""
    lines = spark.read.text(path)
    calendar = [c for c in lines.columns if c != "value"]
    return (lines.select(*calendar, F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("line")))


__all__ = ["LINE_COLS", "ics_sink", "read_ics_sink", "read_text_sink", "text_sink"]
