"""calforge: venue pages -> event candidates -> per-category iCalendar feeds, on Spark.

Every public operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, joins, aggregates and windows, so it runs distributed and lazily;
nothing in the library collects to the driver.

Layout:
  functions/  Column-level helpers (Unicode strip, guarded date parsing, name-based
              UUID, HTML-to-text regexes, category rules)
  sources/    registry scan, page scans, frame resolution, file sinks
  operators/  html/listing extraction, chunking, event extraction, validation and
              dedup, calendar rendering
  plans/      compositions of operators and the fixture views used by tests/queries
  streaming/  Structured Streaming versions and the upsert
"""

from calforge.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
