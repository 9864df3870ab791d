"""Command line: one run from registry + pages to calendar folders.

    python -m calforge --pages PAGES.parquet --registry CONFIG.json --out OUT_DIR \
        [--profiles PROFILES.csv] [--as-of YYYY-MM-DD] [--sources NAME ...] [--candidates DIR] [--single-file]

``--registry`` is the JSON config form (``{"sources": [...]}``); ``--profiles`` is a
CSV with ``name,profile`` (sources without a row use the generic profile);
``--sources`` is the manual source list (only those run, whatever their flag).
Prints the per-category counts.
"""

from __future__ import annotations

import argparse
import datetime as dt

from calforge.plans.calendar_run import build_calendars, extract_candidates
from calforge.session import get_session
from calforge.sources.registry import read_registry


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="calforge")
    ap.add_argument("--pages", required=True)
    ap.add_argument("--registry", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--profiles")
    ap.add_argument("--listings", help="CSV with source_name,url: sources read from several pages")
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    ap.add_argument("--sources", nargs="*")
    ap.add_argument("--candidates", help="where to keep the extracted candidates (default: shared folder)")
    ap.add_argument("--single-file", action="store_true", help="one file per category instead of one per month")
    ap.add_argument("--master", help="only for local runs; on a cluster the submit settings apply")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    registry = read_registry(spark, args.registry)
    if args.profiles:
        profiles = spark.read.option("header", True).csv(args.profiles).select("name", "profile")
    else:
        profiles = spark.createDataFrame([], "name string, profile string")
    override = None
    if args.sources is not None:
        override = spark.createDataFrame([(n,) for n in args.sources], "name string")
    listings = None
    if args.listings:
        listings = spark.read.option("header", True).csv(args.listings).select("source_name", "url")
    pages = spark.read.parquet(args.pages).select("page_id", "url", "html")
    cand = extract_candidates(spark, registry, profiles, pages, args.as_of, override=override,
                              path=args.candidates, listings=listings)
    counts = build_calendars(spark, cand, args.out, args.as_of, single_file=args.single_file)
    for r in counts.orderBy("category").collect():       # five rows at most
        print(f"[{r.category}] {r.n_events} events, {r.written} written "
              f"({r.global_dup} duplicates, {r.bad_time} bad start times, {r.no_date} without date)")


if __name__ == "__main__":
    main()
