"""Command entry: ``PYTHONPATH=. spark-submit millrace/__main__.py ingest|replay ...``, or ``python -m millrace``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from millrace.config import column_maps_from_text
from millrace.feeds import catalogue
from millrace.plans.medallion import Lake


def arguments(args: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace")
    parser.add_argument("mode", choices=["ingest", "replay"], help="inbox to bronze to silver, or bronze to silver")
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--client", required=True, help="the client's name in file names")
    parser.add_argument("--maps", help="text file of typed column maps")
    parser.add_argument("--inbox", help="folder of deliveries (ingest)")
    parser.add_argument("--batch", help="batch id; a fresh one if absent")
    found = parser.parse_args(args)
    if found.mode == "ingest" and not found.inbox:
        parser.error("ingest needs --inbox")
    return found


def main(args: Sequence[str] | None = None) -> int:
    """Run one mode; 1 if a file or table failed."""
    todo = arguments(args)
    spark = SparkSession.builder.appName(f"millrace-{todo.mode}").getOrCreate()
    maps = {}
    if todo.maps:
        maps = column_maps_from_text(r["value"] for r in spark.read.text(todo.maps).toLocalIterator())
    lake = Lake(spark, todo.lake, catalogue(todo.client, maps))
    if todo.mode == "ingest":
        outcomes = lake.ingest(todo.inbox, datetime.now(), todo.batch)
        outcomes.groupBy("status").count().show()
        failed = outcomes.where("status = 'failed'")
        failed.select("file_name", "error").show(100, truncate=False)
        return int(not failed.isEmpty())
    result = lake.replay(todo.batch)
    for table, state in sorted(result.items()):
        print(f"{table}: {state}")
    return int(any(state.startswith("failed") for state in result.values()))


if __name__ == "__main__":
    raise SystemExit(main())
