"""Run all layers from a JSON settings file: ``python -m retail_layers --config settings.json``.

This is the one place that reads the clock, for the two dates a run is given.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from retail_layers.plans import layers
from retail_layers.sinks.writers import sink_kind, stored, summary
from retail_layers.sources.settings import for_environment


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="retail_layers", description="Build silver and gold from the sources.")
    parser.add_argument("--config", type=Path, default=Path("settings.json"), help="JSON file with 'environments'")
    parser.add_argument("--env", default="dev", help="which environment of the file to use")
    parser.add_argument("--as-of", type=date.fromisoformat, default=None, help="day that counts as today")
    parser.add_argument("--null-token", action="append", default=[], help="text that means NULL; may be repeated")
    parser.add_argument("--show-summary", action="store_true", help="show schema and row count of every table read back")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> dict[str, int]:
    args = parse(argv)
    settings = for_environment(json.loads(args.config.read_text()), args.env)
    spark = SparkSession.builder.appName("retail_layers").getOrCreate()
    rows = layers.run(spark, settings, args.as_of or date.today(), datetime.now(), args.null_token)
    for name, count in rows.items():
        print(f"{name}: {count} rows")
    if args.show_summary:
        for layer in ("silver", "gold"):
            if sink_kind(settings[layer]) == "jdbc":
                print(f"{layer}: not read back from a JDBC sink")
                continue
            names = [n for n in rows if n.startswith("gold_") == (layer == "gold")]
            summary(stored(spark, names, settings[layer]), rows).show(len(names), truncate=False)
    return rows


if __name__ == "__main__":
    main()
