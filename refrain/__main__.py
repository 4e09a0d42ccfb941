"""The jobs from the command line, for ``spark-submit`` or ``python -m refrain``.

    python -m refrain prepare ITEMS ENTITIES ITEMS_TARGET ENTITIES_TARGET
    python -m refrain publish ITEMS ENTITIES ITEMS_URI ENTITIES_URI
    python -m refrain load ITEMS_URI ENTITIES_URI
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import SparkSession

from refrain.plans import jobs
from refrain.schemas import MIN_DURATION_MS
from refrain.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="refrain", description=__doc__)
    steps = parser.add_subparsers(dest="job", required=True)

    def step(name: str, *paths: str) -> argparse.ArgumentParser:
        added = steps.add_parser(name)
        for path in paths:
            added.add_argument(path)
        added.add_argument("--multi-line", action="store_true", help="line breaks inside quotes")
        return added

    prepare = step("prepare", "items_source", "entities_source", "items_target", "entities_target")
    prepare.add_argument("--min-duration", type=float, default=MIN_DURATION_MS)
    prepare.add_argument("--fmt", choices=("csv", "parquet"), default="parquet")
    prepare.add_argument("--rejects-target")
    prepare.add_argument("--raw-lists-target")
    publish = step("publish", "items_path", "entities_path", "items_uri", "entities_uri")
    publish.add_argument("--fmt", choices=("csv", "parquet"), default="csv")
    publish.add_argument("--prepared-fmt", choices=("csv", "parquet"), default="parquet")
    load = step("load", "items_uri", "entities_uri")
    load.add_argument("--fmt", choices=("csv", "parquet"), default="csv")
    load.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    load.add_argument("--on-bad", choices=("fail", "null"), default="fail")
    load.add_argument("--items-table", default=jobs.ITEMS_TABLE)
    load.add_argument("--entities-table", default=jobs.ENTITIES_TABLE)
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run one job and print its report as JSON lines."""
    options = vars(_parser().parse_args(arguments))
    job = getattr(jobs, f"{options.pop('job')}_catalogue")
    reports = job(spark or build_session("refrain"), **options)
    for report in reports if isinstance(reports, list) else [reports] * bool(reports):
        print(json.dumps(asdict(report)))


if __name__ == "__main__":
    main()
