"""Publishing datasets to an object store or any other file system."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from refrain.sinks.csv import csv_files, write_csv
from refrain.sources.versions import write_version, write_versions

log = logging.getLogger(__name__)

# Fixed value: how often a publication is tried.
ATTEMPTS = 3


def write_parquet(df: DataFrame, path: str) -> None:
    """As a new version; what was there stays until that is whole."""
    write_version(df, path, _parquet_files)


def _parquet_files(df: DataFrame, folder: str) -> None:
    df.write.parquet(folder)


WRITERS = {"csv": write_csv, "parquet": write_parquet}
_FILES = {"csv": csv_files, "parquet": _parquet_files}


def publish(
    df: DataFrame, uri: str, fmt: str = "csv", attempts: int = ATTEMPTS, write=None
) -> None:
    """Write a dataset to ``uri`` as a new version, again from the start if it fails.

    Lost tasks and executors are already retried by Spark; this covers a job
    that failed altogether. The last failure is raised, and then readers of ``uri``
    still get the version before. A dataset that cannot be
    analysed, such as one whose source is missing, is not tried again.
    """
    write = write or WRITERS[fmt]
    for attempt in range(1, attempts + 1):
        try:
            write(df, uri)
            log.info("published %s", uri)
            return
        except AnalysisException:
            raise
        except Exception:
            log.exception("attempt %d to publish %s failed", attempt, uri)
            if attempt == attempts:
                raise


def publish_all(
    datasets: Mapping[str, DataFrame],
    fmt: str = "csv",
    attempts: int = ATTEMPTS,
    journal: str | None = None,
) -> None:
    """Publish several datasets at the same time, by target URI.

    One that fails does not stop the others; the first failure is raised once
    all have ended. With a ``journal``, a folder that the targets share, readers see
    the new versions of all of them or of none, and a failed try begins all again.
    """
    if not datasets:
        return
    spark = next(iter(datasets.values())).sparkSession
    if journal:

        def together(_, __):
            write_versions(datasets, _FILES[fmt], journal, lambda runs: _side_by_side(spark, runs))

        publish(next(iter(datasets.values())), journal, fmt, attempts, together)
        return
    run = inheritable_thread_target(spark)(publish)
    with ThreadPoolExecutor(len(datasets)) as pool:
        futures = [
            pool.submit(run, df, uri, fmt, attempts) for uri, df in datasets.items()
        ]
    for future in futures:
        future.result()


def _side_by_side(spark, runs) -> None:
    run = inheritable_thread_target(spark)(lambda f: f())
    with ThreadPoolExecutor(len(runs)) as pool:
        futures = [pool.submit(run, f) for f in runs]
    for future in futures:
        future.result()
