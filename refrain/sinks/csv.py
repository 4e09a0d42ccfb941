"""CSV with a header, written as a new version of its target."""

from __future__ import annotations

from pyspark.sql import DataFrame

from refrain.sources.csv import DIALECT
from refrain.sources.versions import write_version

# Keep values exactly: no trimming, and empty text as an empty field.
EXACT = {
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# A blank value of a single column would be a blank line, which readers skip.
QUOTED_BLANKS = {"emptyValue": '""', "nullValue": '""', "quoteAll": True}


def csv_files(df: DataFrame, path: str) -> None:
    blanks = QUOTED_BLANKS if len(df.columns) == 1 else {}
    df.write.options(**DIALECT, **(EXACT | blanks), header=True).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """One file per partition; returns the folder of the new version.

    What was there stays until the new version is whole.
    """
    return write_version(df, path, csv_files)
