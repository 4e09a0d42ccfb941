"""Readers of raw and prepared datasets."""

from refrain.sources.csv import read_prepared, read_raw
from refrain.sources.versions import VersionConflict, current, vacuum, version, write_version

__all__ = [
    "VersionConflict", "current", "read_prepared", "read_raw", "vacuum", "version", "write_version",
]
