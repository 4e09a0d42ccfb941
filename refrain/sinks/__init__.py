"""Writers: files, published datasets and catalog tables."""

from refrain.sinks.csv import write_csv
from refrain.sinks.publish import publish, publish_all
from refrain.sinks.tables import LoadReport, load_table

__all__ = ["LoadReport", "load_table", "publish", "publish_all", "write_csv"]
