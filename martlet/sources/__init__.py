"""Sources and sinks: typed CSV/Parquet scans, the testdata binding, table/view sinks."""

from martlet.sources.files import read_csv, read_parquet  # noqa: F401
from martlet.sources.testdata import bronze_tables, read_table  # noqa: F401
