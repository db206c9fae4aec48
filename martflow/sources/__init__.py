"""Sources: the delivered CSV files (batch and stream) and the parquet test
tables, each mapped onto the same logical feed."""

from martflow.sources.feed import Feed  # noqa: F401
