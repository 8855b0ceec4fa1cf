"""Session helpers of the text operators: intermediate tables in the shared folder, and batch size."""

from __future__ import annotations

from pyspark.sql import SparkSession

from examlytics.session import discard, keep, shared_dir

__all__ = ["discard", "keep", "shared_dir", "text_batches"]

TEXT_ROWS = "1000"


def text_batches(spark: SparkSession) -> None:
    """Rows hold whole texts: exchange fewer of them at a time with Python workers than the default 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)
