"""Parquet scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def scan_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Files with differing schemas as one table; a column a file lacks is null."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def scan_batched(df: DataFrame, per_batch: Callable, schema, batch_rows: int = 1000) -> DataFrame:
    """Apply ``per_batch(RecordBatch) -> RecordBatch`` to Arrow batches of at most ``batch_rows`` rows.

    For row work that has no native expression. The scan itself stays
    columnar and reads only the columns of ``df``.
    """
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                yield per_batch(batch.slice(start, batch_rows))

    return df.mapInArrow(run, schema)
