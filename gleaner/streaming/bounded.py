"""First-seen keys with state that does not grow, and a lane for what comes too late for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.session import path_exists
from gleaner.streaming.ingest import run_to_end


def _late_lane(target: str, keys: Sequence[str], ts: str, delay: str):
    """Rows further behind the newest one so far than ``delay``, a key once per micro-batch; a repeated batch replaces its folders."""
    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = batch.agg(F.max(ts)).first()[0]
        if path_exists(spark, f"{target}/newest"):
            # One row per micro-batch.
            before = (spark.read.parquet(f"{target}/newest").where(F.col("batch_id") < batch_id)
                      .agg(F.max("newest")).first()[0])
            newest = max(filter(None, (newest, before)), default=None)
        late = batch.where(F.col(ts) < F.lit(newest) - F.expr(f"INTERVAL {delay}"))
        late.select(*keys).distinct().write.mode("overwrite").parquet(f"{target}/late/batch_id={batch_id}")
        (spark.createDataFrame([(newest,)], "newest timestamp").coalesce(1)
         .write.mode("overwrite").parquet(f"{target}/newest/batch_id={batch_id}"))
    return save


def bounded_first_seen(events: DataFrame, target: str, checkpoint: str, keys: Sequence[str], delay: str = "1 day",
                       ts: str = "ts") -> list[int]:
    """Work off a stream: the keys of its events below ``target``, read by :func:`seen_keys`.

    Keys that come again within ``delay`` are dropped by Spark's own operator, whose state holds the keys of that time
    and no more. Rows that are later than that, which the operator leaves out, go through a lane of their own.
    A second run goes on where the first ended. Returns the rows of state after each micro-batch.
    """
    first = events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys)).select(*keys)
    query = run_to_end(first.writeStream.format("parquet").outputMode("append")
                       .option("checkpointLocation", f"{checkpoint}/first").option("path", f"{target}/first"))
    run_to_end(events.writeStream.foreachBatch(_late_lane(target, keys, ts, delay))
               .option("checkpointLocation", f"{checkpoint}/late"))
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def seen_keys(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Each key once, null keys too: those of the state's lane, and late ones that it does not have."""
    schema = spark.read.parquet(f"{target}/first").select(*keys).schema
    first = spark.read.schema(schema).parquet(f"{target}/first").distinct()
    late = spark.read.schema(schema).parquet(f"{target}/late").select(*keys).distinct().withColumnsRenamed(
        {k: f"_{k}" for k in keys})
    here = [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in keys]
    missing = late.join(first, here, "left_anti").select(*[F.col(f"_{k}").alias(k) for k in keys])
    return first.union(missing)
