"""State that a stream's batches hand on: one version of a small table, in two slots.

Batch n writes slot n % 2 and reads what the batch before left in the other one. A repeated batch finds the
state it started from untouched and replaces its own, and the number of files stays the same however many batches
there have been. A row without values marks a state that is empty.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from stationlake.plans.daily_state import stored_days


def left_by_last_batch(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """The state that the last batch before ``batch_id`` left (no rows ahead of the first batch)."""
    fields = StructType.fromDDL(schema)
    slots = [os.path.join(path, f"slot={k}") for k in stored_days(spark, path, "slot")]
    if not slots:
        return spark.createDataFrame([], fields)
    stored = StructType(fields.fields).add("batch_id", LongType()).add("used", "boolean")
    rows = spark.read.schema(stored).parquet(*slots).where(F.col("batch_id") < batch_id)
    last = rows.agg(F.max("batch_id")).first()[0]
    return rows.where((F.col("batch_id") == F.lit(last)) & F.col("used")).select(*fields.fieldNames())


def leave(rows: DataFrame, path: str, schema: str, batch_id: int) -> None:
    """Write the state after a batch."""
    fields = StructType.fromDDL(schema)
    mark = rows.sparkSession.createDataFrame([(None,) * len(fields)], fields).withColumn("used", F.lit(False))
    (rows.select(*fields.fieldNames()).withColumn("used", F.lit(True)).unionByName(mark).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .coalesce(1).write.mode("overwrite").parquet(os.path.join(path, f"slot={batch_id % 2}")))
