"""Live availability ingestion with Structured Streaming, in two steps.

1. Intake. Raw availability files (CSV text, like the batch landing zone) arrive in a folder.
   Each micro-batch is cleaned with the same native rules as the batch silver, gets the raw station
   capacity from a static table, and is written once, by batch and status:

   * ``rejected``: lines with another number of fields (raw line kept);
   * ``timeless``: no readable time, so no place in event time;
   * ``late``: not newer than the watermark of the batches before;
   * ``on_time``: the rest.

   Nothing disappears: :func:`intake_counts` counts every line of every batch. A batch appears whole (its folder
   is renamed into place, which file systems do at once and object stores file by file).
2. Silver. The on-time readings are deduplicated on ``(station_id, timestamp)`` by the most complete
   copy, exactly like the batch: an event-time aggregation that emits a reading once the
   watermark has passed it. So a reading appears after the watermark, but it is the one that the batch
   keeps. :func:`close_input` adds a mark after the last reading so that the end of a finite
   input is emitted too.
3. Day silver. :func:`start_day_silver` merges the emitted readings, then the late and timeless ones
   (:func:`set_aside_stream`), into a table by day: the most complete copy of each reading again, touched days
   only. So the day silver is the batch silver, whatever arrives when.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (DateType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

from stationlake.operators.cleaning import SCORE, apply_rules, strip_flags
from stationlake.plans.silver import AVAILABILITY_RULES, raw_capacity
from stationlake.schemas import RAW_AVAILABILITY_COLUMNS
from stationlake.session import scratch_path
from stationlake.sources.csv import CORRUPT_RECORD, csv_options, text_schema
from stationlake.sources.sinks import write_partitioned
from stationlake.streaming.state import leave, left_by_last_batch

WATERMARK = "2 hours"
LAST_SCHEMA = "reading_time timestamp"
INTAKE_SCHEMA = StructType([
    StructField("station_id", IntegerType()), StructField("timestamp", StringType()),
    StructField("bikes_available", IntegerType()), StructField("slots_free", IntegerType()),
    StructField("capacity", StringType()), StructField(SCORE, IntegerType()),
    StructField("reading_time", TimestampType()), StructField("date_partition", DateType()),
    StructField(CORRUPT_RECORD, StringType()),
])


def read_raw_stream(spark: SparkSession, path: str, *, sep: str = ";", header: bool = True,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(text_schema(RAW_AVAILABILITY_COLUMNS, corrupt_column=True))
              .options(**csv_options(sep, header)))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def clean_readings(raw: DataFrame, raw_stations: DataFrame) -> DataFrame:
    """The batch rules on raw lines (with their corrupt-record column), before any dedup."""
    joined = raw.join(raw_capacity(raw_stations), "station_id", "left").select(
        *RAW_AVAILABILITY_COLUMNS, "capacity", CORRUPT_RECORD)
    scored = strip_flags(apply_rules(joined, AVAILABILITY_RULES, score=True))
    # the score also counts the corrupt-record column, which is NULL on every well-formed line
    return (scored.withColumn(SCORE, F.col(SCORE) - F.col(CORRUPT_RECORD).isNull().cast("int"))
            .withColumn("reading_time", F.col("timestamp").try_cast("timestamp"))
            .withColumn("date_partition", F.to_date("reading_time"))
            .select(*INTAKE_SCHEMA.fieldNames()))


def publish(rows: DataFrame, folder: str, hidden: str) -> None:
    """Write ``rows`` by status and put the finished folder in place by a rename, so that a reader of the intake sees a
    batch whole or not at all. A batch that is there already (a repeated one) stays as it is."""
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(folder)
    fs = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(to):
        return
    rows.write.mode("overwrite").partitionBy("status").parquet(hidden)
    fs.mkdirs(to.getParent())
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(hidden), to):
        raise OSError(f"cannot rename {hidden} to {folder}")


def start_intake(stream: DataFrame, raw_stations: DataFrame, intake: str, checkpoint: str, *,
                 watermark: str = WATERMARK, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Step 1: every line of every batch, written once with its status.

    A reading is late if it is not newer than the last on-time reading of the batches before minus the
    delay: the very readings that an event-time aggregation drops. That last reading is one row of state."""
    state = os.path.join(intake, "_last")

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = clean_readings(batch, raw_stations)
        last = left_by_last_batch(spark, state, LAST_SCHEMA, batch_id).agg(F.max("reading_time")).first()[0]
        limit = F.lit(last).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
        status = (F.when(F.col(CORRUPT_RECORD).isNotNull(), F.lit("rejected"))
                  .when(F.col("reading_time").isNull(), F.lit("timeless"))
                  .when(F.coalesce(F.col("reading_time") <= limit, F.lit(False)), F.lit("late"))
                  .otherwise(F.lit("on_time")))
        folder = os.path.join(intake, f"batch_id={batch_id}")
        publish(rows.withColumn("status", status), folder, os.path.join(intake, f"_batch-{batch_id}"))
        own = spark.read.schema(StructType([*INTAKE_SCHEMA, StructField("status", StringType())])).parquet(folder)
        newest = own.where("status = 'on_time'").agg(F.max("reading_time").alias("t"))
        leave(newest.select(F.greatest("t", F.lit(last).cast("timestamp")).alias("reading_time")), state, LAST_SCHEMA, batch_id)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")
    return writer.start()


def intake_counts(spark: SparkSession, intake: str) -> DataFrame:
    """batch_id, status, n: every line that the intake has read."""
    rows = spark.read.schema(INTAKE_SCHEMA).option("basePath", intake).parquet(intake)
    return rows.where(F.col("batch_id") >= 0).groupBy("batch_id", "status").agg(F.count(F.lit(1)).alias("n"))


def close_input(spark: SparkSession, intake: str, watermark: str = WATERMARK) -> None:
    """Mark the end of a finite input: one row without station and text, later than the last reading
    by more than the watermark. The silver stream passes it by."""
    rows = spark.read.schema(INTAKE_SCHEMA).option("basePath", intake).parquet(intake)
    end = (rows.where("status = 'on_time' and timestamp is not null").agg(F.max("reading_time").alias("t"))
           .select((F.col("t") + F.expr(f"INTERVAL {watermark}") + F.expr("INTERVAL 1 SECOND")).alias("reading_time"))
           .where(F.col("reading_time").isNotNull()))
    cols = [F.col("reading_time") if f.name == "reading_time" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in INTAKE_SCHEMA.fields]
    end.select(*cols).write.mode("overwrite").parquet(os.path.join(intake, "batch_id=-1", "status=on_time"))


def silver_stream(spark: SparkSession, intake: str, watermark: str = WATERMARK) -> DataFrame:
    """Step 2: the most complete copy of each reading, like the batch silver."""
    rows = (spark.readStream.schema(INTAKE_SCHEMA).parquet(os.path.join(intake, "batch_id=*", "status=on_time"))
            .withWatermark("reading_time", watermark))
    best = rows.groupBy("station_id", "timestamp", "reading_time").agg(
        F.min(F.struct(SCORE, "bikes_available", "slots_free", "capacity", "date_partition")).alias("b"))
    # the mark of the end has no score; a filter on an aggregate is not pushed below the watermark,
    # which the mark must reach
    return best.where(F.col(f"b.{SCORE}").isNotNull()).select(
        "station_id", "timestamp", "b.bikes_available", "b.slots_free", "reading_time", "b.date_partition", f"b.{SCORE}", "b.capacity")


def start_silver(silver: DataFrame, out_path: str, checkpoint: str, *, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Append the silver stream to parquet (partitioned by day). The checkpoint makes the sink
    exactly-once across restarts and lost executors."""
    writer = (silver.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).partitionBy("date_partition"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")
    return writer.start(out_path)


DAY_SILVER = StructType([
    StructField("station_id", IntegerType()), StructField("timestamp", StringType()), StructField("bikes_available", IntegerType()),
    StructField("slots_free", IntegerType()), StructField(SCORE, IntegerType()), StructField("capacity", StringType()),
    StructField("date_partition", DateType()),
])


def merge_readings(new: DataFrame, path: str) -> None:
    """Merge readings into the day silver: in the days that ``new`` touches, the most complete copy of each
    (station, time) among those stored and those new. Other days are not read; merging twice changes nothing."""
    spark = new.sparkSession
    day = F.substring("timestamp", 1, 10).try_cast("date")
    rows = new.withColumn("date_partition", day).select(*DAY_SILVER.fieldNames())
    days = [r.date_partition for r in rows.select("date_partition").distinct().collect()]
    if not days:
        return
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        touched = F.col("date_partition").isin([d for d in days if d is not None])
        if None in days:
            touched = F.coalesce(touched, F.lit(True))
        rows = rows.unionByName(spark.read.schema(DAY_SILVER).parquet(path).where(touched))
    rest = [n for n in DAY_SILVER.fieldNames() if n not in ("station_id", "timestamp")]
    best = (rows.groupBy("station_id", "timestamp").agg(F.min(F.struct(SCORE, *[n for n in rest if n != SCORE])).alias("b"))
            .select("station_id", "timestamp", *[f"b.{n}" for n in rest]).select(*DAY_SILVER.fieldNames()))
    staged = scratch_path(spark, f"day-silver-{uuid.uuid4().hex}")
    best.write.parquet(staged)
    write_partitioned(spark.read.schema(DAY_SILVER).parquet(staged), path)


def start_day_silver(rows: DataFrame, path: str, checkpoint: str, *, available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Merge every batch of a stream of readings (with score and capacity) into the day silver."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: merge_readings(batch, path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "10 minutes")
    return writer.start()


def set_aside_stream(spark: SparkSession, intake: str) -> DataFrame:
    """The intake's late and timeless readings as a stream."""
    return spark.readStream.schema(INTAKE_SCHEMA).parquet(os.path.join(intake, "batch_id=*", "status={late,timeless}"))
