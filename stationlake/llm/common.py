"""Helpers shared by the operators: staged tables, words, folds, sampling, tables kept by workers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import scratch_path

#: The white space of every contract: space and \t \n \v \f \r.  ``bytes.split()`` cuts exactly there.
WORD = r"[^\x20\x09-\x0D]+"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the application's folder in the cluster's shared one (``spark.checkpoint.dir``)."""
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str | Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text (remainder 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % k


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches a few rows at a time, so that only so many texts become Python objects at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def labelled_sample(docs: DataFrame, labels: DataFrame, cols: list[str], rows: int) -> DataFrame:
    """``cols`` and ``label`` of at most ``rows`` labelled training documents.

    Training rows are those whose crc32 fold modulo 3 is not 1.  The labels are reduced to
    one per id (the larger one), the first ``rows`` of them by a hash of the id are taken:
    the side that is broadcast is bounded by the parameter ``rows``, whatever the table's size.
    Rows that repeat an id give one row, the first by a hash of ``cols``.
    """
    lab = (labels.select("doc_id", F.col("quality").cast("int").alias("label"))
           .where("doc_id is not null and label in (0, 1)").where(fold("doc_id", 3) != 1)
           .groupBy("doc_id").agg(F.max("label").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    one = F.min(F.struct(F.xxhash64(*cols).alias("__h"), *cols, "label"))  # combined before the shuffle
    return (docs.select("doc_id", *cols).join(F.broadcast(lab), "doc_id")
            .groupBy("doc_id").agg(one.alias("__one")).select("doc_id", *(f"__one.{c}" for c in cols), "__one.label"))


def set_apart(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with every column but ``used`` renamed by its place, so that no name of the caller's meets one that an
    operator adds; :func:`put_back` undoes it."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in used else f"own_{i}") for i, c in enumerate(docs.columns)])


def put_back(rows: DataFrame, docs: DataFrame, *used: str) -> list[Column]:
    """The columns of ``docs`` under their own names, of rows made from :func:`set_apart`."""
    return [rows[c if c in used else f"own_{i}"].alias(c) for i, c in enumerate(docs.columns)]


class Remembered(dict):
    """A function's results by key, at most 2 * ``limit`` of them: the keys not seen of late go first."""

    def __init__(self, compute: Callable, limit: int) -> None:
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_KEPT: dict[str, object] = {}


def forget() -> None:
    """Drop what :func:`kept` holds: for tasks that keep nothing."""
    _KEPT.clear()


def kept(name: str, make: Callable):
    """A table that a worker process keeps between its tasks; asking for another one drops it, so
    operators that run one after the other do not add up."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]
