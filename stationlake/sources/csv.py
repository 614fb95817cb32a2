"""Raw CSV landing files.

Every read is PERMISSIVE: a line with another number of fields, or broken quoting, is kept
with its raw text in ``_corrupt_record`` and split off once, so it is counted and can be
written to a rejected table.  The parser sees all columns (no pruning inside it): a projection
never changes which lines count as malformed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_RECORD = "_corrupt_record"


@dataclass
class RawRead:
    """The well-formed rows of a landing folder and the malformed ones (with their raw line)."""

    rows: DataFrame
    rejected: DataFrame
    lines: DataFrame  # both, with the raw line of the malformed ones

    def counts(self) -> DataFrame:
        """One row: ``rows_read`` (well-formed) and ``rows_malformed``, in one pass."""
        bad, first = F.col(CORRUPT_RECORD), F.col(self.rows.columns[0])
        return self.lines.agg(F.count_if(bad.isNull()).alias("rows_read"),
                              F.count(F.when(bad.isNotNull(), F.coalesce(first, bad))).alias("rows_malformed"))


def text_schema(columns: Sequence[str], *, corrupt_column: bool = False) -> StructType:
    fields = [StructField(c, StringType(), True) for c in columns]
    if corrupt_column:
        fields.append(StructField(CORRUPT_RECORD, StringType(), True))
    return StructType(fields)


def csv_options(sep: str = ";", header: bool = True) -> dict[str, str]:
    """The options of every raw read, batch or stream."""
    return {"header": str(header).lower(), "sep": sep, "mode": "PERMISSIVE", "columnPruning": "false",
            "columnNameOfCorruptRecord": CORRUPT_RECORD}


def split_malformed(df: DataFrame) -> RawRead:
    bad, first = F.col(CORRUPT_RECORD), F.col(df.columns[0])
    # both filters also look at a parsed column: Spark refuses a raw CSV query, like a count, that
    # reads nothing but the corrupt-record column
    seen = F.coalesce(bad, F.when(first == bad, first))
    return RawRead(df.where(seen.isNull()).drop(CORRUPT_RECORD), df.where(seen.isNotNull()), df)


def read_raw(spark: SparkSession, path: str, columns: Sequence[str], *, sep: str = ";",
             header: bool = True) -> RawRead:
    """Read a raw CSV, every column as text, well-formed and malformed lines apart."""
    schema = text_schema(columns, corrupt_column=True)
    return split_malformed(spark.read.options(**csv_options(sep, header)).schema(schema).csv(path))


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, *,
                 sep: str = ";", header: bool = True,
                 header_columns: Sequence[str] | None = None) -> DataFrame:
    """The well-formed rows of a raw CSV, projected to ``columns``.

    Without ``header_columns`` (the file's columns in order) the header line is read first;
    a line with another number of fields than the header has is then malformed."""
    if header_columns is None:
        header_columns = spark.read.option("header", header).option("sep", sep).csv(path).columns
    rows = read_raw(spark, path, header_columns, sep=sep, header=header).rows
    return rows.select(*columns) if columns is not None else rows


def land_csv(df: DataFrame, path: str, *, sep: str = ";", malformed: Column | None = None) -> None:
    """Write rows as headerless CSV lines; where ``malformed`` holds, a line gets one field too many."""
    flagged = df.withColumn("__bad", F.coalesce(malformed, F.lit(False)) if malformed is not None else F.lit(False))
    line = F.to_csv(F.struct(*df.columns), {"sep": sep})
    (flagged.select(F.when(F.col("__bad"), F.concat(line, F.lit(f"{sep}extra"))).otherwise(line).alias("value"))
     .write.text(path))
