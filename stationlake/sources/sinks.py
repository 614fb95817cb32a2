"""Sinks: partitioned parquet (S4) and plain distributed writes (S5, the S8 report table)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_partitioned(df: DataFrame, path: str, partition_col: str = "date_partition", *,
                      mode: str = "overwrite", dynamic: bool = True) -> None:
    """Write ``df`` as parquet partitioned by ``partition_col``.

    The ``rebalance`` hint hash-partitions on the partition column and lets AQE size the
    writer tasks from the shuffle statistics: small days are coalesced (few files), a day
    holding a large share of the rows is split across several writers (no single hot
    task). It is one pass with no sampling job, so metrics observed on ``df`` are
    counted once. Overwrite is dynamic: only the days present in ``df`` are replaced; with
    ``dynamic=False`` the whole table is.
    """
    (df.hint("rebalance", partition_col)
       .sortWithinPartitions(partition_col)
       .write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
       .partitionBy(partition_col).parquet(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                **options: str) -> None:
    """Plain distributed write (parquet, csv, ...) — no driver-side collection."""
    w = df.write.mode(mode).format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
