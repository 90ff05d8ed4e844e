"""Sinks (S7, S8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def append_sink(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), sep: str = ";") -> None:
    """Append new rows; the first write creates the table (with header for CSV)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("sep", sep).csv(path)
    else:
        w.format(fmt).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ";", partition_by: Sequence[str] = ()) -> None:
    """Overwrite the output as ``;`` CSV or Parquet (Parquet also serves as a stage checkpoint)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("sep", sep).csv(path)
    else:
        w.format(fmt).save(path)
