"""Parquet, JSON-lines, relational and in-memory tables."""

from __future__ import annotations

from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.schema import TRANSACTION

# ---------------------------------------------------------------- Parquet


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


_OPERATORS = {
    "=": lambda c, v: c == v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v, ">": lambda c, v: c > v, "<=": lambda c, v: c <= v, ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)), "not in": lambda c, v: ~c.isin(list(v)),
}


def _term(column: str, op: str, value) -> Column:
    if op not in _OPERATORS:
        raise ValueError(f"unknown filter operator {op!r}")
    return _OPERATORS[op](F.col(column), value)


def predicate(filters: list) -> Column:
    """``[(col, op, value), ...]`` ANDed, or a list of such lists ORed."""
    groups = filters if filters and isinstance(filters[0], list) else [filters]
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [_term(*t) for t in g]) for g in groups])


def read_filtered(spark: SparkSession, path: str, filters: list | None = None) -> DataFrame:
    """The predicate stays a plain filter, so it reaches partition pruning and the Parquet reader."""
    df = spark.read.parquet(path)
    return df.where(predicate(filters)) if filters else df


def schema_table(df: DataFrame) -> DataFrame:
    """(position, name, type) of every column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def merge_partitions(spark: SparkSession, path: str) -> DataFrame:
    """All partitions as one table with the partition column restored."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_recursive(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below ``path`` at any depth; raises when there is none.

    Directory names are not turned into columns here; use :func:`merge_partitions` for that.
    """
    try:
        return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no parquet files in {path}") from error


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] = (),
                  compression: str | None = None) -> str:
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def archive_transactions(df: DataFrame, path: str, by_region: bool = True) -> str:
    """One directory per region where the column exists, else a flat table; replaces the old archive."""
    return write_parquet(df, path, partition_by=["region"] if by_region and "region" in df.columns else [])


# ---------------------------------------------------------------- in-memory frames


def ingest_frame(spark: SparkSession, frame: pd.DataFrame, columns: list[str] | None = None) -> DataFrame:
    """pandas frame held by the caller: wanted columns that exist; dates and objects become text,
    missing text stays null, whole numbers are bigint and other numbers double."""
    names = [c for c in (columns or frame.columns) if c in frame.columns]
    table = pa.Table.from_pandas(frame[names], preserve_index=False)
    kinds = ((pa.types.is_boolean, pa.bool_()), (pa.types.is_integer, pa.int64()), (pa.types.is_floating, pa.float64()))
    for i, field in enumerate(table.schema):
        kind = next((k for is_kind, k in kinds if is_kind(field.type)), None)
        column = table.column(i).cast(kind) if kind else pa.array(
            [None if v is None or v is pd.NaT else str(v) for v in frame[field.name].astype(object).where(frame[field.name].notna(), None)], pa.string())
        table = table.set_column(i, field.name, column)
    return spark.createDataFrame(table)


# ---------------------------------------------------------------- JSON lines


def write_json(df: DataFrame, path: str, rows_per_file: int | None = None) -> str:
    writer = df.write.mode("overwrite").option("compression", "gzip")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType | str = TRANSACTION) -> DataFrame:
    return spark.read.schema(schema).json(path)


# ---------------------------------------------------------------- relational tables


def seed_tables(transactions: DataFrame, warehouses: DataFrame, root: str, suffix: str = "") -> tuple[str, str]:
    """Fact and dimension as catalog tables stored below ``root``; existing ones are replaced."""
    return (write_table(transactions, f"transactions{suffix}", root), write_table(warehouses, f"warehouses{suffix}", root))


def read_table(spark: SparkSession, name: str, order: list[str] = (), limit: int | None = None) -> DataFrame:
    """Catalog table; with a limit the first rows of a declared order, so the answer is repeatable."""
    df = spark.table(name)
    if limit is None:
        return df
    return df.orderBy(*order).limit(limit)


def write_table(df: DataFrame, name: str, root: str) -> str:
    """Replace a catalog table stored below ``root``."""
    df.write.mode("overwrite").option("path", f"{root}/{name}").saveAsTable(name)
    return name


def run_sql(spark: SparkSession, sql: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with named parameters; ``{name}`` in the text refers to a DataFrame argument."""
    return spark.sql(sql, args=params or {}, **frames)


def jdbc_partitions(column: str, low: int, high: int, parts: int) -> dict[str, str]:
    """Options for a parallel JDBC scan over a numeric key range."""
    if parts < 1 or high < low:
        raise ValueError("need parts >= 1 and high >= low")
    return {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}


def read_jdbc(spark: SparkSession, url: str, table: str, limit: int | None = None, order: str | None = None,
              partitions: dict[str, str] | None = None, **options: str) -> DataFrame:
    """Table of an external database; limits and filters are pushed into its query.

    A whole table needs ``partitions`` (see jdbc_partitions): without them one task would read it all.
    """
    if limit is None and not partitions:
        raise ValueError("give partitions for a whole table, or a limit")
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **(partitions or {}), **options).load()
    if limit is None:
        return df
    return (df.orderBy(order) if order else df).limit(limit)


def write_jdbc(df: DataFrame, url: str, table: str = "predictions", **options: str) -> None:
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, **options).save()
