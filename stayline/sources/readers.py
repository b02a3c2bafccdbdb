"""Source tables by name, from CSV, Parquet or a JDBC database."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.schemas import SOURCES

# File name of each source table in the CSV layout.
CSV_FILES = {
    "transactions": "transactions.csv",
    "user_logs": "user_logs.csv",
    "members": "members.csv",
    "train_labels": "train.csv",
}

KINDS = ("csv", "parquet", "jdbc")


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header and a declared schema; a malformed row fails the job."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    single_partition: bool = False,
    **extra: Any,
) -> dict[str, str]:
    """Options for a parallel, read-only JDBC scan split on a numeric column.

    Without a partition column one task reads the whole table; that must be asked for.
    """
    if not url:
        raise ValueError("a JDBC url is required")
    if not partition_column and not single_partition:
        raise ValueError("name a partition_column, or say single_partition=True for a one-task read")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **{k: str(v) for k, v in extra.items()}}
    if partition_column:
        if bounds is None or partitions < 1:
            raise ValueError("partition_column needs bounds and partitions >= 1")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def load_sources(
    spark: SparkSession,
    kind: str,
    location: str | Mapping[str, Any],
    tables: tuple[str, ...] = tuple(SOURCES),
    register: bool = False,
) -> dict[str, DataFrame]:
    """The named source tables as DataFrames, optionally registered as views.

    ``location`` is a folder for ``csv`` and ``parquet``; for ``jdbc`` it is a mapping
    with ``url`` and, per table, extra :func:`jdbc_options` arguments.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, got {kind!r}")
    unknown = [t for t in tables if t not in SOURCES]
    if unknown:
        raise ValueError(f"unknown tables {unknown}")
    if kind == "jdbc" and not (isinstance(location, Mapping) and location.get("url")):
        raise ValueError("kind='jdbc' needs a location with a url")

    out: dict[str, DataFrame] = {}
    for name in tables:
        if kind == "csv":
            out[name] = read_csv(spark, f"{location}/{CSV_FILES[name]}", SOURCES[name])
        elif kind == "parquet":
            out[name] = spark.read.parquet(f"{location}/{name}")
        else:
            options = jdbc_options(location["url"], name, **location.get(name, {}))
            out[name] = spark.read.format("jdbc").options(**options).load()
        if register:
            out[name].createOrReplaceTempView(name)
    return out


def read_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """Parameterised SQL: ``:name`` markers for values, ``{name}`` for DataFrames."""
    return spark.sql(text, args=dict(args or {}), **frames)


def dataset_split(spark: SparkSession, root: str, version: str, split: str) -> DataFrame:
    """One split of a dataset version; partition pruning leaves only its files."""
    return (
        spark.read.parquet(f"{root}/rows")
        .where((F.col("dataset_version_id") == version) & (F.col("split") == split))
        .drop("dataset_version_id", "split")
    )


def dataset_params(spark: SparkSession, root: str, version: str) -> DataFrame:
    """The one-row parameter record (winsor threshold) of a dataset version."""
    return spark.read.parquet(f"{root}/params").where(F.col("dataset_version_id") == version)


def drift_baseline(spark: SparkSession, root: str, version: str, columns: list[str]) -> DataFrame:
    """What a model trained on this version saw: train and val, never test."""
    return (
        spark.read.parquet(f"{root}/rows")
        .where((F.col("dataset_version_id") == version) & F.col("split").isin("train", "val"))
        .select(*columns)
    )


def drift_histograms(spark: SparkSession, root: str, version: str) -> DataFrame:
    """Ranges and bin counts of the version's baseline: a row per feature."""
    return spark.read.parquet(f"{root}/histograms").where(F.col("dataset_version_id") == version).drop("dataset_version_id")
