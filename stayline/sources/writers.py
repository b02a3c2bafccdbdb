"""Sinks: CSV, Parquet stores with merge-by-key, dataset snapshots."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from stayline.operators.checks import duplicate_keys, store_rules
from stayline.operators.drift import histograms
from stayline.schemas import LABEL_STORE, PREDICTION_STORE
from stayline.session import stage, stage_tallied, tallies
from stayline.sources.readers import drift_baseline, read_csv


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("nullValue", "").csv(path)


def _read_or_none(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def ingest_csv(spark: SparkSession, csv_path: str, schema: StructType, target: str) -> str:
    """Bulk-load a CSV into a Parquet table.

    Returns ``loaded``; ``skipped`` when the target already has rows; ``missing`` when
    there is no such file. A rerun is therefore harmless.
    """
    existing = _read_or_none(spark, target, schema)
    if existing is not None and not existing.isEmpty():
        return "skipped"
    try:
        rows = read_csv(spark, csv_path, schema)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return "missing"
        raise
    rows.write.mode("overwrite").parquet(target)
    return "loaded"


def overwrite_partitions(df: DataFrame, path: str, partition: str, sort_by: list[str] | None = None) -> None:
    """Replace exactly the partitions present in ``df``; all others stay.

    Rebalancing sends each partition value to one task and lets adaptive execution split the
    large ones, so that neither many tiny files nor one huge task comes out. Sorted files
    have tight row-group statistics for reads by user.
    """
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, *(sort_by or []))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def _check_columns(incoming: DataFrame, stored: StructType, path: str, add_columns: bool) -> None:
    """A batch must hold every stored column with its type, and no other unless that is asked for."""
    batch = {f.name: f.dataType for f in incoming.schema.fields}
    missing = [f.name for f in stored.fields if f.name not in batch]
    if missing:
        raise ValueError(f"the batch lacks the stored columns {missing} of {path}")
    other = [f"{f.name} {batch[f.name].simpleString()}" for f in stored.fields if batch[f.name] != f.dataType]
    if other:
        raise ValueError(f"the batch has other types than {path}: {other}")
    new = sorted(set(batch) - set(stored.names))
    if new and not add_columns:
        raise ValueError(f"{path} has no columns {new}; add_columns=True adds them")


def merge_by_key(
    incoming: DataFrame,
    path: str,
    keys: list[str],
    partition: str,
    add_columns: bool = False,
    staged: bool = False,
    rules: dict[str, Column] | None = None,
) -> int:
    """Insert or replace rows by key in a partitioned Parquet table.

    The store is read with its own schema, so a row that the batch does not touch keeps every
    column; the batch must bring all stored columns in their types. ``add_columns`` lets it
    bring more, which are NULL in older rows. ``partition`` holds days or 'yyyy-MM' months:
    only the touched ones are read and rewritten, and their list is bounded by the calendar.

    The merged rows are staged in shared storage first, because a table cannot be
    overwritten while it is being read. The batch is staged too unless it already reads a
    stored table (``staged``). Returns the number of rows upserted; running it twice changes
    nothing.

    ``rules`` are conditions that no row may meet. They are counted in the pass that stages the
    batch, or the one that counts a staged batch; a broken one is an error before the store is
    touched.
    """
    if partition not in incoming.columns:
        raise ValueError(f"partition column {partition!r} is not in the batch")
    if not isinstance(incoming.schema[partition].dataType, (DateType, StringType)):
        raise ValueError(f"partition column {partition!r} must hold days or months")
    spark = incoming.sparkSession
    if staged:
        found = incoming.agg(*tallies(rules or {})).first().asDict()
    else:
        incoming, found = stage_tallied(incoming, "merge-in", rules or {})
    n_rows = found["n"]
    if n_rows == 0:
        return 0
    broken = {name: found[name] for name in rules or {} if found[name]}
    if broken:
        raise ValueError(f"rows of the batch break the rules of {path}: {broken}")
    if not duplicate_keys(incoming, keys).isEmpty():
        raise ValueError(f"duplicate {keys} in the batch")

    merged = incoming
    existing = _stored(spark, path, incoming.schema[partition])
    if existing is not None:
        _check_columns(incoming, existing.schema, path, add_columns)
        touched = [r[0] for r in incoming.select(partition).distinct().collect()]
        kept = existing.where(F.col(partition).isin(touched)).join(incoming, keys, "left_anti")
        merged = stage(incoming.unionByName(kept, allowMissingColumns=True), "merge-out")
    overwrite_partitions(merged, path, partition, [k for k in keys if k != partition])
    return n_rows


def _stored(spark: SparkSession, path: str, partition: StructField) -> DataFrame | None:
    """The table at ``path`` with its stored columns; the partition column has the batch's type."""
    try:
        # Files may differ where columns were added; the partition column is part of no file.
        files = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return files.withColumn(partition.name, F.col(partition.name).cast(partition.dataType))


def upsert_labels(labels: DataFrame, path: str, add_columns: bool = False, staged: bool = False) -> int:
    """Merge labels on (msno, anchor_expiry_date), stored by cohort month."""
    # Equal keys have equal anchors and so always meet in the same month partition.
    batch = labels.withColumn("cohort_month", F.date_format("anchor_expiry_date", "yyyy-MM"))
    rules = store_rules(labels, LABEL_STORE)
    return merge_by_key(batch, path, ["msno", "anchor_expiry_date"], "cohort_month", add_columns, staged, rules)


def upsert_predictions(predictions: DataFrame, path: str, add_columns: bool = False, staged: bool = False) -> int:
    """Merge predictions on (msno, scoring_date), stored by scoring date."""
    rules = store_rules(predictions, PREDICTION_STORE)
    return merge_by_key(predictions, path, ["msno", "scoring_date"], "scoring_date", add_columns, staged, rules)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """One partition per scoring date, replaced on a rerun; scores stored as float32."""
    out = predictions.withColumn("score", F.col("score").cast("float"))
    overwrite_partitions(out, path, "scoring_date", ["msno"])


def write_dataset(rows: DataFrame, p99: DataFrame, root: str, version: str) -> None:
    """Snapshot a split dataset and its winsor threshold under a version id.

    ``rows`` carries a ``split`` column; ``p99`` is the one-row threshold frame. The drift
    baseline is not a copy: it is the train and val partitions (see ``drift_baseline``), and
    their histograms are stored beside the threshold (see ``write_histograms``).
    """
    (
        rows.withColumn("dataset_version_id", F.lit(version))
        .hint("rebalance", "split")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset_version_id", "split")
        .parquet(f"{root}/rows")
    )
    (
        p99.select(F.round("p99_secs", 6).alias("p99_secs"))
        .withColumn("dataset_version_id", F.lit(version))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset_version_id")
        .parquet(f"{root}/params")
    )


def write_histograms(spark: SparkSession, root: str, version: str, columns: list[str], bins: int = 10) -> None:
    """Store ranges and bin counts of a written version's drift baseline, a row per column."""
    (
        histograms(drift_baseline(spark, root, version, columns), columns, bins)
        .withColumn("dataset_version_id", F.lit(version))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset_version_id")
        .parquet(f"{root}/histograms")
    )
