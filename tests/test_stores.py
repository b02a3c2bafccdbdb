import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayline.operators import reads
from stayline.schemas import MEMBERS, SOURCES
from stayline.session import cluster_settings, scratch_path, scratch_root, scratch_scope, stage_counted
from stayline.sources import readers, writers

D = dt.date


def predictions(spark, rows):
    return spark.createDataFrame(
        rows, "msno string, score double, risk_tier string, scoring_date date, expiry_date date, model_version string"
    )


def pred(user, score, day, version="m1"):
    d = D(2017, 3, day)
    return (user, score, "HIGH" if score >= 0.5 else "LOW", d, d + dt.timedelta(14), version)


def contents(spark, path):
    rows = spark.read.parquet(path).select("msno", "scoring_date", "score", "model_version").collect()
    return {(r.msno, r.scoring_date.day): (r.score, r.model_version) for r in rows}


def files_of_day(spark, path, day):
    return sorted(f for f in spark.read.parquet(path).inputFiles() if f"scoring_date={day}" in f)


def test_upsert_is_idempotent_and_local(spark):
    store = scratch_path(spark, "t-store")
    first = predictions(spark, [pred("a", 0.1, 1), pred("b", 0.2, 1), pred("a", 0.3, 2)])
    assert writers.upsert_predictions(first, store) == 3
    assert writers.upsert_predictions(first, store) == 3
    assert spark.read.parquet(store).count() == 3

    other_day = files_of_day(spark, store, "2017-03-02")
    assert other_day
    again = predictions(spark, [pred("b", 0.9, 1, "m2"), pred("c", 0.4, 1, "m2")])
    assert writers.upsert_predictions(again, store) == 2
    assert contents(spark, store) == {
        ("a", 1): (0.1, "m1"), ("b", 1): (0.9, "m2"), ("c", 1): (0.4, "m2"), ("a", 2): (0.3, "m1"),
    }
    assert files_of_day(spark, store, "2017-03-02") == other_day


def test_upsert_rejects_duplicates_and_accepts_nothing(spark):
    store = scratch_path(spark, "t-store")
    with pytest.raises(ValueError, match="duplicate"):
        writers.upsert_predictions(predictions(spark, [pred("a", 0.1, 1), pred("a", 0.2, 1)]), store)
    assert writers.upsert_predictions(predictions(spark, []), store) == 0
    with pytest.raises(ValueError, match="partition"):
        writers.merge_by_key(predictions(spark, []), store, ["msno"], "nope")


def test_merge_loses_no_stored_column(spark):
    store = scratch_path(spark, "t-store")
    writers.upsert_predictions(predictions(spark, [pred("a", 0.1, 1), pred("b", 0.9, 1), pred("a", 0.3, 2)]), store)
    batch = predictions(spark, [pred("c", 0.4, 1)])
    with pytest.raises(ValueError, match="risk_tier"):
        writers.upsert_predictions(batch.drop("risk_tier"), store)
    with pytest.raises(ValueError, match="score float"):
        writers.upsert_predictions(batch.withColumn("score", F.col("score").cast("float")), store)
    more = batch.withColumn("note", F.lit("new"))
    with pytest.raises(ValueError, match="note"):
        writers.upsert_predictions(more, store)
    assert writers.upsert_predictions(more, store, add_columns=True) == 1
    rows = spark.read.option("mergeSchema", True).parquet(store).collect()
    assert {(r.msno, r.scoring_date.day, r.risk_tier, r.note) for r in rows} == {
        ("a", 1, "LOW", None), ("b", 1, "HIGH", None), ("c", 1, "LOW", "new"), ("a", 2, "LOW", None),
    }
    # A later batch must bring the added column too, whichever day it touches.
    with pytest.raises(ValueError, match="note"):
        writers.upsert_predictions(predictions(spark, [pred("d", 0.4, 2)]), store)
    with pytest.raises(ValueError, match="days or months"):
        writers.merge_by_key(batch, store, ["msno"], "score")


@pytest.mark.parametrize("staged", [False, True])
def test_a_bad_row_leaves_the_store_untouched(spark, staged):
    store = scratch_path(spark, "t-store")
    writers.upsert_predictions(predictions(spark, [pred("a", 0.1, 1)]), store)
    before = sorted(spark.read.parquet(store).inputFiles())
    good = pred("b", 0.5, 1)
    bad = {
        "score_domain": ("b", 1.5, *good[2:]), "score_null": ("b", None, *good[2:]), "risk_tier_domain": ("b", 0.5, "TOP", *good[3:]),
        "msno_domain": ("u" * 65, *good[1:]), "model_version_null": (*good[:5], None), "expiry_date_null": (*good[:4], None, "m1"),
    }
    for rule, row in bad.items():
        with pytest.raises(ValueError, match=f"'{rule}': 1"):
            writers.upsert_predictions(predictions(spark, [pred("c", 0.2, 1), row]), store, staged=staged)
    several = [pred("c", 0.2, 1), ("b", float("nan"), *good[2:]), ("d", -0.1, *good[2:])]
    with pytest.raises(ValueError, match="'score_domain': 2"):
        writers.upsert_predictions(predictions(spark, several), store, staged=staged)
    assert sorted(spark.read.parquet(store).inputFiles()) == before
    assert writers.upsert_predictions(predictions(spark, [good]), store, staged=staged) == 1

    schema = "msno string, anchor_expiry_date date, feature_cutoff_date date, is_churn short, labeled_date date"
    label = ("a", D(2017, 3, 5), D(2017, 2, 19), 2, None)
    with pytest.raises(ValueError, match="labeled_date_null.*is_churn_domain"):
        writers.upsert_labels(spark.createDataFrame([label], schema), scratch_path(spark, "t-labels"), staged=staged)


def test_scope_deletes_what_it_staged(spark):
    with scratch_scope(spark):
        kept, n = stage_counted(spark.range(5), "t-scope")
        folder = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert n == 5 and spark.read.parquet(folder).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


def test_label_store(spark):
    store = scratch_path(spark, "t-labels")
    schema = "msno string, anchor_expiry_date date, feature_cutoff_date date, is_churn short, labeled_date date"
    rows = [("a", D(2017, 3, 5), D(2017, 2, 19), 1, D(2017, 5, 1)), ("a", D(2017, 4, 5), D(2017, 3, 22), 0, D(2017, 5, 1))]
    writers.upsert_labels(spark.createDataFrame(rows, schema), store)
    writers.upsert_labels(spark.createDataFrame([(*rows[0][:3], 0, D(2017, 6, 1))], schema), store)
    got = {(r.anchor_expiry_date.month, r.is_churn, r.labeled_date.month) for r in spark.read.parquet(store).collect()}
    assert got == {(3, 0, 6), (4, 0, 5)}


def test_rebalanced_write_keeps_few_files(spark):
    path = scratch_path(spark, "t-files")
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("msno"), (F.col("id") % 4).cast("int").alias("day"), F.lit(0.5).alias("score")
    )
    writers.overwrite_partitions(rows.repartition(16), path, "day", ["msno"])
    back = spark.read.parquet(path)
    assert back.count() == 5000 and len(back.inputFiles()) <= 8


def test_predictions_file_per_day_with_float_scores(spark):
    path = scratch_path(spark, "t-pred")
    writers.write_predictions(predictions(spark, [pred("a", 0.1, 1), pred("b", 0.2, 2)]), path)
    writers.write_predictions(predictions(spark, [pred("c", 0.3, 2)]), path)
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["score"] == "float"
    assert {(r.msno, r.scoring_date.day) for r in back.collect()} == {("a", 1), ("c", 2)}


def test_reads(spark):
    store = predictions(spark, [pred("a", 0.1, 1), pred("a", 0.7, 3), pred("b", 0.7, 3), pred("c", 0.9, 3)])
    assert {r.msno: r.score for r in reads.latest_prediction(store).collect()} == {"a": 0.7, "b": 0.7, "c": 0.9}
    assert reads.latest_prediction(store, "a").first().scoring_date == D(2017, 3, 3)
    assert reads.latest_prediction(store, "zz").count() == 0
    with pytest.raises(ValueError, match="user id"):
        reads.latest_prediction(store, "a b")
    day = reads.cohort_for_date(store, "2017-03-03").collect()
    assert [r.msno for r in day] == ["c", "a", "b"] and {r["count"] for r in day} == {3}
    assert reads.cohort_for_date(store, "2017-03-09").count() == 0
    assert reads.predictions_for_month(store, "2017-03").count() == 4
    assert reads.predictions_for_month(store, "2017-04").count() == 0


def test_csv_ingest(spark):
    root = scratch_path(spark, "t-csv")
    members = spark.createDataFrame([("a", 1, 30, None, 7, 20100101), ("b", None, None, "male", 3, None)], MEMBERS)
    writers.write_csv(members, f"{root}/members.csv")
    args = (spark, f"{root}/members.csv", MEMBERS, f"{root}/members")
    assert writers.ingest_csv(*args) == "loaded"
    assert writers.ingest_csv(*args) == "skipped"
    assert writers.ingest_csv(spark, f"{root}/nothing.csv", MEMBERS, f"{root}/none") == "missing"
    assert sorted(map(tuple, spark.read.parquet(f"{root}/members").collect())) == sorted(map(tuple, members.collect()))


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "train.csv").write_text("msno,is_churn\na,not-a-number\n")
    loaded = readers.load_sources(spark, "csv", str(tmp_path), ("train_labels",))
    with pytest.raises(Exception):
        loaded["train_labels"].collect()


def test_load_sources(spark, make):
    root = scratch_path(spark, "t-src")
    make.txn([("a", 20170101, 20170131, 0)]).write.parquet(f"{root}/transactions")
    got = readers.load_sources(spark, "parquet", root, ("transactions",), register=True)
    assert got["transactions"].count() == 1
    row = readers.read_sql(
        spark, "SELECT count(*) AS n FROM transactions WHERE transaction_date <= :d", {"d": 20170101}
    ).first()
    assert row.n == 1
    named = readers.read_sql(spark, "SELECT msno FROM {t} WHERE is_cancel = :c", {"c": 0}, t=got["transactions"])
    assert named.first().msno == "a"
    for bad in ({"kind": "postgres", "location": "x"}, {"kind": "jdbc", "location": "x"}, {"kind": "csv", "location": "x", "tables": ("zz",)}):
        with pytest.raises(ValueError):
            readers.load_sources(spark, **bad)
    assert set(SOURCES) == {"transactions", "user_logs", "members", "train_labels"}


def test_jdbc_options():
    got = readers.jdbc_options("jdbc:x", "transactions", "transaction_date", (20150101, 20170331), 8)
    assert got["numPartitions"] == "8" and got["lowerBound"] == "20150101" and got["dbtable"] == "transactions"
    assert "partitionColumn" not in readers.jdbc_options("jdbc:x", "members", single_partition=True)
    with pytest.raises(ValueError, match="one-task"):
        readers.jdbc_options("jdbc:x", "members")
    with pytest.raises(ValueError):
        readers.jdbc_options("", "members")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "members", "city")


def test_cluster_settings(spark):
    assert cluster_settings(10**9)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_settings(20 * 10**12)["spark.sql.shuffle.partitions"] == "74506"
    for key, value in cluster_settings(1).items():
        before = spark.conf.get(key, None)
        spark.conf.set(key, value)  # every one can be set on a running session
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_scratch(spark):
    assert scratch_path(spark, "x").startswith(scratch_root(spark))
    staged, n = stage_counted(spark.range(17).toDF("a"), "n")
    assert n == 17 and staged.count() == 17
    assert stage_counted(spark.range(0).toDF("a"), "n")[1] == 0
