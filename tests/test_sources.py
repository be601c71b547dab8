"""File, table and view helpers."""

import pytest
from pyspark.sql import functions as F

from estimand.sources import files, jdbc, tables


@pytest.fixture
def frame(spark):
    return spark.range(200).select(
        "id", (F.col("id") % 3).alias("p"), (F.col("id") / 2).alias("x"), F.concat(F.lit("n"), "id").alias("s"))


def test_partition_read(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame.write.partitionBy("p").parquet(path)
    df = files.read_partitions(spark, path, "p", [0, 2])
    assert df.count() == frame.where("p <> 1").count()
    assert "PartitionFilters: [isnotnull" in df._jdf.queryExecution().toString() or "p#" in df._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="not found"):
        files.read_partitions(spark, path, "p", [0, 9])


def test_columnar_and_glob(spark, frame, tmp_path):
    path = str(tmp_path / "orc")
    frame.coalesce(1).write.orc(path)
    assert files.read_columnar_text(spark, path, "orc", glob="*.orc").count() == 200
    with pytest.raises(ValueError):
        files.read_columnar_text(spark, path, "xml")


def test_csv_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "csv")
    files.export_csv(frame, path)
    back = files.import_csv(spark, path, {"id": int, "x": float})
    assert dict(back.dtypes) == {"id": "bigint", "p": "string", "x": "double", "s": "string"}
    assert sorted(r["x"] for r in back.collect()) == sorted(r["x"] for r in frame.collect())


def test_size_guard(spark, frame, tmp_path):
    path = str(tmp_path / "g")
    frame.repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    assert files.size_guard(df) is df
    for limit in (dict(max_rows=10), dict(max_files=2), dict(max_bytes=10)):
        with pytest.raises(ValueError, match="exceed"):
            files.size_guard(df, **limit)


@pytest.mark.parametrize("bounds", [{}, {"lower": -40, "upper": 160}])
def test_jdbc_predicates_cover_once(spark, bounds):
    # the predicates are evaluated by Spark here; no database is started
    df = spark.range(-100, 100).select("id").unionByName(spark.createDataFrame([(None,)], "id bigint"))
    hits = [F.expr(p).cast("int") for p in jdbc.partition_predicates("id", 7, **bounds)]
    counts = df.select(sum((F.coalesce(h, F.lit(0)) for h in hits), F.lit(0)).alias("n")).groupBy("n").count().collect()
    assert [(r["n"], r["count"]) for r in counts] == [(1, 201)]


def test_bucketed_tables_join_without_shuffle(spark, frame):
    tables.write_bucketed(frame, "bucket_a", "id", 4, sort_column="id", mode="overwrite")
    tables.write_bucketed(frame, "bucket_b", "id", 4, sort_column="id", mode="overwrite")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucket_a").join(spark.table("bucket_b").select("id"), "id")
        assert joined.count() == 200
        assert "Exchange hashpartitioning(id" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tables.drop_view(spark, "bucket_a")
    tables.drop_view(spark, "bucket_b")


def test_tables_and_partitions(spark, frame, tmp_path):
    tables.export_table(frame, str(tmp_path / "out"))
    with pytest.raises(Exception):
        tables.export_table(frame, str(tmp_path / "out"))
    tables.append_auto(frame, "auto_t", partition_by="p")
    tables.append_auto(frame, "auto_t", partition_by="p")
    assert spark.table("auto_t").count() == 400
    tables.drop_partition(spark, "auto_t", "p", 1)
    assert spark.table("auto_t").where("p = 1").count() == 0 and spark.table("auto_t").count() == 2 * frame.where("p <> 1").count()
    assert {r["name"]: r["rows"] for r in tables.list_tables(spark, counts=True).collect()}["auto_t"] > 0
    tables.drop_view(spark, "auto_t")
    days = frame.withColumn("day_", F.date_sub(F.current_date(), F.col("id").cast("int")))
    assert tables.retain_days(days, 14).count() == 15


def test_views(spark, frame):
    view = tables.create_view(spark, "v_small", ["id", "x * 2 AS x2"], frame, where="p = 1", limit=10, materialize=False)
    assert view.count() == 10 and view.columns == ["id", "x2"]
    stored = tables.create_view(spark, "v_stored", "id, p".split(", "), frame, bucket_column="id", num_buckets=2, materialize=True)
    assert spark.catalog.getTable("v_stored").tableType == "MANAGED" and stored.count() == 200
    with pytest.raises(ValueError):
        tables.create_view(spark, "v_bad", ["id"], frame, bucket_column="nope")
    tables.drop_view(spark, "v_small")
    tables.drop_view(spark, "v_stored")
    assert files.peek(frame, "p", [1], 5).count() == 5
    assert jdbc.read_union([frame, frame.select("s", "x", "p", "id")]).count() == 400
