import datetime as dt

from pyspark.sql import functions as F

from claimweave.streaming import changes, volumes

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "feed string, at timestamp"
KEYED = "k int, v string, _op string, _seq long"


def feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_windows_close_once_and_late_rows_are_dropped(spark, tmp_path):
    base = str(tmp_path)

    def arrive(*hours):
        feed(spark, f"{base}/in", [("a", DAY + dt.timedelta(hours=h)) if h is not None
                                   else ("a", None) for h in hours], SCHEMA)
        volumes.start_volumes(
            spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema, f"{base}/out",
            f"{base}/progress", "feed", "at", "2 hours", once=True).awaitTermination()
        return {(r["window_start"].hour, r["row_count"])
                for r in spark.read.schema("feed string, window_start timestamp, row_count long")
                .parquet(f"{base}/out").collect()}

    assert arrive(0.1, 0.2, 1.5, None) == set()
    assert arrive(4.5, 1.6) == {(0, 2), (1, 2)}      # the watermark is now 2:30
    assert arrive(1.7, 2.6, 6.0) == {(0, 2), (1, 2), (2, 1)}
    batch = volumes.hourly(spark.read.schema(SCHEMA).parquet(f"{base}/in"), "feed", "at", "2 hours")
    assert {(r["window_start"].hour, r["row_count"]) for r in batch.collect()} == {
        (0, 2), (1, 3), (2, 1), (4, 1), (6, 1)}


def test_changes_in_any_order_give_the_same_rows(spark, tmp_path):
    batches = [[(1, "a", "upsert", 1), (2, "b", "upsert", 1), (3, "c", "upsert", 1)],
               [(1, "A", "upsert", 3), (2, None, "delete", 4), (4, "d", None, None)],
               [(1, "late", "upsert", 2), (2, "late", "upsert", 3), (3, None, "delete", 2),
                (3, "back", "upsert", 5), (4, "d2", "upsert", 0)]]
    want = [(1, "A"), (3, "back"), (4, "d2")]
    schema = spark.createDataFrame([], KEYED).schema
    for name, order in (("x", batches), ("y", batches[::-1])):
        base = f"{tmp_path}/{name}"
        for batch in [*order, order[0]]:  # the first batch comes twice
            feed(spark, f"{base}/in", batch, KEYED)
            changes.start_changes(spark, f"{base}/in", schema, f"{base}/table", f"{base}/progress",
                                  ["k"], once=True).awaitTermination()
        got = changes.current(spark, f"{base}/table", schema, ["k"])
        assert got.columns == ["k", "v"] and sorted(map(tuple, got.collect())) == want
    changes.compact(spark, f"{base}/table", f"{base}/new", schema, ["k"])
    changes.append_changes(spark.createDataFrame([(2, "older", "upsert", 1)], KEYED), 7,
                           f"{base}/new", ["k"])
    assert sorted(map(tuple, changes.current(spark, f"{base}/new", schema, ["k"]).collect())) == want


def test_equal_numbers_prefer_the_deletion(spark):
    rows = spark.createDataFrame([(1, "z", "upsert", 1), (1, None, "delete", 1)], KEYED)
    assert changes.newest_changes(rows, ["k"]).first()["_op"] == "delete"
    assert changes.newest_changes(rows.filter(F.lit(False)), ["k"]).count() == 0
