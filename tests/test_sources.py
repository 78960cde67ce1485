import os
from dataclasses import replace

import pytest

from pyspark.sql import functions as F

from claimweave.operators.typed import clean
from claimweave.sources.delimited import land, land_folder, landing_log, read_landed, register_views
from claimweave.sources.layout import SOURCES
from claimweave.sources.lineage import audit_columns
from claimweave.sources.sinks import write_csv
from claimweave.streaming.upsert import (compact, current_rows, drop_repeats, start_upsert,
                                         stream_landed)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


HEAD = "emr_encounter_id,icd10_code,diagnosis_desc,diagnosis_rank\n"


def test_missing_texts_and_quoted_breaks(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    write(path, HEAD + 'N1,NA,"two\nlines, ""q""",1\nN2,null,,n/a\n')
    df, log = land(spark, path, replace(SOURCES["emr_diagnosis"], multi_line=True))
    rows = {r.emr_encounter_id: r for r in df.collect()}
    assert log.status == "loaded"
    assert rows["N1"].diagnosis_desc == 'two\nlines, "q"' and rows["N1"].icd10_code is None
    assert (rows["N2"].icd10_code, rows["N2"].diagnosis_desc, rows["N2"].diagnosis_rank) == (
        None, None, None)


def test_columns_are_aligned_and_hash_covers_the_file(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    write(path, "icd10_code,extra,emr_encounter_id\nI10,x,N1\n")
    source = SOURCES["emr_diagnosis"]
    df, _ = land(spark, path, source)
    assert df.schema.simpleString() == source.landed_schema().simpleString()
    row = df.first()
    want = spark.range(1).select(F.md5(F.lit("I10|x|N1|emr|emr_diagnosis.csv")).alias("h")).first()
    assert row["_row_hash"] == want["h"] and row["diagnosis_desc"] is None


def test_folder_lands_what_it_can(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "landed")
    write(f"{folder}/emr/emr_diagnosis.csv", HEAD + "N1,I10,x,1\nN2,I10,y,2\n")
    write(f"{folder}/emr/emr_procedure.csv", "emr_encounter_id,cpt_code\n")
    sources = [SOURCES[n] for n in ("emr_diagnosis", "emr_procedure", "emr_provider")]
    for _ in range(2):  # repeating a batch replaces it
        log = land_folder(spark, folder, target, "b1", sources)
        assert [(x.status, x.row_count) for x in log] == [("loaded", 2), ("empty", 0), ("missing", 0)]
    assert read_landed(spark, target, "emr_diagnosis").count() == 2
    land_folder(spark, folder, target, "b2", sources)
    landed = read_landed(spark, target, "emr_diagnosis")
    assert landed.count() == 4
    assert clean(landed, SOURCES["emr_diagnosis"]).count() == 2
    assert landing_log(spark, log).filter("status = 'loaded'").first()["row_count"] == 2


def test_views_and_csv_round_trip(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "landed")
    for source in SOURCES.values():
        df = spark.createDataFrame([tuple("1" for _ in source.columns)],
                                   ", ".join(f"{c} string" for c in source.columns))
        write_csv(df, f"{folder}/{source.system}/{source.file}")
    log = land_folder(spark, folder, target, "b1")
    assert {x.status for x in log} == {"loaded"} and len(log) == 13
    assert len(register_views(spark, target)) == 13
    assert spark.sql("SELECT count(*) AS n FROM stg_referral_order").first()["n"] == 1


def test_audit_columns(spark):
    df = spark.createDataFrame([("N1", None)], "a string, b string")
    row = audit_columns(df, ["a"], "b7").first()
    assert (row.source_record_id, row.batch_id, row.payload_json) == ("N1", "b7", '{"a":"N1","b":null}')


def test_stream_merges_by_key(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "t")

    def run():
        query = start_upsert(spark, folder, target, str(tmp_path / "cp"), "emr_diagnosis",
                             once=True)
        query.awaitTermination(120)
        rows = current_rows(spark, target, "emr_diagnosis").collect()
        return {(r.emr_encounter_id, r.icd10_code): r.diagnosis_desc for r in rows}

    write(f"{folder}/1.csv", HEAD + "N1,I10,old,1\nN2,I10,keep,1\n")
    os.utime(f"{folder}/1.csv", (1_700_000_000, 1_700_000_000))
    assert run() == {("N1", "I10"): "old", ("N2", "I10"): "keep"}
    write(f"{folder}/2.csv", HEAD + "N1, i10,new,1\nN3,Z23,x,1\n")
    os.utime(f"{folder}/2.csv", (1_700_000_500, 1_700_000_500))
    write(f"{folder}/3.csv", HEAD + "N1,I10,late,1\n")
    os.utime(f"{folder}/3.csv", (1_600_000_000, 1_600_000_000))
    want = {("N1", "I10"): "new", ("N2", "I10"): "keep", ("N3", "Z23"): "x"}
    assert run() == want
    compact(spark, target, str(tmp_path / "t2"), "emr_diagnosis")
    rows = current_rows(spark, str(tmp_path / "t2"), "emr_diagnosis").collect()
    assert {(r.emr_encounter_id, r.icd10_code): r.diagnosis_desc for r in rows} == want
    assert len(rows) == spark.read.parquet(str(tmp_path / "t2")).count() == 3


def test_reordered_header_fails_the_stream(spark, tmp_path):
    write(f"{tmp_path}/in/1.csv", "icd10_code,emr_encounter_id,diagnosis_desc,diagnosis_rank\n"
          "I10,N1,x,1\n")
    query = start_upsert(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/cp",
                         "emr_diagnosis", once=True)
    with pytest.raises(Exception, match="header|schema"):
        query.awaitTermination(120)


def test_repeats_in_a_stream_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(f"{folder}/1.csv", HEAD + "N1,I10,a,1\nN1,I10,a,1\nN2,I10,b,1\n")
    rows = stream_landed(spark, folder, SOURCES["emr_diagnosis"])
    query = (drop_repeats(rows, ["_row_hash"], "1 hour").writeStream.format("memory")
             .queryName("unrepeated").trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert spark.table("unrepeated").count() == 2


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    from claimweave.operators.latest import newest_per_key
    from claimweave.session import materialise, stored
    from claimweave.sources.sinks import write_table

    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
        files = blocks.diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in files if "/shuffle_" in f}

    before = shuffles()
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    stored(rows.groupBy("k").count(), "sums")
    materialise(rows.groupBy("k").count())
    write_table(newest_per_key(rows, ["k"], [F.desc("v")]), str(tmp_path / "t"))
    assert not shuffles() - before


def test_feeds_of_the_round_trip_go_once_they_are_landed(spark, tmp_path, monkeypatch):
    from claimweave.plans import queries

    few = {n: SOURCES[n] for n in ("emr_diagnosis", "emr_provider")}
    monkeypatch.setattr(queries, "SOURCES", few)
    monkeypatch.setattr(queries, "checkpoint_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(queries, "landed", lambda spark, sf, name: spark.createDataFrame(
        [["NA", *["x"] * (len(few[name].columns) - 1)]], list(few[name].columns)))
    monkeypatch.setattr(queries, "register_views", lambda spark, target: [
        read_landed(spark, target, n).createOrReplaceTempView(n) or n for n in few])
    found = queries.all_queries()["bronze_csv_round_trip"](spark, "")
    assert sorted(r.table_name for r in found.collect()) == sorted(few)
    kept = [f for _, _, names in os.walk(tmp_path) for f in names if not f.startswith((".", "_"))]
    assert kept and all(f.endswith(".zstd.parquet") for f in kept)
