import datetime as dt
import json
import os

from pyspark.sql import functions as F

from support import SF_SMALL, rows
from ledgerflow import schemas
from ledgerflow.operators import facts
from ledgerflow.sources.landing import read_landing, with_rescued, write_batches
from ledgerflow.streaming.ingest import append_available_now, file_stream, table_stream


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_landing_arrays_and_rescued_data(spark, tmp_dir):
    land = os.path.join(tmp_dir, "activity")
    recs = [{"appid": 1, "player_count": 5, "extracted_at": "2024-01-02T03:04:05.123456+00:00"},
            {"appid": 2, "player_count": 3000000000, "extracted_at": "2024-01-02T03:04:05+00:00", "extra": "x"},
            {"appid": "three", "player_count": 7, "extracted_at": "2024-01-02T03:04:05+00:00"}]
    _write(land, "compact.json", json.dumps(recs[:1]))
    _write(land, "indented.json", json.dumps(recs[1:], indent=3))
    typed = read_landing(spark, land, schemas.ACTIVITY)            # multiLine: the indented file parses
    assert typed.count() == 3
    got = {r["player_count"]: r for r in with_rescued(spark, land, schemas.ACTIVITY).collect()}
    assert got[5]["extracted_at"] == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert got[5]["_rescued_data"] is None
    assert got[3000000000]["appid"] == 2 and json.loads(got[3000000000]["_rescued_data"]) == {"extra": "x"}
    assert got[7]["appid"] is None and json.loads(got[7]["_rescued_data"]) == {"appid": "three"}


def test_rescued_nested_struct_fields(spark, tmp_dir):
    land = os.path.join(tmp_dir, "details")
    rec = {"appid": 1, "price_overview": {"currency": "EUR", "initial": 100, "final": "cheap", "tax": 5},
           "unknown_top": [1, 2]}
    _write(land, "d.json", json.dumps([rec]))
    r = with_rescued(spark, land, schemas.DETAILS).first()
    assert r["price_overview"]["initial"] == 100 and r["price_overview"]["final"] is None
    assert json.loads(r["_rescued_data"]) == {"unknown_top": "[1,2]", "price_overview.final": "cheap",
                                              "price_overview.tax": "5"}


def test_write_batches_caps_records_per_file(spark, tmp_dir):
    out = os.path.join(tmp_dir, "batches")
    write_batches(spark.range(450).coalesce(1), out, max_records=200)
    files = sorted(f for f in os.listdir(out) if f.endswith(".json"))
    sizes = sorted(sum(1 for _ in open(os.path.join(out, f))) for f in files)
    assert sizes == [50, 200, 200]
    back = with_rescued(spark, out, spark.range(1).schema, layout="lines")
    assert back.count() == 450 and back.where("_rescued_data is not null").count() == 0


def test_available_now_exactly_once_and_stream_equals_batch(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land")
    _write(land, "a.json", json.dumps([{"appid": 1, "player_count": 5, "extracted_at": "2024-01-02T03:04:05+00:00"}]))
    src = lambda: read_landing(spark, land, schemas.ACTIVITY, stream=True)
    out, ck = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ck")
    append_available_now(src(), ck, path=out)
    append_available_now(src(), ck, path=out)                  # rerun: nothing new
    assert spark.read.parquet(out).count() == 1
    _write(land, "b.json", json.dumps([{"appid": 2, "player_count": 6, "extracted_at": "2024-01-02T05:00:00+00:00"},
                                       {"appid": 3, "player_count": 7, "extracted_at": "2024-01-03T05:00:00+00:00"}]))
    append_available_now(src(), ck, path=out)
    streamed = spark.read.parquet(out)
    assert streamed.count() == 3
    batch = read_landing(spark, land, schemas.ACTIVITY)
    assert rows(facts.snapshot(streamed)) == rows(facts.snapshot(batch))


def test_table_stream_picks_up_only_new_rows(spark, tmp_dir):
    spark.sql("CREATE SCHEMA IF NOT EXISTS lf_test")
    spark.sql("DROP TABLE IF EXISTS lf_test.bronze_events")
    spark.sql("DROP TABLE IF EXISTS lf_test.silver_events")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "value", "ts")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    ev.where(F.col("ts") < cut).write.format("parquet").saveAsTable("lf_test.bronze_events")
    ck = os.path.join(tmp_dir, "silver-ck")
    run = lambda: append_available_now(
        facts.snapshot(table_stream(spark, "lf_test.bronze_events"), observed="ts"), ck, table="lf_test.silver_events")
    run()
    first = spark.table("lf_test.silver_events").count()
    ev.where(F.col("ts") >= cut).write.mode("append").format("parquet").saveAsTable("lf_test.bronze_events")
    run()
    assert first < spark.table("lf_test.silver_events").count() == ev.count()


def test_file_stream_on_driver_table(spark, tmp_dir):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    s = file_stream(spark, SF_SMALL, schema, glob="events.parquet")
    out = os.path.join(tmp_dir, "ev")
    append_available_now(s, os.path.join(tmp_dir, "ck2"), path=out)
    assert spark.read.parquet(out).count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_malformed_files_lines_and_elements_keep_their_text(spark, tmp_dir):
    import json
    import os

    os.makedirs(f"{tmp_dir}/a")
    texts = {"whole.json": '\n[{"appid": 1, "player_count": 5}, null, 7]\n', "cut.json": '[{"appid": 2}, {"appid": 3, "pl',
             "none.json": "oops", "one.json": '{"appid": 4}', "blank.json": " \n", "empty.json": "[]"}
    for name, text in texts.items():
        with open(f"{tmp_dir}/a/{name}", "w") as f:
            f.write(text)
    for stream in (False, True):
        found = with_rescued(spark, f"{tmp_dir}/a", schemas.ACTIVITY, stream=stream, **({"maxFilesPerTrigger": 2} if stream else {}))
        if stream:
            append_available_now(found, f"{tmp_dir}/ck", path=f"{tmp_dir}/out")
            found = spark.read.parquet(f"{tmp_dir}/out")
        got = [(r["appid"], json.loads(r["_rescued_data"] or "{}")) for r in found.collect()]
        assert sorted(a for a, x in got if not x) == [1, 4]
        bad = sorted((os.path.basename(x["_file"]), x["_malformed"]) for a, x in got if x)
        assert bad == [("cut.json", texts["cut.json"]), ("none.json", "oops"), ("whole.json", "7"), ("whole.json", "null")]
        assert all(a is None for a, x in got if x)
    os.makedirs(f"{tmp_dir}/l")
    with open(f"{tmp_dir}/l/x.json", "w") as f:
        f.write('{"appid": 1}\n\n{"appid": 2, "pl\n[{"appid": 3}]\n')
    got = with_rescued(spark, f"{tmp_dir}/l", schemas.ACTIVITY, layout="lines").collect()
    assert sorted(str(r["appid"]) for r in got) == ["1", "3", "None"]
    assert [json.loads(r["_rescued_data"])["_malformed"] for r in got if r["_rescued_data"]] == ['{"appid": 2, "pl']


def test_clean_source_reaches_the_reader(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/in")
    for i in range(3):
        with open(f"{tmp_dir}/in/{i}.json", "w") as f:
            f.write('[{"appid": %d}]' % i)
    found = with_rescued(spark, f"{tmp_dir}/in", schemas.ACTIVITY, stream=True, cleanSource="delete", maxFilesPerTrigger=1)
    append_available_now(found, f"{tmp_dir}/ck", path=f"{tmp_dir}/out")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 3
    assert len([f for f in os.listdir(f"{tmp_dir}/in") if f.endswith(".json")]) < 3
