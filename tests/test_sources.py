import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import announcements, readers, writers
from tidemark.streaming import microbatch


def test_json_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x":1},{"x":2}]')
    (tmp_path / "b.jsonl").write_text('{"x":1}\n\nbad\n{"x":3}\n')
    (tmp_path / "c.json").write_text('{"alerts":[{"x":7}]}')
    assert readers.json_array(spark, str(tmp_path / "a.json"), "x int").count() == 2
    assert readers.json_array(spark, str(tmp_path / "none.json"), "x int").count() == 0
    assert [r.x for r in readers.json_lines(spark, str(tmp_path / "b.jsonl"), "x int").orderBy("x").collect()] == [1, 3]
    got = readers.containers(spark, [str(tmp_path / "a.json"), str(tmp_path / "c.json")], "x int")
    assert sorted(r.x for r in got.collect()) == [1, 2, 7]


def test_documents_keep_errors(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b" hello ")
    (tmp_path / "b.PDF").write_bytes(b"\xff")
    (tmp_path / "c.txt").write_bytes(b"no")
    got = {r.path.rsplit("/", 1)[1]: (r.text, bool(r.error)) for r in readers.documents(spark, str(tmp_path), lambda b: b.decode("ascii")).collect()}
    assert got == {"a.pdf": ("hello", False), "b.PDF": (None, True)}


def test_announcement_source_ends_a_day_on_error(spark, tmp_path):
    (tmp_path / "20251201.json").write_text(json.dumps([{"Title": f"t{i}", "Code": "A"} for i in range(23)]))
    (tmp_path / "20251203.json").write_text(json.dumps([{"Title": "z"}]))
    spark.dataSource.register(announcements.AnnouncementSource)
    df = spark.read.format("announcements").options(first="20251201", last="20251203", path=str(tmp_path)).load()
    assert {r.day: r["count"] for r in df.groupBy("day").count().collect()} == {"20251201": 23, "20251203": 1}


def test_upload_collects_failures(spark):
    def send(row):
        if row["symbol"] == "B":
            raise ValueError("no")

    got = writers.upload(spark.createDataFrame([("A", None, 1), ("B", "x", 2)], "symbol string, title string, extra int"), send).collect()
    assert {(r.ok, r.error, r.row) for r in got} == {(True, None, '{"symbol":"A"}'), (False, "no", '{"symbol":"B","title":"x"}')}


def test_buckets_and_manifest(spark, tmp_path):
    writers.alert_buckets(spark.createDataFrame([("inserted", 1), ("not_inserted", 2)], "category string, x int"), str(tmp_path / "al"), "r1")
    assert writers.read_bucket(spark, str(tmp_path / "al"), "inserted").first().x == 1
    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.txt").write_bytes(b"abc")
    files = writers.manifest(spark, str(tmp_path / "m"))
    assert files.first().sha256.startswith("ba7816bf") and writers.manifest_totals(files).first().bytes == 3


@pytest.mark.parametrize("again", [False, True])
def test_stream_equals_batch_and_is_idempotent(spark, sf, tmp_path, again):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    src = tmp_path / "in"
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(str(src))
    for k in range(1 + again):
        rows = microbatch.stream(spark, str(src), schema, 1)
        microbatch.write_new(rows, ["event_id"], str(tmp_path / "out"), str(tmp_path / f"cp{k}")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("event_id").distinct().count() == spark.read.parquet(str(src)).count()
    assert out.select(F.max("batch")).first()[0] == 2


def test_windows_on_a_stream(spark, sf, tmp_path):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    src = str(tmp_path / "in")
    spark.read.parquet(f"{sf}/events.parquet").write.parquet(src)
    w = microbatch.windows(microbatch.stream(spark, src, schema), "ts", ["event_type"], "value", "1 day")
    q = w.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("w").agg(F.sum("n")).first()[0] == spark.read.parquet(src).count()
