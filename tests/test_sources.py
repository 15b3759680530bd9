import json
import types

import pytest
from pyspark.sql import functions as F

from feedmill.plans.feed import encode_feed
from feedmill.sources import scratch
from feedmill.sources.tables import (
    MESSAGE_SCHEMA, Target, append_table, as_messages, fan_out, feed_places, publish, read_csv, read_feed, read_table, replace_table,
    table_rows,
)


def test_replace_changes_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_table(spark.range(5), path) == 5
    assert replace_table(spark.range(3).withColumn("x", F.lit("a")), path) == 3
    assert read_table(spark, path).columns == ["id", "x"]


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc", "csv"])
def test_append_and_count(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    append_table(spark.range(5), path, fmt)
    append_table(spark.range(2), path, fmt)
    assert table_rows(spark, path, fmt, "id bigint") == 7
    assert read_table(spark, path, fmt, "id bigint").agg(F.sum("id")).first()[0] == 11


def test_fan_out_computes_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(0, 10, 1, 2)
    counted = rows.rdd.map(lambda row: (seen.add(1), row)[1]).toDF("id bigint")
    targets = [Target("parquet", str(tmp_path / "a")), Target("json", str(tmp_path / "b")), Target("orc", str(tmp_path / "c"))]
    fan_out(counted, targets)
    assert seen.value == 10
    assert [table_rows(spark, target.path, target.fmt) for target in targets] == [10, 10, 10]
    fan_out(spark.range(4), targets)
    assert [table_rows(spark, target.path, target.fmt) for target in targets] == [4, 4, 4]


def test_publish_appends_values(spark, tmp_path):
    path = str(tmp_path / "topic")
    frame = spark.range(2).select(F.to_json(F.struct("id")).alias("value"), F.lit(1).alias("chunk"))
    publish(frame, "text", path)
    publish(frame, "text", path)
    assert sorted(json.loads(row["value"])["id"] for row in spark.read.text(path).collect()) == [0, 0, 1, 1]


def test_chunks_are_published_in_order(spark, tmp_path):
    path = str(tmp_path / "topic")
    feed = encode_feed(spark.range(95).select(F.xxhash64("id").alias("h"), "id").repartition(5), ["id"], chunk_rows=10, unique=True)
    publish(feed, "text", path)
    read = spark.read.text(path).select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    files = {}
    for row in read.orderBy("file", "at").collect():
        files.setdefault(row["file"], []).append(json.loads(row["value"])["id"])
    assert sorted(sum(files.values(), [])) == list(range(95))
    assert all(ids == sorted(ids) for ids in files.values())
    assert all(len({file for file, ids in files.items() if set(ids) & set(range(10 * chunk, 10 * chunk + 10))}) == 1 for chunk in range(10))


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_order_is_restored_from_messages(spark, tmp_path, fmt):
    path = str(tmp_path / "topic")
    feed = encode_feed(spark.range(95).repartition(5), ["id"], chunk_rows=10, unique=True)
    publish(feed.where("ordinal >= 50"), fmt, path)  # the later half first
    publish(feed.where("ordinal < 50"), fmt, path)
    read = read_feed(spark, path, fmt).collect()
    assert [(row["ordinal"], row["chunk"], json.loads(row["value"])["id"]) for row in read] == [(n, n // 10, n) for n in range(95)]


def test_a_partition_holds_its_chunks_in_order(spark, tmp_path):
    path = str(tmp_path / "topic")
    feed = encode_feed(spark.range(95).repartition(5), ["id"], chunk_rows=10, unique=True)
    publish(feed, "parquet", path, partitions=4)
    rows = spark.read.schema(MESSAGE_SCHEMA).parquet(path).select(
        "partition", F.get_json_object("value", "$.id").cast("int").alias("id"), F.input_file_name().alias("file"),
        F.monotonically_increasing_id().alias("at"),
    ).orderBy("file", "at").collect()
    held = {}
    for row in rows:
        assert row["id"] // 10 % 4 == row["partition"]
        held.setdefault(row["partition"], []).append((row["file"], row["id"]))
    assert sorted(held) == [0, 1, 2, 3]
    for sent in held.values():
        assert len({file for file, _ in sent}) == 1 and [row for _, row in sent] == sorted(row for _, row in sent)


def test_messages_without_places(spark):
    headers = "array<struct<key: string, value: binary>>"
    rows = spark.createDataFrame([("a", None), ("b", []), ("c", [("chunk", b"x"), ("other", b"1")])], f"value string, headers {headers}")
    assert [tuple(row) for row in feed_places(rows).orderBy("value").collect()] == [(None, None, "a"), (None, None, "b"), (None, None, "c")]
    assert as_messages(spark.createDataFrame([], "ordinal bigint, chunk bigint, value string")).columns == ["key", "value", "headers"]


def test_csv_schema_and_inference(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1,x\n2.5,\n")
    path = str(tmp_path / "f.csv")
    assert [field.dataType.simpleString() for field in read_csv(spark, path).schema] == ["string", "string"]
    assert [field.dataType.simpleString() for field in read_csv(spark, path, infer=True).schema] == ["double", "string"]
    assert read_csv(spark, path, schema="a double, b string").agg(F.sum("a")).first()[0] == 3.5


def test_stage_and_release(spark, tmp_path, monkeypatch):
    assert scratch.session_folder(spark).startswith(scratch.shared_folder(spark))
    monkeypatch.setattr(scratch, "shared_folder", lambda session: str(tmp_path))
    frame = scratch.stage(spark.range(3), "case")
    assert frame.count() == 3
    assert scratch.new_path(spark, "case") != scratch.new_path(spark, "case")
    assert len(list(tmp_path.iterdir())) == 1
    scratch.release(spark)
    assert list(tmp_path.iterdir()) == []


def fake_session(master, named=None, existing=None):
    made = {"dir": existing}
    context = types.SimpleNamespace(
        master=master, getCheckpointDir=lambda: made["dir"], setCheckpointDir=lambda path: made.update(dir=path)
    )
    return types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda key, default: named))


def test_shared_folder_comes_from_the_session():
    assert scratch.shared_folder(fake_session("yarn", named="hdfs://shared/x/")) == "hdfs://shared/x"
    assert scratch.shared_folder(fake_session("yarn", existing="hdfs://set/y")) == "hdfs://set/y"


def test_no_private_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(fake_session("yarn"))
    assert scratch.shared_folder(fake_session("local[2]"))
