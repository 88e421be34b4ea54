import json
import tempfile

import pytest
from pyspark.sql import functions as F

from storepulse import schemas, session
from storepulse.sources import changes, tables, topics
from storepulse.streaming import jobs, sinks


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("1", "d1"), ("2", "d2")], "id string, day string")
    sinks.write_batch(rows, 0, path, "day")
    sinks.write_batch(rows.withColumn("id", F.concat("id", F.lit("x"))), 1, path, "day")
    sinks.write_batch(rows, 0, path, "day")
    stored = tables.read_table(spark, path, rows.schema)
    assert sorted((r.id, r.day, r.batch_id) for r in stored.collect()) == [
        ("1", "d1", 0), ("1x", "d1", 1), ("2", "d2", 0), ("2x", "d2", 1)]


def test_latest_row_per_key(spark):
    rows = spark.createDataFrame([("1", "old", 0), ("1", "new", 2), ("2", "only", 1)],
                                 "id string, v string, batch_id long")
    assert sorted((r.id, r.v) for r in tables.latest_per_key(rows, "id").collect()) == [
        ("1", "new"), ("2", "only")]


def test_named_partitions_that_exist_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("1", "d1"), ("2", "d2")], "id string, day string")
    sinks.write_batch(rows, 0, path, "day")
    read = lambda *days: [r.id for r in tables.read_partitions(spark, path, rows.schema, "day", days).collect()]
    assert (read("d2", "d9"), read("d9")) == (["2"], [])


def test_orders_stream_masks_stores_and_sets_aside(spark, tmp_path, put):
    good = {"id": "1", "total_amount": "2.5", "consignee_tel": "13812345678",
            "create_time": "2024-01-02 03:04:05"}
    put(tmp_path / "topics", "order", good, {**good, "id": "2", "consignee_tel": None}, "{broken")
    put(tmp_path / "topics", "event", good)
    query = jobs.ingest_orders(topics.read_folder(spark, str(tmp_path / "topics"), "order"),
                               str(tmp_path / "orders"), once=True)
    query.awaitTermination()
    row, = tables.read_table(spark, str(tmp_path / "orders"), schemas.ORDER_TABLE).collect()
    assert (row.id, row.consignee_tel, row.create_date, row.create_hour, row.total_amount) == (
        "1", "138********", "2024-01-02", "03", 2.5)
    rejected = tables.read_table(spark, str(tmp_path / "orders" / "_quarantine"), schemas.QUARANTINE_TABLE)
    assert sorted(r._error for r in rejected.collect()) == ["bad_json", "missing_consignee_tel"]
    assert query.lastProgress["observedMetrics"]["orders"].asDict() == {"rows": 3, "rejected": 2}


def test_a_resent_order_is_stored_once_for_readers(spark, tmp_path, put):
    order = {"id": "1", "total_amount": "1", "consignee_tel": "138", "create_time": "2024-01-02 03:04:05"}
    for amount in ("1", "7"):
        put(tmp_path / "topics", "order", {**order, "total_amount": amount})
        jobs.ingest_orders(topics.read_folder(spark, str(tmp_path / "topics"), "order"),
                           str(tmp_path / "orders"), once=True).awaitTermination()
    stored = tables.read_table(spark, str(tmp_path / "orders"), schemas.ORDER_TABLE)
    assert stored.count() == 2
    assert [r.total_amount for r in tables.read_orders(spark, str(tmp_path / "orders")).collect()] == [7.0]


def test_the_newest_message_of_a_batch_wins(spark, tmp_path):
    order = {"id": "1", "consignee_tel": "138", "create_time": "2024-01-02 03:04:05"}
    rows = [(json.dumps({**order, "total_amount": str(n)}), n) for n in (9, 11, 10)]
    (tmp_path / "in").mkdir()
    spark.createDataFrame(rows, "value string, offset long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("value string, offset long").parquet(str(tmp_path / "in"))
    jobs.ingest_orders(stream, str(tmp_path / "orders"), once=True).awaitTermination()
    assert [r.total_amount for r in tables.read_orders(spark, str(tmp_path / "orders")).collect()] == [11.0]


def test_routed_lines_reach_topics_and_archive(spark, tmp_path, put):
    put(tmp_path / "in", "lines", {"type": "startup", "ts": 5}, {"type": "event"}, "{broken")
    jobs.route_logs(topics.read_folder(spark, str(tmp_path / "in"), "lines"),
                    sinks.topic_folder(str(tmp_path / "topics")), str(tmp_path / "archive"),
                    once=True).awaitTermination()
    sent = topics.read_folder_once(spark, str(tmp_path / "topics"))
    by_topic = {r.topic: r.value for r in sent.collect()}
    assert set(by_topic) == {"startup", "event"}
    archived = spark.read.schema("value string, log_date string").text(str(tmp_path / "archive"))
    assert {r.value for r in archived.collect()} == set(by_topic.values())


def test_topic_filter_skips_other_topics_files(spark, tmp_path, put):
    put(tmp_path, "a", {"x": 1})
    put(tmp_path, "b", {"x": 2})
    plan = topics.read_folder_once(spark, str(tmp_path), "a")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


def test_change_entries_from_files(spark, tmp_path):
    (tmp_path / "e.json").write_text(
        '{"entry_type":"ROWDATA","table":"order_info","type":"INSERT",'
        '"rows":[{"after":[{"name":"id","value":"1"}]}]}\n')
    assert changes.read_entries(spark, str(tmp_path)).first().rows[0].after[0].value == "1"


def test_console_sink_takes_every_row(spark, tmp_path, put):
    put(tmp_path / "in", "t", {"x": "hello"}, {"x": "again"})
    query = sinks.print_rows(topics.read_folder(spark, str(tmp_path / "in"), "t"),
                             str(tmp_path / "c"), once=True)
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress["numInputRows"] == 2


def test_kafka_options():
    assert topics.kafka_source_options("h:9092", "order", max_offsets=10) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "order", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10"}
    assert sinks.kafka_sink_options("h:9092", acks="all")["acks"] == "all"


class _Session:
    def __init__(self, master, **settings):
        get = lambda key, default=None: settings.get(key, default)
        self.conf = type("Conf", (), {"get": staticmethod(get), "set": staticmethod(settings.__setitem__)})
        self.sparkContext = type("Context", (), {
            "master": master, "getConf": staticmethod(lambda: self.conf)})


def test_work_folder_lies_in_the_configured_folder():
    cluster = _Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/ck/"})
    assert session.work_folder(cluster, "x").startswith("hdfs://shared/ck/x-")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]", "local[2]"])
def test_no_work_folder_without_a_name(master):
    with pytest.raises(RuntimeError):
        session.work_folder(_Session(master), "x")


def test_default_work_root_is_for_one_machine(tmp_path):
    near, far = _Session("local[2]"), _Session("local-cluster[3,2,1024]")
    session.default_work_root(near)
    session.default_work_root(far)
    assert session.work_folder(near, "x").startswith(tempfile.gettempdir())
    with pytest.raises(RuntimeError):
        session.work_folder(far, "x")
