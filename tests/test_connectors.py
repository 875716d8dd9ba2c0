"""Connectors that cannot run here: what they hand to Spark."""

import pytest

from millrace.session import checkpoint_root
from millrace.sinks import ledger, tables, topics
from millrace.sources import topics as source_topics


class Recorder:
    """Stands in for a reader or writer and keeps what it was told."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call

    def options_set(self):
        return {a[0]: a[1] for n, a, _ in self.calls if n == "option"}


class FakeBatch:
    def __init__(self):
        self.write = Recorder()
        self.writeStream = self.write
        self.columns_selected = None
        self.partitions = None

    def select(self, *columns):
        self.columns_selected = columns
        return self

    def coalesce(self, n):
        self.partitions = n
        return self


def test_kafka_text_starts_at_latest_and_casts():
    assert source_topics.kafka_options("h:9092", "T", "g") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "T", "startingOffsets": "latest", "groupIdPrefix": "g",
    }


@pytest.mark.parametrize("topic, columns", [("T", ("value",)), (None, ("topic", "value"))])
def test_kafka_sinks(topic, columns):
    batch = FakeBatch()
    topics.kafka_writer("h:9092", topic)(batch, 0)
    assert batch.columns_selected == columns
    assert batch.write.options_set().get("topic") == topic
    assert batch.write.calls[-1][0] == "save"

    stream = FakeBatch()
    topics.kafka_sink(stream, "h:9092", "/shared/ckpt", topic)
    assert stream.writeStream.options_set()["checkpointLocation"] == "/shared/ckpt"
    assert stream.writeStream.calls[-1][0] == "start"


def test_jdbc_writer_sends_the_columns_of_the_table(monkeypatch):
    batch = FakeBatch()
    monkeypatch.setattr(tables, "conform", lambda rows, ddl: rows if ddl == tables.KEYWORD_TABLE else None)
    tables.jdbc_writer("jdbc:x", "keyword_stats", {"driver": "d"}, batch_size=500, connections=3)(batch, 1)
    ((name, args, kwargs),) = batch.write.calls
    assert (name, args, kwargs["mode"]) == ("jdbc", ("jdbc:x", "keyword_stats"), "append")
    assert kwargs["properties"] == {"driver": "d", "batchsize": "500"}
    assert batch.partitions == 3


def test_the_checkpoint_folder_of_the_cluster_is_used(spark):
    class Cluster:
        def __init__(self, **conf):
            self.conf = conf

    assert checkpoint_root(Cluster(**{"spark.checkpoint.dir": "s3a://bucket/x/"})) == "s3a://bucket/x"
    with pytest.raises(ValueError):
        checkpoint_root(Cluster(**{"spark.master": "yarn"}))
    assert checkpoint_root(spark)


def test_a_batch_is_inserted_once_whenever_it_fails(spark, tmp_path):
    store, failing = [], [True]

    def insert(batch, batch_id):
        if batch_id == 1 and failing:
            failing.pop()
            raise RuntimeError("the store is away")
        store.extend(r.v for r in batch.collect())

    write = ledger.inserted_once(insert, str(tmp_path), "job")
    first, second = (spark.createDataFrame([(v,)], "v int") for v in (1, 2))
    write(first, 0)
    write(first, 0)
    with pytest.raises(RuntimeError):
        write(second, 1)
    # run again, the batch is what was staged, whatever it is computed to be now
    write(spark.createDataFrame([(99,)], "v int"), 1)
    write(second, 1)
    assert sorted(store) == [1, 2]
    other = ledger.inserted_once(insert, str(tmp_path), "another job")
    other(first, 0)
    assert sorted(store) == [1, 1, 2]


def test_jdbc_properties_and_another_name_reach_the_store():
    batch = FakeBatch()
    batch.selectExpr = lambda *_: batch
    batch.columns = ["ts"]
    tables.jdbc_writer("jdbc:x", "province_stats", {"user": "u", "driver": "d"}, into="province_stats_sql")(batch, 0)
    name, arguments, options = batch.write.calls[-1]
    assert (name, arguments[1]) == ("jdbc", "province_stats_sql")
    assert options["properties"]["user"] == "u" and options["properties"]["driver"] == "d"
