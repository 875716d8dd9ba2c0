"""Start the jobs on streams. Readers and writers are parameters: Kafka and JDBC on a
cluster, folders in tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import changes
from millrace.plans.jobs import JOBS, LiveTopics, change_records
from millrace.session import checkpoint_root
from millrace.sinks.dimensions import DimensionTables
from millrace.sources.routing import dimension_routes, load_routing
from millrace.streaming.clock import TopicClock
from millrace.streaming.run import start

Reader = Callable[[str], DataFrame]
Writer = Callable[[DataFrame, int], None]


def start_job(
    name: str,
    read_topic: Reader,
    writer: Callable[[str, str], Writer],
    read_dim: Reader | None = None,
    root: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start one of ``JOBS`` as one query, whatever the number of its outputs.

    ``writer`` gives the writer of a job to a topic or table: two jobs may share a table,
    each with its own count of batches. Dimensions are read again for every batch, so
    changes to them are seen.
    """
    job = JOBS[name]
    topics = LiveTopics({topic: read_topic(topic) for topic in job.reads})
    spark = topics[job.reads[0]].sparkSession
    root = root or checkpoint_root(spark)
    folder = f"{root}/{name}"
    if len(job.reads) > 1:
        topics.clock = TopicClock(spark, f"{folder}/clock")
        topics.clock.start(job.reads)
        spark.streams.addListener(topics.clock.listener(name))
    frame = job.core(topics)

    def write(batch: DataFrame, batch_id: int) -> None:
        dims = {d: read_dim(d) for d in job.dims} if read_dim else {}
        # a batch with several outputs is computed once
        given = batch.persist()
        rows = job.step(given, folder, batch_id).persist() if job.step else given
        try:
            for output, found in job.outputs(rows, dims).items():
                writer(name, output)(found, batch_id)
        finally:
            rows.unpersist()
            given.unpersist()

    return start(frame, name, write, root, every)


def start_change_routing(
    raw: DataFrame,
    read_routing: Callable[[], DataFrame],
    write_facts: Writer,
    dims: DimensionTables,
    root: str | None = None,
    every: str | None = None,
    deletes: bool = True,
) -> StreamingQuery:
    """Route change records: facts to their topics, dimension rows into their tables.

    The routing table is read again for every batch; an empty one fails the batch.
    ``raw`` carries the ``partition`` and ``offset`` of each record, which order the changes of
    a key where the records do not say when they were made.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        routing = load_routing(read_routing())
        routed = changes.route_changes(batch, routing).persist()
        try:
            write_facts(changes.fact_messages(routed), batch_id)
            dims.merge_all(dimension_routes(routing), changes.dimension_changes(routed), deletes)
        finally:
            routed.unpersist()

    return start(change_records({"ODS_BASE_DB_M": raw}), "change_routing", write, root, every)
