"""Run one job on a cluster: ``spark-submit ... millrace/main.py JOB --servers ...``.

Topics are read from and written to Kafka, statistics inserted over JDBC, dimension tables
kept in a shared folder. Checkpoints go to the folder in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from millrace.plans.jobs import JOBS
from millrace.plans.launch import start_change_routing, start_job
from millrace.session import build_session, checkpoint_root
from millrace.sinks.dimensions import DimensionTables
from millrace.sinks.tables import TABLES, jdbc_writer
from millrace.sinks.topics import kafka_writer
from millrace.sources.routing import read_table
from millrace.sources.topics import kafka_text

# Dimension tables by their role.
DIMENSION_TABLES = {
    "user": "DIM_USER_INFO",
    "province": "DIM_BASE_PROVINCE",
    "sku": "DIM_SKU_INFO",
    "spu": "DIM_SPU_INFO",
    "category3": "DIM_BASE_CATEGORY3",
    "trademark": "DIM_BASE_TRADEMARK",
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=[*JOBS, "change_routing"])
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--dims", required=True, help="shared folder of the dimension tables")
    parser.add_argument("--store", help="JDBC address of the statistics store")
    parser.add_argument("--config", help="JDBC address of the database with the routing table")
    parser.add_argument("--every", default="10 seconds", help="trigger interval")
    parser.add_argument("--state-partitions", type=int, default=200)
    parser.add_argument("--start", default="latest", help="where a job that never ran starts: latest, earliest or offsets as JSON")
    parser.add_argument("--max-per-trigger", type=int, help="records of a topic in one batch, at most")
    for side in ("store", "config"):
        parser.add_argument(f"--{side}-option", action="append", default=[], metavar="NAME=VALUE", help=f"JDBC property of --{side}, such as user=..., driver=...")
    given = parser.parse_args(arguments)
    store_options, config_options = (dict(o.split("=", 1) for o in opts) for opts in (given.store_option, given.config_option))

    spark = build_session(given.job, shuffle_partitions=given.state_partitions)
    root = checkpoint_root(spark)
    dims = DimensionTables(spark, given.dims)

    def read_topic(topic: str):
        return kafka_text(spark, given.servers, topic, given.job, given.start, given.max_per_trigger)

    def writer(job: str, output: str):
        if output in TABLES:
            # two jobs make the statistics of provinces: each has a table of its own
            return jdbc_writer(given.store, output, store_options, into=job if job == "province_stats_sql" else output)
        return kafka_writer(given.servers, output)

    if given.job == "change_routing":
        start_change_routing(
            read_topic("ODS_BASE_DB_M"),
            lambda: read_table(spark, given.config, "table_process", config_options),
            kafka_writer(given.servers),
            dims,
            root,
            given.every,
        )
    else:
        start_job(given.job, read_topic, writer, lambda d: dims.latest(DIMENSION_TABLES[d]), root, given.every)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
