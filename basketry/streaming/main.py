"""Job entry point: ``python -m basketry.streaming.main <job> [options]``.

Jobs: ``multi-event`` (active users, top products, abandoned carts, dead
letters) and ``transactions`` (last-write-wins table, sales roll-ups).
Settings come from arguments, else from the same environment variables the
original deployment reads: BOOTSTRAP_SERVERS, KAFKA_START_MODE,
KAFKA_START_TIMESTAMP_MS, ABANDONED_TIMEOUT_MINUTES.  Results and
checkpoints go under ``--out`` (default: <spark.checkpoint.dir>/basketry-jobs);
``--jdbc-url`` also upserts them into the database tables (password from
BASKETRY_JDBC_PASSWORD).
"""

from __future__ import annotations

import argparse
import os

from basketry import schemas
from basketry.operators.carts import timeout_from_env
from basketry.session import checkpoint_root, get_session
from basketry.sources import files, kafka
from basketry.streaming import jobs
from basketry.streaming.writers import jdbc_execute


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="basketry")
    p.add_argument("job", choices=["multi-event", "transactions"])
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--path", help="folder of JSON-lines files (--source files)")
    p.add_argument("--bootstrap", default=os.environ.get("BOOTSTRAP_SERVERS"))
    p.add_argument("--topic", default=kafka.TOPIC)
    p.add_argument("--start-mode", default=os.environ.get("KAFKA_START_MODE", "latest"))
    p.add_argument("--start-timestamp-ms", default=os.environ.get("KAFKA_START_TIMESTAMP_MS"))
    p.add_argument("--timeout-minutes", default=os.environ.get("ABANDONED_TIMEOUT_MINUTES"))
    p.add_argument("--max-offsets", type=int, help="Kafka records of a micro-batch, at most")
    p.add_argument("--max-files", type=int, help="files of a micro-batch, at most")
    p.add_argument("--state-store", help="state store provider class, e.g. RocksDB's, for large state")
    p.add_argument("--out", default=None)
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    p.add_argument("--console", action="store_true", help="also print routed events and labels")
    p.add_argument("--jdbc-url", help="also upsert results into this database")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-driver", help="JDBC driver class, e.g. org.postgresql.Driver")
    p.add_argument("--jdbc-dialect", choices=["postgres", "merge"], default="postgres")
    p.add_argument("--search-format", help="connector that also gets results as search documents")
    p.add_argument("--search-option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--publish-topic", help="also publish decoded events to this Kafka topic (multi-event)")
    p.add_argument("--create-tables", action="store_true",
                   help="run the result-table DDL (PostgreSQL dialect) once at start")
    return p


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = get_session(extra={"spark.sql.streaming.stateStore.providerClass": args.state_store}
                        if args.state_store else None)
    jdbc = None
    if args.jdbc_url:
        props = {}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if os.environ.get("BASKETRY_JDBC_PASSWORD"):
            props["password"] = os.environ["BASKETRY_JDBC_PASSWORD"]
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        jdbc = {"url": args.jdbc_url, "props": props, "dialect": args.jdbc_dialect}
        if args.create_tables:
            jdbc_execute(spark, args.jdbc_url, list(schemas.DDL.values()), props)
    search = None
    if args.search_format:
        search = {"format": args.search_format, "options": dict(o.split("=", 1) for o in args.search_option)}
    out = jobs.Outputs(args.out or os.path.join(checkpoint_root(spark), "basketry-jobs"), jdbc=jdbc,
                       search=search)
    trigger = {"availableNow": True} if args.once else None
    if args.source == "files":
        raw = files.read_records_stream(spark, args.path, args.max_files)
    elif args.job == "multi-event":
        raw = kafka.read_kafka_stream(spark, kafka.kafka_options(
            args.bootstrap, args.topic, kafka.EVENTS_GROUP, args.start_mode,
            args.start_timestamp_ms, args.max_offsets))
    else:
        raw = kafka.read_kafka_stream(spark, kafka.transaction_kafka_options(
            args.bootstrap, args.topic, args.max_offsets))
    if args.job == "multi-event":
        queries = jobs.start_multi_event_job(raw, out, timeout_from_env(args.timeout_minutes),
                                             trigger, console=args.console,
                                             publish=(kafka.write_kafka_options(args.bootstrap, args.publish_topic)
                                                      if args.publish_topic else None))
    else:
        queries = jobs.start_transaction_job(raw, out, trigger, console=args.console)
    if args.once:
        jobs.await_all(queries)
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
