"""Streaming: replay after a crash, late rows, keyed writers, JDBC upsert."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from basketry.session import work_path
from basketry.sources import files
from basketry.streaming import jobs
from basketry.streaming.writers import BatchLog, BucketTable, ReplaceByKey, jdbc_execute, jdbc_upsert
from tests.conftest import rows

ONCE = {"availableNow": True}


def _write_lines(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string") \
        .coalesce(1).write.mode("append").text(folder)


def _pv(i, user, ts):
    return json.dumps({"eventId": f"e{i}", "eventType": "page_view", "userId": user,
                       "timestamp": ts.strftime("%Y-%m-%dT%H:%M:%SZ")})


T0 = dt.datetime(2024, 1, 1)


def test_bucket_table_replay_keeps_one_copy(spark):
    table = BucketTable(work_path(spark, "t_keyed"), ["k"], "k string, v int", buckets=4)
    assert table.read(spark).count() == 0
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    table.write_batch(df, 0)
    table.write_batch(df, 0)                      # the same batch again
    table.write_batch(spark.createDataFrame([("a", 5)], "k string, v int"), 1)
    assert rows(table.read(spark), "k", "v") == [("a", 5), ("b", 2)]
    assert spark.read.parquet(table.path).count() == 2    # one stored row per key


def test_replace_by_key(spark):
    store = ReplaceByKey(work_path(spark, "t_replace"), "h")
    store.write_batch(spark.createDataFrame([("h1", "p1"), ("h1", "p2"), ("h2", "p9")],
                                            "h string, p string"))
    store.write_batch(spark.createDataFrame([("h1", "p3")], "h string, p string"))
    assert rows(store.read(spark), "h", "p") == [("h1", "p3"), ("h2", "p9")]
    assert rows(store.read(spark, "h2"), "p") == [("p9",)]


def test_stream_replay_after_crash(spark):
    out = jobs.Outputs(work_path(spark, "t_crash"))
    in_dir = out.path("_input")
    _write_lines(spark, in_dir, ["not json", '{"eventId":"x","zzz":1}', _pv(1, "u", T0)])
    log = BatchLog(out.path("dead"), "value string, reason string")
    state = {"crashed": False}

    def crashing(df, batch_id):
        log.write_batch(df, batch_id)
        if not state["crashed"]:
            state["crashed"] = True
            raise RuntimeError("simulated crash after the sink write")

    def start(fn):
        raw = files.read_records_stream(spark, in_dir)
        _, bad = jobs.decode_event_stream(raw)
        return (bad.writeStream.foreachBatch(fn).trigger(**ONCE)
                   .option("checkpointLocation", out.checkpoint("dead")).start())

    q = start(crashing)
    with pytest.raises(Exception):
        q.awaitTermination(120)
    q = start(log.write_batch)                  # restart: the batch id is re-run
    jobs.await_all([q])
    assert log.read(spark).count() == 2     # replaced, not appended twice
    assert log.count(spark).first()[0] == 2
    assert rows(log.read(spark), "reason") == [("malformed",), ("unknown_field",)]


def test_late_rows_dropped_on_time_kept(spark):
    out = jobs.Outputs(work_path(spark, "t_late"))
    in_dir = out.path("_input")

    def run():
        raw = files.read_records_stream(spark, in_dir)
        events, _ = jobs.decode_event_stream(raw)
        jobs.await_all([jobs.start_active_users(events, out, trigger=ONCE)])

    m = lambda x: T0 + dt.timedelta(minutes=x)
    _write_lines(spark, in_dir, [_pv(1, "a", m(0.5)), _pv(2, "b", m(20))])
    run()
    _write_lines(spark, in_dir, [_pv(3, "late", m(1)), _pv(4, "c", m(21)), _pv(5, "d", m(40))])
    run()
    got = dict(rows(out.active_users().read(spark).select(
        F.col("minute_ts").cast("timestamp_ntz"), "users")))
    assert got[m(1)] == 1                       # only "a": the late row is dropped
    assert got[m(22)] == 2                      # on-time rows of the second file are kept
    assert all(ts <= m(40) for ts in got)


def test_jdbc_staging_merge_upsert(spark):
    # Embedded in-memory Derby: a database only this process sees.
    url = "jdbc:derby:memory:basketry_upsert;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    jdbc_execute(spark, url, ['CREATE TABLE sales_per_day ("transaction_date" DATE NOT NULL '
                              'PRIMARY KEY, "total_sales" DOUBLE)'], props)
    b0 = spark.createDataFrame([(dt.date(2024, 1, 1), 10.0), (dt.date(2024, 1, 2), 5.0)],
                               "transaction_date date, total_sales double")
    jdbc_upsert(b0, 0, url, "sales_per_day", ["transaction_date"], props)
    b1 = spark.createDataFrame([(dt.date(2024, 1, 2), 7.5)], "transaction_date date, total_sales double")
    jdbc_upsert(b1, 1, url, "sales_per_day", ["transaction_date"], props)
    jdbc_upsert(b1, 1, url, "sales_per_day", ["transaction_date"], props)   # replay
    got = spark.read.jdbc(url, "sales_per_day", properties=props)
    assert rows(got) == [(dt.date(2024, 1, 1), 10.0), (dt.date(2024, 1, 2), 7.5)]


def test_multi_event_job_end_to_end(spark):
    out = jobs.Outputs(work_path(spark, "t_multi"))
    in_dir = out.path("_input")
    lines = [_pv(1, "u1", T0), _pv(2, "u2", T0 + dt.timedelta(seconds=30)),
             json.dumps({"eventId": "e3", "eventType": "add_to_cart", "cartId": "c1",
                         "productId": "p1", "totalAmount": 12.5,
                         "timestamp": "2024-01-01T00:01:00Z"}),
             "not json",
             _pv(4, "u3", T0 + dt.timedelta(hours=3))]
    _write_lines(spark, in_dir, lines)
    raw = files.read_records_stream(spark, in_dir)
    jobs.await_all(jobs.start_multi_event_job(raw, out, trigger=ONCE))
    au = dict(rows(out.active_users().read(spark).select(
        F.col("minute_ts").cast("timestamp_ntz"), "users")))
    assert au[T0 + dt.timedelta(minutes=1)] == 2
    top = out.top_products().read(spark, "2024010100").collect()
    assert [(r.product_id, r.amount) for r in top] == [("p1", 12.5)]
    ab = out.abandoned().read(spark).collect()
    assert [r.cart_id for r in ab] == ["c1"]
    dead = out.dead_letters(spark, "events").collect()
    assert [(r.value, r.reason) for r in dead] == [("not json", "malformed")]
    assert os.path.basename(out.root).startswith("t_multi")


def test_fanout_writes_each_sink_once(spark):
    from basketry.streaming.writers import Fanout
    a = BucketTable(work_path(spark, "t_fan_a"), ["k"], "k string, v int")
    b = BatchLog(work_path(spark, "t_fan_b"), "k string")
    df = spark.createDataFrame([("x", 1)], "k string, v int")
    Fanout(a, b, shapes={1: lambda d: d.select("k")}).write_batch(df, 3)
    assert rows(a.read(spark)) == [("x", 1)]
    assert rows(b.read(spark)) == [("x",)]


def test_cli_files_once(spark):
    from basketry.streaming import main as cli
    out = work_path(spark, "t_cli")
    in_dir = os.path.join(out, "_in")
    _write_lines(spark, in_dir, [_pv(1, "u1", T0), _pv(2, "u2", T0 + dt.timedelta(hours=1))])
    cli.main(["multi-event", "--source", "files", "--path", in_dir, "--out", out, "--once"])
    got = jobs.Outputs(out).active_users().read(spark).count()
    assert got == 5


def test_processing_time_cart_timers(spark):
    """E3: wall-clock timers — c1 is abandoned after T, c2 checked out in time."""
    import time

    out = jobs.Outputs(work_path(spark, "t_pt"))
    in_dir = out.path("_input")
    lines = [json.dumps({"eventId": "e1", "eventType": "add_to_cart", "cartId": "c1",
                         "timestamp": "2024-01-01T00:00:00Z"}),
             json.dumps({"eventId": "e2", "eventType": "add_to_cart", "cartId": "c2",
                         "timestamp": "2024-01-01T00:00:00Z"}),
             json.dumps({"eventId": "e3", "eventType": "checkout", "cartId": "c2",
                         "timestamp": "2024-01-01T00:00:01Z"})]
    _write_lines(spark, in_dir, lines)
    raw = files.read_records_stream(spark, in_dir)
    events, _ = jobs.decode_event_stream(raw, watermark=None)
    q = jobs.start_abandoned_carts_processing_time(events, out, "2 seconds",
                                                   {"processingTime": "1 second"})
    log = BatchLog(out.path("abandoned_carts_pt"), "cart_id string, abandoned_at timestamp")
    try:
        deadline = time.time() + 90
        got = []
        while time.time() < deadline:
            time.sleep(2)
            assert q.exception() is None
            got = [r.cart_id for r in log.read(spark).collect()]
            if got:
                break
        time.sleep(3)
        got = [r.cart_id for r in log.read(spark).collect()]
    finally:
        q.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert got == ["c1"]


def _cart(i, kind, cart, ts):
    return json.dumps({"eventId": f"e{i}", "eventType": kind, "cartId": cart,
                       "timestamp": ts.strftime("%Y-%m-%dT%H:%M:%SZ")})


def test_event_time_cart_timers(spark):
    """E3/E4: a cart is emitted once the watermark passes add + T, over restarts."""
    out = jobs.Outputs(work_path(spark, "t_et"))
    in_dir = out.path("_input")
    log = BatchLog(out.path("abandoned_carts_et"), "cart_id string, abandoned_at timestamp")
    m = lambda x: T0 + dt.timedelta(minutes=x)

    def feed(*lines):
        _write_lines(spark, in_dir, lines)
        events, _ = jobs.decode_event_stream(files.read_records_stream(spark, in_dir))
        jobs.await_all([jobs.start_abandoned_carts_event_time(events, out, trigger=ONCE)])
        return rows(log.read(spark).select("cart_id", F.col("abandoned_at").cast("timestamp_ntz")))

    # c2 adds again exactly T later, c3 checks out at the instant of its add, c4 never adds
    got = feed(_cart(1, "add_to_cart", "c1", m(1)), _cart(2, "add_to_cart", "c2", m(2)),
               _cart(3, "add_to_cart", "c2", m(32)), _cart(4, "add_to_cart", "c3", m(1)),
               _cart(5, "checkout", "c3", m(1)), _cart(6, "checkout", "c4", m(1)),
               _cart(7, "add_to_cart", None, m(1)))
    assert got == [("c1", m(31))]  # at once: the default form waits for the end of the hour
    # a late checkout of c1 takes nothing back; a watermark exactly at c2's time does not fire it
    got = feed(_cart(8, "checkout", "c1", m(30)), _pv(9, "u", m(62) + dt.timedelta(seconds=5)))
    assert got == [("c1", m(31))]
    got = feed(_pv(10, "u", m(62) + dt.timedelta(seconds=6)), _cart(11, "add_to_cart", "c1", m(70)))
    assert got == [("c1", m(31)), ("c2", m(62))]
    got = feed(_pv(12, "u", m(300)))
    assert got == [("c1", m(31)), ("c1", m(100)), ("c2", m(62))]
    # c1's slice of m(70) is gone by now: a row of it takes no part, and a replay repeats nothing
    assert feed(_cart(13, "add_to_cart", "c1", m(71)), _pv(14, "u", m(600))) == got


def test_hot_cart_is_reduced_before_the_shuffle(spark):
    """A cart's rows reach the timer machine as one per Arrow batch and slice."""
    from basketry.streaming.stateful import reduced
    many = spark.range(0, 100_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("c"), F.col("id"))).otherwise("hot").alias("cart_id"),
        F.lit(0).cast("long").alias("slice"), F.col("id").alias("first"), F.col("id").alias("last"))
    got = reduced(many, ["cart_id", "slice"], {"first": "min", "last": "max"})
    hot = got.where("cart_id = 'hot'")
    assert hot.count() <= 4 * 3  # 25,000 rows a task, batches of 10,000
    assert hot.agg(F.min("first"), F.max("last")).first()[:] == (1, 99_998)
    assert got.where("cart_id <> 'hot'").count() == 33_334
    assert reduced(many.limit(0), ["cart_id", "slice"], {"first": "min", "last": "max"}).count() == 0


def test_transaction_job_fans_out_to_database(spark):
    """S2–S5: keyed files and database tables from the same micro-batches."""
    url = "jdbc:derby:memory:basketry_tx;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    q = lambda n: f'"{n}"'
    jdbc_execute(spark, url, [
        "CREATE TABLE transactions (" + ", ".join(
            f"{q(c)} {t}" for c, t in [
                ("transaction_id", "VARCHAR(255) NOT NULL PRIMARY KEY"), ("product_id", "VARCHAR(255)"),
                ("product_name", "VARCHAR(255)"), ("product_category", "VARCHAR(255)"),
                ("product_price", "DOUBLE"), ("product_quantity", "INTEGER"),
                ("product_brand", "VARCHAR(255)"), ("total_amount", "DOUBLE"),
                ("currency", "VARCHAR(255)"), ("customer_id", "VARCHAR(255)"),
                ("transaction_date", "TIMESTAMP"), ("payment_method", "VARCHAR(255)")]) + ")",
        'CREATE TABLE sales_per_category ("transaction_date" DATE NOT NULL, '
        '"category" VARCHAR(255) NOT NULL, "total_sales" DOUBLE, '
        'PRIMARY KEY ("transaction_date", "category"))',
        'CREATE TABLE sales_per_day ("transaction_date" DATE NOT NULL PRIMARY KEY, "total_sales" DOUBLE)',
        'CREATE TABLE sales_per_month ("year" INTEGER NOT NULL, "month" INTEGER NOT NULL, '
        '"total_sales" DOUBLE, PRIMARY KEY ("year", "month"))'], props)
    out = jobs.Outputs(work_path(spark, "t_txdb"), jdbc={"url": url, "props": props,
                                                         "dialect": "merge"})
    in_dir = out.path("_input")

    def tx(i, tid, cat, amount, day):
        return json.dumps({"transactionId": tid, "productId": f"p{i}", "productCategory": cat,
                           "productPrice": amount, "productQuantity": 1, "totalAmount": amount,
                           "currency": "USD", "customerId": "c", "paymentMethod": "credit_card",
                           "transactionDate": f"2024-01-0{day}T10:00:00Z"})

    def run():
        raw = files.read_records_stream(spark, in_dir)
        jobs.await_all(jobs.start_transaction_job(raw, out, trigger=ONCE))

    _write_lines(spark, in_dir, [tx(1, "t1", "home", 10.0, 1), tx(2, "t2", "home", 5.0, 1)])
    run()
    _write_lines(spark, in_dir, [tx(3, "t1", "home", 12.5, 2)])       # t1 again, later
    run()
    db = lambda t: spark.read.jdbc(url, t, properties=props)
    assert rows(db("transactions"), "transaction_id", "total_amount") == [("t1", 12.5), ("t2", 5.0)]
    assert rows(db("sales_per_day"), "total_sales") == [(12.5,), (15.0,)]
    assert rows(db("sales_per_month"), "year", "month", "total_sales") == [(2024, 1, 27.5)]
    assert rows(out.sales("sales_per_day").read(spark), "total_sales") == [(12.5,), (15.0,)]


def test_jdbc_table_retries_then_fails(spark):
    from basketry.streaming.writers import JdbcTable
    url = "jdbc:derby:memory:basketry_retry;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    t = JdbcTable(url, "no_such_table", ["k"], props, "merge", max_retries=2, backoff_s=0.01)
    with pytest.raises(Exception):
        t.write_batch(spark.createDataFrame([("a", 1)], "k string, v int"), 0)


def test_console_peeks(spark, capsys):
    out = jobs.Outputs(work_path(spark, "t_console"))
    in_dir = out.path("_input")
    _write_lines(spark, in_dir, [_pv(1, "u1", T0), _pv(2, "u2", T0 + dt.timedelta(hours=1))])
    raw = files.read_records_stream(spark, in_dir)
    qs = jobs.start_multi_event_job(raw, out, trigger=ONCE, console=True)
    jobs.await_all(qs)
    assert {q.name for q in qs} >= {"peek_events", "print_active_users", "print_abandoned"}


def test_jdbc_replace_by_hour(spark):
    """S7 as decided: a re-run hour replaces its members, no leftovers."""
    url = "jdbc:derby:memory:basketry_topn;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    jdbc_execute(spark, url, ['CREATE TABLE top_products_hourly ("hour_ts" TIMESTAMP NOT NULL, '
                              '"product_id" VARCHAR(255) NOT NULL, "amount" DOUBLE, '
                              'PRIMARY KEY ("hour_ts", "product_id"))'], props)
    h1, h2 = dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 1)
    sch = "hour_ts timestamp, product_id string, amount double"
    jdbc_upsert(spark.createDataFrame([(h1, "p1", 5.0), (h1, "p2", 4.0), (h2, "p9", 1.0)], sch),
                0, url, "top_products_hourly", ["hour_ts", "product_id"], props,
                replace_key="hour_ts")
    jdbc_upsert(spark.createDataFrame([(h1, "p3", 7.0)], sch), 1, url, "top_products_hourly",
                ["hour_ts", "product_id"], props, replace_key="hour_ts")
    got = rows(spark.read.jdbc(url, "top_products_hourly", properties=props))
    assert got == [(h1, "p3", 7.0), (h2, "p9", 1.0)]


def test_serving_reads_over_stored_results(spark):
    from basketry.operators import serving
    out = jobs.Outputs(work_path(spark, "t_serving"))
    # nothing written yet: the documented defaults
    assert serving.metrics_active_users(spark, out).first()[0] == 0
    assert serving.metrics_abandoned_count(spark, out).first()[0] == 0
    assert serving.metrics_top_products_hourly(spark, out, "2024010100").count() == 0
    in_dir = out.path("_input")
    lines = [json.dumps({"eventId": f"e{i}", "eventType": "add_to_cart", "cartId": f"c{i}",
                         "productId": p, "totalAmount": a, "timestamp": "2024-01-01T00:10:00Z"})
             for i, (p, a) in enumerate([("p1", 5.0), ("p2", 5.0), ("p3", 9.0)])]
    _write_lines(spark, in_dir, lines + [_pv(8, "u8", T0 + dt.timedelta(minutes=10)),
                                         _pv(9, "u9", T0 + dt.timedelta(hours=3))])
    jobs.await_all(jobs.start_multi_event_job(files.read_records_stream(spark, in_dir), out,
                                              trigger=ONCE))
    top = serving.metrics_top_products_hourly(spark, out, "2024010100")
    assert [(r.product_id, r.position) for r in top.orderBy("position").collect()] == [
        ("p3", 1), ("p2", 2), ("p1", 3)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour_key" in plan
    assert dict(out.top_products().read(spark).dtypes)["hour_key"] == "string"
    assert serving.metrics_abandoned_count(spark, out).first()[0] == 3
    # windows around 03:00 are still open; the latest closed one holds u8
    assert serving.metrics_active_users(spark, out).first()[0] == 1


def test_cli_transactions_once(spark):
    from basketry.streaming import main as cli
    out = work_path(spark, "t_cli_tx")
    in_dir = os.path.join(out, "_in")
    rec = lambda tid, amt, day: json.dumps({
        "transactionId": tid, "productCategory": "home", "totalAmount": amt,
        "transactionDate": f"2024-01-0{day}T12:00:00Z", "productQuantity": "2"})
    _write_lines(spark, in_dir, [rec("t1", 1.5, 1), rec("t2", 2.25, 1), rec("t3", 4.0, 2),
                                 '{"transactionId":"bad","zzz":1}'])
    cli.main(["transactions", "--source", "files", "--path", in_dir, "--out", out, "--once"])
    o = jobs.Outputs(out)
    assert rows(o.sales("sales_per_day").read(spark), "total_sales") == [(3.75,), (4.0,)]
    assert rows(o.transactions().read(spark), "transaction_id", "product_quantity",
                "product_price") == [("t1", 2, 0.0), ("t2", 2, 0.0), ("t3", 2, 0.0)]
    assert [r.reason for r in o.dead_letters(spark, "transactions").collect()] == ["unknown_field"]


def test_cli_writes_database(spark):
    from basketry.streaming import main as cli
    url = "jdbc:derby:memory:basketry_cli;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    jdbc_execute(spark, url, [
        'CREATE TABLE active_users_minute ("minute_ts" TIMESTAMP NOT NULL PRIMARY KEY, "users" BIGINT)',
        'CREATE TABLE top_products_hourly ("hour_ts" TIMESTAMP NOT NULL, "product_id" VARCHAR(255) '
        'NOT NULL, "amount" DOUBLE, PRIMARY KEY ("hour_ts", "product_id"))'], props)
    out = work_path(spark, "t_cli_db")
    in_dir = os.path.join(out, "_in")
    _write_lines(spark, in_dir, [
        _pv(1, "u1", T0),
        json.dumps({"eventId": "e2", "eventType": "add_to_cart", "cartId": "c1", "productId": "p1",
                    "totalAmount": 2.5, "timestamp": "2024-01-01T00:01:00Z"}),
        _pv(3, "u2", T0 + dt.timedelta(hours=2))])
    cli.main(["multi-event", "--source", "files", "--path", in_dir, "--out", out, "--once",
              "--jdbc-url", url, "--jdbc-driver", props["driver"], "--jdbc-dialect", "merge"])
    db = lambda t: spark.read.jdbc(url, t, properties=props)
    assert rows(db("top_products_hourly"), "product_id", "amount") == [("p1", 2.5)]
    assert db("active_users_minute").count() == 5
