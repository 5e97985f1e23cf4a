"""One decode per job, panes before windows, and result tables that a replay leaves unchanged."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from basketry.operators import active_users, sales
from basketry.session import work_path
from basketry.sources import files
from basketry.streaming import jobs, writers
from basketry.streaming.writers import BatchLog, BucketTable, LatestSlot
from tests.conftest import rows
from tests.test_streaming import ONCE, T0, _pv, _write_lines
from tests.test_verdict_cases import _tx


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


# --- one decode ------------------------------------------------------------------

def test_only_the_landing_stream_reads_and_decodes_the_source(spark):
    out = jobs.Outputs(work_path(spark, "t_once"))
    in_dir = out.path("_input")
    _write_lines(spark, in_dir, [_pv(1, "u1", T0), "not json", _pv(2, "u2", T0 + dt.timedelta(hours=1))])
    queries = jobs.start_multi_event_job(files.read_records_stream(spark, in_dir), out, trigger=ONCE)
    jobs.await_all(queries)
    read = {q.name: [s.description for s in q.recentProgress[0].sources] for q in queries}
    assert [n for n, s in read.items() if any(in_dir in x for x in s)] == ["landing_events"]
    assert all(len(s) == 1 for s in read.values())
    landing = out.events_landing(jobs.event_schema())
    for metric in (active_users.active_users_stream, lambda e: jobs.carts.abandoned_carts(e)):
        plan = _plan(metric(jobs.landed_events(landing, spark)))
        assert "from_json" not in plan and "json_object_keys" not in plan
    # batch reads of the same table: typed rows by day, dead letters apart
    assert rows(landing.read(spark), "userId") == [("u1",), ("u2",)]
    assert rows(landing.dead_letters(spark)) == [("not json", "malformed")]


def test_landing_restarts_without_a_second_copy(spark):
    out = jobs.Outputs(work_path(spark, "t_land"))
    in_dir = out.path("_input")
    for i in range(3):
        _write_lines(spark, in_dir, [_pv(i, f"u{i}", T0 + dt.timedelta(days=i))])
        _, table = jobs.land_events(files.read_records_stream(spark, in_dir), out, ONCE)
        jobs.land_events(files.read_records_stream(spark, in_dir), out, ONCE)   # nothing new
    assert rows(table.read(spark), "userId") == [("u0",), ("u1",), ("u2",)]
    assert sorted(d for d in os.listdir(f"{table.path}/kind=good")) == [
        f"day=2024-01-0{i}" for i in (1, 2, 3)]


def test_a_file_of_a_killed_batch_is_not_read(spark):
    """A file that is in the folder but not in the sink's log belongs to no batch."""
    out = jobs.Outputs(work_path(spark, "t_stray"))
    in_dir = out.path("_input")
    _write_lines(spark, in_dir, [_pv(1, "u1", T0)])
    _, table = jobs.land_events(files.read_records_stream(spark, in_dir), out, ONCE)
    day = f"{table.path}/kind=good/day=2024-01-01"
    good = next(f for f in os.listdir(day) if f.endswith(".parquet"))
    with open(f"{day}/{good}", "rb") as a, open(f"{day}/part-stray.parquet", "wb") as b:
        b.write(a.read())
    assert table.read(spark).count() == 1
    jobs.await_all([jobs.start_active_users(jobs.landed_events(table, spark), out, ONCE)])


def test_empty_source_lands_nothing(spark):
    out = jobs.Outputs(work_path(spark, "t_none"))
    in_dir = out.path("_input")
    _write_lines(spark, in_dir, [])
    jobs.await_all(jobs.start_transaction_job(files.read_records_stream(spark, in_dir), out, ONCE))
    assert out.transactions().read(spark).count() == 0
    assert out.dead_letters(spark, "transactions").count() == 0
    assert out.sales("sales_per_month").read(spark).columns == ["year", "month", "total_sales"]


# --- panes -----------------------------------------------------------------------

def test_raw_rows_are_not_fanned_out(spark):
    out = jobs.Outputs(work_path(spark, "t_pane"))
    _write_lines(spark, out.path("_input"), [_pv(1, "u1", T0)])
    events, _ = jobs.decode_event_stream(files.read_records_stream(spark, out.path("_input")))
    plan = _plan(active_users.active_users_stream(events)).splitlines()
    depth = {k: [i for i, line in enumerate(plan) if k in line] for k in ("Expand", "Aggregate")}
    assert len(depth["Expand"]) == 1 and len(depth["Aggregate"]) == 3
    assert depth["Aggregate"][-1] > depth["Expand"][0]      # the pane aggregate lies below the fan-out


@pytest.mark.parametrize("window,slide", [("5 minutes", "1 minute"), ("1 minute", "1 minute"),
                                          ("90 seconds", "1 minute")])
def test_stream_equals_batch_for_all_window_shapes(spark, window, slide):
    out = jobs.Outputs(work_path(spark, "t_shapes"))
    in_dir = out.path("_input")
    lines = [_pv(i, f"u{i % 3}", T0 + dt.timedelta(seconds=17 * i)) for i in range(40)]
    lines.append(json.dumps({"eventId": "n", "eventType": "page_view", "timestamp": "2024-01-01T00:00:10Z"}))
    _write_lines(spark, in_dir, lines + [_pv(99, "end", T0 + dt.timedelta(hours=2))])
    _, table = jobs.land_events(files.read_records_stream(spark, in_dir), out, ONCE)
    df = active_users.active_users_stream(jobs.landed_events(table, spark), window, slide)
    log = BatchLog(out.path("shapes"), "minute_ts timestamp, users bigint")
    q = (df.writeStream.outputMode("append").option("checkpointLocation", out.checkpoint("shapes"))
           .foreachBatch(log.write_batch).trigger(**ONCE).start())
    jobs.await_all([q])
    batch = active_users.active_users(table.read(spark), window, slide)
    end = T0 + dt.timedelta(hours=2) - dt.timedelta(seconds=5)
    want = [r for r in rows(batch.withColumn("t", F.col("minute_ts").cast("timestamp_ntz")), "t", "users") if r[0] <= end]
    got = rows(log.read(spark).withColumn("t", F.col("minute_ts").cast("timestamp_ntz")), "t", "users")
    assert got == want and want


# --- bucketed tables -------------------------------------------------------------

def _kv(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v int")


def test_a_batch_rewrites_only_its_buckets(spark):
    table = BucketTable(work_path(spark, "t_touch"), ["k"], "k string, v int", buckets=8)
    table.write_batch(_kv(spark, [(f"k{i}", i) for i in range(50)]), 0)
    files_of = lambda: {d: sorted(os.listdir(f"{table.path}/{d}")) for d in os.listdir(table.path) if "bucket=" in d}
    before = files_of()
    table.write_batch(_kv(spark, [("k1", -1)]), 1)
    after = files_of()
    assert sum(before[d] != after[d] for d in before) == 1 and len(before) > 4
    assert rows(table.read(spark)) == sorted([(f"k{i}", i) for i in range(50) if i != 1] + [("k1", -1)])
    assert not os.path.exists(table.stage(1))


@pytest.mark.parametrize("broken", [0, 1])
def test_a_crash_while_folders_are_replaced_is_mended(spark, monkeypatch, broken):
    """The replacement dies after some folders are gone: the re-run takes the stage as it is."""
    import shutil
    table = BucketTable(work_path(spark, "t_crash_b"), ["k"], "k string, v int", buckets=4)
    table.write_batch(_kv(spark, [(f"k{i}", i) for i in range(20)]), 0)
    batch = [(f"k{i}", 100 + i) for i in range(16)]     # in all four buckets

    def dies(df, path, column):
        for d in sorted(os.listdir(path))[:2 * broken]:
            shutil.rmtree(f"{path}/{d}", ignore_errors=True)     # folders of this test's own table
        raise RuntimeError("killed")

    whole = writers._dynamic_overwrite
    monkeypatch.setattr(writers, "_dynamic_overwrite", dies)
    with pytest.raises(RuntimeError):
        table.write_batch(_kv(spark, batch), 1)
    monkeypatch.setattr(writers, "_dynamic_overwrite", whole)
    again = BucketTable(table.path, ["k"], "k string, v int", buckets=4)    # a new process
    again.write_batch(_kv(spark, batch), 1)
    want = dict([(f"k{i}", i) for i in range(20)] + batch)
    assert dict(rows(again.read(spark))) == want
    assert again.touched(spark, 1).count() == 20 and again.touched(spark, 2) is None


def test_an_unfinished_stage_is_made_anew(spark):
    table = BucketTable(work_path(spark, "t_half_b"), ["k"], "k string, v int", buckets=2)
    table.write_batch(_kv(spark, [("a", 1), ("b", 1)]), 0)
    os.makedirs(f"{table.stage(1)}/bucket=0")       # no marker
    table.write_batch(_kv(spark, [("a", 2), ("c", 2)]), 1)
    assert rows(table.read(spark)) == [("a", 2), ("b", 1), ("c", 2)]


def test_empty_batches_leave_the_table(spark):
    table = BucketTable(work_path(spark, "t_empty_b"), ["k"], "k string, v int")
    table.write_batch(_kv(spark, []), 0)
    assert table.read(spark).count() == 0 and table.touched(spark, 0) is None
    table.write_batch(_kv(spark, [("a", 1)]), 1)
    table.write_batch(_kv(spark, []), 2)
    assert rows(table.read(spark)) == [("a", 1)]


# --- roll-ups --------------------------------------------------------------------

def _sales(spark, out):
    return {n: rows(out.sales(n).read(spark)) for n in ("sales_per_category", "sales_per_day", "sales_per_month")}


def test_one_stream_keeps_all_rollups_also_when_it_dies_half_way(spark, monkeypatch):
    out = jobs.Outputs(work_path(spark, "t_roll"))
    in_dir = out.path("_input")

    def run():
        _, table = jobs.land_transactions(files.read_records_stream(spark, in_dir), out, ONCE)
        q = jobs.start_sales_rollups(table.stream(spark), out, ONCE)
        jobs.await_all([q])

    _write_lines(spark, in_dir, [_tx("a", "x", 1.5, 1), _tx("b", "y", 2.25, 1), _tx("c", "x", 4.0, 2),
                                 _tx("h", "x", 1e25, 9)])
    run()
    _write_lines(spark, in_dir, [_tx("d", "x", 0.125, 1), _tx("e", "z", 8.0, 3)])
    real, left = BucketTable.write_batch, [1]

    def dies(self, df, batch_id):
        if self.path.endswith("sales_per_day") and left:
            left.pop()
            raise RuntimeError("killed between two tables")
        real(self, df, batch_id)

    monkeypatch.setattr(BucketTable, "write_batch", dies)
    with pytest.raises(Exception):
        run()
    run()       # the batch is re-run
    got = _sales(spark, out)
    d = lambda n: dt.date(2024, 1, n)
    assert got["sales_per_category"] == [(d(1), "x", 1.625), (d(1), "y", 2.25), (d(2), "x", 4.0), (d(3), "z", 8.0),
                                         (d(9), "x", 1e25)]
    assert got["sales_per_day"] == [(d(1), 3.875), (d(2), 4.0), (d(3), 8.0), (d(9), 1e25)]
    assert got["sales_per_month"] == [(2024, 1, 1e25 + 15.875)]


# --- order of arrival --------------------------------------------------------------

def test_a_later_offset_wins_over_a_newer_record_time(spark):
    at = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame(
        [(_tx("t", amount=1.0), at + dt.timedelta(hours=5), (10, 0)), (_tx("t", amount=2.0), at, (11, 0)),
         (_tx("u", amount=3.0), at, (12, 0))],
        "value string, record_ts timestamp, arrival struct<offset:long,partition:int>")
    tx = jobs.transaction_rows(raw).withColumn("seq", F.lit(0))
    assert rows(sales.latest_transactions(tx, jobs.ARRIVAL), "transaction_id", "total_amount") == [("t", 2.0), ("u", 3.0)]


# --- counter and slot --------------------------------------------------------------

def test_counter_reads_one_row_per_batch_and_survives_replays(spark):
    log = BatchLog(work_path(spark, "t_count"), "cart_id string, abandoned_at timestamp")
    assert log.count(spark).first()[0] == 0 and log.read(spark).count() == 0
    make = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("cart_id"),
                                                 F.lit(T0).alias("abandoned_at"))
    for b, (lo, hi) in enumerate([(0, 5), (5, 5), (5, 12)]):
        log.write_batch(make(lo, hi), b)
        log.write_batch(make(lo, hi), b)        # replayed
    assert log.count(spark).first()[0] == 12 == log.read(spark).count()
    plan = log.count(spark)._jdf.queryExecution().executedPlan().toString()
    assert "t_count" in plan and "_counts" in plan and "cart_id" not in plan
    assert spark.read.parquet(log.counts).count() == 2


def test_an_older_replay_cannot_win_the_slot(spark):
    slot = LatestSlot(work_path(spark, "t_slot"), "m")
    other = LatestSlot(slot.path, "n")
    assert slot.read(spark).count() == 0
    make = lambda *r: spark.createDataFrame([(T0 + dt.timedelta(minutes=m), v) for m, v in r],
                                            "minute_ts timestamp, users bigint")
    slot.write_batch(make((1, 5), (3, 7), (2, 9)), "minute_ts", "users", 0)
    slot.write_batch(make((4, 1)), "minute_ts", "users", 1)
    slot.write_batch(make((1, 5), (3, 7), (2, 9)), "minute_ts", "users", 0)     # an older batch again
    slot.write_batch(make(), "minute_ts", "users", 2)
    other.write_batch(make((0, 3)), "minute_ts", "users", 0)
    assert [r["value"] for r in slot.read(spark).collect()] == [1]
    assert [r["value"] for r in other.read(spark).collect()] == [3]
    slot.write_batch(make((4, 2)), "minute_ts", "users", 3)     # the same time, a later value
    assert [r["value"] for r in slot.read(spark).collect()] == [2]


# --- what a batch and a feed write ---------------------------------------------------

def test_a_staged_batch_is_copied_without_a_shuffle(spark, monkeypatch):
    table = BucketTable(work_path(spark, "t_copy_b"), ["k"], "k string, v int", buckets=4)
    table.write_batch(_kv(spark, [(f"k{i}", i) for i in range(20)] + [(None, 1)]), 0)
    plans, whole = [], writers._dynamic_overwrite

    def seen(df, path, column):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        whole(df, path, column)

    monkeypatch.setattr(writers, "_dynamic_overwrite", seen)
    table.write_batch(_kv(spark, [("k1", -1), (None, 2)]), 1)
    assert len(plans) == 1 and "Exchange" not in plans[0]
    want = [(f"k{i}", i) for i in range(20) if i != 1] + [("k1", -1), (None, 2)]
    assert sorted(map(tuple, table.read(spark).collect()), key=str) == sorted(want, key=str)


def test_a_feed_stores_less_than_its_texts(spark):
    """Records are held by columns and their texts written once, compressed."""
    from basketry.plans.streams import feed_in_chunks
    work = work_path(spark, "t_feed")
    at = dt.datetime(2024, 1, 1)
    records = spark.range(3000).select("id", F.lit("a long text that all records have " * 5).alias("name"),
                                       (F.lit(at).cast("timestamp") + F.make_dt_interval(F.col("id"))).alias("ts"))
    value, seen = F.to_json(F.struct("id", "name")), []

    def run():
        seen.append(files.read_records(spark, f"{work}/in").count())

    feed_in_chunks(records, "ts", f"{work}/in", run, value=value)
    texts = files.read_records(spark, f"{work}/in").select("value")
    assert seen == [1000, 2000, 3000]
    assert rows(texts) == rows(records.select(value.alias("value")))
    stored = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(work) for f in names)
    assert stored < texts.agg(F.sum(F.length("value"))).first()[0] / 3


@pytest.mark.parametrize("name", ["stream_quarantine", "stream_transaction_quarantine"])
def test_damaged_inputs_are_held_by_columns(spark, monkeypatch, name):
    """Of damaged records too, the texts are written once: the held records have none."""
    from basketry.plans import streams
    held, feed = [], streams.feed_in_chunks

    def seen(records, *args, **options):
        held.append(records.columns)
        feed(records, *args, **options)

    monkeypatch.setattr(streams, "feed_in_chunks", seen)
    assert streams.STREAM_QUERIES[name](spark, "/root/testdata/sf0.001").count() > 1
    assert len(held) == 1 and "value" not in held[0]


def test_last_writes_are_found_in_the_shuffle_that_makes_the_files(spark, monkeypatch):
    """Several rows of a key in a batch: none are held in between, and a first batch is not copied."""
    table = BucketTable(work_path(spark, "t_order_b"), ["k"], "k string, v int", buckets=4)
    frame = lambda pairs: spark.createDataFrame([(k, v, (1, f"f{v % 2}"), s) for k, v, s in pairs],
                                                "k string, v int, arrival struct<time int, file string>, seq long")
    copies, whole = [], writers._dynamic_overwrite
    monkeypatch.setattr(writers, "_dynamic_overwrite", lambda *a: copies.append(1) or whole(*a))
    monkeypatch.setattr(type(frame([("a", 1, 1)])), "persist", lambda self: pytest.fail("held in between"))
    first = [(f"k{i}", v, v) for i in range(20) for v in (2, 0, 4)]
    table.write_batch(frame(first), 0, ["arrival", "seq"])
    assert rows(table.read(spark)) == sorted((f"k{i}", 4) for i in range(20)) and not copies
    assert table.touched(spark, 0).count() == 20
    again = [("k1", 10, 5), ("k1", 12, 3), ("k1", 11, 1), ("new", 8, 8), (None, 6, 1), (None, 8, 0)]
    for _ in range(2):      # and once more, as after a crash: the same rows
        table.write_batch(frame(again), 1, ["arrival", "seq"])
        got = sorted(map(tuple, table.read(spark).collect()), key=str)
        assert got == sorted([(f"k{i}", 4) for i in range(20) if i != 1] + [("k1", 11), ("new", 8), (None, 6)], key=str)
    assert len(copies) == 2
