"""Rows that once were lost, merged, rounded or crashed a job."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from basketry.functions import codec
from basketry.operators import active_users, sales, top_products
from basketry.session import checkpoint_root, work_path
from basketry.sources import files
from basketry.streaming import jobs
from tests.conftest import rows
from tests.test_streaming import ONCE, _pv, _write_lines

TX = "transaction_id string, product_category string, total_amount double, transaction_date timestamp"
DAY = dt.datetime(2024, 1, 1)


def _tx(i, category="c", amount=1.0, day=1, **more):
    r = {"transactionId": i, "productCategory": category, "totalAmount": amount, "productId": "p",
         "transactionDate": None if day is None else int(dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc).timestamp() * 1000)}
    return json.dumps({k: v for k, v in (r | more).items() if v is not None})


def test_amounts_are_not_rounded_to_cents(spark):
    tx = spark.createDataFrame([("a", "c", 0.004, DAY)] * 3 + [("b", "d", 0.125, DAY)], TX)
    assert rows(sales.sales_per_category(tx), "category", "total_sales") == [("c", 0.012), ("d", 0.125)]


@pytest.mark.parametrize("amount", [1e18, 9.3e16, 1e25, 1.7e308])
def test_huge_amounts_do_not_fail(spark, amount):
    tx = spark.createDataFrame([("a", "c", amount, DAY), ("b", "c", 1.0, DAY)], TX)
    assert rows(sales.sales_per_day(tx), "total_sales")[0][0] == pytest.approx(amount + 1.0)
    ev = spark.createDataFrame([("e", DAY, "p", amount)] * 3, "eventId string, event_ts timestamp, product_id string, amount double")
    got = top_products.product_sales_windowed(ev, from_sales=True).first()["amount"]
    assert got == pytest.approx(3 * amount) or got == float("inf")


def test_dates_out_of_range_and_nested_values_are_bad_types(spark):
    lines = [_tx("a", transactionDate=10**17), _tx("b", transactionDate=-(10**17)), _tx("c"),
             '{"transactionId": {"x": 1}}', '{"transactionId": "{not nested}"}', '{"productId": [1]}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r["value"]: r["reason"] for r in codec.decode_transactions(df).collect()}
    assert [got[x] for x in lines] == ["bad_type", "bad_type", None, "bad_type", None, "bad_type"]


def test_transaction_job_dead_letters_missing_keys_and_keeps_the_last_write(spark):
    out = jobs.Outputs(work_path(spark, "t_keys"))
    in_dir = out.path("_input")
    _write_lines(spark, in_dir, [
        _tx("t1", amount=10.0), _tx(None), _tx(None, amount=2.0), _tx("t2", category=None), _tx("t3", day=None),
        _tx("t4", amount=5.0, day=3), _tx("t4", amount=3.0, day=1), _tx("t5", amount=1e18)])
    jobs.await_all(jobs.start_transaction_job(files.read_records_stream(spark, in_dir), out, ONCE))
    assert [r["reason"] for r in out.dead_letters(spark, "transactions").collect()] == ["null_key"] * 4
    assert rows(out.transactions().read(spark), "transaction_id", "total_amount") == [
        ("t1", 10.0), ("t4", 3.0), ("t5", 1e18)]
    day = {r["transaction_date"].day: r["total_sales"] for r in out.sales("sales_per_day").read(spark).collect()}
    assert day == {1: 1e18 + 13.0, 3: 5.0}


def test_untyped_events_advance_the_watermark(spark):
    out = jobs.Outputs(work_path(spark, "t_untyped"))
    in_dir = out.path("_input")
    t0 = dt.datetime(2024, 1, 1)
    late = json.dumps({"eventId": "x", "timestamp": "2024-01-01T05:00:00Z"})
    for lines in ([_pv(1, "u", t0)], [late]):
        _write_lines(spark, in_dir, lines)
        events, _ = jobs.decode_event_stream(files.read_records_stream(spark, in_dir))
        jobs.await_all([jobs.start_active_users(events, out, ONCE)])
    assert out.active_users().read(spark).count() == 5


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        checkpoint_root(Session())


def test_search_documents_are_written(spark):
    folder = work_path(spark, "t_docs")
    out = jobs.Outputs(work_path(spark, "t_search"), search={"format": "json", "options": {"path": folder}})
    in_dir = out.path("_input")
    _write_lines(spark, in_dir, [_tx("t1", amount=2.5), _tx("t2")])
    _, table = jobs.land_transactions(files.read_records_stream(spark, in_dir), out, ONCE)
    jobs.await_all([jobs.start_transactions_table(table.stream(spark), out, trigger=ONCE)])
    docs = spark.read.json(folder).collect()
    assert sorted((d["index"], d["id"]) for d in docs) == [("transactions", "t1"), ("transactions", "t2")]
    assert json.loads(sorted(docs, key=lambda d: d["id"])[0]["doc"])["totalAmount"] == 2.5


def test_hour_read_reaches_the_scan(spark):
    from basketry.plans.queries import serve_top_products
    plan = serve_top_products(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
