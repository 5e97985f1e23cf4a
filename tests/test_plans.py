"""Plan-shape regression tests: the properties the scale design relies on."""

import json
import re

import __spark_entry__ as E
from basketry.session import work_path
from basketry.sources import files
from basketry.streaming import jobs
from basketry.operators import carts, top_products

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_limits_before_the_shuffle(spark):
    p = plan(E.queries()["top_products_hourly"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p
    # partial limit sits below the exchange that feeds the final window
    assert p.index("Final") < p.index("Exchange hashpartitioning(hour_ts") < p.index("Partial")
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_last_write_wins_limits_before_the_shuffle(spark):
    p = plan(E.queries()["transactions_latest"](spark, SF))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", p)


def test_abandoned_carts_aggregate_only(spark):
    p = plan(E.queries()["abandoned_carts"](spark, SF))
    assert "partial_max" in p and "partial_min" in p
    assert "Window [" not in p and "SortMergeJoin" not in p and "SortAggregate" not in p
    assert p.count("Exchange") == 1


def test_active_users_pre_distinct_before_fan_out(spark):
    p = plan(E.queries()["active_users_5m"](spark, SF))
    fan_out = p.index("Generate explode(sequence")
    pre_distinct = p.index("HashAggregate(keys=[b", fan_out)
    assert pre_distinct > fan_out           # the pre-distinct runs below the fan-out
    assert "Expand" not in p                # single distinct aggregate: no Expand


def test_json_is_parsed_once(spark):
    for key in ["decode_events", "decode_transactions", "quarantine_events"]:
        p = plan(E.queries()[key](spark, SF))
        assert p.count("from_json") == 1, key


def test_scans_read_only_named_columns(spark):
    p = plan(E.queries()["sales_per_day"](spark, SF))
    scan = re.search(r"FileScan parquet \[([^]]*)\][^\n]*lineitem", p)
    cols = {c.split("#")[0] for c in scan.group(1).split(",")}
    assert cols == {"l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate"}


def test_stream_routes_stay_above_the_watermark(spark):
    d = work_path(spark, "t_plan_wm")
    spark.createDataFrame([(json.dumps({"eventId": "e", "eventType": "page_view",
                                        "timestamp": "2024-01-01T00:00:00Z"}),)],
                          "value string").write.text(d)
    events, _ = jobs.decode_event_stream(files.read_records_stream(spark, d))
    for df in [top_products.product_sales_windowed(events), carts.abandoned_carts(events)]:
        p = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        above, below = p[:p.index("EventTimeWatermark")], p[p.index("EventTimeWatermark"):]
        # no filter that routes by type or cart runs below the watermark
        below_filters = [ln for ln in below.splitlines() if "Filter" in ln]
        assert not any(w in ln for ln in below_filters
                       for w in ("add_to_cart", "cartId", "eventType")), below_filters
        assert any("add_to_cart" in ln for ln in above.splitlines() if "Filter" in ln)
