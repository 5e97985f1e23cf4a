"""Source / sink options and DDL (no live services here)."""

import pytest

from basketry import schemas
from basketry.sources import kafka
from basketry.streaming.writers import merge_sql, postgres_upsert_sql


def test_start_position():
    assert kafka.start_position("earliest") == {"startingOffsets": "earliest"}
    assert kafka.start_position("EARLIEST") == {"startingOffsets": "earliest"}
    assert kafka.start_position(None) == {"startingOffsets": "latest"}
    assert kafka.start_position("bogus") == {"startingOffsets": "latest"}
    assert kafka.start_position("timestamp", "1700000000000") == {
        "startingTimestamp": "1700000000000", "startingOffsetsByTimestampStrategy": "latest"}
    assert kafka.start_position("timestamp", "0") == {"startingOffsets": "latest"}
    assert kafka.start_position("timestamp", "-5") == {"startingOffsets": "latest"}
    assert kafka.start_position("timestamp", "abc") == {"startingOffsets": "latest"}


def test_kafka_options():
    o = kafka.kafka_options("broker:9092", start_mode="earliest")
    assert o["kafka.bootstrap.servers"] == "broker:9092"
    assert o["subscribe"] == "financial_transactions"
    assert o["groupIdPrefix"] == kafka.EVENTS_GROUP and "kafka.group.id" not in o
    assert kafka.kafka_options(max_offsets_per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    assert o["startingOffsets"] == "earliest"
    t = kafka.transaction_kafka_options()
    assert t["groupIdPrefix"] == kafka.TRANSACTIONS_GROUP and t["startingOffsets"] == "earliest"
    assert t["kafka.bootstrap.servers"] == "localhost:9092"


def test_ddl_and_keys():
    assert set(schemas.DDL) == set(schemas.TABLE_KEYS)
    for name, ddl in schemas.DDL.items():
        assert ddl.startswith(f"CREATE TABLE IF NOT EXISTS {name} (")
    assert schemas.TRANSACTION_COLUMNS[0] == "transaction_id"
    assert len(schemas.TRANSACTION_COLUMNS) == 12


def test_upsert_statements():
    m = merge_sql("t", "s_1", ["k"], ["k", "v"])
    assert m == ('MERGE INTO t t USING s_1 s ON t."k" = s."k" WHEN MATCHED THEN UPDATE SET '
                 '"v" = s."v" WHEN NOT MATCHED THEN INSERT ("k", "v") VALUES (s."k", s."v")')
    p = postgres_upsert_sql("t", "s_1", ["k"], ["k", "v"])
    assert p.endswith('ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v"')


def test_range_options():
    import json
    t = kafka.range_options(1000, 2000, "h:1", "t")
    assert (t["startingTimestamp"], t["endingTimestamp"], t["subscribe"]) == ("1000", "2000", "t")
    assert "startingOffsets" not in t and "groupIdPrefix" not in t
    assert kafka.range_options(5)["endingOffsets"] == "latest"
    o = kafka.range_options({1: 7, 0: -2}, {0: 9, 1: 8}, topic="t")
    assert json.loads(o["startingOffsets"]) == {"t": {"0": -2, "1": 7}}
    assert json.loads(o["endingOffsets"]) == {"t": {"0": 9, "1": 8}}
    for bad in ((2, 1), (1, {0: 1}), ({0: 1}, {1: 2})):
        with pytest.raises(ValueError):
            kafka.range_options(*bad)
