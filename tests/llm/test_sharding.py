import tempfile
from collections import defaultdict
from zlib import crc32

from basketry.llm.sharding import SlotMap, shard_documents

from .helpers import AWKWARD, CLASHING, frame


def test_contract(spark):
    rows = AWKWARD + [(100 + i, "x" * (i * 37 % 900), None, None) for i in range(3000)]
    placed, _ = shard_documents(frame(spark, rows, CLASHING), 8)
    got = placed.collect()
    assert len(got) == len(rows)
    places, load = defaultdict(list), defaultdict(int)
    for r in got:
        places[r["shard"]].append(r["place"])
        load[r["shard"]] += r["size"]
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) <= 150_100  # one very long text
    want = sorted((len((t or "").encode()) + 16, crc32((t or "").encode())) for _, t, _, _ in rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want


def test_rebalancing_edits_few_slots():
    loads = {s: 100 + s % 7 for s in range(1000)}
    first = SlotMap.balanced(loads, 8, 1000)
    grown = dict(loads) | {s: 400 for s in range(0, 1000, 40)}
    second = first.rebalanced(grown)
    total = defaultdict(int)
    for s, x in enumerate(second.shard_of):
        total[x] += grown[s]
    assert max(total.values()) - min(total.values()) <= 401
    assert second.version == 1 and len(second.moved) < 200
    more = second.rebalanced(grown, shards=9)
    assert all(b == 8 or a == b for a, b in zip(second.shard_of, more.shard_of) if b == 8) and 8 in more.shard_of
    less = more.rebalanced(grown, shards=4)
    assert max(less.shard_of) == 3


def test_versions_are_stored(spark):
    path = tempfile.mkdtemp()
    first = SlotMap.balanced({s: s for s in range(64)}, 4, 64)
    first.save(spark, path)
    second = first.rebalanced({s: 1 + s * s for s in range(64)})
    second.save(spark, path)
    assert SlotMap.load(spark, path, 0).shard_of == first.shard_of
    assert SlotMap.load(spark, path, 1).shard_of == second.shard_of


def test_empty(spark):
    assert shard_documents(frame(spark, []), 8)[0].count() == 0
