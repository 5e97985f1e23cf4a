import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from basketry.llm import packing
from basketry.llm.queries import vocabulary

from .helpers import AWKWARD, CLASHING, frame


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece(seed):
    r = random.Random(seed)
    counts = Counter(min(4096, max(1, int(r.lognormvariate(6.5, 1.2)))) for _ in range(r.choice([1, 30, 3000])))
    runs = packing.best_plan(dict(counts))
    held = Counter()
    for bins, items in runs:
        assert 0 < sum(items) <= 4096
        for n in items:
            held[n] += bins
    assert held == counts
    least = -(-sum(n * c for n, c in counts.items()) // 4096)
    assert sum(b for b, _ in runs) <= 1.05 * least + 1


def test_plan_grows_with_lengths_not_pieces():
    counts = {n: 1_000_000 + n for n in range(1, 4097, 3)}
    runs = packing.best_plan(counts)
    assert len(runs) < 20_000 and sum(b for b, _ in runs) <= 1.01 * sum(n * c for n, c in counts.items()) / 4096


def test_configurations_respect_demand():
    for pattern, m in packing.configurations([3000, 2100, 1300, 1100], [40, 33, 70, 21], 4096):
        assert (pattern * np.array([3000, 2100, 1300, 1100])).sum() <= 4096 and m > 0


def test_tokens_equal_the_tokenizer():
    t = packing.WordTokens(vocabulary())
    r = random.Random(3)
    alphabet = "".join(map(chr, range(0x17F))) + "'s't’é日😀́   \n<|endoftext|>"
    odd = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(1500)] + ["", "<|endoftext|> a"]
    want = [np.asarray(e.ids, "<u4").tobytes() for e in t.full.encode_batch(odd, add_special_tokens=False)]
    assert t(odd) == want


def test_round_trip(spark):
    rows = AWKWARD + [(100 + i, f"number {i} " * (i % 40), "en", "s") for i in range(200)]
    docs = frame(spark, rows, CLASHING)
    got = packing.pack_documents(docs, vocabulary(), capacity=64, with_ids=True).collect()
    t = packing.WordTokens(vocabulary())
    want = Counter((i, t([x or ""])[0] + b"\x01\0\0\0") for i, x, _, _ in rows)
    places, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], bytes(r["ids"])))
    for p in places.values():
        at = 0
        for offset, n in sorted(p):
            assert offset == at
            at += n
        assert at <= 64
    for (doc, ids), n in want.items():
        own = sorted(pieces[doc])
        assert b"".join(x for _, _, x in own[::n]) == ids or n > 1
    assert sum(len(p) for p in places.values()) == sum(n * -(-len(i) // 256) for (_, i), n in want.items())


def test_empty(spark):
    assert packing.pack_documents(frame(spark, []), vocabulary()).count() == 0
