import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quarrylight.llm import mixing, sharding

from .conftest import doc


def _docs(n=400, seed=3):
    rnd = random.Random(seed)
    rows = [doc(i, " ".join(["wörd"] * rnd.choice([1, 3, 20, 200, 2000])) + str(i), rnd.choice(["a", "b", "c", "d", None])) for i in range(n)]
    rows += [doc(1000 + i, "the same text over and over", "a") for i in range(n // 2)]
    return [*rows, doc(5000, None), doc(5001, ""), doc(None, "no id"), doc(7, rows[7][1], rows[7][3])]


def test_shards_are_near_equal_and_gapless(documents):
    rows = _docs()
    out = sharding.assign(documents(rows), 8).collect()
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    loads = Counter()
    for r in out:
        loads[r.shard] += r.size
    mean = sum(loads.values()) / 8
    assert set(loads) == set(range(8)) and max(abs(v - mean) for v in loads.values()) < 0.05 * mean
    for s in range(8):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))


def test_shard_records_keep_rows_and_repeat(documents):
    rows = _docs()
    df = documents(rows)
    first = sharding.shard_records(df, 4)
    assert first.columns == [c for c in df.columns if c != "shard"] + ["shard", "slot"]
    assert Counter((r.doc_id, r.text) for r in first.collect()) == Counter((r[0], r[1]) for r in rows)
    again = sharding.shard_records(df.repartition(7), 4)
    assert Counter(first.select("doc_id", "shard", "slot").collect()) == Counter(again.select("doc_id", "shard", "slot").collect())


def test_sharding_empty_and_bad(documents):
    assert sharding.assign(documents([]), 4).count() == 0
    assert sharding.assign(documents([doc(1, "a")]), 4).count() == 1
    with pytest.raises(ValueError):
        sharding.assign(documents([]), 0)
    with pytest.raises(ValueError):
        sharding.assign(documents([]), 2, text_col="nothing")


def test_targets_are_capped_and_reshared():
    got = mixing.targets({"b": 10, "a": 1000, None: 10, "c": 500})
    assert got["b"] == 30 and got[None] == 30.0 and list(got) == ["a", "b", "c", None]
    assert abs(sum(got.values()) - 1520) < 1e-9 and abs(got["c"] - 3 * got["a"]) < 1e-9
    assert mixing.targets({"a": 0}) == {"a": 0.0} and mixing.targets({}) == {}


def test_quotas_add_up():
    counts = np.array([100, 7, 0, 33])
    out = mixing.split_quotas(counts, 5, 1)
    assert (out.sum(0) == counts).all() and (out >= 0).all() and np.ptp(out.sum(1)) <= 4
    assert (mixing.split_quotas(counts, 5, 1) == out).all()


def test_mix_table(documents):
    rows = _docs(900)
    out = mixing.mix_table(documents(rows)).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((i, len((t or "").split())) for i, t, *_ in rows)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = mixing.targets(dict(sizes))
    by_id = {i: s for i, _, _, s, _ in rows}
    taken = Counter()
    for r in out:
        s = by_id[r.doc_id]
        assert r.source_size == sizes[s] and r.target == want[s] and r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 5 for s in want)
    assert Counter(out) == Counter(mixing.mix_table(documents(rows).repartition(9)).collect())


def test_mix_repeats_rows_as_the_table_says(documents):
    rows = [r for r in _docs(300) if r[0] is not None]
    table = Counter()
    for r in mixing.mix_table(documents(rows)).collect():
        table[r.doc_id] += r.taken // r.size if r.size else 0
    df = documents(rows)
    got = mixing.mix(df)
    assert got.columns == df.columns
    assert Counter(r.doc_id for r in got.collect()) == +table


def test_shards_of_the_mixture_are_disjoint_and_even(documents):
    """Every repeat has one shard of its own, the same wherever the row lies, and shards get near equal numbers of blocks."""
    rows = [r for r in _docs(3000) if r[0] is not None and r[0] < 5000]
    out = mixing.mix_table(documents(rows), n_shards=4).collect()
    dealt = Counter()
    for r in out:
        own = [int(s) for s in r.shards.split(",") if s]
        assert len(own) * r.size == r.taken and all(0 <= s < 4 for s in own)
        dealt.update(own)
    assert set(dealt) == set(range(4)) and max(dealt.values()) < 1.6 * min(dealt.values())
    assert {(r.doc_id, r.shards) for r in out} == {(r.doc_id, r.shards) for r in mixing.mix_table(documents(rows).repartition(5), n_shards=4).collect()}


def test_mix_empty(documents):
    assert mixing.mix_table(documents([])).count() == 0 and mixing.mix(documents([])).count() == 0
    assert [r.taken for r in mixing.mix_table(documents([doc(1, None), doc(2, "")])).collect()] == [0, 0]
