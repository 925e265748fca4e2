"""Mixing and sharding against plain versions."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from snapledger.llm import mixing, sharding
from snapledger.llm.queries import QUERIES


def plain_targets(sizes: dict, weights, share, most):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if part[s] > most * sizes[s]]
        if not over:
            return part | {s: most * sizes[s] for s in capped}
        capped.update(over)


@pytest.mark.parametrize("name", ["sf", "awkward"])
def test_mix(spark, sf, awkward, name):
    docs = awkward if name == "awkward" else spark.read.parquet(f"{sf}/documents.parquet")
    run = lambda: mixing.plan_mix(docs, [3.0, 1.0, 2.0], 1.5, 2.0)
    got = run().collect()
    given = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()]
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((a or -1, n) for a, _, n in given)
    sizes, largest = {}, {}
    for _, source, n in given:
        sizes[source] = sizes.get(source, 0) + n
        largest[source] = max(largest.get(source, 0), n)
    targets = plain_targets(sizes, [3, 1, 2], 1.5, 2)
    source_of = {(a, n): s for a, s, n in given}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        source = source_of[(r.doc_id, r.size)]
        assert r.source_size == sizes[source] and abs(r.target - targets[source]) < 1e-6
        assert r.copies == len(r.shards) <= 2
        taken[source] += r.copies * r.size
    for source, words in taken.items():
        assert abs(words - targets[source]) <= max(1, largest[source] if name == "awkward" else 0.05 * targets[source])
    key = lambda r: (r.row_hash, tuple(r.shards))
    assert sorted(map(key, run().collect())) == sorted(map(key, got))


def test_long_runs_deal_the_same_documents(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = lambda: {r.row_hash: r for r in mixing.plan_mix(docs, [3.0, 1.0, 2.0], 1.5, 2.0, n_shards=4).collect()}
    monkeypatch.setattr(mixing, "_BLOCK_ROWS", 2)
    one_by_one = plan()
    monkeypatch.setattr(mixing, "_MOST_DRAWS", 16)
    in_runs = plan()
    assert {k: r.copies for k, r in one_by_one.items()} == {k: r.copies for k, r in in_runs.items()}
    assert any(r.shards != in_runs[k].shards for k, r in one_by_one.items())
    dealt = collections.Counter(s for r in in_runs.values() for s in r.shards)
    assert set(dealt) == {0, 1, 2, 3} and max(dealt.values()) < 3 * min(dealt.values())


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_random_order_is_one_order_for_any_ranges(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "_RANGE_BITS", bits)
    rows = [(n, b, 10 * n + b % 7) for n in (1, 2) for b in range(150 * n)]
    df = spark.createDataFrame(rows, "number int, block long, words long")
    got = mixing.in_random_order(df, seed=3).collect()
    assert len(got) == len(rows)
    hashes = {(r.number, r.block): r.h for r in df.select("number", "block", F.xxhash64(F.lit(3), "number", "block").alias("h")).collect()}
    for n in (1, 2):
        mine = sorted((r for r in got if r.number == n), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(150 * n))
        assert [hashes[n, r.block] for r in mine] == sorted(hashes[n, r.block] for r in mine)
        assert [r.words_before for r in mine] == [sum(q.words for q in mine[:i]) for i in range(len(mine))]
    assert mixing.in_random_order(df.limit(0), seed=3).count() == 0


def test_mixed_rows_follow_the_plan(spark, awkward, empty):
    plan = mixing.plan_mix(awkward, [3.0, 1.0, 2.0], 1.5, 2.0).collect()
    mixed = mixing.mix_documents(awkward, [3.0, 1.0, 2.0], 1.5, 2.0)
    assert mixed.columns == awkward.columns
    assert mixed.count() == sum(r.copies for r in plan)
    assert mixing.mix_documents(empty, [1.0], 1.5, 2.0).count() == 0


@pytest.mark.parametrize("shards", [1, 5, 8])
def test_quotas_are_split_exactly(spark, shards):
    quotas = {1: 40, 2: 0, 3: 7, 4: 100}
    df = spark.createDataFrame(list(quotas.items()), "number int, blocks long")
    got = mixing.split_quotas(df, shards, seed=1).collect()
    for number, n in quotas.items():
        assert sum(r.blocks for r in got if r.number == number) == n
    per_shard = [sum(r.blocks for r in got if r.shard == s) for s in range(shards)]
    assert max(per_shard) - min(per_shard) <= 1


def test_draws_are_hypergeometric(spark):
    # Of 30 and 10 blocks, 20 go left: 15 of the first on average, with variance 20 * 3/16 * 20/39.
    df = spark.createDataFrame([(1, 30), (2, 10)], "number int, blocks long")
    got = [
        {(r.number, r.shard): r.blocks for r in mixing.split_quotas(df, 2, seed=s).collect()}[(1, 0)] for s in range(60)
    ]
    assert abs(sum(got) / len(got) - 15) < 0.8 and len(set(got)) > 2


def test_room_tree_and_packing():
    rng = random.Random(5)
    for _ in range(30):
        groups = [rng.randint(1, 60) for _ in range(rng.randint(0, 80))]
        capacity = rng.randint(40, 120)
        bins = []
        for size in sorted(groups, reverse=True):
            fitting = [(b, i) for i, b in enumerate(bins) if b >= size]
            if fitting:
                bins[min(fitting)[1]] -= size
            else:
                bins.append(max(capacity, size) - size)
        counted = {s: groups.count(s) for s in groups}
        runs, shards = sharding.best_fit_decreasing(list(counted.items()), capacity)
        assert shards == len(bins)
        for size, n in counted.items():
            assert sum(r[2] for r in runs if r[0] == size) == n


@pytest.mark.parametrize("name", ["sf", "awkward"])
def test_shards(spark, sf, awkward, name):
    docs = awkward if name == "awkward" else spark.read.parquet(f"{sf}/documents.parquet")
    got = sharding.shard_documents(docs, n_shards=8).collect()
    text = [(r.text or "") for r in docs.collect()]
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len(t.encode()) + 1, zlib.crc32(t.encode())) for t in text)
    shard_of = {}
    for r in got:
        assert shard_of.setdefault((r.size, r.text_crc32), r.shard) == r.shard
    sizes = {}
    for s in {r.shard for r in got}:
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own))) and 0 <= s < 8
        sizes[s] = sum(r.size for r in own)
    if name == "sf":
        assert max(sizes.values()) <= 1.01 * sum(sizes.values()) / 8


def test_large_groups_have_shards_of_their_own(spark):
    texts = [f"{i:06d}" + "x" * (i % 150) for i in range(6000)]
    total = sum(len(t) + 1 for t in texts)
    third = total // 2 // 100  # copies of 99 characters, a third of all bytes
    rows = [(i, t) for i, t in enumerate(texts + ["c" * 99] * third)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), n_shards=8)
    sizes = sorted(r[1] for r in got.groupBy("shard").sum("size").collect())
    assert len(sizes) == 8 and sum(sizes) == total + 100 * third
    assert sizes[-1] == 100 * third and sizes[-2] <= 1.01 * total / 7 and sizes[0] >= 0.99 * total / 7
    for held in ([(50, 2), (1, 700)], [(9, 20)], [(7, 3)], [(5, 9), (100, 1)], [(1000, 1), (300, 1), (1, 60)], []):
        for n_shards in (1, 2, 5, 8):
            runs = sharding.even_shards(held, n_shards)
            assert sum(s * n for s, _, n, _ in runs) == sum(s * n for s, n in held)
            assert all(0 <= shard < n_shards for *_, shard in runs)
            for size, n in held:
                places = sorted(f + k for s, f, c, _ in runs if s == size for k in range(c))
                assert places == list(range(n))


def test_fixed_capacity_and_empty(spark, awkward, empty):
    got = sharding.shard_documents(awkward, capacity=2000).groupBy("shard").sum("size").collect()
    # The two texts that are larger have a shard each.
    assert sorted(r[1] > 2000 for r in got) == [False, False, True, True]
    assert sharding.shard_documents(empty, n_shards=8).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_documents(awkward)


def test_registered_columns(spark, sf):
    rows = QUERIES["op9_shards"](spark, sf)
    assert rows.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = QUERIES["op4_source_mix"](spark, sf)
    assert rows.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
