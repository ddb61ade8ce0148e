import itertools
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeload.llm.queries import QUERIES
from lakeload.llm.resharding import equal_capacities, min_cost_flow, reshard
from lakeload.llm.storage import new_path

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_flow_moves_as_few_bytes_as_can_be():
    chance = random.Random(6)
    for _ in range(60):
        old = {i: chance.randint(0, 50) for i in range(chance.randint(1, 6))}
        capacities = equal_capacities(sum(old.values()) + chance.randint(0, 9), chance.randint(1, 6))
        flow = min_cost_flow(old, capacities)
        for i, amount in old.items():
            assert sum(n for (a, _), n in flow.items() if a == i) == amount
        for j, room in enumerate(capacities):
            assert sum(n for (_, b), n in flow.items() if b == j) <= room
        # What can stay is the smaller of a shard's size and its new capacity.
        stays = sum(min(old.get(j, 0), room) for j, room in enumerate(capacities))
        assert sum(n for (i, j), n in flow.items() if i == j) == stays


def test_flow_needs_room():
    with pytest.raises(ValueError):
        min_cost_flow({0: 5}, [2, 2])


@pytest.mark.parametrize("shards, blocks", [(4, 1), (4, 64), (9, 16)])
def test_reshard(spark, documents, shards, blocks):
    chance = random.Random(8)
    texts = ["x" * chance.randint(0, 300) for _ in range(900)]
    docs = documents(texts).withColumn("old", F.pmod(F.col("doc_id") * 7, F.lit(5)).cast("int"))
    rows = reshard(docs, new_path(spark, "s"), old_shard="old", shards=shards, blocks=blocks).collect()
    assert sorted(r.doc_id for r in rows) == list(range(900))
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text == texts[r.doc_id] for r in rows)
    sizes = {}
    for shard, held in itertools.groupby(sorted(rows, key=lambda r: (r.shard, r.slot)), key=lambda r: r.shard):
        held = list(held)
        assert [r.slot for r in held] == list(range(len(held)))
        sizes[shard] = sum(r.size for r in held)
    assert len(sizes) == shards
    assert max(sizes.values()) - min(sizes.values()) < 900


def test_shards_that_give_nothing_stay(spark, documents):
    """Two shards of one row each and a third to share out: only the third's rows are written."""
    texts = ["a" * 99, "b" * 99] + ["c"] * 50
    docs = documents(texts).withColumn("old", F.least("doc_id", F.lit(2)).cast("int"))
    path = new_path(spark, "s")
    rows = reshard(docs, path, old_shard="old", shards=3).collect()
    assert {r.shard for r in rows if r.doc_id > 1} == {2}
    assert spark.read.schema("size bigint").parquet(path).count() == 0


def test_awkward_rows(spark, awkward, documents):
    docs = awkward.withColumn("old", F.lit(3)).withColumnRenamed("source", "slot")
    out = reshard(docs.withColumnRenamed("lang", "hash"), new_path(spark, "s"), old_shard="old", shards=2)
    rows = out.collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in rows))) == sorted(
        map(repr, ((r.doc_id, r.text) for r in awkward.collect()))
    )
    assert "hash" in out.columns and out.columns.count("slot") == 1
    empty = documents([]).withColumn("old", F.lit(0))
    assert reshard(empty, new_path(spark, "s"), old_shard="old", shards=4).count() == 0


def test_the_query_moves_as_few_bytes_as_can_be(spark):
    rows = QUERIES["op7_min_cost_resharding"](spark, SF_DIR).collect()
    old, new = Counter(), Counter()
    for r in rows:
        old[r.old_shard] += r.size
        new[r.shard] += r.size
    capacities = equal_capacities(sum(old.values()), 16)
    stays = sum(r.size for r in rows if r.shard == r.old_shard)
    most = sum(min(old[j], room) for j, room in enumerate(capacities))
    longest = max(r.size for r in rows)
    assert len(old) == 20 and 0 < stays
    # Blocks are cut between rows.
    assert abs(most - stays) <= 36 * longest
    assert sorted(new) == list(range(16))
    assert all(abs(new[j] - room) <= 36 * longest for j, room in enumerate(capacities))
    for shard in range(16):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
