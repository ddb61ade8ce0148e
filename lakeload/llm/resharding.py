"""Rows moved between shards so that as few bytes as possible are moved.

Old shard sizes and new capacities make a minimum-cost flow: a byte that stays costs nothing, one
that moves costs one. Its solution says how many bytes go from each shard to each other; blocks of
rows carry them, and only files of shards that give rows away or take some are written.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.names import column

BLOCKS = 1024


def min_cost_flow(
    supplies: Mapping[int, int], capacities: Sequence[int]
) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one, the fewest possible moved.

    Successive shortest paths with potentials, over a graph of shards: its size does not depend on
    the rows. ``capacities[j]`` is what new shard ``j`` takes; together they must hold everything.
    """
    if sum(supplies.values()) > sum(capacities):
        raise ValueError("the new shards cannot hold everything")
    old = [i for i in sorted(supplies) if supplies[i]]
    new = list(range(len(capacities)))
    source, sink = ("source", 0), ("sink", 0)
    graph: dict[tuple, dict[tuple, list[int]]] = {source: {}, sink: {}}

    def edge(a, b, room, cost):
        graph.setdefault(a, {})[b] = [room, cost]
        graph.setdefault(b, {})[a] = [0, -cost]

    for i in old:
        edge(source, ("old", i), supplies[i], 0)
        for j in new:
            edge(("old", i), ("new", j), supplies[i], int(i != j))
    for j in new:
        edge(("new", j), sink, capacities[j], 0)
    potential = dict.fromkeys(graph, 0)
    while True:
        cost, came = _shortest(graph, potential, source)
        if sink not in cost:
            break
        for node in graph:
            potential[node] += min(cost.get(node, cost[sink]), cost[sink])
        path = [sink]
        while path[-1] != source:
            path.append(came[path[-1]])
        steps = list(zip(path[1:], path, strict=False))
        amount = min(graph[a][b][0] for a, b in steps)
        for a, b in steps:
            graph[a][b][0] -= amount
            graph[b][a][0] += amount
    flow = {(i, j): graph[("new", j)][("old", i)][0] for i in old for j in new}
    return {pair: amount for pair, amount in flow.items() if amount}


def _shortest(graph, potential, source):
    cost, came, done = {source: 0}, {}, set()
    waiting = [(0, source)]
    while waiting:
        so_far, node = heapq.heappop(waiting)
        if node in done:
            continue
        done.add(node)
        for to, (room, price) in graph[node].items():
            total = so_far + price + potential[node] - potential[to]
            if room and total < cost.get(to, total + 1):
                cost[to], came[to] = total, node
                heapq.heappush(waiting, (total, to))
    return cost, came


def equal_capacities(total: int, shards: int) -> list[int]:
    """``total`` split into whole numbers at most one apart."""
    return [total * (j + 1) // shards - total * j // shards for j in range(shards)]


def row_size(text: Column) -> Column:
    """What a row counts for: the bytes of its text (none if null) and one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def reshard(
    docs: DataFrame,
    path: str,
    *,
    old_shard: str,
    shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    blocks: int = BLOCKS,
) -> DataFrame:
    """Put every row into one of ``shards`` shards of nearly equal bytes, moving as few as can be.

    ``old_shard`` is an integer column; an old shard whose number is not that of a new one goes
    away. Rows of a shard are dealt to blocks by a hash of id and text, at most ``blocks`` to a
    shard; blocks in turn stay, or go where the flow sends them. The block at which a transfer ends
    is cut between two rows, so a shard misses its capacity by half a row's size at most for each
    transfer.

    Rows that change shard, and those of shards that give some away, are written under ``path``,
    one folder a shard. The files of the other shards stay as they are and are only added to.
    Returned are all rows, read from where they now are, with ``size``, ``shard`` and ``slot``
    (gapless from 0 in each shard) added; columns of these names are replaced. Null ids and texts
    are values like others; equal rows are kept, all of them; an empty table gives no rows.
    """
    spark = docs.sparkSession
    given = [name for name in docs.columns if name not in ("size", "shard", "slot")]
    kept = F.struct(*[column(name).alias(f"c{k}") for k, name in enumerate(given)])
    # Names of our own from here on; whatever the input has is inside ``row``.
    rows = docs.select(
        kept.alias("row"),
        column(old_shard).cast("int").alias("old"),
        row_size(column(text)).alias("size"),
        F.xxhash64(column(doc_id).cast("string"), column(text)).alias("hash"),
    ).withColumn("block", F.pmod("hash", F.lit(blocks)).cast("int"))

    sizes = rows.groupBy("old", "block").agg(F.sum("size").alias("bytes"))
    # At most ``blocks`` numbers for each old shard, then one for each.
    ordered = Window.partitionBy("old").orderBy("block")
    starts = sizes.withColumn("first", F.sum("bytes").over(ordered) - F.col("bytes"))
    supplies = {
        r.old: r.bytes for r in sizes.groupBy("old").agg(F.sum("bytes").alias("bytes")).collect()
    }
    flow = min_cost_flow(supplies, equal_capacities(sum(supplies.values()), shards))

    inside = Window.partitionBy("old", "block").orderBy("hash", "size")
    placed = rows.join(F.broadcast(starts.drop("bytes")), ["old", "block"]).withColumn(
        "at", F.col("first") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    )
    placed = placed.withColumn("at", F.coalesce("at", "first"))
    placed = placed.withColumn("shard", _target(flow))
    placed = placed.withColumn(
        "n", F.row_number().over(Window.partitionBy("old", "block", "shard").orderBy("hash", "size"))
    )
    losing = sorted({i for i, j in flow if i != j})
    written = placed.filter(F.col("old").isin(losing)) if losing else placed.filter("false")
    written.drop("at", "first", "hash").write.partitionBy("shard").parquet(path)
    moved = _read(spark, path, written)
    stay = placed.filter(~F.col("old").isin(losing)) if losing else placed
    every = moved.unionByName(stay.select(moved.columns))

    counts = every.groupBy("shard", "old", "block").agg(F.count("*").alias("rows"))
    ahead = Window.partitionBy("shard").orderBy("old", "block")
    bases = counts.withColumn("base", F.sum("rows").over(ahead) - F.col("rows")).drop("rows")
    numbered = every.join(bases, ["shard", "old", "block"])
    back = [F.col(f"row.c{k}").alias(name) for k, name in enumerate(given)]
    slot = (F.col("base") + F.col("n") - 1).cast("bigint").alias("slot")
    return numbered.select(*back, "size", "shard", slot)


def _read(spark: SparkSession, path: str, written: DataFrame) -> DataFrame:
    columns = ["row", "old", "size", "block", "n", "shard"]
    schema = written.select(columns).schema
    return spark.read.schema(schema).parquet(path).select(columns)


def _target(flow: Mapping[tuple[int, int], int]) -> Column:
    """The new shard of a row, by its old one and its place among the bytes there.

    What stays comes first. A byte range for each transfer: at most one more than there are shards.
    """
    target = F.lit(None).cast("int")
    for i in sorted({i for i, _ in flow}):
        ranges = sorted((i != j, j) for a, j in flow if a == i)
        choice = F.lit(ranges[-1][1])
        upper = sum(flow[i, j] for _, j in ranges)
        for (_, j), (_, after) in zip(ranges[-2::-1], ranges[:0:-1], strict=True):
            upper -= flow[i, after]
            choice = F.when(F.col("at") + F.col("size") / 2 < upper, F.lit(j)).otherwise(choice)
        target = F.when(F.col("old") == i, choice).otherwise(target)
    return target.cast("int")
