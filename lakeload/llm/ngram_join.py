"""Near copies: documents whose sets of word shingles are similar, and what they link up to.

Documents with the same set make one node. Two sets that are similar enough share a shingle among
the first few of each, in any order that holds for all sets, so nodes meet in a tile for each such
shingle. The order puts frequent shingles last, which keeps tiles small, and tiles of the very same
nodes, as the shingles of a passage make, are one. A tile is cut to blocks, and these are compared
with one another by bitmaps of their sets: the bits in which two bitmaps differ bound the overlap
from above. What passes is decided by intersecting the sorted sets.

So that a large group of near copies is not compared pair by pair, every node is first held against
the likeliest of its tiles, then every component against the likeliest other, a few times; after that
only nodes not yet connected are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeload.llm import storage
from lakeload.llm.components import components
from lakeload.llm.encoding import forget_encoder
from lakeload.llm.shingles import SHINGLE_WORDS, shingle_set, word_hashes
from lakeload.names import column

#: Similarity as a fraction: 100 * overlap >= 75 * union.
PER_CENT = 75
#: A frequent shingle is one that six documents of a slice have; a slice ends at either bound. Which ones are
#: found changes what the join costs, never its result.
COUNTED_DOCS = 2000
COUNTED_SHINGLES = 1 << 20
COUNTED_LEAST = 6
#: So many of the most frequent shingles are told to all tasks: half a megabyte.
FREQUENT = 1 << 16
BLOCK = 1024
#: Tokens meet in so many parts, one after the other: only one part's are in shuffle files at a time.
TOKEN_PARTS = 2
#: Tiles of more nodes than that are summed up before they meet, and ordered by size in parts.
LARGE_TILE = 4096
#: A node's set is sent once for so many of its pairs.
PAIRS_A_SET = 64
#: So often at most, components look for their likeliest links before all pairs that are left over
#: are compared. It changes what the join costs, never its result.
TURNS = 2
#: Ids of documents to look up are broadcast up to this many (32 MB), beyond that joined.
BROADCAST_IDS = 2_000_000

#: Of rows that Python gets at once. A batch is there several times, in Spark and in Python, for each
#: task; Spark's own bound, 10,000 rows, is dozens of MB of texts, bitmaps or sets.
BATCH_BYTES = 4 << 20

_MAX_BITS = 1 << 16
_PAIRS = 1 << 15
_ROWS = 1024


def stored(df: DataFrame, name: str) -> DataFrame:
    return storage.stored(df, name, batch_bytes=BATCH_BYTES)


def least_overlap(n: np.ndarray | int, m: np.ndarray | int, per_cent: int = PER_CENT):
    """The smallest overlap with which sets of ``n`` and ``m`` are similar."""
    return -(-per_cent * (n + m) // (100 + per_cent))


def prefix_length(n: int, per_cent: int = PER_CENT) -> int:
    return n - -(-per_cent * n // 100) + 1


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parities of a set by hash, in a power of two of bits at least twice its size, for sets of up
    to 512 four times.

    Elements that only one of two sets has seldom meet in so many bits, so few pairs below the
    similarity pass; of large sets the share of those that do varies less.
    """
    size = 1 << (max(1, len(shingles)) - 1).bit_length()
    bits = min(_MAX_BITS, max(64, 2 * size, min(4 * size, 2048)))
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def folded(bitmaps: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps, one a row, brought to ``width`` bytes: halves laid over one another."""
    while bitmaps.shape[1] > width:
        half = bitmaps.shape[1] // 2
        bitmaps = bitmaps[:, :half] ^ bitmaps[:, half:]
    return bitmaps


def fingerprint(shingles: np.ndarray) -> int:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _sets(batches: Iterator[pa.RecordBatch], size: int):
    """Record batches of few rows with the shingle sets of their column ``body``."""
    forget_encoder()
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            texts = (value.as_py() for value in batch.column("body"))
            yield batch, (shingle_set(words, size) for words in word_hashes(texts))


def near_copies(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    per_cent: int = PER_CENT,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` and ``component_id``.

    Sets hold the distinct shingles of ``words`` words; fewer words make one shingle, and no words
    an empty set, which is linked with nothing. Rows link when their sets' overlap is at least
    ``per_cent`` of their union; ``component_id`` is the smallest id that a row reaches by links,
    its own included. Ids are whole numbers; a row with a null id links others but has a null
    component unless it reaches an id. Repeated rows all appear; other columns are not kept; an
    empty table gives no rows. No partner or candidate is left out, however large a group is.
    """
    rows = _rows(docs, doc_id, text)
    return _labelled(rows, words, per_cent).select("doc_id", "n_shingles", "component_id")


def one_of_each(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    per_cent: int = PER_CENT,
) -> DataFrame:
    """``docs`` with one row of each group that :func:`near_copies` finds, columns as they are.

    The row with the smallest id stays, an id before none; of rows with equal ids and texts one.
    Rows without a word are in no group and all stay.
    """
    labels = _labelled(_rows(docs, doc_id, text), words, per_cent)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    kept = labels.filter("n_shingles > 0").groupBy("root").agg(F.min(first).alias("k"))
    lone = labels.filter("n_shingles = 0").select("doc_id", "text_key").distinct()
    keys = stored(kept.select("k.doc_id", "k.text_key").unionByName(lone), "kept")
    again = labels.filter("n_shingles > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    repeated = again.filter("n > 1").join(keys, ["doc_id", "text_key"], "left_semi")

    given = F.struct(*[column(name).alias(f"c{k}") for k, name in enumerate(docs.columns)])
    rows = docs.select(given.alias("row"), *_keys(doc_id, text))
    few = keys.count() <= BROADCAST_IDS
    on = rows["id"].eqNullSafe(keys["doc_id"]) & (rows["key"] == keys["text_key"])
    found = rows.join(F.broadcast(keys) if few else keys, on, "left_semi")
    if not repeated.isEmpty():
        same = Window.partitionBy("id", "key").orderBy("key")
        words_ = F.trim(F.translate(F.coalesce(column("body"), F.lit("")), "\t\n\x0b\x0c\r", "     "))
        numbered = found.withColumn("again", F.row_number().over(same))
        found = numbered.filter((F.col("again") == 1) | (words_ == ""))
    return found.select(*[F.col(f"row.c{k}").alias(n) for k, n in enumerate(docs.columns)])


def _keys(doc_id: str, text: str):
    """What tells rows apart: equal rows have equal keys."""
    body = column(text)
    return column(doc_id).cast("bigint").alias("id"), F.xxhash64(body).alias("key"), body.alias("body")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(*_keys(doc_id, text)).withColumnsRenamed({"id": "doc_id", "key": "text_key"})


def _labelled(rows: DataFrame, words: int, per_cent: int) -> DataFrame:
    """Each row's ``doc_id``, ``text_key``, ``n_shingles``, ``root`` and ``component_id``."""
    spark = rows.sparkSession
    seen = stored(_scanned(rows, words), "shingles")
    members = seen.filter("kind = 0").select("doc_id", "text_key", "n", "node")
    nodes = (
        seen.filter("kind = 0 AND n > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.first("bits").alias("bits"))
    )
    nodes = stored(nodes, "nodes")
    tiles = stored(_tiles(spark, rows, _frequent(seen), words, per_cent), "tiles")

    links = _verified(rows, nodes, _first_pairs(tiles, nodes, per_cent), words, per_cent)
    links = stored(links, "links")
    roots = stored(components(links), "roots")
    apart = stored(_apart(tiles, roots), "apart")
    for turn in range(TURNS):
        pairs = _hub_pairs(apart, nodes, per_cent, turn)
        new = stored(_verified(rows, nodes, pairs, words, per_cent), "links")
        if new.isEmpty():
            break
        links = links.unionByName(new)
        roots = stored(components(links), "roots")
        apart = stored(_apart(apart.drop("root"), roots), "apart")
    rest = _other_pairs(apart, nodes, per_cent)
    more = stored(_verified(rows, nodes, rest, words, per_cent), "links")
    roots = components(links.unionByName(more))

    least = nodes.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "doc_id"
    )
    named = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = least.join(named, "root").select("node", "root", "component_id")
    found = members.join(labels, "node", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "text_key",
        F.col("n").cast("bigint").alias("n_shingles"),
        "root",
        own.alias("component_id"),
    )


def _scanned(rows: DataFrame, size: int) -> DataFrame:
    """Kind 0: a row for each document. Kind 1: a shingle that many documents of a slice have."""
    schema = "kind int, doc_id bigint, n int, node bigint, bits binary, text_key bigint"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[np.ndarray] = []
        gathered = 0
        for batch, sets in _sets(batches, size):
            n, nodes, bits = [], [], []
            frequent: list[tuple[int, int]] = []
            for found in sets:
                n.append(len(found))
                nodes.append(fingerprint(found))
                bits.append(bitmap(found).tobytes())
                pending.append(found)
                gathered += len(found)
                if len(pending) == COUNTED_DOCS or gathered > COUNTED_SHINGLES:
                    frequent += _counted(pending)
                    pending, gathered = [], 0
            ids = batch.column("doc_id").to_pylist()
            yield _scan_rows(0, ids, n, nodes, bits, batch.column("text_key"))
            if frequent:
                yield _scan_rows(1, [s for s, _ in frequent], [c for _, c in frequent])
        frequent = _counted(pending)
        if frequent:
            yield _scan_rows(1, [s for s, _ in frequent], [c for _, c in frequent])

    return rows.mapInArrow(scan, schema)


def _scan_rows(
    kind: int, ids: list, n: list, nodes=None, bits=None, keys=None
) -> pa.RecordBatch:
    none = [None] * len(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * len(ids), pa.int32()),
            pa.array(ids, pa.int64()),
            pa.array(n, pa.int32()),
            pa.array(nodes or none, pa.int64()),
            pa.array(bits or none, pa.binary()),
            pa.array(none, pa.int64()) if keys is None else keys,
        ],
        ["kind", "doc_id", "n", "node", "bits", "text_key"],
    )


def _counted(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    if not sets:
        return []
    shingles, counts = np.unique(np.concatenate(sets), return_counts=True)
    many = counts >= COUNTED_LEAST
    return list(zip(shingles[many].view(np.int64).tolist(), counts[many].tolist(), strict=True))


def _frequent(seen: DataFrame) -> list[int]:
    """The most frequent shingles, rarest first; a bounded list, which only orders."""
    counts = seen.filter("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("count"))
    top = counts.orderBy(F.desc("count"), "doc_id").limit(FREQUENT)
    return [row.doc_id for row in top.select("doc_id").collect()][::-1]


def _tiles(
    spark: SparkSession, rows: DataFrame, frequent: list[int], size: int, per_cent: int
) -> DataFrame:
    """``token``, ``node``, its size ``n``, the token's place ``pos`` in it, and ``many``, the nodes
    of the tile, for the tokens in the prefixes of two nodes or more.

    Tokens that the same nodes have are one: their number is ``weight``, ``pos`` the first place.
    """
    by_rank = np.array(frequent, dtype=np.int64).view(np.uint64)
    order = np.argsort(by_rank)
    known = spark.sparkContext.broadcast((by_rank[order], order))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = known.value
        for batch, sets in _sets(batches, size):
            nodes, n, rare, prefix = [], [], [], []
            for found in sets:
                if len(found):
                    nodes.append(fingerprint(found))
                    n.append(len(found))
                    ordered, others = _frequent_last(found, hashes, ranks)
                    prefix.append(ordered[: prefix_length(len(found), per_cent)].view(np.int64))
                    rare.append(others)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array(n, pa.int32()),
                    pa.array(rare, pa.int32()),
                    pa.array(prefix, pa.list_(pa.int64())),
                ],
                ["node", "n", "rare", "prefix"],
            )

    fields = "node bigint, n int, rare int, prefix array<bigint>"
    found = rows.select("body").mapInArrow(prefixes, fields)
    firsts = [F.first(name).alias(name) for name in ("n", "rare", "prefix")]
    unique = found.groupBy("node").agg(*firsts)
    # Prefixes are worked out again for each part: kept, they would take as much room to the end.
    parts = [stored(_met(unique, part, per_cent), "met") for part in range(TOKEN_PARTS)]
    return _merged(reduce(DataFrame.unionByName, parts))


def _met(unique: DataFrame, part: int, per_cent: int) -> DataFrame:
    """The tiles of a part of the tokens, those of the same nodes made one."""
    tokens = unique.select("node", "n", "rare", F.posexplode("prefix").alias("pos", "token"))
    # Not the hash by which rows are dealt to tasks.
    tokens = tokens.filter(F.pmod(F.xxhash64("token", F.lit("part")), F.lit(TOKEN_PARTS)) == part)
    # Who shares a token, as a number. Frequent tokens, which very many nodes may share, are counted
    # before they meet; the others, nearly all, meet at once.
    members = {"many": F.count("*"), "who": F.bit_xor(F.xxhash64("node"))}
    tile = Window.partitionBy("token")
    by_n = tile.orderBy("n")
    met = tokens.filter("pos < rare").withColumns({k: v.over(tile) for k, v in members.items()})
    # If the next larger and smaller ones of a tile are too different in size, so are all.
    met = met.withColumns({"less": F.lag("n").over(by_n), "more": F.lead("n").over(by_n)})
    met = met.filter(f"100 * less >= {per_cent} * n OR 100 * n >= {per_cent} * more")
    often = tokens.filter("pos >= rare")
    sizes = {"least": F.min("n"), "most": F.max("n")}
    counted = often.groupBy("token").agg(*[v.alias(k) for k, v in {**members, **sizes}.items()])
    counted = counted.filter(f"many > 2 OR many = 2 AND 100 * least >= {per_cent} * most")
    columns = ["node", "n", "pos", "many", "who"]
    both = met.select(columns).unionByName(often.join(counted, "token").select(columns))
    return _merged(both.withColumnsRenamed({"who": "token"}).withColumn("weight", F.lit(1)))


def _merged(tiles: DataFrame) -> DataFrame:
    """Tiles with the same number are one."""
    return tiles.groupBy("token", "many", "node").agg(
        F.first("n").alias("n"), F.min("pos").alias("pos"), F.sum("weight").cast("int").alias("weight")
    )


def _frequent_last(
    found: np.ndarray, hashes: np.ndarray, ranks: np.ndarray
) -> tuple[np.ndarray, int]:
    """A set in the order that holds for all, and how many of it are not frequent."""
    if not len(hashes):
        return found, len(found)
    place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
    hit = hashes[place] == found
    common = found[hit][np.argsort(ranks[place[hit]])]
    return np.concatenate([found[~hit], common]), len(found) - len(common)


def _first_pairs(tiles: DataFrame, nodes: DataFrame, per_cent: int) -> DataFrame:
    """A pair for each node: of the neighbours below it by size, and of the smallest nodes it may
    be similar to, the one it shares most tokens with; if bitmaps do not rule it out.

    In a large tile neighbours are looked for in parts of it, which only makes links less likely.
    """
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("many") / LARGE_TILE)).alias("part")
    lower = F.lag(F.struct("n", "node")).over(Window.partitionBy("token", "part").orderBy("n", "node"))
    found = []
    for rows, beside in _by_size(tiles):
        near = rows.select("*", part, _band(per_cent).alias("band")).withColumn("below", lower)
        near = beside(near, ["token", "band"], hub=F.min(F.struct("n", "node")))
        found.append(near.select("node", "n", "weight", "below", "hub"))
    both = found[0].unionByName(found[1]).select(
        F.col("node").alias("x"), "n", "weight", F.posexplode(F.array("below", "hub")).alias("kind", "other")
    ).select("x", "n", "weight", "kind", F.col("other.node").alias("y"), F.col("other.n").alias("m"))
    able = both.filter(f"y IS NOT NULL AND x <> y AND 100 * m >= {per_cent} * n")
    shared = able.groupBy("kind", "x", "y").agg(F.sum("weight").alias("shared"))
    most = F.max_by(F.struct("y", "shared"), F.struct("shared", "y")).alias("most")
    best = shared.groupBy("kind", "x").agg(most).select("x", "most.y", "most.shared").distinct()
    able = _able(best, nodes, per_cent)
    return able.groupBy("x").agg(F.max_by("y", F.struct("shared", "y")).alias("y"))


def _by_size(tiles: DataFrame):
    """The rows of small and of large tiles, each with a way to put aggregates of tiles beside their
    rows: the rows of a small tile meet; those of a large one, which may be many of all, do not."""

    def met(rows: DataFrame, key: list[str], **values) -> DataFrame:
        tile = Window.partitionBy(*key)
        return rows.withColumns({name: value.over(tile) for name, value in values.items()})

    def summed(rows: DataFrame, key: list[str], **values) -> DataFrame:
        return rows.join(rows.groupBy(*key).agg(*[v.alias(name) for name, v in values.items()]), key)

    return [(tiles.filter(f"many <= {LARGE_TILE}"), met), (tiles.filter(f"many > {LARGE_TILE}"), summed)]


def _band(per_cent: int, shift: float = 0.0):
    """Sizes within a band differ by less than those of similar sets may."""
    return F.floor(F.log("n") / np.log(100 / per_cent) + shift)


def _not_ruled_out(
    batches: Iterator[pa.RecordBatch], names: list[str], per_cent: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for n, m, a, b in zip(
            *(batch.column(c).to_pylist() for c in ("n_x", "n_y", "bits_x", "bits_y")), strict=True
        ):
            width = min(len(a), len(b))
            one, two = (folded(np.frombuffer(bits, np.uint8)[None, :], width) for bits in (a, b))
            differ = int(np.bitwise_count(one ^ two).sum())
            keep.append((n + m - differ) // 2 >= least_overlap(n, m, per_cent))
        yield batch.select(names).filter(pa.array(keep, pa.bool_()))


def _apart(tiles: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of tiles whose nodes are not all connected, with ``root``."""
    rooted = tiles.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ends = {"low": F.min("root"), "high": F.max("root")}
    small, large = (beside(rows, ["token"], **ends) for rows, beside in _by_size(rooted))
    return small.unionByName(large).filter("low <> high").drop("low", "high")


def _hub_pairs(apart: DataFrame, nodes: DataFrame, per_cent: int, turn: int) -> DataFrame:
    """For each component its likeliest link to another.

    Each node of a tile is held against one node of another component: all against the same, which
    turns choose anew, or if that is in their own, against one that is not.
    """
    # Bands lie differently each turn.
    banded = apart.withColumn("band", _band(per_cent, (turn % 2) / 2))
    tile = ["token", "band"]
    one = F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), "node", "root")
    elsewhere = F.col("root") != F.col("first.root")
    found = []
    for rows, beside in _by_size(banded):
        near = beside(rows, tile, first=F.min(one))
        near = beside(near, tile, second=F.min(F.when(elsewhere, one)))
        near = near.withColumn("hub", F.when(elsewhere, F.col("first")).otherwise(F.col("second")))
        found.append(near.filter("hub IS NOT NULL").select("node", "root", "weight", "hub"))
    near = found[0].unionByName(found[1])
    pairs = near.select(F.col("node").alias("x"), F.col("hub.node").alias("y"), "root", "weight")
    shared = pairs.groupBy("x", "y", "root").agg(F.sum("weight").alias("shared"))
    able = _able(shared, nodes, per_cent)
    best = F.max_by(F.struct("x", "y"), F.struct("shared", "x", "y")).alias("best")
    return able.groupBy("root").agg(best).select("best.x", "best.y")


def _able(pairs: DataFrame, nodes: DataFrame, per_cent: int) -> DataFrame:
    """The pairs of ``x`` and ``y`` that their bitmaps do not rule out; ``shared`` and others stay."""
    bits = nodes.select("node", "n", "bits")
    first, second = (
        bits.withColumnsRenamed({"node": end, "n": f"n_{end}", "bits": f"bits_{end}"})
        for end in ("x", "y")
    )
    joined = pairs.join(first, "x").join(second, "y")
    schema = pairs.schema
    return joined.mapInArrow(lambda b: _not_ruled_out(b, schema.names, per_cent), schema)


def _other_pairs(apart: DataFrame, nodes: DataFrame, per_cent: int) -> DataFrame:
    """Pairs of a tile that are not connected yet and that their bitmaps do not rule out."""
    small, large = (beside(rows, ["token"], left=F.count("*")) for rows, beside in _by_size(apart))
    blocks = F.ceil(F.col("left") / BLOCK)
    placed = small.unionByName(large).select(
        "token",
        "node",
        "n",
        "pos",
        "root",
        F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"),
        (blocks - 1).cast("int").alias("last"),
    )
    placed = placed.join(nodes.select("node", "bits"), "node")
    # A block meets each other block of its tile, and itself.
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), "last"))).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
    )
    key = ["token", "i", "j"]
    ordered = dealt.select(*key, "block", "n", "pos", "root", "node", "bits")
    ordered = ordered.repartition(*key).sortWithinPartitions(*key, "block", "n", "node")
    pairs = ordered.mapInArrow(lambda b: _compared(b, per_cent), "x bigint, y bigint")
    return pairs.distinct()


class _Tiles:
    """Rows of some whole tiles, in order, as arrays."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        for name in ("token", "i", "j", "block", "n", "pos", "root", "node"):
            setattr(self, name, batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64))
        new = np.diff(self.token) != 0
        new |= (np.diff(self.i) != 0) | (np.diff(self.j) != 0)
        self.tile = np.concatenate([[0], np.cumsum(new)]) if len(self.token) else self.token
        bits = batch.column("bits").to_pylist()
        self.width = np.array([len(b) for b in bits], dtype=np.int64)
        self._by_width: dict[int, np.ndarray] = {}
        self._at = np.zeros(len(bits), dtype=np.int64)
        for width in np.unique(self.width):
            here = np.flatnonzero(self.width == width)
            self._at[here] = np.arange(len(here))
            joined = b"".join(bits[k] for k in here)
            self._by_width[int(width)] = np.frombuffer(joined, np.uint8).reshape(len(here), -1)

    def passing(self, x: np.ndarray, y: np.ndarray, per_cent: int) -> np.ndarray:
        """Which of the pairs of rows may be similar."""
        n, m = self.n[x], self.n[y]
        need = least_overlap(n, m, per_cent)
        # In the tile of their first common token, no more can be common than follows it.
        able = need <= np.minimum(n - self.pos[x], m - self.pos[y])
        able &= self.root[x] != self.root[y]
        able &= (self.i[x] == self.j[x]) | (self.block[x] != self.block[y])
        at = np.flatnonzero(able)
        widths = np.stack([self.width[x[at]], self.width[y[at]]], axis=1)
        for one, two in np.unique(widths, axis=0):
            here = at[(widths == (one, two)).all(axis=1)]
            width = min(one, two)
            differ = folded(self._by_width[one][self._at[x[here]]], width) ^ folded(
                self._by_width[two][self._at[y[here]]], width
            )
            count = np.bitwise_count(differ.view("<u8")).sum(axis=1, dtype=np.int64)
            able[here] = (n[here] + m[here] - count) // 2 >= need[here]
        return np.flatnonzero(able)


def _compared(batches: Iterator[pa.RecordBatch], per_cent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes that may be similar, out of tiles that come in order."""
    left = None
    for batch in batches:
        rows = batch if left is None else _joined([left, batch])
        keys = _Tiles(rows).tile
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        yield from _pairs(rows.slice(0, cut), per_cent)
        left = rows.slice(cut)
    if left is not None:
        yield from _pairs(left, per_cent)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _pairs(rows: pa.RecordBatch, per_cent: int) -> Iterator[pa.RecordBatch]:
    """Each row is held against those that follow in its tile, all rows at the same distance at
    once; pairs leave as they are found."""
    if not rows.num_rows:
        return
    tiles = _Tiles(rows)
    all_rows = np.arange(rows.num_rows)
    left_in_tile = np.searchsorted(tiles.tile, tiles.tile, side="right") - all_rows - 1
    apart = 1
    x = all_rows[left_in_tile >= apart]
    while len(x):
        for part in np.array_split(x, -(-len(x) // _PAIRS)):
            able = tiles.passing(part, part + apart, per_cent)
            one, two = tiles.node[part[able]], tiles.node[part[able] + apart]
            found = [np.maximum(one, two), np.minimum(one, two)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["x", "y"])
        apart += 1
        x = x[left_in_tile[x] >= apart]


def _verified(
    rows: DataFrame,
    nodes: DataFrame,
    pairs: DataFrame,
    size: int,
    per_cent: int,
) -> DataFrame:
    """The pairs whose sets are similar.

    Sets are worked out again from the texts of the nodes that are in a pair, one text a node. A
    pair's set with more pairs waits, in one task for every few of them, for the other one.
    """
    larger, smaller = F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")
    pairs = stored(pairs.select(larger, smaller).distinct(), "pairs")
    roles = stored(_roles(pairs), "roles")
    wanted = roles.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    ids = stored(wanted, "wanted")
    few = ids.count() <= BROADCAST_IDS
    lookup = F.broadcast(ids) if few else ids
    picked = rows.join(lookup, rows["doc_id"].eqNullSafe(lookup["doc_id"])).select("node", "body")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _sets(batches, size):
            keep = [
                (node, s.view(np.int64))
                for node, s in zip(batch.column("node").to_pylist(), found, strict=True)
                if fingerprint(s) == node
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([node for node, _ in keep], pa.int64()),
                    pa.array([s for _, s in keep], pa.list_(pa.int64())),
                ],
                ["node", "shingles"],
            )

    # Rows with the id of a node's document but another text drop out by their fingerprint.
    known = picked.mapInArrow(sets, "node bigint, shingles array<bigint>")
    told = F.broadcast(roles) if roles.count() <= BROADCAST_IDS else roles
    key = ["hub", "part"]
    sent = known.join(told, "node").select(*key, "node", "shingles")
    # The hub's set comes first of its part.
    sent = sent.repartition(*key).sortWithinPartitions(*key, F.col("node") != F.col("hub"))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, waiting = None, None
        for batch in batches:
            found = []
            columns = (batch.column(name).to_pylist() for name in ("hub", "node"))
            for at, other, shingles in zip(*columns, batch.column("shingles"), strict=True):
                own = shingles.values.to_numpy()
                if other == at:
                    hub, waiting = at, own
                elif hub == at and _similar(waiting, own, per_cent):
                    found.append((max(at, other), min(at, other)))
            ends = [pa.array([pair[k] for pair in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(ends, ["x", "y"])

    return sent.mapInArrow(similar, "x bigint, y bigint")


def _roles(pairs: DataFrame) -> DataFrame:
    """Where each ``node`` of the pairs is sent: to ``hub``, the end that has more pairs, of which
    each ``part`` has a few; and each hub to all of its parts."""
    ends = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node")))
    degrees = ends.groupBy("node").agg(F.count("*").alias("degree"))
    known = pairs
    for end in ("x", "y"):
        known = known.join(degrees.withColumnsRenamed({"node": end, "degree": f"degree_{end}"}), end)
    first = F.col("degree_x") >= F.col("degree_y")
    hub, other = F.when(first, F.col("x")).otherwise(F.col("y")), F.when(first, F.col("y")).otherwise(F.col("x"))
    parts = F.ceil(F.greatest("degree_x", "degree_y") / PAIRS_A_SET)
    part = F.pmod(F.xxhash64(other), parts).cast("int")
    sent = known.select(hub.alias("hub"), part.alias("part"), other.alias("node"))
    return sent.unionByName(sent.select("hub", "part", F.col("hub").alias("node")).distinct())


def _similar(a: np.ndarray, b: np.ndarray, per_cent: int) -> bool:
    overlap = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * overlap >= per_cent * (len(a) + len(b) - overlap)
