"""Ranked search: for each item of a query set, the documents that its words score highest.

One pass over the texts keeps, for a block of documents at a time, where the items' terms occur and
how often. With the counts of the whole table each term has a weight, and a second pass ranks: in a
block every term has a bitmap of the documents that have it. Laid side by side, the bitmaps of an
item's terms give each document the mask of the terms it has, and documents with the same mask make
one group. No document of a group can score more than the sum of what each of its terms adds at
most in the block, so groups are scored from the highest such sum down, until the next is below the
lowest of the best documents found so far.

Terms are 64-bit hashes, see :mod:`lakeload.llm.shingles`: a word of the corpus is taken for one of
``q`` terms with a probability of ``q`` over 2**64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeload.llm.shingles import word_hashes
from lakeload.llm.storage import new_path, stored
from lakeload.names import column

#: Documents of a block, and about as many words at most.
BLOCK_DOCS = 4096
BLOCK_WORDS = 1 << 21
#: Items go through the documents in blocks of about so many terms (with repeats over items): what
#: tasks are told stays within a few tens of MB, whatever the number of items.
QUERY_TERMS = 500_000

# All ASCII but letters and digits stands between terms; bytes of other characters are part of them.
_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    best: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """For each item its ``best`` documents: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower
    case; a null or empty text has none. With ``N`` documents that have a term, ``L`` terms in all
    with repeats, ``n`` of them in a document, and ``df`` documents with a term, that term weighs
    ``floor(1000 * ln((2N + 2) / (2df + 1)))``, and where it occurs ``tf`` times it adds its weight
    times ``10**9 * tf div (1000 * tf + 8m)``, with ``m = 10 + 90nN div L``.

    Only scores above 0 are ranked; equal ones by ascending id, null last. Document ids are whole
    numbers; rows with equal ids are documents of their own, and equal in all they come in any
    order. Items with equal ids are one, with the terms of all their texts; items without terms or
    matches have no rows. Whole texts of any length count; other columns are not looked at; empty
    tables give an empty result.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType
    rows = docs.select(column(doc_id).cast("bigint"), column(text))
    terms = stored(_item_terms(items.select(column(item_id), column(item_text)), kind), "item-terms")
    blocks = -(-terms.count() // QUERY_TERMS)
    path = new_path(spark, "ranked")
    schema = StructType(
        [
            StructField("item_id", kind),
            StructField("rank", LongType()),
            StructField("doc_id", LongType()),
            StructField("score", LongType()),
        ]
    )
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item"), F.lit(blocks)) == block
        found = _searched(spark, rows, terms.filter(own), best)
        found.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append").parquet(path)
    ranked = spark.read.schema(schema).parquet(path)
    return ranked.select(
        F.col("item_id").alias(item_id),
        F.col("rank").cast("int").alias("rank"),
        F.col("doc_id").alias(doc_id),
        "score",
    )


def _item_terms(items: DataFrame, kind) -> DataFrame:
    """``item`` and ``term``, each pair once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [np.unique(w) for w in word_hashes((v.as_py() for v in batch.column(1)), _BETWEEN)]
            rows = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
            hashes = np.concatenate([np.empty(0, np.uint64), *terms]).view(np.int64)
            arrays = [batch.column(0).take(pa.array(rows)), pa.array(hashes)]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "term"])

    schema = StructType([StructField("item", kind), StructField("term", LongType())])
    return items.mapInArrow(found, schema).distinct()


def _searched(spark: SparkSession, rows: DataFrame, terms: DataFrame, best: int) -> DataFrame:
    """The best documents of a block of items."""
    names, items, hashes = _told(terms)
    known = spark.sparkContext.broadcast(hashes)
    index = stored(_index(rows, known), "postings")
    sums = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = (int(x or 0) for x in sums)
    query = Query(items, _weights(_spread(index, len(hashes)), n_docs), n_docs, n_terms, best)
    asked = spark.sparkContext.broadcast(query)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders = Leaders(asked.value)
        for batch in batches:
            for row in range(batch.num_rows):
                leaders.see(Block(*(batch.column(k)[row] for k in range(5))))
        yield leaders.rows()

    parts = index.drop("n_docs", "n_terms").mapInArrow(ranked, "item int, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _told(terms: DataFrame) -> tuple[DataFrame, list[np.ndarray], np.ndarray]:
    """Items by number, the places of each one's terms, and the terms' hashes in order."""
    spark = terms.sparkSession
    collected = terms.orderBy("item").toArrow()
    hashes, places = np.unique(collected["term"].to_numpy().view(np.uint64), return_inverse=True)
    numbers: dict = {}
    of = np.array([numbers.setdefault(v, len(numbers)) for v in collected["item"].to_pylist()], int)
    sizes = np.bincount(of, minlength=len(numbers))
    items = np.split(places[np.argsort(of, kind="stable")], np.cumsum(sizes)[:-1])
    schema = StructType([StructField("item", LongType()), StructField("item_id", terms.schema[0].dataType)])
    named = spark.createDataFrame([(number, value) for value, number in numbers.items()], schema)
    return named.withColumn("item", F.col("item").cast("int")), items, hashes


def _index(rows: DataFrame, known) -> DataFrame:
    """Blocks of documents with the places and counts of the terms that items ask for.

    ``ids`` and ``lengths`` are those of the documents that have such a term; ``terms``, ``places``
    and ``counts`` (4 bytes each, ordered by term, then document) say which, where and how often.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = known.value
        ids: list = []
        found: list[np.ndarray] = []
        words = 0
        for batch in batches:
            texts = word_hashes((v.as_py() for v in batch.column(1)), _BETWEEN)
            for doc, terms in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids.append(doc)
                found.append(terms)
                words += len(terms)
                if len(ids) == BLOCK_DOCS or words > BLOCK_WORDS:
                    yield _block(ids, found, hashes)
                    ids, found, words = [], [], 0
        if ids:
            yield _block(ids, found, hashes)

    return rows.mapInArrow(
        scan,
        "ids array<bigint>, lengths array<bigint>, terms binary, places binary, counts binary, "
        "n_docs bigint, n_terms bigint",
    )


def _block(ids: list, found: list[np.ndarray], hashes: np.ndarray) -> pa.RecordBatch:
    lengths = np.array([len(terms) for terms in found], np.int64)
    words = np.concatenate(found)
    at = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
    hit = hashes[at] == words
    docs = np.repeat(np.arange(len(found)), lengths)[hit]
    # Documents without any such term are counted, but need no place.
    there, docs = np.unique(docs, return_inverse=True)
    keys, counts = np.unique(at[hit] * BLOCK_DOCS + docs, return_counts=True)
    columns = [x.astype("<u4").tobytes() for x in (keys // BLOCK_DOCS, keys % BLOCK_DOCS, counts)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([[ids[k] for k in there]], pa.list_(pa.int64())),
            pa.array([lengths[there]], pa.list_(pa.int64())),
            *(pa.array([data], pa.binary()) for data in columns),
            pa.array([int((lengths > 0).sum())], pa.int64()),
            pa.array([int(lengths.sum())], pa.int64()),
        ],
        ["ids", "lengths", "terms", "places", "counts", "n_docs", "n_terms"],
    )


def _spread(index: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u4"), minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "n"])

    parts = index.select("terms").mapInArrow(count, "term bigint, n bigint")
    summed = parts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    spread = np.zeros(terms, np.int64)
    spread[summed["term"].to_numpy()] = summed["n"].to_numpy()
    return spread


def _weights(spread: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in spread.tolist()])


@dataclass(frozen=True)
class Query:
    """What all tasks know of a block of items."""

    items: list[np.ndarray]  # the terms of each
    weights: np.ndarray  # by term
    n_docs: int
    n_terms: int
    best: int


class Block:
    """The postings of a block of documents, as arrays."""

    def __init__(self, ids, lengths, terms, places, counts) -> None:
        self.ids = ids.values
        self.lengths = lengths.values.to_numpy(zero_copy_only=False)
        self.terms, self.places, self.counts = (
            np.frombuffer(data.as_buffer(), "<u4").astype(np.int64) for data in (terms, places, counts)
        )


class Leaders:
    """The best documents of each item so far, over all blocks of a task."""

    def __init__(self, query: Query) -> None:
        self.query = query
        self._slot = np.full(len(query.weights), -1)
        # Score, whether the id is null, and id.
        self._best = [np.empty((0, 3), np.int64) for _ in query.items]

    def see(self, block: Block) -> None:
        """Rank the documents of one more block."""
        if not len(block.terms):
            return
        query, docs = self.query, len(block.lengths)
        m = 10 + 90 * block.lengths * query.n_docs // query.n_terms
        adds = 1_000_000_000 * block.counts // (1000 * block.counts + 8 * m[block.places])
        new = np.append(True, np.diff(block.terms) != 0)
        starts = np.flatnonzero(new)
        present = block.terms[starts]
        self._slot[present] = np.arange(len(present))
        rows = np.cumsum(new) - 1
        self._most = np.maximum.reduceat(adds, starts) * query.weights[present]
        self._keys, self._adds, self._docs = rows * docs + block.places, adds, docs
        self._has = _bitmaps(rows, block.places, len(present), docs)
        null = block.ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        self._ids = np.stack([null, block.ids.fill_null(0).to_numpy(zero_copy_only=False)], axis=1)
        for item, terms in enumerate(query.items):
            here = self._slot[terms]
            self._rank(item, here[here >= 0], terms[here >= 0])
        self._slot[present] = -1

    def _rank(self, item: int, slots: np.ndarray, terms: np.ndarray) -> None:
        if not len(slots):
            return
        masks, group = _masks(self._has[slots], self._docs)
        most = masks @ self._most[slots].astype(np.float64)  # whole numbers below 2**53
        order = np.argsort(-most, kind="stable")
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        docs = np.argsort(turn[group], kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(order))[order])
        most, weights = most[order], self.query.weights[terms]
        done = first = 0
        while done < len(order) and most[done] > 0 and most[done] >= self._least(item):
            # Whole groups, a few at a time.
            done = max(done + 1, int(np.searchsorted(ends, first + 64)))
            done = min(done, len(order))
            some, first = docs[first : ends[done - 1]], int(ends[done - 1])
            keys = slots[None, :] * self._docs + some[:, None]
            at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
            scores = np.where(self._keys[at] == keys, self._adds[at], 0) @ weights
            found = np.column_stack([scores, self._ids[some]])[scores > 0]
            both = np.concatenate([self._best[item], found])
            order_ = np.lexsort([both[:, 2], both[:, 1], -both[:, 0]])
            self._best[item] = both[order_[: self.query.best]]

    def _least(self, item: int) -> int:
        best = self._best[item]
        return int(best[-1, 0]) if len(best) == self.query.best else 0

    def rows(self) -> pa.RecordBatch:
        sizes = [len(best) for best in self._best]
        all_ = np.concatenate([np.empty((0, 3), np.int64), *self._best])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                pa.array(all_[:, 2], pa.int64(), mask=all_[:, 1] == 1),
                pa.array(all_[:, 0], pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )


def _bitmaps(rows: np.ndarray, places: np.ndarray, n: int, docs: int) -> np.ndarray:
    """A row of bits for each term: which documents have it. Both arrays are in order."""
    width = -(-docs // 8)
    byte = rows * width + (places >> 3)
    starts = np.flatnonzero(np.append(True, np.diff(byte) != 0))
    bits = np.zeros(n * width, np.uint8)
    bits[byte[starts]] = np.add.reduceat(1 << (places & 7), starts)
    return bits.reshape(n, width)


def _masks(has: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct masks of terms that documents have, a row of 0 and 1 each, and the mask of each
    document by its place among them."""
    terms = len(has)
    bits = np.unpackbits(has, axis=1, count=docs, bitorder="little")
    words = -(-terms // 64)
    packed = np.zeros((docs, 8 * words), np.uint8)
    packed[:, : -(-terms // 8)] = np.packbits(bits, axis=0, bitorder="little").T
    keys = packed.view("<u8")
    if words == 1:
        keys, group = np.unique(keys[:, 0], return_inverse=True)
    else:
        keys, group = np.unique(keys, axis=0, return_inverse=True)
    each = np.ascontiguousarray(keys.reshape(-1, words)).view(np.uint8)
    masks = np.unpackbits(each, axis=1, count=terms, bitorder="little")
    return masks.astype(np.float64), group.reshape(-1)
