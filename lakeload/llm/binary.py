"""Token ids in files: one long array of ids per block, document boundaries in Elias-Fano code.

The files are Parquet, one row per block. A block holds the ids of consecutive documents, in the
fewest whole bytes their vocabulary needs, and where each document ends. Ends only grow, so
Elias-Fano code stores them in about two bits and the bits of a mean length each, and finds any of
them without a table of 64-bit numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeload.llm.encoding import encoder
from lakeload.names import column

BLOCK_IDS = 1 << 20
#: Of pieces met, in each Python worker: words come back less often than a task's texts would tell.
REMEMBERED_BYTES = 256 << 20
_CHUNK = 512  # bits of the upper part between two counts


class EliasFano:
    """Numbers that never decrease, compressed, each to be had by its place.

    The lower bits stand packed one behind the other. Of the upper bits there is a bit string in
    which the number at place ``i`` sets bit ``upper + i``; how many are set before each chunk of
    512 bits leads to the chunk that holds the ``i``-th.
    """

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, before: bytes) -> None:
        self.n, self.low_bits = n, low_bits
        self._low = np.frombuffer(low, np.uint8)
        self._high = np.frombuffer(high, np.uint8)
        self._before = np.frombuffer(before, "<u4")

    @classmethod
    def of(cls, numbers: Sequence[int] | np.ndarray) -> EliasFano:
        values = np.asarray(numbers, dtype=np.int64)
        n = len(values)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        if values[0] < 0 or (np.diff(values) < 0).any():
            raise ValueError("numbers must not be negative or decrease")
        low_bits = max(0, int((int(values[-1]) + 1) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8), bitorder="little")
        places = (values >> low_bits) + np.arange(n)
        length = -(-(int(places[-1]) + 1) // _CHUNK) * _CHUNK
        flags = np.zeros(length, np.uint8)
        flags[places] = 1
        counts = flags.reshape(-1, _CHUNK).sum(axis=1)
        before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4")
        high = np.packbits(flags, bitorder="little")
        return cls(n, low_bits, low.tobytes(), high.tobytes(), before.tobytes())

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self._low), len(self._before)], "<u4")
        return b"".join(x.tobytes() for x in (head, self._low, self._before, self._high))

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, n_low, chunks = (int(x) for x in np.frombuffer(data, "<u4", 4))
        cut = np.cumsum([16, n_low, 4 * chunks])
        return cls(n, low_bits, data[cut[0] : cut[1]], data[cut[2] :], data[cut[1] : cut[2]])

    def select(self, places: Sequence[int] | np.ndarray) -> np.ndarray:
        """The numbers at some places."""
        places = np.asarray(places, dtype=np.int64)
        if len(places) and not (0 <= places.min() and places.max() < self.n):
            raise IndexError("no such place")
        chunks = np.searchsorted(self._before, places, side="right") - 1
        upper = np.empty(len(places), np.int64)
        for chunk in np.unique(chunks):
            here = chunks == chunk
            first = chunk * _CHUNK // 8
            flags = np.unpackbits(self._high[first : first + _CHUNK // 8], bitorder="little")
            ones = np.flatnonzero(flags)
            rank = places[here] - int(self._before[chunk])
            upper[here] = chunk * _CHUNK + ones[rank] - places[here]
        return (upper << self.low_bits) | self._lower(places)

    def _lower(self, places: np.ndarray) -> np.ndarray:
        bit = places[:, None] * self.low_bits + np.arange(self.low_bits)
        flags = (self._low[bit >> 3] >> (bit & 7)) & 1
        return (flags.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    partitions: int | None = None,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending order of ``doc_id``.

    Null ids come first; rows with equal ids are ordered by a hash of their texts, and equal rows
    all appear. A null text is an empty one. Other columns are not kept. Ids are ranged over
    ``partitions`` (default: the session's shuffle partitions), so files follow one another in
    order too. A block closes with the document that fills it to ``block_ids``.

    Columns of the files: ``part`` and ``block`` (their order), ``doc_ids``, ``width`` (bytes of an
    id), ``ids`` (little-endian) and ``ends`` (:class:`EliasFano`, the ids up to each document's
    end), ``n_ids``.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(column(doc_id).alias("key"), column(text).alias("text"))
    order = [F.col("key"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = StructType(
        [
            *StructType.fromDDL("part bigint, block bigint").fields,
            StructField("doc_ids", _array(docs.schema[doc_id].dataType)),
            *StructType.fromDDL("width int, ids binary, ends binary, n_ids bigint").fields,
        ]
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, REMEMBERED_BYTES)
        width = encode.width
        end = int(end_id).to_bytes(width, "little")
        part, block = TaskContext.get().partitionId(), 0
        keys: list = []
        parts: list[bytes] = []
        ends: list[int] = []
        filled = 0
        key_type = None

        def full() -> pa.RecordBatch:
            columns = [
                pa.array([part], pa.int64()),
                pa.array([block], pa.int64()),
                pa.array([keys], pa.list_(key_type)),
                pa.array([width], pa.int32()),
                pa.array([b"".join(parts)], pa.binary()),
                pa.array([EliasFano.of(ends).to_bytes()], pa.binary()),
                pa.array([filled], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            key_type = batch.column(0).type
            texts = (value.as_py() for value in batch.column(1))
            for key, ids in zip(batch.column(0), encode.encode(texts), strict=True):
                keys.append(key.as_py())
                parts += [ids, end]
                filled += len(ids) // width + 1
                ends.append(filled)
                if filled >= block_ids:
                    yield full()
                    keys, parts, ends, filled = [], [], [], 0
                    block += 1
        if keys:
            yield full()

    ranged.mapInArrow(blocks, schema).write.parquet(path)


def _array(kind):
    return StructType.fromDDL("a array<int>")["a"].dataType.__class__(kind)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start`` (ids of all before it), ``n_tokens``, its
    ``ids`` as arrays and ``ids_crc32``, the checksum of its ids as 4 bytes each."""
    files = spark.read.parquet(path)
    key = files.schema["doc_ids"].dataType.elementType
    schema = StructType(
        [
            *StructType.fromDDL("part bigint, block bigint").fields,
            StructField("doc_id", key),
            StructField("place", LongType()),
            *StructType.fromDDL("n_tokens bigint, ids array<bigint>, ids_crc32 bigint").fields,
        ]
    )
    return _placed(files, files.mapInArrow(lambda b: _documents(b, True), schema))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """:func:`read_ids` without the ids."""
    files = spark.read.parquet(path)
    key = files.schema["doc_ids"].dataType.elementType
    schema = StructType(
        [
            *StructType.fromDDL("part bigint, block bigint").fields,
            StructField("doc_id", key),
            StructField("place", LongType()),
            *StructType.fromDDL("n_tokens bigint, ids_crc32 bigint").fields,
        ]
    )
    return _placed(files, files.mapInArrow(lambda b: _documents(b, False), schema))


def _documents(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            block = {n: batch.column(n)[row].as_py() for n in ("part", "block", "width", "ids", "ends")}
            keys = batch.column("doc_ids")[row].values
            ids = np.frombuffer(block["ids"], f"<u{block['width']}")
            ends = EliasFano.from_bytes(block["ends"]).select(np.arange(len(keys)))
            starts = np.concatenate([[0], ends[:-1]])
            documents = [ids[s:e] for s, e in zip(starts, ends, strict=True)]
            sums = [zlib.crc32(d.astype("<u4").tobytes()) for d in documents]
            columns = {
                "part": pa.array([block["part"]] * len(keys), pa.int64()),
                "block": pa.array([block["block"]] * len(keys), pa.int64()),
                "doc_id": keys,
                "place": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(ends - starts, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(documents, pa.list_(pa.int64()))
            columns["ids_crc32"] = pa.array(sums, pa.int64())
            yield pa.RecordBatch.from_pydict(columns)


def _placed(files: DataFrame, documents: DataFrame) -> DataFrame:
    """Add what stands before a document's block to its place there.

    Sums run within the blocks of a part, and over the parts, of which there are as many as tasks
    wrote.
    """
    sizes = files.select("part", "block", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    parts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = before.partitionBy("part").orderBy("block")
    blocks = sizes.select(
        "part", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inside")
    )
    bases = blocks.join(parts, "part").select(
        "part", "block", (F.col("base") + F.col("inside")).alias("base")
    )
    found = documents.join(bases, ["part", "block"]).withColumn(
        "start", F.col("base") + F.col("place")
    )
    names = [n for n in documents.columns if n not in ("part", "block", "place", "doc_id")]
    return found.select("doc_id", "start", *names)
