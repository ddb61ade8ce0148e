"""Texts packed into sequences of a fixed number of tokens by bounded-space online best-fit."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeload.llm.encoding import encoder
from lakeload.llm.storage import stored
from lakeload.names import column

OPEN_BINS = 64
#: So many partitions hand what is in their last open bins to one task.
PARTITIONS_A_GROUP = 16
#: Of pieces of texts, in each Python worker: open bins need room as well.
REMEMBERED_BYTES = 48 << 20
_OUT_BYTES = 4 << 20


class OpenBins:
    """A fixed number of open bins, keyed by their free space.

    Bit ``f`` of an integer tells whether a bin with ``f`` free is open, so the tightest bin that
    takes an item is the lowest bit from the item's length on. When an item fits nowhere and no
    more bins may be open, the fullest closes.
    """

    def __init__(self, capacity: int, most: int = OPEN_BINS) -> None:
        self.capacity = capacity
        self.most = most
        self._bits = 0
        self._open: dict[int, list[list]] = {}
        self._count = 0

    def put(self, length: int, item: Any) -> Iterator[list]:
        """Place an item; gives the bins that this closes, each a list of ``(offset, item)``."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"length {length} is not from 1 to {self.capacity}")
        fitting = self._bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            contents = self._take(free)
        else:
            if self._count == self.most:
                yield self._take((self._bits & -self._bits).bit_length() - 1)
            free, contents = self.capacity, []
        contents.append((self.capacity - free, item))
        if free == length:
            yield contents
        else:
            self._keep(free - length, contents)

    def rest(self) -> Iterator[list]:
        """The bins still open, fullest first; they close."""
        while self._bits:
            yield self._take((self._bits & -self._bits).bit_length() - 1)

    def _take(self, free: int) -> list:
        bins = self._open[free]
        contents = bins.pop()
        if not bins:
            del self._open[free]
            self._bits ^= 1 << free
        self._count -= 1
        return contents

    def _keep(self, free: int, contents: list) -> None:
        self._open.setdefault(free, []).append(contents)
        self._bits |= 1 << free
        self._count += 1


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 4096,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    open_bins: int = OPEN_BINS,
) -> DataFrame:
    """Every text as ids in sequences of at most ``capacity``, few of them.

    A text is its ids and then ``end_id``; a null text is an empty one, so it has ``end_id`` alone.
    Only texts longer than ``capacity`` are cut, into pieces of just that length and a last one
    that may be shorter. Result, one row per piece: the ``doc_id`` column, ``piece`` (from 0),
    ``start`` (ids of the text before it), ``length``, ``ids`` (little-endian, 4 bytes each),
    ``sequence_id`` and ``offset`` (its place there, gapless). Other columns are not kept; rows
    with equal ids or texts are packed each for itself; an empty table gives no rows.

    Each task packs what it reads as it reads it, with ``open_bins`` bins open. Those that are open
    at the end of a task are not full: a second round packs their pieces again, the longest first,
    with those of the neighbouring tasks. So a text is tokenized once and never shuffled, but for the few in such
    bins.
    """
    rows = docs.select(column(doc_id), column(text).alias("text" if doc_id != "text" else "body"))
    schema = StructType(
        [StructField(doc_id, docs.schema[doc_id].dataType)]
        + [StructField(n, LongType()) for n in ("piece", "start", "length")]
        + StructType.fromDDL("ids binary, part bigint, bin bigint, offset bigint, open boolean").fields
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(TaskContext.get().partitionId(), capacity)
        bins = OpenBins(capacity, open_bins)
        encode = encoder(tokenizer, REMEMBERED_BYTES)
        for batch in batches:
            keys = batch.column(0)
            texts = (value.as_py() for value in batch.column(1))
            for row, ids in enumerate(encode.encode(texts)):
                whole = np.append(np.frombuffer(ids, f"<u{encode.width}").astype("<u4"), end_id)
                for piece, start in enumerate(range(0, len(whole), capacity)):
                    part = whole[start : start + capacity].astype("<u4")
                    item = (keys[row].as_py(), piece, start, len(part), part.tobytes())
                    for full in bins.put(len(part), item):
                        yield from out.add(full, False, keys.type)
            key_type = keys.type
        for full in bins.rest():
            yield from out.add(full, True, key_type)
        yield from out.flush()

    placed = stored(rows.mapInArrow(packed, schema), "packed")
    left = placed.filter("open")
    group = (F.col("part") / PARTITIONS_A_GROUP).cast("bigint").alias("grp")
    moved = (
        left.select(group, "part", "bin", "offset", "length")
        .groupBy("grp")
        .applyInPandas(
            lambda key, rows: _repacked(int(key[0]), rows, capacity),
            "part bigint, bin bigint, offset bigint, sequence_id bigint, place bigint",
        )
    )
    columns = [column(doc_id), "piece", "start", "length", "ids", "sequence_id", "offset"]
    done = placed.filter("NOT open").withColumn(
        "sequence_id", F.shiftleft(F.col("part"), 32) + F.col("bin")
    )
    rest = left.join(moved, ["part", "bin", "offset"]).withColumn("offset", F.col("place"))
    return done.select(columns).unionByName(rest.select(columns))


class _Rows:
    """Result rows, gathered to record batches of some bytes."""

    def __init__(self, part: int, capacity: int) -> None:
        self.part = part
        self.most = max(1, _OUT_BYTES // (4 * capacity))
        self.rows: list[tuple] = []
        self.full = 0
        self.bin = 0
        self.key_type = None

    def add(self, contents: list, is_open: bool, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        self.key_type = key_type
        for offset, item in contents:
            self.rows.append((*item, self.part, self.bin, offset, is_open))
        self.bin += 1
        self.full += 1
        if self.full >= self.most:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            longs = pa.int64()
            types = [self.key_type, longs, longs, longs, pa.binary(), longs, longs, longs, pa.bool_()]
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)]
            names = ["id", "piece", "start", "length", "ids", "part", "bin", "offset", "open"]
            yield pa.RecordBatch.from_arrays(arrays, names)
            self.rows, self.full = [], 0


def _repacked(grp: int, rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pack the pieces of open bins anew, the longest first.

    What comes here filled a bounded number of bins, so all bins may stay open: the short pieces
    come last and fill the gaps that long ones leave.
    """
    rows = rows.sort_values(["length", "part", "bin", "offset"], ascending=[False, True, True, True])
    bins = OpenBins(capacity, len(rows))
    found = []
    sequences = 0

    def number(contents: list) -> None:
        nonlocal sequences
        sequences += 1
        # Negative, so that no sequence of the first round has the same.
        found.extend((*piece, -(grp << 32) - sequences, place) for place, piece in contents)

    for part, bin_, offset, length in rows[["part", "bin", "offset", "length"]].itertuples(index=False):
        for full in bins.put(length, (part, bin_, offset)):
            number(full)
    for full in bins.rest():
        number(full)
    return pd.DataFrame(found, columns=["part", "bin", "offset", "sequence_id", "place"])
