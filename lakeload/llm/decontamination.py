"""Benchmark passages in texts, also with some characters changed, by the q-gram lemma.

A copy of a passage of ``m`` characters with at most ``k`` edits keeps ``m - q + 1 - k * q`` of its
q-grams, at places that differ from those in the passage by nearly the same distance: within a band
of ``k`` diagonals. So q-grams that a text shares with a passage are counted in overlapping bands,
only regions with enough of them are kept, and these are decided by an alignment within the band.

Passages and texts are compared in code points, with A-Z in lower case and white space runs as one
space.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lakeload.llm.storage import new_path, stored
from lakeload.names import column

Q = 8
#: Edits allowed, as a share of a passage's characters.
EDIT_RATE = 0.1
#: Passages are compared in blocks of so many characters; an index takes some 20 bytes for each.
BLOCK_CHARS = 1 << 20

_SLICE_CHARS = 1 << 19
_POSTINGS = 1 << 20
_OTHERS = 1 << 40  # beyond all places in texts and passages
#: A q-gram that a passage has more often is counted by stretches of the passage.
OFTEN = 8
_TABLE_BITS = 22
_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
# The code points that count as white space.
_SPACES = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
_SAME = np.arange(0x110001, dtype=np.uint32)
_SAME[65:91] += 32
_SAME[_SPACES] = 32
_BREAK = 0x110000  # no code point: stands between texts


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def normalized(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's code points as they are compared, and where each stands in the text."""
    codes = _SAME[_codes(text)]
    space = codes == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    if len(keep):
        keep[0] = not space[0]
    places = np.flatnonzero(keep)
    if len(places) and space[places[-1]]:
        places = places[:-1]
    return codes[places], places


def _grams(codes: np.ndarray) -> np.ndarray:
    """A hash of each q-gram (``Q`` is a power of two); two that share one only add to a count that is an upper bound."""
    if len(codes) < Q:
        return np.empty(0, np.uint64)
    found = codes.astype(np.uint64)
    size = 1
    while size < Q:  # two neighbours make one of twice the size
        found = found[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + found[size:]
        size *= 2
    return found * _SPREAD


def edits_allowed(m: int, rate: float = EDIT_RATE) -> int:
    """The edit budget of a passage: its share, or what leaves one q-gram untouched if less."""
    return max(0, min(int(rate * m), (m - Q) // Q))


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of columns in order: where each run of equal rows begins, its length, and each row's run's."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for column_ in columns:
        new[1:] |= np.diff(column_) != 0
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, n))
    return starts, lengths, np.repeat(lengths, lengths)


@dataclass(frozen=True)
class Often:
    """Stretches of passages with a q-gram that is there many times: those with gram ``k`` are at
    ``first[k]`` up to ``first[k + 1]``."""

    first: np.ndarray
    item: np.ndarray
    stretch: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, gram: np.ndarray, item: np.ndarray, stretch: np.ndarray, grams: int) -> Often:
        starts, lengths, _ = _runs(gram, item, stretch)
        first = np.searchsorted(gram[starts], np.arange(grams + 1))
        return cls(first, item[starts], stretch[starts], lengths)


@dataclass(frozen=True)
class Passages:
    """An index of passages. ``grams`` are sorted; those at ``k`` stand at ``first[k]`` up to
    ``first[k + 1]`` of ``item`` and ``at``.

    A q-gram that one passage has many times is left out there, and stands in ``often`` instead: for
    each stretch of a passage as wide as half a band, ``weight`` tells how many are in it.
    """

    ids: list
    codes: list[np.ndarray]
    budget: np.ndarray
    least: np.ndarray
    width: int
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    often: Often
    short: list[int]

    @classmethod
    def of(cls, ids: Sequence, texts: Iterable[str | None], rate: float = EDIT_RATE) -> Passages:
        codes = [normalized(text or "")[0] for text in texts]
        budget = np.array([edits_allowed(len(c), rate) for c in codes], np.int64)
        least = np.array([len(c) - Q + 1 for c in codes], np.int64) - budget * Q
        grams = [_grams(c) for c in codes]
        every = np.concatenate([*grams, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(codes)), [len(g) for g in grams])
        at = np.concatenate([*[np.arange(len(g)) for g in grams], np.empty(0, np.int64)])
        width = int(budget.max(initial=0)) + 1
        order = np.lexsort([at, item, every])
        every, item, at = every[order], item[order], at[order]
        unique, gram = np.unique(every, return_inverse=True)
        many = _runs(gram, item)[2] > OFTEN
        few = ~many
        first = np.searchsorted(gram[few], np.arange(len(unique) + 1))
        often = Often.of(gram[many], item[many], at[many] // width, len(unique))
        short = [k for k, c in enumerate(codes) if 0 < len(c) < Q]
        return cls(list(ids), codes, budget, least, width, unique, first, item[few], at[few], often, short)

    def table(self) -> np.ndarray:
        """Whether a passage has a q-gram with such upper bits."""
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[self.grams >> np.uint64(64 - _TABLE_BITS)] = True
        return table


_FAR = 1 << 40


def _first(passage: np.ndarray, text: np.ndarray) -> int:
    """Where a passage first stands unchanged in a text, or -1."""
    data, wanted = text.tobytes(), passage.tobytes()
    at = data.find(wanted)
    while at % 4 and at >= 0:
        at = data.find(wanted, at + 1)
    return at // 4 if at >= 0 else -1


def banded(
    passage: np.ndarray, text: np.ndarray, budget: int, *, anchored: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Ends in ``text``, and the edits of the best alignment of the whole passage up to each.

    It begins anywhere in the text, or at its first character if ``anchored``. Only diagonals that
    a budget of edits can reach are worked out.
    """
    m, n = len(passage), len(text)
    offsets = np.arange(-budget, max(n - m, 0) + budget + 1)
    rim = np.full(budget + 1 + max(m - n, 0), _BREAK, np.uint32)
    padded = np.concatenate([rim[: budget + 1], text, rim])
    cost = np.where((offsets >= 0) & (offsets <= n), offsets * anchored, _FAR)
    for i, code in enumerate(passage, 1):
        step = cost + (padded[i : i + len(offsets)] != code)  # one for one
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)  # one of the passage left out
        cost = np.minimum.accumulate(step - offsets) + offsets  # some of the text put in
        cost[(i + offsets < 0) | (i + offsets > n)] = _FAR
        if i % 16 == 0 and cost.min() > budget:
            break  # edits only become more
    return m + offsets, cost


class Finder:
    """Finds passages in texts, many texts at a time."""

    def __init__(self, passages: Passages) -> None:
        self.passages = passages
        self._table = passages.table()

    def find(self, texts: Iterable[str | None]) -> Iterator[list[tuple[int, int, int, int]]]:
        """For each text, passage number, start, end and edits of each hit, by start."""
        for batch in _slices(texts):
            known = [normalized(text) for text in batch]
            yield from self._in(known)

    def _in(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[list]:
        lengths = np.array([len(codes) + 1 for codes, _ in texts])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        joined = np.full(starts[-1], _BREAK, np.uint32)
        for start, (codes, _) in zip(starts, texts, strict=False):
            joined[start : start + len(codes)] = codes
        hits: list[list] = [[] for _ in texts]
        done: dict[tuple[int, int], int] = {}
        for item, low, high in self._regions(joined):
            # A band can reach into several texts; each is looked at for itself.
            first, last = np.searchsorted(starts, [max(low, 0), high], side="right") - 1
            for k in range(int(first), min(int(last), len(texts) - 1) + 1):
                begin, end = int(starts[k]), int(starts[k + 1]) - 1
                # Regions come in order, and what lies up to an unchanged copy has been looked at.
                start = max(low, begin, done.get((item, k), 0))
                found = self._aligned(item, joined[start : min(high, end)], start - begin)
                hits[k] += found
                exact = [begin + hit[2] for hit in found if hit[3] == 0]
                if exact:
                    done[item, k] = max(exact)
        for k in self.passages.short:
            self._find_short(k, texts, hits)
        return [_placed(_best(found), places) for found, (_, places) in zip(hits, texts, strict=True)]

    def _regions(self, joined: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Passage, first and last possible place of bands with enough shared q-grams."""
        p = self.passages
        grams = _grams(joined)
        at = np.flatnonzero(self._table[grams >> np.uint64(64 - _TABLE_BITS)])
        if not len(at) or not len(p.grams):
            return
        place = np.minimum(np.searchsorted(p.grams, grams[at]), len(p.grams) - 1)
        same = p.grams[place] == grams[at]
        at, place = at[same], place[same]
        # Bands are two widths wide and begin a width apart, so any run of diagonals that a budget
        # allows lies within one.
        longest = max(map(len, p.codes)) // p.width
        shift = longest + 2
        span = len(joined) // p.width + longest + 5

        def single(of_text: bool) -> Iterator[Shared]:
            for which, posting in _postings(p.first, place):
                band = p.item[posting] * span + (at[which] - p.at[posting]) // p.width + shift
                value = at[which] if of_text else p.at[posting]
                once = np.ones(2 * len(band), np.int64)
                yield np.concatenate([band, band - 1]), np.tile(value, 2), once

        def repeated(of_text: bool) -> Iterator[Shared]:
            # Where in the text such a q-gram is, by stretches as well.
            here = p.often.first[place + 1] > p.often.first[place]
            order = np.lexsort([at[here], place[here]])
            gram, stretch = place[here][order], at[here][order] // p.width
            starts, lengths, _ = _runs(gram, stretch)
            gram, stretch = gram[starts], stretch[starts]
            for which, posting in _postings(p.often.first, gram):
                band = p.often.item[posting] * span + stretch[which] - p.often.stretch[posting] + shift
                # Diagonals from one stretch to another lie on both sides of one that begins a band.
                keys = np.concatenate([band, band - 1, band - 2])
                value, weight = (which, lengths[which]) if of_text else (posting, p.often.weight[posting])
                own = _OTHERS + value
                yield keys, np.tile(own, 3), np.tile(weight, 3)

        # What a copy keeps are different q-grams of the passage, at different places of the text.
        found, counts = _counted(chain(single(False), repeated(False)))
        left = found[counts >= p.least[found // span]]
        if not len(left):
            return
        found, counts = _counted(
            tuple(x[hit] for x in part)
            for part in chain(single(True), repeated(True))
            for hit in [np.isin(part[0], left)]
        )
        items = found // span
        enough = counts >= p.least[items]
        for key, k in zip(found[enough].tolist(), items[enough].tolist(), strict=True):
            low = (key - k * span - shift) * p.width
            budget = int(p.budget[k])
            yield k, low - budget, low + 2 * p.width + len(p.codes[k]) + budget

    def _aligned(self, item: int, region: np.ndarray, at: int) -> list[tuple[int, int, int, int]]:
        """Alignments within a region whose edits are within the budget: the best one, and those of
        what is left on both sides of it."""
        passage, budget = self.passages.codes[item], int(self.passages.budget[item])
        found, left = [], [(0, len(region))]
        while left:
            low, high = left.pop()
            if high - low < len(passage) - budget:
                continue
            exact = _first(passage, region[low:high])
            if exact >= 0:
                start, end = low + exact, low + exact + len(passage)
                found.append((item, at + start, at + end, 0))
                left += [(low, start), (end, high)]
                continue
            ends, cost = banded(passage, region[low:high], budget)
            edits = int(cost.min())
            if edits > budget:
                continue
            end = low + int(ends[cost.argmin()])
            before = region[max(low, end - len(passage) - budget) : end]
            lengths, cost = banded(passage[::-1], before[::-1], budget, anchored=True)
            start = end - int(lengths[np.lexsort([np.abs(lengths - len(passage)), cost])[0]])
            found.append((item, at + start, at + end, edits))
            left += [(low, start), (end, high)]
        return found

    def _find_short(self, k: int, texts, hits) -> None:
        passage = self.passages.codes[k]
        for (codes, _), found in zip(texts, hits, strict=True):
            if len(codes) < len(passage):
                continue
            windows = np.lib.stride_tricks.sliding_window_view(codes, len(passage))
            for at in np.flatnonzero((windows == passage).all(axis=1)).tolist():
                found.append((k, at, at + len(passage), 0))


#: Bands, what they share, and how much that counts.
Shared = tuple[np.ndarray, np.ndarray, np.ndarray]


def _postings(first: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each q-gram found, by its number, with each of its postings, a bounded number at a time."""
    many = first[place + 1] - first[place]
    ends = np.cumsum(many)
    start = 0
    while start < len(place):
        before = ends[start] - many[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + _POSTINGS)))
        part = many[start:stop]
        which = np.repeat(np.arange(start, stop), part)
        inside = np.arange(len(which)) - np.repeat(ends[start:stop] - part - before, part)
        yield which, first[place[which]] + inside
        start = stop


def _once(keys: np.ndarray, values: np.ndarray, weights: np.ndarray) -> Shared:
    """Rows in order of keys and values, each once."""
    order = np.lexsort([values, keys])
    starts = _runs(keys[order], values[order])[0]
    order = order[starts]
    return keys[order], values[order], weights[order]


def _counted(slices: Iterable[Shared]) -> tuple[np.ndarray, np.ndarray]:
    """Each band, and the weights of the different values that it has in all slices."""
    known = (np.empty(0, np.int64),) * 3
    waiting: list[Shared] = []
    size = 0
    for part in slices:
        waiting.append(_once(*part))
        size += len(waiting[-1][0])
        if size > max(_POSTINGS, len(known[0])):
            known = _once(*map(np.concatenate, zip(known, *waiting, strict=True)))
            waiting, size = [], 0
    keys, _, weights = _once(*map(np.concatenate, zip(known, *waiting, strict=True)))
    if not len(keys):
        return keys, weights
    starts = _runs(keys)[0]
    return keys[starts], np.add.reduceat(weights, starts)


def _best(hits: list) -> list:
    """Of hits of a passage that overlap, the one with the fewest edits."""
    kept: list = []
    for hit in sorted(set(hits), key=lambda h: (h[0], h[3], h[1])):
        item, start, end, _ = hit
        if all(k[0] != item or end <= k[1] or start >= k[2] for k in kept):
            kept.append(hit)
    return sorted(kept, key=lambda h: (h[1], h[0]))


def _placed(hits: list, places: np.ndarray) -> list:
    return [(k, int(places[a]), int(places[b - 1]) + 1, edits) for k, a, b, edits in hits if b > a]


def _slices(texts: Iterable[str | None]) -> Iterator[list[str]]:
    batch: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if batch and size + len(text) > _SLICE_CHARS:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text) + 1
    if batch:
        yield batch


def blocks(
    benchmark: DataFrame,
    *,
    item_id: str = "item_id",
    text: str = "text",
    chars: int = BLOCK_CHARS,
    rate: float = EDIT_RATE,
) -> Iterator[Passages]:
    """Indexes of the benchmark, each of at most ``chars`` characters or of one passage.

    Rows come to the driver one partition at a time and go on as bounded blocks.
    """
    ids, texts, size = [], [], 0
    for row in benchmark.select(column(item_id), column(text)).toLocalIterator():
        if ids and size + len(row[1] or "") > chars:
            yield Passages.of(ids, texts, rate)
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1] or "")
    if ids:
        yield Passages.of(ids, texts, rate)


def leaks(text: Column, known: Broadcast, kind: DataType) -> Column:
    """Array of the passages of a broadcast index in a text: ``item_id``, ``start``, ``end`` (code
    points of the text as it is, end exclusive) and ``edits``, by start."""
    names = ("item_id", "start", "end", "edits")

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = Finder(known.value)
        ids = known.value.ids
        arrow = pa.list_(pa.struct([("item_id", _arrow(kind)), *[(n, pa.int64()) for n in names[1:]]]))
        for texts in batches:
            found = finder.find(value.as_py() for value in texts)
            rows = [[dict(zip(names, (ids[k], *at), strict=True)) for k, *at in hits] for hits in found]
            yield pa.array(rows, type=arrow)

    return F.arrow_udf(find, _leaks_type(kind))(text)


def _leaks_type(kind: DataType) -> str:
    return f"array<struct<item_id:{kind.simpleString()},start:bigint,end:bigint,edits:bigint>>"


def _arrow(kind: DataType) -> pa.DataType:
    return pa.string() if kind.simpleString() == "string" else pa.int64()


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = EDIT_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with ``leaks``, the benchmark passages each text holds whole but for edits.

    A passage may have ``rate`` of its characters changed, and at least one of its q-grams must be
    unchanged; one shorter than a q-gram must be unchanged altogether. Where copies of a passage
    overlap, the closest counts. Null and empty texts or passages have no part in any leak;
    repeated passages are found each under its id; ids are strings or whole numbers. A column
    ``leaks`` is replaced. A very long text is looked through whole, and takes memory in proportion
    to its length; what repeats in it takes no more than what does not. A benchmark of more than
    ``block_chars`` characters goes through the texts block by block, one index at a time.
    """
    spark = docs.sparkSession
    kind = benchmark.schema[item_id].dataType
    if kind.simpleString() not in ("string", "bigint"):
        benchmark = benchmark.withColumn(item_id, column(item_id).cast("bigint"))
        kind = benchmark.schema[item_id].dataType
    none = F.array().cast(_leaks_type(kind))
    indexes = blocks(benchmark, item_id=item_id, text=item_text, chars=block_chars, rate=rate)
    first, second = next(indexes, None), next(indexes, None)
    if second is None:
        if first is None:
            return docs.withColumn("leaks", none)
        return docs.withColumn("leaks", leaks(column(text), spark.sparkContext.broadcast(first), kind))

    # Rows are numbered and kept, so that what each block finds can be put together again.
    own = F.struct(*[column(name).alias(f"c{k}") for k, name in enumerate(docs.columns)])
    number = F.monotonically_increasing_id().alias("number")
    rows = stored(docs.select(number, column(text).alias("body"), own.alias("row")), "numbered")
    path = new_path(spark, "leaks")
    for passages in chain((first, second), indexes):
        known = spark.sparkContext.broadcast(passages)
        found = rows.select("number", leaks(F.col("body"), known, kind).alias("leaks"))
        found.filter(F.size("leaks") > 0).write.mode("append").parquet(path)
        known.destroy()
    found = spark.read.parquet(path).groupBy("number").agg(F.flatten(F.collect_list("leaks")).alias("leaks"))
    by_start = F.array_sort("leaks", lambda a, b: (a.start - b.start).cast("int"))
    found = found.select("number", by_start.alias("leaks"))
    both = rows.drop("body").join(found, "number", "left")
    columns = [F.col(f"row.c{k}").alias(name) for k, name in enumerate(docs.columns) if name != "leaks"]
    return both.select(*columns, F.coalesce("leaks", none).alias("leaks"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the rows that :func:`with_leaks` finds a passage in."""
    kept = [column(name) for name in docs.columns]
    marked = docs.select(F.struct(*kept).alias("row"), column(how.get("text", "text")).alias("body"))
    found = with_leaks(marked, benchmark, **{**how, "text": "body"})
    return found.filter(F.size("leaks") == 0).select("row.*")
