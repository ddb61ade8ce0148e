"""Scores of texts under a class-based bigram model trained on some of them.

Words are put into classes, more of them the more words there are. The most frequent words, a fixed
number of them, are assigned by exchange clustering: each moves to the class that makes the bigrams
of classes most likely, until none does. Every other word with enough neighbours then goes to the
class that gains most from its own neighbours; only words too rare for that go to classes by how
often they occur. A token's probability is that of its class after the class before it, times that
of the token within its class.

Words are 64-bit hashes, see :mod:`lakeload.llm.shingles`. Counts of the whole vocabulary never
meet in one place: texts are dealt to buckets, and each bucket gets the counts of its own words. All
tasks know the most frequent words, so that no word is sent to every bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.shingles import word_hashes
from lakeload.llm.storage import stored
from lakeload.names import column

#: So many of the most frequent words are clustered by exchange, on the driver, from the counts of
#: their bigrams: a matrix of 2,050 rows and columns at most, whatever the corpus.
CORE_WORDS = 2048
#: Into so many classes at least and at most; between, classes grow with the cube root of the number
#: of words that are clustered in all.
CORE_CLASSES = 32
MOST_CLASSES = 512
SWEEPS = 5
#: Words that training has so often are clustered by their neighbours.
EVIDENCE = 8
#: Classes of other words: the number of binary digits of a word's count.
BANDS = 40
#: Pseudo-count of a class after a class.
SMOOTHING = 0.5

_WORDS_AT_ONCE = 1024
_CELLS_AT_ONCE = 1 << 14
_BUCKET_BYTES = 8 << 20
_COUNTED_WORDS = 1 << 19

_FILTER_BITS = 24


def class_number(words: int) -> int:
    """Into how many classes so many words are clustered."""
    return min(MOST_CLASSES, max(CORE_CLASSES, round(2 * words ** (1 / 3))))


def exchange_classes(
    bigrams: np.ndarray, words: int, classes: int = CORE_CLASSES, sweeps: int = SWEEPS
) -> np.ndarray:
    """The class of each of the first ``words`` rows of a square matrix of bigram counts.

    The other rows are tokens with a class of their own each. A word in turn tries every class and
    takes the one with the highest likelihood of the bigrams of classes, the lowest if several.
    Sweeps end when no word moves, or after ``sweeps``.
    """
    fixed = len(bigrams) - words
    label = np.concatenate([np.arange(words) % classes, classes + np.arange(fixed)])
    n = classes + fixed
    counts = np.zeros((n, n))
    np.add.at(counts, (label[:, None], label[None, :]), bigrams)
    table = Steps(counts, classes)
    for _ in range(sweeps):
        moved = False
        for w in range(words):
            old = label[w]
            after = np.bincount(label, weights=bigrams[w], minlength=n)
            before = np.bincount(label, weights=bigrams[:, w], minlength=n)
            own = bigrams[w, w]
            after[old] -= own
            before[old] -= own
            table.add(old, -after, -before, -own)
            cells = np.flatnonzero(np.concatenate([after, before]))
            amounts = np.concatenate([after, before])[cells]
            best = int(table.gains(np.array([len(cells)]), cells, amounts, own)[0].argmax())
            label[w] = best
            table.add(best, after, before, own)
            moved |= best != old
        if not moved:
            break
    return label[:words]


class Steps:
    """How often each class follows each, and what words would add to the likelihood of that.

    The first ``classes`` rows and columns are classes that words can join. Neighbours of a word are
    given as cells: ``c`` for class ``c`` after the word, ``n + c`` for class ``c`` before it.
    """

    def __init__(self, counts: np.ndarray, classes: int) -> None:
        self.counts, self.classes, self.n = counts, classes, len(counts)
        # A row for each class: what follows it, then what it follows.
        self._both = np.concatenate([counts[:classes], counts[:, :classes].T], axis=1)
        self._logs = _xlogx(self._both)
        self._out, self._into = counts.sum(axis=1), counts.sum(axis=0)

    def add(self, k: int, after: np.ndarray, before: np.ndarray, own: float) -> None:
        """Let a word with these neighbours, itself ``own`` times, join class ``k``."""
        counts, n, classes = self.counts, self.n, self.classes
        counts[k] += after
        counts[:, k] += before
        counts[k, k] += own
        self._out += before
        self._out[k] += after.sum() + own
        self._into += after
        self._into[k] += before.sum() + own
        self._both[k] = np.concatenate([counts[k], counts[:, k]])
        self._both[:, k] = counts[:classes, k]
        self._both[:, n + k] = counts[k, :classes]
        self._logs[k] = _xlogx(self._both[k])
        self._logs[:, [k, n + k]] = _xlogx(self._both[:, [k, n + k]])

    def gains(
        self, sizes: np.ndarray, cells: np.ndarray, amounts: np.ndarray, own: float = 0
    ) -> np.ndarray:
        """What each class would gain in likelihood from each of some words, a row each.

        ``sizes`` tells how many of the cells and amounts belong to each word, one at least. Only
        cells that a word has change.
        """
        classes, n = self.classes, self.n
        word = np.repeat(np.arange(len(sizes)), sizes)
        change = _xlogx(self._both[:, cells] + amounts) - self._logs[:, cells]
        gain = np.add.reduceat(change, np.cumsum(sizes) - sizes, axis=1).T
        side = cells >= n
        near = cells - n * side
        joins = near < classes
        after, before = (np.zeros((len(sizes), classes)) for _ in range(2))
        after[word[joins & ~side], near[joins & ~side]] = amounts[joins & ~side]
        before[word[joins & side], near[joins & side]] = amounts[joins & side]
        all_after = np.bincount(word, weights=np.where(side, 0, amounts), minlength=len(sizes))[:, None]
        all_before = np.bincount(word, weights=np.where(side, amounts, 0), minlength=len(sizes))[:, None]
        # The cell of a class after itself is in both sums, and gets all three parts.
        k = np.arange(classes)
        cell, known = self.counts[k, k], self._logs[k, k]
        gain -= _xlogx(cell + after) + _xlogx(cell + before) - 2 * known
        gain += _xlogx(cell + after + before + own) - known
        # Its neighbours count it in their sums wherever it goes.
        out, into = self._out[:classes] + before, self._into[:classes] + after
        gain -= _xlogx(out + all_after + own) - _xlogx(out)
        gain -= _xlogx(into + all_before + own) - _xlogx(into)
        return gain


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


@dataclass(frozen=True)
class Vocabulary:
    """What all tasks know: bounded, whatever the corpus."""

    clustered: int  # classes of clustered words; bands, end and start come after
    tokens: int  # in training, ends included
    types: int
    ends: int
    class_tokens: np.ndarray  # by class
    class_types: np.ndarray
    core: np.ndarray  # the most frequent words, in order
    core_counts: np.ndarray
    core_classes: np.ndarray

    @property
    def end(self) -> int:
        return self.clustered + BANDS

    @property
    def classes(self) -> int:
        return self.clustered + BANDS + 2

    def emissions(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log10 of each token's probability within its class.

        Words seen once share their class with those never seen, which are taken to be as many;
        so each of them has half of one part.
        """
        rare = classes == self.clustered
        share = np.maximum(counts, 1) / np.maximum(self.class_tokens[classes], 1)
        once = 1 / (2 * max(1, self.class_types[self.clustered]))
        return np.log10(np.where(rare, once, share))


def score(
    docs: DataFrame,
    training: Column,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Score every text under a model of the texts for which ``training`` holds.

    Result: the ``doc_id`` column, ``held_out`` (not in training; null counts as in training),
    ``n_tokens`` (words and one end), ``n_known`` (tokens that training has), ``train_tokens``,
    ``base_score`` (log10, by token frequencies with one added) and ``score`` (log10, by the class
    model), ``perplexity`` of the latter. Words are runs of other than white space with A-Z in
    lower case. A null or empty text is an end alone. Repeated rows count and are scored each for
    itself; other columns are not kept; an empty table gives no rows, and without training texts
    every word is unknown.
    """
    spark = docs.sparkSession
    rows = docs.select(
        column(doc_id).alias("doc_id"),
        F.coalesce(column(text), F.lit("")).alias("body"),
        F.coalesce(training, F.lit(True)).alias("train"),
    )
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // _BUCKET_BYTES))

    counts = stored(_word_counts(rows), "words")
    words = counts.filter("word IS NOT NULL")
    vocabulary, words = _vocabulary(rows, counts, words)
    known = spark.sparkContext.broadcast(vocabulary)

    # Repeated rows lie in as many buckets as partitions of the input hold them.
    place = F.xxhash64("doc_id", "body", F.spark_partition_id())
    key = F.pmod(place, F.lit(buckets)).cast("int").alias("bucket")
    dealt = rows.select(key, "doc_id", "body", "train")
    used = dealt.groupBy("bucket").applyInArrow(
        lambda texts: _bucket_words(texts, known.value.core), "bucket int, word bigint"
    )
    shares = used.join(words, "word").select("bucket", "word", "n", "class")
    fields = "n_tokens bigint, n_known bigint, base_score double, emission double, classes binary"
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, train boolean, {fields}"
    encoded = stored(
        dealt.groupBy("bucket")
        .cogroup(shares.groupBy("bucket"))
        .applyInArrow(lambda texts, table: _encoded(texts, table, known.value), schema),
        "classes",
    )
    classes = vocabulary.classes
    steps = _steps(encoded.filter("train"), classes)
    log_steps = np.log10((steps + SMOOTHING) / (steps.sum(axis=1, keepdims=True) + SMOOTHING * classes))
    scored = encoded.withColumn("score", F.col("emission") + _path_score(F.col("classes"), log_steps))
    return scored.select(
        F.col("doc_id").alias(doc_id),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def _word_counts(rows: DataFrame) -> DataFrame:
    """``word`` and ``n``, its count in training; a null word stands for ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, gathered, n = 0, [], 0
        for batch in batches:
            ends += batch.num_rows
            for words in word_hashes(v.as_py() for v in batch.column(0)):
                gathered.append(words)
                n += len(words)
                if n >= _COUNTED_WORDS:
                    yield _counts(gathered)
                    gathered, n = [], 0
        if gathered:
            yield _counts(gathered)
        if ends:
            yield _two([None], [ends])

    parts = rows.filter("train").select("body").mapInArrow(count, "word bigint, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _counts(gathered: list[np.ndarray]) -> pa.RecordBatch:
    words, n = np.unique(np.concatenate(gathered), return_counts=True)
    return _two(words.view(np.int64), n)


def _two(words, n) -> pa.RecordBatch:
    arrays = [pa.array(words, pa.int64()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["word", "n"])


def _vocabulary(rows: DataFrame, counts: DataFrame, words: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and ``words`` with the class of each."""
    spark = rows.sparkSession
    often = words.filter(F.col("n") >= EVIDENCE)
    clustered = class_number(often.count())
    top = words.orderBy(F.desc("n"), "word").limit(CORE_WORDS).toArrow()
    core = top["word"].to_numpy().view(np.uint64)
    order = np.argsort(core)
    core, core_counts = core[order], top["n"].to_numpy()[order]
    bigrams = _core_bigrams(rows, core)
    core_class = exchange_classes(bigrams, len(core), clustered)
    steps = np.zeros((clustered + 2, clustered + 2))
    label = np.concatenate([core_class, [clustered, clustered + 1]])
    np.add.at(steps, (label[:, None], label[None, :]), bigrams)

    pairs = zip(core.view(np.int64).tolist(), core_class.tolist(), strict=True)
    labels = spark.createDataFrame([*pairs], "word bigint, class int")
    labels = labels.unionByName(_assigned(rows, often, core, core_class, steps))
    digits = F.least(F.floor(F.log2("n")), F.lit(BANDS - 1)).cast("int") + clustered
    labelled = words.join(labels, "word", "left").select(
        "word", "n", F.coalesce("class", digits).cast("int").alias("class")
    )
    labelled = stored(labelled, "labels")

    ends = counts.filter("word IS NULL").agg(F.sum("n")).first()[0] or 0
    tokens, types = (np.zeros(clustered + BANDS + 2, np.int64) for _ in range(2))
    for row in labelled.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        tokens[row["class"]], types[row["class"]] = row.n, row.v
    total, distinct = int(tokens.sum()) + ends, int(types.sum()) + bool(ends)
    tokens[clustered + BANDS], types[clustered + BANDS] = ends, 1
    core_words = (core, core_counts, core_class)
    return Vocabulary(clustered, total, distinct, ends, tokens, types, *core_words), labelled


def _assigned(
    rows: DataFrame, often: DataFrame, core: np.ndarray, core_class: np.ndarray, steps: np.ndarray
) -> DataFrame:
    """``word`` and ``class`` of all words of ``often`` outside ``core``, by the classes of their
    neighbours; neighbours outside are one class.

    A filter of two megabytes keeps most rare words' neighbours from being counted. What passes it
    is left out again by a join, so how much passes changes the cost only.
    """
    n, other, end = len(steps), len(steps) - 2, len(steps) - 1
    known = rows.sparkSession.sparkContext.broadcast((core, core_class, _filter(often)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core, core_class, packed = known.value
        wanted = np.unpackbits(packed, bitorder="little").view(bool)
        gathered, amount = [], 0
        for batch in batches:
            for words in word_hashes(v.as_py() for v in batch.column(0)):
                if not len(words):
                    continue
                at = np.minimum(np.searchsorted(core, words), len(core) - 1)
                hit = core[at] == words
                path = np.full(len(words) + 2, end)
                path[1:-1] = np.where(hit, core_class[at], other)
                own = np.flatnonzero(~hit & wanted[words >> np.uint64(64 - _FILTER_BITS)])
                gathered.append((np.tile(words[own], 2), np.concatenate([path[own + 2], n + path[own]])))
                amount += 2 * len(own)
                if amount >= _COUNTED_WORDS:
                    yield _cells(gathered)
                    gathered, amount = [], 0
        if amount:
            yield _cells(gathered)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Steps(steps.copy(), n - 2)
        for batch in batches:
            found = [np.empty(0, np.int64)]
            at = 0
            while at < batch.num_rows:
                # A few words at a time, by the number of their cells.
                part = batch.slice(at, _WORDS_AT_ONCE)
                cells, amounts = (part.column(name) for name in ("cells", "amounts"))
                sizes = cells.value_lengths().to_numpy()
                fit = max(1, int(np.searchsorted(np.cumsum(sizes), _CELLS_AT_ONCE, side="right")))
                sizes, total = sizes[:fit], int(sizes[:fit].sum())
                given = (x.flatten().to_numpy()[:total] for x in (cells, amounts))
                found.append(table.gains(sizes, *given).argmax(axis=1))
                at += len(sizes)
            arrays = [batch.column("word"), pa.array(np.concatenate(found), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "class"])

    parts = rows.filter("train").select("body").mapInArrow(count, "word bigint, cell int, n bigint")
    summed = parts.groupBy("word", "cell").agg(F.sum("n").alias("amount"))
    each = summed.groupBy("word").agg(F.collect_list(F.struct("cell", "amount")).alias("all"))
    each = each.join(often.select("word"), "word", "left_semi")
    each = each.select("word", F.col("all.cell").alias("cells"), F.col("all.amount").alias("amounts"))
    return each.mapInArrow(best, "word bigint, class int")


def _filter(often: DataFrame) -> np.ndarray:
    """A bit for each value of the leading bits of the hashes of words: whether a word has it."""
    place = F.shiftrightunsigned("word", 64 - _FILTER_BITS) + 1
    bitmaps = often.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    size = 1 << 12  # bytes of each
    packed = np.zeros((1 << _FILTER_BITS) // 8, np.uint8)
    for row in bitmaps.collect():
        packed[(row.part - 1) * size : row.part * size] = np.frombuffer(row.bits, np.uint8)
    return packed


def _cells(gathered: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """How often each word has each cell."""
    words, cells = (np.concatenate(parts) for parts in zip(*gathered, strict=True))
    order = np.lexsort([cells, words])
    words, cells = words[order], cells[order]
    new = np.append(True, (np.diff(cells) != 0) | (words[1:] != words[:-1]))
    first = np.flatnonzero(new)
    amounts = np.diff(np.append(first, len(words)))
    arrays = [pa.array(words[first].view(np.int64)), pa.array(cells[first], pa.int32()), pa.array(amounts, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["word", "cell", "n"])


def _core_bigrams(rows: DataFrame, core: np.ndarray) -> np.ndarray:
    """Counts of neighbours among the core words, any other word, and ends, in that order.

    A matrix of a bounded size, of which tasks send the cells they have, summed by Spark; all texts
    of training are counted.
    """
    n = len(core) + 2
    other, end = len(core), len(core) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, amount = [], 0
        for batch in batches:
            for words in word_hashes(v.as_py() for v in batch.column(0)):
                place = np.minimum(np.searchsorted(core, words), max(0, len(core) - 1))
                # Each text begins and ends with an end; those of two texts are no bigram.
                found = np.full(len(words) + 2, end)
                hit = core[place] == words if len(core) else np.zeros(len(words), bool)
                found[1:-1] = np.where(hit, place, other)
                gathered.append(found[:-1] * n + found[1:])
                amount += len(found)
                if amount >= _COUNTED_WORDS:
                    yield _counts(gathered)
                    gathered, amount = [], 0
        if gathered:
            yield _counts(gathered)

    parts = rows.filter("train").select("body").mapInArrow(count, "word bigint, n bigint")
    summed = parts.groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros(n * n)
    matrix[summed["word"].to_numpy()] = summed["n"].to_numpy()
    return matrix.reshape(n, n)


def _bucket_words(texts: pa.Table, core: np.ndarray) -> pa.Table:
    """The words of a bucket that not every task knows."""
    bucket = texts["bucket"][0].as_py()
    found = [np.unique(words) for words in word_hashes(v.as_py() for v in texts["body"])]
    unique = np.setdiff1d(np.concatenate(found), core)
    return pa.table(
        {
            "bucket": pa.array(np.full(len(unique), bucket), pa.int32()),
            "word": pa.array(unique.view(np.int64), pa.int64()),
        }
    )


def _encoded(texts: pa.Table, table: pa.Table, v: Vocabulary) -> pa.Table:
    """Figures and the classes of all tokens of each text of a bucket."""
    hashes = np.concatenate([table["word"].to_numpy().view(np.uint64), v.core])
    order = np.argsort(hashes)
    hashes, amounts = hashes[order], np.concatenate([table["n"].to_numpy(), v.core_counts])[order]
    labels = np.concatenate([table["class"].to_numpy(), v.core_classes])[order]
    out: dict[str, list] = {n: [] for n in ("n_tokens", "n_known", "base_score", "emission", "classes")}
    base = np.log10(v.tokens + v.types + 1)
    for words in word_hashes(t.as_py() for t in texts["body"]):
        counts = np.zeros(len(words), np.int64)
        classes = np.full(len(words), v.clustered)
        if len(hashes):
            place = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
            hit = hashes[place] == words
            counts = np.where(hit, amounts[place], 0)
            classes = np.where(hit, labels[place], v.clustered)
        out["n_tokens"].append(len(words) + 1)
        out["n_known"].append(int((counts > 0).sum()) + bool(v.ends))
        every = np.append(counts, v.ends)
        out["base_score"].append(float(np.log10(every + 1.0).sum() - len(every) * base))
        out["emission"].append(float(v.emissions(classes, counts).sum()))
        out["classes"].append(np.append(classes, v.end).astype(np.uint16).tobytes())
    return pa.table({"doc_id": texts["doc_id"], "train": texts["train"], **out})


def _steps(encoded: DataFrame, classes: int) -> np.ndarray:
    """How often each class follows each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for value in batch.column(0):
                at, n = np.unique(_path(value.as_py(), classes), return_counts=True)
                total[at] += n
        cells = np.flatnonzero(total)
        yield _two(cells, total[cells])

    parts = encoded.select("classes").mapInArrow(count, "word bigint, n bigint")
    steps = np.zeros(classes * classes)
    for row in parts.groupBy("word").agg(F.sum("n").alias("n")).collect():
        steps[row.word] = row.n
    return steps.reshape(classes, classes)


def _path(path: bytes, classes: int) -> np.ndarray:
    """Cells of the steps from class to class, from the start on."""
    after = np.frombuffer(path, np.uint16).astype(np.int64)
    before = np.concatenate([[classes - 1], after[:-1]])
    return before * classes + after


def _path_score(path: Column, log_steps: np.ndarray) -> Column:
    flat, classes = log_steps.ravel(), len(log_steps)

    def total(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([float(flat[_path(v.as_py(), classes)].sum()) for v in batch], pa.float64())

    return F.arrow_udf(total, "double")(path)
