"""Quality rules as a short-circuit cascade, in Spark expressions only.

A rule looks at figures of a text and says whether to reject it. Each rule's cost and the share of
texts it rejects are measured on a sample; then the rules run in the order of rejections per cost,
and a text that one rule rejects is not shown to the next. The order changes what a cascade costs,
never which texts it keeps.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.names import column

# The white space between words, and the characters that count as symbols.
WHITE_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

SAMPLE_ROWS = 2000


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once.

    Named in a lambda, an expression would be worked out again for each element; a lambda's own
    variable is not, wherever the optimizer moves the expression.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, in order; none if it is null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, " " * len(WHITE_SPACE))
    return F.array_remove(F.split(spaced, " "), "")


def _lines(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda line: F.translate(line, WHITE_SPACE, "") != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    body = F.coalesce(text, F.lit(""))
    return (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint")


def n_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(_lines(text)).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = _lines(text)
    return _with(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def n_repeat_words(text: Column) -> Column:
    """Words within windows of three words that the text holds twice or more.

    Most windows occur once. Where a hashed set finds that some do not, sorting brings equal ones
    together, and each is compared with its neighbours; then the words they cover are counted by
    the distances between the places of those that repeat.
    """

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)),
        )

    def repeated(sorted_: Column) -> Column:
        return F.filter(
            sorted_,
            lambda x, j: F.coalesce(x.w == F.get(sorted_, j - 1).w, F.lit(False))
            | F.coalesce(x.w == F.get(sorted_, j + 1).w, F.lit(False)),
        )

    def covered(found: Column) -> Column:
        return F.aggregate(
            F.array_sort(F.transform(found, lambda x: x.i)),
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, i: F.struct(
                (a.n + F.least(F.lit(3), i - a.last)).alias("n"), i.alias("last")
            ),
            lambda a: a.n,
        )

    def count(v: Column) -> Column:
        placed = F.transform(v, lambda x, i: F.struct(x.alias("w"), i.alias("i")))
        several = F.size(F.array_distinct(v)) < F.size(v)
        found = _with(F.sort_array(placed), repeated)
        return F.when(several, covered(found)).otherwise(F.lit(0))

    return _with(
        words(text),
        lambda w: F.when(F.size(w) > 3, _with(windows(w), count)).otherwise(F.lit(0)),
    ).cast("bigint")


#: The figures of a text, by name.
FIGURES: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_lines": n_lines,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
}

Figure = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function from a figure's name to its column; null does not reject."""

    name: str
    rejects: Callable[[Figure], Column]

    def verdict(self, figure: Figure) -> Column:
        return F.coalesce(self.rejects(figure), F.lit(False))


BASE_RULES = (
    Rule("too_short", lambda f: f("n_words") < 50),
    Rule("repeats_itself", lambda f: 100 * f("n_repeat_words") > 50 * f("n_words")),
)
PRODUCTION_RULES = (
    *BASE_RULES,
    Rule("mostly_symbols", lambda f: 2 * f("n_symbols") > f("n_words")),
    Rule("repeats_lines", lambda f: 100 * f("n_dup_lines") > 30 * f("n_lines")),
    Rule("short_words", lambda f: f("word_chars") < 2 * f("n_words")),
    Rule("long_words", lambda f: f("word_chars") > 15 * f("n_words")),
)


def measured(
    texts: DataFrame,
    rules: Sequence[Rule],
    *,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, tuple[float, float]]:
    """Seconds and share of rejections of each rule over the first ``sample_rows`` rows.

    Only booleans leave the executors, one per row of the sample, and Spark stops reading once it
    has them.
    """
    found = {}
    for rule in rules:
        verdicts = texts.select(rule.verdict(_figures_of(column(text))).alias("rejected"))
        seconds = []
        for _ in range(2):  # the first run also compiles
            start = time.perf_counter()
            got = verdicts.limit(sample_rows).collect()
            seconds.append(time.perf_counter() - start)
        share = sum(row.rejected for row in got) / len(got) if got else 0.0
        found[rule.name] = (min(seconds), share)
    return found


def ordered(rules: Sequence[Rule], costs: Mapping[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per cost first; ties as given."""

    def worth(rule: Rule) -> float:
        seconds, share = costs[rule.name]
        return share / max(seconds, 1e-6)

    return sorted(rules, key=worth, reverse=True)


def quality_cascade(
    docs: DataFrame,
    rules: Sequence[Rule] = PRODUCTION_RULES,
    *,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` without the rows that a rule rejects, rules in their cheapest order.

    The rules become one condition that Spark leaves at the first rejection. Columns stay as they
    are. A null text is judged like an empty one: it has no words. Repeated rows are judged each
    for itself, and alike. Without rules or rows the input comes back.
    """
    costs = measured(docs, rules, text=text, sample_rows=sample_rows)
    for rule in ordered(rules, costs):
        docs = docs.filter(~rule.verdict(_figures_of(column(text))))
    return docs


def with_verdicts(
    docs: DataFrame,
    rules: Sequence[Rule] = PRODUCTION_RULES,
    *,
    base: Sequence[Rule] = BASE_RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Every row with all figures, ``base_failed`` (one of ``base`` rejects it) and ``kept``.

    ``kept`` is false for a row that ``base`` or ``rules`` reject. The verdict is a chain of
    conditions in the cheapest order that ends at the first rejection. Nulls, empty texts and
    repeated rows as in :func:`quality_cascade`; columns with the names of results are replaced.
    """
    costs = measured(docs, rules, text=text, sample_rows=sample_rows)
    body = column(text)
    seen = docs.withColumns({name: figure(body) for name, figure in FIGURES.items()})
    failed = F.lit(False)
    for rule in base:
        failed = failed | rule.verdict(F.col)
    verdict = F.lit(True)
    for rule in reversed(ordered(rules, costs)):
        verdict = F.when(rule.verdict(F.col), F.lit(False)).otherwise(verdict)
    judged = seen.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & verdict)


def _figures_of(body: Column) -> Figure:
    return lambda name: FIGURES[name](body)
