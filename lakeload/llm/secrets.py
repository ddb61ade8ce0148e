"""Secrets in texts, found by one automaton for all rules."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.automaton import Automaton, compiled
from lakeload.names import column


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds matches; those that do not also fit ``least`` as a whole are dropped.

    Matches of a rule are leftmost, greedy and do not overlap; a dropped one uses up its text like
    any other. ``rest`` is what a match goes on with where it can. Syntax:
    :mod:`lakeload.llm.automaton`.
    """

    kind: str
    pattern: str
    least: str | None = None
    ignore_case: bool = False
    rest: str | None = None


# The three kinds every scan has, in this order.
_KEY = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    SecretRule("assign", _KEY + "[A-Za-z0-9+/_.=-]+", _KEY + "[A-Za-z0-9+/_.=-]{6,}", True),
    SecretRule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{16,}"),
    # As good as runs of any length of which short ones are dropped, and quiet in plain prose; a
    # count up to 24 would triple the automaton.
    SecretRule("hex", "[0-9a-f]{8,}", "[0-9a-f]{24,}"),
)
# Public token formats. Lines of a key may be escaped, and headers stand before them;
# without an end, its full lines count.
_LINE = r"(\x20|\t|\r|\n|\x5c[nr])"
_BODY = rf"([A-Za-z0-9+/=]|{_LINE}|[A-Za-z0-9-]+:\x20[^\r\n\x5c]*)*"
EXTRA_RULES = (
    SecretRule(
        "private_key",
        "-----BEGIN [A-Z ]*PRIVATE KEY-----",
        rest=rf"({_BODY}-----END [A-Z ]*PRIVATE KEY-----|({_LINE}+[A-Za-z0-9+/=]{{40,}})+)",
    ),
    SecretRule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}"),
    SecretRule(
        "jwt",
        r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
        r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    ),
)
PRODUCTION_RULES = (*BASE_RULES, *EXTRA_RULES)

#: Of redacted texts that go back to Spark together.
_OUT_CHARS = 1 << 20

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


class Scanner:
    """Finds the spans of all rules in one pass over the bytes.

    The pass says where a match of a rule has come to an end. Only there its start is looked up
    backwards, and its greedy end forwards, by small automata of that rule alone.
    """

    def __init__(self, rules: Sequence[SecretRule]) -> None:
        self.rules = tuple(rules)
        cased = [rule.ignore_case for rule in rules]
        self._all = compiled([r.pattern for r in rules], ignore_case=cased, anywhere=True)
        self._forth = [self._alone(f"({r.pattern})({r.rest})?" if r.rest else r.pattern, r) for r in rules]
        self._back = [self._alone(r.pattern, r, backwards=True) for r in rules]
        self._least = [self._alone(r.least, r) if r.least else None for r in rules]
        self._rows: list[list[int]] | None = None

    @staticmethod
    def _alone(pattern: str, rule: SecretRule, **how) -> Automaton:
        return compiled([pattern], ignore_case=[rule.ignore_case], **how)

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """Start, rule number and end of each match, sorted; in code points, ends exclusive."""
        if not text:
            return []
        data = text.encode()
        found = self._find(data)
        if found and len(data) != len(text):
            places = _code_points(data, {p for start, _, end in found for p in (start, end)})
            found = [(places[start], k, places[end]) for start, k, end in found]
        return sorted(found)

    def _find(self, data: bytes) -> list[tuple[int, int, int]]:
        rows = self._rows = self._rows or self._all.rows()
        accepting = self._all.first_accepting
        accepts = self._all.accepts
        found = []
        used = [0] * len(self.rules)
        state = 0
        view = memoryview(data)  # parts of it are not copied
        for at, byte in enumerate(data):
            state = rows[state][byte]
            if state >= accepting:
                for k, done in enumerate(used):
                    if at >= done and accepts[state] >> k & 1:
                        start = _longest(self._back[k], view[done : at + 1][::-1])
                        if start:
                            start = at + 1 - start
                            end = start + _longest(self._forth[k], view[start:])
                            used[k] = end
                            if self._fits(k, view[start:end]):
                                found.append((start, k, end))
        return found

    def _fits(self, k: int, match: memoryview) -> bool:
        least = self._least[k]
        return least is None or _longest(least, match) == len(match)


def _longest(automaton: Automaton, data) -> int:
    """How many bytes the longest match from the first byte on has; 0 if there is none."""
    step, accepting, dead = automaton.step, automaton.first_accepting, automaton.dead
    state = length = 0
    for n, byte in enumerate(data, 1):
        state = step[state, byte]
        if state >= accepting:
            length = n
        elif state == dead:
            break
    return length


def _code_points(data: bytes, places: set[int]) -> dict[int, int]:
    counted, last, n = {}, 0, 0
    for place in sorted(places):
        n += len(data[last:place].decode())
        counted[place] = n
        last = place
    return counted


@lru_cache(maxsize=4)
def scanner(rules: tuple[SecretRule, ...]) -> Scanner:
    return Scanner(rules)


def secret_spans(text: Column, rules: Sequence[SecretRule] = PRODUCTION_RULES) -> Column:
    """The secrets of a text: kind, start and end in code points, by start, then order of rules.

    Spans of different rules may overlap. A null or empty text has none; repeated texts have equal
    ones. A very long text is scanned whole, in time in proportion to its length however many
    matches it has; an empty table stays empty.
    """
    rules = tuple(rules)
    names = [rule.kind for rule in rules]

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = scanner(rules)
        for texts in batches:
            yield pa.array(
                [
                    [
                        {"kind": names[k], "start": start, "end": end}
                        for start, k, end in scan.spans(value.as_py())
                    ]
                    for value in texts
                ],
                type=_ARROW_SPANS,
            )

    return F.arrow_udf(found, SPANS)(text)


def redacted(text: Column, rules: Sequence[SecretRule] = PRODUCTION_RULES) -> Column:
    """The text with each secret replaced by its kind, as in ``<hex>``.

    Overlapping spans are replaced together, by the kind of the one that starts first. Null stays
    null.
    """
    rules = tuple(rules)

    def replaced(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _redacted(batches, rules)

    return F.arrow_udf(replaced, "string")(text)


def _redacted(batches: Iterator[pa.Array], rules: tuple[SecretRule, ...]) -> Iterator[pa.Array]:
    """A batch may hold the texts of a whole file; what becomes of them goes back in small parts."""
    scan = scanner(rules)
    for texts in batches:
        done, size = [], 0
        for value in texts:
            done.append(_without(scan, value.as_py()))
            size += len(done[-1] or "")
            if size >= _OUT_CHARS:
                yield pa.array(done, type=pa.string())
                done, size = [], 0
        yield pa.array(done, type=pa.string())


def _without(scan: Scanner, text: str | None) -> str | None:
    parts, done, filled = [], 0, 0
    for start, k, end in scan.spans(text):
        if start >= filled:
            parts += [text[done:start], f"<{scan.rules[k].kind}>"]
        done = filled = max(filled, end)
    return text if not parts else "".join([*parts, text[done:]])


def find_secrets(
    docs: DataFrame, rules: Sequence[SecretRule] = PRODUCTION_RULES, *, text: str = "text"
) -> DataFrame:
    """Add ``secrets``, the spans of :func:`secret_spans`; a column of that name is replaced."""
    return docs.withColumn("secrets", secret_spans(column(text), rules))


def redact_secrets(
    docs: DataFrame, rules: Sequence[SecretRule] = PRODUCTION_RULES, *, text: str = "text"
) -> DataFrame:
    """``docs`` with the secrets of every text replaced; rows and other columns stay."""
    return docs.withColumn(text, redacted(column(text), rules))


def listed(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))
