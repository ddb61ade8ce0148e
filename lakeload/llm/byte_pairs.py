"""Byte-level BPE: texts to the ids of a file of ranks, and ids back to bytes.

A text is split by a pattern, and each match is encoded by itself. Merging pair by pair takes more
than linear time in a match's length, so the same ids are found another way. Two tokens are
compatible if merging their joint bytes gives just these two; a row of tokens is what merging gives
if all its neighbours are compatible. An automaton over all tokens (bytes as Latin-1 letters) tells
the longest token at each place. From left to right the longest token compatible with the one before
is taken; where none is left, the one before gives way to its next shorter. A place found to lead
nowhere is never tried again, so the time is linear.

What a match was encoded to, and which tokens are compatible, is remembered within bounds.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.names import column

#: For both generations of remembered matches together, in each Python worker.
REMEMBERED_BYTES = 48 << 20
#: Pairs of tokens whose compatibility is remembered: some 30 MB.
REMEMBERED_PAIRS = 1 << 18
# What an entry costs beside letters and ids: dictionary slot and two object headers.
_ENTRY_BYTES = 200
_NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, from a file of lines with a token in base 64 and its rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class BytePairs:
    """Encodes and decodes bytes by ranks: the pair of neighbours whose joint bytes have the lowest
    rank merges first, the leftmost of several, until no pair has one; bytes that are a token as a
    whole are that token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte needs a rank")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        if len(self.tokens) < len(ranks):
            raise ValueError("two tokens share a rank")
        # The two tokens that each token was last merged from.
        self._halves: dict[int, tuple[int, int]] = {}
        found = ahocorasick.Automaton()
        for token, rank in ranks.items():
            parts = self._halves_of(token, rank) if len(token) > 1 else ()
            if parts is None:
                continue  # merging never gives this token
            if parts:
                self._halves[rank] = parts
            # Backwards, so that the tokens that begin at a place end there, the longest first.
            found.add_word(token[::-1].decode("latin-1"), rank)
        found.make_automaton()
        self._found = found
        self._shorter = {rank: self._prefix(self.tokens[rank]) for rank in found.values()}
        self._compatible: dict[tuple[int, int], bool] = {}

    def _halves_of(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The last two parts of a token when it is merged from bytes, if that ever gives it."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
            ranks = [self.ranks.get(pair, _NEVER) for pair in pairs]
            least = min(ranks)
            if least == _NEVER:
                return None
            if least > rank:
                raise ValueError(f"{token!r} ranks before a part of it: no order of merges")
            at = ranks.index(least)
            parts[at : at + 2] = [pairs[at]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _prefix(self, token: bytes) -> int:
        """The longest shorter token with which this one begins, or -1."""
        for end in range(len(token) - 1, 0, -1):
            rank = self.ranks.get(token[:end])
            if rank is not None and (end == 1 or rank in self._halves):
                return rank
        return -1

    def compatible(self, one: int, two: int) -> bool:
        """Whether the bytes of two tokens, merged together, give just these two."""
        known = self._compatible.get((one, two))
        if known is None:
            if len(self._compatible) >= REMEMBERED_PAIRS:
                self._compatible.clear()
            known = self._compatible[one, two] = self._never_merge(one, two)
        return known

    def _never_merge(self, left: int, right: int) -> bool:
        """Undo the merges at the border of two tokens, the latest first: at no moment may the parts
        that meet there have merged before one of them merged with its other neighbour."""
        left_until = right_until = _NEVER
        while True:
            joint = self.ranks.get(self.tokens[left] + self.tokens[right])
            # Of two merges of one rank the left one comes first.
            if joint is not None and joint < left_until and joint <= right_until:
                return False
            # The part formed last is undone; a single byte was never formed.
            formed = (left if left in self._halves else -1, right if right in self._halves else -1)
            if max(formed) < 0:
                return True
            if formed[0] > formed[1]:
                left_until, left = left, self._halves[left][1]
            elif formed[0] < formed[1]:
                right_until, right = right, self._halves[right][0]
            else:
                # Equal tokens: the left one was formed first.
                right_until, right = right, self._halves[right][0]

    def encode(self, data: bytes) -> array:
        """The ids of some bytes."""
        whole = self.ranks.get(data)
        if whole is not None:
            return array("I", (whole,))
        n = len(data)
        longest = array("i", bytes(4 * n))
        place = -1
        for end, rank in self._found.iter(data[::-1].decode("latin-1")):
            if end != place:
                longest[n - 1 - end] = rank
                place = end
        open_at = bytearray(b"\x01") * (n + 1)
        tokens, shorter, compatible = self.tokens, self._shorter, self.compatible
        out: list[int] = []
        at = 0
        token = longest[0] if n else -1
        while at < n:
            end = at + len(tokens[token])
            if open_at[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
                continue
            token = shorter[token]
            while token < 0:
                # Nothing fits here: the token before gives way.
                open_at[at] = 0
                last = out.pop()
                at -= len(tokens[last])
                token = shorter[last]
        return array("I", out)

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of some ids; an id without a token is an error."""
        return b"".join(map(self.tokens.__getitem__, ids))


class Encoder:
    """Encodes texts match by match of a pattern, matches met before from memory."""

    def __init__(self, path: str, pattern: str) -> None:
        self.pairs = BytePairs(read_ranks(path))
        self._matches = regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._bytes = 0

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, four bytes each; those of nothing for null."""
        matches = self._matches(text or "")
        for match in set(matches).difference(self._known):
            ids = self._older.pop(match, None)
            if ids is None:
                ids = self.pairs.encode(match.encode()).tobytes()
            self._known[match] = ids
            self._bytes += 4 * len(match) + len(ids) + _ENTRY_BYTES
        found = b"".join(map(self._known.__getitem__, matches))
        if 2 * self._bytes > REMEMBERED_BYTES:
            self._known, self._older, self._bytes = {}, self._known, 0
        return found


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    return Encoder(path, pattern)


def bpe_ids(text: Column, ranks: str, pattern: str) -> Column:
    """The ids of whole texts as ``array<int>``; see :func:`with_bpe_ids`."""

    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoder(ranks, pattern).encode
        for texts in batches:
            found = [encode(value.as_py()) for value in texts]
            ends = np.cumsum([0, *(len(ids) // 4 for ids in found)], dtype=np.int32)
            flat = np.frombuffer(b"".join(found), np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    # Several columns of a query may be made from the ids, which are worked out once.
    return F.arrow_udf(encoded, "array<int>").asNondeterministic()(text)


def bpe_bytes(ids: Column, ranks: str, pattern: str) -> Column:
    """The bytes that ids stand for; null for null. An id that the file lacks is an error."""

    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode = _encoder(ranks, pattern).pairs.decode
        for lists in batches:
            yield pa.array(
                [None if value is None else decode(value) for value in _lists(lists)], pa.binary()
            )

    return F.arrow_udf(decoded, "binary").asNondeterministic()(ids)


def _lists(lists: pa.Array) -> Iterator[list[int] | None]:
    for value in lists:
        yield value.values.to_numpy(zero_copy_only=False).tolist() if value.is_valid else None


def with_bpe_ids(
    docs: DataFrame, ranks: str, pattern: str, *, text: str = "text", into: str = "ids"
) -> DataFrame:
    """Add the ids of every whole text.

    ``ranks`` is the path of a file of ranks that every executor has, see :func:`read_ranks`;
    ``pattern`` splits a text before merging, each match being encoded separately. Special tokens
    are not known: their strings are ordinary text. Null and empty texts have no ids; a text of any
    length takes time in proportion to it, also without a place to split. Rows stay as they are,
    repeated ones too, an empty table stays empty, and a column named ``into`` is replaced.
    """
    return docs.withColumn(into, bpe_ids(column(text), ranks, pattern))


def with_bpe_bytes(
    rows: DataFrame, ranks: str, pattern: str, *, ids: str = "ids", into: str = "bytes"
) -> DataFrame:
    """Add the bytes that the ids of each row stand for, the inverse of :func:`with_bpe_ids`.

    Ids need not end where a character does, hence bytes and not text. Null ids give null, none
    give empty bytes; a column named ``into`` is replaced.
    """
    return rows.withColumn(into, bpe_bytes(column(ids), ranks, pattern))
