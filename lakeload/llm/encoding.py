"""Token ids of whole texts, by the tokenizers library, inside a task.

A text is cut at safe boundaries, places at which its tokens are those of the left part followed by
those of the right part, so that only short pieces reach the tokenizer, in batches of about equal
bytes. A piece seen before is not encoded again: prose repeats its words, and a lookup is far
cheaper than an encoding. Arrow cuts the texts of a batch and numbers its different pieces, so that
each is looked up once, and puts their ids in place. What is remembered is bounded by bytes; when
half of that is full, what was not met while it filled is forgotten.
"""

from __future__ import annotations

import gc
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Of what the tokenizer gets at once; it keeps much about each piece.
BATCH_BYTES = 1 << 17
_TEXT_BATCHES = 8  # so many times that, at most, are texts cut together
_PART_OF_REMEMBERED = 256  # what they have, next to what is remembered
#: Of pieces in both generations together, in each Python worker.
REMEMBERED_BYTES = 128 << 20
# What an entry costs beside its two objects: its part of a dictionary.
_ENTRY_BYTES = 80
_BYTES_OBJECT = sys.getsizeof(b"")

# A space after anything but white space begins a new word of a byte-level tokenizer. White space
# here is Python's, which includes all that the tokenizers' own expressions count as such.
_DOUBTFUL = re.compile(r"[\s᠎] ")
_SAFE = re.compile(r"(?<=[^\s᠎])(?= )")
# What it finds, as texts; no white space comes after U+3000. Looking for a letter is far cheaper than
# an expression, and most texts have two kinds of white space only.
_DOUBTFUL_PAIRS = [(c, c + " ") for c in map(chr, range(0x3001)) if _DOUBTFUL.match(c + " ")]

# A word of Latin letters, each of them one letter in lower case too, and perhaps a few signs; and
# after a line end perhaps another one. Tokenizers split these in front of the signs and around the
# line end.
_WORD = "([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?#*$%&]{0,3})"
_PLAIN = re.compile(f"{_WORD}(?:\n{_WORD})?")
_ONE_SIGN = frozenset(".,;:!?#*$%&")
_PLAIN_SAMPLE = ("Word", "word", "Äpfel", "éèçñ", "Ünïcödé", "ıĳſɏ", "McDonald", "a")


def _is_doubtful(text: str) -> bool:
    """Whether a space follows white space."""
    for white, pair in _DOUBTFUL_PAIRS:
        if white in text and pair in text:
            return True
    return False


def split_before_spaces(text: str) -> list[str]:
    """Cut before each space that follows something other than white space; those spaces go."""
    if _is_doubtful(text):
        first, *rest = _SAFE.split(text)
        return [first, *[piece[1:] for piece in rest]]
    return text.split(" ")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: the printable ones for
    themselves, the others in turn for those from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + n) for n, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Letters(dict):
    """The letters that stand for the bytes of a character."""

    def __missing__(self, character: str) -> str:
        letters = self[character] = character.encode().decode("latin-1").translate(_LETTERS)
        return letters


_LETTERS_OF = _Letters()  # of a few hundred characters that plain words have


class Encoder:
    """Encodes texts with one tokenizer file; ids come as little-endian bytes, ``width`` each."""

    def __init__(self, path: str, remembered: int | None = None) -> None:
        if sys.byteorder != "little":
            raise RuntimeError("ids are packed on little-endian machines")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._most = remembered or REMEMBERED_BYTES
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._code = "H" if self.width == 2 else "I"
        self._one = [n.to_bytes(self.width, "little") for n in range(self.tokenizer.get_vocab_size())]
        self._lower = self._drops_white_space()
        self._plain = all(
            self._words([w], space) == [self._ids(space + w)] for w in _PLAIN_SAMPLE for space in ("", " ")
        )
        # Ids of signs after a word, and of a line end.
        self._signs = {"": b"", "\n": self._ids("\n")}
        # Ids of pieces that follow a space, with that space.
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        # Ids of plain words that no space precedes.
        self._bare: dict[str, bytes] = {}
        self._bytes = 0

    def _ids(self, piece: str) -> bytes:
        return self._packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        return array(self._code, ids).tobytes()

    def _words(self, words: Iterable[str], space: str = " ") -> list[bytes]:
        """Ids of plain words, each after ``space``, straight from the tokenizer's model.

        They need no splitting, and its bookkeeping for one word costs more than the merges.
        """
        tokenize = self.tokenizer.model.tokenize
        one, joined = self._one, b"".join
        space = _LETTERS[32] if space and not self._lower else ""
        if self._lower:
            words = map(str.lower, words)
        # ASCII letters stand for themselves.
        letters_of, spell = _LETTERS_OF.__getitem__, "".join
        letters = [
            space + (word if word.isascii() else spell(map(letters_of, word))) for word in words
        ]
        return [joined([one[token.id] for token in tokenize(word)]) for word in letters]

    def _drops_white_space(self) -> bool:
        return not self.tokenizer.encode(" \n", add_special_tokens=False).ids

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order; a null text is an empty one."""
        most = min(max(self._most // _PART_OF_REMEMBERED, BATCH_BYTES), _TEXT_BATCHES * BATCH_BYTES)
        for batch in _by_bytes(texts, most):
            first, pieces, starts, ends = self._cut(batch)
            data, places = self._known_ids(pieces)
            # The first piece of a text has no space before it.
            spans = zip(self._batch(first), places[starts].tolist(), places[ends].tolist(), strict=True)
            for ids, start, end in spans:
                yield ids + data[start:end]

    def _cut(self, batch: list[str]) -> tuple[list[str], pa.Array, np.ndarray, np.ndarray]:
        """First pieces; all others, each after a space that is left out, and where those of each
        text start and end."""
        first, rests, doubtful, rows = [], [], [], []
        for text in batch:
            if self._lower:  # line ends part words as spaces do
                text = text.replace("\n", " ")
            elif _is_doubtful(text):
                head, *rest = split_before_spaces(text)
                first.append(head)
                doubtful.append(rest)
                rows.append(-len(doubtful))
                continue
            head, space, rest = text.partition(" ")
            first.append(head)
            rows.append(len(rests))
            rests.append(rest if space else None)
        lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        if doubtful:  # the last comes first: those rows count from the end
            lists = pa.concat_arrays([lists, pa.array(doubtful[::-1], lists.type)])
        counts = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(counts, dtype=np.int64)
        return first, lists.flatten(), (ends - counts)[rows], ends[rows]

    def _known_ids(self, pieces: pa.Array) -> tuple[memoryview, np.ndarray]:
        """The ids of all pieces one behind the other, and the place where each piece's begin."""
        coded = pieces.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self._learned(different)
        ids = pa.array(known, pa.large_binary()).take(coded.indices)
        if not len(ids):
            return memoryview(b""), np.zeros(1, np.int64)
        _, places, data = ids.buffers()
        return memoryview(data or b""), np.frombuffer(places, np.int64, len(ids) + 1)

    def count(self, texts: Iterable[str | None]) -> Iterator[int]:
        """The number of ids of each text, in order."""
        return (len(ids) // self.width for ids in self.encode(texts))

    def _learned(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces, which are remembered from now on."""
        if 2 * self._bytes > self._most:
            self._known, self._older = {}, self._known
            self._bare, self._bytes = {}, 0
        found = list(map(self._known.get, pieces))
        missing = [n for n, ids in enumerate(found) if ids is None]
        new = {pieces[n] for n in missing}
        older = self._older
        if older:
            met = list(older.keys() & new)  # goes through the smaller one
            self._keep(met, [older[piece] for piece in met])
            new.difference_update(met)
        rest = self._learn_words(new) if self._plain else list(new)
        self._keep(rest, self._batch([" " + piece for piece in rest]))
        known = self._known
        for n in missing:
            found[n] = known[pieces[n]]
        return found

    def _batch(self, pieces: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for batch in _by_bytes(pieces):
            encoded = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
            found.extend(self._packed(encoding.ids) for encoding in encoded)
        return found

    def _learn_words(self, new: set[str]) -> list[str]:
        """Learn the plain words among new pieces; the pieces that are none."""
        rest, words, signed, composed = [], set(), [], []
        for piece in new:
            if piece.isascii():  # most of them: told apart without an expression
                if piece.isalpha():
                    words.add(piece)
                    continue
                word = piece[:-1]
                if piece[-1:] in _ONE_SIGN and word.isalpha():
                    words.add(word)
                    signed.append((piece, word))
                    continue
            if match := _PLAIN.fullmatch(piece):
                words.add(match[1])
                if len(match[1]) < len(piece):
                    composed.append((piece, *match.groups()))
            else:
                rest.append(piece)
        self._learn_new(self._known, words, " ")
        self._learn_new(self._bare, {bare for _, _, _, bare, _ in composed if bare}, "")
        known, after, bare = self._known, self._sign, self._bare
        line = self._signs["\n"]
        self._keep([x[0] for x in signed], [known[word] + after(piece[-1]) for piece, word in signed])
        self._keep(
            [x[0] for x in composed],
            [
                known[word] + after(sign) + (line + bare[second] + after(more) if second else b"")
                for _, word, sign, second, more in composed
            ],
        )
        return rest

    def _learn_new(self, known: dict[str, bytes], words: set[str], space: str) -> None:
        unknown = list(words.difference(known))
        self._keep(unknown, self._words(unknown, space), known)

    def _sign(self, sign: str) -> bytes:
        """Ids of some signs: so few at most that there are no more than a thousand."""
        if sign not in self._signs:
            self._signs[sign] = self._ids(sign)
        return self._signs[sign]

    def _keep(self, pieces: list[str], ids: list[bytes], known: dict[str, bytes] | None = None) -> None:
        """Remember the ids of pieces that are not known yet."""
        (self._known if known is None else known).update(zip(pieces, ids, strict=True))
        size = sum(map(str.__sizeof__, pieces)) + len(b"".join(ids))
        self._bytes += size + (_ENTRY_BYTES + _BYTES_OBJECT) * len(pieces)


def _by_bytes(texts: Iterable[str | None], most: int | None = None) -> Iterator[list[str]]:
    """Lists of texts of about ``most`` bytes together, by default ``BATCH_BYTES``; a longer text
    comes alone."""
    most = most or BATCH_BYTES
    batch: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if batch and size + len(text) > most:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text) + 1
    if batch:
        yield batch


@lru_cache(maxsize=1)
def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The worker's encoder for a file, kept from task to task until another one is asked for.

    ``remembered`` bounds the bytes of remembered pieces, by default :data:`REMEMBERED_BYTES`.
    """
    # Pieces and ids are no containers: looking through them for cycles is in vain.
    gc.set_threshold(100_000, 20, 100)
    # What earlier stages have left to this worker goes back first.
    pa.default_memory_pool().release_unused()
    return Encoder(path, remembered)


def forget_encoder() -> None:
    """Free the worker's encoder: workers live on from one query to the next, and what an earlier one
    remembered would be there beside what this one needs."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        pa.default_memory_pool().release_unused()
