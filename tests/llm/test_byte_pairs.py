"""Byte-level BPE against the library that defines its ids."""

import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken

from lakeload.llm import byte_pairs
from lakeload.llm.byte_pairs import BytePairs, Encoder, read_ranks, with_bpe_bytes, with_bpe_ids
from lakeload.llm.queries import QUERIES, RANKS

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module", params=[RANKS, public_tokenizers.path("byte_bpe_50k.tiktoken")])
def ranks(request):
    return request.param


@pytest.fixture(scope="module")
def pairs(ranks):
    return BytePairs(read_ranks(ranks))


@pytest.fixture(scope="module")
def library(pairs):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})


def test_matches_encode_as_the_library_merges(pairs, library):
    chance = random.Random(5)
    tokens = list(pairs.ranks)
    for n in range(6000):
        data = (
            bytes(chance.choices(b"ab", k=chance.randint(1, 30))),
            bytes(chance.choices(b"etaoin \xc3\xa9", k=chance.randint(1, 30))),
            b"".join(chance.choices(tokens, k=chance.randint(1, 6))),
            chance.randbytes(chance.randint(1, 12)),
        )[n % 4]
        found = pairs.encode(data)
        assert list(found) == library._encode_single_piece(data)
        assert pairs.decode(found) == data


def test_every_token_is_itself(pairs):
    assert all(list(pairs.encode(token)) == [rank] for token, rank in pairs.ranks.items())


def test_time_grows_with_the_length_only(pairs, library):
    for text in ("a" * 400_000, "=-" * 200_000, "".join(random.Random(1).choices("abcd", k=400_000))):
        began = time.time()
        found = list(pairs.encode(text.encode()))
        assert time.time() - began < 20
        assert found[:2000] == library._encode_single_piece(text.encode())[:2000]


def test_whole_texts(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED_BYTES", 4000)
    monkeypatch.setattr(byte_pairs, "REMEMBERED_PAIRS", 50)
    encoder = Encoder(ranks, PATTERN)
    chance = random.Random(2)
    odd = ["a", "B", " ", "  ", "\n", "\t", "'s", "<|endoftext|>", "1", "é", "́", "\x1c", "\x85"]
    odd += ["᠎", "​", "!", "　", "İ", "word", "ǅ", "日", "_", "🙂", "x" * 50]
    for _ in range(3000):
        text = "".join(chance.choices(odd, k=chance.randint(0, 20)))
        ids = memoryview(encoder.encode(text)).cast("I").tolist()
        assert ids == library.encode_ordinary(text)
    assert encoder._bytes <= 4000 and len(encoder.pairs._compatible) <= 50


def test_ranks_must_be_those_of_merges(pairs):
    with pytest.raises(ValueError, match="every single byte"):
        BytePairs({b"a": 0})
    single = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError, match="share a rank"):
        BytePairs({**single, b"ab": 7})
    with pytest.raises(ValueError, match="no order of merges"):
        BytePairs({**single, b"abc": 300, b"ab": 301})


def test_tokens_that_merging_never_gives_stand_only_for_themselves():
    single = {bytes([b]): b for b in range(256)}
    odd = BytePairs({**single, b"bc": 256, b"ab": 257, b"abcd": 258, b"dx": 259})
    library = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=odd.ranks, special_tokens={})
    for text in ("abc", "abcd", "xabcd", "abcdabcd", "ababcd", "abcabc", "cdab", "abcdx"):
        assert list(odd.encode(text.encode())) == library._encode_single_piece(text.encode())


def test_ids_of_a_table_and_back(awkward, library, ranks):
    clashing = awkward.withColumnRenamed("lang", "ids").withColumnRenamed("source", "text_")
    encoded = with_bpe_ids(clashing, ranks, PATTERN)
    both = with_bpe_bytes(encoded, ranks, PATTERN)
    assert both.columns == ["doc_id", "text", "ids", "text_", "n_chars", "bytes"]
    assert both.count() == awkward.count()
    for row in both.collect():
        assert row.ids == library.encode_ordinary(row.text or "")
        assert bytes(row.bytes) == (row.text or "").encode()


def test_ids_are_worked_out_once(documents, ranks):
    encoded = with_bpe_ids(documents(["a b"]), ranks, PATTERN)
    both = with_bpe_bytes(encoded, ranks, PATTERN).selectExpr("size(ids)", "ids", "bytes")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("encoded(") == 1


def test_nothing_and_null_ids(spark, documents, ranks):
    assert with_bpe_ids(documents([]), ranks, PATTERN).count() == 0
    rows = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>")
    found = [row.bytes for row in with_bpe_bytes(rows, ranks, PATTERN).collect()]
    assert found[:2] == [None, b""] and len(found[2]) == 2


def test_the_query(spark, documents, tmp_path, awkward, library):
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    ranks = read_ranks(RANKS)
    encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = set()
    for row in awkward.collect():
        ids = encode.encode_ordinary(row.text or "")
        listed = ",".join(map(str, ids)).encode()
        digests = [hashlib.sha256(data).hexdigest() for data in (listed, (row.text or "").encode())]
        wanted.add((row.doc_id, len(ids), *digests))
    found = QUERIES["op11_byte_bpe"](spark, str(tmp_path)).collect()
    assert {tuple(row) for row in found} == wanted and len(found) == awkward.count()
