import random
import resource
import time

import pytest
from pyspark.sql import functions as F

from lakeload.llm import decontamination as d

from .conftest import PROSE


def sellers(passage, text):
    """The fewest edits that make some part of a text a passage, cell by cell."""
    before = list(range(len(passage) + 1))
    best = before[-1]
    for code in text:
        row = [0]
        for i, other in enumerate(passage, 1):
            row.append(min(before[i - 1] + (other != code), before[i] + 1, row[i - 1] + 1))
        before, best = row, min(best, row[-1])
    return best


@pytest.mark.parametrize("often, postings", [(8, 1 << 20), (0, 1 << 20), (1, 16)])
def test_finds_what_brute_force_finds(monkeypatch, often, postings):
    """Also where q-grams repeat, and are counted a few at a time."""
    monkeypatch.setattr(d, "OFTEN", often)
    monkeypatch.setattr(d, "_POSTINGS", postings)
    chance = random.Random(3)
    for _ in range(1200):
        letters = chance.choice(["ab cAé\n", "aaaab", "a"])
        items = ["".join(chance.choices(letters, k=chance.randint(0, 45))) for _ in range(3)]
        noise = ["".join(chance.choices("ab c", k=chance.randint(0, 20))) for _ in range(2)]
        copy = "".join(c for c in chance.choice(items) if chance.random() > 0.04)
        text = noise[0] + copy + noise[1]
        (hits,) = d.Finder(d.Passages.of(range(3), items)).find([text])
        codes = d.normalized(text)[0].tolist()
        wanted = set()
        for k, item in enumerate(items):
            passage = d.normalized(item)[0].tolist()
            if passage and sellers(passage, codes) <= d.edits_allowed(len(passage)):
                wanted.add(k)
        assert {hit[0] for hit in hits} == wanted, (items, text)


def test_text_and_passage_of_one_character():
    """As rules of dashes are: in time and memory in proportion to the text."""
    finder = d.Finder(d.Passages.of([0, 1], ["-" * 4000, "=" * 300 + "x"]))
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    (hits,) = finder.find(["-" * 1_000_000])
    assert [hit[1:] for hit in hits] == [(4000 * k, 4000 * (k + 1), 0) for k in range(250)]
    assert time.time() - began < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kB
    mixed = "".join("-" * n + "+" for n in range(3500, 4300, 50))
    (hits,) = finder.find([mixed])
    assert hits and all(0 <= hit[3] <= 400 for hit in hits)


def test_places_in_the_text_as_it_is():
    item = "Nobody  in the\nvillage minds because it rains"
    text = "é — " + item.upper().replace(" ", " \t ") + " and more"
    (hits,) = d.Finder(d.Passages.of(["q"], [item])).find([text])
    [(_, start, end, edits)] = hits
    assert d.normalized(text[start:end])[0].tolist() == d.normalized(item)[0].tolist()
    assert edits == 0


def test_many_texts_at_once_do_not_mix(monkeypatch):
    monkeypatch.setattr(d, "_SLICE_CHARS", 400)
    items = [PROSE[k : k + 60] for k in range(0, 300, 60)]
    texts = [items[0], items[0][:30], items[0][30:], None, "", " ".join(items), PROSE * 3, items[4]]
    finder = d.Finder(d.Passages.of(range(5), items))
    found = [sorted({hit[0] for hit in hits}) for hits in finder.find(texts)]
    assert found == [[0], [], [], [], [], [0, 1, 2, 3, 4], [0, 1, 2, 3, 4], [4]]


def benchmark(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


def test_operator(spark, documents, awkward):
    leak = PROSE[40:160]
    edited = leak.replace("seven", "eleven").replace("pot", "pan")
    docs = documents([f"x {leak} y", f"{PROSE[:20]} {edited}", "clean line", None], [10, 11, 12, 13])
    docs = docs.unionByName(awkward)
    items = benchmark(spark, [leak, None, "", "x", leak])
    marked = d.with_leaks(docs, items)
    assert marked.count() == docs.count()
    found = {(r.doc_id, x.item_id) for r in marked.collect() for x in r.leaks if x.item_id != 3}
    assert found == {(i, k) for i in (3, 10, 11) for k in (0, 4)}
    kept = d.decontaminate(docs, items)
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect()]
    assert 12 in left and 13 in left and not {3, 10, 11, 7} & set(left)


def test_blocks_of_the_benchmark(spark, documents):
    items = benchmark(spark, [PROSE[k : k + 50] for k in range(0, 300, 50)])
    parts = list(d.blocks(items, chars=100))
    assert len(parts) == 3 and sum(len(p.ids) for p in parts) == 6


def test_a_benchmark_in_blocks_finds_the_same(spark, documents, awkward):
    items = benchmark(spark, [PROSE[k : k + 50] for k in range(0, 300, 50)])
    docs = documents([PROSE, PROSE[100:260], "none", None, PROSE], [1, 2, 3, 4, 1]).unionByName(awkward)
    docs = docs.withColumn("number", F.lit(5)).withColumn("leaks", F.lit(1))

    def found(marked):
        return sorted(
            ((r.doc_id or -1, r.number, sorted(tuple(x) for x in r.leaks)) for r in marked.collect()), key=str
        )

    whole, parts = d.with_leaks(docs, items), d.with_leaks(docs, items, block_chars=100)
    assert parts.columns == whole.columns and found(parts) == found(whole)
    starts = [[x.start for x in r.leaks] for r in parts.collect()]
    assert all(s == sorted(s) for s in starts)
    assert d.decontaminate(docs, items, block_chars=60).count() == d.decontaminate(docs, items).count()


def test_nothing_and_clashing_columns(spark, documents):
    items = benchmark(spark, [PROSE[:80]])
    assert d.decontaminate(documents([]), items).count() == 0
    assert d.decontaminate(documents([PROSE]), items.limit(0)).count() == 1
    clashing = documents([PROSE, "ok"]).withColumn("leaks", F.lit(1)).withColumn("body", F.lit(2))
    kept = d.decontaminate(clashing, items)
    assert (kept.columns, [r.doc_id for r in kept.collect()]) == (clashing.columns, [1])


def test_every_copy_of_a_short_item_beside_a_long_one():
    """A long item widens the bands of all; copies of the short one stand next to each other."""
    chance = random.Random(5)
    short, long = ("".join(chance.choices("abcdefghij klmno", k=k)).strip() for k in (50, 4000))
    copies = [short, short[:20] + "#" + short[21:], *[short] * 11]
    text = "".join(copy + " " + str(1000 + k) + " +++++ "[: 60 - len(copy) - 5] for k, copy in enumerate(copies))
    for items in ([short], [short, long]):
        (hits,) = d.Finder(d.Passages.of(range(len(items)), items)).find([text + short + short])
        assert [hit[0] for hit in hits] == [0] * 15
        assert [hit[3] for hit in hits] == [0, 1, *[0] * 13]
        assert all(a[2] <= b[1] for a, b in zip(hits, hits[1:], strict=False))
