import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeload.llm import components as graph, ngram_join, shingles
from lakeload.llm.components import components
from lakeload.llm.ngram_join import near_copies, one_of_each
from lakeload.llm.storage import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_sets(texts, size=5):
    for text in texts:
        words = WORD.findall((text or "").translate(LOWER))
        ends = range(len(words) - size + 1) if len(words) >= size else range(bool(words))
        yield {tuple(words[i : i + size]) for i in ends}


def brute(rows):
    """Links of all pairs that share a shingle, and what they connect."""
    sets = list(shingle_sets(text for _, text in rows))
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    held = defaultdict(list)
    for k, one in enumerate(sets):
        shared = Counter(j for s in one for j in held[s])
        for s in one:
            held[s].append(k)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(one) + len(sets[j]) - n):
                parent[root(k)] = root(j)
    groups = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            groups[root(k)].append(i)
    return sorted(
        ((i, len(s), min(groups[root(k)], default=None)) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=repr,
    )


def changed(words, chance, share):
    return [f"new{chance.random()}" if chance.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus():
    """Copies, chains of near copies, shared passages, and a group of a third of all rows."""
    chance = random.Random(11)
    passage = [f"licence{k}" for k in range(30)]
    texts = []
    for n in range(12):
        words = [f"w{chance.randint(0, 4000)}" for _ in range(chance.randint(3, 260))]
        texts.append(words)
        for _ in range(chance.randint(0, 4)):
            words = changed(words, chance, 0.03)
            texts.append(words)
        texts.append(words[: len(words) * 3 // 4])
    for n in range(20):
        texts.append(passage + [f"own{n}_{k}" for k in range(chance.randint(2, 14))])
    hot = [f"hot{k}" for k in range(120)]
    texts += [changed(hot, chance, 0.02) for _ in range(45)] + [hot] * 15
    rows = [" ".join(words) for words in texts] + ["a b", "A  b", "b a", "", None, " \n", "one"]
    ids = list(range(len(rows)))
    chance.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def test_same_as_brute_force(documents, corpus, monkeypatch):
    ids, texts = zip(*corpus, strict=True)
    docs = documents(texts, ids).repartition(4)
    found = sorted(map(tuple, near_copies(docs).collect()), key=repr)
    assert found == brute(corpus)
    # Neither turns nor blocks nor knowledge of frequent shingles change the result.
    monkeypatch.setattr(ngram_join, "TURNS", 0)
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "FREQUENT", 1)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    assert sorted(map(tuple, near_copies(docs).collect()), key=repr) == found


def test_one_of_each(documents, corpus):
    ids, texts = zip(*corpus, strict=True)
    docs = documents([*texts, texts[0]], [*ids, ids[0]])  # one row twice
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    wanted = sorted({i if n == 0 else c for i, n, c in brute(corpus)})
    assert sorted(r.doc_id for r in kept.collect()) == wanted


def test_awkward_rows(awkward, documents):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    clashing = awkward.withColumnRenamed("lang", "node").withColumnRenamed("source", "key")
    found = sorted(map(tuple, near_copies(clashing).collect()), key=repr)
    assert found == brute(rows)
    assert one_of_each(clashing).columns == clashing.columns
    assert sorted((r.doc_id or -1) for r in one_of_each(clashing).collect()) == [-1, -1, 1, 2, 3, 5, 6, 7]
    assert near_copies(documents([])).count() == 0
    assert one_of_each(documents([])).count() == 0


def test_bitmaps_bound_the_overlap():
    chance = np.random.default_rng(1)
    for _ in range(300):
        pool = chance.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (np.unique(chance.choice(pool, chance.integers(1, 300))) for _ in range(2))
        one, two = (ngram_join.bitmap(s)[None, :] for s in (a, b))
        width = min(one.shape[1], two.shape[1])
        differ = ngram_join.folded(one, width) ^ ngram_join.folded(two, width)
        bound = (len(a) + len(b) - int(np.bitwise_count(differ).sum())) // 2
        assert bound >= len(np.intersect1d(a, b))


def test_word_hashes_do_not_depend_on_the_slices(monkeypatch):
    texts = ["One two\tTWO", None, "", "éé é", "x" * 50, "a b " * 40]
    whole = [words.tolist() for words in shingles.word_hashes(texts)]
    assert whole[0][1] == whole[0][2] != whole[0][0]
    monkeypatch.setattr(shingles, "SLICE_BYTES", 16)
    assert [words.tolist() for words in shingles.word_hashes(texts)] == whole


def test_components_of_paths_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(200, k) for k in range(201, 240)]
    links += [(k, 300 + (k - 299) % 20) for k in range(300, 320)] + [(7, 7), (9, 8), (8, 9)]
    df = spark.createDataFrame(links, "x bigint, y bigint")
    found = {r.node: r.root for r in components(df).collect()}
    wanted = {k: 100 for k in range(100, 161)} | {k: 200 for k in range(200, 240)}
    wanted |= {k: 300 for k in range(300, 320)} | {8: 8, 9: 8}
    assert found == wanted
    assert components(df.filter(F.lit(False))).count() == 0


def some_links(seed=3):
    """Links of paths, stars and pairs, and the smallest node that each of their nodes reaches."""
    chance = random.Random(seed)
    names = [chance.randrange(-(1 << 62), 1 << 62) for _ in range(600)]
    links, wanted = [], {}
    for group in (names[:200], names[200:400], *(names[k : k + 2] for k in range(400, 600, 2))):
        ends = group if group[0] == names[0] else [group[0]] * len(group)
        links += [chance.choice([(a, b), (b, a)]) for a, b in zip(ends, group[1:], strict=False)]
        wanted |= dict.fromkeys(group, min(group))
    chance.shuffle(links)
    return links + links[:50], wanted


@pytest.mark.parametrize("held", [1, 8, 1 << 17])
def test_components_do_not_depend_on_what_a_task_holds(spark, monkeypatch, held):
    monkeypatch.setattr(graph, "LINKS_A_TASK", held)
    links, wanted = some_links()
    df = spark.createDataFrame(links, "x bigint, y bigint").repartition(3)
    rows = components(df).collect()
    assert len(rows) == len(wanted) and {r.node: r.root for r in rows} == wanted


def test_components_of_few_links_take_no_rounds(spark, monkeypatch):
    """However long their paths are."""
    tables = []
    monkeypatch.setattr(graph, "stored", lambda df, name: tables.append(name) or stored(df, name))
    df = spark.createDataFrame([(k, k + 1) for k in range(5000)], "x bigint, y bigint").repartition(5)
    assert {r.root for r in components(df).collect()} == {0}
    assert len(tables) == 2
