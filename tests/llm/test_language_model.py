import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeload.llm import language_model as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    return [*WORD.findall((text or "").translate(lower)), None]


def likelihood(bigrams, label):
    n = max(label) + 1
    counts = np.zeros((n, n))
    np.add.at(counts, (label[:, None], label[None, :]), bigrams)
    rows, columns = counts.sum(axis=1), counts.sum(axis=0)
    return lm._xlogx(counts).sum() - lm._xlogx(rows).sum() - lm._xlogx(columns).sum()


def test_gains_are_differences_of_the_likelihood():
    chance = np.random.default_rng(2)
    bigrams = chance.integers(0, 30, (9, 9)).astype(float)
    for word in range(7):
        label = np.concatenate([chance.integers(0, 3, 7), [3, 4]])
        counts = np.zeros((5, 5))
        others = [k for k in range(9) if k != word]
        np.add.at(counts, (label[others][:, None], label[others][None, :]), bigrams[np.ix_(others, others)])
        after = np.bincount(label[others], weights=bigrams[word, others], minlength=5)
        before = np.bincount(label[others], weights=bigrams[others, word], minlength=5)
        cells = np.flatnonzero(np.concatenate([after, before]))
        amounts = np.concatenate([after, before])[cells]
        table = lm.Steps(counts, 3)
        (gains,) = table.gains(np.array([len(cells)]), cells, amounts, bigrams[word, word])
        whole = []
        for k in range(3):
            label[word] = k
            whole.append(likelihood(bigrams, label))
        assert np.allclose(gains - gains[0], np.array(whole) - whole[0])


def test_gains_of_many_words_and_after_moves():
    """Sparse neighbours of several words at once, in a table that words have left and joined."""
    chance = np.random.default_rng(5)
    table = lm.Steps(chance.integers(0, 9, (7, 7)).astype(float), 5)
    for _ in range(6):
        after, before = (chance.integers(0, 3, 7).astype(float) for _ in range(2))
        table.add(int(chance.integers(5)), after, before, float(chance.integers(3)))
    fresh = lm.Steps(table.counts.copy(), 5)
    sizes = np.array([1, 3, 14, 2])
    cells = np.concatenate([np.sort(chance.choice(14, n, replace=False)) for n in sizes])
    amounts = chance.integers(1, 9, len(cells)).astype(float)
    found = table.gains(sizes, cells, amounts)
    assert np.allclose(found, fresh.gains(sizes, cells, amounts))
    for word, end in enumerate(np.cumsum(sizes)):
        own = slice(end - sizes[word], end)
        sides = np.bincount(cells[own], weights=amounts[own], minlength=14)

        def whole(k):
            counts = table.counts.copy()
            counts[k] += sides[:7]
            counts[:, k] += sides[7:]
            # The rows and columns of classes are what the likelihood is made of.
            return sum(lm._xlogx(c).sum() for c in (counts,)) - sum(
                lm._xlogx(counts.sum(axis=axis)).sum() for axis in (0, 1)
            )

        wanted = np.array([whole(k) for k in range(5)])
        assert np.allclose(found[word] - found[word][0], wanted - wanted[0])


def test_exchange_finds_words_that_behave_alike():
    """Words 0 to 3 and 4 to 7 take turns."""
    chance = random.Random(1)
    bigrams = np.zeros((10, 10))
    for _ in range(4000):
        a, b = chance.randrange(4), 4 + chance.randrange(4)
        bigrams[a, b] += 1
        bigrams[b, chance.randrange(4)] += 1
    classes = lm.exchange_classes(bigrams, 8, classes=2)
    assert len(set(classes[:4])) == len(set(classes[4:])) == 1
    assert classes[0] != classes[4]


@pytest.fixture(scope="module")
def scored(documents):
    chance = random.Random(3)
    nouns, verbs = [[f"{k}{n}" for n in range(60)] for k in ("Noun", "verb")]
    texts = [
        " ".join(w for _ in range(chance.randint(1, 40)) for w in (chance.choice(nouns), chance.choice(verbs)))
        for _ in range(300)
    ]
    texts += [None, "", "never seen words", "\n\t "]
    docs = documents(texts)
    return texts, lm.score(docs, F.col("doc_id") % 4 != 1).collect()


def test_base_scores(scored):
    texts, rows = scored
    counts = Counter(t for i, text in enumerate(texts) if i % 4 != 1 for t in tokens(text))
    total, types = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for row in rows:
        own = tokens(texts[row.doc_id])
        assert row.held_out == (row.doc_id % 4 == 1)
        assert (row.n_tokens, row.train_tokens) == (len(own), total)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        base = sum(math.log10((counts[t] + 1) / (total + types + 1)) for t in own)
        assert row.base_score == pytest.approx(base)


def test_classes_help_on_held_out_texts(scored):
    _, rows = scored
    held = [r for r in rows if r.held_out and r.n_tokens > 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in rows)
    assert all(r.score < 0 for r in rows)


def test_scores_are_those_of_the_class_model(documents, monkeypatch):
    """Every score worked out again, token by token, from the classes of the words."""
    monkeypatch.setattr(lm, "CORE_WORDS", 40)
    monkeypatch.setattr(lm, "CORE_CLASSES", 4)
    monkeypatch.setattr(lm, "class_number", lambda words: 4)
    monkeypatch.setattr(lm, "_WORDS_AT_ONCE", 7)
    monkeypatch.setattr(lm, "_CELLS_AT_ONCE", 30)
    monkeypatch.setattr(lm, "_COUNTED_WORDS", 500)
    monkeypatch.setattr(lm, "_BUCKET_BYTES", 1000)
    chance = random.Random(8)
    texts = [
        " ".join(f"w{int(300 * chance.random() ** 3)}" for _ in range(chance.randint(0, 60)))
        for _ in range(250)
    ]
    texts += [texts[3]] * 100 + [None, "new words only", "w1 " * 3000]
    docs = documents(texts, [k % 300 for k in range(len(texts))])
    rows = lm.score(docs, F.col("doc_id") % 4 != 1).collect()
    assert len(rows) == len(texts)

    given = docs.selectExpr("coalesce(text, '') AS body", "doc_id % 4 != 1 AS train")
    counts = lm._word_counts(given)
    v, labelled = lm._vocabulary(given, counts, counts.filter("word IS NOT NULL"))
    by_hash = {r.word: (r.n, r["class"]) for r in labelled.collect()}
    known = {
        w: by_hash.get(int(next(lm.word_hashes([w]))[0].view(np.int64)), (0, v.clustered))
        for text in texts
        for w in tokens(text)[:-1]
    }
    known[None] = (v.ends, v.end)
    paths = {k: [known[w][1] for w in tokens(text)] for k, text in enumerate(texts)}
    steps = Counter()
    start = v.classes - 1
    for k, path in paths.items():
        if (k % 300) % 4 != 1:
            steps.update(zip([start, *path], path, strict=False))
    left = Counter()
    for (a, _), n in steps.items():
        left[a] += n
    train = Counter(t for k, t_ in enumerate(texts) if (k % 300) % 4 != 1 for t in tokens(t_))
    members = {}
    for w in train:
        members.setdefault(known[w][1], []).append(w)

    def emission(w):
        n, c = known[w]
        if c == v.clustered:
            return 1 / (2 * max(1, len(members.get(c, []))))
        return max(n, 1) / max(1, sum(train[m] for m in members[c]))

    def plain(text):
        own = tokens(text)
        path = [start, *(known[w][1] for w in own)]
        total = 0.0
        for w, a, b in zip(own, path, path[1:], strict=False):
            step = (steps[a, b] + lm.SMOOTHING) / (left[a] + lm.SMOOTHING * v.classes)
            total += math.log10(step) + math.log10(emission(w))
        return total

    wanted = sorted((k % 300, round(plain(text), 6)) for k, text in enumerate(texts))
    assert sorted((r.doc_id, round(r.score, 6)) for r in rows) == wanted


def test_awkward_rows(awkward, documents):
    docs = awkward.withColumnRenamed("lang", "train").withColumnRenamed("source", "bucket")
    rows = lm.score(docs, F.col("doc_id") != 3).collect()
    assert len(rows) == awkward.count()
    assert sum(r.held_out for r in rows) == 2
    assert lm.score(documents([]), F.lit(True)).count() == 0
    untrained = lm.score(documents(["a b"]), F.lit(False)).first()
    assert (untrained.n_known, untrained.train_tokens, untrained.base_score) == (0, 0, 0.0)


def test_words_outside_the_core_are_clustered_by_their_neighbours(documents, monkeypatch):
    """Nouns and verbs take turns; all but the few of the core are told apart by that alone."""
    monkeypatch.setattr(lm, "CORE_WORDS", 8)
    monkeypatch.setattr(lm, "CORE_CLASSES", 2)
    monkeypatch.setattr(lm, "class_number", lambda words: 2 if words < 1000 else 4)
    chance = random.Random(4)
    nouns, verbs = [[f"{k}{n}" for n in range(100)] for k in ("noun", "verb")]
    texts = []
    for _ in range(400):
        pick = [chance.choice(w[:4] if chance.random() < 0.5 else w) for w in [nouns, verbs] * 20]
        texts.append(" ".join(pick))
    rows = documents([*texts, "noun7 seldom"]).selectExpr("text AS body", "true AS train")
    counts = lm._word_counts(rows)
    vocabulary, words = lm._vocabulary(rows, counts, counts.filter("word IS NOT NULL"))
    hashed = {w: int(h[0].view(np.int64)) for w in [*nouns, *verbs, "seldom"] for h in lm.word_hashes([w])}
    found = {r.word: r["class"] for r in words.collect()}
    kinds = [{found[hashed[w]] for w in kind} for kind in (nouns, verbs)]
    assert len(kinds[0]) == len(kinds[1]) == 1 and kinds[0] != kinds[1]
    assert found[hashed["seldom"]] == vocabulary.clustered
    assert sum(vocabulary.class_tokens) == vocabulary.tokens


def test_classes_grow_with_the_words():
    assert [lm.class_number(n) for n in (0, 1000, 125_000, 1_000_000)] == [32, 32, 100, 200]
