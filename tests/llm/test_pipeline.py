"""The pipeline against a plain version of all its stages, on documents that need each of them."""

import random

import numpy as np
import pytest

import corpus_pipeline
from lakeload.llm.queries import WORD_BPE

from .conftest import DOCS
from .test_ngram_join import brute, changed
from .test_quality import figures
from .test_secrets import base
from .test_tokens import ids_of


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    chance = random.Random(21)
    passage = [f"question{k}" for k in range(25)]
    texts = []
    for n in range(25):
        words = [f"plain{chance.randint(0, 900)}" for _ in range(chance.randint(60, 200))]
        texts.append(" ".join(words))
        if n % 3 == 0:
            texts += [" ".join(changed(words, chance, 0.01)), " ".join(words)]
        if n % 5 == 0:
            texts.append(" ".join([*words[40:], *passage, *words[:40]]))
        if n % 4 == 0:
            texts.append(" ".join(words[::-1]) + "\ntoken = 0123456789abcdef0123456789ab é AKIA" + "Q" * 20)
    texts += [None, "", "too short", "again and " * 60, "### $$$ " * 60, " ".join(f"big{k}" for k in range(9000))]
    folder = tmp_path_factory.mktemp("sf")
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    items = [(0, " ".join(passage)), (1, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts, " ".join(passage)


def plain(texts, passage):
    docs = list(enumerate(texts))

    def good(text):
        f = figures(text)
        n = f["n_words"]
        return not (
            n < 50
            or 2 * f["n_repeat_words"] > n
            or 2 * f["n_symbols"] > n
            or 100 * f["n_dup_lines"] > 30 * f["n_lines"]
            or not 2 * n <= f["word_chars"] <= 15 * n
        )

    docs = [(i, t) for i, t in docs if good(t)]
    first = {i for i, _, least in brute(docs) if i == least}
    docs = [(i, t) for i, t in docs if i in first]
    docs = [(i, t) for i, t in docs if passage not in t]
    for k, (i, text) in enumerate(docs):
        parts, done = [], 0
        for start, kind, end in base(text):
            if start >= done:
                parts += [text[done:start], f"<{kind}>"]
            done = max(done, end)
        docs[k] = (i, "".join(parts) + text[done:])
    return docs


def test_run(spark, sf_dir):
    path, texts, passage = sf_dir
    rows = corpus_pipeline.run(spark, path).collect()
    wanted = []
    for i, text in plain(texts, passage):
        ids = [*ids_of(WORD_BPE, text), 1]
        wanted += [(i, k, s, ids[s : s + 4096]) for k, s in enumerate(range(0, len(ids), 4096))]
    found = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows]
    assert sorted(found) == sorted(wanted)
    assert any(r.piece == 1 for r in rows)


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir[0]}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "near_duplicates",
        "benchmark_decontamination",
        "secret_scan",
        "best_fit_packing",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir[0])
        assert out.columns == docs.columns
        assert out.schema.simpleString() == docs.schema.simpleString()
    redacted = corpus_pipeline.secret_scan(spark, docs, sf_dir[0])
    assert redacted.filter("n_chars <> length(text)").count() == 0
    assert redacted.count() == docs.count()


def test_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
