"""The registered queries of the operators, and their SQL counterparts where SQL can express them.

Each applies its operator to the whole of its table and returns the whole result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm import (
    binary,
    byte_pairs,
    decontamination,
    html,
    language_model,
    lexical_search,
    ngram_join,
    packing,
    quality,
    resharding,
    secrets,
    tokens,
    whitening,
)
from lakeload.llm.storage import new_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle.strip()
        return run

    return register


def given(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


@query()
def op1_token_counts(spark, sf_dir):
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    counted = tokens.with_token_counts(docs, BYTE_BPE)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query()
def op2_decontamination(spark, sf_dir):
    """Each passage of the benchmark that a document holds, and where."""
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    benchmark = given(spark, sf_dir, "benchmark", "item_id", "text")
    marked = decontamination.with_leaks(docs, benchmark)
    # A plain explode makes Spark test first whether there is anything, which finds leaks twice.
    found = marked.select("doc_id", F.explode_outer("leaks").alias("leak")).filter("leak IS NOT NULL")
    return found.select("doc_id", "leak.item_id", "leak.start", "leak.end", "leak.edits")


@query()
def op3_html_text(spark, sf_dir):
    pages = given(spark, sf_dir, "pages", "page_id", "url", "html")
    return html.extract_text(pages).select("page_id", "url", "text", "n_chars")


@query()
def op4_secret_scan(spark, sf_dir):
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    found = F.col("secrets")
    kinds = [rule.kind for rule in secrets.BASE_RULES]
    base = F.filter(found, lambda s: s.kind.isin(kinds))

    def n(kind):
        return F.size(F.filter(found, lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    return secrets.find_secrets(docs).select(
        "doc_id",
        *map(n, kinds),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(found).alias("spans"),
    )


@query()
def op5_token_id_files(spark, sf_dir):
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    path = new_path(spark, "token-ids")
    binary.write_ids(docs, path, BYTE_BPE, end_id=0)
    return binary.read_checksums(spark, path)


@query(
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (
        SELECT doc_id, text,
               list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
               list_filter(string_split(text, chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM d
    ),
    v AS (
        SELECT *, list_transform(range(1, greatest(len(words) - 1, 1)),
                                 lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS wins
        FROM w
    ),
    placed AS (
        SELECT doc_id, unnest(wins) AS win, unnest(range(1, len(wins) + 1)) AS i FROM v
    ),
    again AS (
        SELECT doc_id, i FROM placed QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
    ),
    covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n
        FROM again, (VALUES (0), (1), (2)) t(k) GROUP BY doc_id
    ),
    f AS (
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
               CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
                   AS n_symbols,
               CAST(len(lines) AS BIGINT) AS n_lines,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
        FROM v LEFT JOIN covered USING (doc_id)
    ),
    b AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 2 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
                OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
    FROM b
    """
)
def op6_quality_rules(spark, sf_dir):
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    return quality.with_verdicts(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query()
def op7_min_cost_resharding(spark, sf_dir):
    """All documents from 20 shards of very different sizes, dealt by a hash of the id, to 16 of near
    equal bytes."""
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    old = F.floor(20 * share * share).cast("int").alias("old_shard")
    docs = given(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", "text", old)
    path = new_path(spark, "shards")
    placed = resharding.reshard(docs, path, old_shard="old_shard", shards=16)
    return placed.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


@query()
def op8_best_fit_packing(spark, sf_dir):
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, WORD_BPE, capacity=4096, end_id=1).select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


@query()
def op9_ngram_jaccard(spark, sf_dir):
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    return ngram_join.near_copies(docs, words=5, per_cent=75)


@query()
def op10_class_bigrams(spark, sf_dir):
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return language_model.score(docs, ~held_out)


@query()
def op11_byte_bpe(spark, sf_dir):
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    encoded = byte_pairs.with_bpe_ids(docs, RANKS, public_tokenizers.PATTERN)
    both = byte_pairs.with_bpe_bytes(encoded, RANKS, public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query(
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS num, doc_id,
               regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ),
    filled AS (SELECT num, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM filled),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ),
    placed AS (SELECT num, doc_id, n, unnest(terms) AS term FROM filled),
    held AS (
        SELECT num, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
        FROM placed WHERE term IN (SELECT term FROM asked) GROUP BY num, term
    ),
    weighed AS (
        SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM held, totals GROUP BY term
    ),
    added AS (
        SELECT num, doc_id, term,
               w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))) AS part
        FROM held JOIN weighed USING (term), totals
    ),
    scored AS (
        SELECT item_id, any_value(doc_id) AS doc_id, CAST(sum(part) AS BIGINT) AS score
        FROM asked JOIN added USING (term) GROUP BY item_id, num
    ),
    ranked AS (
        SELECT item_id, doc_id, score,
               row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
        FROM scored WHERE score > 0
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """
)
def op12_ranked_search(spark, sf_dir):
    """The 10 documents that each item of the benchmark scores highest."""
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    items = given(spark, sf_dir, "benchmark", "item_id", "text")
    return lexical_search.search(docs, items, best=10)


@query()
def op13_whitening(spark, sf_dir):
    return whitening.whiten(given(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=4)
