"""Token counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.encoding import encoder


def token_count(text: Column, tokenizer: str) -> Column:
    """How many tokens a text has, as a long; a null text has none.

    ``tokenizer`` is the path of a tokenizers file that every executor has. No begin, end or other
    special token is added; special strings inside a text are treated as the file says. Only the
    counts go back to Spark. Texts are encoded whole, see :mod:`lakeload.llm.encoding` for how they
    are batched and split.
    """

    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(tokenizer)
        for texts in batches:
            strings = (value.as_py() for value in texts)
            yield pa.array(encode.count(strings), type=pa.int64(), size=len(texts))

    return F.arrow_udf(counts, "bigint")(text)


def with_token_counts(
    docs: DataFrame, tokenizer: str, *, text: str = "text", limit: int = 512
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Rows and their order within a partition stay as they are, repeated ones too; an empty table
    gives an empty result. Columns of these names are replaced.
    """
    counted = docs.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint"),
            "n_tokens": token_count(F.col(text), tokenizer),
        }
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
