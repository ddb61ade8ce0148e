"""Intermediate tables, and what Python workers hold while they are made."""

import pyarrow as pa
from pyspark.sql import functions as F

from lakeload.llm import encoding
from lakeload.llm.ngram_join import BATCH_BYTES, _sets, stored
from lakeload.llm.queries import WORD_BPE


def test_batches_of_the_join_are_bounded_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["bytes"])

    rows = spark.range(6000, numPartitions=1).select(F.repeat(F.lit("some words "), 300).alias("body"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    seen = stored(rows.mapInArrow(sizes, "bytes bigint"), "sizes")
    assert seen.agg(F.max("bytes")).first()[0] < 1.1 * BATCH_BYTES
    assert seen.agg(F.sum("bytes")).first()[0] > 6000 * 3300
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def test_join_frees_the_encoder_of_an_earlier_stage():
    encoding.encoder(WORD_BPE)
    next(_sets(iter([pa.RecordBatch.from_pydict({"body": ["a b"]})]), 5))
    assert not encoding.encoder.cache_info().currsize
