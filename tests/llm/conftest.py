import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wizards boil turnips in a copper pot "
    "and nobody in the village minds because the market opens late on stormy winter mornings when "
    "every baker sells warm bread to travellers from the northern valley who arrive with carts of "
    "salted fish and bright woollen blankets for the long cold nights ahead of spring"
)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents of given texts; ids count from 0 unless given."""

    def make(texts, ids=None):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
        if ids is not None:
            rows = [(i, *row[1:]) for i, row in zip(ids, rows, strict=True)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls, empty and blank texts, repeated rows, odd characters, a very long text."""
    long = " ".join(f"word{i % 9001}" for i in range(60_000))
    texts = [None, "", " \n\t ", PROSE, PROSE, "日本語 é́ \x1c\x85 <|endoftext|> end", long, "x", None]
    ids = [None, 1, 2, 3, 3, 5, 6, 7, None]
    return documents(texts, ids).repartition(3)


@pytest.fixture(scope="session")
def texts_of(spark):
    """All rows as (id, text), in the order of ids, nulls first."""

    def read(df):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))

    return read
