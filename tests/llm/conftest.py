import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.session import share_code

#: Names that operators use inside or return, as columns a table may already have.
CLASHING = ("score", "predicted", "shard", "slot", "size", "key", "m", "label", "path", "rng", "pos", "target", "taken", "y", "n")


@pytest.fixture(scope="session", autouse=True)
def workers_find_code(spark):
    share_code(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text[, source]) rows as a table shaped like ``documents``, with columns of clashing names."""

    def make(rows):
        rows = [(*r, *("src0",) * (3 - len(r))) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        df = df.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
        return df.withColumns({c: F.lit(c) for c in CLASHING})

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in any column, empty and very long texts, repeated rows, ties, an id with two texts."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000))
    return make_docs([(1, None), (2, ""), (2, ""), (3, "one two"), (3, "one two"), (None, "no id at all here"), (4, long, None),
                      (5, "same text for two of them"), (6, "same text for two of them"), (7, "   \n\t "), (8, "é" * 50, ""),
                      (9, "first"), (9, "second"), (10, None, None)])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def read(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "quality", "toxic")]))
