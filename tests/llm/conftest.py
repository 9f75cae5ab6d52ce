import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (id, text) pairs; extra columns are taken as given by name."""

    def make(pairs, source="s", **extra):
        rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in pairs]
        found = spark.createDataFrame(rows, DOCS)
        for name, value in extra.items():
            from pyspark.sql import functions as F
            found = found.withColumn(name, F.lit(value))
        return found

    return make


@pytest.fixture(scope="session")
def given(spark, folder):
    """(id, text) of the small documents table."""
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]
