import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, ...) rows, with columns that clash with results."""

    def make(rows, **extra):
        padded = [(*row, *(None,) * (5 - len(row))) for row in rows]
        df = spark.createDataFrame(padded, SCHEMA).repartition(3)
        for name in ("score", "rank", "ranges", "place", "fp", "key", "_0"):
            df = df.withColumn(name, F.lit("clash"))
        return df

    return make


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def small_texts(small_docs):
    return [(r.doc_id, r.text) for r in small_docs.select("doc_id", "text").collect()]
