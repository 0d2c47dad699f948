import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def write(spark, tmp_path):
    """Writes tables as Parquet below one folder, as the queries read them."""

    def put(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return put


@pytest.fixture
def documents(spark):
    """A documents table of (text, lang, source) or plain texts, numbered from 0."""

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            text, lang, source = row if isinstance(row, tuple) else (row, "en", "src0")
            full.append((i, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENTS)

    return make
