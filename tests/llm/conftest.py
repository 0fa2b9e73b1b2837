import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns that clash with names operators give or use.
CLASH = "shard int, SLOT string, score string, lang_pred string, removed string, n_words string, id string, fingerprint string, text_hash string"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang])."""

    def make(*rows, lang="en"):
        full = [(r[0], r[1], r[2] if len(r) > 2 else lang, "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def clashing(spark):
    """The same table with extra columns of clashing names."""
    from pyspark.sql import functions as F

    def make(df):
        for field in CLASH.split(", "):
            name, kind = field.split()
            df = df.withColumn(name, F.lit(None).cast(kind))
        return df

    return make


@pytest.fixture
def write_table(tmp_path):
    """Write tables as a folder of Parquet tables, as queries read them."""

    def make(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
