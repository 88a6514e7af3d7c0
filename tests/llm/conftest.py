import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small fixtures: two tasks a stage are enough to cross partitions."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    yield
    spark.conf.set(name, before)


@pytest.fixture()
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows, with columns
    whose names clash with those the operators make."""
    from pyspark.sql import functions as F

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", 0) for r in rows]
        df = spark.createDataFrame(full, DOCUMENT).repartition(parts)
        for name in ("size", "score", "row", "cid", "digest", "_key", "node", "_doc", "component"):
            df = df.withColumn(name, F.lit("x"))
        return df
    return make


@pytest.fixture()
def folder(spark, scratch):
    """A folder of tables from named frames."""
    def make(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{scratch}/{name}.parquet")
        return scratch
    return make
