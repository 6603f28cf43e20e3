import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """Scratch results of the operators go to a folder of the test run."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture()
def documents(shared):
    """A documents table from (doc_id, text[, lang, source]), with columns that clash with results."""

    def make(rows, clash=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        df = shared.createDataFrame(full, DOCS)
        for c in clash:
            df = df.withColumn(c, F.lit("clash"))
        return df.repartition(3)

    return make
