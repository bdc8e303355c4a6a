import pytest


@pytest.fixture
def documents(spark):
    """A builder of document tables with columns that clash with names used inside."""

    def build(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        return df.selectExpr("*", "'x' AS id", "1 AS size", "2 AS shard", "'y' AS node", "'z' AS row") if extra else df

    return build


def doc(i, text, source="s"):
    return (i, text, "en", source, len(text or ""))
