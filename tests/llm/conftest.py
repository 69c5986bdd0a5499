import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with a column whose name clashes."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        from pyspark.sql import functions as F

        return spark.createDataFrame(full, DOCUMENTS).withColumns({"text_key": F.lit(1), "bucket": F.lit("x"), "label": F.lit(0)})

    return make
