import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture()
def make_docs(spark):
    def make(rows, extra=False):
        """rows of (doc_id, text); extra adds columns whose names the operators use themselves."""
        schema = "doc_id long, text string"
        if extra:
            schema += ", n_words int, text_hash string, spans int, items string, pos int, _kept string, key string"
            rows = [(*r, 1, "x", 2, "y", 3, "z", "k") for r in rows]
        return spark.createDataFrame(rows, schema).repartition(3)

    return make
