import pytest

from tallyhour.llm.common import ship


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text, lang) rows, with columns whose names clash with results."""
    ship(spark)

    def make(rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        data = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        if extra:
            schema += ", score string, fp string, u string, n string, held_out string, items string"
            data = [(*d, "x", "x", "x", "x", "x", "x") for d in data]
        return spark.createDataFrame(data, schema)
    return make


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
