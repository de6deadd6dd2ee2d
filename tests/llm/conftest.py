import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, row string, taken long"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with awkward values and columns whose names clash with those that operators use."""

    def make(texts, ids=None, sources=None, langs=None):
        n = len(texts)
        ids, sources, langs = ids or range(n), sources or ["s"] * n, langs or ["en"] * n
        rows = [(i, t, g, s, None if t is None else len(t), "f", "r", 7) for i, t, g, s in zip(ids, texts, langs, sources)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def sf_dir(tmp_path_factory):
    """A writer of tables into a folder like the given ones."""

    def write(**tables):
        base = tmp_path_factory.mktemp("sf")
        for name, frame in tables.items():
            frame.write.parquet(f"{base}/{name}.parquet")
        return str(base)

    return write
