"""Shared fixtures; the parent folder's session is used."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table with given texts; ids count from 0."""

    def make(texts, lang="en", source="s"):
        rows = [(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def stored(spark, tmp_path):
    """A folder with given tables, as queries read them."""

    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
