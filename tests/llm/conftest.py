import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGE = "page_id bigint, url string, html string"


@pytest.fixture(scope="session")
def write(spark, tmp_path_factory):
    """Write rows as a table in a folder of its own; the folder."""

    def run(name, rows, schema):
        folder = tmp_path_factory.mktemp("data")
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return run


@pytest.fixture(scope="session")
def documents(write):
    """Rows of (doc_id, text) or (doc_id, text, source) as a table of documents."""

    def run(rows):
        full = [(i, t, "en", (*rest, "s")[0], None if t is None else len(t)) for i, t, *rest in rows]
        return write("documents", full, DOCUMENT)

    return run


@pytest.fixture(scope="session")
def pages(write):
    return lambda rows: write("pages", rows, PAGE)
