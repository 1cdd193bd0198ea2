import pytest


@pytest.fixture(scope="session")
def table(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows, with all its columns."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return build


@pytest.fixture(scope="session")
def folder(table, tmp_path_factory):
    """A folder with documents.parquet, and labels.parquet where labels are given, as the queries read them."""

    def build(rows, labels=None):
        path = tmp_path_factory.mktemp("tables")
        df = table(rows)
        df.repartition(3).write.parquet(str(path / "documents.parquet"))
        if labels is not None:
            df.sparkSession.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
        return str(path)

    return build
