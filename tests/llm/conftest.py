import pytest

ODD_TEXTS = [None, "", " \t\n", "a", "A b", "a b c", "A B C", "x" * 5000, "\x00 \x85 é ß \U0001f600 e\u0301", "a b c " * 4000]


@pytest.fixture(scope="session")
def docs_of(spark):
    """DataFrame of documents from texts, or from (id, text) pairs, with extra columns whose names clash with results."""

    def build(rows, partitions=3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans int, score int, uid string"
        data = [(i, t, "en", None if i is None else f"s{i % 3}", None if t is None else len(t), "k", 1, None, "u") for i, t in rows]
        return spark.createDataFrame(data, schema).repartition(partitions)

    return build


__all__ = ["ODD_TEXTS"]
