import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from texts, numbered in order, or from (doc_id, text) pairs."""

    def build(texts, **more):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def awkward(docs_of):
    """Nulls, empty and long texts, ties, repeated rows, and separators of other kinds."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    return docs_of(
        [
            (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (None, "no id at all here"), (None, None),
            (6, long), (7, long), (8, "same text twice over and over"), (8, "same text twice over and over"),
            (9, "nb sp \x1c and \x0b tabs\r\nend"), (10, "É ß 日本語 🙂 ok"), (11, "a" * 100_000),
        ]
    )
