import pytest

from conftest import SF_SMALL  # noqa: F401 - shared session fixture and paths

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts or (doc_id, text) pairs."""
    def make(rows, parts=3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en" if (i or 0) % 3 else None, f"src{(i or 0) % 4}" if (i or 0) % 5 else None, None if t is None else len(t))
                for i, t in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(parts)
    return make


#: Nulls, empty, white space only, ties, repeated rows, odd characters, one long text.
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "same words here and there"), (5, "same words here and there"),
       (5, "same words here and there"), (None, "a row without a name"), (6, "SAME words here and there"),
       (7, "Ünïcode wörds \U0001f600 and more é"), (8, "x" * 70_000), (9, "long text " * 30_000), (10, "one")]
