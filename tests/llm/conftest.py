import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows, extra=None):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) + tuple(extra or ())
            for r in rows
        ]
        schema = DOCS + "".join(f", x{i} string" for i in range(len(extra or ())))
        return spark.createDataFrame(full, schema)

    return make


ODD_ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (None, "no id at all"), (None, None),
    (5, "a b c d e f"), (6, "ünï cödé \U0001f600 text"), (7, "word " * 3000),
]


@pytest.fixture()
def odd_rows():
    return ODD_ROWS
