import pytest

#: Texts every operator has to cope with.
EDGE_TEXTS = [None, "", " \t\n", "one", "word " * 30_000, "Ünïcödé 文字 слово", "\x00\x1f|<>&"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, repeated rows, very long text, columns with names of results."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src0", 7) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "no id here", "en", "src1", 7), (2, None, None, None, None), *[(90, "again and again", "en", "src1", 1)] * 2]
    # ``kept``, ``shard`` and ``n_words`` are results of operators.
    return spark.createDataFrame(
        [(*r, "k", "s", "w") for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, kept string, shard string, n_words string",
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
