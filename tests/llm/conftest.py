import pytest

SMALL = "/root/testdata/sf0.001"
LONG = ("Alpha beta, gamma delta! " * 30000) + "x" * 5000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names an operator may use itself."""
    texts = [
        None, "", "   \n\t", "one", "One  two\tthree\n\nfour", LONG, LONG, "a b c d e f g h " * 9, "née Ünïcode 日本語 🙂  x y",
        "line one here\nline one here\n\n \nline two", "password=hunter2secret token: abc", "a\x1cb c\x85d e　f",
        "word " * 40 + "# # $ | <>", "".join(chr(97 + i % 26) for i in range(300)) + " tail \U0001fae8",
    ]
    rows = [(i, t, "en" if i % 2 else None, ["s1", "s2", None][i % 3], i, "w", 1.5, "k") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "no id here at all", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, words string, fp double, kept string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("false")
