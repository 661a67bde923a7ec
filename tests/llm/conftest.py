import pytest

from chronoweave.llm.common import ship

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, spans long, score string"


def awkward(extra=()):
    """Texts with every awkward case: null, empty, blank, one word, copies, long, odd characters."""
    base = "And the reading of that long passage went on for many more words than anyone there would have thought it could. " * 1
    long = " ".join(f"word{i % 977} of{i}" for i in range(12_000))
    shared = "".join(f"shared passage number {i} stands here in full " for i in range(8))
    texts = [None, "", "   ", "one", "ONE", "one two", "\n\n\t", base, base, base.upper(), base.replace("many", "several"),
             long, long + " tail", "x" * 700, "x" * 199, "x" * 200, "日本語 😀 ñandú ▁mark  two　wide", "no\nno\nno\n  \nno",
             "start " + shared + "end", "other " + shared + "close " + shared, "a b c " * 80, "<s> </s> #*$%&|<> 12 34", "123 456", *extra]
    rows = [(i, t, ["en", "fr", None][i % 3], f"src{i % 4}" if i % 5 else None, None if i % 7 == 0 else len(t or ""), "r", "k", 1, "s") for i, t in enumerate(texts)]
    return rows + [rows[7], rows[7], (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def rows():
    import pyarrow.parquet as pq

    return awkward(pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:120])


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The awkward texts and some of the tables', with columns whose names clash with results."""
    ship(spark)
    return spark.createDataFrame(rows, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    ship(spark)
    return spark.createDataFrame([], COLUMNS)
