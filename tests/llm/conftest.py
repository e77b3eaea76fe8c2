import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
LONG = "word " * 40_000 + "end"

# columns that operators use inside, next to the documents' own
CLASHING = "content digest salt key words rank cell _id row _own_digest _words _text n size".split()


@pytest.fixture(scope="session")
def shipped(spark):
    from tidepanel.llm.common import let_workers_import
    let_workers_import(spark)
    return spark


@pytest.fixture(scope="session")
def vocabulary():
    from tidepanel.llm.queries import vocabulary
    return vocabulary()


@pytest.fixture(scope="session")
def small_docs(shipped):
    return shipped.read.parquet(f"{SMALL}/documents.parquet")


def frame(spark, rows):
    """(doc_id, text) rows with the other columns of documents and clashing ones."""
    extra = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(
        [(i, t, "en", None, len(t) if t else None, *["x"] * len(CLASHING)) for i, t in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "A few words, and more of them here."),
    (5, "A few  words,\nand more\tof them here."), (6, LONG), (7, LONG), (8, "ñandú – ünï 😀 \x00 x"),
    (9, "A few words, and more of them here."), (9, "A few words, and more of them here."),
    (10, "<|endoftext|> is a string"), (None, "no id"), (11, "!!! ... ,,, --- ,.,. \xa0 y  \n\n z"),
]


@pytest.fixture(scope="session")
def awkward(shipped):
    return frame(shipped, AWKWARD)


@pytest.fixture(scope="session")
def nothing(shipped):
    return frame(shipped, [])
