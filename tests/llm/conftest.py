import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from texts import prose  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, doc string, row string, n string, label string, lang string, source string"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def make_docs(spark):
    """A documents table with more columns, some named like the operators' own."""
    def make(rows, parts=3):
        more = [(i, t, "x", None, "y", "z", "en", "src") for i, t in rows]
        return spark.createDataFrame(more, DOCS).repartition(parts, "doc_id", "text")
    return make


@pytest.fixture()
def edge_texts():
    """Nulls, empty and blank texts, one word, repeats, a long text, non-ASCII, odd white space."""
    rng = random.Random(5)
    base = prose(rng, 300, 5000)
    return [None, "", " \n\t ", "One", "one", "ONE", base, base, base.upper(), base + " tail",
            prose(rng, 30_000, 50_000), "Ünï ßtraße ñandú " * 40, "a\x0bb\x0cc  d \r\n e",
            "x" * 3000, "naïve café end", "<|endoftext|> and <|startoftext|>"]
