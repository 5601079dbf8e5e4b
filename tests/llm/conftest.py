import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from homespan.session import local_session

    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, and extra columns whose names clash."""
    long_text = " ".join(f"w{i % 977} v{i % 31}" for i in range(40_000))
    rows = [(1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "a"),
            (2, None, None, None), (3, "", "en", "a"), (4, " \n\t ", "de", None), (5, long_text, "en", "b"),
            (6, long_text, "en", "b"), (None, "text without an id, jo@x.example.org", "fr", "a"), (7, "x" * 30_000, None, "b"),
            (8, "Ünï <|endoftext|> cödé\u2003x\x1cy\n\n  z", "fr", "c")]
    rows += [(100 + i, f"plain words number {i} " + " ".join(f"k{(i * 7 + j) % 53}" for j in range(60)), "en", "a")
             for i in range(40)]
    out = [(*r, len(r[1]) if r[1] else None, "x", 1, True, "y") for r in rows]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long, "
                                      "fp string, component_id int, kept boolean, spans string")


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.limit(0)
