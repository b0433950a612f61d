import pytest

from skygrid.llm.common import prepare
from tests.compare import session

LONG = "lorem ipsum dolor sit amet " * 12_000
# Nulls in any column, empty, blank and very long texts, ties and repeated rows, and clashing names.
ODD = [
    (1, "one two three four five six seven", "en", "a"), (2, None, None, None), (3, "", "en", None), (4, " \t\n", None, "a"),
    (5, "one two three four five six seven", "en", "b"), (5, "one two three four five six seven", "en", "b"), (None, "no number here at all", "en", "a"),
    (None, None, None, None), (6, "two words", "de", "b"), (7, LONG, "en", "a"), (8, LONG + "tail", "en", "c"), (9, "ñandú ✓ 𝕏 été", "es", "c"),
    (10, "two  words", "de", "b"), (11, "ONE two three four five six seven", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def llm():
    return prepare(session())


@pytest.fixture(scope="session")
def odd(llm):
    """With columns that bear names the operators use inside."""
    return llm.createDataFrame(
        [(*r, len(r[1] or ""), 7, "x", 1.5, [1]) for r in ODD],
        SCHEMA + ", n_chars long, size int, kept string, score double, row array<int>, sig int, n int".replace(", sig int, n int", "")).cache()


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], SCHEMA + ", n_chars long")
