from __future__ import annotations

import pytest

from candlemill.llm.ship import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names operators use themselves.
CLASH = (
    "size int, key string, rep long, kept string, score string, taken long, target string, _id long, _leaks string, "
    "_log_words string, quality_score string, toxic_score string, main_text string, language int, pack string"
)


def sentence(n: int, seed: int = 0) -> str:
    """n different words."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long one, ties and repeated rows."""
    same = sentence(60, 1)
    return [
        (1, same, "en", "a", 1),
        (2, same, "en", "b", 1),
        (2, same, "en", "b", 1),
        (3, None, None, None, None),
        (4, "", "fr", "a", 0),
        (5, " \n\t ", "fr", None, 4),
        (None, sentence(70, 2), "en", "a", 9),
        (None, None, None, None, None),
        (6, sentence(20_000, 3), "de", "b", 7),
        (7, "one two", "xx", "b", 7),
        (8, "one two", "xx", "b", 7),
        (9, "Ünïcode ∑ 漢字 \x00 \x1c end\x85.", "zz", "c", 1),
        (10, "For " * 300, "en", "c", 1),
    ]


@pytest.fixture(scope="session")
def shipped_spark(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(shipped_spark):
    """The odd rows, with clashing columns."""
    names = [c.strip().split()[0] for c in CLASH.split(",")]
    rows = [(*r, *[None] * len(names)) for r in odd_rows()]
    return shipped_spark.createDataFrame(rows, f"{DOCS}, {CLASH}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
