import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DOCS = "doc_id long, text string, lang string, source string"
# Columns named like those that operators use inside.
CLASHING = ["kept", "norm", "h", "w", "size", "target", "spans", "n", "g", "tokens", "pieces_",
            "label", "id", "t", "keep_id", "odds", "value", "copies"]


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from tuples, with clashing extra columns."""
    from pyspark.sql import functions as F

    def build(*rows, clash=True):
        df = spark.createDataFrame([(*r, *[None] * (4 - len(r))) for r in rows], DOCS)
        return df.withColumns({c: F.lit("x") for c in CLASHING}) if clash else df

    return build


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls anywhere, empty and long texts, repeated rows and ids, ties."""
    return docs(
        (1, "The quick brown fox", "en", "a"), (1, "The quick brown fox", "en", "a"),
        (1, "another text of the same id", None, "b"), (None, None, None, None),
        (None, "no id here", "en", None), (2, "", "en", "a"), (3, " \n\t ", "en", "b"),
        (4, "THE QUICK BROWN FOX", "de", "a"), (5, "ÀÉ üß 漢字 😀 x", "fr", None),
        (6, "word " * 30_000, "en", "a"), (7, None, "en", "c"))
