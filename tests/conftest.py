import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from newsroster.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests", spark__sql__shuffle__partitions="4",
                            spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def mentions(spark):
    """Build a mention table of dicts; missing columns are null."""
    columns = ["ord", "Person", "Title", "Date", "Source", "Link", "Title text"]

    def build(*rows, columns=columns):
        data = [tuple(row.get(c, n if c == "ord" else None) for c in columns)
                for n, row in enumerate(rows)]
        schema = ", ".join(f"`{c}` {'long' if c == 'ord' else 'string'}" for c in columns)
        return spark.createDataFrame(data, schema)

    return build
