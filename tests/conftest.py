import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierkit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Rows to a DataFrame by DDL: table("a int, b string", (1, "x"), ...)."""

    def make(schema, *rows):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return make


@pytest.fixture(scope="session")
def rows():
    """The rows of a DataFrame as sorted tuples."""

    def sort_key(row):
        return tuple((v is not None, str(v)) for v in row)

    def read(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=sort_key)

    return read
