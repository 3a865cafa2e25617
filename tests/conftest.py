import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hearthline import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "3",
            # Tiny inputs: compiling fast matters more than running fast.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1 -XX:+UseSerialGC",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples; NULLs sort first."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        found = [tuple(r) for r in chosen.collect()]
        return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])

    return collect


def plan_of(df) -> str:
    """The physical plan as text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
