import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cotejo.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session("tests", "8", 4, **{"spark.sql.warehouse.dir": warehouse})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """Frame from tuples, with ``_row_no`` in the given order unless the schema names it."""

    def build(schema: str, *data):
        if "_row_no" in schema:
            return spark.createDataFrame(list(data), schema)
        return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], f"{schema}, _row_no bigint")

    return build


def plan_of(df) -> str:
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
