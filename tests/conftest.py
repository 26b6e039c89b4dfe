import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from peerbench.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[8]", "peerbench-tests", **{"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def entities(spark):
    """Build entity rows from (file_ord, sheet_ord, row_idx, holding, universe, sub, focus, id)."""

    def build(rows):
        full = [(f"F{r[0]}.xlsx", r[0], f"Key {r[1]}", *r[1:]) for r in rows]
        return spark.createDataFrame(
            full,
            "file string, file_ord int, sheet string, sheet_ord int, row_idx int, holding string, "
            "universe string, sub_industry string, focus string, id string",
        )

    return build
