import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.session import local_session  # noqa: E402
from mercato.sources.schema import SCHEMAS  # noqa: E402
from mercato.sources.tables import Tables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="mercato-tests")
    yield s


def ts(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S" if " " in text else "%Y-%m-%d")


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


@pytest.fixture(scope="session")
def make_tables(spark):
    """Build a ``Tables`` from lists of tuples in declared-schema column order.

    Tables not given are empty (with their schema); pass ``absent=[...]`` to
    leave tables out entirely.
    """

    def build(absent=(), **rows):
        frames = {}
        for name, schema in SCHEMAS.items():
            if name in absent:
                continue
            frames[name] = spark.createDataFrame(rows.get(name, []), schema)
        return Tables(frames)

    return build
