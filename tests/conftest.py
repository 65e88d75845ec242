import sys
from contextlib import ExitStack
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from salescope.session import local_session, settings  # noqa: E402

SALES_SCHEMA = """CalendarYear bigint, YearMonthNumber int, Revenue decimal(18,2), Profit decimal(18,2),
    UnitsSold bigint, SalesOrderNumber string, CustomerKey string, ProductCategory string"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "6g", "tests")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set runtime settings for one test."""
    with ExitStack() as stack:
        yield lambda **values: stack.enter_context(
            settings(spark, {key.replace("__", "."): value for key, value in values.items()})
        )


@pytest.fixture
def make_sales(spark):
    """Sales lines from (year, month, revenue, profit, units, order, customer, category) tuples."""
    from decimal import Decimal

    def build(*rows):
        def money(x):
            return None if x is None else Decimal(str(x))

        data = [(y, m, money(r), money(p), u, o, c, k) for y, m, r, p, u, o, c, k in rows]
        return spark.createDataFrame(data, SALES_SCHEMA)

    return build


def full_year(year, revenue, category="Bikes", tag=""):
    """Twelve lines, one order per month, customers C1 to C12."""
    return [
        (year, year * 100 + m, round(revenue / 12, 2), round(revenue / 24, 2), 1, f"SO{tag}{year}_{m}", f"C{m}", category)
        for m in range(1, 13)
    ]
