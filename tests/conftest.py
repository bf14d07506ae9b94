import contextlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderloom.session import local_session  # noqa: E402
from orderloom.sources.schemas import RAW, RAW_COLUMNS  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        cores="8",
        shuffle_partitions=4,
        spark__checkpoint__dir=str(base / "shared"),
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__ui__showConsoleProgress="false",
    )
    yield session
    session.stop()


DEFAULTS = {
    "index": "1",
    "Order ID": "o1",
    "Date": "04-30-22",
    "Status": "Shipped",
    "Fulfilment": "Merchant",
    "Sales Channel": "web",
    "ship-service-level": "Standard",
    "Style": "S1",
    "SKU": "k1",
    "Category": "Set",
    "Size": "M",
    "ASIN": "a1",
    "Courier Status": "Shipped",
    "Qty": "1",
    "currency": "INR",
    "Amount": "10.00",
    "ship-city": " mumbai ",
    "ship-state": "Maharashtra",
    "ship-postal-code": "400081.0",
    "ship-country": "IN",
    "promotion-ids": None,
    "B2B": "False",
    "fulfilled-by": None,
    "Unnamed: 22": None,
}


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Builds a raw extract from partial rows; columns not given take a default."""

    def build(*rows):
        filled = [{**DEFAULTS, **row} for row in rows]
        return spark.createDataFrame([[row[c] for c in RAW_COLUMNS] for row in filled], RAW)

    return build
