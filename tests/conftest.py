import datetime
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tablepull.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def types_table(spark):
    """One column per base type, four rows."""
    rows = [
        ("alpha", 7, Decimal("5.100"), False, datetime.date(2020, 2, 28)),
        ("beta", -3, Decimal("0.001"), True, datetime.date(2020, 2, 29)),
        ("gamma", 0, Decimal("-12.500"), False, datetime.date(2020, 3, 1)),
        ("delta", 41, Decimal("99.999"), True, datetime.date(1999, 12, 31)),
    ]
    return spark.createDataFrame(
        rows, "character string, integer int, `decimal` decimal(5,3), `boolean` boolean, `date` date"
    )


@pytest.fixture(scope="session")
def increments(spark):
    """Six rows with awkward names and a five-way tie in the last column."""
    base = datetime.datetime(2021, 1, 5, 13, 43, 17)
    rows = [
        (i, f"name-{i}", i, Decimal(f"{i}.{i}0"), "t", base if i < 6 else base + datetime.timedelta(seconds=10))
        for i in range(1, 7)
    ]
    return spark.createDataFrame(
        rows,
        "`_Weir%d I-D` int, `Weir%d Na-me` string, someInteger int, someDecimal decimal(10,2), "
        "type string, datetime timestamp_ntz",
    )


@pytest.fixture(scope="session")
def escaping(spark):
    rows = [
        ("plain words", "more of them"),
        ('quotes "" inside, and a comma', 'ends in quotes ""'),
        ("two\nlines", "a \t tab"),
        ("one \\ backslash", 'backslash and quote \\""'),
        ("ends in a backslash \\", "  blanks around  "),
        ("ľščťžýáíéúäôň", "\U0001f600\U0001f680"),
        ("carriage\r\nreturn", "old\rmac"),
        (None, ""),
        ("", None),
    ]
    return spark.createDataFrame(rows, "col1 string, col2 string")
