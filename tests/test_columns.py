"""Column functions against stated values and against an independent engine."""

import datetime as dt
import math
import random
import re
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from orderloom.functions import numbers, parse, text
from orderloom.functions.keys import surrogate_key


def apply(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = rows.select("i", function("v").alias("out")).orderBy("i").collect()
    return [r["out"] for r in found]


@pytest.mark.parametrize(
    "function, cases",
    [
        (
            parse.parse_int,
            {
                "3.7": 4, "2.5": 3, "-2.5": -3, "1e2": 100, " 3 ": 3, "": None, "1d": None, "2147483648": None,
                "NaN": None, "1_000": 1000, "25e-1": 3, "0.49999999999999999999": 0, "\xa03": None, "٣": None,
                "2147483647.4": 2147483647, "2147483647.5": None, "1 2": None, "5.": 5, ".5": 1, ".": None, "-": None,
            },
        ),
        (
            parse.parse_money,
            {
                "12.345": Decimal("12.35"), "12.344": Decimal("12.34"), "-1.005": Decimal("-1.01"),
                " 7 ": Decimal("7.00"), "123456789.1": None, "99999999.995": None, "1e8": None, "x": None,
            },
        ),
        (parse.parse_double, {"1.5": 1.5, "1d": None, "inf": math.inf, "-Infinity": -math.inf, "0x10": None, "1e400": math.inf}),
        (
            parse.parse_mdy,
            {
                "04-30-22": dt.date(2022, 4, 30), "4-3-22": dt.date(2022, 4, 3), "04-30-75": dt.date(1975, 4, 30),
                "01-01-68": dt.date(2068, 1, 1), "01-01-69": dt.date(1969, 1, 1), "02-29-96": dt.date(1996, 2, 29),
                "04-30-2022": None, "13-01-22": None, "02-29-23": None, "": None, "04-30-2": dt.date(2002, 4, 30),
                " 04-30-22\n": dt.date(2022, 4, 30), "004-30-22": None, "04 -30-22": None, "0-1-22": None,
            },
        ),
        (text.clean, {"\xa0a\xa0": "a", "\ta \n": "\ta \n", " a　b  ": "a　b", "  ": "", "é ": "é"}),
        (text.clean_upper, {" mumbai ": "MUMBAI"}),
        (text.before_dot, {"400081.0": "400081", "400081": "400081", "": "", " 4.0 ": "4"}),
        (text.is_true_text, {" TRUE ": True, "True": True, "no": False, "": False}),
        (text.list_length, {"": 1, "ab,c": 2, "a": 1, ",,": 3}),
        (text.is_blank, {"": True, " \xa0": True, "\t": False, "x": False}),
    ],
    ids=lambda v: getattr(v, "__name__", ""),
)
def test_stated_values(spark, function, cases):
    assert dict(zip(cases, apply(spark, function, list(cases)), strict=True)) == cases


def test_null_in_null_out(spark):
    for function in (parse.parse_int, parse.parse_money, parse.parse_double, parse.parse_mdy, text.clean,
                     text.before_dot, text.is_true_text, text.list_length, text.blank_to_null):
        assert apply(spark, function, [None]) == [None]
    assert apply(spark, text.is_blank, [None]) == [True]
    assert apply(spark, text.has_text, [None]) == [False]


# A dot or underscore in the exponent, two signs, and zero with an exponent beyond all digits.
ACCEPTED_DIFFERENCE = re.compile(r"e[+-]?\d+[._]|\+-|^ *[+-]?[0_.]+e\+?\d\d")


def random_texts(alphabet, count, longest, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, longest))) for _ in range(count)]


@pytest.mark.parametrize(
    "function, sql, alphabet, longest",
    [
        (parse.parse_int, "try_cast(v AS int)", "0125 .-+e_", 7),
        (parse.parse_money, "try_cast(v AS decimal(10, 2))", "0125 .-+e", 8),
        (parse.parse_double, "try_cast(v AS double)", "0159 .-+ed", 7),
        (parse.parse_mdy, "cast(try_strptime(v, '%m-%d-%y') AS date)", "012369--- ", 9),
        (text.clean, "trim(v)", " a\t\xa0　é​", 8),
        (text.before_dot, "split_part(trim(v), '.', 1)", "1. .", 6),
    ],
)
def test_agrees_with_independent_engine(spark, function, sql, alphabet, longest):
    values = [v for v in sorted(set(random_texts(alphabet, 20000, longest, seed=7))) if not ACCEPTED_DIFFERENCE.search(v)]
    wanted = dict(duckdb.connect().execute(f"SELECT v, {sql} FROM (SELECT unnest(?::varchar[]) AS v)", [values]).fetchall())
    found = apply(spark, function, values)
    wrong = [(v, f, wanted[v]) for v, f in zip(values, found, strict=True) if f != wanted[v]]
    assert not wrong, wrong[:10]


def test_surrogate_key_is_stable_and_tells_null_from_blank(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in rows.select(surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3
    assert keys[2] == "8ca2ed590cf2ea2404f2e67641bcdf50"


def test_round_double_rounds_the_stored_value(spark):
    row = spark.range(1).select(
        numbers.round_double(F.lit(0.285), 2).alias("below"),
        numbers.round_double(F.lit(2.5), 0).alias("half"),
        numbers.round_double(F.lit(-2.5), 0).alias("negative"),
        numbers.percent(F.lit(1), F.lit(0)).alias("empty"),
    ).first()
    assert row.asDict() == {"below": 0.28, "half": 3.0, "negative": -3.0, "empty": None}
