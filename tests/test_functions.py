"""Column functions: statistics maps, type names, counters."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallymark.functions import counters as C, messages as M, statistics as S


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def stats(**counts):
    return S.build_statistics({name: F.lit(n) for name, n in counts.items()})


def test_lookup_with_and_without_default(spark):
    m = stats(TRADE_DATA=3)
    assert one(spark, S.statistic(m, "TRADE_DATA")) == 3
    assert one(spark, S.statistic(m, "MARKET_DATA")) is None
    assert one(spark, S.statistic_or_default(m, "MARKET_DATA", 7)) == 7
    assert one(spark, S.statistic_or_fail(m, "TRADE_DATA")) == 3


def test_lookup_or_fail_fails(spark):
    with pytest.raises(Exception, match="statistics has no entry for MARKET_DATA"):
        one(spark, S.statistic_or_fail(stats(TRADE_DATA=3), "MARKET_DATA"))


def test_contains_and_size(spark):
    m = stats(TRADE_DATA=3, MARKET_DATA=0)
    assert one(spark, S.has_statistic(m, "MARKET_DATA")) is True
    assert one(spark, S.has_statistic(m, "OTHER")) is False
    assert one(spark, S.statistics_size(m)) == 2
    assert one(spark, S.statistics_size(F.lit(None).cast(S.MAP_TYPE))) == 0
    assert one(spark, S.empty_statistics()) == {}


def test_put_remove_merge(spark):
    m = stats(TRADE_DATA=3, MARKET_DATA=1)
    assert one(spark, S.put_statistics(m, {"MARKET_DATA": F.lit(9), "X": F.lit(2)})) == {
        "TRADE_DATA": 3,
        "MARKET_DATA": 9,
        "X": 2,
    }
    assert one(spark, S.remove_statistics(m, "TRADE_DATA")) == {"MARKET_DATA": 1}
    assert one(spark, S.merge_statistics(m, stats(TRADE_DATA=5))) == {"TRADE_DATA": 5, "MARKET_DATA": 1}
    assert one(spark, S.merge_statistics(F.lit(None).cast(S.MAP_TYPE), m)) == {"TRADE_DATA": 3, "MARKET_DATA": 1}


def test_last_entry_wins(spark):
    repeated = F.from_json(F.lit('{"a":1,"b":5,"a":2}'), S.MAP_TYPE)
    assert one(spark, S.last_entry_wins(repeated)) == {"a": 2, "b": 5}


@pytest.mark.parametrize(
    "name,expected",
    [("TRADE_DATA", "TRADE_DATA"), ("MARKET_DATA", "MARKET_DATA"), ("OTHER", "UNRECOGNIZED"), (None, "TRADE_DATA")],
)
def test_normalise_type(spark, name, expected):
    assert one(spark, M.normalise_type(F.lit(name).cast("string"))) == expected


@pytest.mark.parametrize(
    "number,expected", [(0, "TRADE_DATA"), (1, "MARKET_DATA"), (2, "UNRECOGNIZED"), (-1, "UNRECOGNIZED"), (None, "TRADE_DATA")]
)
def test_type_from_number(spark, number, expected):
    assert one(spark, M.type_from_number(F.lit(number).cast("int"))) == expected


@pytest.mark.parametrize(
    "declared,received,has_control,has_data,expected",
    [
        ((0, 0), (1, 0), False, True, C.NO_CTRL),
        ((0, 0), (None, None), True, False, C.COMPLETE),
        ((2, 1), (2, 1), True, True, C.COMPLETE),
        ((2, 1), (None, None), True, False, C.NO_DATA),
        ((2, 1), (3, 1), True, True, C.OVER),
        ((2, 1), (3, 0), True, True, C.OVER),
        ((2, 1), (1, 1), True, True, C.INCOMPLETE),
    ],
)
def test_status_order(spark, declared, received, has_control, has_data, expected):
    row = spark.createDataFrame(
        [(*declared, *received)],
        "declared_trade_data bigint, declared_market_data bigint, received_trade_data bigint, received_market_data bigint",
    )
    status = C.delivery_status(F.lit(has_control), F.lit(has_data))
    assert row.select(status.alias("s")).first()["s"] == expected


def test_describe(spark):
    assert one(spark, C.describe(F.lit(3), F.lit(-1))) == "num trade: 3; num market data: -1"
