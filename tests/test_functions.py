"""Scalar helpers on hand-computed values."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions.display import dollars_text, millions_text, percent_text
from kpiloom.functions.derive import release_type, revenue_estimate, sale_price, spike_flag


def test_sale_price_rounds_half_up_in_decimal(spark):
    df = spark.createDataFrame(
        [(10.10, 5.0, 1), (19.99, 25.0, 1), (19.99, 25.0, 0), (4.99, 0.0, 1)],
        "base double, disc double, on_sale int")
    got = [r[0] for r in df.select(sale_price("base", "disc", "on_sale")).collect()]
    # 10.10 × 0.95 = 9.595 → 9.60 (half-up, no binary noise); 19.99 × 0.75 = 14.9925 → 14.99
    assert got == [9.6, 14.99, 19.99, 4.99]


def test_revenue_estimate_and_fallback(spark):
    df = spark.createDataFrame([(1000, 9.99), (0, 9.99), (None, 9.99), (3, 0.01)],
                               "players int, price double")
    got = [r[0] for r in df.select(revenue_estimate("players", "price", 0.15, 100.0)).collect()]
    # 1000 × 9.99 × 0.15 = 1498.5; 0 → fallback; NULL stays NULL; 3 × 0.01 × 0.15 = 0.0045 → 0.00 → fallback
    assert got == [1498.5, 100.0, None, 100.0]


def test_nothing_is_cut_from_price_and_rate(spark):
    df = spark.createDataFrame([(1000, 9.995, 12.3456, 0), (1000, 9.995, 12.3456, 1), (617330, 10.0, 0.0, 0), (5, float("inf"), 0.0, 1)], "players int, price double, disc double, on_sale int")
    assert [r[0] for r in df.select(sale_price("price", "disc", "on_sale")).collect()] == [9.995, 8.76, 10.0, float("inf")]
    got = [r[0] for r in df.select(revenue_estimate("players", "price", 0.12344, 1.234)).collect()]
    assert got == [1233.78, 1233.78, 762032.15, float("inf")]


def test_spike_and_release_labels(spark):
    df = spark.createDataFrame([(300_000, 1), (300_001, 0), (None, None)], "p int, f int")
    rows = df.select(spike_flag("p"), release_type("f")).collect()
    assert [tuple(r) for r in rows] == [(0, "Early Access"), (1, "Full Release"), (0, "Full Release")]


def test_display_text(spark):
    df = spark.createDataFrame([(12_345_678.92, 12.345, 1234.5)], "m double, p double, d double")
    row = df.select(millions_text("m"), percent_text("p"), dollars_text("d"),
                    millions_text(F.lit(1_250_000.0)), millions_text(F.lit(49_894_548_026.65))).first()
    assert tuple(row) == ("$12.3M", "12.3%", "$1,234.50", "$1.3M", "$49894.5M")


def test_dates_are_read_by_the_cast_alone(spark):
    """A format that does not fit costs an exception for each row, and failed the job for years of seven digits."""
    from pyspark.sql.types import DateType

    from kpiloom.functions.casting import typed_column

    texts = {"1995-01-02": 9132, "1995-01-02 00:00:00": 9132, "1995-01-02T10:11:12Z": 9132, " 1995-1-2 ": 9132, "1995-02": 9162, "12345-01-02": 3789392, "+1234567-01-02": 450196811,
             "+12345678-01-02": None, "2021-02-30": None, "02/01/1995": None, "1995-01-02x": None, "": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    typed = df.select("d", F.unix_date(typed_column(df, "d", DateType(), "yyyy-MM-dd")))
    assert {r[0]: r[1] for r in typed.collect()} == texts
    other = spark.createDataFrame([("02/01/1995",), ("1995-01-02",), ("x",)], "d string")
    assert [r[0] for r in other.select(F.unix_date(typed_column(other, "d", DateType(), "dd/MM/yyyy"))).collect()] == [9132, 9132, None]


def test_whole_numbers_with_a_point_are_read_without_exceptions(spark):
    """The cast of "7.0" to a whole number makes an exception for each row; such text goes to the cast to double first."""
    import time

    from pyspark.sql.types import IntegerType, LongType

    from kpiloom.functions.casting import typed_column

    texts = {"7": 7, "7.0": 7, " 7 ": 7, "-7.9": -7, "+7": 7, "7.": 7, ".": None, "1e3": 1000, "99999999999": None, "99999999999.5": None, "NaN": None, "abc": None, "7 .0": None, "": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    assert {r[0]: r[1] for r in df.select("a", typed_column(df, "a", IntegerType())).collect()} == texts
    big = spark.createDataFrame([("9007199254740993",), ("99999999999.0",)], "a string")
    assert [r[0] for r in big.select(typed_column(big, "a", LongType())).collect()] == [9007199254740993, 99999999999]

    def seconds(text):
        rows = spark.range(0, 400_000, 1, 2).selectExpr(f"concat(id % 1000, '{text}') AS a")
        typed = rows.select(typed_column(rows, "a", IntegerType()))
        return min(timed(typed) for _ in range(3))

    def timed(typed):
        begun = time.monotonic()
        typed.write.format("noop").mode("overwrite").save()
        return time.monotonic() - begun

    assert seconds(".0") < 4 * seconds("") + 0.5
