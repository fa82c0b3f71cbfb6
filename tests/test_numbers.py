"""Measures of any length against Python's decimals."""

import random
from decimal import ROUND_HALF_UP, Context, Decimal, InvalidOperation, localcontext

from pyspark.sql import functions as F

from gridspark.functions import numeric as N
from gridspark.sinks.tables import published_text

WIDE = Context(prec=900, rounding=ROUND_HALF_UP)


def plain(value: Decimal, places=None):
    with localcontext(WIDE):
        if places is not None:
            shown = format(value.quantize(Decimal(1).scaleb(-places)), "f")
            return shown.lstrip("-") if not value.quantize(Decimal(1).scaleb(-places)) else shown
        shown = format(value, "f")
        shown = shown.rstrip("0").rstrip(".") if "." in shown else shown
        return "0" if not value else shown


def texts(n=1500):
    rng = random.Random(6)
    digits = lambda k: "".join(rng.choice("0123456789") if rng.random() < 0.6 else rng.choice("09") for _ in range(k))
    out = ["0", "-0", "-0.0", "+5", ".5", "-.50", "5.", "007", "1234567890123", "-999999999999.9995", "9" * 40 + ".95", "0." + "0" * 25 + "1",
           "1E30", "+1.5E3", "-2.50e-9", "1e-40", "9.5E0", "12345678901234567890", "0.99999999999999999999", "1 234 567 890 123,45", "1\xa0000,5"]
    for _ in range(n):
        text = rng.choice(["", "", "-", "+"]) + digits(rng.randint(1, 30))
        if rng.random() < 0.6:
            text += rng.choice(".,") + digits(rng.randint(0, 30))
        if rng.random() < 0.15:
            text += rng.choice("eE") + rng.choice(["", "+", "-"]) + str(rng.randint(0, 30))
        out.append(text)
    return out


def test_measures_of_any_length(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("m", N.to_measure(F.col("t")))
    shown = {"plain": N.format_measure(F.col("m")), "scaled": N.format_measure(N.scaled(F.col("m"), F.lit("#,##0,"))),
             "percent": N.format_measure(N.percentage(F.col("m"), F.lit("0.0%"))),
             "whole": N.format_measure(N.to_measure(F.col("t")), 0), "tenth": N.format_measure(N.percentage(F.col("m"), F.lit("0%")), 1),
             "cents": N.format_measure(N.two_decimals(N.scaled(F.col("m"), F.lit("0,"))))}
    for r in df.select("id", "t", F.col("m.flag").alias("flag"), *[c.alias(n) for n, c in shown.items()]).collect():
        with localcontext(WIDE):
            value = Decimal(r.t.replace(" ", "").replace("\xa0", "").replace(",", "."))
            wanted = {"plain": plain(value), "scaled": plain(value / 1000), "percent": plain(value * 100), "whole": plain(value, 0),
                      "tenth": plain(value * 100, 1), "cents": plain(Decimal(plain(value / 1000, 2)))}
        assert r.flag is None and {n: r[n] for n in shown} == wanted, r.t


def test_ordinary_numbers_have_no_digits(spark):
    rows = [("12.5", None), ("999999999999.123456789012345678", None), ("000012.50", None), ("1000000000000", "1000000000000"),
            ("0.1234567890123456789", "0.1234567890123456789"), ("NS", None), ("n.c.", None), ("", None), (None, None), ("1.2.3", None)]
    got = spark.createDataFrame(rows, "t string, d string").select("d", N.to_measure(F.col("t"))["digits"].alias("got")).collect()
    assert [r.got for r in got] == [r.d for r in got]


def test_plain_notation_keeps_a_plus(spark):
    rows = [("+1.5E3", "1500"), ("-1.5E3", "-1500"), ("1.5E-3", "0.0015"), ("+5", "+5"), ("x", "x")]
    got = spark.createDataFrame(rows, "t string, w string").select("w", N.plain_notation(F.col("t")).alias("got")).collect()
    assert [r.got for r in got] == [r.w for r in got]


def test_whole_numbers(spark):
    rows = [("7", "7"), ("7.0", "7"), ("7.5", None), ("12345678901234567890", "12345678901234567890"), ("1" * 38, "1" * 38),
            ("1" * 39, None), ("1" * 20 + ".5", None), ("x", None)]
    got = spark.createDataFrame(rows, "t string, w string").select("w", N.to_int(N.to_measure(F.col("t"))).cast("string").alias("got")).collect()
    assert [r.got for r in got] == [r.w for r in got]


def test_published_measure(spark):
    df = spark.createDataFrame([("1234567890123456.5",), ("NS",), (None,)], "t string").select(N.to_measure(F.col("t")).alias("x_mad"))
    assert [r[0] for r in df.select(published_text(df.schema["x_mad"])).collect()] == ["1234567890123457", "NS", ""]
