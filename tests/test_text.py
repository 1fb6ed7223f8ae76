import random

from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions import text

SPACES = fixed.WHITESPACE


def column(spark, values, step):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in rows.select("i", step(F.col("x")).alias("y")).orderBy("i").collect()]


def test_whitespace_is_what_strip_removes():
    assert set(SPACES) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_strip_equals_python(spark):
    rng = random.Random(1)
    values = ["", " ", "\xa0a "] + [
        "".join(rng.choice(SPACES + "abè​") for _ in range(rng.randint(0, 12))) for _ in range(300)
    ]
    assert column(spark, values, text.strip) == [v.strip() for v in values]


def test_digits_or(spark):
    values = ["12", "", " 12", "+5", "12b", "007", "1.0", "99999999999999999999", "12\n"]
    assert column(spark, values, lambda x: text.digits_or(x, 0)) == [12, 0, 0, 0, 0, 7, 0, 0, 0]
    assert column(spark, ["x", "3", None], lambda x: text.digits_or(x, None)) == [None, 3, None]


def test_int_or_zero(spark):
    values = ["12", " +12 ", "-3", "", "x", "1_000", "1__0", "1.5", "\xa07"]
    assert column(spark, values, text.int_or_zero) == [12, 12, -3, 0, 0, 1000, 0, 0, 7]


def test_count_paragraphs(spark):
    values = ["", "a", "a\n\nb", "a\n\n\n\nb", "a\n\n\nb", "a\nb"]
    assert column(spark, values, text.count_paragraphs) == [0, 1, 2, 3, 2, 1]


def test_numbers_and_join(spark):
    assert column(spark, ["7, 3 e 7", "", "a12b"], text.numbers_in) == [[7, 3, 7], [], [12]]
    assert column(spark, ["7 3", ""], lambda x: text.join_numbers(text.numbers_in(x))) == ["7, 3", ""]
