"""Column functions on text."""

import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.functions import scalar, text


def values(spark, column, *inputs):
    df = spark.createDataFrame([(i, value) for i, value in enumerate(inputs)], "i int, v string")
    return [row[0] for row in df.orderBy("i").select(column(F.col("v"))).collect()]


def cut_tags(value, keep_empty=False):
    """What extract_tags has to give, token by token."""
    tags = [re.split("['.?,:!…💕]", token[1:])[0] for token in re.split(r"\s+", value) if token[:1] == "#" != token]
    return tags if keep_empty else [tag for tag in tags if tag]


def test_extract_tags(spark):
    sample = "#Dont go #a.b #x… #y💕 # #'q hi#no ##z #nb\n#end"
    assert values(spark, text.extract_tags, sample) == [["Dont", "a", "x", "y", "#z", "nb", "end"]]
    kept = values(spark, lambda c: text.extract_tags(c, keep_empty=True), sample)
    assert kept == [["Dont", "a", "x", "y", "", "#z", "nb", "end"]]


def test_extract_tags_on_random_texts(spark):
    found = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.text(alphabet="#ab é'.?,:!…💕 \t\n  ", max_size=30))
    def collect(sample):
        found.append(sample)

    collect()
    assert values(spark, text.extract_tags, *found) == [cut_tags(sample) for sample in found]
    kept = values(spark, lambda c: text.extract_tags(c, keep_empty=True), *found)
    assert kept == [cut_tags(sample, True) for sample in found]


def test_normalise_tag(spark):
    assert values(spark, text.normalise_tag, " A b ", " É\t", "x", " ") == ["a b", "é", "x", ""]


def test_percent_encode(spark):
    unreserved = string.ascii_letters + string.digits + "-_.~"
    assert values(spark, text.percent_encode, unreserved, "a b+*é#,") == [unreserved, "a%20b%2B%2A%C3%A9%23%2C"]


def test_request_text(spark):
    assert values(spark, text.form_text, "&track=#a&b=c", "x") == ["track=%23a&b=c", "x"]


def test_small_ones(spark):
    assert values(spark, text.preview, "x" * 300, "ab") == ["x" * 250, "ab"]
    assert values(spark, lambda c: text.utf8_text(text.utf8_bytes(c)), "é💕") == ["é💕"]
    assert values(spark, text.is_blank, "", None, " ") == [True, True, False]
    assert values(spark, lambda c: text.dictionary_key("Language", c), "en") == ["Language:en"]
    assert values(spark, scalar.as_long, "12", "x", "9223372036854775808", None) == [12, None, None, None]


def test_contains(spark):
    assert values(spark, lambda c: text.contains_text(c, F.lit("ab")), "xABx", "a") == [True, False]
    assert values(spark, lambda c: text.contains_text(c, F.lit("ab"), ignore_case=False), "xABx", "xab") == [False, True]


def test_rate(spark):
    df = spark.createDataFrame([(5000, 400), (5000, 2999), (7, 60000)], "n bigint, ms bigint")
    rates = [row[0] for row in df.select(scalar.rate_per_second(F.col("n"), F.col("ms"))).collect()]
    assert rates == [5000, 2500, 0]


def test_every_white_space_is_trimmed(spark):
    code = F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")
    signs = spark.range(0x11000).where("id not between 55296 and 57343").select(code.alias("c"))
    both = signs.select(F.concat("c", "c", F.lit("x"), "c", F.lit("y"), "c").alias("t"))
    by_rule = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    assert both.where(~text.trim_all(F.col("t")).eqNullSafe(by_rule)).count() == 0
    assert both.where(text.trim_all(F.col("t")) != F.col("t")).count() == 25
    assert spark.range(1).select(text.trim_all(F.lit(None).cast("string"))).first()[0] is None
