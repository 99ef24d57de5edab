from __future__ import annotations

import datetime as dt
import html

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pubweave.functions import (
    country_name,
    decode_entities,
    element_text,
    last_comma_split,
    leading_number,
    lenient_long,
    metric_long,
    parse_day_month_year,
    publication_date_parts,
    strip,
)


def evaluate(rows, values, column):
    df = rows([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in df.orderBy("k").select(column(F.col("v"))).collect()]


def test_lenient_long(rows):
    values = ["3.7", "1,234", None, " 12 ", "1e3", "0x1f", "", "1d", "inf", "NaN", "1e30", "-2.9"]
    assert evaluate(rows, values, lenient_long) == [3, 0, 0, 12, 1000, 0, 0, 0, 0, 0, 0, -2]


def test_lenient_long_of_numbers(spark):
    df = spark.sql("select 2020 as i, 2020.9D as d, double('NaN') as n, cast(null as int) as z")
    row = df.select([lenient_long(F.col(c)).alias(c) for c in df.columns]).first()
    assert tuple(row) == (2020, 2020, 0, 0)


def test_metric_long(rows):
    values = ["N/A", "1,234", "7", " 7 ", "many", "", None, "9" * 30]
    assert evaluate(rows, values, metric_long) == [0, 1234, 7, 7, None, None, None, None]


def test_leading_number(rows):
    values = ["7 cites", " 3.5x", "-2", ".5", "1e2z", "x1", "", None]
    assert evaluate(rows, values, leading_number) == [7.0, 3.5, -2.0, 0.5, 100.0, None, None, None]


def test_parse_day_month_year(rows):
    run = dt.date(2024, 1, 2)
    values = ["5 March 2021", "05 March 2021", "Mar 2021", "31 February 2021", None, "1 may  1999"]
    expected = [dt.date(2021, 3, 5), dt.date(2021, 3, 5), run, run, run, dt.date(1999, 5, 1)]
    assert evaluate(rows, values, lambda c: parse_day_month_year(c, run)) == expected


def test_publication_date_parts(spark):
    parts = publication_date_parts(F.lit(dt.date(2021, 3, 5)))
    row = spark.range(1).select([c.alias(n) for n, c in parts.items()]).first()
    assert row.asDict() == {"Date": "05 March 2021", "Year": 2021, "Month": "March", "Day": 5}


def test_strip_and_country(rows):
    values = ["\t IoT \xa0", "\x1c　x y ", "", None]
    assert evaluate(rows, values, strip) == ["IoT", "x y", "", None]
    names = [" france ", "UNITED KINGDOM", "USA", "côte d'ivoire"]
    assert evaluate(rows, names, country_name) == [
        "France",
        "United Kingdom",
        "Usa",
        "Côte D'ivoire",
    ]


def test_last_comma_split(rows):
    values = ["MIT, Cambridge, USA", "MIT", "MIT,", ",", "a ,\n b "]
    heads = evaluate(rows, values, lambda c: last_comma_split(c)[0])
    tails = evaluate(rows, values, lambda c: last_comma_split(c)[1])
    assert list(zip(heads, tails)) == [
        ("MIT, Cambridge", "USA"),
        ("MIT", "Unknown"),
        ("MIT", ""),
        ("", ""),
        ("a", "b"),
    ]


def test_decode_entities(rows):
    values = [
        "A &amp; B",
        "&#233;&#x1F600;&eacute;",
        "&bogus; & x &amp",
        "&amp;lt;",
        "&#0;&#55296;",
        "plain",
        "&apos;&quot;&nbsp;|",
        "&#000000065;&#x00000000042;&lsqb;&NotEqualTilde;&#99999999;",
        None,
    ]
    assert evaluate(rows, values, decode_entities) == [
        "A & B",
        "é😀é",
        "&bogus; & x &amp",
        "&lt;",
        "&#0;&#55296;",
        "plain",
        "'\"\xa0|",
        "AB[\u2242\u0338&#99999999;",
        None,
    ]


def test_element_text(rows):
    values = ["<b>a</b>\n  b<!-- <i> -->", " x <br/>y ", "&lt;b&gt;", "1 < 2 <b>3</b>"]
    assert evaluate(rows, values, element_text) == ["a b", "x y", "<b>", "1 < 2 3"]
    assert evaluate(rows, [" a\n b "], lambda c: element_text(c, collapse=False)) == ["a\n b"]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="ab ,&<é\t x;#1", max_size=12), min_size=1, max_size=20))
def test_text_functions_agree_with_python(rows, texts):
    assert evaluate(rows, texts, strip) == [t.strip() for t in texts]
    assert evaluate(rows, [html.escape(t) for t in texts], decode_entities) == texts
    expected = [
        tuple(p.strip() for p in t.rsplit(",", 1)) if "," in t else (t, "Unknown") for t in texts
    ]
    heads = evaluate(rows, texts, lambda c: last_comma_split(c)[0])
    tails = evaluate(rows, texts, lambda c: last_comma_split(c)[1])
    assert list(zip(heads, tails)) == expected


@pytest.mark.parametrize("function", [strip, lenient_long, element_text])
def test_functions_are_built_in(spark, function):
    plan = spark.range(1).select(function(F.lit("x")))._jdf.queryExecution().toString()
    assert "Python" not in plan
