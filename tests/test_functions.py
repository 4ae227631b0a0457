import html
import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_point, hash_threshold
from tidemark.functions.nested import default_to, first_filled, present
from tidemark.functions.numbers import cubed, floor_to, int_or_zero, multiple_above, ratio, scaled
from tidemark.functions.payload import json_field
from tidemark.functions.text import char_length, ends_with_any, html_to_text, normalized
from tidemark.functions.timing import date_and_time, day_of, day_text, hour_of, parse_timestamp


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def evaluate(spark, values, expression, kind="string"):
    return [r[0] for r in column(spark, values, kind).select(expression).collect()]


def test_cubes_stay_whole(spark):
    assert evaluate(spark, [1, 7, 14, 21, None], cubed("v"), "int") == [1, 343, 2744, 9261, None]
    assert evaluate(spark, [2097151], cubed("v"), "bigint") == [2097151 ** 3]


def test_cube_beyond_bigint_fails_loudly_or_widens(spark):
    big = 20_000_000_000
    with pytest.raises(Exception, match="OVERFLOW"):
        evaluate(spark, [big], cubed("v"), "bigint")
    assert evaluate(spark, [big], cubed("v", wide=True), "bigint") == [big ** 3]


def test_numbers_whose_cube_is_a_multiple(spark):
    numbers = spark.range(1, 26).select("id", cubed("id").alias("c"))
    chosen = numbers.where(multiple_above("c", 7, 50)).collect()
    assert [tuple(r) for r in chosen] == [(7, 343), (14, 2744), (21, 9261)]


def test_scaled_and_floored(spark):
    assert evaluate(spark, [3, 5], scaled("v"), "bigint") == [6, 10]
    assert evaluate(spark, [2.669, 0.009, -1.001, None], floor_to("v"), "double") == [2.66, 0.0, -1.01, None]
    assert evaluate(spark, [2.66999], floor_to("v", 4), "double") == [2.6699]


def test_ratio_is_double_and_null_at_zero(spark):
    pairs = spark.createDataFrame([(7, 2), (7, 0), (None, 2)], "a INT, b INT")
    assert [r[0] for r in pairs.select(ratio("a", "b")).collect()] == [3.5, None, None]


def test_int_or_zero_reads_what_it_can(spark):
    assert evaluate(spark, ["12", " 7 ", "3.9", "x", "", None], int_or_zero("v")) == [12, 7, 3, 0, 0, 0]


def test_normalized_keeps_letters_of_any_script(spark):
    texts = ["  El DÍA, después!! ", "año_2 (nuevo)", "a b c", "你好, мир", "--- !!", None, "a\tb\r\nc"]
    assert evaluate(spark, texts, normalized("v")) == [
        "el día después", "año_2 nuevo", "a b c", "你好 мир", "", None, "a b c"]


def test_default_vowels_leave_out_a_acute(spark):
    words = ["casa", "està", "irá", "peu", "és", "ningú", "pingüi", "blau", "camió"]
    found = evaluate(spark, words, ends_with_any("v"))
    assert dict(zip(words, found)) == {
        "casa": True, "està": True, "irá": False, "peu": True, "és": False, "ningú": True,
        "pingüi": True, "blau": True, "camió": True}
    assert evaluate(spark, ["irá"], ends_with_any("v", ["á"])) == [True]


UNPICKLE = """
import pickle, sys, pandas as pd
decode = pickle.loads(bytes.fromhex(sys.argv[1]))
print(next(decode(iter([pd.Series(["a &amp; b", None])]))).tolist(), "tidemark" in sys.modules)
"""


def test_decoder_runs_where_this_package_is_missing(spark):
    from pyspark.cloudpickle import dumps

    from tidemark.functions.text import _entity_decoder
    done = subprocess.run([sys.executable, "-c", UNPICKLE, dumps(_entity_decoder().func).hex()],
                          cwd="/", env={"PATH": os.environ["PATH"]}, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "['a & b', None] False", done.stderr[-1000:]


MARKUP = ["<p>Fish &amp; chips</p>", "a<br/>b", "&lt;b&gt; &quot;x&quot; &#233; &#x20AC; &nbsp;&hellip;",
          "<a href='x?a=1&b=2'>link</a> &notareal; &copy 2020", "no markup", "", None, "&amp;amp; <i\n>x</i>"]


def test_markup_matches_the_standard_library(spark):
    import re
    want = [None if t is None else html.unescape(re.sub("<[^>]+>", "", t)) for t in MARKUP]
    assert evaluate(spark, MARKUP, html_to_text("v")) == want


def test_length_counts_characters(spark):
    assert evaluate(spark, ["día", "", "你好", None], char_length("v")) == [3, 0, 2, None]


def test_first_filled_passes_over_empty_text(spark):
    people = spark.createDataFrame([("", "ann"), ("bob", "x"), (None, ""), (None, None)], "a STRING, b STRING")
    assert [r[0] for r in people.select(first_filled(["a", "b"], "unknown")).collect()] == [
        "ann", "bob", "unknown", "unknown"]
    assert evaluate(spark, [None, 3], default_to("v", 0), "int") == [0, 3]


def test_present_checks_parents(spark):
    df = spark.createDataFrame(
        [(((("x",),),)), ((None,),), (((None,),))], "place STRUCT<name STRING>")
    assert [r[0] for r in df.select(present("place.name")).collect()] == [True, False, False]


def test_bad_timestamps_become_null(spark):
    texts = ["2024-03-01T10:20:30Z", "2024-03-01 10:20:30", "soon", "", None]
    assert evaluate(spark, texts, parse_timestamp("v")) == [
        datetime(2024, 3, 1, 10, 20, 30), datetime(2024, 3, 1, 10, 20, 30), None, None, None]


def test_written_days_sort_by_month_real_days_by_time(spark):
    stamps = [datetime(2023, 12, 31, 23, 5), datetime(2024, 1, 1, 0, 30)]
    df = column(spark, stamps, "timestamp_ntz")
    assert [r[0] for r in df.orderBy(day_text("v")).select(day_text("v")).collect()] == ["01-01-24", "12-31-23"]
    assert [str(r[0]) for r in df.orderBy(day_of("v")).select(day_of("v")).collect()] == ["2023-12-31", "2024-01-01"]
    assert [r[0] for r in df.select(hour_of("v")).collect()] == [23, 0]


def test_date_and_clock_make_one_timestamp(spark):
    df = spark.createDataFrame([("2024-05-06", "07:30"), ("2024-05-06", "late")], "d STRING, t STRING")
    got = df.select(date_and_time(F.col("d").cast("date"), "t")).collect()
    assert [r[0] for r in got] == [datetime(2024, 5, 6, 7, 30), None]


def test_json_field_of_bad_lines_is_null(spark):
    lines = ['{"tweet": "hi"}', '{"other": 1}', "not json", '{"tweet": null}', '{"a": {"b": 3}}']
    assert evaluate(spark, lines, json_field("v", "tweet")) == ["hi", None, None, None, None]
    assert evaluate(spark, lines, json_field("v", "a.b"))[-1] == "3"


def test_hash_points_follow_md5(spark):
    import hashlib
    want = [int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:8], 16) for i in range(50)]
    assert [r[0] for r in spark.range(50).select(hash_point("id", 42)).collect()] == want
    assert spark.range(1).select(hash_threshold(0.01)).first()[0] == 42949672
    assert spark.range(1).select(hash_threshold(7.0)).first()[0] == 4294967296


def test_endings_of_any_length(spark):
    assert evaluate(spark, ["running", "ran", "ring"], ends_with_any("v", ("ing", "n"))) == [True, True, True]
    assert evaluate(spark, ["running"], ends_with_any("v", ("in",))) == [False]
    assert evaluate(spark, ["running"], ends_with_any("v", ())) == [False]
