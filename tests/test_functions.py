import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import bag
from dotreef.functions import (
    detect, extract_first, first_token, if_else_na, in_set, not_in_set, pad_left, remove, replace_map, sample_expr,
    separate, strip_leading_zeros, strip_to_last, trim_ws, try_number,
)
from dotreef.plans import campaigns


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(fn(F.col("v")).alias("o")).first()["o"]


def test_membership_null_rules(frame):
    df = frame("v string", (None,), ("",), ("Unscorable",), ("Sponges",))
    assert bag(df.filter(not_in_set("v", ["", "Unscorable", None]))) == [("Sponges",)]
    assert bag(df.filter(not_in_set("v", ["Unscorable"]))) == [("",), ("Sponges",), (None,)]
    assert bag(df.filter(in_set("v", ["Sponges", None]))) == [("Sponges",), (None,)]
    assert bag(df.filter(in_set("v", ["Sponges"]))) == [("Sponges",)]
    # The plain comparison drops NULL, the membership keeps it.
    assert bag(df.filter(F.col("v") != "")) == [("Sponges",), ("Unscorable",)]


@pytest.mark.parametrize("code,expected", [(2, "Biota"), (3, "own"), (None, None)])
def test_if_else_na(frame, code, expected):
    df = frame("c int, l string", (code, "own"))
    assert df.select(if_else_na(F.col("c") == 2, F.lit("Biota"), F.col("l")).alias("o")).first()["o"] == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("80300910", 80300910), ("00000001", 1), ("80300910.0", 80300910), ("1.5", None), ("Macroalgae", None), ("", None),
     (None, None), ("NaN", None), ("1e30", None)],
)
def test_try_number(spark, raw, expected):
    assert one(spark, raw, try_number) == expected


def test_replacements_are_sequential_patterns(spark):
    rules = {"_left": "", ".avi": "", " \\(2\\)": ""}
    assert one(spark, "Inside (2)_left.avi", lambda c: replace_map(c, rules)) == "Inside"
    # The dot is a pattern, as in the exports' own rules.
    assert one(spark, "a_JPG", lambda c: replace_map(c, {".JPG": ""})) == "a"


@pytest.mark.parametrize(
    "fn,raw,expected",
    [
        (lambda c: extract_first(c, "(?<=_)[0-9]+(?=_)"), "CMR_104_x_7_", "104"),
        (lambda c: extract_first(c, "(?<=_)[0-9]+(?=_)"), "plain", None),
        (strip_to_last, "a_b_0012", "0012"),
        (strip_to_last, "none", "none"),
        (strip_leading_zeros, "0012", "12"),
        (strip_leading_zeros, "000", ""),
        (trim_ws, "\t a b \n", "a b"),
        (lambda c: pad_left(c, 2), "7", "07"),
        (lambda c: pad_left(c, 2), "abc", "abc"),
        (lambda c: remove(c, r"\.jpg$"), "a.jpg.jpg", "a.jpg"),
        (lambda c: remove(c, r"\.jpg$"), "a.JPG", "a.JPG"),
        (lambda c: first_token(c, ".JPG"), "12.JPG", "12"),
        (lambda c: detect(c, "Drift Algae", ignore_case=True), "some drift algae", True),
    ],
)
def test_text(spark, fn, raw, expected):
    assert one(spark, raw, fn) == expected


def test_separate(frame):
    df = frame("id int, v string", (1, "a > b > c"), (2, "a"), (3, None), (4, "Genus species-x"))
    assert bag(separate(df, "v", ["p", "q"], " > ", extra="merge")) == [
        (1, "a", "b > c"), (2, "a", None), (3, None, None), (4, "Genus species-x", None)]
    assert bag(separate(df, "v", ["p", "q"], " > ")) == [
        (1, "a", "b"), (2, "a", None), (3, None, None), (4, "Genus species-x", None)]
    assert bag(separate(df, "v", ["p", "q"]).filter("id = 4")) == [(4, "Genus", "species")]
    assert separate(df, "v", ["v", "extra"], " > ").columns == ["id", "v", "extra"]
    with pytest.raises(ValueError):
        separate(df, "v", ["p"], extra="warn")


@pytest.mark.parametrize(
    "steps,raw,expected",
    [
        (campaigns.STRIP_IMAGE, "NPZ6.10.JPG", "NPZ6.10"),
        (campaigns.STRIP_IMAGE_TRIM, "12 .jpg", "12"),
        (campaigns.PILCHARD_FILES, "Inside_2_25_Pilchards (2)_Right.avi", "INSIDE_2_25_PILCHARDS"),
        (campaigns.PILCHARD_FILES, "Outside_1_5_Pilchards_left.avi", "Outside_2_15_Pilchards"),
        (campaigns.AFTER_LAST, "A_0012.avi", "12"),
        (campaigns.BETWEEN, "CMR_104_x.png", "104"),
        (campaigns.GRID_BACKWARDS, "7.1.JPG", "07"),
        (campaigns.FIRST_TOKEN, "PCB18_2.JPG", "PCB18"),
        (campaigns.STRIP_IMAGE, None, None),
    ],
)
def test_sample_rules(spark, steps, raw, expected):
    assert one(spark, raw, lambda c: sample_expr(c, steps)) == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZ09._ JPGjpg()", max_size=12), min_size=1, max_size=20))
def test_sample_rules_settle(spark, names):
    """Trimming and zero stripping change nothing the second time."""
    df = spark.createDataFrame([(n,) for n in names], "v string")
    for steps in (campaigns.TRIM, (("strip_zeros",),), (("after_last", "_"),)):
        once = sample_expr("v", steps)
        assert df.filter(once != sample_expr(once, steps)).count() == 0
