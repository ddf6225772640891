import pytest
from pyspark.sql import functions as F

from conftest import bag
from dotreef.operators import columns as c
from dotreef.schemas import METADATA, conform


def test_clean_names():
    raw = ["﻿Sample", "Successful.count", "Comment", "comment", "", "", "", "CampaignID", "a__b", "Depth (m)"]
    want = ["sample", "successful_count", "comment", "comment_2", "x", "x_1", "x_2", "campaignid", "a_b", "depth_m"]
    assert c.clean_names(raw) == want
    assert c.clean_names(["Successful.count", "MP Zoning"], "dots") == ["successful.count", "mp.zoning"]


def test_clean_header_is_the_same_rule(frame):
    raw = ["﻿Sample", "Successful.count", "Comment", "comment", "", " ", "comment", "", "Comment", "9x"]
    df = c.clean_header(frame("h array<string>", (raw,)), "h")
    assert df.first()["h"] == c.clean_names(raw)


def test_presence(frame):
    df = frame("a int, level_1 string, x_1 string", (1, "l", "x"))
    assert c.ensure_cols(df, ["a", "level_9"]).columns == ["a", "level_1", "x_1", "level_9"]
    assert c.rename_if_present(df, {"opcode": "sample", "a": "b"}).columns == ["b", "level_1", "x_1"]
    with pytest.raises(ValueError):
        c.rename(df, {"opcode": "sample"})
    assert c.drop_prefix(df, "x").columns == ["a", "level_1"]
    assert c.select_prefix(df, "level", also=["a"]).columns == ["a", "level_1"]
    assert c.front(df, "x_1").columns == ["x_1", "a", "level_1"]
    assert c.shadow(df, ["level_1"]).columns == ["a", "raw_level_1", "x_1"]


def test_drop_all_null(frame):
    df = frame("a int, b string, c string", (1, None, ""), (None, None, None))
    assert c.drop_all_null(df).columns == ["a", "c"]


def test_union_is_a_bag_by_name(frame):
    a, b = frame("x int, y string", (1, "a"), (1, "a")), frame("z int, x int", (9, 1))
    assert bag(c.union_by_name(a, b), "x", "y", "z") == [(1, "a", None), (1, "a", None), (1, None, 9)]


def test_path_columns(frame):
    df = frame(
        "p string",
        ("file:/land/Port%20A+b/2020-01_x/f_Metadata.csv",), ("file:/land/Only/f.csv",), ("file:/land/f.csv",),
        ("file:/land/P/C/deep/f.csv",),
    )
    assert bag(df.select(*c.path_columns(F.col("p"), "/land/"))) == [
        ("Only", None), ("P", "C"), ("Port A+b", "2020-01_x"), (None, None)]


def test_conform(frame):
    df = frame("sample string, depth_m string, surplus int", ("s", "12.5", 1), ("t", "deep", 2))
    out = conform(df, METADATA)
    assert out.schema.fieldNames() == METADATA.fieldNames()
    assert bag(out, "sample", "depth_m", "project") == [("s", 12.5, None), ("t", None, None)]
    assert "surplus" in conform(df, METADATA, keep_extra=True).columns
