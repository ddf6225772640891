import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import bag
from dotreef.operators.columns import rename
from dotreef.schemas import CLASSIFICATION, CODE
from dotreef.sources import (
    read_annotations, read_classification, read_crosswalk, read_metadata, read_plain_csv, scan_ragged, scratch_dir,
    store_points, synthesise_metadata, write_metadata, write_report, write_upload, write_upload_files,
)

PREAMBLE = "Measurements\n\nby someone\nunits\n"


@pytest.fixture
def exports(tmp_path):
    folder = tmp_path / "Project A+b" / "2020-01_one"
    folder.mkdir(parents=True)
    (folder / "f_Dot Point Measurements.txt").write_text(
        PREAMBLE + "Filename\tImage row\tCODE\tNote\n" + "a.JPG\t1\t80300910\t\n" + "b.jpg\t\tx\t\"said \"\"hi\"\"\tthere\"\n\n"
        + "short\t2\n" + "Measurements\n"
    )
    (folder / "b_Dot Point Measurements.txt").write_bytes(
        (PREAMBLE + "﻿Code\tFILENAME\t\t\t\t\t\t\t\n" + "7\tc.JPG\tx0\tx1\tx2\tx3\tx4\tx5\tx6\n").replace("\n", "\r\n").encode()
    )
    (folder / "empty_Dot Point Measurements.txt").write_text("only\ntwo\n")
    (folder / "other.txt").write_text("not read")
    return str(tmp_path)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_ragged_scan(spark, exports, limit):
    """Whole-file and line-split reading give the same rows."""
    out = scan_ragged(spark, exports, glob="*_Dot Point Measurements.txt", whole_file_bytes=limit)
    assert set(out.columns) == {"filename", "image_row", "code", "note", "x", *[f"x_{i}" for i in range(1, 7)], "__path"}
    rows = bag(out, "filename", "image_row", "code", "note", "x", "x_6")
    assert rows == [
        ("Measurements", None, None, None, None, None),
        ("a.JPG", "1", "80300910", None, None, None), ("b.jpg", None, "x", 'said "hi"\tthere', None, None),
        ("c.JPG", None, "7", None, "x0", "x6"), ("short", "2", None, None, None, None)]


@pytest.mark.parametrize("block", ["300", "134217728"])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_rows_that_repeat_preamble_and_header(spark, tmp_path, limit, block):
    head = PREAMBLE + "Filename\tCode\n"
    body = "a.JPG\t1\n" * 40 + "units\n" + "Filename\tCode\n" * 2 + "b.JPG\t2\nMeasurements\t7\nunits\n"
    (tmp_path / "one.txt").write_text(head + body)
    (tmp_path / "two.txt").write_text(head)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        out = scan_ragged(spark, str(tmp_path), glob="*.txt", columns=["filename", "code"], whole_file_bytes=limit)
        want = [("a.JPG", "1")] * 40 + [("units", None)] * 2 + [("Filename", "Code")] * 2 + [("b.JPG", "2"), ("Measurements", "7")]
        assert bag(out, "filename", "code") == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_quotes(spark, tmp_path, limit):
    wide = "\t".join(f'"cell {i}"' for i in range(3000))
    lines = ["a\tb\tc\td", '12" deep\tx\ty\tz', '"q\tr"\t"say ""so"""\t ""\t"" ""', wide, '\t"t"\t\t']
    (tmp_path / "q.txt").write_text("\n".join(lines) + "\n")
    out = scan_ragged(spark, str(tmp_path), skip=0, glob="*.txt", columns=["a", "b", "c", "d"], whole_file_bytes=limit)
    rows = bag(out, "a", "b", "c", "d")
    assert ('12" deep', "x", "y", "z") in rows and ("cell 0", "cell 1", "cell 2", "cell 3") in rows and (None, "t", None, None) in rows
    assert ("q\tr", 'say "so"') in [r[:2] for r in rows] and len(rows) == 4


TORN = (
    'a\tb\tc\n1\t"two\nlines"\tx\n2\t"a ""quoted"" word\n\nand\ta tab\n"\ty\n3\tplain\tz\n"4\n4"\t"5"\t"6\n6\n6"\n5\t12" deep\t"7" x\n6\tend\t"last\none"'
)
TORN_ROWS = [
    ("1", "two\nlines", "x"), ("2", 'a "quoted" word\n\nand\ta tab\n', "y"), ("3", "plain", "z"), ("4\n4", "5", "6\n6\n6"), ("5", '12" deep', '"7" x'), ("6", "end", "last\none"),
]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("block", ["7", "20", "134217728"])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_quoted_line_breaks(spark, tmp_path, limit, block, ending):
    """The same rows whole or split, wherever the file is cut; other files are not touched by it."""
    for k in range(2):
        (tmp_path / f"torn{k}.txt").write_bytes((TORN + ("" if k else "\n")).replace("\n", ending).encode())
    (tmp_path / "plain.txt").write_text('b\ta\n"q"\t7\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        out = scan_ragged(spark, str(tmp_path), skip=0, glob="*.txt", columns=["a", "b", "c"], whole_file_bytes=limit)
        assert bag(out, "a", "b", "c") == sorted(TORN_ROWS * 2 + [("7", "q", None)], key=lambda t: tuple((x is None, str(x)) for x in t))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_random_tables_with_quotes(spark, tmp_path):
    """What a CSV writer wrote comes back, whatever stands in its cells."""
    import csv
    import random

    rng, want = random.Random(11), []
    for k in range(4):
        rows = [["".join(rng.choice(['a', 'b', '"', '\n', ',', ' ', 'é', '""']) for _ in range(rng.randint(1, 7))).strip(' "') or "x" for _ in range(3)] for _ in range(40)]
        with open(tmp_path / f"t{k}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows([["a", "b", "c"], *rows])
        want += [tuple(r) for r in rows]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for limit, block in ((1 << 20, "134217728"), (0, "134217728"), (0, "61"), (0, "150")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", block)
            out = scan_ragged(spark, str(tmp_path), sep=",", skip=0, glob="*.csv", columns=["a", "b", "c"], whole_file_bytes=limit)
            assert bag(out, "a", "b", "c") == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t)), (limit, block)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_a_quoted_cell_that_never_ends_is_an_error(spark, tmp_path, limit):
    (tmp_path / "m.txt").write_text('a\tb\n1\t"two\nlines\n' + "x\ty\n" * 50)
    with pytest.raises(Exception, match="quoted cell does not end"):
        scan_ragged(spark, str(tmp_path), skip=0, glob="*.txt", columns=["a", "b"], whole_file_bytes=limit).collect()


def test_kinds_in_one_path_under_static_mode(spark, frame):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        path, store = scratch_dir(spark), scratch_dir(spark)
        df = frame(f"campaignid string, sample string, {CODE} bigint", ("c", "s", 1), ("d", "s", 2))
        for kind in ("benthos", "relief", "benthos"):
            write_upload(df, path, kind)
            store_points(df.selectExpr("campaignid", f"'{kind}' AS kind", "sample"), store)
        store_points(df.where("campaignid = 'c'").selectExpr("campaignid", "'relief' AS kind", "'new' AS sample"), store)
        assert spark.read.csv(path, header=True).groupBy("upload_kind").count().count() == 2
        assert bag(spark.read.parquet(store), "campaignid", "kind", "sample") == [
            ("c", "benthos", "s"), ("c", "relief", "new"), ("d", "benthos", "s"), ("d", "relief", "s")]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_no_local_folder_on_a_cluster():
    class Fake:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_dir(Fake)


def test_annotations_with_named_columns(spark, exports):
    out = read_annotations(spark, exports, columns=["filename", "x_6", "absent"])
    assert bag(out.filter("x_6 is not null"), "filename", "x_6", "absent") == [("c.JPG", "x6", None)]
    assert out.count() == 5


def test_large_files_split_into_tasks(spark, tmp_path):
    body = "".join(f"img{i}.JPG\t{i}\tsome longer text to fill the line\n" for i in range(30_000))
    (tmp_path / "big.txt").write_text(PREAMBLE + "Filename\tCode\tNote\n" + body)
    (tmp_path / "small.txt").write_text(PREAMBLE + "Code\tFilename\n" + "1\tz.JPG\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        out = scan_ragged(spark, str(tmp_path), glob="*.txt", columns=["filename", "code"], whole_file_bytes=10_000)
        assert spark.read.text(f"{tmp_path}/big.txt").rdd.getNumPartitions() > 4
        assert out.count() == 30_001 and out.selectExpr("sum(cast(code as bigint))").first()[0] == sum(range(30_000)) + 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.fixture
def archive(tmp_path):
    def put(path, text):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(text, encoding="utf-8")

    put("P One/c1/c1_Metadata.csv", "﻿Campaign.ID,Sample,Latitude,Longitude,Date,Time,Site,Location,Status,Depth,Successful.count,Successful.length,Comment\n"
        "zzz,s1,-31.5,115.2,20210518,12:28,NA,\"Bay, north\",Fished,-12.5,Yes,No,fine\n")
    put("P One/c2/c2_Metadata.csv", "opcode,latitude_dd,depth_m,date,time,comment,comment\n7,-30,deep,20210519,7:36:19,first,second\n,,,,,,\n")
    put("Q/c3/notes.csv", "Sample\nnot metadata\n")
    return str(tmp_path)


def test_synthesis(spark, archive):
    out = synthesise_metadata(spark, archive)
    assert bag(out, "project", "campaignid", "sample", "latitude", "location", "site", "comment") == [
        ("P One", "c1", "s1", "-31.5", "Bay, north", None, "fine"), ("P One", "c2", "7", None, None, None, "first"),
        ("P One", "c2", None, None, None, None, None)]


def test_canonical_metadata(spark, archive):
    out = read_metadata(spark, archive, campaign_level=False)
    assert bag(out.filter("sample is not null"), "campaignid", "sample", "latitude_dd", "depth_m", "date_time") == [
        ("c1", "s1", -31.5, -12.5, dt.datetime(2021, 5, 18, 12, 28)), ("c2", "7", -30.0, None, dt.datetime(2021, 5, 19, 7, 36, 19))]


def test_upload_keeps_empty_and_null_apart(spark, frame):
    df = frame(f"campaignid string, sample string, level_2 string, {CODE} bigint, count bigint",
               ("c", "b", "", 2, 1), ("c", "a", None, None, 5), ("d", "x", "Sponges, cup", 3, 2))
    path = scratch_dir(spark)
    write_upload(df, path, "relief", rename_sample="opcode", order=["opcode"])
    back = read_plain_csv(spark, path, rename(df, {"sample": "opcode"}).schema).drop("upload_campaign", "upload_kind")
    assert back.columns == ["campaignid", "opcode", "level_2", CODE, "count"]
    assert bag(back) == bag(df)
    raw = spark.read.text(f"{path}/upload_campaign=c/upload_kind=relief")
    assert [r[0] for r in raw.collect()] == [f"campaignid,opcode,level_2,{CODE},count", "c,a,NA,NA,5", 'c,b,"",2,1']


def test_metadata_sink_and_report(spark, frame):
    df = frame("campaignid string, sample string", ("c", None), ("c", "s"))
    path = scratch_dir(spark)
    write_metadata(df, path)
    assert bag(spark.read.parquet(f"{path}/parquet")) == bag(read_plain_csv(spark, f"{path}/csv", df.schema)) == bag(df)
    write_report(df, f"{path}/report")
    assert bag(read_plain_csv(spark, f"{path}/report", df.schema)) == bag(df)
    store_points(df, f"{path}/points")
    assert spark.read.parquet(f"{path}/points").filter("campaignid = 'c'").count() == 2


def test_dimension_snapshots(spark, tmp_path):
    (tmp_path / "classes.csv").write_text("CAAB_CODE,Level.1,level_2,qualifiers\n00000001,Unknown,Unscorable,q\nbad,Biota,\"\",q\n2,Biota,NA,q\n")
    got = read_classification(spark, str(tmp_path / "classes.csv"))
    assert got.schema.fieldNames() == CLASSIFICATION.fieldNames()
    assert bag(got, CODE, "level_1", "level_2") == [(1, "Unknown", "Unscorable"), (2, "Biota", None), (None, "Biota", "")]
    (tmp_path / "walk.csv").write_text("Broad,caab_code\nA,1\nA,1\nNA,2\n")
    assert bag(read_crosswalk(spark, str(tmp_path / "walk.csv"))) == [("A", 1), (None, 2)]
    assert isinstance(got.schema[CODE].dataType, T.LongType)


def test_no_column_of_any_file_is_lost(spark, tmp_path):
    (tmp_path / "one.txt").write_text(PREAMBLE + "Filename\tCode\tNote\tNote\na.JPG\t1\tx\ty\tbeyond\nb.JPG\t\t\tz\n")
    (tmp_path / "two.txt").write_text(PREAMBLE + "Other\tFILENAME\nq\tc.JPG\n")
    for limit in (0, 1 << 20):
        out = scan_ragged(spark, str(tmp_path), glob="*.txt", columns=["filename"], rest="rest", whole_file_bytes=limit)
        got = {r["filename"]: r["rest"] for r in out.collect()}
        assert got == {"a.JPG": {"code": "1", "note": "x", "note_2": "y", "cell_5": "beyond"}, "b.JPG": {"note_2": "z"}, "c.JPG": {"other": "q"}}


def test_rows_taken_for_headers_do_not_flood_the_driver(spark, tmp_path, monkeypatch):
    from dotreef.sources import ragged

    monkeypatch.setattr(ragged, "MOST_NAMES", 20)
    for i in range(5):
        (tmp_path / f"{i}.txt").write_text(PREAMBLE + "\t".join(f"n{i}_{k}" for k in range(6)) + "\n")
    with pytest.raises(ValueError, match="more than 20 different names"):
        scan_ragged(spark, str(tmp_path), glob="*.txt")


def test_one_file_for_each_campaign(spark, tmp_path):
    rows = [(c, f"s{i}", i % 3 or None) for c in ("c one", "c/2", "ü=x") for i in range(20)]
    df = spark.createDataFrame(rows, "campaignid string, sample string, count int").repartition(5)
    path = str(tmp_path / "up")
    for _ in range(2):  # the second one replaces the files of the first
        seen = write_upload_files(df, path, "benthos", rename_sample="opcode", order=["opcode"], watch={"empty": F.col("count").isNull()})
    assert seen == {"rows": 60, "empty": 21}
    names = sorted(p.relative_to(path).as_posix() for p in (tmp_path / "up").rglob("*.csv"))
    assert names == sorted(["c one_benthos.csv", "c%2F2_benthos.csv", "ü=x_benthos.csv"])
    text = (tmp_path / "up" / "c one_benthos.csv").read_text().splitlines()
    assert text[0] == "campaignid,opcode,count" and text[1:] == sorted(text[1:], key=lambda r: r.split(",")[1]) and len(text) == 21 and text[1].endswith("NA")


def test_findings_are_observed_while_writing(spark, tmp_path):
    rows = [("c", "s", i % 4 or None) for i in range(40)]
    df = spark.createDataFrame(rows, "campaignid string, sample string, count int")
    seen = write_upload(df, str(tmp_path / "up"), "benthos", watch={"empty": F.col("count").isNull(), "big": F.col("count") > 2})
    assert seen == {"rows": 40, "empty": 10, "big": 10}
    assert write_upload(df.limit(0), str(tmp_path / "none"), "benthos", watch={"empty": F.lit(True)}) == {"rows": 0, "empty": 0}


@pytest.mark.parametrize("block", ["2000", "134217728"])
def test_row_numbers_follow_the_files(spark, tmp_path, block):
    from dotreef.operators.columns import with_row_number

    for k in range(3):

        (tmp_path / f"f{k}.txt").write_text("".join(f"{k * 1000 + i}\n" for i in range(400)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        lines = spark.read.text(str(tmp_path))
        want = [(str(k * 1000 + i), k * 400 + i + 1) for k in range(3) for i in range(400)]
        assert sorted(tuple(r) for r in with_row_number(lines).collect()) == sorted(want)
        odd = [(v, j) for j, (v, _) in enumerate([w for w in want if int(w[0]) % 2], 1)]
        assert sorted(tuple(r) for r in with_row_number(lines.filter("value % 2 = 1"), "n").collect()) == sorted(odd)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_scratch_folders_go(spark):
    from pathlib import Path

    from dotreef.sources import sinks

    first = sinks.scratch_count()
    kept, gone = scratch_dir(spark, "kept"), scratch_dir(spark)
    for path in (kept, gone):
        spark.range(3).write.parquet(path)
    sinks.drop_scratch(spark, first, keep=[kept])
    assert Path(kept).exists() and not Path(gone).exists() and sinks.scratch_count() == first + 1
    sinks.drop_scratch(spark, first)
    assert not Path(kept).exists()


def test_frequent_lines_are_spread_over_files(spark, tmp_path, monkeypatch):
    """Rows that look alike once written, but are different ones, make as many files as other rows do."""
    from dotreef.plans import landing

    monkeypatch.setattr(landing, "ROWS_PER_FILE", 20)
    rows = spark.createDataFrame([("a", i, "Units: dots") for i in range(200)], "campaignid string, sample long, filename string")
    landing.write_raw(rows, str(tmp_path / "raw"), ["campaignid"], {"filename": "Filename"}, landing.PREAMBLE, "\t")
    lines = spark.read.text(str(tmp_path / "raw")).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    found = [r["n"] for r in lines.collect()]
    per_file = len(landing.PREAMBLE) + 1
    assert len(found) > 5 and max(found) < 50 + per_file and sum(found) == 200 + per_file * len(found)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_what_follows_from_a_path_is_worked_out_once_per_file(spark, tmp_path, limit, monkeypatch):
    from dotreef.sources import exports, ragged

    monkeypatch.setattr(exports, "read_annotations", lambda *a, **k: ragged.scan_ragged(*a, **k, whole_file_bytes=limit))
    folder = tmp_path / "p one" / "campaignid=a+b"
    folder.mkdir(parents=True)
    (folder / "x_Backward_Relief.txt").write_text("a\nb\n\nc\nFilename\tCode\nf1\t1\nb\t2\nf1\t1\n")
    (folder / "x_Forwards.txt").write_text("a\nb\n\nc\nCode\tFilename\n3\tf2\n")
    dots = exports.ingest(spark, str(tmp_path), ["filename", "code"], glob="*.txt")
    assert dots.columns == ["filename", "code", "project", "campaignid", "direction", "kind"]
    place = ("p one", "campaignid=a+b")
    assert bag(dots) == bag(spark.createDataFrame([("f1", "1", *place, "backwards", "relief"), ("b", "2", *place, "backwards", "relief"), ("f1", "1", *place, "backwards", "relief"),
                                                   ("f2", "3", *place, "forwards", "benthos")], dots.schema))
    above = dots._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "forwards?" not in above and "try_url_decode" not in above.lower()


def test_one_file_is_sorted_in_pieces(spark, tmp_path, monkeypatch):
    from dotreef.sources import sinks

    monkeypatch.setattr(sinks, "ROWS_PER_PIECE", 7)
    rows = [(c, f"s{i:03}" if i else None, 'say "x",\r\nthen' if i % 9 == 1 else "" if i % 9 == 2 else None) for c in ("one", "{two}", None) for i in range(100)]
    df = spark.createDataFrame(rows, "campaignid string, sample string, note string").repartition(6)
    assert write_upload_files(df, str(tmp_path), "benthos", order=["sample"]) == {"rows": 300}
    assert sorted(p.name for p in tmp_path.glob("[!.]*")) == ["NA_benthos.csv", "one_benthos.csv", "{two}_benthos.csv"]
    for name, c in (("NA", "NA"), ("one", "one"), ("{two}", "{two}")):
        text = (tmp_path / f"{name}_benthos.csv").read_bytes().decode()
        cell = lambda i: '"say \\"x\\",\r\nthen"' if i % 9 == 1 else '""' if i % 9 == 2 else "NA"
        assert text == "campaignid,sample,note\n" + "".join(f"{c},{f's{i:03}' if i else 'NA'},{cell(i)}\n" for i in [*range(1, 100), 0])
