import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import bag
from dotreef.operators import classify, counts
from dotreef.operators.columns import ensure_cols, union_by_name
from dotreef.plans import campaigns as cp
from dotreef.schemas import CLASSIFICATION, CODE, COUNTS, LEVELS
from dotreef.sources import starter_classification


def classes(spark):
    def row(code, l1, l2, l3=None, l4=None, l5=None, family=None, genus=None, species=None):
        return (code, l1, l2, l3, l4, l5, None, None, None, family, genus, species)

    rows = [
        row(1, "Unknown", "Unscorable"), row(2, "Own", "Sessile invertebrates"), row(99900044, "Biota", "Sessile invertebrates"),
        row(10000000, "Biota", "Sponges"), row(80300910, "Biota", "Macroalgae", "Erect fine branching", "Red"),
        row(80300000, "Biota", "Macroalgae"),
        row(54079009, "Biota", "Macroalgae", "Large canopy-forming", "Brown", None, "Lessoniaceae", "Ecklonia", "radiata"),
        row(82001014, "Physical", "Substrate", "Unconsolidated (soft)", "Sand / mud (<2mm)", "Coarse sand (with shell fragments)"),
        row(82003001, "Physical", "Relief", "Flat", None, "0"), row(82003004, "Physical", "Relief", "Low / moderate", "Moderate (1-3m)", "2"),
    ]
    return spark.createDataFrame(rows, CLASSIFICATION)


def dots(spark, campaignid, columns, *rows):
    names = columns.split()
    df = spark.createDataFrame(list(rows), ", ".join(f"{n} string" for n in names))
    return df.withColumn("campaignid", F.lit(campaignid))


@pytest.fixture(scope="module")
def tables(spark):
    walk = spark.createDataFrame([("Sponges", None, "B", 10000000, "Sponges"), ("Dirt", None, None, 1, "Unscorable")],
                                 f"catami_l1 string, catami_l2 string, catami_l3 string, {CODE} bigint, level_2 string")
    words = spark.createDataFrame([("0. Flat", 82003001, "Relief", "0"), ("Unknown", 82003001, "Relief", None)],
                                  f"catami_l5 string, {CODE} bigint, level_2 string, level_5 string")
    l2l3 = spark.createDataFrame([("Sponges", None, None, 10000000), ("Macroalgae > Drift Algae", None, None, 80300000)],
                                 f"catami_l2_l3 string, catami_l4 string, catami_l5 string, {CODE} bigint")
    bmt = spark.createDataFrame([("Sponges", None, None, 10000000, "Sponges")],
                                f"broad string, morphology string, type string, {CODE} bigint, level_2 string")
    meta = spark.createDataFrame(
        [("2021-05_Abrolhos_stereo-BRUVs", "in", -28.0, "Yes"), ("2021-05_Abrolhos_stereo-BRUVs", "out", -27.0, "Yes"),
         ("2020-06_south-west_stereo-BRUVs", "a", -34.0, "Yes"), ("2020-06_south-west_stereo-BRUVs", "unseen", -34.0, "Yes")],
        "campaignid string, sample string, latitude_dd double, successful_count string").withColumns(
        {"successful_length": F.lit("No"), "successful_habitat_forward": F.lit("Yes"), "successful_habitat_backward": F.lit("No")})
    return cp.Tables(classes(spark), meta, {"catami": walk, "relief_text": words, "l2_l3": l2l3, "broad_morphology_type": bmt})


@pytest.fixture(scope="module")
def points(spark):
    """A few dots of every vocabulary."""
    d = lambda *a: dots(spark, *a)
    return union_by_name(
        d("2020-06_south-west_stereo-BRUVs", "filename direction code broad type", ("a.JPG", "forwards", "90300910", None, None),
          ("a.jpg", "backwards", None, "Invertebrate Complex", None), ("a.jpg", "backwards", None, "Open Water", None),
          (None, "forwards", "10000000", None, None)),
        d("2019-08-Ningaloo-deep_stereo-BRUVS", "filename code broad", ("n.JPG", None, "Invertebrate Complex"), ("n.jpg", "10000000", None)),
        d("2020-10_south-west_stereo-BRUVs", "filename direction qualifiers level_2 level_4",
          ("IO333.jpg", "forwards", "10000000", None, None), ("12take 2 .jpg", "forwards", "10000000", None, None),
          ("12.jpg", "backwards", "5", "raw", "Ecklonia radiata"), (None, "forwards", "10000000", None, None)),
        d("2021-03_Geographe_BOSS", "filename code broad", ("p1.jpg", "2", "x"), ("p1.jpg", None, "Invertebrate Complex"), ("p1.jpg", None, None)),
        d("2021-05_Abrolhos_BOSS", "filename qualifiers level_2 level_3 level_4", ("q.jpg", "7", "Sponges", None, None),
          ("q.jpg", "82001014", "x", None, "y"), ("q.jpg", "7", "Unknown", None, None), ("q.jpg", "7", "Macroalgae", "z", "Ecklonia radiata")),
        d("2021-05_Abrolhos_stereo-BRUVs", "filename code morphology", ("in.JPG", "10000000", None), ("out.JPG", "10000000", None),
          ("in.JPG", None, "Bryozoa / Cnidaria Matrix")),
        d("2021-08_PtCloates_stereo-BRUVs", "filename direction x_6", ("PCB1_1.JPG", "forwards", "10000000"), ("PCB18.JPG", "backwards", "10000000")),
        d("2022-05_PtCloates_stereo-BRUVS", "filename direction opcode code", ("zz", "forwards", "7", "10000000"), ("7.JPG", "backwards", None, "10000000")),
        d("2022-11_Investigator_stereo-BRUVs", "opcode level_2 level_3", ("i1", "Sponges", None), ("i1", "Macroalgae > Drift Algae", None), ("i1", "??", None)),
        d("2022-11_Salisbury_stereo-BRUVs", "opcode catami_l2_l3", ("s1", "Sponges"), ("s1", "macroalgae > drift algae"), ("s1", None)),
        d("2022-12_Daw_stereo-BOSS", "filename period level_2 level_3 level_4", ("f", " d1 ", "Macroalgae > Large canopy-forming", "Brown", "Ecklonia radiata"),
          ("f", "d1", "Matrix > Mixed", None, None), ("IO333.jpg", "d1", "Sponges", None, None), (None, "d1", "Sponges", None, None), ("f", "d1", "Sponges", None, None)),
        d("2023-03_SwC_stereo-BRUVs", "filename opcode caab_code", ("g", "k ", "2"), ("g", "k", "10000000")),
        d("2024-04_Geographe_stereo-BRUVs", "opcode level_2 level_3 level_4 scientific", ("w", "Macroalgae", "Large canopy-forming", "Brown", "Ecklonia radiata"), ("w", "Sponges", None, None, None)),
        d("2013-05_Aidans_Hons_pilchards_stereoBRUVs", "filename catami_l1 catami_l3", ("x_left.avi", "Sponges", "B"), ("x_Right.avi", "Sponges", "B"), ("x_left.avi", "Dirt", None)),
        d("Tasman_Fracture_202103", "filename broad", ("CMR_104_x.png", "Sponges")),
    )


WANT = {
    "2020-06_south-west_stereo-BRUVs": [("a", 80300910, 1), ("a", 99900044, 1), (None, 10000000, 1)],
    "2019-08-Ningaloo-deep_stereo-BRUVS": [("n", None, 1), ("n", None, 1)],
    "2020-10_south-west_stereo-BRUVs": [("12", 10000000, 1), ("12", 54079009, 1), (None, 10000000, 1)],
    "2021-03_Geographe_BOSS": [("p1", 2, 1), ("p1", 99900044, 1)],
    "2021-05_Abrolhos_BOSS": [("q", 7, 1), ("q", 10000000, 1), ("q", 54079009, 1), ("q", 82001014, 1)],
    "2021-05_Abrolhos_stereo-BRUVs": [("in", 10000000, 1), ("in", 99900044, 1)],
    "2021-08_PtCloates_stereo-BRUVs": [("PCB1", None, 1), ("PCBP18", None, 1)],
    "2022-05_PtCloates_stereo-BRUVS": [("7", None, 2)],
    "2022-11_Investigator_stereo-BRUVs": [("i1", 10000000, 1), ("i1", 80300000, 1)],
    "2022-11_Salisbury_stereo-BRUVs": [("s1", 10000000, 1)],
    "2022-12_Daw_stereo-BOSS": [("d1", 10000000, 1), ("d1", 54079009, 1)],
    "2023-03_SwC_stereo-BRUVs": [("k", 10000000, 1), ("k", 99900044, 1)],
    "2024-04_Geographe_stereo-BRUVs": [("w", 10000000, 1), ("w", 54079009, 1)],
    "2013-05_Aidans_Hons_pilchards_stereoBRUVs": [("x", 10000000, 1), ("x", 10000000, 1)],
    "Tasman_Fracture_202103": [("104", 10000000, 1)],
}
# Rows of this campaign without any level 2 in the class table are dropped only where NULL is excluded.
WANT["2021-05_Abrolhos_BOSS"] = [("q", 10000000, 1), ("q", 54079009, 1), ("q", 82001014, 1)]


def test_archive_in_one_go(points, tables):
    out = cp.benthos(cp.KNOWN_CAMPAIGNS, points, tables)
    assert out.columns[: len(COUNTS)] == COUNTS.fieldNames()
    got = {}
    for campaign, *rest in bag(out, "campaignid", "sample", CODE, "count"):
        got.setdefault(campaign, []).append(tuple(rest))
    assert got == WANT


def test_archive_equals_campaign_by_campaign(points, tables):
    singles = [cp.benthos([s], points, tables) for s in cp.KNOWN_CAMPAIGNS if s.campaignid in WANT]
    assert bag(union_by_name(*singles), *COUNTS.fieldNames()) == bag(cp.benthos(cp.KNOWN_CAMPAIGNS, points, tables), *COUNTS.fieldNames())


def test_known_code_two_is_biota(points, tables):
    out = cp.benthos([cp.known("2021-03_Geographe_BOSS")], points, tables)
    assert bag(out, CODE, "level_1") == [(2, "Biota"), (99900044, "Biota")]


def test_relief(spark, tables):
    d = lambda *a: dots(spark, *a)
    pts = union_by_name(
        d("2020-06_south-west_stereo-BRUVs", "filename direction relief", ("01.JPG", "forwards", ".0. flat"), ("7.1.JPG", "backwards", ".2. mostly"),
          ("7.1.JPG", "backwards", "Unknown"), ("7.1.JPG", "backwards", None)),
        d("2019-08-Ningaloo-deep_stereo-BRUVS", "filename relief", ("n.JPG", "0. flat"), ("n.JPG", "Unknown")),
        d("2021-05_Abrolhos_BOSS", "filename scientific", ("q.JPG", ".2. x")),
        d("2022-11_Investigator_stereo-BRUVs", "opcode level_5", ("i", "0"), ("i", "0"), ("i", None)),
        d("2024-05_Wudjari_stereo-BRUVs", "opcode level_2 level_3 level_4 level_5", ("w", "Relief", "Flat", None, "0"), ("w", None, None, None, None)),
        d("2023-03_SwC_stereo-BRUVs", "filename opcode level_2 level_3 level_5 caab_code", ("IO333.jpg", " k", "Relief", "Flat", "0", "82003001")),
        d("2013-05_Aidans_Hons_pilchards_stereoBRUVs", "filename catami_l5", ("x_left.avi", "Unknown")),
        d("2012-08_Flinders_CMR_BRUV", "filename catami_l5", ("fl.avi", "Unknown"), ("fl.avi", "0. Flat")),
        d("Tasman_Fracture_202103", "filename relief", ("CMR_104_x.png", "0. Flat")),
        d("2021-08_PtCloates_stereo-BRUVs", "filename x_6", ("PCB1_1.JPG", "82003004")),
    )
    out = cp.relief(cp.KNOWN_CAMPAIGNS, pts, tables)
    assert bag(out, "campaignid", "sample", "level_1", "level_5", CODE, "count") == sorted([
        ("2020-06_south-west_stereo-BRUVs", "01", "Physical", "0", 82003001, 1), ("2020-06_south-west_stereo-BRUVs", "07", "Physical", "2", 82003004, 1),
        ("2019-08-Ningaloo-deep_stereo-BRUVS", "n", "Physical", "0", None, 1), ("2021-05_Abrolhos_BOSS", "q", "Physical", "2", 82003004, 1),
        ("2022-11_Investigator_stereo-BRUVs", "i", "Physical", "0", 82003001, 2), ("2024-05_Wudjari_stereo-BRUVs", "w", "Physical", "0", 82003001, 1),
        ("2023-03_SwC_stereo-BRUVs", "k", "Physical", "0", 82003001, 1), ("2013-05_Aidans_Hons_pilchards_stereoBRUVs", "x", "Physical", "0", 82003001, 1),
        ("2012-08_Flinders_CMR_BRUV", "fl", "Physical", "0", 82003001, 1), ("Tasman_Fracture_202103", "104", "Physical", "0", 82003001, 1),
        ("2021-08_PtCloates_stereo-BRUVs", "PCB1", "Physical", "2", None, 1)], key=lambda t: tuple((x is None, str(x)) for x in t))
    swc = cp.as_upload(cp.known("2023-03_SwC_stereo-BRUVs"), out, "relief")
    assert swc.columns == ["campaignid", "opcode", CODE, *LEVELS[:5], "count"]


def test_upload_names(points, tables):
    spec = cp.known("Tasman_Fracture_202103")
    out = cp.as_upload(spec, cp.benthos([spec], points, tables))
    assert {"sample", "number", "filename"} <= set(out.columns)
    spec = cp.known("2021-08_PtCloates_stereo-BRUVs")
    assert CODE not in cp.as_upload(spec, cp.benthos([spec], points, tables)).columns
    spec = cp.known("2021-03_Geographe_BOSS")
    assert {"period", "count", CODE} <= set(cp.as_upload(spec, cp.benthos([spec], points, tables)).columns)


def test_checks(points, tables):
    specs = [cp.known("2020-06_south-west_stereo-BRUVs"), cp.known("2021-05_Abrolhos_stereo-BRUVs"), cp.known("2020-10_south-west_stereo-BRUVs")]
    found = cp.checks(specs, points, tables)
    assert bag(found["annotations_missing_metadata"], "campaignid", "sample") == [
        ("2020-06_south-west_stereo-BRUVs", None), ("2020-10_south-west_stereo-BRUVs", "12"), ("2020-10_south-west_stereo-BRUVs", "12"),
        ("2020-10_south-west_stereo-BRUVs", None), ("2021-05_Abrolhos_stereo-BRUVs", "out")]
    assert bag(found["metadata_missing_annotations"], "sample") == [("unseen",)]
    assert bag(found["wrong_point_counts"], "sample", "points_annotated", "expected") == [("a", 3, 20), ("in", 2, 20)]
    assert found["unmatched_codes"].count() == 0
    assert bag(found["presence_diff"].filter("campaignid like '2020-06%'"), "sample", "in_habitat") == [("unseen", None), (None, True)]
    assert bag(found["metadata_missing_relief"], "sample") == [("a",), ("in",), ("unseen",)]
    assert {"relief_missing_metadata", "unmatched_relief", "coverage"} <= set(found)


def test_expected_dots_follow_the_campaign(spark, tables):
    ids = ["2020-06_south-west_stereo-BRUVs", "2020-10_south-west_stereo-BRUVs", "2021-03_Geographe_BOSS"]
    pts = union_by_name(
        dots(spark, ids[0], "filename code", *[("a.JPG", "10000000")] * 40), dots(spark, ids[1], "filename qualifiers", *[("a.jpg", "10000000")] * 40),
        dots(spark, ids[2], "filename code", *[("a.jpg", "10000000")] * 40))
    meta = spark.createDataFrame([(c, "a", -34.0, "Yes", "Yes", "Yes", "No") for c in ids], "campaignid string, sample string, latitude_dd double, "
        "successful_count string, successful_length string, successful_habitat_forward string, successful_habitat_backward string")
    found = cp.checks([cp.known(c) for c in ids], pts, cp.Tables(tables.schema, meta, tables.crosswalks))
    assert bag(found["wrong_point_counts"], "campaignid", "points_annotated", "expected") == [(ids[0], 40, 20), (ids[2], 40, 80)]


def test_unscorable_deployments_are_reported(spark, tables):
    pts = dots(spark, "2020-06_south-west_stereo-BRUVs", "filename code", ("a.JPG", "1"), ("unseen.JPG", "10000000"))
    found = cp.checks([cp.known("2020-06_south-west_stereo-BRUVs")], pts, tables)
    assert bag(found["metadata_missing_annotations"], "sample") == [("a",)]


def test_class_checks_use_the_vocabulary(points, tables):
    every = [s for s in cp.KNOWN_CAMPAIGNS if s.campaignid in WANT]
    found = cp.checks(every, points, tables)
    missing = {(r["campaignid"], r["catami_l2_l3"] or r["level_2"] or r["catami_l1"] or r["broad"]) for r in found["missing_codes"].collect()}
    assert ("2022-11_Investigator_stereo-BRUVs", "??") in missing
    assert not {m for m in missing if m[0] in ("2024-04_Geographe_stereo-BRUVs", "2013-05_Aidans_Hons_pilchards_stereoBRUVs", "Tasman_Fracture_202103")}
    unmatched = {(r["campaignid"], r[CODE]) for r in found["unmatched_codes"].collect()}
    assert ("2021-05_Abrolhos_BOSS", 10000000) not in unmatched


def test_kinds_share_one_store(spark, tables, points):
    """Both exports of a campaign in one table: neither output counts the other's dots."""
    spec = [cp.known("2021-08_PtCloates_stereo-BRUVs"), cp.known("2024-04_Geographe_stereo-BRUVs"), cp.known("2023-03_SwC_stereo-BRUVs")]
    d = lambda *a: dots(spark, *a)
    benthos_side = points.filter(F.col("campaignid").isin([s.campaignid for s in spec])).withColumn("kind", F.lit("benthos"))
    relief_side = union_by_name(
        d(spec[0].campaignid, "filename x_6", ("PCB1_1.JPG", "82003004")),
        d(spec[1].campaignid, "opcode level_2 level_3 level_5", ("w", "Relief", "Flat", "0")),
        d(spec[2].campaignid, "filename opcode level_2 level_3 level_5 caab_code", ("g", "k", "Relief", "Flat", "0", "82003001"))).withColumn("kind", F.lit("relief"))
    store = union_by_name(benthos_side, relief_side)
    benthos = cp.benthos(spec, store, tables)
    assert benthos.filter("level_2 = 'Relief'").count() == 0
    assert bag(benthos, "campaignid", "sample", CODE, "count") == sorted(
        [(s.campaignid, *row) for s in spec for row in WANT[s.campaignid]], key=lambda t: tuple((x is None, str(x)) for x in t))
    relief = cp.relief(spec, store, tables)
    assert relief.filter("level_2 <> 'Relief'").count() == 0 and relief.count() == 3


def test_count_matrix_campaign(spark, tables):
    campaign = "2014-12_Geographe-bay_stereo-BRUVs"
    matrix = spark.createDataFrame(
        [("s1", "old", "3", "0", "2"), ("s2", "old", "1", None, None), ("gone", "old", "9", "1", "1")],
        "sample string, campaignid string, biota_sponges string, biota_worms string, relief_0_flat_substrate_sandy_rubble_with_few_features_0_substrate_slope string")
    meta = tables.metadata.unionByName(spark.createDataFrame([(campaign, "s1"), (campaign, "s2")], "campaignid string, sample string"), True)
    own = cp.Tables(tables.schema, meta, tables.crosswalks, {campaign: matrix})
    none = spark.createDataFrame([], "campaignid string, filename string")
    assert bag(cp.benthos([cp.known(campaign)], none, own), "campaignid", "sample", CODE, "count") == [
        (campaign, "s1", 10000000, 3), (campaign, "s2", 10000000, 1)]
    assert bag(cp.relief([cp.known(campaign)], none, own), "campaignid", "sample", CODE, "count") == [(campaign, "s1", 82003001, 2)]


def test_one_plan_per_vocabulary_not_per_campaign(points, tables):
    raw = ensure_cols(points, cp.RAW_COLUMNS)
    same = [s for s in cp.KNOWN_CAMPAIGNS if s.vocabulary == "scientific"]
    plan = cp.benthos(same, raw, tables)._jdf.queryExecution().optimizedPlan().toString()
    alone = cp.benthos(same[:1], raw, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == alone.count("Aggregate")


# --- all findings from one fold, rules as a table --------------------------------------------


def as_rows(df, finding, extra=()):
    """What ``checks`` gives, in the columns of ``findings``."""
    n = {"annotations_missing_metadata": "count", "relief_missing_metadata": "count", "metadata_missing_annotations": "count", "metadata_missing_relief": "count"}
    if finding in n:
        return [(finding, *r) for r in bag(counts.tally(df, ["campaignid", "sample"], name="n"), "campaignid", "sample", "n")]
    return [(finding, *r) for r in bag(df, "campaignid", "sample", "points_annotated")]


def test_findings_equal_the_checks(spark):
    import __spark_entry__ as entry  # noqa: F401
    from dotreef.plans import frames as fr

    d = "/root/testdata/sf0.001"
    between = cp.SampleRule(steps=[("extract", "(?<=_)[0-9]+(?=_)")])
    specs = [cp.CampaignSpec(f"survey-{i}", sample=between, points_per_image=i % 3 + 1, only_successful=i % 2 == 0, relief=None if i == 4 else cp.ReliefSpec(),
                             exclude_files=("img_1_1.JPG",) if i == 1 else (), one_export=i == 3) for i in range(1, 8)]
    pts = fr.points(spark, d).filter("sample % 5 <> 0").select(
        "campaignid", "direction", "filename", "broad", "morphology", "type", "relief", F.col(CODE).cast("string").alias("code"),
        F.when(F.col("broad") == "Sponges", "relief").otherwise("benthos").alias("kind"),
    )
    classes = fr.classes(spark, d).unionByName(starter_classification(spark).filter("level_2 = 'Relief'"), allowMissingColumns=True)
    meta = fr.metadata(spark, d).filter("sample % 7 <> 0").withColumn("sample", F.col("sample").cast("string"))
    tables = cp.Tables(classes, meta.union(meta.filter("sample % 11 = 0")))
    old, new = cp.checks(specs, pts, tables), cp.findings(specs, pts, tables).cache()
    for finding in ("annotations_missing_metadata", "metadata_missing_annotations", "relief_missing_metadata", "metadata_missing_relief", "wrong_point_counts"):
        want = as_rows(old[finding], finding)
        assert bag(new.filter(F.col("finding") == finding), "finding", "campaignid", "sample", "n") == want and want, finding
    for side, finding in (("in_habitat", "in_habitat_only"), ("in_metadata", "in_metadata_only")):
        want = bag(old["presence_diff"].filter(F.col(side)), "campaignid", "sample")
        assert bag(new.filter(F.col("finding") == finding), "campaignid", "sample") == want
    for finding in ("missing_codes", "unmatched_codes"):
        assert new.filter(F.col("finding") == finding).count() == old[finding].count() > 0
    for kind in ("relief", "benthos"):
        want = bag(old["coverage"].filter(f"{kind}_sample IS NOT NULL"), "campaignid", f"{kind}_sample")
        assert bag(new.filter(F.col("finding") == f"samples_with_{kind}"), "campaignid", "n") == want


def test_findings_fold_away_images_that_no_campaign_reads(spark):
    """Image and camera are no keys of the fold where nothing depends on them, and stay where one campaign looks at them; the findings are the same."""
    rows = [(c, "forwards" if i % 2 else "backwards", f"{o}_{i}.jpg", o, "80300902" if i % 3 else None, "Sponges", "Erect", None, ".1. flat") for c in "ab" for o in ("x", "y", None) for i in range(6)]
    dots = spark.createDataFrame(rows, "campaignid string, direction string, filename string, opcode string, code string, broad string, morphology string, type string, relief string")
    meta = spark.createDataFrame([(c, o, "Yes", "Yes", "Yes", "No", -30.0) for c in "ab" for o in ("x", "z")],
                                 "campaignid string, sample string, successful_count string, successful_length string, successful_habitat_forward string, successful_habitat_backward string, latitude_dd double")
    tables = cp.Tables(starter_classification(spark), meta)
    plain = [cp.CampaignSpec(c, sample=cp.SampleRule("opcode", ())) for c in "ab"]
    looking = [plain[0], replace(plain[1], exclude_files=("no such image",))]
    keys = lambda df: [k for k in ("filename", "direction") if re.search(rf"Aggregate \[[^]]*\b{k}#", df._jdf.queryExecution().optimizedPlan().toString())]
    pruned, whole = cp.findings(plain, dots, tables), cp.findings(looking, dots, tables)
    assert keys(pruned) == [] and keys(whole) == ["filename", "direction"]
    assert bag(pruned) == bag(whole) and bag(pruned)
    for s in cp.KNOWN_CAMPAIGNS:
        assert cp._reads_images(s) == (s.campaignid not in ("2014-12_Geographe-bay_stereo-BRUVs", "2024-04_Geographe_stereo-BRUVs", "2024-05_Wudjari_stereo-BRUVs"))


def test_findings_of_every_vocabulary_scan_the_dots_once(spark, tmp_path):
    """All known campaigns at once: the same findings as campaign by campaign, one scan."""
    rows = []
    for s in cp.KNOWN_CAMPAIGNS:
        for i in range(6):
            rows.append((s.campaignid, "forwards" if i % 2 else "backwards", f"{i}_7_x.jpg", f"op{i}", f"op{i}", str(80300902 + i), "Sponges", "Erect", None, f".{i}. flat", "Macroalgae", None))
    names = "campaignid string, direction string, filename string, opcode string, period string, code string, broad string, morphology string, type string, relief string, level_2 string, level_5 string"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "dots"))
    dots = spark.read.parquet(str(tmp_path / "dots"))
    walk = {name: spark.createDataFrame([], ", ".join(f"{k} string" for k in keys) + f", {CODE} bigint, level_2 string, level_5 string")
            for name, keys in {"catami": ["catami_l1", "catami_l2", "catami_l3", "catami_l4", "catami_l5"], "broad_morphology_type": ["broad", "morphology", "type"],
                               "l2_l3": ["catami_l2_l3", "catami_l4", "catami_l5"]}.items()}
    walk["relief_text"] = spark.createDataFrame([], f"catami_l5 string, {CODE} bigint, level_2 string, level_5 string")
    meta = spark.createDataFrame([(s.campaignid, f"op{i}", "Yes", "Yes", "Yes", "Yes", -30.0) for s in cp.KNOWN_CAMPAIGNS for i in range(4)],
                                 "campaignid string, sample string, successful_count string, successful_length string, successful_habitat_forward string, successful_habitat_backward string, latitude_dd double")
    tables = cp.Tables(starter_classification(spark), meta, walk)
    found = cp.findings(cp.KNOWN_CAMPAIGNS, dots, tables)
    together = bag(found)
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    import re

    assert len(re.findall(r"FileScan parquet[^\n]*dots", plan)) == 1
    one_by_one = []
    for s in cp.KNOWN_CAMPAIGNS:
        if s.vocabulary != "wide":
            one_by_one += [tuple(r) for r in cp.findings([s], dots, tables).collect()]
    # Class labels join the columns that all campaigns of a family use.
    plain = lambda rows: sorted(str(tuple(x for i, x in enumerate(r) if i != 3)) for r in rows)
    assert plain(together) == plain(one_by_one) and together


def test_a_thousand_campaigns_with_ten_rules_each(spark):
    import random

    rng = random.Random(5)
    labels = [f"label {i}" for i in range(12)]
    rules = lambda: tuple(classify.Rule(rng.choice(["broad", "type"]), (rng.choice([*labels, None]),), rng.randint(1, 99), rng.random() < 0.2) if rng.random() < 0.8
                          else classify.Rule(CODE, (rng.randint(1, 9), None), rng.randint(1, 99)) for _ in range(10))
    specs = [cp.CampaignSpec(f"c{i}", sample=cp.SampleRule("opcode", ()), rules=rules(), relief=None) for i in range(1000)]
    dots = spark.createDataFrame([(f"c{rng.randint(0, 999)}", f"o{rng.randint(0, 2)}", rng.choice([*labels, None]), rng.choice(labels), rng.choice([None, "5", "x", "17"])) for _ in range(3000)],
                                 "campaignid string, opcode string, broad string, type string, code string")
    schema = spark.createDataFrame([(i, "Biota", f"class {i}") for i in range(1, 100)], f"{CODE} bigint, level_1 string, level_2 string")
    keys = ["campaignid", "sample", CODE]

    def by_hand(row):
        try:
            code = int(row["code"])
        except (TypeError, ValueError):
            code = None
        for r in specs[int(row["campaignid"][1:])].rules:
            if (code if r.column == CODE else row[r.column]) in r.values and (code is None or not r.only_if_null):
                return r.code
        return code

    want = Counter((r["campaignid"], r["opcode"], by_hand(r)) for r in dots.collect())
    table = cp.prepare(specs, dots)
    assert {tuple(r)[:3]: r["count"] for r in counts.tally(table, keys).collect()} == want
    some = specs[:20]
    few = lambda sets: bag(counts.tally(cp.prepare(some, dots, rule_sets=sets), keys), *keys, "count")
    assert few(1) == few(1000) == bag(counts.tally(table.filter(F.col("campaignid").isin([s.campaignid for s in some])), keys), *keys, "count")
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().numberedTreeString().split("\n"))
    assert size(table) == size(cp.prepare(specs[:40], dots))
    found = {tuple(r): n for *r, n in bag(cp.benthos(specs, dots, cp.Tables(schema)), "campaignid", "sample", CODE, "count")}
    assert found == {k: n for k, n in want.items() if k[2] is not None and 1 <= k[2] < 100}


def test_campaigns_that_agree_share_a_branch():
    specs = [cp.CampaignSpec(f"c{i}", code_from="code" if i % 2 else "x_6") for i in range(50)]
    chain = str(cp.per_campaign(specs, lambda s: F.col(s.code_from), lambda s: s.code_from))
    assert chain.count("WHEN") == 2 and "CASE" not in str(cp.per_campaign(specs[::2], lambda s: F.col(s.code_from), lambda s: s.code_from))


# --- fixed values: headers of finished uploads ------------------------------------------------
UPLOADS = {
    ("2012-08_Flinders_CMR_BRUV", "relief"): "campaignid,sample,caab_code,number,level_1,level_2,level_3,level_4,level_5,level_6,level_7,level_8,family,genus,species",
    ("2013-05_Aidans_Hons_pilchards_stereoBRUVs", "benthos"): "campaignid,sample,caab_code,number,level_1,level_2,level_3,level_4,level_5,level_6,level_7,level_8,family,genus,species",
    ("2013-05_Aidans_Hons_pilchards_stereoBRUVs", "relief"): "campaignid,sample,caab_code,number,level_1,level_2,level_3,level_4,level_5,level_6,level_7,level_8,family,genus,species",
    ("2021-05_Abrolhos_stereo-BRUVs", "relief"): "campaignid,opcode,level_1,level_5,level_2,level_3,level_4,level_6,level_7,level_8,family,genus,species,caab_code,count",
    ("2021-05_PtCloates_stereo-BRUVS", "relief"): "campaignid,sample,level_1,level_5,level_2,level_3,level_4,level_6,level_7,level_8,family,genus,species,count",
    ("2022-11_Investigator_stereo-BRUVs", "relief"): "campaignid,opcode,level_5,count,caab_code,level_1,level_2,level_3,level_4,level_6,level_7,level_8,family,genus,species",
    ("2023-03_SwC_stereo-BRUVs", "relief"): "campaignid,opcode,level_1,level_2,level_3,level_4,level_5,caab_code,count",
}


@pytest.mark.parametrize("campaignid,kind", list(UPLOADS))
def test_uploads_have_the_columns_of_finished_ones(spark, campaignid, kind):
    out = cp.as_upload(cp.known(campaignid), spark.createDataFrame([], COUNTS).withColumn("filename", F.lit("x")), kind)
    assert set(out.columns) == set(UPLOADS[campaignid, kind].split(",")), set(out.columns) ^ set(UPLOADS[campaignid, kind].split(","))


def test_rules_as_rows_meet_dots_where_they_lie(spark, tmp_path):
    from dotreef.operators import classify

    rules = {"a": [classify.Rule("broad", ("x", None), 1), classify.Rule("type", ("t",), 2, only_if_null=True), classify.Rule(CODE, (7,), 3)], "b": [classify.Rule("type", ("t",), 4)]}
    rows = [(c, b, t, n) for c in ("a", "b", None) for b in ("x", "y", None) for t in ("t", None) for n in (5, 7, None)]
    spark.createDataFrame(rows * 2, f"campaignid string, broad string, type string, {CODE} bigint").write.parquet(str(tmp_path / "dots"))
    out = classify.repair_by_table(spark.read.parquet(str(tmp_path / "dots")), classify.rule_table(spark, rules), ["broad", "type"])

    def by_hand(c, b, t, n):
        if c == "a":
            return 1 if b in ("x", None) else 2 if t == "t" and n is None else 3 if n == 7 else n
        return 4 if c == "b" and t == "t" else n

    assert bag(out) == bag(spark.createDataFrame([(c, b, t, by_hand(c, b, t, n)) for c, b, t, n in rows * 2], out.schema))
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "SortMergeJoin" not in plan
