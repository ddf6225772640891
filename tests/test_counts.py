import random
from collections import Counter

import pytest

from conftest import bag
from dotreef.operators import classify, counts, qc
from dotreef import fixed
from dotreef.schemas import CLASSIFICATION, CODE, LABELS, LEVELS
from dotreef.sources import starter_classification


def class_rows(*rows):
    """(code, level_1, level_2, level_3[, genus, species]) to full rows."""
    out = []
    for r in rows:
        code, l1, l2, l3, genus, species = (*r, *[None] * (6 - len(r)))
        out.append((code, l1, l2, l3, *[None] * 5, None, genus, species))
    return out


@pytest.fixture
def schema(spark):
    rows = class_rows(
        (1, "Unknown", "Unscorable", None), (10, "Biota", "Sponges", None), (11, "Biota", "Sponges", "Erect"),
        (11, "Biota", "Sponges", "Erect"), (12, "Biota", "", None), (13, "Biota", "Cnidaria", None),
        (14, "Biota", "Cnidaria", None), (13, "Biota", "Hydroids", None), (None, "Physical", "Substrate", None),
    )
    return spark.createDataFrame(rows, CLASSIFICATION)


@pytest.fixture
def dots(spark):
    """One sample and one class hold more than a third of all rows; keys are NULL too."""
    rnd = random.Random(3)
    rows = [("c1", "hot", 10)] * 150
    rows += [("c1", rnd.choice(["a", "b", None]), rnd.choice([1, 10, 11, 12, 13, 14, 99, None])) for _ in range(200)]
    return spark.createDataFrame(rows, f"campaignid string, sample string, {CODE} bigint"), rows


@pytest.mark.parametrize("with_code", [True, False])
def test_label_counts_equal_the_row_by_row_join(dots, schema, with_code):
    points, rows = dots
    table = [tuple(r) for r in schema.collect()]
    want = Counter()
    for campaign, sample, code in rows:
        for c in [c for c in table if c[0] == code]:
            if c[2] not in ("", "Unscorable", None):
                want[(campaign, sample, *c[1:], *([code] if with_code else []))] += 1
    got = classify.counts_by_code(points, schema, ["campaignid", "sample"], with_code=with_code)
    names = ["campaignid", "sample", *LABELS, *([CODE] if with_code else []), "count"]
    assert Counter({tuple(r)[:-1]: r["count"] for r in got.select(*names).collect()}) == want


def test_sum_of_counts_is_the_number_of_kept_dots(dots, schema):
    points, rows = dots
    unique = classify.schema_by_path(schema).filter("caab_code != 13")
    kept = sum(1 for r in rows if r[2] in (10, 11))
    got = classify.counts_by_code(points, unique, ["campaignid", "sample"]).filter("level_2 = 'Sponges'")
    assert got.groupBy().sum("count").first()[0] == kept


def test_union_order_does_not_matter(dots, schema):
    points, _ = dots
    a, b = points.filter("sample = 'hot'"), points.filter("sample is null or sample <> 'hot'")
    one = classify.counts_by_code(a.unionByName(b), schema, ["campaignid", "sample"])
    two = classify.counts_by_code(b.unionByName(a), schema, ["campaignid", "sample"])
    assert bag(one) == bag(two)


def test_small_aggregates(frame):
    df = frame("g string, s string, v int", ("x", None, None), ("x", "a", 2), ("x", None, 3), ("y", None, None), (None, "a", 1))
    assert bag(counts.tally(df, ["g"])) == [("x", 3), ("y", 1), (None, 1)]
    assert bag(counts.sum_na_rm(df, ["g"], "v")) == [("x", 5), ("y", 0), (None, 1)]
    assert bag(counts.distinct_per_group(df, ["g"], "s", "n")) == [("x", 2), ("y", 1), (None, 1)]


def test_first_by_takes_null_last_and_whole_rows(frame):
    df = frame("l string, code int, w string", ("a", None, "n"), ("a", 5, "five"), ("a", 3, "three"), (None, 9, None), (None, 9, "z"))
    assert bag(counts.first_by(df, ["l"], "code")) == [("a", 3, "three"), (None, 9, None)]


def test_coverage(frame):
    relief = frame("campaignid string, sample string", ("c", "1"), ("c", "1"), ("c", None), ("only-r", "1"))
    benthos = frame("campaignid string, sample string", ("c", "2"), ("b", "9"))
    assert bag(counts.coverage_summary(relief, benthos)) == [("b", None, 1), ("c", 2, 1), ("only-r", 1, None)]
    assert bag(counts.class_coverage(relief, benthos, ["campaignid"])) == [("b", None, 1), ("c", 3, 1), ("only-r", 1, None)]


def test_wide(frame):
    wide = frame("opcode string, campaignid string, biota_sponges string, biota_consolidated string, relief_3_good_relief_structure_with_some_overhangs_45_substrate_slope_ string",
                 ("o1", "c", "3", "0", "2"), ("o2", "c", None, "x", "1"), ("o3", "c", "5", "7", "0"))
    spark = wide.sparkSession
    meta = frame("campaignid string, opcode string", ("c", "o1"), ("c", "o2"))
    long = counts.wide_to_long(wide, "biota_", ["campaignid", "opcode"], "category")
    assert bag(long)[2:4] == [("c", "o2", "biota_consolidated", None), ("c", "o2", "biota_sponges", None)]
    starter = starter_classification(spark)
    got = classify.wide_to_counts(wide, starter, meta)
    assert bag(got, "opcode", "level_1", "level_2", CODE, "count") == [("o1", "Biota", "Sponges", 10000000, 3.0)]
    rel = classify.wide_relief(wide, starter, meta)
    assert bag(rel, "opcode", "level_5", CODE, "count") == [("o1", "3", 82003006, 2.0), ("o2", "3", 82003006, 1.0)]


# --- repair and labels ---------------------------------------------------------------------


def test_repair_rules_in_order(frame):
    df = frame(
        f"broad string, morphology string, type string, {CODE} bigint",
        ("Open Water", None, "Ecklonia radiata", 5), ("Invertebrate Complex", None, None, None),
        ("Sessile invertebrates", None, None, 2), (None, "Bryozoa / Cnidaria Matrix", None, 7),
        (None, None, "Ecklonia radiata", 1), (None, None, "Thalassodendrum sp.", None), (None, None, None, 90300910),
        (None, None, None, 123), (None, None, None, None),
    )
    out = classify.repair_codes(df, classify.repair_rules(matrix=True))
    assert [r[CODE] for r in out.collect()] == [1, 99900044, 99900044, 99900044, 54079009, 63618905, 80300910, 123, None]
    again = classify.repair_codes(out, classify.repair_rules(matrix=True))
    assert [r[CODE] for r in again.collect()] == [r[CODE] for r in out.collect()]
    old = classify.repair_codes(df, classify.repair_rules(invertebrate=2, spelled_out=False, kind=None))
    assert [r[CODE] for r in old.collect()] == [1, 2, 2, 7, 1, None, 90300910, 123, None]


def test_fill_only_where_missing(frame):
    df = frame(f"broad string, {CODE} bigint", ("Invertebrate Complex", None), ("Invertebrate Complex", 5), (None, 90300910), (None, None))
    out = classify.repair_codes(df, classify.mistyped_then_missing())
    assert [r[CODE] for r in out.collect()] == [99900044, 5, 80300910, None]


def test_realign(frame):
    names = "level_2 string, level_3 string, level_4 string, level_5 string"
    df = frame(
        names, ("Macroalgae > Large canopy-forming", "Brown", "Ecklonia radiata", None),
        ("Substrate > Unconsolidated (soft)", "Sand", "Fine", "old5"), ("Matrix > A > B", "x", None, None),
        ("Unscorable", None, None, None), (None, "l3", None, None), ("Sponges", None, None, None),
    )
    out = classify.realign_hierarchy(df)
    assert bag(out, *LEVELS[:5]) == sorted([
        ("Biota", "Macroalgae", "Large canopy-forming", "Brown", "Ecklonia radiata"),
        ("Physical", "Substrate", "Unconsolidated (soft)", "Sand", "Fine"),
        ("Matrix", "A > B", "x", None, None), ("Unscorable", None, None, None, None), (None, None, "l3", None, None),
        ("Biota", "Sponges", None, None, None)], key=lambda t: tuple((x is None, str(x)) for x in t))


def test_harmonise(frame):
    df = frame(
        "id int, level_2 string, level_3 string, level_4 string",
        (1, "Invertebrate Complex", "Complex 1", "x"), (2, "Macroalgae", "Drift", "Ecklonia radiata"),
        (3, "Macroalgae", "Erect course branching", None), (4, "Consolidated", None, "Veneer"), (5, None, "a", "b"),
        (6, "Unknown", None, "c"),
    )
    out = classify.harmonise_labels(df)
    assert bag(out, "id", "level_1", "level_2", "level_3", "level_4", "genus") == [
        (1, "Biota", "Sessile invertebrates", None, "x", None), (2, "Biota", "Macroalgae", None, "Brown", "Ecklonia"),
        (3, "Biota", "Macroalgae", "Erect coarse branching", None, None), (4, "Biota", "Consolidated", None, None, None),
        (5, None, None, "a", "b", None), (6, "Unknown", "Unknown", None, "c", None)]


def test_flat_fill_and_overlay(spark, frame):
    df = frame(
        f"level_1 string, level_2 string, level_3 string, level_4 string, genus string, species string, {CODE} bigint",
        ("Biota", "Sponges", None, None, None, None, 5), ("Biota", "Sponges", None, "x", None, None, 90300910),
        ("Biota", "Macroalgae", None, None, "Ecklonia", "radiata", 5), ("Biota", "Nothing", None, None, None, None, None),
    )
    out = classify.flat_code_fill(df, starter_classification(spark))
    assert bag(out, "level_2", "level_4", CODE) == [
        ("Macroalgae", None, 54079009), ("Nothing", None, None), ("Sponges", "x", 80300910), ("Sponges", None, 10000000)]
    table = frame(f"{CODE} bigint, level_1 string, level_3 string, level_5 string", (10000000, None, "Cups", "new"))
    over = classify.overlay_labels(out, table)
    assert bag(over.filter(f"{CODE} = 10000000"), "level_1", "level_3", "level_5") == [("Biota", "Cups", "new")]


def test_taxonomy_fill_may_fan_out(spark, frame):
    rows = class_rows((7, "Biota", "Macroalgae", None, "Ecklonia", "radiata"), (8, "Biota", "Macroalgae", None, "Ecklonia", "radiata"))
    schema = spark.createDataFrame(rows, CLASSIFICATION)
    df = frame(f"{CODE} bigint, family string, genus string, species string", (None, None, "Ecklonia", "radiata"), (3, None, "Other", None))
    assert bag(classify.taxonomy_fill(df, schema), CODE) == [(3,), (7,), (8,)]


def test_relief_digit(frame):
    df = frame("relief string", (".2. text",), ("2. text",), ("Unknown",), (None,))
    assert bag(classify.relief_digit(df, 2), "level_5") == [(".",), ("2",)]
    assert bag(classify.relief_digit(df, 1, drop=None), "level_5") == [(".",), ("2",), ("U",)]


def test_scientific(spark, frame):
    schema = spark.createDataFrame(class_rows((7, "Biota", "Algae", None, "Ecklonia", "radiata"), (8, "Biota", "Algae", None)), CLASSIFICATION)
    df = frame("sample string, level_2 string, level_3 string, level_4 string, level_5 string, scientific string",
               ("s", "Algae", None, None, None, "Ecklonia radiata"), ("s", "Algae", None, None, None, "Ecklonia radiata"),
               ("s", "Algae", None, None, None, None), ("s", "Unscorable", None, None, None, None))
    assert bag(classify.scientific_counts(df, schema, ["sample"]), "genus", CODE, "count") == [("Ecklonia", 7, 2), (None, 8, 1)]


def test_relabel_restores_every_code_of_a_label(dots, schema, frame):
    walk = frame(f"k string, {CODE} bigint", ("x", 13), ("x", 13), (None, 10))
    pts = frame("campaignid string, sample string, k string", ("c", "s", "x"), ("c", "s", "x"), ("c", "s", None), ("c", "s", "?"))
    out = classify.counts_with_relabel(pts, walk, schema, ["k"])
    # 13 has two label rows, one of them shared with 14; unknown classes meet the class without a code.
    assert bag(out, "level_2", CODE, "count") == [
        ("Cnidaria", 13, 2), ("Cnidaria", 14, 2), ("Hydroids", 13, 2), ("Sponges", 10, 1), ("Substrate", None, 1)]


# --- checks --------------------------------------------------------------------------------


def test_point_checks(frame):
    pts = frame("sample string, code string", *[("a", "1")] * 4, *[("b", "x")] * 3, ("c", None), (None, "2"))
    meta = frame(
        "sample string, successful_habitat_forward string, successful_habitat_backward string, successful_count string, successful_length string",
        ("a", "Yes", "Yes", "Yes", "No"), ("b", "Yes", "No", "No", "No"), ("c", None, "Yes", "Yes", "Yes"),
        ("d", "No", "No", "No", "Yes"), ("e", "No", "No", "No", None))
    assert bag(qc.wrong_point_counts(pts, meta, 2, on=["sample"]), "sample", "points_annotated", "expected") == [("b", 3, 2)]
    assert bag(qc.points_per_sample(pts, meta, ["sample"]), "sample", "points_annotated") == [("a", 4), ("b", 3), ("c", 1), (None, 1)]
    assert bag(qc.annotations_missing_metadata(pts, meta, ["sample"]), "sample") == [(None,)]
    assert bag(qc.metadata_missing_annotations(meta, pts, ["sample"]), "sample") == [("d",), ("e",)]
    assert bag(qc.metadata_missing_annotations(meta, pts, ["sample"], only_successful=True), "sample") == [("d",)]
    assert bag(qc.unparseable_codes(pts, "code")) == [("x",), (None,)]
    assert bag(qc.unique_values(pts, "sample")) == [("a",), ("b",), ("c",)]
    report = qc.qc_report({"none": meta.filter("false"), "some": meta})
    assert bag(report) == [("none", 0), ("some", 5)]


def test_class_checks(frame, schema):
    pts = frame(f"broad string, {CODE} bigint", ("s", 10), ("s", 10), ("t", 99), (None, None))
    assert bag(qc.missing_codes(pts, ["broad"])) == [(None,)]
    assert bag(qc.unmatched_classes(pts, schema, ["broad", CODE], "level_1", [CODE])) == [("t", 99)]
    assert bag(qc.missing_in_schema(pts, schema)) == [("t", 99)]
    assert bag(qc.distinct_classes(pts, ["broad"])) == [("s",), ("t",), (None,)]
    assert bag(qc.schema_browse(schema, ["level_2", CODE], level_1="Biota"))[0] == ("", 12)
    assert bag(qc.profile(pts)) == [("broad", 4, 3), (CODE, 4, 3)]


# --- known outputs, backwards ----------------------------------------------------------------

# Rows of known relief tables: sample, score, count.
KNOWN_RELIEF = [("1", "1", 6), ("1", "2", 8), ("1", "3", 6), ("10", "0", 20), ("npz6.13", "1", 6), ("npz6.13", "2", 6)]


def test_known_relief_counts_survive_being_taken_apart(spark, frame):
    dots = [("c", s, f".{score}. sentence") for s, score, n in KNOWN_RELIEF for _ in range(n)]
    scored = classify.relief_digit(frame("campaignid string, sample string, relief string", *dots), 2)
    out = classify.relief_counts(scored, starter_classification(spark), ["campaignid", "sample"])
    assert bag(out, "sample", "level_5", "count") == sorted(KNOWN_RELIEF)
    labels = {r["level_5"]: (r[CODE], r["level_3"], r["level_4"]) for r in out.collect()}
    assert labels["0"] == (82003001, "Flat", None) and labels["2"] == (82003004, "Low / moderate", "Moderate (1-3m)")


def test_starter_has_one_class_per_code(spark):
    starter = starter_classification(spark)
    assert starter.select(CODE).distinct().count() == starter.count()
    assert starter.filter("level_3 = ''").count() == 1 and len(fixed.RELIEF_CLASSES) == 7
