"""The benchmark tables seen as habitat data.

``lineitem`` plays the dots, ``part`` the class table, ``orders`` the sample metadata. Each frame
has its SQL twin in ``dotreef.plans.frames_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CLASSIFICATION, CODE, LEVELS
from ..sources.dimensions import literal_table, starter_classification


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null():
    return F.lit(None).cast("string")


def _pick(column: str, options: dict, default=None):
    chain = F
    for value, result in options.items():
        chain = chain.when(F.col(column) == value, F.lit(result))
    return chain.otherwise(_null() if default is None else F.lit(default))


def campaign(key: str):
    """A few campaigns of uneven size: the first digit of the key."""
    return F.concat(F.lit("survey-"), F.substring(F.col(key).cast("string"), 1, 1))


def points(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    number, flag = F.col("l_linenumber"), F.col("l_returnflag")
    return li.select(
        campaign("l_orderkey").alias("campaignid"),
        F.col("l_orderkey").alias("sample"),
        F.concat(
            F.lit("img_"), F.col("l_orderkey").cast("string"), F.lit("_"), number.cast("string"),
            _pick("l_linestatus", {"F": ".JPG"}, ".jpg"),
        ).alias("filename"),
        F.when(~((flag == "N") & (number == 7)), F.col("l_partkey")).alias(CODE),
        _pick("l_linenumber", {1: "Open Water", 2: "Invertebrate Complex", 3: "Sessile invertebrates", 5: "Sponges",
                               6: "Sponges", 7: "Sponges"}).alias("broad"),
        F.when((flag == "R") & (number == 5), F.lit("Bryozoa / Cnidaria Matrix")).otherwise(flag).alias("morphology"),
        F.when((number == 6) & (flag == "A"), F.lit("Ecklonia radiata"))
        .when((number == 6) & (flag == "N"), F.lit("Thalassodendrum sp.")).alias("type"),
        _pick("l_linestatus", {"F": "forwards"}, "backwards").alias("direction"),
        F.when(F.col("l_tax") > 0.06, _null()).when(number == 7, F.lit("Unknown"))
        .otherwise(F.concat(F.lit("."), (number - 1).cast("string"), F.lit(". relief"))).alias("relief"),
    )


# Known classes that the repaired codes lead to.
EXTRA_CLASSES = [
    (99900044, "Biota", "Sessile invertebrates"),
    (54079009, "Biota", "Macroalgae"),
    (63618905, "Biota", "Seagrasses"),
]


def classes(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    own = F.col("p_brand") != "Brand#1"
    out = part.select(
        F.when(F.col("p_type") == "PROMO", -F.col("p_partkey")).otherwise(F.col("p_partkey")).alias(CODE),
        F.when(F.col("p_size") > 25, "Biota").otherwise("Physical").alias("level_1"),
        F.when(first == "red", "Unscorable").when(first == "hot", "").when(first != "old", first).alias("level_2"),
        second.alias("level_3"),
        F.when(own, F.col("p_brand")).alias("level_4"),
        *[_null().alias(c) for c in LEVELS[4:]],
        F.when(own, F.col("p_type")).alias("family"),
        F.when(own & (F.col("p_size") <= 40), second).alias("genus"),
        _null().alias("species"),
    )
    rows = [r + (None,) * 9 for r in EXTRA_CLASSES]
    return out.unionByName(literal_table(spark, rows, CLASSIFICATION))


def metadata(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        campaign("o_orderkey").alias("campaignid"),
        F.col("o_orderkey").alias("sample"),
        (-(F.lit(27.0) + F.col("o_totalprice") / F.lit(400000.0))).alias("latitude_dd"),
        F.col("o_orderpriority").alias("location"),
        _pick("o_orderstatus", {"F": "No"}, "Yes").alias("successful_count"),
        _pick("o_orderpriority", {"5-LOW": "No"}, "Yes").alias("successful_length"),
        _pick("o_orderpriority", {"1-URGENT": "Yes", "2-HIGH": "Yes", "3-MEDIUM": "Yes", "4-NOT SPECIFIED": "No"})
        .alias("successful_habitat_forward"),
        _pick("o_orderstatus", {"F": "No"}, "Yes").alias("successful_habitat_backward"),
    )


def moved_points(spark: SparkSession, d: str) -> DataFrame:
    """Dots of which some stand under a sample that metadata spells otherwise."""
    return points(spark, d).withColumn("sample", F.when(F.col("broad") == "Open Water", -F.col("sample")).otherwise(F.col("sample")))


def south(spark: SparkSession, d: str) -> DataFrame:
    """Metadata cut by latitude."""
    return metadata(spark, d).filter(F.col("latitude_dd") < -27.71)


def legacy_points(spark: SparkSession, d: str) -> DataFrame:
    """Dots in the three-part legacy vocabulary, with NULLs in the class columns."""
    return table(spark, d, "lineitem").select(
        campaign("l_orderkey").alias("campaignid"),
        F.concat(F.lit("img_"), F.col("l_orderkey").cast("string"), F.lit(".avi")).alias("filename"),
        F.col("l_orderkey").alias("sample"),
        F.col("l_returnflag").alias("broad"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("morphology"),
        F.nullif(F.col("l_linenumber").cast("string"), F.lit("7")).alias("type"),
    )


def crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """One row per legacy class; keys contain NULL."""
    c = table(spark, d, "part").select(
        F.when(F.col("p_size") <= 17, "A").when(F.col("p_size") <= 34, "N").otherwise("R").alias("broad"),
        F.when(F.col("p_type").isin("PROMO", "LARGE", "SMALL"), "F").alias("morphology"),
        F.nullif(F.substring("p_brand", 7, 1), F.lit("7")).alias("type"),
        F.when(F.col("p_type") != "PROMO", F.col("p_partkey")).alias(CODE),
        F.nullif(F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit("old")).alias("word"),
    )
    return c.groupBy("broad", "morphology", "type").agg(F.min(CODE).alias(CODE), F.min("word").alias("level_2"))


def worded_points(spark: SparkSession, d: str) -> DataFrame:
    """Dots with the annotator's own level texts."""
    number = "l_linenumber"
    return table(spark, d, "lineitem").select(
        campaign("l_orderkey").alias("campaignid"),
        F.col("l_orderkey").alias("sample"),
        F.when(F.col("l_returnflag") == "A", F.lit(82001003)).when(F.col("l_returnflag") == "N", F.lit(90300910))
        .cast("bigint").alias(CODE),
        _pick(number, {1: "Invertebrate Complex", 2: "Macroalgae", 3: "Consolidated", 4: "Unknown", 6: "Macroalgae",
                       7: "Sponges"}).alias("level_2"),
        F.when((F.col(number) == 1) & (F.col("l_returnflag") == "R"), "Complex 1")
        .when((F.col(number) == 2) & (F.col("l_returnflag") == "R"), "Drift")
        .when(F.col(number) == 6, "Erect course branching").alias("level_3"),
        F.when((F.col(number) == 3) & (F.col("l_linestatus") == "F"), "Turf mat")
        .when((F.col(number) == 6) & (F.col("l_linestatus") == "O"), "Ecklonia radiata").otherwise("plain")
        .alias("level_4"),
    )


def compound_points(spark: SparkSession, d: str) -> DataFrame:
    """Dots whose level 2 reads ``A > B``."""
    number = "l_linenumber"
    return table(spark, d, "lineitem").select(
        campaign("l_orderkey").alias("campaignid"),
        F.col("l_orderkey").alias("sample"),
        _pick(number, {1: "Macroalgae > Large canopy-forming", 2: "Substrate > Unconsolidated (soft)",
                       3: "Sponges > Erect forms", 4: "Matrix > Mixed > More", 5: "Unscorable", 7: "Cnidaria"})
        .alias("level_2"),
        F.when(F.col(number) == 2, "Sand / mud (<2mm)").when(F.col(number) == 3, "Branching")
        .when(F.col(number) == 1, "Brown").alias("level_3"),
        F.when((F.col(number) == 2) & (F.col("l_returnflag") != "N"), "Coarse sand (with shell fragments)")
        .when((F.col(number) == 1) & (F.col("l_returnflag") == "R"), "Ecklonia radiata").alias("level_4"),
        _null().alias("level_5"),
    )


def scientific_points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        campaign("l_orderkey").alias("campaignid"),
        F.col("l_orderkey").alias("sample"),
        F.col("l_returnflag").alias("level_2"),
        *[_null().alias(c) for c in LEVELS[2:5]],
        _pick("l_linenumber", {1: "small ring", 2: "red widget", 3: "blue bolt", 4: "hot-gear", 5: "old bolt extra",
                               6: "small"}).alias("scientific"),
    )


def scientific_classes(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    named = table(spark, d, "part").select(
        F.when(size <= 17, "A").when(size <= 34, "N").otherwise("R").alias("level_2"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("genus"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("species"),
        "p_partkey",
    )
    return named.groupBy("level_2", "genus", "species").agg(F.min("p_partkey").alias(CODE)).select(
        CODE, _null().alias("level_1"), "level_2", *[_null().alias(c) for c in LEVELS[2:]],
        _null().alias("family"), "genus", "species",
    )


MATRIX_COLUMNS = {
    "biota_macroalgae": "click",
    "biota_sponges": "view",
    "biota_consolidated": "error",
    "relief_0_flat_substrate_sandy_rubble_with_few_features_0_substrate_slope_": "signup",
    "relief_3_good_relief_structure_with_some_overhangs_45_substrate_slope_": "purchase",
}


def matrix(spark: SparkSession, d: str) -> DataFrame:
    """One row per sample, class counts as text columns."""
    ev = table(spark, d, "events")
    cells = [F.count(F.when(F.col("event_type") == e, 1)).cast("string").alias(c) for c, e in MATRIX_COLUMNS.items()]
    return ev.groupBy(campaign("user_id").alias("campaignid"), F.col("user_id").alias("opcode")).agg(*cells)


def users(spark: SparkSession, d: str) -> DataFrame:
    """Metadata for the count matrix."""
    c = table(spark, d, "customer").filter(F.col("c_mktsegment") != "MACHINERY")
    return c.select(campaign("c_custkey").alias("campaignid"), F.col("c_custkey").alias("opcode"))


def text_points(spark: SparkSession, d: str) -> DataFrame:
    """Dots as ingested: every column is text, the code stands in two places."""
    number = F.col(CODE).cast("string")
    return points(spark, d).select(
        "campaignid", "direction", "filename", "broad", "morphology", "type", number.alias("code"),
        F.concat((F.col(CODE) + 1).cast("string"), F.lit(".0")).alias("qualifiers"),
    )


def scored_points(spark: SparkSession, d: str) -> DataFrame:
    """Relief dots that carry their standard labels and code."""
    digit = F.substring("relief", 2, 1)
    return points(spark, d).filter(F.col("relief").isNotNull()).select(
        "campaignid", "sample", F.when(digit != "n", "Relief").alias("level_2"), digit.alias("level_5"),
        (F.ascii(digit) + 82003000).cast("bigint").alias(CODE),
    )


def relief_crosswalk(spark: SparkSession) -> DataFrame:
    """Relief sentences to classes; "Unknown" is relief without a score."""
    relief = starter_classification(spark).filter(F.col("level_2") == "Relief")
    sentence = F.coalesce(F.concat(F.lit("."), F.col("level_5"), F.lit(". relief")), F.lit("Unknown"))
    return relief.select(sentence.alias("relief"), CODE, "level_2", "level_5")
