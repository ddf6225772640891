"""One registered query per operator, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nulls, text
from ..functions.samples import sample_expr
from ..operators import classify, columns, counts, joins, qc
from ..schemas import CODE, LABELS, LEVELS, TAXONOMY
from ..session import bounded_tasks
from ..sources import metadata as metadata_source
from ..sources.dimensions import labels_by_code, read_classification, read_crosswalk, starter_classification
from ..sources.exports import ingest
from ..sources.ragged import read_annotations, scan_ragged
from ..sources.sinks import read_plain_csv, scratch_dir, store_points, write_metadata, write_report, write_upload, write_upload_files
from ..streaming import FindingsLog, Landing, deployments, watch
from . import campaigns
from . import frames as fr
from . import frames_sql as fs
from . import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BY = ("campaignid", "sample")
SAMPLE_STEPS = [("replace", {".JPG": "", ".jpg": ""}), ("extract", "(?<=_)[0-9]+(?=_)")]


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = wraps(fn)(lambda spark, d: fn(bounded_tasks(spark), d))
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return keep


# --- whole pipelines -----------------------------------------------------------------------


def _repaired_points(spark, d):
    pts = fr.points(spark, d).withColumn("sample", sample_expr("filename", SAMPLE_STEPS))
    return classify.repair_codes(pts, classify.repair_rules(matrix=True))


_BENTHOS = f"""SELECT p.campaignid, {fs.SAMPLE} AS sample, {fs.LABELS}, p.code AS caab_code, CAST(count(*) AS BIGINT) AS count
FROM (SELECT *, {fs.REPAIRED} AS code FROM points) p
LEFT JOIN classes c ON p.code IS NOT DISTINCT FROM c.caab_code
WHERE level_2 IS NOT NULL AND level_2 NOT IN ('', 'Unscorable') GROUP BY ALL"""


@register(fs.sql(fs.POINTS, fs.CLASSES, _BENTHOS))
def benthos_by_code(spark, d):
    return classify.counts_by_code(_repaired_points(spark, d), fr.classes(spark, d), BY)


@register(fs.sql(fs.POINTS, fs.CLASSES, _BENTHOS.replace("p.code AS caab_code, ", "")))
def benthos_without_code(spark, d):
    return classify.counts_by_code(_repaired_points(spark, d), fr.classes(spark, d), BY, with_code=False)


@register(fs.sql(fs.POINTS, fs.STARTER, """
SELECT campaignid, sample, level_1, level_2, level_3, level_4, CAST(NULL AS VARCHAR) AS level_6,
  CAST(NULL AS VARCHAR) AS level_7, CAST(NULL AS VARCHAR) AS level_8, CAST(NULL AS VARCHAR) AS family,
  CAST(NULL AS VARCHAR) AS genus, CAST(NULL AS VARCHAR) AS species, p.level_5, CAST(s.caab_code AS BIGINT) AS caab_code,
  CAST(count(*) AS BIGINT) AS count
FROM (SELECT *, substr(relief, 2, 1) AS level_5 FROM points WHERE relief IS NOT NULL) p
LEFT JOIN starter s ON p.level_5 IS NOT DISTINCT FROM s.level_5
WHERE p.level_5 <> 'n' AND level_2 IS NOT NULL AND level_2 NOT IN ('', 'Unscorable') GROUP BY ALL"""))
def relief_counts(spark, d):
    scored = classify.relief_digit(fr.points(spark, d), 2)
    return classify.relief_counts(scored, starter_classification(spark), BY)


@register(fs.sql(fs.LEGACY, fs.CROSSWALK, fs.CLASSES, f"""
SELECT t.campaignid, regexp_replace(regexp_replace(t.filename, '.*_', ''), '.avi', '', 'g') AS sample,
  t.caab_code, t.number, {fs.LABELS}
FROM (SELECT campaignid, filename, x.caab_code, CAST(count(*) AS BIGINT) AS number FROM legacy l
  LEFT JOIN crosswalk x ON l.broad IS NOT DISTINCT FROM x.broad AND l.morphology IS NOT DISTINCT FROM x.morphology
    AND l.type IS NOT DISTINCT FROM x.type
  WHERE level_2 IS NOT NULL AND level_2 NOT IN ('', 'Unscorable') GROUP BY ALL) t
LEFT JOIN classes c ON t.caab_code IS NOT DISTINCT FROM c.caab_code"""))
def crosswalk_counts(spark, d):
    out = classify.counts_by_crosswalk(
        fr.legacy_points(spark, d), fr.crosswalk(spark, d), fr.classes(spark, d), ["broad", "morphology", "type"]
    )
    steps = [("after_last", "_"), ("replace", {".avi": ""})]
    return out.withColumn("sample", sample_expr("filename", steps)).drop("filename")


@register(fs.sql(fs.LEGACY, fs.CROSSWALK, fs.CLASSES, f"""counted AS (
  SELECT campaignid, sample, {', '.join('c.' + c for c in LABELS)}, CAST(count(*) AS BIGINT) AS count FROM legacy l
  LEFT JOIN crosswalk x ON l.broad IS NOT DISTINCT FROM x.broad AND l.morphology IS NOT DISTINCT FROM x.morphology
    AND l.type IS NOT DISTINCT FROM x.type
  LEFT JOIN classes c ON x.caab_code IS NOT DISTINCT FROM c.caab_code
  WHERE c.level_2 IS NOT NULL AND c.level_2 NOT IN ('', 'Unscorable') GROUP BY ALL)""", f"""
SELECT t.*, c.caab_code FROM counted t
LEFT JOIN classes c ON {' AND '.join(f't.{c} IS NOT DISTINCT FROM c.{c}' for c in LABELS)}"""))
def rosetta_counts(spark, d):
    return classify.counts_with_relabel(
        fr.legacy_points(spark, d), fr.crosswalk(spark, d), fr.classes(spark, d), ["broad", "morphology", "type"]
    )


@register(fs.sql(fs.SCIENTIFIC, fs.SCIENTIFIC_CLASSES, """
SELECT s.campaignid, s.sample, CAST(NULL AS VARCHAR) AS level_1, s.level_2, CAST(NULL AS VARCHAR) AS level_3,
  CAST(NULL AS VARCHAR) AS level_4, CAST(NULL AS VARCHAR) AS level_5, CAST(NULL AS VARCHAR) AS level_6,
  CAST(NULL AS VARCHAR) AS level_7, CAST(NULL AS VARCHAR) AS level_8, CAST(NULL AS VARCHAR) AS family,
  s.genus, s.species, c.caab_code, CAST(count(*) AS BIGINT) AS count
FROM (SELECT *, split_part(replace(scientific, '-', ' '), ' ', 1) AS genus,
        nullif(split_part(replace(scientific, '-', ' '), ' ', 2), '') AS species FROM scientific) s
LEFT JOIN sci_classes c ON s.level_2 = c.level_2 AND s.genus IS NOT DISTINCT FROM c.genus
  AND s.species IS NOT DISTINCT FROM c.species
GROUP BY ALL"""))
def scientific_counts(spark, d):
    return classify.scientific_counts(fr.scientific_points(spark, d), fr.scientific_classes(spark, d), BY)


@register(fs.sql(fs.MATRIX, fs.USERS, fs.STARTER, """
SELECT m.campaignid, m.opcode, s.level_1, m.level_2, m.level_3, CAST(NULL AS VARCHAR) AS level_4, s.level_5,
  CAST(NULL AS VARCHAR) AS level_6, CAST(NULL AS VARCHAR) AS level_7, CAST(NULL AS VARCHAR) AS level_8,
  CAST(NULL AS VARCHAR) AS family, CAST(NULL AS VARCHAR) AS genus, CAST(NULL AS VARCHAR) AS species,
  CAST(s.caab_code AS BIGINT) AS caab_code, CAST(sum(m.count) AS DOUBLE) AS count
FROM (
  SELECT campaignid, opcode, count,
    CASE category WHEN 'biota_macroalgae' THEN 'Macroalgae' WHEN 'biota_sponges' THEN 'Sponges' ELSE 'Substrate' END AS level_2,
    CASE category WHEN 'biota_consolidated' THEN 'Consolidated (hard)' END AS level_3
  FROM (UNPIVOT (SELECT campaignid, opcode, biota_macroalgae, biota_sponges, biota_consolidated FROM matrix)
    ON COLUMNS('biota_.*') INTO NAME category VALUE count) WHERE count > 0) m
LEFT JOIN starter s ON m.level_2 = s.level_2 AND m.level_3 IS NOT DISTINCT FROM s.level_3 AND s.level_4 IS NULL
WHERE EXISTS (SELECT 1 FROM users u WHERE u.campaignid = m.campaignid AND u.opcode = m.opcode)
GROUP BY ALL"""))
def wide_to_counts(spark, d):
    return classify.wide_to_counts(fr.matrix(spark, d), starter_classification(spark), fr.users(spark, d))


@register(fs.sql(fs.MATRIX, fs.USERS, fs.STARTER, """
SELECT m.campaignid, m.opcode, s.level_1, s.level_2, s.level_3, s.level_4, s.level_5, CAST(NULL AS VARCHAR) AS level_6,
  CAST(NULL AS VARCHAR) AS level_7, CAST(NULL AS VARCHAR) AS level_8, CAST(NULL AS VARCHAR) AS family,
  CAST(NULL AS VARCHAR) AS genus, CAST(NULL AS VARCHAR) AS species, CAST(s.caab_code AS BIGINT) AS caab_code,
  CAST(m.count AS DOUBLE) AS count
FROM (UNPIVOT (SELECT campaignid, opcode, COLUMNS('relief_.*') FROM matrix) ON COLUMNS('relief_.*')
  INTO NAME category VALUE count) m
LEFT JOIN starter s ON s.caab_code = CASE WHEN category LIKE 'relief\\_0%' ESCAPE '\\' THEN 82003001 ELSE 82003006 END
WHERE count > 0 AND EXISTS (SELECT 1 FROM users u WHERE u.campaignid = m.campaignid AND u.opcode = m.opcode)"""))
def wide_relief(spark, d):
    return classify.wide_relief(fr.matrix(spark, d), starter_classification(spark), fr.users(spark, d))


_MATRIX_CELLS = "biota_macroalgae, biota_sponges, biota_consolidated"


@register(fs.sql(fs.MATRIX, f"""SELECT campaignid, opcode, category, CAST(count AS DOUBLE) AS count
FROM (UNPIVOT (SELECT campaignid, opcode, {_MATRIX_CELLS} FROM matrix) ON {_MATRIX_CELLS} INTO NAME category VALUE count)"""))
def wide_to_long(spark, d):
    return counts.wide_to_long(fr.matrix(spark, d), "biota_", ["campaignid", "opcode"], "category")


@register(fs.sql(fs.POINTS, fs.STARTER, """
SELECT p.campaignid, p.filename, CAST(s.caab_code AS BIGINT) AS caab_code, CAST(count(*) AS BIGINT) AS number,
  s.level_1, s.level_2, s.level_3, s.level_4, s.level_5
FROM points p LEFT JOIN (SELECT *, coalesce('.' || level_5 || '. relief', 'Unknown') AS words FROM starter WHERE level_2 = 'Relief') s
  ON p.relief IS NOT DISTINCT FROM s.words
WHERE s.level_5 IS NOT NULL GROUP BY ALL"""))
def crosswalk_relief(spark, d):
    out = classify.counts_by_crosswalk(
        fr.points(spark, d), fr.relief_crosswalk(spark), starter_classification(spark), ["relief"], drop_on="level_5"
    )
    return out.select("campaignid", "filename", CODE, "number", *LEVELS[:5])


@register(fs.sql(fs.POINTS, """
SELECT campaignid, sample, 'Physical' AS level_1, level_2, level_5, CAST(82003000 + ascii(level_5) AS BIGINT) AS caab_code,
  CAST(count(*) AS BIGINT) AS count
FROM (SELECT *, substr(relief, 2, 1) AS level_5, CASE WHEN substr(relief, 2, 1) <> 'n' THEN 'Relief' END AS level_2
  FROM points WHERE relief IS NOT NULL) WHERE level_2 IS NOT NULL GROUP BY ALL"""))
def native_relief(spark, d):
    return classify.native_counts(fr.scored_points(spark, d), BY, {"level_1": "Physical"})


_BETWEEN = [("extract", "(?<=_)[0-9]+(?=_)")]
_SPECS = [
    campaigns.CampaignSpec("survey-1", sample=campaigns.SampleRule(steps=_BETWEEN), rules=tuple(classify.repair_rules())),
    campaigns.CampaignSpec("survey-2", sample=campaigns.SampleRule(steps=[("after_last", "_")]), code_from="qualifiers"),
    campaigns.CampaignSpec(
        "survey-3", sample=campaigns.SampleRule(steps=[("after_last", "_"), *campaigns.STRIP_IMAGE], back_steps=_BETWEEN),
        rules=tuple(classify.repair_rules(invertebrate=2, spelled_out=False, matrix=True)), with_code=False,
    ),
    campaigns.CampaignSpec("survey-4", sample=campaigns.SampleRule(steps=_BETWEEN), scope_latitude=-27.71),
    *[campaigns.CampaignSpec(f"survey-{i}", sample=campaigns.SampleRule(steps=_BETWEEN)) for i in (0, *range(5, 10))],
]
_ARCHIVE_CODE = """CASE campaignid
  WHEN 'survey-1' THEN CASE WHEN broad = 'Open Water' THEN 1
    WHEN broad IN ('Invertebrate Complex', 'Sessile invertebrates') THEN 99900044 WHEN type = 'Thalassodendrum sp.' THEN 63618905
    WHEN type = 'Ecklonia radiata' THEN 54079009 ELSE caab_code END
  WHEN 'survey-2' THEN caab_code + 1
  WHEN 'survey-3' THEN CASE WHEN broad = 'Open Water' THEN 1 WHEN broad = 'Invertebrate Complex' THEN 2
    WHEN morphology = 'Bryozoa / Cnidaria Matrix' THEN 2 WHEN type = 'Thalassodendrum sp.' THEN 63618905
    WHEN type = 'Ecklonia radiata' THEN 54079009 ELSE caab_code END
  ELSE caab_code END"""
_ARCHIVE_SAMPLE = f"""CASE WHEN campaignid = 'survey-2' THEN regexp_replace(filename, '.*_', '')
  WHEN campaignid = 'survey-3' AND direction = 'forwards' THEN left(regexp_replace(filename, '.*_', ''), 1) ELSE {fs.SAMPLE} END"""


@register(fs.sql(fs.POINTS, fs.CLASSES, fs.META, f"""
SELECT campaignid, code_sample AS sample, CASE WHEN campaignid <> 'survey-3' THEN code END AS caab_code, {fs.LABELS},
  CAST(count(*) AS BIGINT) AS count
FROM (SELECT *, {_ARCHIVE_CODE} AS code, {_ARCHIVE_SAMPLE} AS code_sample FROM points) p
LEFT JOIN classes c ON p.code IS NOT DISTINCT FROM c.caab_code
WHERE level_2 IS NOT NULL AND level_2 NOT IN ('', 'Unscorable') AND (campaignid <> 'survey-4' OR EXISTS (
  SELECT 1 FROM meta m WHERE m.campaignid = p.campaignid AND CAST(m.sample AS VARCHAR) = code_sample
  AND m.latitude_dd < CAST(-27.71 AS DOUBLE)))
GROUP BY ALL"""))
def archive_benthos(spark, d):
    meta = fr.metadata(spark, d).withColumn("sample", F.col("sample").cast("string"))
    return campaigns.benthos(_SPECS, fr.text_points(spark, d), campaigns.Tables(fr.classes(spark, d), meta))


@register(SQL["archive_benthos"])
def archive_benthos_by_rule_table(spark, d):
    """The same counts with the repair rules of all campaigns as rows that meet distinct classes."""
    meta = fr.metadata(spark, d).withColumn("sample", F.col("sample").cast("string"))
    tables = campaigns.Tables(fr.classes(spark, d), meta)
    return campaigns.benthos(_SPECS, fr.text_points(spark, d), tables, rule_sets=1)


@register(fs.sql(fs.POINTS, f"""
SELECT campaignid, filename, {_ARCHIVE_SAMPLE} AS sample FROM points"""))
def sample_rules(spark, d):
    return campaigns.prepare(_SPECS, fr.text_points(spark, d)).select("campaignid", "filename", "sample")


# --- labels --------------------------------------------------------------------------------

_HARMONISED = """fixed_labels AS (
  SELECT campaignid, sample, caab_code, CASE WHEN level_2 IS NULL THEN NULL WHEN level_2 = 'Unknown' THEN 'Unknown' ELSE 'Biota' END AS level_1,
    CASE WHEN level_2 = 'Invertebrate Complex' AND level_3 = 'Complex 1' THEN 'Sessile invertebrates' ELSE level_2 END AS level_2,
    CASE WHEN level_2 = 'Invertebrate Complex' AND level_3 = 'Complex 1' THEN NULL
      WHEN level_2 = 'Macroalgae' AND level_3 = 'Drift' THEN NULL
      WHEN level_3 = 'Erect course branching' THEN 'Erect coarse branching' ELSE level_3 END AS level_3,
    CASE WHEN level_2 = 'Consolidated' AND level_4 IN ('Turf mat', 'Veneer') THEN NULL ELSE level_4 END AS old_4
  FROM worded),
harmonised AS (
  SELECT campaignid, sample, caab_code, level_1, level_2, level_3,
    CASE WHEN old_4 = 'Ecklonia radiata' THEN 'Brown' ELSE old_4 END AS level_4,
    CASE WHEN old_4 = 'Ecklonia radiata' THEN 'Lessoniaceae' END AS family,
    CASE WHEN old_4 = 'Ecklonia radiata' THEN 'Ecklonia' END AS genus,
    CASE WHEN old_4 = 'Ecklonia radiata' THEN 'radiata' END AS species
  FROM fixed_labels)"""
_FILLED = """filled AS (
  SELECT h.* EXCLUDE (caab_code), CASE WHEN code = 90300910 THEN 80300910 ELSE code END AS caab_code FROM (
    SELECT h.*, CASE WHEN genus = 'Ecklonia' AND species = 'radiata' THEN 54079009
      WHEN h.level_4 IS NULL AND s.caab_code IS NOT NULL THEN s.caab_code ELSE h.caab_code END AS code
    FROM harmonised h LEFT JOIN (SELECT * FROM starter WHERE level_4 IS NULL) s
      ON h.level_1 IS NOT DISTINCT FROM s.level_1 AND h.level_2 IS NOT DISTINCT FROM s.level_2
      AND h.level_3 IS NOT DISTINCT FROM s.level_3) h)"""
_WORDED_KEYS = ["campaignid", *LEVELS[:4], *TAXONOMY, CODE]


def _harmonised(spark, d):
    return classify.harmonise_labels(fr.worded_points(spark, d))


@register(fs.sql(fs.WORDED, _HARMONISED, f"""SELECT {', '.join(_WORDED_KEYS)}, CAST(count(*) AS BIGINT) AS count
FROM harmonised GROUP BY ALL"""))
def harmonise_labels(spark, d):
    return counts.tally(_harmonised(spark, d), _WORDED_KEYS)


@register(fs.sql(fs.WORDED, fs.STARTER, _HARMONISED, _FILLED, f"""
SELECT {', '.join(_WORDED_KEYS[:-1])}, CAST(caab_code AS BIGINT) AS caab_code, CAST(count(*) AS BIGINT) AS count
FROM filled GROUP BY ALL"""))
def flat_code_fill(spark, d):
    filled = classify.flat_code_fill(_harmonised(spark, d), starter_classification(spark))
    return counts.tally(filled, _WORDED_KEYS)


@register(fs.sql(fs.WORDED, fs.STARTER, fs.BY_CODE, _HARMONISED, _FILLED, f"""
SELECT campaignid, sample, coalesce(s1, level_1) AS level_1, coalesce(s2, level_2) AS level_2,
  coalesce(s3, level_3) AS level_3, coalesce(s4, level_4) AS level_4, s5 AS level_5, family, genus, species,
  CAST(f.caab_code AS BIGINT) AS caab_code, CAST(count(*) AS BIGINT) AS count
FROM filled f LEFT JOIN by_code b ON f.caab_code IS NOT DISTINCT FROM b.caab_code
WHERE coalesce(s2, level_2) NOT IN ('', 'Unknown', 'Open Water') GROUP BY ALL"""))
def overlay_labels(spark, d):
    starter, by_code = starter_classification(spark), labels_by_code(spark)

    def resolve(seen):
        named = classify.flat_code_fill(classify.harmonise_labels(seen), starter)
        return classify.overlay_labels(named, by_code)

    pts = fr.worded_points(spark, d)
    keep = nulls.not_in_set("level_2", ["", "Unknown", "Open Water", None])
    return counts.resolve_counts(pts, [*LEVELS[1:4], CODE], resolve, BY, [*LEVELS[:5], *TAXONOMY, CODE], keep)


_REALIGNED = """realigned AS (
  SELECT campaignid, sample,
    CASE WHEN a IN ('Bryozoa','Cnidaria','Macroalgae','Seagrasses','Sponges') THEN 'Biota' WHEN a = 'Substrate' THEN 'Physical' ELSE a END AS level_1,
    CASE WHEN moves THEN a ELSE b END AS level_2, CASE WHEN moves THEN b ELSE level_3 END AS level_3,
    CASE WHEN moves THEN level_3 ELSE level_4 END AS level_4, CASE WHEN moves THEN level_4 END AS level_5
  FROM (SELECT *, coalesce(a IN ('Bryozoa','Cnidaria','Macroalgae','Seagrasses','Sponges','Substrate'), false) AS moves FROM (
    SELECT *, CASE WHEN contains(level_2, ' > ') THEN left(level_2, strpos(level_2, ' > ') - 1) ELSE level_2 END AS a,
      CASE WHEN contains(level_2, ' > ') THEN substr(level_2, strpos(level_2, ' > ') + 3) END AS b FROM compound)))"""


@register(fs.sql(fs.COMPOUND, _REALIGNED, """
SELECT campaignid, level_1, level_2, level_3, level_4, level_5, CAST(count(*) AS BIGINT) AS count
FROM realigned GROUP BY ALL"""))
def realign_hierarchy(spark, d):
    return counts.tally(classify.realign_hierarchy(fr.compound_points(spark, d)), ["campaignid", *LEVELS[:5]])


@register(fs.sql(fs.COMPOUND, _REALIGNED, fs.STARTER, """
SELECT r.campaignid, r.sample, r.level_1, r.level_2, r.level_3, r.level_4, r.level_5,
  CASE WHEN r.level_5 = 'Ecklonia radiata' THEN 'Lessoniaceae' END AS family,
  CASE WHEN r.level_5 = 'Ecklonia radiata' THEN 'Ecklonia' END AS genus,
  CASE WHEN r.level_5 = 'Ecklonia radiata' THEN 'radiata' END AS species,
  CAST(s.caab_code AS BIGINT) AS caab_code, CAST(count(*) AS BIGINT) AS count
FROM realigned r LEFT JOIN starter s ON r.level_1 IS NOT DISTINCT FROM s.level_1 AND r.level_2 IS NOT DISTINCT FROM s.level_2
  AND r.level_3 IS NOT DISTINCT FROM s.level_3 AND r.level_4 IS NOT DISTINCT FROM s.level_4
  AND r.level_5 IS NOT DISTINCT FROM s.level_5
WHERE r.level_2 IS NOT NULL AND r.level_2 NOT IN ('', 'Unscorable')
  AND (r.level_1 IS NULL OR r.level_1 NOT IN ('Matrix', 'Unscorable')) GROUP BY ALL"""))
def counts_by_path(spark, d):
    paths = classify.schema_by_path(starter_classification(spark))

    def resolve(seen):
        named = joins.lookup(classify.realign_hierarchy(seen), paths, LEVELS[:5])
        return classify.taxonomy_from_levels(named)

    pts = fr.compound_points(spark, d)
    keep = nulls.not_in_set("level_2", counts.UNSCORABLE) & nulls.not_in_set("level_1", ["Matrix", "Unscorable"])
    return counts.resolve_counts(pts, LEVELS[1:5], resolve, BY, [*LEVELS[:5], *TAXONOMY, CODE], keep)


@register(fs.sql(fs.POINTS, fs.CLASSES, """
SELECT t.family, t.genus, coalesce(t.code, c.caab_code) AS caab_code, CAST(count(*) AS BIGINT) AS count
FROM (SELECT morphology AS family, type AS genus, CASE WHEN broad = 'Sponges' THEN NULL ELSE caab_code END AS code FROM points) t
LEFT JOIN (SELECT family, genus, min(caab_code) AS caab_code FROM classes WHERE genus IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'A', 'Ecklonia radiata', 54079009) c
  ON t.family IS NOT DISTINCT FROM c.family AND t.genus IS NOT DISTINCT FROM c.genus
GROUP BY ALL"""))
def taxonomy_fill(spark, d):
    pts = fr.points(spark, d).select(
        F.col("morphology").alias("family"), F.col("type").alias("genus"), F.lit(None).cast("string").alias("species"),
        F.when(F.col("broad") == "Sponges", None).otherwise(F.col(CODE)).alias(CODE),
    )
    named = fr.classes(spark, d).filter(F.col("genus").isNotNull()).groupBy(*TAXONOMY).agg(F.min(CODE).alias(CODE))
    kelp = spark.range(1).select(F.lit("A").alias("family"), F.lit("Ecklonia radiata").alias("genus"),
                                 F.lit(None).cast("string").alias("species"), F.lit(54079009).cast("bigint").alias(CODE))
    # Fold to classes before the lookup, as the count pipelines do.
    folded = counts.tally(pts, ["family", "genus", "species", CODE], name="n")
    out = classify.taxonomy_fill(folded, named.unionByName(kelp))
    return counts.tally(out, ["family", "genus", CODE], "n")


@register(fs.sql(fs.POINTS, f"""
SELECT campaignid, broad, morphology, type, {fs.REPAIRED} AS caab_code, CAST(count(*) AS BIGINT) AS count
FROM points GROUP BY ALL"""))
def repair_codes(spark, d):
    fixed_codes = classify.repair_codes(fr.points(spark, d), classify.repair_rules(matrix=True))
    return counts.tally(fixed_codes, ["campaignid", "broad", "morphology", "type", CODE])


@register(fs.sql(fs.CLASSES, f"""
SELECT {fs.LABELS}, caab_code FROM (SELECT *, row_number() OVER (PARTITION BY level_1, level_2, level_3, level_4, level_5
  ORDER BY caab_code) AS rn FROM classes) WHERE rn = 1"""))
def first_code_per_path(spark, d):
    return classify.schema_by_path(fr.classes(spark, d))


# --- counting ------------------------------------------------------------------------------


@register("""SELECT 'survey-' || left(CAST(l_orderkey AS VARCHAR), 1) AS campaignid, l_returnflag AS level_1,
  l_linestatus AS level_2, CAST(sum(l_linenumber) AS BIGINT) AS number FROM lineitem GROUP BY ALL""")
def tidy_counts(spark, d):
    li = fr.table(spark, d, "lineitem").select(
        fr.campaign("l_orderkey").alias("campaignid"), F.col("l_returnflag").alias("level_1"),
        F.col("l_linestatus").alias("level_2"), F.col("l_linenumber").cast("bigint").alias("n"),
    )
    return counts.tally(li, ["campaignid", *columns.prefixed(li, "level")], "n", "number")


@register("""SELECT event_type, user_id, coalesce(sum(k), 0) AS total FROM (
  SELECT event_type, user_id, CASE WHEN event_type <> 'error' THEN CAST(1 AS DOUBLE) END AS k FROM events) GROUP BY ALL""")
def sum_na_rm(spark, d):
    ev = fr.table(spark, d, "events").select("event_type", "user_id", F.when(F.col("event_type") != "error", 1.0).alias("k"))
    return counts.sum_na_rm(ev, ["event_type", "user_id"], "k", "total")


@register(fs.sql(fs.LEGACY, """SELECT campaignid, CAST(count(*) AS BIGINT) AS samples
FROM (SELECT DISTINCT campaignid, CASE WHEN type IS NOT NULL THEN sample END AS sample FROM legacy) GROUP BY ALL"""))
def distinct_samples_per_campaign(spark, d):
    pts = fr.legacy_points(spark, d).withColumn("sample", F.when(F.col("type").isNotNull(), F.col("sample")))
    return counts.distinct_per_group(pts, ["campaignid"], "sample", "samples")


@register(fs.sql(fs.POINTS, """SELECT DISTINCT campaignid, sample AS sample_code FROM points"""))
def distinct_with_rename(spark, d):
    return fr.points(spark, d).select("campaignid", F.col("sample").alias("sample_code")).distinct()


@register("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def unique_values(spark, d):
    return qc.unique_values(fr.table(spark, d, "documents"), "source")


@register(fs.sql(fs.POINTS, fs.META, fs.SOUTH, """
SELECT campaignid, sample AS opcode, caab_code, CAST(count(*) AS BIGINT) AS count FROM points p
WHERE EXISTS (SELECT 1 FROM south s WHERE s.campaignid = p.campaignid AND s.sample = p.sample) GROUP BY ALL"""))
def scope_semi(spark, d):
    counted = counts.tally(fr.points(spark, d), [*BY, CODE])
    return counts.scope(columns.rename(counted, {"sample": "opcode"}), fr.south(spark, d), ["campaignid", ("opcode", "sample")])


# All dots on both sides; what is on one side only hangs on a derived campaign.
_RELIEF_SIDE = "SELECT CASE WHEN broad = 'Open Water' THEN campaignid || '-deep' ELSE campaignid END AS campaignid, sample FROM points"
_BENTHOS_SIDE = "SELECT CASE WHEN type IS NOT NULL THEN campaignid || '-reef' ELSE campaignid END AS campaignid, sample FROM points"


def _two_sides(spark, d):
    pts = fr.points(spark, d)
    name = lambda where, end: F.when(where, F.concat("campaignid", F.lit(end))).otherwise(F.col("campaignid"))
    relief = pts.withColumn("campaignid", name(F.col("broad") == "Open Water", "-deep"))
    return relief, pts.withColumn("campaignid", name(F.col("type").isNotNull(), "-reef"))


@register(fs.sql(fs.POINTS, f"""
SELECT campaignid, relief_sample, benthos_sample FROM
(SELECT campaignid, CAST(count(DISTINCT sample) AS BIGINT) AS relief_sample FROM ({_RELIEF_SIDE}) GROUP BY ALL)
FULL JOIN (SELECT campaignid, CAST(count(DISTINCT sample) AS BIGINT) AS benthos_sample FROM ({_BENTHOS_SIDE}) GROUP BY ALL)
USING (campaignid)"""))
def coverage_summary(spark, d):
    return counts.coverage_summary(*_two_sides(spark, d))


@register(fs.sql(fs.POINTS, f"""
SELECT campaignid, sample, relief_sample, benthos_sample FROM
(SELECT campaignid, sample, CAST(count(*) AS BIGINT) AS relief_sample FROM ({_RELIEF_SIDE}) GROUP BY ALL)
FULL JOIN (SELECT campaignid, sample, CAST(count(*) AS BIGINT) AS benthos_sample FROM ({_BENTHOS_SIDE}) GROUP BY ALL)
USING (campaignid, sample)"""))
def class_coverage(spark, d):
    return counts.class_coverage(*_two_sides(spark, d), BY)


@register(fs.sql(fs.POINTS, f"""
SELECT campaignid, sample, r.n AS relief_rows, b.n AS benthos_rows FROM
(SELECT campaignid, sample, CAST(count(*) AS BIGINT) AS n FROM ({_RELIEF_SIDE}) GROUP BY ALL) r
FULL JOIN (SELECT campaignid, sample, CAST(count(*) AS BIGINT) AS n FROM ({_BENTHOS_SIDE}) GROUP BY ALL) b
USING (campaignid, sample)"""))
def full_join_summaries(spark, d):
    relief, benthos = _two_sides(spark, d)
    return joins.full_on(counts.tally(relief, BY, name="relief_rows"), counts.tally(benthos, BY, name="benthos_rows"), BY)


# --- joins ---------------------------------------------------------------------------------


@register(fs.sql(fs.LEGACY, fs.CROSSWALK, """
SELECT l.broad, l.morphology, l.type, x.caab_code, CAST(count(*) AS BIGINT) AS count FROM legacy l
LEFT JOIN crosswalk x ON l.broad IS NOT DISTINCT FROM x.broad AND l.morphology IS NOT DISTINCT FROM x.morphology
  AND l.type IS NOT DISTINCT FROM x.type GROUP BY ALL"""))
def null_safe_left_join(spark, d):
    keys = ["broad", "morphology", "type"]
    out = joins.lookup(fr.legacy_points(spark, d), fr.crosswalk(spark, d).drop("level_2"), keys)
    return counts.tally(out, [*keys, CODE])


@register(fs.sql(fs.POINTS, fs.META, """
SELECT campaignid, sample, filename, location FROM points LEFT JOIN meta USING (campaignid, sample)"""))
def natural_left_join(spark, d):
    pts = fr.points(spark, d).select(*BY, "filename")
    return joins.natural_join(pts, fr.metadata(spark, d).select(*BY, "location"))


@register(fs.sql(fs.CLASSES, """
SELECT a.caab_code, a.level_3, coalesce(a.level_4, b.level_4) AS level_4, b.level_4 AS level_4_tax FROM classes a
LEFT JOIN (SELECT level_3, min(level_4) AS level_4 FROM classes GROUP BY ALL) b ON a.level_3 IS NOT DISTINCT FROM b.level_3"""))
def suffix_join_coalesce(spark, d):
    own = fr.classes(spark, d).select(CODE, "level_3", "level_4")
    best = own.groupBy("level_3").agg(F.min("level_4").alias("level_4"))
    out = joins.lookup(own, best, "level_3", suffix="_tax")
    return out.withColumn("level_4", F.coalesce("level_4", "level_4_tax"))


@register(fs.sql(fs.POINTS, fs.MOVED, fs.META, """
SELECT sample, filename FROM moved p WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.sample = p.sample)"""))
def anti_single(spark, d):
    return qc.annotations_missing_metadata(fr.moved_points(spark, d).select("sample", "filename"), fr.metadata(spark, d), ["sample"])


@register(fs.sql(fs.POINTS, fs.META, """
SELECT campaignid, sample, location FROM meta m WHERE (successful_count = 'Yes' OR successful_length = 'Yes')
AND NOT EXISTS (SELECT 1 FROM points p WHERE p.campaignid = m.campaignid AND p.sample = m.sample)"""))
def anti_composite(spark, d):
    found = qc.metadata_missing_annotations(fr.metadata(spark, d), fr.points(spark, d), BY, only_successful=True)
    return found.select(*BY, "location")


@register(fs.sql(fs.POINTS, fs.CLASSES, """
SELECT filename, caab_code FROM points p
WHERE NOT EXISTS (SELECT 1 FROM classes c WHERE c.caab_code IS NOT DISTINCT FROM p.caab_code)"""))
def anti_natural(spark, d):
    return qc.missing_in_schema(fr.points(spark, d).select("filename", CODE), fr.classes(spark, d))


@register(fs.sql(fs.POINTS, fs.MOVED, fs.META, """
SELECT campaignid, sample, direction, CAST(count(*) AS BIGINT) AS count FROM moved p
WHERE EXISTS (SELECT 1 FROM meta m WHERE m.campaignid = p.campaignid AND m.sample = p.sample) GROUP BY ALL"""))
def semi_natural(spark, d):
    counted = counts.tally(fr.moved_points(spark, d), [*BY, "direction"])
    return joins.natural_join(counted, fr.metadata(spark, d).select(*BY), "left_semi")


@register("""SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN true END AS in_habitat, CAST(NULL AS BOOLEAN) AS in_metadata
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL
UNION ALL SELECT doc_id, NULL, true FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def presence_diff(spark, d):
    return joins.presence_diff(fr.table(spark, d, "documents"), fr.table(spark, d, "labels"), ["doc_id"])


@register("SELECT o_custkey FROM orders EXCEPT SELECT user_id FROM events")
def value_setdiff(spark, d):
    return joins.value_setdiff(fr.table(spark, d, "orders"), fr.table(spark, d, "events"), ("o_custkey", "user_id"))


@register(fs.sql(fs.POINTS, fs.META, f"SELECT campaignid FROM ({_RELIEF_SIDE}) EXCEPT SELECT campaignid FROM meta"))
def campaign_id_diff(spark, d):
    return qc.campaign_id_diff(_two_sides(spark, d)[0], fr.metadata(spark, d))


@register(fs.sql(fs.CLASSES, """SELECT level_1, level_2, level_3, CAST(count(*) AS BIGINT) AS rows FROM classes
GROUP BY ALL HAVING count(*) > 1"""))
def duplicate_keys(spark, d):
    return joins.duplicate_keys(fr.classes(spark, d), LEVELS[:3])


@register(fs.sql(fs.LEGACY, fs.CROSSWALK, fs.CLASSES, """
SELECT l.level_2, l.level_3, l.rows, c.copies FROM
(SELECT level_2, level_3, CAST(count(*) AS BIGINT) AS rows FROM legacy l LEFT JOIN crosswalk x ON l.broad IS NOT DISTINCT FROM x.broad
  AND l.morphology IS NOT DISTINCT FROM x.morphology AND l.type IS NOT DISTINCT FROM x.type
  LEFT JOIN (SELECT caab_code, level_3 FROM classes) k ON x.caab_code IS NOT DISTINCT FROM k.caab_code GROUP BY ALL) l
JOIN (SELECT level_2, level_3, CAST(count(*) AS BIGINT) AS copies FROM classes GROUP BY ALL HAVING count(*) > 1) c
  ON l.level_2 IS NOT DISTINCT FROM c.level_2 AND l.level_3 IS NOT DISTINCT FROM c.level_3"""))
def fan_outs(spark, d):
    """Label pairs of legacy dots that a lookup by labels would multiply."""
    keys = ["broad", "morphology", "type"]
    coded = joins.lookup(fr.legacy_points(spark, d), fr.crosswalk(spark, d), keys)
    labelled = joins.lookup(coded, fr.classes(spark, d).select(CODE, "level_3"), [CODE])
    return joins.fan_outs(labelled, fr.classes(spark, d), ["level_2", "level_3"])


# --- checks --------------------------------------------------------------------------------


@register(fs.sql(fs.POINTS, fs.MOVED, fs.META, """
SELECT p.sample, p.n AS points_annotated, m.campaignid, m.location FROM
(SELECT sample, CAST(count(*) AS BIGINT) AS n FROM moved GROUP BY ALL) p LEFT JOIN meta m ON p.sample = m.sample"""))
def points_per_sample(spark, d):
    return qc.points_per_sample(fr.moved_points(spark, d), fr.metadata(spark, d).select(*BY, "location"), ["sample"])


@register(fs.sql(fs.POINTS, fs.META, """
SELECT * FROM (SELECT p.sample, p.n AS points_annotated,
  CAST(CASE WHEN successful_habitat_forward = 'Yes' AND successful_habitat_backward = 'Yes' THEN 4
    WHEN successful_habitat_forward = 'Yes' AND successful_habitat_backward = 'No' THEN 2
    WHEN successful_habitat_forward = 'No' AND successful_habitat_backward = 'Yes' THEN 2
    WHEN successful_habitat_forward = 'No' AND successful_habitat_backward = 'No' THEN 0 END AS BIGINT) AS expected
FROM (SELECT sample, CAST(count(*) AS BIGINT) AS n FROM points GROUP BY ALL) p LEFT JOIN meta m ON p.sample = m.sample)
WHERE points_annotated <> expected"""))
def wrong_point_counts(spark, d):
    found = qc.wrong_point_counts(fr.points(spark, d), fr.metadata(spark, d), 2)
    return found.select("sample", "points_annotated", "expected")


@register(fs.sql(fs.POINTS, "SELECT DISTINCT broad, morphology, type FROM points WHERE caab_code IS NULL"))
def missing_codes(spark, d):
    return qc.missing_codes(fr.points(spark, d), ["broad", "morphology", "type"])


@register(fs.sql(fs.LEGACY, fs.CROSSWALK, """
SELECT DISTINCT l.broad, l.morphology, l.type FROM (SELECT broad, morphology, CASE WHEN type = '3' THEN 'x3' ELSE type END AS type FROM legacy) l LEFT JOIN crosswalk x ON l.broad IS NOT DISTINCT FROM x.broad
  AND l.morphology IS NOT DISTINCT FROM x.morphology AND l.type IS NOT DISTINCT FROM x.type WHERE x.level_2 IS NULL"""))
def unmatched_classes(spark, d):
    keys = ["broad", "morphology", "type"]
    spelled = F.when(F.col("type") == "3", "x3").otherwise(F.col("type"))  # as the crosswalk does not have it
    return qc.unmatched_classes(fr.legacy_points(spark, d).withColumn("type", spelled), fr.crosswalk(spark, d), keys, "level_2")


@register(fs.sql(fs.POINTS, "SELECT DISTINCT broad, morphology, type, caab_code FROM points"))
def distinct_classes(spark, d):
    return qc.distinct_classes(fr.points(spark, d), ["broad", "morphology", "type", CODE])


@register(fs.sql(fs.POINTS, """
SELECT DISTINCT filename, direction FROM points WHERE type IS NULL AND broad IS NULL"""))
def missing_opcode(spark, d):
    pts = fr.points(spark, d).withColumn("opcode", F.coalesce("type", "broad"))
    return qc.missing_opcode(pts)


_MIXED = """CASE o_orderstatus WHEN 'F' THEN substr(o_orderpriority, 1, 1) WHEN 'O' THEN o_orderpriority
  ELSE o_orderkey || '.0' END"""


def _mixed(spark, d):
    return fr.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.substring("o_orderpriority", 1, 1))
        .when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
        .otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))).alias("qualifiers"),
    )


@register(f"SELECT o_orderkey, TRY_CAST({_MIXED} AS BIGINT) AS code FROM orders")
def try_numeric_code(spark, d):
    return _mixed(spark, d).select("o_orderkey", nulls.try_number("qualifiers").alias("code"))


@register(f"SELECT DISTINCT {_MIXED} AS qualifiers FROM orders WHERE TRY_CAST({_MIXED} AS BIGINT) IS NULL")
def unparseable_codes(spark, d):
    return qc.unparseable_codes(_mixed(spark, d), "qualifiers")


@register(fs.sql(fs.CLASSES, "SELECT DISTINCT level_3, level_4, caab_code FROM classes WHERE level_1 = 'Biota' AND level_2 = 'small'"))
def schema_browse(spark, d):
    return qc.schema_browse(fr.classes(spark, d), ["level_3", "level_4", CODE], level_1="Biota", level_2="small")


_PROFILE = fs.sql(fs.POINTS, " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS rows, CAST(count({c}) AS BIGINT) AS filled FROM points"
    for c in ["campaignid", "sample", "caab_code", "broad", "type", "relief"]))


@register(_PROFILE)
def profile(spark, d):
    return qc.profile(fr.points(spark, d).select("campaignid", "sample", CODE, "broad", "type", "relief"))


@register("SELECT doc_id, source, lang FROM documents ORDER BY doc_id LIMIT 10")
def preview(spark, d):
    return fr.table(spark, d, "documents").select("doc_id", "source", "lang").orderBy("doc_id").limit(10)


@register(fs.sql(fs.POINTS, fs.MOVED, fs.META, fs.CLASSES, """
SELECT 'annotations_missing_metadata' AS "check", CAST(count(*) AS BIGINT) AS findings FROM moved p
  WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.sample = p.sample)
UNION ALL SELECT 'metadata_missing_annotations', CAST(count(*) AS BIGINT) FROM meta m
  WHERE NOT EXISTS (SELECT 1 FROM moved p WHERE m.sample = p.sample)
UNION ALL SELECT 'missing_codes', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT broad, morphology, type FROM moved WHERE caab_code IS NULL)
UNION ALL SELECT 'unmatched_classes', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT p.caab_code FROM moved p
  LEFT JOIN classes c ON c.caab_code IS NOT DISTINCT FROM p.caab_code WHERE c.level_1 IS NULL)"""))
def qc_report(spark, d):
    pts, meta = qc.folded(fr.moved_points(spark, d), ["sample", "broad", "morphology", "type", CODE]), fr.metadata(spark, d)
    return qc.qc_report({
        "annotations_missing_metadata": qc.annotations_missing_metadata(pts, meta, ["sample"]),
        "metadata_missing_annotations": qc.metadata_missing_annotations(meta, pts, ["sample"]),
        "missing_codes": qc.missing_codes(pts, ["broad", "morphology", "type"]),
        "unmatched_classes": qc.unmatched_classes(pts, fr.classes(spark, d), [CODE], "level_1"),
    })


# --- columns -------------------------------------------------------------------------------


@register("""SELECT l_orderkey, l_linenumber, l_quantity AS f_only, CAST(NULL AS DOUBLE) AS b_only FROM lineitem WHERE l_linestatus = 'F'
UNION ALL SELECT l_orderkey, l_linenumber, NULL, l_tax FROM lineitem WHERE l_linestatus = 'O'""")
def union_by_name_missing(spark, d):
    li = fr.table(spark, d, "lineitem")
    forwards = li.filter(F.col("l_linestatus") == "F").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("f_only"))
    backwards = li.filter(F.col("l_linestatus") == "O").select(F.col("l_tax").alias("b_only"), "l_linenumber", "l_orderkey")
    return columns.union_by_name(forwards, backwards)


@register("SELECT doc_id, lang, n_chars FROM documents")
def drop_all_null(spark, d):
    docs = fr.table(spark, d, "documents").select(
        "doc_id", "lang", F.lit(None).cast("string").alias("image_row"),
        F.when(F.col("n_chars") < 0, F.col("n_chars")).alias("image_col"), "n_chars",
    )
    return columns.drop_all_null(docs)


@register("SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS level_6, CAST(NULL AS VARCHAR) AS species FROM supplier")
def ensure_cols(spark, d):
    return columns.ensure_cols(fr.table(spark, d, "supplier").select("s_suppkey", "s_name"), ["s_name", "level_6", "species"])


@register("SELECT c_custkey AS sample, c_name, c_mktsegment AS status FROM customer")
def rename_if_present(spark, d):
    c = fr.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return columns.rename_if_present(columns.rename(c, {"c_custkey": "sample"}), {"opcode": "sample", "c_mktsegment": "status"})


@register("SELECT p_partkey, p_type AS raw_p_type, p_brand AS raw_p_brand FROM part")
def shadow_rename(spark, d):
    return columns.shadow(fr.table(spark, d, "part").select("p_partkey", "p_type", "p_brand"), ["p_type", "p_brand"])


@register(fs.sql(fs.CLASSES, f"SELECT caab_code, {fs.LEVELS} FROM classes"))
def prefix_select(spark, d):
    return columns.select_prefix(fr.classes(spark, d), "level", also=[CODE])


@register(fs.sql(fs.CLASSES, "SELECT caab_code, family, genus, species FROM classes"))
def prefix_drop(spark, d):
    return columns.drop_prefix(fr.classes(spark, d), "level")


@register("SELECT o_custkey, o_totalprice, o_orderkey, o_orderstatus FROM orders")
def reorder_front(spark, d):
    o = fr.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return columns.front(o, "o_custkey", "o_totalprice")


@register("SELECT o_orderkey AS order_key, o_orderstatus AS order_status, o_totalprice AS x, o_orderpriority AS order_key_2 FROM orders")
def clean_header_names(spark, d):
    o = fr.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return columns.with_clean_names(o.toDF("﻿Order Key", "Order.status", " ", "order-key"))


@register("SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS ids FROM lineitem")
def row_id(spark, d):
    ids = columns.with_row_id(fr.table(spark, d, "lineitem").select("l_orderkey"))
    one_each = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return one_each.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("ids"))


@register("SELECT l_orderkey, l_linenumber, CAST(row_number() OVER () AS BIGINT) AS id FROM lineitem")
def row_number(spark, d):
    """1 to n in file order."""
    return columns.with_row_number(fr.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@register("""SELECT page_id, split_part(u, '/', 1) AS project,
  CASE WHEN length(u) - length(replace(u, '/', '')) >= 2 THEN split_part(u, '/', 2) END AS campaignid
FROM (SELECT page_id, regexp_replace(url, '^https?://', '') AS u FROM pages)""")
def path_to_columns(spark, d):
    pages = fr.table(spark, d, "pages")
    landed = F.concat(F.lit("file:/landing/"), F.regexp_replace("url", "^https?://", ""))
    return pages.select("page_id", *columns.path_columns(landed, "/landing"))


# --- text ----------------------------------------------------------------------------------


@register("""SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, 'Customer#', 'cust_', 'g'), '_0', '-', 'g'),
  '0{3}.', 'z', 'g') AS sample FROM customer""")
def replace_map_sequential(spark, d):
    return fr.table(spark, d, "customer").select(
        "c_custkey", text.replace_map("c_name", {"Customer#": "cust_", "_0": "-", "0{3}.": "z"}).alias("sample")
    )


@register(fs.sql(fs.POINTS, f"SELECT filename, {fs.SAMPLE} AS sample FROM points"))
def extract_between_underscores(spark, d):
    return fr.points(spark, d).select("filename", text.extract_first("filename", "(?<=_)[0-9]+(?=_)").alias("sample"))


@register(fs.sql(fs.POINTS, "SELECT filename, regexp_replace(filename, '.*_', '') AS sample FROM points"))
def strip_to_last_sep(spark, d):
    return fr.points(spark, d).select("filename", text.strip_to_last("filename").alias("sample"))


@register("SELECT c_custkey, regexp_replace(substr(c_name, 10), '^0+', '') AS sample FROM customer")
def strip_leading_zeros(spark, d):
    return fr.table(spark, d, "customer").select(
        "c_custkey", text.strip_leading_zeros(F.expr("substring(c_name, 10)")).alias("sample")
    )


@register("""SELECT o_orderkey, CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 3 THEN lpad(CAST(o_orderkey AS VARCHAR), 3, '0')
  ELSE CAST(o_orderkey AS VARCHAR) END AS sample FROM orders""")
def pad_left_no_truncate(spark, d):
    return fr.table(spark, d, "orders").select("o_orderkey", text.pad_left(F.col("o_orderkey").cast("string"), 3).alias("sample"))


@register("""SELECT doc_id, md5(text) AS trimmed, source FROM documents""")
def trim_whitespace(spark, d):
    dirty = F.concat(F.lit("\t  "), F.col("text"), F.lit(" \n "))
    return fr.table(spark, d, "documents").select("doc_id", F.md5(text.trim_ws(dirty)).alias("trimmed"), "source")


@register(fs.sql(fs.POINTS, """SELECT filename, substr(relief, 2, 1) AS level_5 FROM points
WHERE relief IS NOT NULL AND substr(relief, 2, 1) <> 'n'"""))
def substring_digit(spark, d):
    return classify.relief_digit(fr.points(spark, d), 2).select("filename", "level_5")


@register("""SELECT doc_id, md5(CASE WHEN contains(text, '. ') THEN left(text, strpos(text, '. ') - 1) ELSE text END) AS head,
  md5(CASE WHEN contains(text, '. ') THEN substr(text, strpos(text, '. ') + 2) END) AS tail FROM documents""")
def separate_merge(spark, d):
    out = text.separate(fr.table(spark, d, "documents").select("doc_id", "text"), "text", ["head", "tail"], r"\. ", extra="merge")
    return out.select("doc_id", F.md5("head").alias("head"), F.md5("tail").alias("tail"))


@register(fs.sql(fs.POINTS, "SELECT split_part(filename, '_', 1) AS kind, split_part(filename, '_', 2) AS sample FROM points"))
def separate_drop(spark, d):
    return text.separate(fr.points(spark, d).select("filename"), "filename", ["kind", "sample"], "_")


@register("""SELECT page_id, r[1] AS scheme, r[2] AS host, r[9] AS ninth FROM (
  SELECT page_id, regexp_split_to_array(url, '[^[:alnum:]]+') AS r FROM pages)""")
def separate_default_alnum(spark, d):
    parts = ["scheme", "host", *[f"p{i}" for i in range(3, 9)], "ninth"]
    return text.separate(fr.table(spark, d, "pages").select("page_id", "url"), "url", parts).select("page_id", "scheme", "host", "ninth")


@register("SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '(?i)ON THE')")
def icase_exclude(spark, d):
    return fr.table(spark, d, "documents").filter(~text.detect("text", "ON THE", ignore_case=True)).select("doc_id")


@register("SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[0-9]{4}')")
def pattern_keep(spark, d):
    return fr.table(spark, d, "documents").filter(text.detect("text", "[0-9]{4}")).select("doc_id", "lang")


# --- predicates ------------------------------------------------------------------------------


@register(fs.sql(fs.POINTS, "SELECT filename, broad FROM points WHERE broad IS NOT NULL AND broad NOT IN ('', 'Open Water')"))
def not_in_drop_null(spark, d):
    return fr.points(spark, d).filter(nulls.not_in_set("broad", ["", "Open Water", None])).select("filename", "broad")


@register(fs.sql(fs.POINTS, "SELECT filename, broad FROM points WHERE broad IS NULL OR broad <> 'Open Water'"))
def not_in_keep_null(spark, d):
    return fr.points(spark, d).filter(nulls.not_in_set("broad", ["Open Water"])).select("filename", "broad")


@register(fs.sql(fs.POINTS, "SELECT filename, broad FROM points WHERE campaignid IN ('survey-1', 'survey-2') AND (broad IS NULL OR broad = 'Sponges')"))
def in_set_keep(spark, d):
    pts = fr.points(spark, d).filter(nulls.in_set("campaignid", ["survey-1", "survey-2"]))
    return pts.filter(nulls.in_set("broad", ["Sponges", None])).select("filename", "broad")


@register(fs.sql(fs.POINTS, """SELECT filename, CASE WHEN caab_code IS NULL THEN NULL WHEN caab_code = 2 THEN 'Biota' ELSE broad END AS level_1 FROM points"""))
def if_else_na(spark, d):
    return fr.points(spark, d).select("filename", nulls.if_else_na(F.col(CODE) == 2, F.lit("Biota"), F.col("broad")).alias("level_1"))


@register(fs.sql(fs.META, """SELECT sample, CAST(CASE WHEN successful_habitat_forward = 'Yes' AND successful_habitat_backward = 'Yes' THEN 40
  WHEN successful_habitat_forward = 'Yes' AND successful_habitat_backward = 'No' THEN 20
  WHEN successful_habitat_forward = 'No' AND successful_habitat_backward = 'Yes' THEN 20
  WHEN successful_habitat_forward = 'No' AND successful_habitat_backward = 'No' THEN 0 END AS BIGINT) AS expected FROM meta"""))
def case_no_default(spark, d):
    yes = qc.expected_points(20, "successful_habitat_forward", "successful_habitat_backward")
    return fr.metadata(spark, d).select("sample", yes.alias("expected"))


@register(fs.sql(fs.META, "SELECT sample, location FROM meta WHERE latitude_dd < CAST(-27.71 AS DOUBLE)"))
def range_scope(spark, d):
    return fr.south(spark, d).select("sample", "location")


@register(fs.sql(fs.META, """SELECT sample, successful_count, successful_length FROM meta
WHERE successful_count = 'Yes' OR successful_length = 'Yes'"""))
def successful_either(spark, d):
    return qc.successful(fr.metadata(spark, d)).select("sample", "successful_count", "successful_length")


# --- files in and out ------------------------------------------------------------------------


def _campaign_folder(root):
    """The campaign of a file, from the folder it lies in."""
    folder, = columns.path_columns(F.col("__path"), root, ["folder"])
    return text.remove(folder, "^campaignid=").alias("campaignid")


@register(fs.sql(fs.POINTS, """
SELECT campaignid, filename, caab_code, broad, CASE WHEN direction = 'backwards' THEN morphology END AS morphology,
  CASE WHEN direction = 'forwards' THEN type END AS type, CASE WHEN direction = 'forwards' THEN relief END AS relief
FROM points"""))
def annotation_scan(spark, d):
    root = scratch_dir(spark)
    landing.write_exports(spark, d, root)
    wanted = ["filename", "code", "broad", "morphology", "type", "relief"]
    raw = read_annotations(spark, root, columns=wanted, glob="*.txt", of_path=[_campaign_folder(root)])
    return raw.select(
        "campaignid", "filename", nulls.try_number("code").alias(CODE),
        *wanted[2:],
    )


@register(fs.sql(fs.POINTS, """
SELECT campaignid, CASE WHEN relief IS NULL THEN 'Units: dots' WHEN type IS NOT NULL THEN 'Filename' ELSE filename END AS filename FROM points"""))
def annotation_scan_split(spark, d):
    """Rows spelled like lines before the header, in files that are read line by line."""
    root = scratch_dir(spark)
    spelled = F.when(F.col("relief").isNull(), "Units: dots").when(F.col("type").isNotNull(), "Filename").otherwise(F.col("filename"))
    landing.write_raw(fr.points(spark, d).withColumn("filename", spelled), root, ["campaignid"], {"filename": "Filename"}, landing.PREAMBLE, "\t")
    raw = scan_ragged(spark, root, glob="*.txt", columns=["filename"], whole_file_bytes=0, of_path=[_campaign_folder(root)])
    return raw.select("campaignid", "filename")


_KINDS_SQL = fs.sql(fs.POINTS, fs.CLASSES, """
SELECT 'benthos' AS kind, p.campaignid, p.direction, caab_code, CAST(count(*) AS BIGINT) AS count FROM points p GROUP BY ALL
UNION ALL SELECT 'relief', campaignid, direction, caab_code, CAST(count(*) AS BIGINT) FROM points WHERE relief IS NOT NULL GROUP BY ALL""")


@register(_KINDS_SQL)
def ingest_both_kinds(spark, d):
    """Exports of both kinds and directions, ingested in one go and counted by what their names say."""
    root = scratch_dir(spark)
    pts = fr.points(spark, d)
    for kind, side in (("", pts), ("_Relief", pts.filter(F.col("relief").isNotNull()))):
        named = side.withColumn("export", F.concat(F.lit("x_"), F.initcap("direction"), F.lit(kind)))
        landing.write_raw(named, root, ["campaignid", "export"], {"filename": "Filename", CODE: "Code"}, landing.PREAMBLE, "\t")
    dots = ingest(spark, root, ["filename", "code"], folders=["campaignid"], glob="*.txt")
    dots = dots.withColumns({"campaignid": text.remove("campaignid", "^campaignid="), CODE: nulls.try_number("code")})
    store = scratch_dir(spark)
    store_points(dots, store)
    return counts.tally(spark.read.schema(dots.schema).parquet(store), ["kind", "campaignid", "direction", CODE])


@register(fs.sql(fs.POINTS, """
SELECT 'benthos' AS kind, campaignid, caab_code, CAST(count(*) AS BIGINT) AS count FROM points GROUP BY ALL
UNION ALL SELECT 'relief', campaignid, CAST(ascii(substr(relief, 2, 1)) AS BIGINT), CAST(count(*) AS BIGINT) FROM points WHERE relief IS NOT NULL GROUP BY ALL"""))
def two_kind_upload(spark, d):
    """Both outputs written to one path, one after the other; neither replaces the other."""
    path, pts = scratch_dir(spark), fr.points(spark, d)
    scored = pts.filter(F.col("relief").isNotNull()).withColumn(CODE, F.ascii(F.substring("relief", 2, 1)).cast("bigint"))
    for kind, side in (("benthos", pts), ("relief", scored)):
        counted = counts.tally(side, ["campaignid", CODE])
        write_upload(counted, path, kind)
    sides = [read_plain_csv(spark, f"{path}/*/upload_kind={k}", counted.schema).withColumn("kind", F.lit(k)) for k in ("benthos", "relief")]
    return columns.union_by_name(*sides)


@register(SQL["wide_to_counts"].replace("SELECT campaignid, opcode, count,", "SELECT 'bay' AS campaignid, opcode, count,")
          .replace("u.campaignid = m.campaignid AND ", ""))
def wide_rekeyed(spark, d):
    """A count matrix whose rows get the campaign's own id before the sum and the look at metadata."""
    users = fr.users(spark, d).withColumn("campaignid", F.lit("bay"))
    return classify.wide_to_counts(fr.matrix(spark, d), starter_classification(spark), users, campaignid="bay")


_PER_IMAGE = {i: (1, 2, 3)[i % 3] for i in range(10)}


@register(fs.sql(fs.POINTS, fs.META, f"""
SELECT campaignid, CAST(sample AS VARCHAR) AS sample, points_annotated, expected FROM (
  SELECT p.campaignid, p.sample, p.n AS points_annotated, CAST(CASE p.campaignid
    {" ".join(f"WHEN 'survey-{i}' THEN {n}" for i, n in _PER_IMAGE.items())} END
    * (CASE successful_habitat_forward WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END + CASE successful_habitat_backward WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END)
    AS BIGINT) AS expected
  FROM (SELECT campaignid, sample, CAST(count(*) AS BIGINT) AS n FROM points GROUP BY ALL) p LEFT JOIN meta m USING (campaignid, sample))
WHERE points_annotated <> expected"""))
def campaign_point_checks(spark, d):
    """Dots per sample against what each campaign expects of an image, several campaigns in one go."""
    specs = [campaigns.CampaignSpec(f"survey-{i}", sample=campaigns.SampleRule(steps=_BETWEEN), points_per_image=n, relief=None)
             for i, n in _PER_IMAGE.items()]
    meta = fr.metadata(spark, d).withColumn("sample", F.col("sample").cast("string"))
    found = campaigns.checks(specs, fr.text_points(spark, d), campaigns.Tables(fr.classes(spark, d), meta))
    return found["wrong_point_counts"].select(*BY, "points_annotated", "expected")


_FINDING = "SELECT '{}' AS finding, campaignid, CAST(sample AS VARCHAR) AS sample, CAST(NULL AS VARCHAR) AS class, CAST(NULL AS BIGINT) AS caab_code, CAST({} AS BIGINT) AS n FROM"
_NO_META = "LEFT JOIN m USING (campaignid, sample) WHERE m.rows IS NULL"
_PER_CAMPAIGN = " ".join(f"WHEN 'survey-{i}' THEN {n}" for i, n in _PER_IMAGE.items())


@register(fs.sql(fs.POINTS, fs.CLASSES, fs.STARTER, fs.META, """named AS (
  SELECT *, CASE WHEN broad = 'Open Water' THEN sample || '-deep' ELSE CAST(sample AS VARCHAR) END AS id FROM points),
m AS (SELECT campaignid, CAST(sample AS VARCHAR) AS sample, count(*) AS rows, count(*) FILTER (campaignid <> 'survey-1' OR successful_count = 'Yes' OR successful_length = 'Yes') AS due FROM meta GROUP BY ALL),
dots AS (SELECT campaignid, id AS sample, count(*) AS n FROM named GROUP BY ALL),
benthos AS (SELECT p.campaignid, id AS sample, count(DISTINCT c.caab_code) AS n FROM named p JOIN classes c ON p.caab_code = c.caab_code
  WHERE level_2 NOT IN ('', 'Unscorable') GROUP BY ALL),
scored AS (SELECT campaignid, id AS sample, substr(relief, 2, 1) AS digit FROM named WHERE relief IS NOT NULL AND substr(relief, 2, 1) <> 'n'),
relief AS (SELECT campaignid, sample, count(DISTINCT digit) AS n FROM scored JOIN starter s ON digit = s.level_5 GROUP BY ALL),
relief_dots AS (SELECT campaignid, sample, count(*) AS n FROM scored GROUP BY ALL)""", f"""
{_FINDING.format('annotations_missing_metadata', 'n')} dots {_NO_META}
UNION ALL {_FINDING.format('relief_missing_metadata', 'n')} relief_dots {_NO_META}
UNION ALL {_FINDING.format('in_habitat_only', 'n')} benthos {_NO_META}
UNION ALL {_FINDING.format('in_metadata_only', 'rows')} m ANTI JOIN benthos USING (campaignid, sample)
UNION ALL {_FINDING.format('metadata_missing_annotations', 'due')} m ANTI JOIN benthos USING (campaignid, sample) WHERE due > 0
UNION ALL {_FINDING.format('metadata_missing_relief', 'due')} m ANTI JOIN relief USING (campaignid, sample) WHERE due > 0 AND campaignid <> 'survey-2'
UNION ALL {_FINDING.format('wrong_point_counts', 'n')} (SELECT d.campaignid, d.sample, d.n, CASE d.campaignid {_PER_CAMPAIGN} END
    * (CASE successful_habitat_forward WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END + CASE successful_habitat_backward WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END) AS expected
  FROM dots d JOIN meta ON d.campaignid = meta.campaignid AND d.sample = CAST(meta.sample AS VARCHAR)) WHERE n <> expected
UNION ALL SELECT 'samples_with_benthos', campaignid, NULL, NULL, NULL, CAST(count(*) AS BIGINT) FROM benthos GROUP BY ALL
UNION ALL SELECT 'samples_with_relief', campaignid, NULL, NULL, NULL, CAST(count(*) AS BIGINT) FROM relief WHERE campaignid <> 'survey-2' GROUP BY ALL
UNION ALL SELECT 'missing_codes', campaignid, NULL, concat_ws(' | ', broad, morphology, type), NULL, CAST(1 AS BIGINT) FROM (
  SELECT DISTINCT campaignid, broad, morphology, type FROM points WHERE caab_code IS NULL)
UNION ALL SELECT 'unmatched_codes', campaignid, NULL, concat_ws(' | ', broad, morphology, type), caab_code, CAST(1 AS BIGINT) FROM (
  SELECT DISTINCT campaignid, broad, morphology, type, p.caab_code FROM points p LEFT JOIN classes c ON p.caab_code = c.caab_code
  WHERE p.caab_code IS NOT NULL AND c.level_1 IS NULL)""").replace("relief_dots LEFT JOIN", "(FROM relief_dots WHERE campaignid <> 'survey-2') LEFT JOIN"))
def archive_findings(spark, d):
    """Every finding of all campaigns, benthos and relief, from one scan of the dots."""
    specs = [campaigns.CampaignSpec(f"survey-{i}", sample=campaigns.SampleRule("opcode", ()), points_per_image=n, only_successful=i == 1,
                                    relief=None if i == 2 else campaigns.ReliefSpec()) for i, n in _PER_IMAGE.items()]
    sample = F.col("sample").cast("string")
    named = F.when(F.col("broad") == "Open Water", F.concat(sample, F.lit("-deep"))).otherwise(sample).alias("opcode")
    pts = fr.points(spark, d).select("campaignid", "direction", "filename", "broad", "morphology", "type", "relief", named, F.col(CODE).cast("string").alias("code"))
    classes = columns.union_by_name(fr.classes(spark, d), starter_classification(spark).filter(F.col("level_2") == "Relief"))
    tables = campaigns.Tables(classes, fr.metadata(spark, d).withColumn("sample", sample))
    return campaigns.findings(specs, pts, tables)


@register(SQL["wide_to_long"])
def matrix_scan(spark, d):
    root = scratch_dir(spark)
    fr.matrix(spark, d).write.csv(root, sep="\t", header=True)
    raw = scan_ragged(spark, root, skip=0, glob="*.csv")
    long = counts.wide_to_long(raw, "biota_", ["campaignid", "opcode"], "category")
    return long.withColumn("opcode", nulls.try_number("opcode"))


@register(fs.sql(fs.META, """
SELECT 'project=Project ' || location AS project, 'campaignid=' || campaignid AS campaignid,
  CAST(sample AS VARCHAR) AS sample, 'north, ' || location AS location, successful_count, successful_length,
  CAST(NULL AS VARCHAR) AS comment FROM meta"""))
def synthesise_metadata(spark, d):
    root = scratch_dir(spark)
    landing.write_metadata_files(spark, d, root)
    out = metadata_source.synthesise_metadata(spark, root, glob="*.txt")
    return out.select("project", "campaignid", "sample", "location", "successful_count", "successful_length", "comment")


@register(fs.sql(fs.META, """
SELECT campaignid, CAST(sample AS VARCHAR) AS sample, latitude_dd, successful_count FROM meta"""))
def canonical_metadata(spark, d):
    root = scratch_dir(spark)
    landing.write_metadata_files(spark, d, root)
    out = metadata_source.read_metadata(spark, root, glob="*.txt", campaign_level=False)
    return out.select(text.remove("campaignid", "^campaignid=").alias("campaignid"), "sample", "latitude_dd", "successful_count")


@register(fs.sql(fs.POINTS, fs.CLASSES, f"""
SELECT p.campaignid, p.sample AS opcode, {fs.LABELS}, p.caab_code, CAST(count(*) AS BIGINT) AS count
FROM points p LEFT JOIN classes c ON p.caab_code IS NOT DISTINCT FROM c.caab_code GROUP BY ALL"""))
def upload_roundtrip(spark, d):
    counted = classify.counts_by_code(fr.points(spark, d), fr.classes(spark, d), BY, drop=None)
    struct = columns.rename(counted, {"sample": "opcode"}).schema
    path = scratch_dir(spark)
    write_upload(counted, path, "benthos-count", rename_sample="opcode", order=["opcode", *LEVELS])
    return read_plain_csv(spark, path, struct).select(*struct.fieldNames())


@register(fs.sql(fs.POINTS, fs.CLASSES, f"""
SELECT p.campaignid || '_benthos.csv' AS file, p.campaignid, p.sample AS opcode, {fs.LABELS}, p.caab_code, CAST(count(*) AS BIGINT) AS count
FROM points p LEFT JOIN classes c ON p.caab_code IS NOT DISTINCT FROM c.caab_code GROUP BY ALL"""))
def upload_files(spark, d):
    """One CSV for each campaign, read back with the name of its file."""
    counted = classify.counts_by_code(fr.points(spark, d), fr.classes(spark, d), BY, drop=None)
    struct = columns.rename(counted, {"sample": "opcode"}).schema
    path = scratch_dir(spark)
    write_upload_files(counted, path, "benthos", rename_sample="opcode", order=["opcode", *LEVELS])
    back = read_plain_csv(spark, path, struct)
    return back.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), *struct.fieldNames())


@register(fs.sql(fs.POINTS, """
SELECT 'rows' AS "check", CAST(count(*) AS BIGINT) AS findings FROM (SELECT DISTINCT campaignid, caab_code, broad FROM points)
UNION ALL SELECT 'no_code', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT campaignid, caab_code, broad FROM points) WHERE caab_code IS NULL
UNION ALL SELECT 'more_than_five', CAST(count(*) AS BIGINT) FROM (SELECT campaignid, caab_code, broad FROM points GROUP BY ALL HAVING count(*) > 5)"""))
def observed_upload(spark, d):
    """Findings counted by the job that writes the upload."""
    counted = counts.tally(fr.points(spark, d), ["campaignid", CODE, "broad"])
    seen = write_upload(counted, scratch_dir(spark), "benthos", watch={"no_code": F.col(CODE).isNull(), "more_than_five": F.col("count") > 5})
    return spark.createDataFrame(list(seen.items()), "check string, findings long")


@register(fs.sql(fs.POINTS, """
SELECT campaignid, filename, broad, CASE WHEN direction = 'backwards' THEN morphology END AS morphology,
  CASE WHEN direction = 'forwards' THEN type END AS type, CASE WHEN direction = 'forwards' THEN relief END AS relief FROM points"""))
def annotation_scan_rest(spark, d):
    """Columns that were not asked for, from the map that keeps them."""
    root = scratch_dir(spark)
    landing.write_exports(spark, d, root)
    raw = read_annotations(spark, root, columns=["filename"], glob="*.txt", rest="rest", of_path=[_campaign_folder(root)])
    return raw.select("campaignid", "filename", *[F.col("rest")[c].alias(c) for c in ("broad", "morphology", "type", "relief")])


@register(fs.sql(fs.META, """
SELECT * FROM (SELECT campaignid, sample, location, successful_habitat_forward FROM meta) CROSS JOIN (VALUES ('csv'), ('parquet')) v(kind)"""))
def metadata_sink(spark, d):
    path = scratch_dir(spark)
    meta = fr.metadata(spark, d).select(*BY, "location", "successful_habitat_forward")
    write_metadata(meta, path)
    kinds = {"csv": read_plain_csv(spark, f"{path}/csv", meta.schema), "parquet": spark.read.parquet(f"{path}/parquet")}
    return columns.union_by_name(*[df.withColumn("kind", F.lit(kind)) for kind, df in kinds.items()])


@register(SQL["unmatched_classes"])
def unmatched_classes_sink(spark, d):
    path = scratch_dir(spark)
    found = unmatched_classes(spark, d)
    write_report(found, path)
    return read_plain_csv(spark, path, found.schema)


@register(fs.sql(fs.CROSSWALK, "SELECT broad, morphology, type, caab_code FROM crosswalk"))
def crosswalk_snapshot(spark, d):
    path = scratch_dir(spark)
    fr.crosswalk(spark, d).drop("level_2").union(fr.crosswalk(spark, d).drop("level_2")).write.parquet(path)
    return read_crosswalk(spark, path)


@register(fs.sql(fs.CLASSES, f"SELECT caab_code, {fs.LABELS} FROM classes"))
def classification_snapshot(spark, d):
    path = scratch_dir(spark)
    own = fr.classes(spark, d).withColumns({CODE: F.col(CODE).cast("string"), "qualifiers": F.lit("a note")})
    own.write.parquet(path)
    return read_classification(spark, path)


# --- landing folders -------------------------------------------------------------------------

_DOT_HEADER = {"filename": "Filename", CODE: "Code"}


def _dot_landing(spark, count, **options):
    root = scratch_dir(spark)
    return Landing(spark, f"{root}/box", f"{root}/store", count, ["filename", "code"], **options), root


@register(fs.sql(fs.POINTS, """
SELECT campaignid, code, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT campaignid, CAST(caab_code AS VARCHAR) AS code FROM points
  UNION ALL SELECT campaignid, CAST(caab_code AS VARCHAR) FROM points WHERE type IS NOT NULL) GROUP BY ALL"""))
def landing_stream(spark, d):
    """Counts of a folder that fills in three arrivals: then a late export with an old time, at last a corrected and a withdrawn one."""
    box, root = _dot_landing(spark, lambda df: counts.tally(df, ["campaignid", "code"]), files_per_batch=40)
    pts = fr.points(spark, d)
    ahead, behind = (pts.filter(F.col("direction") == x) for x in ("forwards", "backwards"))

    def arrive(*files):
        for k, (df, name, days_old) in enumerate(files):
            landing.land(spark, df, f"{root}/staged-{name}-{days_old}-{k}", box.landing, _DOT_HEADER, name, days_old=days_old)
        box.scan()
        box.start(f"{root}/checkpoint").awaitTermination()

    arrive((ahead, "forwards", 0), (behind.withColumn(CODE, F.col(CODE) + 1), "backwards", 3), (pts, "test", 0))
    arrive((pts.filter(F.col("type").isNotNull()), "late", 40))
    landing.withdraw(spark, box.landing, "test")
    arrive((behind, "backwards", 1))
    return box.counts()


@register(fs.sql(fs.POINTS, fs.META, """named AS (
  SELECT campaignid, CASE WHEN broad = 'Open Water' THEN sample || '-deep' ELSE CAST(sample AS VARCHAR) END AS sample FROM points)""", """
SELECT 'annotations_missing_metadata' AS finding, campaignid, sample, CAST(count(*) AS BIGINT) AS n FROM named p
WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.campaignid = p.campaignid AND CAST(m.sample AS VARCHAR) = p.sample) GROUP BY ALL
UNION ALL SELECT 'metadata_missing_annotations', campaignid, CAST(sample AS VARCHAR), CAST(count(*) AS BIGINT) FROM meta m
WHERE NOT EXISTS (SELECT 1 FROM named p WHERE m.campaignid = p.campaignid AND CAST(m.sample AS VARCHAR) = p.sample) GROUP BY ALL"""))
def landing_findings(spark, d):
    """What is open between annotations and metadata that arrive by turns; findings of the first look are withdrawn later."""
    by_sample = lambda df: counts.tally(df, BY)
    dots, root = _dot_landing(spark, lambda df: by_sample(df.withColumnRenamed("filename", "sample")))
    meta = Landing(spark, dots.landing, f"{root}/deployments", by_sample, ["sample"], glob="*_Metadata.csv", read=deployments)
    log = FindingsLog(spark, f"{root}/log")
    name = F.when(F.col("broad") == "Open Water", F.concat(F.col("sample").cast("string"), F.lit("-deep"))).otherwise(F.col("sample").cast("string"))
    pts, deployed = fr.points(spark, d).withColumn("filename", name), fr.metadata(spark, d)
    ahead, behind = (pts.filter(F.col("direction") == x) for x in ("forwards", "backwards"))
    for k, (side, df, label, sep, header) in enumerate([
        (dots, ahead, "forwards", "\t", _DOT_HEADER), (meta, deployed, "all", ",", {"sample": "Sample"}), (dots, behind, "backwards", "\t", _DOT_HEADER),
    ]):
        landing.land(spark, df, f"{root}/staged-{k}", side.landing, header, label, sep)
        side.scan()
        side.start(f"{root}/checkpoint-{side.glob[2:6].strip()}").awaitTermination()
        watch(dots, meta, log)
    return log.still_open()
