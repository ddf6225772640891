"""SQL twins of ``dotreef.plans.frames`` for the side-by-side check."""

from __future__ import annotations

from .. import fixed
from .frames import EXTRA_CLASSES, MATRIX_COLUMNS

V = "CAST(NULL AS VARCHAR)"


def literal(v) -> str:
    return "NULL" if v is None else (str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'")


def values(rows, columns, name: str) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"


POINTS = """points AS (
  SELECT 'survey-' || left(CAST(l_orderkey AS VARCHAR), 1) AS campaignid, l_orderkey AS sample,
    'img_' || l_orderkey || '_' || l_linenumber || CASE WHEN l_linestatus = 'F' THEN '.JPG' ELSE '.jpg' END AS filename,
    CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN NULL ELSE l_partkey END AS caab_code,
    CASE l_linenumber WHEN 1 THEN 'Open Water' WHEN 2 THEN 'Invertebrate Complex' WHEN 3 THEN 'Sessile invertebrates'
      WHEN 4 THEN NULL ELSE 'Sponges' END AS broad,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 5 THEN 'Bryozoa / Cnidaria Matrix' ELSE l_returnflag END AS morphology,
    CASE WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN 'Ecklonia radiata'
      WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN 'Thalassodendrum sp.' END AS type,
    CASE WHEN l_linestatus = 'F' THEN 'forwards' ELSE 'backwards' END AS direction,
    CASE WHEN l_tax > 0.06 THEN NULL WHEN l_linenumber = 7 THEN 'Unknown'
      ELSE '.' || (l_linenumber - 1) || '. relief' END AS relief
  FROM lineitem)"""

MOVED = "moved AS (SELECT * REPLACE (CASE WHEN broad = 'Open Water' THEN -sample ELSE sample END AS sample) FROM points)"

_EXTRA = " UNION ALL ".join(
    f"SELECT {literal(c)}, {literal(a)}, {literal(b)}, {', '.join([V] * 9)}" for c, a, b in EXTRA_CLASSES
)
CLASSES = f"""classes AS (
  SELECT CASE WHEN p_type = 'PROMO' THEN -p_partkey ELSE p_partkey END AS caab_code,
    CASE WHEN p_size > 25 THEN 'Biota' ELSE 'Physical' END AS level_1,
    CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'Unscorable' WHEN 'hot' THEN '' WHEN 'old' THEN NULL
      ELSE split_part(p_name, ' ', 1) END AS level_2,
    split_part(p_name, ' ', 2) AS level_3, nullif(p_brand, 'Brand#1') AS level_4,
    {V} AS level_5, {V} AS level_6, {V} AS level_7, {V} AS level_8,
    CASE WHEN p_brand <> 'Brand#1' THEN p_type END AS family,
    CASE WHEN p_brand <> 'Brand#1' AND p_size <= 40 THEN split_part(p_name, ' ', 2) END AS genus, {V} AS species
  FROM part UNION ALL {_EXTRA})"""

META = """meta AS (
  SELECT 'survey-' || left(CAST(o_orderkey AS VARCHAR), 1) AS campaignid, o_orderkey AS sample,
    -(CAST(27.0 AS DOUBLE) + o_totalprice / CAST(400000.0 AS DOUBLE)) AS latitude_dd, o_orderpriority AS location,
    CASE WHEN o_orderstatus = 'F' THEN 'No' ELSE 'Yes' END AS successful_count,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'No' ELSE 'Yes' END AS successful_length,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN 'Yes' WHEN '3-MEDIUM' THEN 'Yes'
      WHEN '4-NOT SPECIFIED' THEN 'No' END AS successful_habitat_forward,
    CASE WHEN o_orderstatus = 'F' THEN 'No' ELSE 'Yes' END AS successful_habitat_backward
  FROM orders)"""
SOUTH = "south AS (SELECT * FROM meta WHERE latitude_dd < CAST(-27.71 AS DOUBLE))"

LEGACY = """legacy AS (
  SELECT 'survey-' || left(CAST(l_orderkey AS VARCHAR), 1) AS campaignid, 'img_' || l_orderkey || '.avi' AS filename,
    l_orderkey AS sample, l_returnflag AS broad, nullif(l_linestatus, 'O') AS morphology,
    nullif(CAST(l_linenumber AS VARCHAR), '7') AS type
  FROM lineitem)"""
CROSSWALK = """crosswalk AS (
  SELECT broad, morphology, type, min(caab_code) AS caab_code, min(word) AS level_2 FROM (
    SELECT CASE WHEN p_size <= 17 THEN 'A' WHEN p_size <= 34 THEN 'N' ELSE 'R' END AS broad,
      CASE WHEN p_type IN ('PROMO', 'LARGE', 'SMALL') THEN 'F' END AS morphology,
      nullif(substr(p_brand, 7, 1), '7') AS type, CASE WHEN p_type <> 'PROMO' THEN p_partkey END AS caab_code,
      nullif(split_part(p_name, ' ', 1), 'old') AS word
    FROM part) GROUP BY ALL)"""

WORDED = """worded AS (
  SELECT 'survey-' || left(CAST(l_orderkey AS VARCHAR), 1) AS campaignid, l_orderkey AS sample,
    CAST(CASE l_returnflag WHEN 'A' THEN 82001003 WHEN 'N' THEN 90300910 END AS BIGINT) AS caab_code,
    CASE l_linenumber WHEN 1 THEN 'Invertebrate Complex' WHEN 2 THEN 'Macroalgae' WHEN 3 THEN 'Consolidated'
      WHEN 4 THEN 'Unknown' WHEN 6 THEN 'Macroalgae' WHEN 7 THEN 'Sponges' END AS level_2,
    CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN 'Complex 1'
      WHEN l_linenumber = 2 AND l_returnflag = 'R' THEN 'Drift'
      WHEN l_linenumber = 6 THEN 'Erect course branching' END AS level_3,
    CASE WHEN l_linenumber = 3 AND l_linestatus = 'F' THEN 'Turf mat'
      WHEN l_linenumber = 6 AND l_linestatus = 'O' THEN 'Ecklonia radiata' ELSE 'plain' END AS level_4
  FROM lineitem)"""
COMPOUND = """compound AS (
  SELECT 'survey-' || left(CAST(l_orderkey AS VARCHAR), 1) AS campaignid, l_orderkey AS sample,
    CASE l_linenumber WHEN 1 THEN 'Macroalgae > Large canopy-forming' WHEN 2 THEN 'Substrate > Unconsolidated (soft)'
      WHEN 3 THEN 'Sponges > Erect forms' WHEN 4 THEN 'Matrix > Mixed > More' WHEN 5 THEN 'Unscorable'
      WHEN 7 THEN 'Cnidaria' END AS level_2,
    CASE l_linenumber WHEN 2 THEN 'Sand / mud (<2mm)' WHEN 3 THEN 'Branching' WHEN 1 THEN 'Brown' END AS level_3,
    CASE WHEN l_linenumber = 2 AND l_returnflag <> 'N' THEN 'Coarse sand (with shell fragments)'
      WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN 'Ecklonia radiata' END AS level_4
  FROM lineitem)"""
SCIENTIFIC = """scientific AS (
  SELECT 'survey-' || left(CAST(l_orderkey AS VARCHAR), 1) AS campaignid, l_orderkey AS sample, l_returnflag AS level_2,
    CASE l_linenumber WHEN 1 THEN 'small ring' WHEN 2 THEN 'red widget' WHEN 3 THEN 'blue bolt' WHEN 4 THEN 'hot-gear'
      WHEN 5 THEN 'old bolt extra' WHEN 6 THEN 'small' END AS scientific
  FROM lineitem)"""
SCIENTIFIC_CLASSES = """sci_classes AS (
  SELECT CASE WHEN p_size <= 17 THEN 'A' WHEN p_size <= 34 THEN 'N' ELSE 'R' END AS level_2,
    split_part(p_name, ' ', 1) AS genus, split_part(p_name, ' ', 2) AS species, min(p_partkey) AS caab_code
  FROM part GROUP BY ALL)"""

_CELLS = ", ".join(f"count(*) FILTER (event_type = '{e}') AS {c}" for c, e in MATRIX_COLUMNS.items())
MATRIX = f"""matrix AS (
  SELECT 'survey-' || left(CAST(user_id AS VARCHAR), 1) AS campaignid, user_id AS opcode, {_CELLS}
  FROM events GROUP BY ALL)"""
USERS = """users AS (
  SELECT 'survey-' || left(CAST(c_custkey AS VARCHAR), 1) AS campaignid, c_custkey AS opcode
  FROM customer WHERE c_mktsegment <> 'MACHINERY')"""

_STARTER_ROWS = [*fixed.RELIEF_CLASSES, *fixed.KNOWN_CLASSES, *[r for r in fixed.LABELS_BY_CODE if r[1] is not None]]
STARTER = values(_STARTER_ROWS, ["caab_code", "level_1", "level_2", "level_3", "level_4", "level_5"], "starter")
BY_CODE = values(fixed.LABELS_BY_CODE, ["caab_code", "s1", "s2", "s3", "s4", "s5"], "by_code")

REPAIRED = """CASE WHEN broad IN ('Unknown', 'Open Water') THEN 1
    WHEN broad IN ('Invertebrate Complex', 'Sessile invertebrates') THEN 99900044
    WHEN morphology = 'Bryozoa / Cnidaria Matrix' THEN 99900044
    WHEN type IN ('Thalassodendrum sp.', 'Thalassodendrum sp. with epiphytes algae') THEN 63618905
    WHEN type = 'Ecklonia radiata' THEN 54079009
    WHEN caab_code = 90300910 THEN 80300910 ELSE caab_code END"""

LEVELS = ", ".join(f"level_{i}" for i in range(1, 9))
LABELS = LEVELS + ", family, genus, species"
SAMPLE = "nullif(regexp_extract(filename, '_([0-9]+)_', 1), '')"


def sql(*parts: str) -> str:
    """``WITH`` the named frames, then the last part."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]
