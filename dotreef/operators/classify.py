"""From the annotator's vocabulary to standard classes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.nulls import if_else_na, in_set, not_in_set
from ..functions.text import separate
from ..schemas import CODE, LABELS, LEVELS, TAXONOMY
from .columns import ensure_cols
from .counts import FOLDED, MULT, UNSCORABLE, first_by, from_literal, keep, label_counts, multiplicity, scorable, tally, wide_to_long
from .joins import lookup, semi_on


# --- code repair ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Rows whose ``column`` is one of ``values`` get ``code``."""

    column: str
    values: tuple
    code: int
    only_if_null: bool = False

    def hit(self) -> Column:
        found = in_set(self.column, self.values)
        return found & F.col(CODE).isNull() if self.only_if_null else found


_MISTYPED = Rule(CODE, (fixed.MISTYPED_CODE,), fixed.CORRECT_CODE)


def repair_rules(
    group: str = "broad",
    form: str | None = "morphology",
    kind: str | None = "type",
    invertebrate: int = fixed.INVERTEBRATE_CODE,
    spelled_out: bool = True,
    matrix: bool = False,
    epiphytes: bool = True,
) -> list[Rule]:
    """The usual ordered rule set; columns and the sessile-invertebrate code are parameters."""
    rules = [
        Rule(group, fixed.UNKNOWN_LABELS, fixed.UNKNOWN_CODE),
        Rule(group, (fixed.INVERTEBRATE_COMPLEX,), invertebrate),
    ]
    if spelled_out:
        rules.append(Rule(group, (fixed.SESSILE_INVERTEBRATES,), invertebrate))
    if matrix:
        rules.append(Rule(form, (fixed.MATRIX_LABEL,), invertebrate))
    if kind:
        grass = (fixed.THALASSODENDRON, fixed.THALASSODENDRON_EPIPHYTES) if epiphytes else (fixed.THALASSODENDRON,)
        rules += [
            Rule(kind, grass, fixed.THALASSODENDRON_CODE),
            Rule(kind, (fixed.ECKLONIA,), fixed.ECKLONIA_CODE),
            _MISTYPED,
        ]
    return rules


def mistyped_then_missing(group: str = "broad") -> list[Rule]:
    """Correct the mistyped code; fill a missing one for invertebrate complexes only."""
    return [_MISTYPED, replace(Rule(group, (fixed.INVERTEBRATE_COMPLEX,), fixed.INVERTEBRATE_CODE), only_if_null=True)]


def old_code_only() -> list[Rule]:
    return [Rule(CODE, (fixed.OLD_INVERTEBRATE_CODE,), fixed.INVERTEBRATE_CODE)]


def repaired(rules: Sequence[Rule]) -> Column:
    """First matching rule wins; otherwise the code as it is."""
    chain = reduce(lambda c, r: (F if c is None else c).when(r.hit(), F.lit(r.code).cast("bigint")), rules, None)
    return F.col(CODE) if chain is None else chain.otherwise(F.col(CODE))


def repair_codes(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(CODE, repaired(rules))


RULE_TABLE = "campaignid string, priority int, column string, value string, code bigint, only_if_null boolean"


def rule_table(spark: SparkSession, rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """The rules of each campaign as rows; the first one has the lowest priority number."""
    rows = [
        (campaignid, i, r.column, None if v is None else str(v), r.code, r.only_if_null)
        for campaignid, own in rules.items() for i, r in enumerate(own) for v in r.values
    ]
    return spark.createDataFrame(rows, RULE_TABLE)


def repair_by_table(df: DataFrame, rules: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``repair_codes`` with rules as rows (``RULE_TABLE``), for any number of campaigns and rules in a plan of one size.

    Rules look at ``columns`` and the code. They are folded by campaign, column and value to the first one, and joined once for each column; of those
    that hit a row, the first wins. Dots meet rules where they lie: as long as the rules are small, no dot goes through an exchange.
    """
    rank = F.struct("priority", "code")
    # A rule for missing codes only counts where the code is missing.
    best = F.min(F.when(~F.col("only_if_null"), rank)).alias("__any"), F.min(rank).alias("__null")
    first = rules.groupBy("campaignid", "column", "value").agg(*best)
    out, hits = df, []
    for i, c in enumerate(dict.fromkeys([*columns, CODE])):
        mine = first.filter(F.col("column") == c).select("campaignid", F.col("value").alias(f"__value_{i}"), F.col("__any").alias(f"__any_{i}"), F.col("__null").alias(f"__null_{i}"))
        out = lookup(out.withColumn(f"__value_{i}", F.col(c).cast("string")), mine, ["campaignid", f"__value_{i}"])
        hits.append(F.when(F.col(CODE).isNull(), F.col(f"__null_{i}")).otherwise(F.col(f"__any_{i}")))
    won = hits[0] if len(hits) == 1 else F.least(*hits)
    return out.select(*[F.coalesce(won["code"], F.col(c)).alias(c) if c == CODE else F.col(c) for c in df.columns])


# --- labels --------------------------------------------------------------------------------


def realign_hierarchy(df: DataFrame, compound: str = "level_2", sep: str = " > ") -> DataFrame:
    """Split ``"A > B"`` and move levels 1-4 of biota and substrate rows one level down.

    Every new level reads only old ones, so one projection does it.
    """
    split = separate(df, compound, ["level_1", "level_2"], sep, extra="merge")
    split = ensure_cols(split, LEVELS[:5])
    biota = in_set("level_1", fixed.BIOTA_GROUPS)
    ground = F.col("level_1") == fixed.SUBSTRATE_GROUP
    moved = {"level_5": "level_4", "level_4": "level_3", "level_3": "level_2"}
    new = {n: F.when(biota | ground, F.col(old)).otherwise(F.col(n)) for n, old in moved.items()}
    new["level_2"] = F.when(biota | ground, F.col("level_1")).otherwise(F.col("level_2"))
    new["level_1"] = F.when(biota, "Biota").when(ground, "Physical").otherwise(F.col("level_1"))
    return split.select(*[new[c].alias(c) if c in new else F.col(c) for c in split.columns])


def harmonise_labels(df: DataFrame, fixes: Sequence[tuple] = tuple(fixed.LABEL_FIXES)) -> DataFrame:
    """Correct known spellings, derive level 1, move a species out of level 4.

    Targets are fixed in order and later ones see earlier results.
    """
    top = F.when(F.col("level_2") == "Unknown", "Unknown").when(F.col("level_2").isNotNull(), "Biota")
    out = ensure_cols(df.withColumn("level_1", top), [*LEVELS, *TAXONOMY])
    for target in dict.fromkeys(f[0] for f in fixes):
        chain = None
        for _, condition, new in (f for f in fixes if f[0] == target):
            hit = reduce(lambda a, b: a & b, [F.col(c).isin(v) for c, v in condition.items()])
            chain = (F if chain is None else chain).when(hit, F.lit(new).cast("string"))
        out = out.withColumn(target, chain.otherwise(F.col(target)))
    kelp = F.col("level_4") == fixed.ECKLONIA
    named = {"family": "Lessoniaceae", "genus": "Ecklonia", "species": "radiata", "level_4": "Brown"}
    return out.select(
        *[if_else_na(kelp, F.lit(named[c]), F.col(c)).alias(c) if c in named else c for c in out.columns]
    )


def flat_code_fill(df: DataFrame, schema: DataFrame) -> DataFrame:
    """Give rows without a level 4 the code of their level 1-3 group, where the schema has one."""
    top = LEVELS[:3]
    blank = [F.col(c).isNull() for c in ["level_4", *TAXONOMY]]
    groups = schema.filter(reduce(lambda a, b: a & b, blank)).select(*top, F.col(CODE).alias("flat_code")).distinct()
    out = lookup(df, groups, top)
    kelp = (F.col("genus") == "Ecklonia") & (F.col("species") == "radiata")
    filled = (
        F.when(kelp, F.lit(fixed.ECKLONIA_CODE).cast("bigint"))
        .when(F.col("level_4").isNull() & F.col("flat_code").isNotNull(), F.col("flat_code"))
        .otherwise(F.col(CODE))
    )
    corrected = if_else_na(filled == fixed.MISTYPED_CODE, F.lit(fixed.CORRECT_CODE).cast("bigint"), filled)
    return out.withColumn(CODE, corrected).drop("flat_code")


def overlay_labels(df: DataFrame, table: DataFrame, on: str = CODE) -> DataFrame:
    """Labels of ``table`` win over the row's own wherever they are not NULL."""
    labels = [c for c in table.columns if c != on]
    out = lookup(df, table, [on], suffix="_schema")
    twins = {c: c + "_schema" for c in labels if c in df.columns}
    return out.selectExpr(
        *[f"coalesce(`{twins[c]}`, `{c}`) AS `{c}`" if c in twins else f"`{c}`" for c in df.columns],
        *[c for c in labels if c not in twins],
    )


def schema_by_path(schema: DataFrame, path: Sequence[str] = tuple(LEVELS[:5])) -> DataFrame:
    """One class per label path: the one with the lowest code."""
    return first_by(schema, list(path), CODE)


def taxonomy_from_levels(df: DataFrame, table: Sequence[tuple] = tuple(fixed.SPECIES_IN_LEVELS)) -> DataFrame:
    """Family, genus and species of names that were written into a level."""
    out = {c: None for c in TAXONOMY}
    for level, label, *names in table:
        for column, name in zip(TAXONOMY, names):
            base = F if out[column] is None else out[column]
            out[column] = base.when(F.col(level) == label, name)
    return df.withColumns({c: chain.otherwise(F.col(c)) for c, chain in out.items()})


def taxonomy_fill(df: DataFrame, schema: DataFrame) -> DataFrame:
    """Codes that the label path did not give, by family, genus and species."""
    by_name = schema.filter(F.col("genus").isNotNull()).select(F.col(CODE).alias("code_tax"), *TAXONOMY)
    return (
        lookup(df, by_name, TAXONOMY)
        .withColumn(CODE, F.coalesce(F.col(CODE), F.col("code_tax")))
        .drop("code_tax")
    )


def relief_digit(df: DataFrame, position: int, text: str = "relief", drop: str | None = "n") -> DataFrame:
    """Relief score from one character of its sentence; rows without a sentence go.

    ``n`` is what an "Unknown" sentence leaves at position 2.
    """
    out = keep(df, F.col(text).isNotNull()).withColumn("level_5", F.substring(text, position, 1))
    return out if drop is None else keep(out, not_in_set("level_5", [drop]))


# --- counting by vocabulary ------------------------------------------------------------------


def counts_by_code(points: DataFrame, schema: DataFrame, by: Sequence[str], **options) -> DataFrame:
    """Class labels through the code."""
    return label_counts(points, schema, [CODE], by, **options)


def relief_counts(points: DataFrame, schema: DataFrame, by: Sequence[str], **options) -> DataFrame:
    """Class labels through the relief score in ``level_5``."""
    return label_counts(points, schema, ["level_5"], by, **options)


def native_counts(points: DataFrame, by: Sequence[str], constants: dict[str, str] | None = None,
                  labels: Sequence[str] = tuple(LEVELS[:5]), drop: Iterable = UNSCORABLE, drop_on: str = "level_2",
                  name: str = "count") -> DataFrame:
    """The export already carries standard labels and code: nothing to look up."""
    out = points.withColumns({c: F.lit(v) for c, v in (constants or {}).items()})
    out = keep(out, not_in_set(drop_on, drop))
    return tally(out, [*by, *[c for c in labels if c in out.columns], CODE], name=name)


def counts_by_crosswalk(
    points: DataFrame,
    crosswalk: DataFrame,
    schema: DataFrame,
    keys: Sequence[str],
    by: Sequence[str] = ("campaignid", "filename"),
    drop_on: str = "level_2",
    name: str = "number",
) -> DataFrame:
    """Legacy classes to codes, count per code, then label the codes."""
    coded = label_counts(points, crosswalk, keys, by, labels=(), drop_on=drop_on, name=name)
    return lookup(coded, schema, [CODE])


def counts_with_relabel(
    points: DataFrame,
    crosswalk: DataFrame,
    schema: DataFrame,
    keys: Sequence[str],
    by: Sequence[str] = ("campaignid", "sample"),
    with_code: bool = False,
    name: str = "count",
    unique: bool = False,
) -> DataFrame:
    """Classes to codes to labels, count per label set, codes back through the labels.

    The dots are folded once; both small tables are looked up for the fold, then it is summed once. A class that the crosswalk
    lacks meets the class without a code.

    Labels shared by several codes give one row per code, each with the whole count; with ``unique`` that is an error (``joins.fan_outs`` lists them).
    """
    wide = tally(points, [*by, *keys], name="__n")
    for dim, on in ((crosswalk.distinct().select(*keys, CODE), list(keys)), (schema, [CODE])):
        wide = lookup(wide, multiplicity(dim), on)
        wide = wide.withColumn("__n", F.col("__n") * F.coalesce(F.col(MULT), F.lit(1))).drop(MULT)
    labels = [c for c in LABELS if c in wide.columns]
    counted = tally(scorable(wide), [*by, *labels, *[CODE] * with_code], "__n", name)
    return relabel(counted.drop(CODE), schema, unique=unique)


def relabel(counts: DataFrame, schema: DataFrame, on: Sequence[str] = tuple(LABELS), unique: bool = False) -> DataFrame:
    keys = [c for c in on if c in counts.columns]
    return lookup(counts, schema, keys, unique=unique)


def scientific_counts(points: DataFrame, schema: DataFrame, by: Sequence[str], name: str = "count") -> DataFrame:
    """Class labels through levels 2-5 plus the two words of ``scientific``."""
    split = separate(points, "scientific", ["genus", "species"])
    return label_counts(split, schema, [*LEVELS[1:5], "genus", "species"], by, name=name)


def _as_campaign(matrix: DataFrame, campaignid: str | None) -> DataFrame:
    return matrix if campaignid is None else matrix.withColumn("campaignid", F.lit(campaignid))


def wide_to_counts(
    matrix: DataFrame,
    schema: DataFrame,
    metadata: DataFrame,
    by: Sequence[str] = ("campaignid", "opcode"),
    name: str = "count",
    campaignid: str | None = None,
) -> DataFrame:
    """Benthos of a count matrix: cells above zero, labels by column name, sums per class.

    ``campaignid`` replaces the matrix's own before anything is summed or looked up in metadata.
    """
    cells = wide_to_long(_as_campaign(matrix, campaignid), "biota_", by, "category", name).filter(F.col(name) > 0)
    labelled = cells.withColumns(
        {
            "level_2": from_literal("category", fixed.BIOTA_LEVEL_2),
            "level_3": from_literal("category", fixed.BIOTA_LEVEL_3),
            "level_4": F.lit(None).cast("string"),
        }
    )
    folded = labelled.groupBy(*by, *LEVELS[1:4]).agg(F.sum(name).alias(name))
    named = lookup(folded, schema, LEVELS[1:4])
    summed = named.groupBy(*by, *LABELS, CODE).agg(F.sum(name).alias(name))
    return semi_on(summed, metadata, list(by))


def wide_relief(
    matrix: DataFrame,
    schema: DataFrame,
    metadata: DataFrame,
    by: Sequence[str] = ("campaignid", "opcode"),
    name: str = "count",
    campaignid: str | None = None,
) -> DataFrame:
    """Relief of a count matrix: one row per filled cell, labels through the code."""
    cells = wide_to_long(_as_campaign(matrix, campaignid), "relief_", by, "category", name).filter(F.col(name) > 0)
    coded = cells.withColumn("__c", F.regexp_replace("category", "_+$", "")).withColumn(
        CODE, from_literal("__c", fixed.RELIEF_CODE, "bigint")
    )
    named = lookup(coded.drop("__c", "category"), schema, [CODE])
    return semi_on(named.select(*by, *LABELS, CODE, name), metadata, list(by))
