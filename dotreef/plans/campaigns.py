"""Campaigns as data, and the plans that run them.

A campaign is one ``CampaignSpec``. Campaigns that share a vocabulary run in one plan: what
differs between them (sample rule, code column, repair rules, excluded images) becomes a CASE
on ``campaignid``, so a whole archive costs one pass per vocabulary, not one job per campaign.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.nulls import if_else_na, in_set, not_in_set, try_number
from ..functions.samples import sample_expr
from ..functions.text import detect, separate
from ..operators import classify, counts, qc
from ..operators.classify import Rule, repair_rules
from ..operators.columns import ensure_cols, rename, union_by_name
from ..operators.joins import lookup, presence_diff
from ..schemas import CODE, COUNTS, CROSSWALK_KEYS, LABELS, LEVELS, TAXONOMY, conform
from ..sources.dimensions import labels_by_code

BY = ("campaignid", "sample")

# --- fixed values: image file endings, as patterns -------------------------------------------
STRIP_IMAGE = (("replace", {".JPG": "", ".jpg": ""}),)
STRIP_IMAGE_TRIM = (*STRIP_IMAGE, ("trim",))
STRIP_JPG = (("remove", r"\.jpg$"),)
STRIP_AVI = (("replace", {".avi": ""}),)
AFTER_LAST = (("after_last", "_"), ("replace", {".avi": ""}), ("strip_zeros",))
BETWEEN = (("replace", {".png": ""}), ("extract", "(?<=_)[0-9]+(?=_)"))
FIRST_TOKEN = (("first_token", "_"), *STRIP_IMAGE)
BEFORE_JPG = (("first_token", ".JPG"),)
GRID_BACKWARDS = (("first_token", ".1.JPG"), ("pad", 2), *STRIP_IMAGE)
TRIM = (("trim",),)
AS_IS = ()
# --- fixed values: file names of one campaign whose spellings differ from its metadata --------
PILCHARD_FILES = (
    (
        "replace",
        {
            "_left": "", "_Left": "", ".avi": "", " \\(2\\)": "", "_right": "", "_Right": "",
            "Inside_2_25_Pilchards": "INSIDE_2_25_PILCHARDS", "Outside_1_5_Pilchards": "Outside_2_15_Pilchards",
        },
    ),
)


@dataclass(frozen=True)
class SampleRule:
    """Where the sample id comes from; backward images may need another rule."""

    source: str = "filename"
    steps: tuple = STRIP_IMAGE
    back_source: str | None = None
    back_steps: tuple | None = None

    def expr(self) -> Column:
        ahead = sample_expr(self.source, self.steps)
        if self.back_source is None and self.back_steps is None:
            return ahead
        behind = sample_expr(self.back_source or self.source, self.steps if self.back_steps is None else self.back_steps)
        return F.when(F.col("direction") == "backwards", behind).otherwise(ahead)


@dataclass(frozen=True)
class ReliefSpec:
    """How relief is read. ``mode``: digit, code, levels, native or crosswalk."""

    mode: str = "digit"
    text: str = "relief"
    position: int = 2
    drop: str | None = "n"
    keys: tuple = ("level_5",)
    code_from: str = "code"
    with_code: bool = True
    relabel: bool = False
    crosswalk_key: str = "catami_l5"
    drop_on: str = "level_2"
    exclude_files: bool = True
    sample: SampleRule | None = None


@dataclass(frozen=True)
class CampaignSpec:
    """``vocabulary``: code, crosswalk, relabel, labels, path or scientific."""

    campaignid: str
    vocabulary: str = "code"
    sample: SampleRule = SampleRule()
    code_from: str = "code"
    rules: tuple[Rule, ...] = ()
    with_code: bool = True
    depth: int = 8
    count_name: str = "count"
    output_key: str = "opcode"
    drop: tuple = counts.UNSCORABLE
    drop_level_1: tuple = ()
    biota_code: int | None = None
    crosswalk: str | None = None
    exclude_files: tuple = ()
    exclude_null_files: bool = False
    strip_files: tuple = ()
    exclude_class: tuple | None = None
    points_per_image: int = fixed.POINTS_STANDARD
    scope_latitude: float | None = None
    keep_filename: bool = False
    relief: ReliefSpec | None = ReliefSpec()
    #: Benthos and relief stand in the same export, so the kind of a dot's export says nothing.
    one_export: bool = False
    #: (header, column it means): spellings of this campaign's benthos exports.
    aliases: tuple = ()
    class_columns: tuple = ("broad", "morphology", "type")
    only_successful: bool = False


def _rules(**options) -> tuple[Rule, ...]:
    return tuple(repair_rules(**options))


_OPCODE = SampleRule("opcode", AS_IS)
# --- fixed values: headers of one campaign, and the crosswalk keys they hold -----------------
L2_L3_HEADERS = (("level_2", "catami_l2_l3"), ("level_3", "catami_l4"), ("level_4", "catami_l5"))
_OLD_CODE = fixed.OLD_INVERTEBRATE_CODE
_LEGACY = {"vocabulary": "crosswalk", "count_name": "number", "output_key": "sample", "one_export": True}

# --- fixed values: the known campaigns -------------------------------------------------------
KNOWN_CAMPAIGNS: tuple[CampaignSpec, ...] = (
    CampaignSpec(
        "2013-05_Aidans_Hons_pilchards_stereoBRUVs", crosswalk="catami", sample=SampleRule(steps=PILCHARD_FILES),
        relief=ReliefSpec("crosswalk"), **_LEGACY,
    ),
    CampaignSpec("2014-12_Geographe-bay_stereo-BRUVs", vocabulary="wide", sample=_OPCODE, relief=ReliefSpec("wide")),
    CampaignSpec(
        "2012-08_Flinders_CMR_BRUV", crosswalk="catami", sample=SampleRule(steps=STRIP_AVI),
        relief=ReliefSpec("crosswalk", drop_on="level_5"), **_LEGACY,
    ),
    CampaignSpec(
        "2014-04_Tasman_Fracture_CMR_stereoBRUVs", crosswalk="catami", sample=SampleRule(steps=AFTER_LAST),
        relief=ReliefSpec("crosswalk", drop_on="level_5"), **_LEGACY,
    ),
    CampaignSpec(
        "Tasman_Fracture_202103", crosswalk="broad_morphology_type", sample=SampleRule(steps=BETWEEN), keep_filename=True,
        relief=ReliefSpec("crosswalk", crosswalk_key="relief", drop_on="level_5"), **_LEGACY,
    ),
    CampaignSpec(
        "2019-08-Ningaloo-deep_stereo-BRUVS", rules=_rules(invertebrate=_OLD_CODE, spelled_out=False), with_code=False,
        output_key="sample", relief=ReliefSpec(position=1, drop=None, with_code=False), one_export=True,
    ),
    CampaignSpec(
        "2020-06_south-west_stereo-BRUVs", rules=_rules(),
        relief=ReliefSpec(sample=SampleRule(back_steps=GRID_BACKWARDS)),
    ),
    CampaignSpec(
        "2020-10_south-west_stereo-BRUVs", code_from="qualifiers", sample=SampleRule(steps=STRIP_IMAGE_TRIM),
        rules=_rules(group="level_2", kind="level_4", spelled_out=False, epiphytes=False),
        exclude_files=(fixed.BAD_IMAGE,), strip_files=("take 2",), points_per_image=fixed.POINTS_DENSE, depth=5,
        class_columns=tuple(LEVELS[1:4]), only_successful=True,
        relief=ReliefSpec(text="scientific"),
    ),
    CampaignSpec(
        "2021-03_Geographe_BOSS", rules=tuple(classify.mistyped_then_missing()), output_key="period",
        sample=SampleRule(steps=(*STRIP_JPG, *TRIM)), biota_code=_OLD_CODE, points_per_image=fixed.POINTS_DROP_CAMERA,
        relief=None,
    ),
    CampaignSpec(
        "2021-05_Abrolhos_BOSS", vocabulary="labels", code_from="qualifiers", output_key="period",
        sample=SampleRule(steps=(*STRIP_JPG, *TRIM)), drop=("", "Unknown", "Open Water", None),
        points_per_image=fixed.POINTS_DROP_CAMERA, class_columns=tuple(LEVELS[1:4]),
        relief=ReliefSpec(text="scientific", sample=SampleRule()),
    ),
    CampaignSpec("2021-05_Abrolhos_stereo-BRUVs", rules=_rules(matrix=True), scope_latitude=-27.71),
    CampaignSpec(
        "2021-05_PtCloates_stereo-BRUVS", rules=_rules(invertebrate=_OLD_CODE, spelled_out=False, kind=None),
        with_code=False, output_key="sample", relief=ReliefSpec(with_code=False),
    ),
    CampaignSpec(
        "2021-08_PtCloates_stereo-BRUVs", code_from="x_6", with_code=False, output_key="sample",
        sample=SampleRule(steps=FIRST_TOKEN, back_steps=(("replace", {"PCB18.JPG": "PCBP18"}), *FIRST_TOKEN)),
        relief=ReliefSpec("code", code_from="x_6", with_code=False),
    ),
    CampaignSpec(
        "2022-05_PtCloates_stereo-BRUVS", with_code=False, output_key="sample",
        rules=_rules(invertebrate=_OLD_CODE, spelled_out=False, matrix=True),
        sample=SampleRule("opcode", AS_IS, "filename", BEFORE_JPG), relief=ReliefSpec(with_code=False),
    ),
    CampaignSpec(
        "2022-11_Investigator_stereo-BRUVs", vocabulary="relabel", crosswalk="l2_l3", sample=_OPCODE, with_code=False,
        aliases=L2_L3_HEADERS, relief=ReliefSpec("levels", with_code=False, relabel=True),
    ),
    CampaignSpec(
        "2022-11_Salisbury_stereo-BRUVs", vocabulary="relabel", crosswalk="l2_l3", sample=_OPCODE,
        exclude_class=("catami_l2_l3", fixed.DRIFT_ALGAE), relief=ReliefSpec("levels"),
    ),
    CampaignSpec(
        "2022-12_Daw_stereo-BOSS", vocabulary="path", sample=SampleRule("period", TRIM), output_key="period",
        drop_level_1=("Matrix", "Unscorable"), exclude_files=(fixed.BAD_IMAGE,), exclude_null_files=True,
        strip_files=("take 2",), points_per_image=fixed.POINTS_DROP_CAMERA, relief=None,
    ),
    CampaignSpec(
        "2023-03_SwC_stereo-BRUVs", code_from="caab_code", rules=tuple(classify.old_code_only()),
        sample=SampleRule("opcode", TRIM), exclude_files=(fixed.BAD_IMAGE,), strip_files=("take 2",),
        class_columns=tuple(LEVELS[1:4]), relief=ReliefSpec("native", code_from="caab_code", exclude_files=False),
    ),
    CampaignSpec(
        "2024-04_Geographe_stereo-BRUVs", vocabulary="scientific", sample=_OPCODE,
        relief=ReliefSpec("levels", keys=tuple(LEVELS[1:5])),
    ),
    CampaignSpec(
        "2024-05_Wudjari_stereo-BRUVs", vocabulary="scientific", sample=_OPCODE,
        relief=ReliefSpec("levels", keys=tuple(LEVELS[1:5])),
    ),
)

RAW_COLUMNS = [
    "campaignid", "direction", "kind", "filename", "opcode", "period", "code", "qualifiers", "x_6", "caab_code", "broad",
    "morphology", "type", "relief", "scientific", *LEVELS[1:5], "catami_l1", "catami_l2", "catami_l3", "catami_l4",
    "catami_l5", "catami_l2_l3",
]


def _reads_images(spec: CampaignSpec) -> bool:
    """Whether anything that is counted or found for ``spec`` depends on the image of a dot or on its camera."""
    r = spec.relief
    samples = [spec.sample, *([r.sample] if r and r.sample else [])]
    named = [spec.code_from, *spec.class_columns, *(rule.column for rule in spec.rules), *(c for alias in spec.aliases for c in alias)]
    named += [spec.exclude_class[0]] if spec.exclude_class else []
    named += [r.text, r.code_from, r.crosswalk_key, *r.keys] if r else []
    return bool(
        spec.vocabulary in ("crosswalk", "relabel") or (r and r.mode == "crosswalk") or spec.keep_filename or spec.exclude_files
        or spec.exclude_null_files or spec.strip_files or not {"filename", "direction"}.isdisjoint(named)
        or any(s.source in ("filename", "direction") or s.back_source is not None or s.back_steps is not None for s in samples)
    )


def per_campaign(
    specs: Sequence[CampaignSpec], value: Callable[[CampaignSpec], Column], of: Callable[[CampaignSpec], object] | None = None
) -> Column:
    """``value`` of the row's campaign; no CASE where there is only one.

    ``of`` names what ``value`` depends on: campaigns that agree in it share a branch, so that the CASE grows with different values, not with campaigns.
    """
    groups: dict[str, list[CampaignSpec]] = {}
    for s in specs:
        groups.setdefault(s.campaignid if of is None else repr(of(s)), []).append(s)
    if len(groups) == 1:
        return value(specs[0])
    same = lambda g: F.col("campaignid") == g[0].campaignid if len(g) == 1 else F.col("campaignid").isin([s.campaignid for s in g])
    return reduce(lambda c, g: (F if c is None else c).when(same(g), value(g[0])), groups.values(), None)


def _behind() -> Column:
    # Known bad images and file names belong to the forward camera.
    return F.coalesce(F.col("direction") == "backwards", F.lit(False))


def _kept_files(spec: CampaignSpec) -> Column:
    if not spec.exclude_files:
        return F.lit(True)
    return _behind() | not_in_set("filename", [*spec.exclude_files, *([None] if spec.exclude_null_files else [])])


def _kept_classes(spec: CampaignSpec) -> Column:
    if spec.exclude_class is None:
        return F.lit(True)
    column, pattern = spec.exclude_class
    return F.coalesce(~detect(column, pattern, ignore_case=True), F.lit(False))


def _file_name(spec: CampaignSpec) -> Column:
    if not spec.strip_files:
        return F.col("filename")
    stripped = sample_expr("filename", [("remove", t) for t in spec.strip_files])
    return F.when(_behind(), F.col("filename")).otherwise(stripped)


def _of_kind(spec: CampaignSpec, kind: str) -> Column:
    # Dots that say nothing about their export count for both outputs.
    return F.lit(True) if spec.one_export else F.coalesce(F.col("kind") == kind, F.lit(True))


def _meant(spec: CampaignSpec, column: str) -> Column:
    header = next((h for h, c in spec.aliases if c == column), None)
    return F.col(column) if header is None else F.coalesce(F.col(column), F.col(header))


def _rows(specs: Sequence[CampaignSpec], points: DataFrame, kept: Callable[[CampaignSpec], Column], kind: str) -> DataFrame:
    out = counts.keep(ensure_cols(points, RAW_COLUMNS), in_set("campaignid", [s.campaignid for s in specs]))
    if "kind" in points.columns:
        out = counts.keep(out, per_campaign(specs, lambda s: _of_kind(s, kind), lambda s: s.one_export))
    if kind == "benthos":
        meant = dict.fromkeys(c for s in specs for _, c in s.aliases)
        out = out.withColumns({c: per_campaign(specs, lambda s, c=c: _meant(s, c), lambda s: s.aliases) for c in meant}) if meant else out
    if any(s.exclude_files or s.exclude_class for s in specs):
        what = lambda s: (s.exclude_files, s.exclude_null_files, s.exclude_class, s.relief and s.relief.exclude_files)
        out = counts.keep(out, per_campaign(specs, kept, what))
    if any(s.strip_files for s in specs):
        out = out.withColumn("filename", per_campaign(specs, _file_name, lambda s: s.strip_files))
    return out


#: Different rule sets from which on they are a table that is joined to the distinct classes, not branches of a CASE.
RULE_SETS = 30


def prepare(specs: Sequence[CampaignSpec], points: DataFrame, rule_sets: int = RULE_SETS) -> DataFrame:
    """Dots with sample id and repaired numeric code. Worth persisting when checks run too."""
    out = _rows(specs, points, lambda s: _kept_files(s) & _kept_classes(s), "benthos")
    out = out.withColumn("sample", per_campaign(specs, lambda s: s.sample.expr(), lambda s: s.sample))
    out = out.withColumn(CODE, try_number(per_campaign(specs, lambda s: F.col(s.code_from), lambda s: s.code_from)))
    if len({s.rules for s in specs}) >= rule_sets:
        columns = sorted({r.column for s in specs for r in s.rules} - {CODE})
        return classify.repair_by_table(out, classify.rule_table(points.sparkSession, {s.campaignid: s.rules for s in specs}), columns)
    if any(s.rules for s in specs):
        out = out.withColumn(CODE, per_campaign(specs, lambda s: classify.repaired(s.rules), lambda s: s.rules))
    return out


@dataclass
class Tables:
    """Everything the plans look things up in. ``matrices`` has the count matrices of campaigns that deliver no dots."""

    schema: DataFrame
    metadata: DataFrame | None = None
    crosswalks: Mapping[str, DataFrame] = field(default_factory=dict)
    matrices: Mapping[str, DataFrame] = field(default_factory=dict)


def _by_code(specs, prepared, t: Tables) -> DataFrame:
    first, schema = specs[0], t.schema
    if first.biota_code is not None:
        is_biota = F.col(CODE) == first.biota_code
        schema = schema.withColumn("level_1", if_else_na(is_biota, F.lit("Biota"), F.col("level_1")))
    labels = [*LEVELS[: first.depth], *TAXONOMY]
    return classify.counts_by_code(
        prepared, schema, BY, labels=labels, with_code=first.with_code, drop=first.drop
    )


def _by_crosswalk(specs, prepared, t: Tables) -> DataFrame:
    keys = CROSSWALK_KEYS[specs[0].crosswalk]
    # The file is the unit of counting; the sample id hangs on it.
    by = ["campaignid", "sample", "filename"]
    return classify.counts_by_crosswalk(prepared, t.crosswalks[specs[0].crosswalk], t.schema, keys, by, name="count")


def _by_relabel(specs, prepared, t: Tables) -> DataFrame:
    keys = CROSSWALK_KEYS[specs[0].crosswalk]
    return classify.counts_with_relabel(
        prepared, t.crosswalks[specs[0].crosswalk], t.schema, keys, BY, with_code=specs[0].with_code
    )


def _by_labels(specs, prepared, t: Tables) -> DataFrame:
    labels = labels_by_code(prepared.sparkSession)

    def resolve(seen: DataFrame) -> DataFrame:
        named = classify.flat_code_fill(classify.harmonise_labels(seen), t.schema)
        return classify.overlay_labels(named, labels)

    keep = not_in_set("level_2", specs[0].drop)
    return counts.resolve_counts(prepared, [*LEVELS[1:5], CODE], resolve, BY, [*LABELS, CODE], keep)


def _by_path(specs, prepared, t: Tables) -> DataFrame:
    def resolve(seen: DataFrame) -> DataFrame:
        named = lookup(classify.realign_hierarchy(seen), classify.schema_by_path(t.schema), LEVELS[:5])
        return classify.taxonomy_fill(classify.taxonomy_from_levels(named), t.schema)

    keep = not_in_set("level_2", specs[0].drop) & not_in_set("level_1", specs[0].drop_level_1)
    return counts.resolve_counts(prepared, LEVELS[1:5], resolve, BY, [*LABELS, CODE], keep)


def _by_scientific(specs, prepared, t: Tables) -> DataFrame:
    return classify.scientific_counts(prepared, t.schema, BY)


def _wide(specs: Sequence[CampaignSpec], t: Tables, plan: Callable[..., DataFrame]) -> list[DataFrame]:
    """One table per campaign that delivers a count matrix; its rows get the campaign's own id."""
    there = [s for s in specs if s.campaignid in t.matrices]
    if there and t.metadata is None:
        raise ValueError("count matrices need metadata: only samples in it count")
    return [plan(t.matrices[s.campaignid], t.schema, t.metadata, list(BY), campaignid=s.campaignid) for s in there]


VOCABULARIES = {
    "code": _by_code,
    "crosswalk": _by_crosswalk,
    "relabel": _by_relabel,
    "labels": _by_labels,
    "path": _by_path,
    "scientific": _by_scientific,
}


def _families(specs: Iterable[CampaignSpec], key: Callable[[CampaignSpec], tuple]) -> list[list[CampaignSpec]]:
    groups: dict[tuple, list[CampaignSpec]] = {}
    for s in specs:
        groups.setdefault(key(s), []).append(s)
    return list(groups.values())


def in_scope(specs: Sequence[CampaignSpec]) -> Column:
    """Metadata rows that count: south of the limit where a campaign has one."""
    outside = [
        in_set("campaignid", [s.campaignid]) & ~F.coalesce(F.col("latitude_dd") < s.scope_latitude, F.lit(False))
        for s in specs
        if s.scope_latitude is not None
    ]
    return ~reduce(lambda a, b: a | b, outside, F.lit(False))


def _scoped(specs: Sequence[CampaignSpec], out: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """Campaigns with a latitude limit keep only the samples of metadata inside it."""
    limited = [s.campaignid for s in specs if s.scope_latitude is not None]
    if not limited or metadata is None:
        return out
    inside = metadata.filter(in_set("campaignid", limited)).filter(in_scope(specs))
    flags = inside.select(*BY).distinct().withColumn("__inside", F.lit(True))
    kept = lookup(out, flags, list(BY))
    return kept.filter(not_in_set("campaignid", limited) | F.col("__inside").isNotNull()).drop("__inside")


def benthos(specs: Sequence[CampaignSpec], points: DataFrame, t: Tables, rule_sets: int = RULE_SETS) -> DataFrame:
    """Benthos of all ``specs``: one plan per vocabulary, one canonical table. ``rule_sets`` as in ``prepare``."""
    family = lambda s: (s.vocabulary, s.with_code, s.drop, s.drop_level_1, s.biota_code, s.crosswalk, s.depth)
    dotted = [s for s in specs if s.vocabulary != "wide"]
    parts = [VOCABULARIES[group[0].vocabulary](group, prepare(group, points, rule_sets), t) for group in _families(dotted, family)]
    parts += _wide([s for s in specs if s.vocabulary == "wide"], t, classify.wide_to_counts)
    out = union_by_name(*[conform(p, COUNTS, keep_extra=True) for p in parts])
    return _scoped(specs, out, t.metadata)


def prepare_relief(specs: Sequence[CampaignSpec], points: DataFrame) -> DataFrame:
    """Relief dots with sample id and, for scored sentences, the score in ``level_5``."""
    out = _rows(specs, points, lambda s: _kept_files(s) if s.relief.exclude_files else F.lit(True), "relief")
    out = out.withColumn("sample", per_campaign(specs, lambda s: (s.relief.sample or s.sample).expr(), lambda s: s.relief.sample or s.sample))
    r = specs[0].relief
    if r.mode == "digit":
        return classify.relief_digit(out, r.position, r.text, r.drop)
    if r.mode == "code":
        return out.withColumn(CODE, try_number(r.code_from))
    if r.mode in ("levels", "native"):
        # Rows without a score must not meet the classes that have none either.
        out = counts.keep(out, F.col("level_5").isNotNull())
        return out.withColumn(CODE, try_number(r.code_from)) if r.mode == "native" else out
    return out


def _relief_family(s: CampaignSpec) -> tuple:
    r = s.relief
    return (r.mode, r.text, r.position, r.drop, r.keys, r.code_from, r.with_code, r.relabel, r.crosswalk_key, r.drop_on)


def _relief_counts(specs: Sequence[CampaignSpec], prepared: DataFrame, t: Tables) -> DataFrame:
    r = specs[0].relief
    if r.mode == "code":
        return classify.counts_by_code(prepared, t.schema, BY, with_code=r.with_code)
    if r.mode == "native":
        return classify.native_counts(prepared, BY, {"level_1": "Physical"})
    if r.mode == "crosswalk":
        table = t.crosswalks["relief_text"]
        if r.crosswalk_key != "catami_l5":
            table = rename(table, {"catami_l5": r.crosswalk_key})
        by = ["campaignid", "sample", "filename"]
        return classify.counts_by_crosswalk(prepared, table, t.schema, [r.crosswalk_key], by, r.drop_on, "count")
    out = classify.label_counts(prepared, t.schema, list(r.keys), BY, with_code=r.with_code)
    return classify.relabel(out.select(*BY, "level_5", "count"), t.schema, ["level_5"]) if r.relabel else out


def relief(specs: Sequence[CampaignSpec], points: DataFrame, t: Tables) -> DataFrame:
    """Relief of all ``specs`` that have any: one plan per way of reading it."""
    with_relief = [s for s in specs if s.relief is not None]
    dotted = [s for s in with_relief if s.relief.mode != "wide"]
    parts = [_relief_counts(g, prepare_relief(g, points), t) for g in _families(dotted, _relief_family)]
    parts += _wide([s for s in with_relief if s.relief.mode == "wide"], t, classify.wide_relief)
    out = union_by_name(*[conform(p, COUNTS, keep_extra=True) for p in parts])
    return _scoped(specs, out, t.metadata)


def _split_scientific(df: DataFrame) -> DataFrame:
    return separate(df, "scientific", ["genus", "species"])


def _classes(specs: Sequence[CampaignSpec], prepared: DataFrame, t: Tables) -> DataFrame:
    """Distinct classes of one family as its exports spell them, with the code and level 1 that they lead to.

    Codes that an export carries are repaired dot by dot and belong to the class; all others come from resolving it once.
    """
    first = specs[0]
    if first.vocabulary in ("crosswalk", "relabel"):
        keys = CROSSWALK_KEYS[first.crosswalk]
        walk = t.crosswalks[first.crosswalk].select(*keys, CODE).distinct()
        coded = lookup(prepared.select("campaignid", *keys).distinct(), walk, keys)
        return lookup(coded, t.schema.select(CODE, "level_1"), [CODE])
    if first.vocabulary == "scientific":
        keys = [*LEVELS[1:5], "genus", "species"]
        seen = _split_scientific(prepared.select("campaignid", *LEVELS[1:5], "scientific").distinct())
        return lookup(seen, t.schema.select(*keys, CODE, "level_1"), keys)
    if first.vocabulary == "path":
        seen = prepared.select("campaignid", *LEVELS[1:5]).distinct()
        named = lookup(classify.realign_hierarchy(seen), classify.schema_by_path(t.schema), LEVELS[:5])
        named = classify.taxonomy_fill(classify.taxonomy_from_levels(named), t.schema)
        return named.select("campaignid", *LEVELS[:5], CODE)
    keys = list(dict.fromkeys(c for s in specs for c in s.class_columns))
    if first.vocabulary == "labels":
        raw = [f"raw_{c}" for c in keys]
        seen = prepared.select("campaignid", *LEVELS[1:5], CODE, *[F.col(c).alias(r) for c, r in zip(keys, raw)]).distinct()
        named = classify.overlay_labels(classify.flat_code_fill(classify.harmonise_labels(seen), t.schema), labels_by_code(prepared.sparkSession))
        return named.select("campaignid", *[F.col(r).alias(c) for c, r in zip(keys, raw)], CODE, F.col("level_1"))
    seen = prepared.select("campaignid", *keys, CODE).distinct()
    return lookup(seen, t.schema.select(CODE, F.col("level_1")), [CODE])


def checks(
    specs: Sequence[CampaignSpec], points: DataFrame, t: Tables, only_successful: bool | None = None
) -> dict[str, DataFrame]:
    """Every check of ``specs``, whatever their vocabularies: always the same keys.

    ``only_successful`` overrides each campaign's own rule on which deployments should have annotations.
    """
    specs = [s for s in specs if s.vocabulary != "wide"]
    with_relief = [s for s in specs if s.relief is not None]
    ids = [s.campaignid for s in specs]
    meta = t.metadata.filter(in_set("campaignid", ids)).filter(in_scope(specs))
    wanted = {s.campaignid: s.only_successful if only_successful is None else only_successful for s in specs}
    due = meta.filter(in_set("campaignid", [c for c, only in wanted.items() if not only]) | qc.was_successful())
    families = _families(specs, lambda s: (s.vocabulary, s.crosswalk, s.class_columns))
    prepared = [prepare(g, points) for g in families]
    narrow = union_by_name(*[p.select(*BY, "filename", "direction") for p in prepared])
    found = union_by_name(*[_classes(g, p, t) for g, p in zip(families, prepared)])
    classes = [c for c in found.columns if c not in (CODE, "level_1")]
    benthos_counts, relief_counts = benthos(specs, points, t), relief(with_relief, points, t) if with_relief else None
    expected = per_campaign(specs, lambda s: F.lit(s.points_per_image), lambda s: s.points_per_image)
    out = {
        "annotations_missing_metadata": qc.annotations_missing_metadata(narrow, meta),
        "metadata_missing_annotations": qc.metadata_missing_annotations(due, benthos_counts),
        "missing_codes": found.filter(F.col(CODE).isNull()).select(*classes).distinct(),
        "unmatched_codes": found.filter(F.col(CODE).isNotNull() & F.col("level_1").isNull()).select(*classes, CODE).distinct(),
        "presence_diff": presence_diff(benthos_counts, meta, list(BY)),
        "wrong_point_counts": qc.wrong_point_counts(narrow, meta, expected),
    }
    if relief_counts is None:
        relief_counts = benthos_counts.limit(0)
    relief_ids = [s.campaignid for s in with_relief]
    relief_dots = [prepare_relief(g, points).select(*BY, "filename", "direction") for g in _families(with_relief, _relief_family)]
    relief_narrow = union_by_name(*relief_dots) if relief_dots else narrow.limit(0)
    return out | {
        "relief_missing_metadata": qc.annotations_missing_metadata(relief_narrow, meta),
        "metadata_missing_relief": qc.metadata_missing_annotations(due.filter(in_set("campaignid", relief_ids)), relief_counts),
        "unmatched_relief": relief_counts.filter(F.col("level_1").isNull()).select("campaignid", *LABELS, CODE).distinct(),
        "coverage": counts.coverage_summary(relief_counts, benthos_counts),
    }


#: Numbers that the findings of a sample follow from: dots and counts of both outputs, deployments, and those that should have annotations.
_MEASURES = ("dots", "benthos", "relief_dots", "relief", "rows", "due")


def _measured(df: DataFrame, **measures: Column) -> DataFrame:
    none = F.lit(0).cast("bigint")
    return df.select(*BY, *[measures.get(m, none).cast("bigint").alias(m) for m in _MEASURES])


def findings(
    specs: Sequence[CampaignSpec], points: DataFrame, t: Tables, only_successful: bool | None = None
) -> DataFrame:
    """Every finding of ``checks`` in one table ``finding, campaignid, sample, class, caab_code, n``, from one scan of the dots.

    The dots are folded once on everything that any vocabulary reads (image and camera only where a campaign looks at them); all plans branch off that fold. What is found about a sample
    follows from six numbers of it, which are summed in one place. ``n`` is how many dots, counts or deployments a finding is about (samples, for coverage).
    """
    specs = [s for s in specs if s.vocabulary != "wide"]
    with_relief = [s for s in specs if s.relief is not None]
    relief_ids = [s.campaignid for s in with_relief]
    meta = t.metadata.filter(in_set("campaignid", [s.campaignid for s in specs])).filter(in_scope(specs))
    wanted = {s.campaignid: s.only_successful if only_successful is None else only_successful for s in specs}
    is_due = in_set("campaignid", [c for c, only in wanted.items() if not only]) | F.coalesce(qc.was_successful(), F.lit(False))

    of_image = () if any(map(_reads_images, specs)) else ("filename", "direction")
    base = counts.folded(points, [c for c in RAW_COLUMNS if c in points.columns and c not in of_image])
    families = _families(specs, lambda s: (s.vocabulary, s.crosswalk, s.class_columns))
    prepared = [prepare(g, base) for g in families]
    one, n = F.lit(1), F.col(counts.FOLDED)
    sides = [_measured(p, dots=n) for p in prepared]
    sides.append(_measured(benthos(specs, base, t), benthos=one))
    relief_counts = relief(with_relief, base, t) if with_relief else None
    if with_relief:
        sides.append(_measured(relief_counts, relief=one))
        sides += [_measured(prepare_relief(g, base), relief_dots=n) for g in _families(with_relief, _relief_family)]
    sides.append(_measured(meta, rows=one, due=is_due.cast("bigint")))
    samples = union_by_name(*sides).groupBy(*BY).agg(*[F.sum(m).alias(m) for m in _MEASURES])

    has_relief = in_set("campaignid", relief_ids)
    rules = {
        "annotations_missing_metadata": ("dots", F.col("rows") == 0), "metadata_missing_annotations": ("due", F.col("benthos") == 0),
        "relief_missing_metadata": ("relief_dots", F.col("rows") == 0), "metadata_missing_relief": ("due", (F.col("relief") == 0) & has_relief),
        "in_habitat_only": ("benthos", F.col("rows") == 0), "in_metadata_only": ("rows", F.col("benthos") == 0),
    }
    flags = [F.struct(F.lit(name).alias("finding"), F.when(when & (F.col(m) > 0), F.col(m)).alias("n")) for name, (m, when) in rules.items()]
    of_samples = samples.select(*BY, F.inline(F.array(*flags))).filter("n IS NOT NULL")

    expected = qc.expected_points(per_campaign(specs, lambda s: F.lit(s.points_per_image), lambda s: s.points_per_image), "successful_habitat_forward", "successful_habitat_backward")
    due_points = meta.select(*BY, expected.alias("expected"))
    wrong = lookup(samples.filter("dots > 0").select(*BY, F.col("dots").alias("n")), due_points, list(BY), "inner").filter("n <> expected")
    covered = samples.groupBy("campaignid").agg(F.count_if(F.col("relief") > 0).alias("relief"), F.count_if(F.col("benthos") > 0).alias("benthos"))
    covered = covered.select("campaignid", F.inline(F.array(*[F.struct(F.lit(f"samples_with_{c}").alias("finding"), F.col(c).alias("n")) for c in ("relief", "benthos")])))

    parts = [of_samples, wrong.select(F.lit("wrong_point_counts").alias("finding"), *BY, "n"), covered.filter("n > 0")]
    for group, p in zip(families, prepared, strict=True):
        seen = _classes(group, p, t)
        label = F.concat_ws(" | ", *[c for c in seen.columns if c not in (CODE, "level_1", "campaignid")]).alias("class")
        bad = F.when(F.col(CODE).isNull(), "missing_codes").when(F.col("level_1").isNull(), "unmatched_codes").alias("finding")
        parts.append(seen.select(bad, "campaignid", label, CODE).filter("finding IS NOT NULL").distinct().withColumn("n", F.lit(1).cast("bigint")))
    if relief_counts is not None:
        label = F.concat_ws(" | ", *LABELS).alias("class")
        unknown = relief_counts.filter(F.col("level_1").isNull()).select("campaignid", *LABELS, CODE).distinct()
        parts.append(unknown.select(F.lit("unmatched_relief").alias("finding"), "campaignid", label, CODE, F.lit(1).cast("bigint").alias("n")))
    return union_by_name(*parts).select("finding", "campaignid", "sample", "class", CODE, "n")


def as_upload(spec: CampaignSpec, df: DataFrame, kind: str = "benthos") -> DataFrame:
    """The campaign's own columns and names for one of its two outputs."""
    r = spec.relief
    without = [] if kind == "benthos" and spec.keep_filename else ["filename"]
    if kind == "benthos":
        without += LEVELS[spec.depth :]
        without += [CODE] if spec.vocabulary == "code" and not spec.with_code else []
    elif r.mode == "native":
        without += [*LEVELS[5:], *TAXONOMY]
    elif not r.with_code and not r.relabel:
        without.append(CODE)
    out = df.filter(F.col("campaignid") == spec.campaignid).drop(*without)
    return out.withColumnsRenamed({"sample": spec.output_key, "count": spec.count_name})


def known(campaignid: str) -> CampaignSpec:
    return next(s for s in KNOWN_CAMPAIGNS if s.campaignid == campaignid)


__all__ = [
    "AS_IS", "CampaignSpec", "KNOWN_CAMPAIGNS", "ReliefSpec", "SampleRule", "TAXONOMY", "Tables", "as_upload", "benthos",
    "checks", "findings", "known", "per_campaign", "prepare", "prepare_relief", "relief",
]
