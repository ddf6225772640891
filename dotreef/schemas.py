"""Canonical tables. Everything arrives as text; types are fixed here and nowhere else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.nulls import try_number

LEVELS = [f"level_{i}" for i in range(1, 9)]
TAXONOMY = ["family", "genus", "species"]
CODE = "caab_code"
LABELS = LEVELS + TAXONOMY


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

CLASSIFICATION = _struct(caab_code=_L, **{c: _S for c in LABELS})

METADATA = _struct(
    project=_S, campaignid=_S, sample=_S, latitude_dd=_D, longitude_dd=_D, date=_S, time=_S,
    date_time=T.TimestampType(), location=_S, status=_S, site=_S, depth_m=_D, observer=_S,
    successful_count=_S, successful_length=_S, successful_habitat_forward=_S,
    successful_habitat_backward=_S, comment=_S,
)

COUNTS = T.StructType(
    [T.StructField("campaignid", _S), T.StructField("sample", _S)]
    + CLASSIFICATION.fields
    + [T.StructField("count", _L)]
)

CROSSWALK_KEYS = {
    "catami": ["catami_l1", "catami_l2", "catami_l3"],
    "relief_text": ["catami_l5"],
    "broad_morphology_type": ["broad", "morphology", "type"],
    "l2_l3": ["catami_l2_l3", "catami_l4", "catami_l5"],
}


def conform(df: DataFrame, struct: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Add what is missing as typed NULLs, cast without failing, and put in order."""
    have = set(df.columns)
    out = []
    for f in struct.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.dataType == df.schema[f.name].dataType:
            out.append(F.col(f.name))
        elif isinstance(f.dataType, T.LongType) and isinstance(df.schema[f.name].dataType, T.StringType):
            out.append(try_number(f.name).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    if keep_extra:
        out += [F.col(c) for c in df.columns if c not in struct.fieldNames()]
    return df.select(*out)
