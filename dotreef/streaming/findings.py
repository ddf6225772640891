"""Checks that stay open until what they miss has arrived.

Annotations and metadata land in any order. Both sides are folded tables of a landing stream (dots per sample, deployments per sample), so the keyed
state of a check is a sum that late, changed and withdrawn files move up or down. What is open follows from the two sums alone; a log keeps when each
finding was opened and withdrawn.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import union_by_name
from ..operators.joins import lookup
from ..operators.qc import BY, expected_points
from .landing import Landing
from .levels import Levels, every

NO_METADATA, NO_DOTS, WRONG_COUNT = "annotations_missing_metadata", "metadata_missing_annotations", "wrong_point_counts"


def open_findings(dots: DataFrame, metadata: DataFrame, by: Sequence[str] = BY, per_image: int | Column | None = None,
                  flags: tuple[str, str] = ("successful_habitat_forward", "successful_habitat_backward")) -> DataFrame:
    """``finding, *by, n``: samples that only one side knows, ``n`` rows there; with ``per_image`` also samples whose dots are not as many as expected.

    ``dots`` has dots per sample in ``count``; ``metadata`` has rows in ``count`` per sample and whatever else is kept of a deployment.
    """
    none = F.lit(0).cast("long")
    left = dots.select(*by, F.col("count").alias("__dots"), none.alias("__rows"))
    right = metadata.select(*by, none.alias("__dots"), F.col("count").alias("__rows"))
    both = left.unionByName(right).groupBy(*by).agg(F.sum("__dots").alias("__dots"), F.sum("__rows").alias("__rows"))
    finding = F.when(F.col("__rows") == 0, NO_METADATA).when(F.col("__dots") == 0, NO_DOTS)
    found = both.filter("__dots + __rows > 0").select(finding.alias("finding"), *by, F.greatest("__dots", "__rows").alias("n")).filter("finding IS NOT NULL")
    if per_image is None:
        return found
    counted = dots.groupBy(*by).agg(F.sum("count").alias("n")).filter("n > 0")
    known = metadata.filter("count > 0").select(*by, *flags, F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("__copy"))
    wrong = lookup(counted, known, list(by)).withColumn("expected", expected_points(per_image, *flags)).filter("n <> expected")
    return union_by_name(found, wrong.select(F.lit(WRONG_COUNT).alias("finding"), *by, "n"))


class FindingsLog:
    """What was open when. Each look adds what has been opened and what has been withdrawn since the look before."""

    def __init__(self, spark: SparkSession, root: str, by: Sequence[str] = BY):
        self.by = list(by)
        self.levels = Levels(spark, root, {"events": every})

    def events(self) -> DataFrame | None:
        """``finding, *by, n, open, look``, one row per change."""
        return self.levels.read("events")

    def still_open(self) -> DataFrame | None:
        events = self.events()
        if events is None:
            return None
        keys = ["finding", *self.by]
        last = events.groupBy(*keys).agg(F.max_by(F.struct("n", "open"), F.col("look")).alias("last"))
        return last.filter("last.open").select(*keys, F.col("last.n").alias("n"))

    def look(self, found: DataFrame) -> int:
        """Compares ``found`` (``open_findings``) with what was open; returns the number of the look. NULL keys match NULL keys."""
        number, keys = self.levels.state().batch + 1, ["finding", *self.by]
        n = F.sum("n").alias("n")
        now = found.groupBy(*keys).agg(n).withColumn("__now", F.lit(1))
        before = self.still_open()
        both = now if before is None else union_by_name(now, before.withColumn("__now", F.lit(0)))
        now_n, old_n = (F.max(F.when(F.col("__now") == side, F.col("n"))).alias(name) for side, name in ((1, "__n"), (0, "__old")))
        changed = both.groupBy(*keys).agg(now_n, old_n).filter("NOT (__n <=> __old)")
        events = changed.select(*keys, F.coalesce("__n", "__old").alias("n"), F.col("__n").isNotNull().alias("open"), F.lit(number).cast("long").alias("look"))
        self.levels.commit(number, {"events": events})
        return number


def watch(dots: Landing, metadata: Landing, log: FindingsLog, **options) -> int:
    """One look at two landing streams; a side without a published state has seen nothing."""
    sides = [box.counts() for box in (dots, metadata)]
    if sides == [None, None]:
        return log.levels.state().batch
    made = [s if s is not None else next(x for x in sides if x is not None).limit(0) for s in sides]
    return log.look(open_findings(*made, by=log.by, **options))
