"""Tables that grow by batches and are published by one small file.

A batch adds one part to each table. ``fan`` parts of a level are folded into one part of the next, so that a table of n batches is at most
``fan - 1`` parts in each of log n levels, and each row is folded that many times at most. Which parts make up the tables stands in a state file;
a new state is a new file with the next number, written whole under another name and then renamed. A reader takes the last state there is: it sees
all tables before a batch or after it, never between. Parts that the last ``keep`` states do not name are deleted, so a reader may stay behind
by that many batches.

One writer at a time, as the checkpoint of a stream ensures. A batch that runs again after its state was published changes nothing; one that failed
before writes its parts anew.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import union_by_name
from ..sources.files import Files

#: Parts of one level that are folded into one of the next; states that stay readable.
FAN, KEEP = 8, 3

Fold = Callable[[DataFrame], DataFrame]


def sums(total: str = "count") -> Fold:
    """Rows with equal keys add up; what adds up to nothing goes."""

    def fold(df: DataFrame) -> DataFrame:
        keys = [c for c in df.columns if c != total]
        added = df.groupBy(*keys).agg(F.sum(total).cast(df.schema[total].dataType).alias(total))
        return added.filter(F.col(total) != 0).select(*df.columns)

    return fold


def latest(key: str, order: str) -> Fold:
    """Of rows with one key the one with the largest ``order`` stays."""

    def fold(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c != key]
        last = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__row"))
        return last.select(*[F.col(c) if c == key else F.col(f"__row.{c}").alias(c) for c in df.columns])

    return fold


def every(df: DataFrame) -> DataFrame:
    """All rows stay; folding only brings them together."""
    return df


@dataclass
class State:
    """``batch``: the last one in it. ``parts``: (level, folder) by table. ``note``: what the writer wants to find again."""

    number: int = -1
    batch: int = -1
    parts: dict[str, list[tuple[int, str]]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    note: list[str] = field(default_factory=list)


class Levels:
    def __init__(self, spark: SparkSession, root: str, folds: Mapping[str, Fold], fan: int = FAN, keep: int = KEEP):
        self.spark, self.root, self.folds, self.fan, self.keep = spark, root.rstrip("/"), dict(folds), fan, keep
        self.files = Files(spark, root)

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.root}/_state") if n.endswith(".json")]

    def state(self, number: int | None = None) -> State:
        """The last state, or the one with the given number; an empty one before the first batch."""
        there = self._numbers()
        if not there:
            return State()
        number = there[-1] if number is None else number
        held = json.loads(self.files.read(f"{self.root}/_state/{number:012d}.json"))
        parts = {t: [(level, folder) for level, folder in p] for t, p in held["parts"].items()}
        return State(number, held["batch"], parts, held["schemas"], held["note"])

    def schema(self, table: str) -> T.StructType | None:
        held = self.state().schemas.get(table)
        return None if held is None else T.StructType.fromJson(json.loads(held))

    def _rows(self, state: State, table: str, folders: list[str]) -> DataFrame:
        struct = T.StructType.fromJson(json.loads(state.schemas[table]))
        reader = self.spark.read.schema(struct)
        return union_by_name(*[reader.parquet(f"{self.root}/{f}") for f in folders])

    def read(self, table: str, number: int | None = None) -> DataFrame | None:
        """The folded table of a state; None before its first batch."""
        state = self.state(number)
        if not state.parts.get(table):
            return None
        return self.folds[table](self._rows(state, table, [f for _, f in state.parts[table]]))

    def commit(
        self, batch: int, new: Mapping[str, DataFrame], note: list[str] | None = None, also: Mapping[str, T.StructType] | None = None
    ) -> bool:
        """Adds ``new`` rows to the tables, as one batch. False if a state with this batch is there already.

        ``also``: schemas of tables that are kept elsewhere, to be found again.
        """
        state = self.state()
        if state.batch >= batch:
            return False
        for table, df in new.items():
            state.schemas[table] = df.schema.json()
            parts = state.parts.setdefault(table, [])
            parts.append((0, self._write(df, table, batch, 0)))
            level = 0
            while len(due := [p for p in parts if p[0] == level]) >= self.fan:
                folded = self.folds[table](self._rows(state, table, [f for _, f in due]))
                parts = [p for p in parts if p[0] != level] + [(level + 1, self._write(folded, table, batch, level + 1))]
                level += 1
            state.parts[table] = parts
        state.schemas |= {table: struct.json() for table, struct in (also or {}).items()}
        held = {"batch": batch, "parts": state.parts, "schemas": state.schemas, "note": note or []}
        self.files.publish(f"{self.root}/_state/{state.number + 1:012d}.json", json.dumps(held))
        self._clean()
        return True

    def _write(self, df: DataFrame, table: str, batch: int, level: int) -> str:
        folder = f"{table}/{batch:012d}-{level}"
        df.write.mode("overwrite").parquet(f"{self.root}/{folder}")
        return folder

    def _clean(self) -> None:
        numbers = self._numbers()
        named = {f for n in numbers[-self.keep :] for p in self.state(n).parts.values() for _, f in p}
        for table in self.folds:
            for name in self.files.names(f"{self.root}/{table}"):
                if f"{table}/{name}" not in named:
                    self.files.delete(f"{self.root}/{table}/{name}")
        for n in numbers[: -self.keep]:
            self.files.delete(f"{self.root}/_state/{n:012d}.json")
