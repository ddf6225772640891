"""Scan of many delimited files whose headers differ, some with lines before the header.

A file up to ``WHOLE_FILE_BYTES`` is one row that is cut into lines where it is read: header,
column positions and rows come out of one scan without an exchange. A larger file is read
line by line and split like any other text; its header is found from its first block. Both give
the same rows, and the plan has the same size for ten files and for a million.

A quoted cell may hold line breaks. In a large file a line then has to know whether it starts inside a cell, which depends on all lines before it. Each line is a
function of that one bit; functions are composed per block, the blocks' functions in file order, and every block works on with the bit that it starts
with. Only files with a cell that goes on go through this.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.columns import clean_header
from ..operators.joins import anti_on, lookup, semi_on

PATH = "__path"
WHOLE_FILE_BYTES = 16 * 1024 * 1024
#: Distinct header names that are looked up by the driver, at most.
MOST_NAMES = 10_000


_UNENDED = "a quoted cell does not end: "


def _ends_inside(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted cell, if it starts outside of one, and if it starts inside."""
    mark = re.escape(sep)
    body = '[^"]*+(?:""[^"]*+)*+'
    cell = f'(?: *+"{body}" *+(?={mark})|(?! *+")[^{mark}]*+| *+(?:"[^"]*+")++[^"{mark}]*+)'
    opens = f'(?:{cell}{mark})*+ *+"{body}$'
    rest = F.regexp_replace(line, f'^{body}"(?!") *+', "")
    closes = line.rlike(f'^{body}"(?!") *+(?:{mark}|$)')
    after = F.regexp_replace(rest, f"^{mark}", "")
    inside = F.when(~closes, True).otherwise((rest != after) & after.rlike(f"^{opens}"))
    quoted = F.contains(line, F.lit('"'))
    return quoted & line.rlike(f"^{opens}"), ~quoted | inside


def _after(state: Column, out: Column, inside: Column) -> Column:
    return F.when(state, inside).otherwise(out)


def _before(by: list[str], order: list[str]) -> tuple[Column, Callable[[Column], Column]]:
    """The running number of flips (to be kept as ``__flips``), and the state before a row as a function of the state before the first row.

    It is what the last row that sets it says, turned around by each later one that flips it.
    """
    prior = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    sets = F.col("__a") == F.col("__b")
    flips = F.count_if(F.col("__a") & ~F.col("__b")).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    last = F.last(F.when(sets, F.struct(F.col("__a").alias("to"), F.col("__flips").alias("flips"))), ignorenulls=True).over(prior)
    since = F.coalesce(F.lag("__flips").over(W.partitionBy(*by).orderBy(*order)), F.lit(0)) - F.coalesce(last["flips"], F.lit(0))
    return flips, lambda start: F.coalesce(last["to"], start) != (since % 2 == 1)


def _whole_records(lines: DataFrame, sep: str, skip: int) -> DataFrame:
    """``lines`` with those that a quoted cell runs through put together again, in files that have any."""
    a, b = _ends_inside(F.col("value"), sep)
    torn = lines.filter(a).select(PATH).distinct()
    whole, lines = anti_on(lines, torn, PATH), semi_on(lines, torn, PATH)
    block, order = [PATH, "__start"], ["__id"]
    nth = F.row_number().over(W.partitionBy(*block).orderBy(*order))
    lines = lines.withColumn("__head", (F.col("__start") == 0) & (nth <= skip + 1))
    # Lines up to the header are no records: they leave the state as it is.
    lines = lines.withColumns({"__a": ~F.col("__head") & a, "__b": F.col("__head") | b})
    flips, state = _before(block, order)
    lines = lines.withColumn("__flips", flips)
    lines = lines.withColumns({"__if_out": state(F.lit(False)), "__if_in": state(F.lit(True))})

    # Each block as a function of the state it starts with, and the state it does start with.
    ends = F.max_by(F.struct(_after(F.col("__if_out"), F.col("__a"), F.col("__b")).alias("a"), _after(F.col("__if_in"), F.col("__a"), F.col("__b")).alias("b")), F.col("__id"))
    blocks = lines.groupBy(*block).agg(ends.alias("__ends")).select(*block, F.col("__ends.a").alias("__a"), F.col("__ends.b").alias("__b"))
    flips, state = _before([PATH], ["__start"])
    blocks = blocks.withColumn("__flips", flips).withColumn("__starts_in", state(F.lit(False)))
    last = F.max_by(_after(F.col("__starts_in"), F.col("__a"), F.col("__b")), F.col("__start")).alias("__open")
    unended = blocks.groupBy(PATH).agg(last).filter("__open").select(F.raise_error(F.concat(F.lit(_UNENDED), F.col(PATH))).cast("string").alias(PATH))

    known = lookup(lines, lookup(blocks.select(*block, "__starts_in"), unended.withColumn("__never", F.lit(True)), PATH), block)
    known = known.withColumn("__inside", F.when(F.col("__starts_in"), F.col("__if_in")).otherwise(F.col("__if_out")))
    # A record is named by the line that starts it, which may stand in an earlier block.
    here = F.struct(F.col("__start").alias("s"), F.col("__id").alias("i"))
    first = F.max(F.when(~F.col("__inside"), here)).over(W.partitionBy(*block).orderBy(*order))
    known = known.withColumn("__first", first)
    latest = known.groupBy(*block).agg(F.max("__first").alias("__latest"))
    earlier = F.max("__latest").over(W.partitionBy(PATH).orderBy("__start").rowsBetween(W.unboundedPreceding, -1)).alias("__earlier")
    known = lookup(known, latest.select(*block, earlier), block)
    known = known.withColumn("__record", F.coalesce("__first", "__earlier"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__start", "__id", "value"))), lambda x: x["value"]), "\n")
    records = known.groupBy(PATH, "__record").agg(text.alias("value"))
    joined = records.select("value", PATH, F.col("__record.s").alias("__start"), F.col("__record.i").alias("__id"))
    return whole.select("value", PATH, "__start", "__id").union(joined.select("value", PATH, "__start", "__id"))


def _cells(line: Column, sep: str) -> Column:
    """Cells of one line. Quotes around a whole cell protect separators and are taken off; doubled ones become one.

    A quote inside a cell is text. A cell that opens with a quote and does not close it anywhere in its file is an error. Every repeat is possessive, so a line
    costs time in proportion to its length.
    """
    mark = re.escape(sep)
    quoted = f' *+"[^"]*+(?:""[^"]*+)*+" *+(?={mark}|$)'
    cells = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f"{mark}({quoted}|[^{mark}]*+)"), 1)

    def unquote(c: Column) -> Column:
        bare = F.trim(c)
        inner = F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"'))
        marks = F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))
        broken = F.raise_error(F.concat(F.lit(_UNENDED), F.substring(c, 1, 80))).cast("string")
        opens = F.ltrim(c).startswith('"')
        closed = opens & c.rlike('" *$') & (F.length(bare) > 1) & (marks % 2 == 0)
        return F.when(closed, inner).when(opens & (marks % 2 == 1), broken).otherwise(c)

    return F.when(F.contains(line, F.lit('"')), F.transform(cells, unquote)).otherwise(F.split(line, mark))


def _small_files(spark: SparkSession, path, options: dict, sep: str, skip: int, limit: int) -> DataFrame:
    """path, header line and one row per record after it, for files up to ``limit`` bytes."""
    whole = spark.read.options(**options).text(path, wholetext=True).filter(F.col("_metadata.file_size") <= limit)
    text = F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r\n|\r", "\n")).otherwise(F.col("value"))
    cut = whole.select(F.col("_metadata.file_path").alias(PATH), text.alias("__text"))
    cut = cut.select(PATH, F.split("__text", "\n", skip + 2).alias("__top"))
    body, mark = F.coalesce(F.get("__top", F.lit(skip + 1)), F.lit("")), re.escape(sep)
    cell = f'(?: *+"[^"]*+(?:""[^"]*+)*+" *+(?={mark}|\n|\\z)|[^{mark}\n]*+)'
    records = F.regexp_extract_all(body, F.lit(f"({cell}(?:{mark}{cell})*+)(?:\n|\\z)"), 1)
    quoted = F.contains(body, F.lit('"'))
    lines = F.when(quoted, records).otherwise(F.split(body, "\n"))
    return cut.select(PATH, F.get("__top", F.lit(skip)).alias("__header"), lines.alias("__lines"))


def _large_files(spark: SparkSession, path, options: dict, sep: str, skip: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Headers per file, and all lines, of files above ``limit`` bytes."""
    lines = (
        spark.read.options(**options)
        .text(path)
        .filter(F.col("_metadata.file_size") > limit)
        .select(
            "value",
            F.col("_metadata.file_path").alias(PATH),
            F.col("_metadata.file_block_start").alias("__start"),
            F.monotonically_increasing_id().alias("__id"),
        )
    )
    # The scan hands out the rows of a block in order. The group is at most one block, and the
    # rank limit leaves skip + 1 lines of it before the exchange.
    first = lines.filter("__start = 0")
    nth = F.row_number().over(W.partitionBy(PATH).orderBy("__id"))
    top = first.withColumn("__n", nth).filter(F.col("__n") <= skip + 1)
    heads = top.groupBy(PATH).agg(F.sort_array(F.collect_list(F.struct("__n", "value"))).alias("__top"))
    heads = heads.select(
        PATH, F.get("__top", F.lit(skip))["value"].alias("__header"), F.col("__top.value").alias("__preamble")
    )
    return heads, _whole_records(lines, sep, skip)


def scan_ragged(
    spark: SparkSession,
    path: str | list[str],
    *,
    sep: str = "\t",
    skip: int = 4,
    glob: str | None = None,
    style: str = "snake",
    columns: Sequence[str] | None = None,
    na: Sequence[str] = ("",),
    trim: bool = False,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    rest: str | None = None,
    of_path: Sequence[Column] = (),
) -> DataFrame:
    """All files as one all-text table plus ``__path``.

    ``columns`` names what to read; a file without a column gives NULL there. ``rest`` names a map column for all other filled cells of a row, by their cleaned
    header; cells beyond the header go by their place (``cell_12``). Without ``columns`` the union of all headers is read, which costs a look at the headers
    first: their distinct names come to the driver, and more than ``MOST_NAMES`` of them (a row taken for a header, in many files) are an error there. Cells in
    quotes may hold separators and line breaks, the header may not hold a line break. ``of_path`` are columns that follow from ``__path``; they are worked
    out once per file, not per row, and stand before ``__path``.
    """
    options = {"recursiveFileLookup": "true"}
    if glob:
        options["pathGlobFilter"] = glob
    small = _small_files(spark, path, options, sep, skip, whole_file_bytes)
    heads, lines = _large_files(spark, path, options, sep, skip, whole_file_bytes)

    def named(df: DataFrame) -> DataFrame:
        return clean_header(df.withColumn("__names", _cells(F.col("__header"), sep)), "__names", style)

    small, heads = named(small), named(heads)
    if columns is None:
        found = small.select("__names").union(heads.select("__names"))
        found = found.select(F.explode("__names").alias("n")).distinct().limit(MOST_NAMES + 1)
        columns = sorted(r["n"] for r in found.collect())
        if len(columns) > MOST_NAMES:
            raise ValueError(f"the headers hold more than {MOST_NAMES} different names; name the columns to read, and one for the rest")
    # 1-based, 0 for a column the file does not have.
    at = F.array(*[F.array_position("__names", F.lit(c)).cast("int") for c in columns]).alias("__at")

    # Positions once per file, then the rows; empty files leave one NULL row, dropped below.
    carried = ["__at"] + ["__names"] * (rest is not None) + ["__of_path"] * bool(of_path)
    known_by = [F.struct(*of_path).alias("__of_path")] if of_path else []
    body = small.select(PATH, at, "__names", "__lines", *known_by).select(PATH, *carried, F.explode_outer("__lines").alias("value"))
    # Equal lines are interchangeable: of each text in the lines up to the header, as many copies go as stand there, wherever
    # the file is cut. Only lines with such a text are counted, all others pass.
    big = lookup(lines, heads.select(PATH, at, "__names", "__preamble", *known_by), PATH, "inner")
    known = F.array_contains("__preamble", F.col("value"))
    copies = big.filter(known).groupBy(PATH, "value").agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in (*carried, "__preamble")])
    left = F.col("__n") - F.size(F.filter("__preamble", lambda t: t == F.col("value")))
    again = copies.withColumn("__n", left).filter("__n > 0").select(PATH, *carried, "value", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")))
    big = big.filter(~known).select(PATH, *carried, "value").union(again.select(PATH, *carried, "value"))
    body = body.union(big).filter(F.col("value") != "")
    body = body.select(PATH, *carried, _cells(F.col("value"), sep).alias("__cells"))

    def cell(i: int) -> Column:
        # get() is NULL out of bounds, for an absent column as for a short row.
        c = F.get("__cells", F.get("__at", F.lit(i)) - 1)
        c = F.trim(c) if trim else c
        return F.when(~c.isin(list(na)), c)

    others = [] if rest is None else [_others(columns, na, trim).alias(rest)]
    return body.select(*[cell(i).alias(c) for i, c in enumerate(columns)], *others, *["__of_path.*"] * bool(of_path), PATH)


def _others(columns: Sequence[str], na: Sequence[str], trim: bool) -> Column:
    """Filled cells under headers that are not in ``columns``, by name."""
    entries = F.transform(
        "__cells",
        lambda c, i: F.struct(F.coalesce(F.get("__names", i), F.concat(F.lit("cell_"), (i + 1).cast("string"))).alias("key"), (F.trim(c) if trim else c).alias("value")),
    )
    return F.map_from_entries(F.filter(entries, lambda e: ~e["key"].isin(list(columns)) & ~e["value"].isin(list(na))))


def read_annotations(
    spark: SparkSession,
    path: str | list[str],
    *,
    columns: Sequence[str] | None = None,
    preamble: int = 4,
    glob: str | None = "*_Dot Point Measurements.txt",
    rest: str | None = None,
    of_path: Sequence[Column] = (),
) -> DataFrame:
    """Annotation exports: tab separated, four lines before the header, empty cells are NULL."""
    return scan_ragged(spark, path, sep="\t", skip=preamble, glob=glob, columns=columns, rest=rest, of_path=of_path)
