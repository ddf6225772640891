import random

import pytest
from pyspark.sql import functions as F

from conftest import bag
from dotreef.operators import joins
from dotreef.operators import joins as j


@pytest.fixture(params=["broadcast", "sort-merge"])
def strategy(request, spark):
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1" if request.param == "sort-merge" else old)
    yield request.param
    spark.conf.set(key, old)


@pytest.fixture
def sides(spark):
    """A third of the left rows share one key; NULL is a key too."""
    rnd = random.Random(7)
    keys = ["hot"] * 100 + [None] * 40 + [rnd.choice("abcdefgh") for _ in range(160)]
    left = [(k, None if i % 5 == 0 else i % 3, i) for i, k in enumerate(keys)]
    right = [(k, n, f"{k}{n}") for k in ("hot", None, "a", "b", "zz") for n in (None, 0, 1)] + [("a", 0, "again")]
    return (
        spark.createDataFrame(left, "k string, n int, v int"), spark.createDataFrame(right, "k string, n int, w string"),
        left, right,
    )


def test_null_matching_joins(strategy, sides):
    left, right, lrows, rrows = sides
    partners = {}
    for k, n, w in rrows:
        partners.setdefault((k, n), []).append(w)
    key = lambda r: (r[0], r[1])
    order = lambda rows: sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))
    want = [r + (w,) for r in lrows for w in partners.get(key(r), [None])]
    assert bag(j.lookup(left, right, ["k", "n"])) == order(want)
    assert bag(j.semi_on(left, right, ["k", "n"])) == order([r for r in lrows if key(r) in partners])
    assert bag(j.anti_on(left, right, ["k", "n"])) == order([r for r in lrows if key(r) not in partners])
    inner = [r + (w,) for r in lrows for w in partners.get(key(r), [])]
    assert bag(j.lookup(left, right, ["k", "n"], "inner")) == order(inner)


def test_semi_and_anti_split_the_left_side(sides):
    left, right, rows, _ = sides
    assert j.semi_on(left, right, "k").count() + j.anti_on(left, right, "k").count() == len(rows)


def test_keys_with_other_names_and_types(frame):
    a, b = frame("opcode int, v int", (1, 1), (2, 2)), frame("sample bigint, w string", (1, "x"))
    assert bag(j.lookup(a, b, [("opcode", "sample")])) == [(1, 1, "x"), (2, 2, None)]
    assert bag(j.semi_on(a, b, [("opcode", "sample")])) == [(1, 1)]


def test_suffix_on_collision(frame):
    a, b = frame("k int, c int", (1, None)), frame("k int, c int", (1, 5))
    out = j.lookup(a, b, "k", suffix="_tax")
    assert bag(out) == [(1, None, 5)] and out.columns == ["k", "c", "c_tax"]


def test_natural_join_uses_all_shared_columns(frame, caplog):
    a, b = frame("k int, l string, v int", (1, None, 1), (1, "x", 2)), frame("l string, k int, w int", (None, 1, 9))
    with caplog.at_level("INFO"):
        assert bag(j.natural_join(a, b)) == [(1, "x", 2, None), (1, None, 1, 9)]
    assert "['k', 'l']" in caplog.text
    assert bag(j.natural_join(a, b, "left_anti")) == [(1, "x", 2)]
    with pytest.raises(ValueError):
        j.natural_join(a, b.select("w"))


def test_full_join_coalesces_keys(frame):
    a, b = frame("c string, r int", ("x", 1), (None, 2)), frame("c string, b int", (None, 3), ("y", 4))
    assert bag(j.full_on(a, b, "c")) == [("x", 1, None), ("y", None, 4), (None, 2, 3)]
    with pytest.raises(ValueError):
        j.full_on(a, a, "c")


def test_presence_and_setdiff(frame):
    a, b = frame("c string, s int", ("x", 1), ("x", 1), (None, 2)), frame("c string, s int", (None, 2), ("y", 3))
    assert bag(j.presence_diff(a, b, ["c", "s"])) == [("x", 1, True, None), ("y", 3, None, True)]
    assert bag(j.value_setdiff(a, b, "c")) == [("x",)]
    assert bag(j.duplicate_keys(a, ["c"])) == [("x", 2)]


def test_distinct_keys_hand_their_partitioning_to_the_join(spark, strategy):
    if strategy == "broadcast":
        pytest.skip("only a sort-merge join needs a partitioning")
    left = spark.range(100).select(F.col("id").alias("k"))
    counted = j.counted_lookup(left, spark.range(50).select(F.col("id").alias("k")), "k", "n")
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    plan = j.anti_on(left, spark.range(50).select(F.col("id").alias("k")), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_key_types(spark):
    left = spark.createDataFrame([(1, 1.0, "1", None), (2, 2.5, "x", True)], "i int, d double, s string, b boolean")
    right = spark.createDataFrame([(1, "one"), (2, "two")], "k bigint, w string")
    assert bag(j.lookup(left.select("d"), right, [("d", "k")])) == [(1.0, "one"), (2.5, None)]
    assert bag(j.lookup(left.select("i"), right, [("i", "k")])) == [(1, "one"), (2, "two")]
    assert bag(j.lookup(left.select("s"), right, [("s", "k")])) == [("1", "one"), ("x", None)]
    for key in ("b",):
        with pytest.raises(TypeError):
            j.lookup(left, right, [(key, "k")])
    with pytest.raises(TypeError):
        j.lookup(left, right.withColumn("k", F.col("k").cast("string")), [("d", "k")])


def test_one_key_of_identical_rows_is_spread(spark):
    """The skew join of adaptive execution cuts a hot key between map tasks: no salt, nothing repeated."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(0, 400_000, 1, 8).select(F.lit("hot").alias("k"), F.sha2(F.lit("x"), 256).alias("v"))
        cold = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit("y").alias("v"))
        right = spark.createDataFrame([("hot", 1), ("5", 2)], "k string, w int")
        for joined in (j.lookup(hot.union(cold), right, ["k"]), j.anti_on(hot.union(cold), right.where("w = 2"), ["k"])):
            rows = joined.withColumn("task", F.spark_partition_id()).where("k = 'hot'").groupBy("task").count().collect()
            assert sum(r["count"] for r in rows) == 400_000 and len(rows) >= 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_materialised_side_is_what_was_estimated(spark):
    right = spark.range(3000).select(F.col("id").alias("k"), F.lit("w").alias("w"))
    joined = j.lookup(spark.range(10).select(F.col("id").alias("k")), right, ["k"])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan


def test_unique_lookups_raise_where_a_key_would_multiply(frame):
    from pyspark.errors import PySparkException

    left = frame("k string, n int", ("a", 1), ("b", 2), (None, 3), ("z", 4))
    right = frame("k string, v int", ("a", 1), ("b", 2), (None, 5), ("unused", 1), ("unused", 2))
    assert bag(joins.lookup(left, right, "k", unique=True)) == bag(joins.lookup(left, right, "k"))
    assert bag(joins.lookup(left, right, "k", "inner", unique=True)) == bag(joins.lookup(left, right, "k", "inner"))
    for twice in (("a", 9), (None, 9)):
        double = right.union(frame("k string, v int", twice))
        for df in (joins.lookup(left, double, "k", unique=True), joins.lookup(left, double, "k", unique=True).select("n"), joins.natural_join(left, double, unique=True)):
            with pytest.raises(PySparkException, match="occurs 2 times"):
                df.collect()
        assert bag(joins.fan_outs(left, double, "k")) == [(twice[0], 1, 2)]
    assert joins.fan_outs(left, right, "k").isEmpty()


def test_strict_relabel(frame):
    from pyspark.errors import PySparkException

    from dotreef.operators import classify

    points = frame("campaignid string, sample string, broad string", ("c", "s", "x"), ("c", "s", "x"))
    walk = frame("broad string, caab_code bigint", ("x", 1))
    schema = frame("caab_code bigint, level_1 string, level_2 string", (1, "Biota", "Sponges"), (2, "Biota", "Sponges"))
    loose = classify.counts_with_relabel(points, walk, schema, ["broad"])
    assert bag(loose, "caab_code", "count") == [(1, 2), (2, 2)]
    with pytest.raises(PySparkException, match="occurs 2 times"):
        classify.counts_with_relabel(points, walk, schema, ["broad"], unique=True).collect()
