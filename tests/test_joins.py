"""Size-checked joins, hot keys and defaulted lookups."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.operators import hot_keys, latest_by_key, lookup_join, measured_bytes, order_wide, sized_join

FORCED = {"small": False, "share": 0.1, "min_rows": 0}


@pytest.fixture(params=[True, False], ids=["split-by-hand", "split-by-aqe"])
def by_hand(request, spark):
    """Both ways to treat skew."""
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    spark.conf.set(name, str(not request.param).lower())
    yield request.param
    spark.conf.set(name, "true")


def bag(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture
def skewed(spark):
    """1,000 rows: a third with key 7, a fifth without key, the rest spread out."""
    n = F.col("id")
    key = F.when(n < 333, 7).when(n < 533, None).otherwise(n)
    return spark.range(1000).select(n.alias("row"), key.cast("bigint").alias("k")).repartition(7)


@pytest.fixture
def dim(spark):
    return spark.range(0, 1000, 2).select((F.col("id") + 1).alias("k"), F.concat(F.lit("v"), "id").alias("v")).filter("k <> 7").unionByName(
        spark.sql("SELECT 7L AS k, 'hot' AS v")
    )


def test_hot_keys_are_found(skewed):
    assert hot_keys(skewed, ["k"], 0.1, 0) == ([(7,)], True)
    assert hot_keys(skewed, ["k"], 0.1, 500) == ([], False)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_do_not_change_the_result(skewed, dim, how, by_hand):
    plain = skewed.join(dim, ["k"], how)
    assert bag(sized_join(skewed, dim, ["k"], how, **FORCED)) == bag(plain)
    assert bag(sized_join(skewed, dim, ["k"], how)) == bag(plain)


def test_hot_rows_are_not_shuffled(spark, skewed, dim, by_hand):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sized_join(skewed, dim, ["k"], "left", **FORCED)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and ("BroadcastHashJoin" in plan) == by_hand


def test_two_key_columns(spark, by_hand):
    left = spark.createDataFrame([(1, "a", i) for i in range(50)] + [(2, None, 50), (3, "c", 51)], "a int, b string, r int")
    right = spark.createDataFrame([(1, "a", "x"), (3, "c", "y"), (2, None, "z")], "a int, b string, v string")
    assert bag(sized_join(left, right, ["a", "b"], "left", **FORCED)) == bag(left.join(right, ["a", "b"], "left"))


def test_size_grows_with_the_text(spark):
    small, large = (spark.range(10).select(F.repeat(F.lit("x"), n).alias("t")) for n in (1, 1000))
    assert measured_bytes(large) - measured_bytes(small) == 9990


def test_small_side_is_broadcast_and_large_is_not(spark, skewed, dim):
    def plan(limit):
        return sized_join(skewed, dim, ["k"], broadcast_bytes=limit)._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(None)
    assert "strategy=broadcast" not in plan(10)


# ---------------------------------------------------------------- lookups


@pytest.fixture
def facts(rows):
    return rows([(1, "a", "old"), (2, "b", "old"), (3, "z", "old"), (4, None, "old")], "id int, k string, name string")


def looked_up(df):
    return {r["id"]: r["name"] for r in df.collect()}


@pytest.mark.parametrize("options", [{}, FORCED])
def test_defaults_on_a_miss_only(facts, rows, options, by_hand):
    names = rows([("a", "A"), ("b", None), (None, "nobody")], "key string, name string")
    assert looked_up(lookup_join(facts, names, ("k", "key"), ["name"], **options)) == {1: "A", 2: None, 3: C.NO_INFO, 4: C.NO_INFO}
    assert looked_up(lookup_join(facts, names, ("k", "key"), ["name"], how="inner", **options)) == {1: "A", 2: None}


def test_versions_of_a_key(facts, rows):
    names = rows([("a", "A1", 1), ("a", "A3", 3), ("a", "A2", 2)], "key string, name string, version int")
    got = lookup_join(facts, names, ("k", "key"), ["name"], {"name": "-"}, latest=["version"])
    assert looked_up(got) == {1: "A3", 2: "-", 3: "-", 4: "-"}


def test_key_types_may_differ(rows):
    facts = rows([(7, 1), (8, 2)], "mid long, id int")
    names = rows([("7", "seven"), ("x8", "no number")], "mid string, name string")
    assert looked_up(lookup_join(facts, names, ("mid", "mid"), ["name"])) == {1: "seven", 2: C.NO_INFO}


def test_order_defaults(rows):
    orders = rows([(1, 5)], "id int, mid long")
    places = rows([], "mid string, province string, city string")
    contracts = rows([], "machine_num string, " + ", ".join(f"{c} string" for c in C.CONTRACT_COLUMNS))
    row = order_wide(orders, places, contracts).first()
    assert (row["province"], row["inv_rate"], row["age_rate"], row["ground_name"]) == (C.NO_INFO, "100.0", "0.0", C.NO_INFO)
    assert order_wide(orders, places, contracts, strict=True).count() == 0


# ---------------------------------------------------------------- latest


def test_latest_keeps_nulls_and_ignores_row_order(rows):
    data = [("a", 1, 1, "old"), ("a", 2, 1, None), ("b", 5, 1, "x"), ("b", 5, 2, "y"), ("c", None, None, "only")]
    for order in (data, data[::-1]):
        df = rows(order, "k string, ts int, xid int, v string")
        got = {r["k"]: r["v"] for r in latest_by_key(df, ["k"], ["ts", "xid"]).collect()}
        assert got == {"a": None, "b": "y", "c": "only"}


def test_latest_combines_before_the_shuffle(rows):
    df = rows([("a", 1, "x")], "k string, ts int, v string")
    plan = latest_by_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_latest_with_columns_that_have_no_order(rows):
    df = rows([("a", 1, {"x": "1"}), ("a", 2, {"x": "2"})], "k string, ts int, m map<string,string>")
    assert latest_by_key(df, ["k"], ["ts"]).first()["m"] == {"x": "2"}


def test_two_lookups_by_one_key_shuffle_the_facts_once(spark, rows):
    orders = spark.range(1000).select(F.col("id"), (F.col("id") % 50).alias("mid"))
    places = rows([("1", "p", "c")], "mid string, province string, city string")
    contracts = rows([], "machine_num string, " + ", ".join(f"{c} string" for c in C.CONTRACT_COLUMNS))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = order_wide(orders, places, contracts, small=False, unique=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_mid") == 3


def test_adaptive_execution_splits_a_hot_key(spark):
    """A third of the rows share a key; the join reads its partition in several tasks."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    left = spark.range(0, 300000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.rand(1).alias("x")
    )
    right = spark.range(300000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        joined = sized_join(left, right, ["k"], small=False)
        assert len(joined.collect()) == 300000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.conf.unset(name)


def test_a_doubled_key_does_not_double_facts(rows):
    from millrace.operators import lookup_join

    facts = rows([("1",), ("2",)], "k string")
    dim = rows([("1", "old", 1), ("1", "new", 2)], "k string, v string, at int")
    for latest, want in ((["at"], "new"), (None, "old")):
        got = lookup_join(facts, dim, ("k", "k"), ["v"], latest=latest).collect()
        assert sorted(map(tuple, got)) == [("1", want), ("2", "无信息")]


def test_strict_orders_need_a_province_and_a_rate(rows):
    from millrace import constants as C
    from millrace.operators import order_wide

    orders = rows([(1, 1), (2, 2), (3, 3)], "id long, mid long")
    places = rows([("1", "p", "c"), ("2", None, "c"), ("3", "p", "c")], "mid string, province string, city string")
    contract = [(m, "n", "p", r, "1", "1", "1", "s", None) for m, r in (("1", "40"), ("2", "40"), ("3", None))]
    contracts = rows(contract, "machine_num string, " + ", ".join(f"{c} string" for c in C.CONTRACT_COLUMNS))
    assert [r["id"] for r in order_wide(orders, places, contracts, strict=True).collect()] == [1]
    assert order_wide(orders, places, contracts).count() == 3


def test_revenue_with_the_address_of_the_place(rows):
    from millrace import constants as C
    from millrace.operators import order_revenue, order_wide

    orders = rows([(1, 5, 300.0, "n", "20200105")], "id long, mid long, amount double, pkg_name string, bill_date string")
    places = rows([("5", "p", "c", "street")], "mid string, province string, city string, address string")
    contracts = rows([("5", "n", "p", "40", "30", "20", "10", "scene", None)], "machine_num string, " + ", ".join(f"{c} string" for c in C.CONTRACT_COLUMNS))
    wide = order_wide(orders, places, contracts, location_columns=("province", "city", "address"))
    assert order_revenue(wide, address_from="place").first()["address"] == "street"
    assert order_revenue(wide).first()["address"] == "scene"
