"""Operators against hand-made cases and brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revloom.operators import (
    ascending,
    best_target,
    explode_links,
    fixed_size_batches,
    histogram,
    hot_keys,
    keep_first,
    labeled_pairs,
    lookup_join,
    number_rows,
    one_per_pair,
    pairs_in_row,
    quality,
)
from revloom.operators.links import best_in_row
from revloom.operators.lookup import HOT_SHARE
from revloom.operators.upsert import incremental_upsert, upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- keep_first --------------------------------------------------------------------------


def test_keep_first_orders_nulls_last_and_groups_null_keys(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("a", 4, 3), (None, 9, 4), (None, None, 5), ("b", None, 6)],
        "k string, o int, id int",
    )
    kept = keep_first(df, ["k"], ascending("o", "id"))
    assert rows(kept) == sorted([("a", 4, 3), (None, 9, 4), ("b", None, 6)], key=repr)


def test_keep_first_equals_row_number_on_random_rows(spark):
    rng = random.Random(3)
    data = [(rng.choice("xyz") if rng.random() > 0.4 else None, rng.randrange(5), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, o int, id int")
    expected = {}
    for k, o, i in data:
        expected[k] = min(expected.get(k, (99, 0)), (o, i))
    got = {k: (o, i) for k, o, i in keep_first(df, ["k"], ascending("o", "id")).collect()}
    assert got == expected


def test_keep_first_reduces_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("cast(id % 2 as string) k", "id")
    plan = keep_first(df, ["k"], ascending("id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange hashpartitioning(k")


# --- lookup_join ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 facts: a third on one key, a third NULL, the rest on 500 keys, some dangling."""
    fact = spark.range(30000).selectExpr(
        "id",
        "case id % 3 when 0 then 'hot' when 1 then null "
        "else concat('k', cast(pmod(hash(id), 500) as string)) end as key",
        "concat('payload', id % 7) as note",
    )
    dim = spark.range(401).selectExpr(
        "if(id = 400, 'hot', concat('k', id)) as key", "id * 10 as value"
    )
    return fact, dim


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_in_dim", [True, False])
def test_split_lookup_equals_plain_join(spark, skewed, how, hot_in_dim):
    fact, dim = skewed
    if not hot_in_dim:
        dim = dim.where("key <> 'hot'")
    split = lookup_join(fact, dim, "key", how, hot=hot_keys(fact, "key"))
    plain = fact.join(dim, "key", how)
    assert split.columns == plain.columns
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))


def test_split_lookup_spreads_the_hot_key_and_nulls(spark, skewed):
    fact, dim = skewed
    keep = {
        name: spark.conf.get(name)
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    }
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:

        def largest(df):
            sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
            return max(r["count"] for r in sizes)

        plain = largest(fact.join(dim, "key", "left"))
        split = largest(lookup_join(fact, dim, "key", hot=["hot"]))
    finally:
        for name, value in keep.items():
            spark.conf.set(name, value)
    assert plain >= 10000  # the hot key, in one task
    assert split < 6000  # 30,000 rows over 8 tasks


def test_lookup_without_named_hot_keys(spark, skewed):
    fact, dim = skewed
    found, plain = lookup_join(fact, dim, "key"), fact.join(dim, "key", "left")
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_hot_keys_are_a_bounded_list(spark, skewed):
    with pytest.raises(ValueError, match="hot keys"):
        lookup_join(*skewed, "key", hot=[f"k{n}" for n in range(HOT_SHARE + 1)])


def test_hot_keys_hold_more_than_their_share(spark, skewed):
    fact = skewed[0]
    counts = {r["key"]: r["count"] for r in fact.where("key is not null").groupBy("key").count().collect()}
    total = sum(counts.values())
    for share in (2, 100, 1500):
        assert set(hot_keys(fact, "key", share)) == {k for k, n in counts.items() if n > total / share}
    assert hot_keys(fact, "key", 100) == ["hot"]
    assert hot_keys(fact.limit(0), "key") == []
    assert len(hot_keys(fact, "key")) < HOT_SHARE


def test_split_lookup_without_a_hot_key(spark):
    fact = spark.range(5000).selectExpr("id", "if(id % 3 = 0, null, cast(id as string)) as key")
    dim = spark.range(4000).selectExpr("cast(id as string) as key", "id * 2 as value")
    assert hot_keys(fact, "key") == []
    split = lookup_join(fact, dim, "key", hot=hot_keys(fact, "key"))
    plain = fact.join(dim, "key", "left")
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))


def test_lookup_join_refuses_other_joins(spark, skewed):
    with pytest.raises(ValueError, match="left and inner"):
        lookup_join(*skewed, "key", "full")


# --- links ---------------------------------------------------------------------------------


LABEL = "contact_to_company"
LOOSE = "contact_to_company_unlabeled"
SHAPE = "hs_object_id string, associations string, _loaded_at timestamp"


def raw_links(spark, blobs):
    df = spark.createDataFrame(
        [(key, blob, None) for key, blob in blobs], SHAPE
    ).withColumn("associations", F.parse_json("associations"))
    return df.withColumn("_loaded_at", F.lit("2024-01-01").cast("timestamp"))


def listing(*links):
    items = ",".join(f'{{"id":"{i}","type":"{t}"}}' for i, t in links)
    return f'{{"companies":{{"results":[{items}]}}}}'


CASES = [
    ("1", listing(("9", LOOSE), ("9", LABEL))),
    ("2", listing(("9", LABEL), ("8", LOOSE))),
    ("3", listing(("7", LOOSE))),
    ("4", None),
    ("5", '{"companies":{}}'),
    ("6", '{"companies":{"results":[]}}'),
    ("7", '{"deals":{"results":[{"id":"1","type":"x"}]}}'),
    ("8", listing(("10", LABEL), ("9", LABEL), ("9", LABEL))),
    ("9", '{"companies":{"results":[{"id":5},{"id":"5","type":"contact_to_company"}]}}'),
    ("10", "null"),
]
PAIRS = [
    ("1", "9", LABEL),
    ("2", "8", LOOSE),
    ("2", "9", LABEL),
    ("3", "7", LOOSE),
    ("8", "10", LABEL),
    ("8", "9", LABEL),
    ("9", "5", LABEL),
]


def test_pairs_prefer_the_labeled_link(spark):
    raw = raw_links(spark, CASES)
    args = ("companies", "contact_id", "company_id")
    in_row = pairs_in_row(raw, *args, LABEL).drop("_loaded_at")
    across = one_per_pair(explode_links(raw, *args), "contact_id", "company_id", LABEL).drop("_loaded_at")
    assert rows(in_row) == rows(across) == sorted(PAIRS, key=repr)


def test_pairs_in_row_do_not_shuffle(spark):
    raw = raw_links(spark, CASES)
    plan = pairs_in_row(raw, "companies", "contact_id", "company_id", LABEL)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_best_target_takes_labeled_first_then_smallest_id(spark):
    raw = raw_links(spark, CASES)
    exploded = explode_links(raw, "companies", "contact_id", "company_id")
    expected = sorted([("1", "9"), ("2", "9"), ("3", "7"), ("8", "10"), ("9", "5")], key=repr)
    assert rows(best_target(exploded, "contact_id", "company_id", LABEL).drop("_loaded_at")) == expected
    in_row = raw.select("hs_object_id", best_in_row(raw, "companies", LABEL).alias("c")).where("c is not null")
    assert rows(in_row) == expected


def test_labeled_pairs_equal_pairs_filtered_afterwards(spark):
    exploded = explode_links(raw_links(spark, CASES), "companies", "contact_id", "company_id")
    pairs = one_per_pair(exploded, "contact_id", "company_id", LABEL)
    after = pairs.where(F.col("link_type") == LABEL).drop("link_type")
    assert rows(labeled_pairs(exploded, "contact_id", "company_id", LABEL)) == rows(after)


def test_copies_of_a_raw_row_collapse_across_rows(spark):
    raw = raw_links(spark, [("1", listing(("9", LABEL), ("9", LOOSE)))] * 500 + CASES[1:3])
    exploded = explode_links(raw, "companies", "contact_id", "company_id")
    pairs = one_per_pair(exploded, "contact_id", "company_id", LABEL).drop("_loaded_at")
    assert rows(pairs) == sorted([p for p in PAIRS if p[0] in "123"], key=repr)


# --- upsert ----------------------------------------------------------------------------------


def test_upsert_replaces_inserts_and_leaves_the_rest(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    batch = spark.createDataFrame([("b", 20, None), ("c", 30, "z")], "k string, v int, w string")
    merged = upsert(target, batch, ["k"])
    assert rows(merged) == sorted([("a", 1, "x"), ("b", 20, None), ("c", 30, "z")], key=repr)
    assert rows(upsert(merged, batch, ["k"])) == rows(merged)


def test_upsert_fills_columns_either_side_lacks(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("b", 2, "new")], "k string, v int, extra string")
    assert rows(upsert(target, batch, ["k"])) == [("a", 1, None), ("b", 2, "new")]


def test_upsert_refuses_a_key_given_twice(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int")
    with pytest.raises(Exception, match="duplicate key in batch: b"):
        upsert(target, batch, ["k"]).collect()


def test_upsert_latest_wins_when_asked(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 5), ("a", 7), ("b", 2)], "k string, v int")
    assert rows(upsert(target, batch, ["k"], latest_by=[F.col("v")])) == [("a", 7), ("b", 2)]


def test_incremental_upsert_takes_only_newer_rows(spark):
    target = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, v int, _loaded_at int")
    batch = spark.createDataFrame([("a", 100, 15), ("b", 200, 21), ("c", 300, 20)], target.schema)
    assert rows(incremental_upsert(target, batch, ["k"])) == [("a", 1, 10), ("b", 200, 21)]
    empty = target.limit(0)
    assert incremental_upsert(empty, batch, ["k"]).count() == 3


# --- batches -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("count", "size", "sizes"),
    [(0, 5, []), (3, 10, [3]), (4, 2, [2, 2]), (5, 2, [2, 2, 1]), (250, 100, [100, 100, 50])],
)
def test_batches_are_full_but_the_last(spark, count, size, sizes):
    df = spark.range(count).selectExpr("cast(id as string) id", "id as item")
    got = fixed_size_batches(df, "id", "item", size).orderBy("batch_no").collect()
    assert [r.batch_size for r in got] == sizes
    assert [r.batch_no for r in got] == list(range(len(sizes)))
    assert sorted(x for r in got for x in r["items"]) == list(range(count))


def test_row_numbers_have_no_gap_and_do_not_depend_on_the_cut(spark):
    df = spark.range(5000).selectExpr("cast(id as string) id")
    wide = {r.id: r.row_no for r in number_rows(df, "id").collect()}
    narrow = {r.id: r.row_no for r in number_rows(df, "id", digits=1).collect()}
    assert sorted(wide.values()) == list(range(5000))
    assert wide == narrow


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        fixed_size_batches(spark.range(1).selectExpr("id", "id as item"), "id", "item", 0)


# --- histogram -----------------------------------------------------------------------------------


def test_histogram_equals_brute_force(spark):
    rng = random.Random(5)
    values = [round(rng.random() * 100, 2) for _ in range(500)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "v double")
    present = [v for v in values if v is not None]
    low, high = min(present), max(present)
    expected = Counter(min(10, int(10 * (v - low) / (high - low)) + 1) for v in present)
    got = {r.bin: r.row_count for r in histogram(df, "v", 10).collect()}
    assert got == {b: expected.get(b, 0) for b in range(1, 11)}


def test_histogram_of_one_value_and_of_none(spark):
    one = histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 4)
    assert {r.bin: r.row_count for r in one.collect()} == {1: 2, 2: 0, 3: 0, 4: 0}
    assert histogram(spark.createDataFrame([], "v double"), "v", 4).count() == 0


def test_histogram_with_a_fixed_range_counts_the_upper_edge(spark):
    df = spark.createDataFrame([(0,), (100,), (99,), (50,)], "v int")
    got = {r.bin: r.row_count for r in histogram(df, "v", 20, 0.0, 100.0).collect() if r.row_count}
    assert got == {1: 1, 11: 1, 20: 2}


# --- checks ----------------------------------------------------------------------------------------


def test_checks_count_failures(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3)], "k string, v int")
    parent = spark.createDataFrame([("b",)], "k string")
    assert rows(quality.unique(df, "t", "k")) == [("unique:t.k", 1)]
    assert rows(quality.not_null(df, "t", ["k", "v"])) == [("not_null:t.k", 2), ("not_null:t.v", 1)]
    assert rows(quality.relationship(df, "t", "k", parent, "p", "k")) == [("relationship:t.k->p.k", 2)]
    assert rows(quality.run_suite({"none": df.where("v > 9"), "some": df.where("v > 1")})) == [
        ("none", 0, True),
        ("some", 2, False),
    ]


@pytest.mark.parametrize("test", ["unique", "keys"])
def test_keys_are_dealt_before_they_are_counted(spark, test):
    """Counting nearly distinct keys ahead of the shuffle, or in merged partitions, spilled them."""
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, None), ("b", 3)], "k string, v int")
    found = quality.unique(df, "t", "k") if test == "unique" else quality.keys(df, "t", ["k", "v"], "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = plan.index("Exchange hashpartitioning(_key")
    assert "REPARTITION_BY_NUM" in plan[dealt:].splitlines()[0]
    assert "HashAggregate" not in plan[dealt:] and plan.count("hashpartitioning") == 1
    expected = {"unique:t.k": 1} | ({"not_null:t.k": 2, "not_null:t.v": 2} if test == "keys" else {})
    assert dict(rows(found)) == expected


@pytest.mark.parametrize(
    ("hours", "status"), [(1, "pass"), (25, "pass"), (26, "warn"), (48, "warn"), (49, "error"), (None, "error")]
)
def test_freshness_limits(spark, hours, status):
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame([(hours,)], "h int").select(
        (F.lit("2024-02-01").cast("timestamp") - F.make_interval(hours=F.col("h"))).alias("_loaded_at")
    )
    if hours is None:
        df = df.limit(0)
    assert quality.freshness(df, "s", as_of, 25, 48).first().status == status
