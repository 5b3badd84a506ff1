"""Numbering and unique keys, also when groups exceed one task."""

import random

import pytest
from pyspark.sql import functions as F

from tablework.operators.keys import unique_keys
from tablework.operators.numbering import dense_ids, first_per_group, number_within
from tablework.runtime import hot_keys


def skewed(spark, n=2_000):
    """A third of all rows under one key, some under NULL."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))
    )
    return spark.range(n).select(key.alias("key"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("v"), "id")


def expected_positions(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r["v"], r["id"])):
        groups.setdefault(r["key"], []).append(r["id"])
    return {(k, i): p for k, ids in groups.items() for p, i in enumerate(ids)}


@pytest.mark.parametrize("max_group", [1_000_000, 100, 1])
def test_number_within_matches_brute_force(spark, max_group):
    df = skewed(spark)
    found = number_within(df, ["key"], ["v", "id"], "pos", max_group).collect()
    assert {(r["key"], r["id"]): r["pos"] for r in found} == expected_positions(df.collect())
    assert len(found) == df.count()


@pytest.mark.parametrize("max_group", [1_000_000, 10])
def test_dense_ids_have_no_gaps(spark, max_group):
    found = dense_ids(skewed(spark), ["v", "id"], "n", max_group).orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(2_000))
    assert [(r["v"], r["id"]) for r in found] == sorted((r["v"], r["id"]) for r in found)


def test_many_hot_keys_keep_the_bound(spark):
    few, many = (hot_keys(skewed(spark), ["key"], 1, max_keys=n) for n in (10_000, 3))
    assert few.count() == many.count() > 3
    assert hot_keys(skewed(spark), ["key"], 10_000) is None


def test_numbering_with_more_hot_keys_than_a_broadcast_takes(spark, monkeypatch):
    from tablework import runtime
    from tablework.operators import numbering

    monkeypatch.setattr(numbering, "hot_keys", lambda df, keys, bound: runtime.hot_keys(df, keys, bound, max_keys=3))
    df = skewed(spark)
    found = number_within(df, ["key"], ["v", "id"], "pos", 1).collect()
    assert {(r["key"], r["id"]): r["pos"] for r in found} == expected_positions(df.collect())


def test_first_per_group_limits_before_the_shuffle(spark, plan):
    text = plan(first_per_group(skewed(spark), ["key"], [F.desc("v")], 2), "simple")
    assert text.count("WindowGroupLimit") == 2


def brute_keys(bases):
    """n-th repeat of a base takes the n-th counter no other base spells out."""
    naturals, seen, out = set(bases), {}, []
    for base in bases:
        n = seen.get(base, 0)
        if n == 0:
            key, counter = base, 0
        else:
            counter = n
            while f"{base}_{counter}" in naturals:
                counter += 1
            key = f"{base}_{counter}"
        seen[base] = counter + 1
        out.append(key)
    return out


@pytest.mark.parametrize("max_group", [1_000_000, 2])
def test_unique_keys_skip_natural_names(spark, max_group):
    rng = random.Random(5)
    bases = ["run", "run_1", "run_3", "run_4", "run_01", "run_1_1", "other", "other_2"]
    drawn = [rng.choice(bases) for _ in range(60)]
    rows = [(b, f"/p/{i:03d}") for i, b in enumerate(drawn)]
    df = spark.createDataFrame(rows, "base string, path string")
    found = unique_keys(df, "base", ["path"], "key", max_group).orderBy("path").collect()
    keys = [r["key"] for r in found]
    assert keys == brute_keys(drawn)
    assert len(set(keys)) == len(keys)
