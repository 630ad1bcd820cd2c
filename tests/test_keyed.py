"""Per-key results attached to rows: equal to plain counting whatever is hot."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedlake.operators import keyed
from feedlake.operators.keyed import absent_keys, attach, key_sizes, with_exists, with_key_size
from feedlake.sources.scratch import materialise


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the rows has one key, a third has none, the rest has keys of one to five rows."""
    path = str(tmp_path_factory.mktemp("skewed"))
    spark.range(9_000).selectExpr(
        "id",
        "case when id < 3000 then 'hot' when id < 6000 then null else concat('k', cast(sqrt(id - 6000) * 30 as int)) end as key",
    ).write.parquet(path + "/t")
    return spark.read.parquet(path + "/t")


@pytest.mark.parametrize("hot_rows", [1, 2, 1_000, 10**9])
@pytest.mark.parametrize("max_hot", [1, 10_000])
def test_key_sizes_at_rows(spark, skewed, monkeypatch, hot_rows, max_hot):
    monkeypatch.setattr(keyed, "MAX_HOT_KEYS", max_hot)
    expected = Counter(r.key for r in skewed.collect())
    rows = with_key_size(skewed, ["key"], "n", hot_rows).collect()
    assert sorted(r.id for r in rows) == list(range(9_000))
    assert all(r.n == expected[r.key] for r in rows)


@pytest.mark.parametrize("hot_rows", [1, 1_000, 10**9])
@pytest.mark.parametrize("known_hot", [True, False])
def test_existence(spark, skewed, hot_rows, known_hot):
    lookup = skewed.where("key like 'k%' and id % 2 = 0").select("key")
    if known_hot:
        lookup = lookup.union(spark.createDataFrame([("hot",), ("hot",), (None,)], "key string"))
    known = {r.key for r in lookup.collect()} - {None}
    rows = with_exists(skewed, lookup, ["key"], "known", hot_rows).collect()
    assert sorted(r.id for r in rows) == list(range(9_000))
    assert all(r.known == (r.key in known) for r in rows)


def test_two_part_key_with_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, None), (None, "a"), (None, None), (1, "a")], "x int, y string")
    got = Counter((r.x, r.y, r.n) for r in with_key_size(df, ["x", "y"], "n", 2).collect())
    assert got == {(1, "a", 2): 2, (1, None, 2): 2, (None, "a", 1): 1, (None, None, 1): 1}


def test_rows_are_read_once_and_hot_ones_spread(spark, skewed):
    """One scan of the rows; those of a hot key get their answer by broadcast and are dealt by their own hash."""
    stats = materialise(key_sizes(skewed, ["key"]).where("key_rows > 1"), "stats")
    attached = attach(skewed, stats, ["key"], hot_rows=1_000)
    plan = attached._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and plan.count("struct<id:bigint,key:string>") == 1
    assert attached.where("key = 'hot'").agg(F.min("key_rows"), F.count("*")).first() == (3000, 3000)


def test_absent_keys_have_row_counts(spark, skewed):
    none = spark.createDataFrame([], "key string")
    found = {r.key: r.key_rows for r in absent_keys(skewed, none, ["key"]).collect()}
    expected = Counter(r.key for r in skewed.collect() if r.key is not None)
    assert found == expected
