"""What registered queries cost: each does its whole work, none does work twice."""

from __future__ import annotations

import os

from feedlake.plans import feeds, queries
from feedlake.sources.scratch import scratch_root


def _tables(spark, folder) -> str:
    customers = [(k, f"Customer {k}", float(k % 3 - 1), "BUILDING") for k in (1, 2, 3, 15, 16, 1002)]
    orders = [(o, o % 4 + 1, "FOP"[o % 3], "1-URGENT") for o in range(1, 12)]
    rows = spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string")
    rows.write.parquet(f"{folder}/customer.parquet")
    rows = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string")
    rows.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def _deliveries(spark) -> set[str]:
    return {name for name in os.listdir(f"{scratch_root(spark)}/feedlake") if name.startswith("delivered-")}


def test_every_daily_query_makes_its_own_lake_and_leaves_no_files(spark, tmp_path):
    sf_dir = _tables(spark, tmp_path)
    feeds.member_lines(spark, sf_dir)
    before = _deliveries(spark)
    first, second = queries.daily_lake(spark, sf_dir), queries.daily_lake(spark, sf_dir)
    assert first.root != second.root
    assert _deliveries(spark) == before
    assert len(first.published()) == len(second.published()) > 0


def test_files_hold_the_lines_of_the_feeds_and_texts_are_not_shuffled(spark, tmp_path, monkeypatch):
    sf_dir, landing = _tables(spark, tmp_path / "tables"), str(tmp_path / "landing")
    shuffled = []
    write = feeds._write_files
    monkeypatch.setattr(feeds, "_write_files", lambda rows, *args: (shuffled.append(rows.columns), write(rows, *args)))
    for batch_id in feeds.BATCHES:
        feeds.write_day(spark, sf_dir, landing, batch_id)
        for folder, feed, column, more in (
            ("member", feeds.member_lines(spark, sf_dir), "raw_record", 2), ("redemption", feeds.redemption_documents(spark, sf_dir), "raw_text", 0)
        ):
            expected = [row[column] for row in feed.where(feed.batch_id == batch_id).collect()]
            found = [row.value for row in spark.read.option("recursiveFileLookup", "true").text(f"{landing}/{folder}/{batch_id}").collect()]
            headers = found.count(feeds.HEADER)
            assert 0 < headers <= more or headers == more == 0
            assert sorted(line for line in found if line != feeds.HEADER) == sorted(expected)
    assert len(shuffled) == 4 and not any({"text", "raw_record", "raw_text"} & set(columns) for columns in shuffled)


def test_staged_members_are_the_valid_rows_of_a_written_table(spark, tmp_path):
    staged = queries._staged(spark, _tables(spark, tmp_path))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_valid,true)" in plan and "split(" not in plan
