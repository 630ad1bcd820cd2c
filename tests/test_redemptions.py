"""Flattening and judging of redemption documents."""

import datetime as dt
from decimal import Decimal

import pytest
from feedtext import document, raw_json, txn

from feedlake.operators.parse import flatten_redemptions
from feedlake.plans.stages import evaluate_redemptions


def flatten(spark, documents):
    return flatten_redemptions(raw_json(spark, documents)).orderBy("source_row_number", "pos").collect()


def test_one_row_per_transaction(spark):
    rows = flatten(spark, [document("7", "20260926", [txn("A"), txn("B", miles="12.5")]), document("8", "x", [txn("C")])])
    assert [(r.source_row_number, r.pos, r.member_id, r.txn_id) for r in rows] == [
        (1, 0, "7", "A"), (1, 1, "7", "B"), (2, 0, "8", "C")]
    assert rows[0].feed_date == dt.date(2026, 9, 26) and rows[2].feed_date is None
    assert rows[0].txn_date == dt.date(2026, 9, 1)
    assert [r.miles_redeemed for r in rows] == [Decimal(100), Decimal(13), Decimal(100)]


def test_elements_do_not_carry_the_document(spark):
    """A document with many transactions must not be copied once per transaction."""
    df = flatten_redemptions(raw_json(spark, [document()]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    generate = next(text for text in plan.splitlines() if "Generate variant_explode" in text)
    kept = generate.split("], false, [")[0].split(", [")[-1]
    assert "member_id" in kept and "redemptions" not in kept and "raw_record" not in kept
    assert plan.count("parseJson") == 1


@pytest.mark.parametrize(
    "text, count",
    [
        ('{"member_id": "1"}', 0),
        ('{"member_id": "1", "redemptions": null}', 0),
        ('{"member_id": "1", "redemptions": []}', 0),
        ('{"member_id": "1", "redemptions": "none"}', 0),
        ('{"member_id": "1", "redemptions": 5}', 0),
        ('[{"member_id": "1", "redemptions": [{"txn_id": "A"}]}]', 0),
        ('{"member_id": "1", "redemptions": {"x": {"txn_id": "A"}, "y": {"txn_id": "B"}}}', 2),
        ('{"member_id": "1", "redemptions": [null, 3, {"txn_id": "A"}]}', 3),
        ('{"member_id": "1", "Redemptions": [{"txn_id": "A"}]}', 0),
    ],
)
def test_odd_shapes(spark, text, count):
    assert len(flatten(spark, [text])) == count


@pytest.mark.parametrize(
    "miles, expected",
    [
        (100, 100), ("100", 100), ("100.6", 101), (100.4, 100), ("-0.5", -1), ("1e3", 1000), ("abc", None),
        ("1,000", None), ("", None), (None, None), (True, None), ([1], None), ("999999999999999999", 999999999999999999),
        ("1000000000000000000", None), (0, 0),
    ],
)
def test_miles(spark, miles, expected):
    row = flatten(spark, [document(redemptions=[txn(miles=miles)])])[0]
    assert row.miles_redeemed == (None if expected is None else Decimal(expected))


def judge(spark, documents, members=("1", "2"), hot_rows=10**9):
    known = spark.createDataFrame([(member,) for member in members], "member_id string")
    rows = evaluate_redemptions(flatten_redemptions(raw_json(spark, documents)), known, hot_rows=hot_rows).collect()
    return {(r.source_row_number, r.pos): r.dq_reason for r in rows}


CASES = {
    "valid": (document(redemptions=[txn("a")]), None),
    "no member": (document(member=None, redemptions=[txn("b")]), "MEMBER_ID_MISSING"),
    "blank member is not missing": (document(member=" ", redemptions=[txn("c")]), "MEMBER_NOT_FOUND"),
    "unknown member": (document(member="RX", redemptions=[txn("RX10093")]), "MEMBER_NOT_FOUND"),
    "no date": (document(redemptions=[txn("d", date=None)]), "TXN_DATE_INVALID_OR_MISSING"),
    "no feed date": (document(feed_date="2026", redemptions=[txn("e")]), "FEED_DATE_INVALID_OR_MISSING"),
    "negative miles": (document(redemptions=[txn("f", miles=-1)]), "MILES_REDEEMED_INVALID"),
    "no miles": (document(redemptions=[txn("g", miles=None)]), "MILES_REDEEMED_INVALID"),
    "zero miles": (document(redemptions=[txn("h", miles=0)]), None),
    "lower-case status": (document(redemptions=[txn("i", status="pending")]), "STATUS_INVALID"),
    "no status": (document(redemptions=[txn("j", status=None)]), "STATUS_INVALID"),
    "no partner": (document(redemptions=[txn("k", partner=None)]), "PARTNER_MISSING"),
    "numeric member": (document(member=2, redemptions=[txn("l")]), None),
    "twice, first": (document(redemptions=[txn("dup")]), "DUPLICATE_TXN_ID"),
    "twice, second": (document(member="9", redemptions=[txn("dup")]), "DUPLICATE_TXN_ID; MEMBER_NOT_FOUND"),
    "no id, first": (document(redemptions=[txn(None)]), "TXN_ID_MISSING; DUPLICATE_TXN_ID"),
    "no id, second": (document(redemptions=[txn(None)]), "TXN_ID_MISSING; DUPLICATE_TXN_ID"),
    "all wrong": (
        document(None, None, [txn("m", None, None, "x", None)]),
        "MEMBER_ID_MISSING; TXN_DATE_INVALID_OR_MISSING; FEED_DATE_INVALID_OR_MISSING; MILES_REDEEMED_INVALID;"
        " STATUS_INVALID; PARTNER_MISSING",
    ),
}


@pytest.mark.parametrize("hot_rows", [1, 2, 10**9])
def test_reasons(spark, hot_rows):
    got = judge(spark, [doc for doc, _ in CASES.values()], hot_rows=hot_rows)
    assert got == {(number, 0): reason for number, (_, reason) in enumerate(CASES.values(), start=1)}


def test_a_single_missing_id_is_no_duplicate(spark):
    assert judge(spark, [document(redemptions=[txn(None)])]) == {(1, 0): "TXN_ID_MISSING"}
