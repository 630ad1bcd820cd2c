"""Parsing and data-quality rules on literal lines: each reason alone, combined and at its limit."""

import datetime as dt

import pytest
from feedtext import line, raw

from feedlake.operators.parse import parse_lines
from feedlake.operators.rules import Rule, evaluate, reason_counts, split_valid
from feedlake.plans.stages import evaluate_members
from feedlake.schemas import MEMBER_CONTRACT, ContractError, Field, FeedContract

CASES = {
    "valid": (line(), None),
    "one field short": ("|D|Ann|1|20100115|20260901|GOLD|Bo|NY|USA|03051985", "FIELD_COUNT_MISMATCH; IS_ACTIVE_MISSING"),
    "one field more": (line(more="|x"), "FIELD_COUNT_MISMATCH"),
    "no name": (line(name=""), "MEMBER_NAME_MISSING"),
    "blank id": (line(member="   "), "MEMBER_ID_MISSING"),
    "no enrolment": (line(enrolled=""), "ENROLLMENT_DATE_MISSING"),
    "impossible enrolment": (line(enrolled="20200230"), "ENROLLMENT_DATE_INVALID"),
    "short enrolment": (line(enrolled="2020115"), "ENROLLMENT_DATE_INVALID"),
    "signed enrolment": (line(enrolled="-20200115"), "ENROLLMENT_DATE_INVALID"),
    "five-digit year": (line(enrolled="+120200115"), "ENROLLMENT_DATE_INVALID"),
    "no flight": (line(flight=""), None),
    "dashed flight": (line(flight="2026-01-01"), "LAST_FLIGHT_DATE_INVALID"),
    "no birth date": (line(dob=""), None),
    "month first birth date": (line(dob="05311985"), "DOB_INVALID"),
    "no country": (line(country=""), "COUNTRY_MISSING"),
    "lower-case country": (line(country="usa"), "COUNTRY_UNSUPPORTED"),
    "long country": (line(country="NZLAND"), "COUNTRY_UNSUPPORTED; COUNTRY_TOO_LONG"),
    "no flag": (line(active=" "), "IS_ACTIVE_MISSING"),
    "wrong flag": (line(active="X"), "IS_ACTIVE_INVALID"),
    "name at limit": (line(name="N" * 255), None),
    "name over limit": (line(name="N" * 256), "MEMBER_NAME_TOO_LONG"),
    "id at limit": (line(member="1" * 18), None),
    "id over limit": (line(member="1" * 19), "MEMBER_ID_TOO_LONG"),
    "tier at limit": (line(tier="12345"), None),
    "tier over limit": (line(tier="123456"), "TIER_CODE_TOO_LONG"),
    "agent over limit": (line(agent="A" * 256), "AGENT_NAME_TOO_LONG"),
    "state over limit": (line(state="123456"), "STATE_TOO_LONG"),
    "spaces around": (line(country="  USA  ", active=" I "), None),
    "tab is no space": (line(active="A\t"), "IS_ACTIVE_INVALID"),
    "many reasons": (
        line(name="", member="", enrolled="x", flight="y", dob="z", country="", active=""),
        "MEMBER_NAME_MISSING; MEMBER_ID_MISSING; ENROLLMENT_DATE_INVALID; LAST_FLIGHT_DATE_INVALID; DOB_INVALID;"
        " COUNTRY_MISSING; IS_ACTIVE_MISSING",
    ),
    "nothing but the type": (
        "|D",
        "FIELD_COUNT_MISMATCH; MEMBER_NAME_MISSING; MEMBER_ID_MISSING; ENROLLMENT_DATE_MISSING; COUNTRY_MISSING;"
        " IS_ACTIVE_MISSING",
    ),
}


@pytest.fixture(scope="module")
def judged(spark):
    texts = [text for text, _ in CASES.values()]
    rows = evaluate_members(raw(spark, texts)).collect()
    return {row.source_row_number - 2: row for row in rows}


@pytest.mark.parametrize("case", CASES)
def test_reasons(judged, case):
    row = judged[list(CASES).index(case)]
    expected = CASES[case][1]
    assert row.dq_reason == expected
    assert row.is_valid is (expected is None)


def test_only_detail_lines_are_parsed(spark):
    lines = [line(kind="H"), line(kind="X"), "", "no pipes", line(kind="d"), line()]
    assert [row.source_row_number for row in parse_lines(raw(spark, lines), MEMBER_CONTRACT).collect()] == [7]


def test_fields_are_trimmed_and_typed(spark):
    row = parse_lines(raw(spark, [line(name="  Ann B ", tier=" ", agent="", flight="x")]), MEMBER_CONTRACT).first()
    assert (row.member_name, row.tier_code, row.agent_name) == ("Ann B", None, None)
    assert (row.enrollment_date, row.enrollment_date_raw) == (dt.date(2010, 1, 15), "20100115")
    assert (row.last_flight_date, row.last_flight_date_raw) == (None, "x")
    assert row.dob == dt.date(1985, 5, 3)
    assert row.source_field_count == 10


def test_null_conditions_give_no_reason(spark):
    df = spark.sql("select * from values (1, cast(null as int)), (2, 5) as t(id, x)")
    from pyspark.sql import functions as F

    out = {r.id: r for r in evaluate(df, [Rule("BIG", F.col("x") > 3), Rule("ODD", F.col("x") % 2 == 1)]).collect()}
    assert out[1].is_valid and out[1].dq_reason is None
    assert out[2].dq_reason == "BIG; ODD"


def test_split_and_counts(spark):
    evaluated = evaluate_members(raw(spark, [line(), line(name=""), line(name="", country="")]))
    good, bad = split_valid(evaluated)
    assert (good.count(), bad.count()) == (1, 2)
    assert {r.reason: r.hits for r in reason_counts(evaluated).collect()} == {"MEMBER_NAME_MISSING": 2, "COUNTRY_MISSING": 1}


MAPPING = {
    "version": 2,
    "record_type": "D",
    "expected_field_count": 2,
    "expected_header": ["Id", "Since"],
    "date_formats": {"since": "%d%m%Y"},
    "fields": [{"name": "since", "position": 2}, {"name": "id", "position": 1}],
}


def test_contract_from_mapping(spark):
    contract = FeedContract.from_mapping(MAPPING)
    assert [f.name for f in contract.fields] == ["id", "since"]
    row = parse_lines(raw(spark, ["|D|7|03051985"]), contract).first()
    assert (row.id, row.since) == ("7", dt.date(1985, 5, 3))


@pytest.mark.parametrize("key", ["version", "record_type", "expected_field_count", "expected_header", "fields"])
def test_contract_lacks_a_key(key):
    with pytest.raises(ContractError, match=key):
        FeedContract.from_mapping({k: v for k, v in MAPPING.items() if k != key})


@pytest.mark.parametrize("key", ["name", "position"])
def test_contract_field_lacks_a_key(key):
    fields = [MAPPING["fields"][0], {k: v for k, v in MAPPING["fields"][1].items() if k != key}]
    with pytest.raises(ContractError, match=f"field 2 of the contract lacks {key}"):
        FeedContract.from_mapping({**MAPPING, "fields": fields})


def test_contract_counts_must_agree():
    with pytest.raises(ContractError, match="header"):
        FeedContract(1, 2, (Field("a", "A"), Field("b", "B")), ("A",))
    with pytest.raises(ContractError, match="fields"):
        FeedContract(1, 2, (Field("a", "A"),), ("A", "B"))
    with pytest.raises(ContractError):
        FeedContract.from_mapping({**MAPPING, "expected_field_count": 3})
    with pytest.raises(ContractError):
        FeedContract.from_mapping({**MAPPING, "expected_header": ["Id"]})
