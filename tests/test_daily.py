"""Whole days from files: movement, late and repeated batches, conflicts, failures."""

import pytest
from feedtext import deliver, document, line, txn

from feedlake.operators.checks import CheckFailure, require_passed
from feedlake.plans import daily
from feedlake.plans.daily import run_batch
from feedlake.schemas import ContractError
from feedlake.sources.landing import MalformedDocumentError, NoFilesError
from feedlake.sources.tables import Lake

D1, D2, D3 = "20260926", "20260927", "20260928"


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "the lake's"), buckets=4)


def first_day(landing):
    deliver(
        landing, D1,
        [
            line(member="223457", country="USA"), line(member="2", country="CAN"), line(member="3", name=""),
            line(member="4", country="GBR"), line(member="4", country="GBR", state="ZZ"),
            line(member="5", country="JPN", flight=""), line(member="5", country="JPN", flight=""), "", line(kind="X"),
        ],
        [
            document("223457", D1, [txn("T1"), txn("T2", miles=-1), txn(None)]),
            document("nobody", D1, [txn("RX10093")]),
            document("2", D1, [txn("T3", status="PENDING"), txn("T3b", partner=None), txn("T3c", date="x")]),
            document("2", D1, []),
        ],
    )


def second_day(landing):
    deliver(
        landing, D2,
        [line(member="223457", country="IND"), line(member="4", country="GBR"), line(member="2", country="usa")],
        [document("2", D2, [txn("T3", status="COMPLETED")]), document("4", D2, [txn("T4")])],
    )


def countries(lake):
    return {r.member_id: r.country for r in daily.read_member_countries(lake).collect()}


def current(lake):
    return {r.member_id: (r.country, r.batch_id) for r in daily.read_member_current(lake).collect()}


def curated(lake):
    return {r.txn_id: (r.member_id, r.status, r.batch_id) for r in daily.read_redemption(lake).collect()}


def ledger(lake):
    return {r.batch_id: r for r in daily.read_ledger(lake).collect()}


def snapshot(lake):
    return current(lake), countries(lake), curated(lake), quarantine(lake)


def quarantine(lake):
    rows = daily.read_dq_quarantine(lake).collect()
    txns = daily.read_redemption_quarantine(lake).collect()
    return (
        sorted((r.batch_id, r.source_row_number, r.dq_reason) for r in rows),
        sorted((r.batch_id, r.source_row_number, r.pos, r.dq_reason) for r in txns),
    )


def test_two_days(lake, landing):
    first_day(landing)
    counts = run_batch(lake, landing, D1)
    assert counts == {
        "member_files_loaded": 1, "member_lines_loaded": 10, "member_files_replaced": 0,
        "redemption_files_loaded": 1, "redemption_lines_loaded": 4, "redemption_files_replaced": 0,
        "member_lines": 10, "member_staged": 6, "member_rejected": 1, "member_conflicting": 2,
        "redemption_flattened": 7, "redemption_accepted": 2, "redemption_rejected": 5,
    }
    assert countries(lake) == {"223457": "USA", "2": "CAN", "5": "JPN"}
    assert quarantine(lake) == (
        [(D1, 4, "MEMBER_NAME_MISSING"), (D1, 5, "MEMBER_ID_SAME_VERSION_CONFLICT"), (D1, 6, "MEMBER_ID_SAME_VERSION_CONFLICT")],
        [
            (D1, 1, 1, "MILES_REDEEMED_INVALID"), (D1, 1, 2, "TXN_ID_MISSING"), (D1, 2, 0, "MEMBER_NOT_FOUND"),
            (D1, 3, 1, "PARTNER_MISSING"), (D1, 3, 2, "TXN_DATE_INVALID_OR_MISSING"),
        ],
    )
    assert curated(lake) == {"T1": ("223457", "COMPLETED", D1), "T3": ("2", "PENDING", D1)}
    row = daily.read_member_current(lake).where("member_id = '5'").first()
    assert (row.stale_member, row.age, row.source_row_number) == (None, 41, 7)
    before = {r.member_id: r.created_at for r in daily.read_member_current(lake).collect()}

    second_day(landing)
    run_batch(lake, landing, D2)
    # 223457 moved and USA is empty now; 2 had no valid row and stays; 4 is free of conflict now.
    assert countries(lake) == {"223457": "IND", "2": "CAN", "5": "JPN", "4": "GBR"}
    assert current(lake)["223457"] == ("IND", D2) and current(lake)["2"] == ("CAN", D1)
    assert curated(lake) == {
        "T1": ("223457", "COMPLETED", D1), "T3": ("2", "COMPLETED", D2), "T4": ("4", "COMPLETED", D2)}
    after = {r.member_id: r for r in daily.read_member_current(lake).collect()}
    assert after["223457"].created_at == before["223457"] and after["223457"].updated_at > before["223457"]
    assert after["2"].updated_at == before["2"]
    require_passed(daily.suite(lake))
    assert daily.read_member_staging(lake).count() == 8
    assert {b: (r.status, r.rows_loaded, r.rows_rejected) for b, r in ledger(lake).items()} == {
        D1: ("SUCCESS", 8, 8), D2: ("SUCCESS", 4, 1)}
    assert daily.read_raw_member(lake, D1).count() == 10
    assert daily.read_raw_redemption(lake, D1).count() == 4


def test_views_answer_sql(spark, lake, landing):
    first_day(landing)
    second_day(landing)
    run_batch(lake, landing, D1)
    run_batch(lake, landing, D2)
    names = daily.create_views(lake)
    assert {"member_usa", "member_sgp", "redemption", "batch_run"} <= set(names)

    def one(sql):
        return spark.sql(sql).first()[0]

    assert one("select count(*) from (select member_id from member_current group by 1 having count(*) > 1)") == 0
    assert one("select count(*) from member_current where member_id = '223457' and country = 'IND'"
               " and source_feed_timestamp = timestamp_ntz'2026-09-27 00:00:00'") == 1
    assert one("select (select count(*) from member_ind where member_id = '223457') * 10"
               " + (select count(*) from member_usa where member_id = '223457')") == 10
    union = " union all ".join(f"select member_id from {n}" for n in names if len(n) in (9, 10, 11) and n.startswith("member_"))
    assert one(f"select count(*) from ({union})") == 4
    assert one("select count(*) from (select txn_id from redemption group by 1 having count(*) > 1)") == 0
    assert one("select dq_reason from redemption_dq_quarantine where txn_id = 'RX10093'") == "MEMBER_NOT_FOUND"
    assert one(f"select (select count(*) from redemption_staging where batch_id = '{D2}')"
               f" - (select count(*) from redemption where batch_id = '{D2}')"
               f" - (select count(*) from redemption_dq_quarantine where batch_id = '{D2}')") == 0
    assert {tuple(r) for r in spark.sql("select batch_id, count(*) from raw_member_feed group by 1").collect()} == {(D1, 10), (D2, 4)}
    assert one("select count(*) from raw_redemption_feed") == 6
    assert one("select string_agg(status, ',') from batch_run") == "SUCCESS,SUCCESS"


def test_rerun_changes_nothing(lake, landing):
    first_day(landing)
    second_day(landing)
    run_batch(lake, landing, D1)
    run_batch(lake, landing, D2)
    expected = snapshot(lake)
    routed = {s.slot: s.version for s in lake.slots("member_country")}
    run_batch(lake, landing, D2)
    assert snapshot(lake) == expected
    assert {s.slot: s.version for s in lake.slots("member_country")} == routed  # no country was rewritten
    run_batch(lake, landing, D1)  # older batch again: members keep the newer version
    again = snapshot(lake)
    assert (again[0], again[1]) == (expected[0], expected[1])
    assert again[2]["T3"] == ("2", "PENDING", D1)  # curated redemptions have no guard: processed last wins
    assert again[2].keys() == expected[2].keys()
    require_passed(daily.suite(lake))


def test_late_batch_does_not_overwrite(lake, landing):
    first_day(landing)
    second_day(landing)
    run_batch(lake, landing, D2)
    run_batch(lake, landing, D1)
    assert countries(lake) == {"223457": "IND", "2": "CAN", "5": "JPN", "4": "GBR"}
    assert current(lake)["223457"] == ("IND", D2)
    require_passed(daily.suite(lake))


def test_conflict_keeps_the_state_before(lake, landing):
    deliver(landing, D1, [line(member="1", country="USA")], [])
    deliver(landing, D2, [line(member="1", country="IND"), line(member="1", country="CAN")], [])
    run_batch(lake, landing, D1)
    run_batch(lake, landing, D2)
    assert countries(lake) == {"1": "USA"} and current(lake)["1"] == ("USA", D1)
    assert daily.read_member_staging(lake).where(f"batch_id = '{D2}'").count() == 2
    require_passed(daily.suite(lake))


def test_corrected_file_of_the_same_day(lake, landing):
    deliver(landing, D1, [line(member="1", country=""), line(member="2")], [])
    run_batch(lake, landing, D1)
    deliver(landing, D1, [line(member="1", country="FRA")], file="more_member_profile_feed.csv")
    run_batch(lake, landing, D1)
    assert countries(lake) == {"1": "FRA", "2": "USA"}
    assert len(quarantine(lake)[0]) == 1


def test_only_rejected_rows(lake, landing):
    deliver(landing, D1, [line(country="")], [document("1", D1, [txn()])])
    run_batch(lake, landing, D1)
    assert countries(lake) == {} and current(lake) == {} and curated(lake) == {}
    assert [len(part) for part in quarantine(lake)] == [1, 1]
    deliver(landing, D2, [line()], [document("1", D2, [txn()])])
    run_batch(lake, landing, D2)
    assert countries(lake) == {"1": "USA"} and curated(lake) == {"T1": ("1", "COMPLETED", D2)}
    require_passed(daily.suite(lake))


def test_small_changes_leave_the_curated_base_alone(lake, landing):
    many = [document("1", D1, [txn(f"T{n}", status="PENDING") for n in range(40)])]
    deliver(landing, D1, [line()], many)
    run_batch(lake, landing, D1)
    first = {r.txn_id: r.loaded_at for r in daily.read_redemption(lake).collect()}
    base = {s.slot: s for s in lake.slots("redemption")}["base"]

    deliver(landing, D2, [line()], [document("1", D2, [txn("T0"), txn("new")])])
    run_batch(lake, landing, D2)
    assert {s.slot: (s.version, s.row_count) for s in lake.slots("redemption")} == {
        "base": (base.version, 40), "recent": (2, 2)}
    rows = {r.txn_id: r for r in daily.read_redemption(lake).collect()}
    assert len(rows) == 41
    assert (rows["T0"].status, rows["T0"].batch_id, rows["T0"].loaded_at) == ("COMPLETED", D2, first["T0"])
    assert (rows["T1"].status, rows["T1"].batch_id) == ("PENDING", D1)
    loaded = rows["new"].loaded_at
    assert loaded > first["T0"]
    require_passed(daily.suite(lake))

    deliver(landing, D3, [line()], [document("1", D3, [txn("T0", status="CANCELLED"), *(txn(f"N{n}") for n in range(9))])])
    run_batch(lake, landing, D3)  # now the changes are worth folding in
    assert {s.slot: (s.version, s.row_count) for s in lake.slots("redemption")} == {"base": (3, 50), "recent": (3, 0)}
    rows = {r.txn_id: r for r in daily.read_redemption(lake).collect()}
    assert (rows["T0"].status, rows["T0"].loaded_at) == ("CANCELLED", first["T0"])
    assert rows["new"].loaded_at == loaded and rows["N1"].batch_id == D3
    require_passed(daily.suite(lake))


def test_small_deliveries_leave_members_and_countries_alone(lake, landing):
    def versions(table):
        return {s.slot: (s.version, s.row_count) for s in lake.slots(table)}

    deliver(landing, D1, [line(member=str(n), country="USA" if n % 2 else "IND") for n in range(40)], [])
    run_batch(lake, landing, D1)
    created = {r.member_id: r.created_at for r in daily.read_member_current(lake).collect()}
    routed = versions("member_country")

    deliver(landing, D2, [line(member="1", country="IND"), line(member="2", country="FRA"), line(member="new")], [document("new", D2, [txn()])])
    assert run_batch(lake, landing, D2)["redemption_accepted"] == 1
    assert versions("member_current") == {"base": (1, 40), "recent": (2, 3)}
    assert versions("member_country") == routed
    assert (countries(lake)["1"], countries(lake)["2"], countries(lake)["new"], countries(lake)["3"]) == ("IND", "FRA", "USA", "USA")
    assert len(countries(lake)) == daily.read_member_countries(lake).count() == 41
    rows = {r.member_id: r for r in daily.read_member_current(lake).collect()}
    assert rows["1"].created_at == created["1"] < rows["1"].updated_at and rows["3"].updated_at == created["3"]
    require_passed(daily.suite(lake))

    run_batch(lake, landing, D1)  # late and large: nothing changes, and the recent changes are folded in
    assert versions("member_current") == {"base": (3, 41), "recent": (3, 0)}
    assert countries(lake)["1"] == "IND" and current(lake)["1"] == ("IND", D2)
    assert {slot for slot, (version, _) in versions("member_country").items() if version == 3} == {"country=USA", "country=IND", "country=FRA"}
    again = {r.member_id: r for r in daily.read_member_current(lake).collect()}
    assert again == rows
    require_passed(daily.suite(lake))


def test_a_later_file_that_contradicts_an_accepted_member(lake, landing):
    deliver(landing, D1, [line(member="1", country="USA"), line(member="2")], [])
    run_batch(lake, landing, D1)
    deliver(landing, D1, [line(member="1", country="FRA")], file="more_member_profile_feed.csv")
    run_batch(lake, landing, D1)
    assert current(lake)["1"] == ("USA", D1) and len(quarantine(lake)[0]) == 2
    require_passed(daily.suite(lake))


def test_a_changed_file_is_taken_in(lake, landing):
    deliver(landing, D1, [line(member="1", country="USA"), line(member="2", country="")], [])
    run_batch(lake, landing, D1)
    deliver(landing, D1, [line(member="1", country="USA"), line(member="2", country="CAN"), line(member="3")], [])
    counts = run_batch(lake, landing, D1)
    assert (counts["member_files_loaded"], counts["member_files_replaced"], counts["member_lines"]) == (1, 1, 4)
    assert countries(lake) == {"1": "USA", "2": "CAN", "3": "USA"} and quarantine(lake)[0] == []
    assert daily.read_raw_member(lake).count() == 4
    assert run_batch(lake, landing, D1)["member_files_loaded"] == 0
    require_passed(daily.suite(lake))


def test_each_bucket_is_one_file(spark, lake, landing):
    from pathlib import Path

    people = [line(member=str(n)) for n in range(200)]
    deliver(landing, D1, people, [document("1", D1, [txn(f"T{n}") for n in range(200)])])
    deliver(landing, D2, people, [document("1", D2, [txn(f"T{n}") for n in range(150, 170)])])
    deliver(landing, D3, people, [document("1", D3, [txn(f"T{n}") for n in range(150, 300)])])
    for batch_id in (D1, D2, D3):
        run_batch(lake, landing, batch_id)
    files = {}
    for table in ("member_current", "redemption"):
        for path in Path(lake.root, "tables", table).rglob("*.parquet"):
            files.setdefault(path.parent, []).append(path.name)
    assert len(files) == 6 and all(len(names) <= lake.buckets for names in files.values())
    assert daily.read_redemption(lake).count() == 300


def test_superseded_folders_can_be_removed(lake, landing):
    from pathlib import Path

    first_day(landing)
    second_day(landing)
    run_batch(lake, landing, D1)
    first_state = {s.slot: s.version for s in lake.slots("member_country")}
    run_batch(lake, landing, D2)
    run_batch(lake, landing, D1)
    expected = snapshot(lake)
    assert lake.superseded(keep_runs=2) == []
    # With one run kept, the state before the last run stays readable, the first one does not.
    assert lake.remove_superseded(keep_runs=1) > 0
    members = Path(lake.root, "tables", "member_current")
    assert sorted(p.name for p in members.iterdir() if any(p.rglob("*.parquet"))) == ["v=2", "v=3"]
    assert snapshot(lake) == expected
    lake.remove_superseded(keep_runs=0)
    assert lake.remove_superseded(keep_runs=0) == 0
    assert sorted(p.name for p in members.iterdir() if any(p.rglob("*.parquet"))) == ["v=3"]
    assert snapshot(lake) == expected
    # CAN was last written by the first run and is in force.
    assert first_state["country=CAN"] == 1 and Path(lake.root, "tables", "member_country", "v=1", "country=CAN").exists()
    run_batch(lake, landing, D2)
    require_passed(daily.suite(lake))


def test_another_process_sees_what_is_published(spark, lake, landing):
    first_day(landing)
    other = Lake(spark, lake.root)
    assert daily.read_member_current(other).count() == 0
    run_batch(lake, landing, D1)
    other.refresh()
    assert snapshot(other) == snapshot(lake)
    second_day(landing)
    run_batch(other, landing, D2)  # with buckets of another number
    lake.refresh()
    assert snapshot(lake) == snapshot(other)
    require_passed(daily.suite(lake))


def test_no_redemption_file(lake, landing):
    deliver(landing, D1, [line()])
    assert run_batch(lake, landing, D1)["redemption_flattened"] == 0
    assert countries(lake) == {"1": "USA"}


def test_no_member_file(lake, landing):
    deliver(landing, D1, documents=[document()])
    with pytest.raises(NoFilesError):
        run_batch(lake, landing, D1)
    assert ledger(lake)[D1].status == "FAILED"


def test_bad_contract_publishes_nothing(lake, landing):
    first_day(landing)
    run_batch(lake, landing, D1)
    expected = snapshot(lake)
    deliver(landing, D2, [line(member="1")], [], header="|H|Other")
    with pytest.raises(ContractError):
        run_batch(lake, landing, D2)
    failed = ledger(lake)[D2]
    assert failed.status == "FAILED" and "HEADER_FIELD_COUNT" in failed.error_message and failed.completed_at
    assert snapshot(lake) == expected
    deliver(landing, D2, [line(member="1", country="SGP")], [])  # mended file of the same name
    run_batch(lake, landing, D2)
    mended = ledger(lake)[D2]
    assert mended.status == "SUCCESS" and mended.error_message is None and mended.created_at < mended.started_at
    assert countries(lake)["1"] == "SGP"


def test_failure_half_way_publishes_nothing(lake, landing, monkeypatch):
    first_day(landing)
    run_batch(lake, landing, D1)
    expected = snapshot(lake)
    second_day(landing)

    def fail(*args, **kwargs):
        raise RuntimeError("x" * 5000)

    with monkeypatch.context() as patched:
        patched.setattr(daily.stages, "merge_redemptions", fail)
        with pytest.raises(RuntimeError):
            run_batch(lake, landing, D2)
    assert snapshot(lake) == expected
    assert ledger(lake)[D2].status == "FAILED" and len(ledger(lake)[D2].error_message) == 4000
    # The folders of the failed run are overwritten, whatever the session says about partitions.
    lake.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        run_batch(lake, landing, D2)
    finally:
        lake.spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert countries(lake) == {"223457": "IND", "2": "CAN", "5": "JPN", "4": "GBR"}
    assert daily.read_redemption_evaluated(lake).count() == 9
    require_passed(daily.suite(lake))


def test_malformed_json_publishes_nothing(lake, landing):
    deliver(landing, D1, [line()], ['{"member_id": '])
    with pytest.raises(MalformedDocumentError):
        run_batch(lake, landing, D1)
    assert lake.slots("member_current") == []


def test_bad_batch_id_leaves_no_trace(lake, landing):
    with pytest.raises(ValueError):
        run_batch(lake, landing, "20260231")
    assert daily.read_ledger(lake).count() == 0


def test_checks_find_what_is_wrong(spark, lake, landing):
    from feedlake.operators import checks

    first_day(landing)
    run_batch(lake, landing, D1)
    members, routed = daily.read_member_current(lake), daily.read_member_countries(lake)
    twice = members.unionByName(members.where("member_id = '2'"))
    assert checks.repeated_keys(twice, ["member_id"]).count() == 1
    assert checks.misrouted(members, routed.where("member_id <> '2'"), "member_id").count() == 1
    assert checks.misrouted(members, routed.unionByName(routed.where("member_id = '2'")), "member_id").count() == 1
    evaluated, staged = daily.read_redemption_evaluated(lake), daily.read_redemption_staging(lake)
    kept = daily.read_redemption(lake).where("txn_id <> 'T1'")
    bad = checks.unreconciled(checks.reconcile(staged, evaluated, kept))
    assert bad.first().accepted_not_curated == 1
    with pytest.raises(CheckFailure, match="txn: 1 violations"):
        require_passed(checks.verdict("txn", kept))


def test_members_are_looked_up_where_they_lie(spark, lake, landing):
    first_day(landing)
    run_batch(lake, landing, D1)
    base = lake.read_entity("member_current", daily.MEMBER_CURRENT, daily.MEMBER_KEY, daily.BASE)
    recent = lake.write_entity(base.where("member_id = '2'"), "recent", daily.MEMBER_CURRENT, 99, daily.MEMBER_KEY)
    keys = spark.createDataFrame([("2", 1), ("2", 2), ("nobody", 3), (None, 4)], "member_id string, n int")
    known = [base.where("member_id <> '2'").select("member_id"), recent.select("member_id")]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for partitions in (str(lake.buckets), str(lake.buckets + 3)):
            for name, value in {**settings, "spark.sql.shuffle.partitions": partitions}.items():
                spark.conf.set(name, value)
            absent = daily.stages.absent_keys(keys, known, ["member_id"], buckets=lake.buckets)
            plan = absent._jdf.queryExecution().executedPlan().toString()
            assert [tuple(r) for r in absent.collect()] == [("nobody", 1)]
            assert plan.count("Bucketed: true") == 2 and plan.count("SortMergeJoin") == 2
            assert plan.count("Exchange") == (1 if int(partitions) == lake.buckets else 2)  # all of them on the side of the keys
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(lake.buckets))
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_day_leaves_no_scratch(spark, lake, landing, monkeypatch):
    from pathlib import Path

    scratch = Path(spark.conf.get("spark.checkpoint.dir"), "feedlake")

    def left():
        return {path.name for path in scratch.glob("*")}

    first_day(landing)
    before, made = left(), []

    def judged(*args, evaluate=daily.stages.evaluate_redemptions, **kwargs):
        result = evaluate(*args, **kwargs)
        made.append(left() - before)
        if len(made) == 2:
            raise RuntimeError("half way")
        return result

    monkeypatch.setattr(daily.stages, "evaluate_redemptions", judged)
    run_batch(lake, landing, D1)
    assert len(made[0]) == 2 and left() == before
    with pytest.raises(RuntimeError):
        run_batch(lake, landing, D1)
    assert len(made[1]) == 2 and left() == before
    assert curated(lake) == {"T1": ("223457", "COMPLETED", D1), "T3": ("2", "PENDING", D1)}


def test_a_small_day_reads_the_buckets_of_its_members(spark, lake, landing, monkeypatch):
    deliver(landing, D1, [line(member=str(n)) for n in range(40)], [])
    run_batch(lake, landing, D1)
    base = lake.read_entity("member_current", daily.MEMBER_CURRENT, daily.MEMBER_KEY, daily.BASE)
    named = spark.createDataFrame([("7",), ("nobody",)], "member_id string").where("member_id = '7'")
    few = daily._named(base, named, 1)
    joined = few.join(base.select("member_id").hint("merge"), "member_id")  # by itself the scan keeps quiet about its buckets
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 4" in plan and "Exchange" not in plan
    assert [r.member_id for r in few.collect()] == ["7"]
    assert daily._named(base, named.limit(0), 0).collect() == []

    monkeypatch.setattr(daily, "LOOKUP_ROWS", 0)
    many = daily._named(base, named, 1)
    assert "LeftSemi" in many._jdf.queryExecution().executedPlan().toString()
    assert many.collect() == few.collect()


def test_countries_are_read_where_they_lie(spark, lake, landing):
    deliver(landing, D1, [line(member=str(n), country="USA" if n % 2 else "IND") for n in range(40)], [])
    run_batch(lake, landing, D1)
    deliver(landing, D2, [line(member="1", country="IND"), line(member="2", country="FRA"), line(member="new")], [])
    run_batch(lake, landing, D2)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        routed = daily.read_member_countries(lake)
        plan = routed._jdf.queryExecution().executedPlan().toString()
        one = routed.where("country = 'USA'")
        one_plan = one._jdf.queryExecution().executedPlan().toString()
        assert routed.count() == 41 and {r.member_id for r in one.collect()} == {"new", *(str(n) for n in range(3, 40, 2))}
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Bucketed: true" in plan
    assert one_plan.count("SortMergeJoin") == 1 and "Exchange" not in one_plan  # of one country, only its folder is read
    countries_written = [s for s in lake.slots("member_country") if s.row_count]
    assert {s.slot for s in countries_written} == {"country=USA", "country=IND"} and {s.buckets for s in countries_written} == {4}


def test_current_state_is_not_shuffled_by_the_next_merge(spark, lake, landing):
    first_day(landing)
    run_batch(lake, landing, D1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = daily.read_member_current(lake)
        source = held.drop("created_at", "updated_at").withColumn("state", held.state).repartition(3)
        plan = daily.stages.merge_members(held, source)._jdf.queryExecution().executedPlan().toString()
        again = daily.read_member_current(lake)
        compared = daily.affected_partitions(held, again, "member_id", "country", daily.LINEAGE)
        comparison = compared._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin", 1)[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    target_side = plan.split("SortMergeJoin", 1)[1].split(":- ", 1)[1].split("+- Sort", 1)[0]
    assert "Bucketed: true" in plan and "Exchange" not in target_side
    assert "Exchange" not in comparison
