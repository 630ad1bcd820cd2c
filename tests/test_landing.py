"""Files: whole lines, numbers across splits, contract, malformed documents, load-once."""

import os
import random
import re

import pytest
from feedtext import HEADER, line
from pyspark.sql import functions as F

from feedlake.operators.contract import check_contract, require_contract
from feedlake.schemas import MEMBER_CONTRACT, ContractError, FeedSource
from feedlake.sources import heads, landing
from feedlake.sources.landing import (
    MalformedDocumentError,
    first_lines,
    index_splits,
    ingest_json,
    ingest_lines,
    ingest_summary,
    land,
    loaded_lines,
    raw_member,
    text_lines,
)
from feedlake.streaming.load_once import ingest_new, load_feed

DAY = "20260926"


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "member" / DAY
    path.mkdir(parents=True)
    return path


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("broadcast_limit", [64 << 20, 0])
def test_line_numbers_across_splits(spark, folder, small_splits, monkeypatch, broadcast_limit):
    monkeypatch.setattr(landing, "MAX_BROADCAST_BYTES", broadcast_limit)
    for name, size in (("a", 60_000), ("b", 50_003), ("c", 1)):
        (folder / f"{name}.csv").write_text("".join(f"|D|{name}|{n}\n" for n in range(1, size + 1)))
    raw = ingest_lines(spark, str(folder.parent), DAY)
    parts = F.split("raw_record", r"\|")
    wrong = raw.where(parts[3].cast("long") != F.col("source_row_number"))
    assert wrong.count() == 0
    assert {r.source_file_name[-5:]: r.row_count for r in ingest_summary(raw).collect()} == {
        "a.csv": 60_000, "b.csv": 50_003, "c.csv": 1}


@pytest.mark.parametrize("seed", range(3))
def test_random_lines_in_tiny_splits(spark, folder, seed):
    """Lines longer than a split, blank lines, either line ending, with or without a last newline."""
    rng = random.Random(seed)
    expected = {}
    for name in ("a.csv", "b.csv", "c.csv"):
        lines = ["x" * rng.choice([0, 1, 7, 90, 700, 2500]) + str(n) * rng.randrange(2) for n in range(rng.randrange(1, 300))]
        end = rng.choice(["\n", "\r\n"])
        lines[-1] += "end"
        (folder / name).write_bytes((end.join(lines) + end * rng.randrange(2)).encode())
        expected |= {(f"member/{DAY}/{name}", number): text for number, text in enumerate(lines, start=1)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", str(rng.choice([0, 400])))
    try:
        raw = ingest_lines(spark, str(folder.parent), DAY)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = raw.collect()
    assert {(r.source_file_name, r.source_row_number): r.raw_record for r in rows} == expected
    assert len(rows) == len(expected)


def test_lines_are_kept_whole(spark, folder):
    (folder / "x.csv").write_bytes(b'|H|a\r\n\n|D|"quoted|\ttab\r\r\n|D|last, no newline\xc3\xa9')
    raw = ingest_lines(spark, str(folder.parent), DAY)
    assert [(r.source_row_number, r.raw_record) for r in raw.orderBy("source_row_number").collect()] == [
        (1, "|H|a"), (2, ""), (3, '|D|"quoted|\ttab\r'), (4, "|D|last, no newlineé")]
    row = raw.where("source_row_number = 2").first()
    assert (row.record_type, row.batch_id, row.source_file_name) == ("", DAY, f"member/{DAY}/x.csv")
    assert str(row.source_feed_timestamp) == "2026-09-26 00:00:00"
    assert row.ingestion_timestamp is not None


def test_files_are_chosen_by_pattern_and_day(spark, folder):
    (folder / "member_profile_feed.csv").write_text("|D|yes\n")
    (folder / "member_profile_feed.csv.bak").write_text("|D|no\n")
    (folder / "sub").mkdir()
    (folder / "sub" / "member_profile_feed.csv").write_text("|D|yes\n")
    other = folder.parent / "20260927"
    other.mkdir()
    (other / "member_profile_feed.csv").write_text("|D|other day\n")
    raw = ingest_lines(spark, str(folder.parent), DAY, r".*member_profile_feed\.csv")
    assert {(r.source_file_name, r.raw_record) for r in raw.collect()} == {
        (f"member/{DAY}/member_profile_feed.csv", "|D|yes"), (f"member/{DAY}/sub/member_profile_feed.csv", "|D|yes")}


@pytest.mark.parametrize(
    "pattern, names",
    [
        (r".*", {"feed.csv", "feed.csv.bak", "xfeed-csv"}),
        (r".*feed\.csv", {"feed.csv"}),
        (r".*/feed\.csv", {"feed.csv"}),
        (r".*feed.csv", {"feed.csv", "xfeed-csv"}),
        (r".*/member/\d{8}/feed.*", {"feed.csv", "feed.csv.bak"}),
        (r"feed\.csv", set()),
    ],
)
def test_patterns_match_whole_paths(spark, folder, pattern, names):
    for name in ("feed.csv", "feed.csv.bak", "xfeed-csv"):
        (folder / name).write_text("|D|\n")
    raw = ingest_lines(spark, str(folder.parent), DAY, pattern)
    assert {r.source_file_name.rsplit("/", 1)[-1] for r in raw.collect()} == names


def test_odd_file_names(spark, folder):
    name = "a b+c%20é'd.csv"
    (folder / name).write_text("|D|1\n")
    raw = ingest_lines(spark, str(folder.parent), DAY, r".*/a b\+c%20é'd\.csv")
    assert [(r.source_file_name, r.source_row_number) for r in raw.collect()] == [(f"member/{DAY}/{name}", 1)]


def test_named_files_are_read_and_no_others(spark, folder):
    names = ["a b+c%20é'd.csv", "x[1]{2,3}.csv", "q*?.csv"]
    for name in [*names, "x1.csv", "x[1]2.csv", "qqq.csv"]:
        (folder / name).write_text(f"{name}\n")
    (folder / "empty.csv").write_text("")
    known = {r.file_path: r.raw_text for r in text_lines(spark.read, str(folder), ".*").collect()}
    uris = [uri for uri, name in known.items() if name in names]
    uris.append(next(iter(known)).rsplit("/", 1)[0] + "/empty.csv")
    got = text_lines(spark.read, str(folder), ".*", file_paths=uris)
    assert {r.file_path: r.raw_text for r in got.collect()} == {uri: known[uri] for uri in uris[:-1]}

    for n in range(100):
        (folder / f"more{n}.csv").write_text("1\n")
    many = [f"{uris[-1].rsplit('/', 1)[0]}/more{n}.csv" for n in range(100)]
    all_of_them = text_lines(spark.read, str(folder), ".*", file_paths=many)
    assert all_of_them.count() == 100

    def size(df):  # of the plan, whose columns are numbered anew each time
        return len(re.sub("#[0-9]+", "", df._jdf.queryExecution().optimizedPlan().toString()))

    assert size(all_of_them) == size(got)


def test_no_lines(spark, folder):
    (folder / "empty.csv").write_text("")
    assert ingest_lines(spark, str(folder.parent), DAY).isEmpty()


def test_bad_batch_id_is_refused(spark, folder):
    with pytest.raises(ValueError):
        ingest_lines(spark, str(folder.parent), "20261301")


HEADERS = {
    "good.csv": (HEADER, None),
    "name.csv": (HEADER.replace("Tier_Code", "tier_code"), "HEADER_NAMES"),
    "space.csv": (HEADER + " ", "HEADER_NAMES"),
    "order.csv": (HEADER.replace("Member_Name|Member_Id", "Member_Id|Member_Name"), "HEADER_NAMES"),
    "more.csv": (HEADER + "|Post_Code", "HEADER_FIELD_COUNT"),
    "less.csv": (HEADER.rsplit("|", 1)[0], "HEADER_FIELD_COUNT"),
    "detail.csv": (line(), "HEADER_RECORD_TYPE"),
    "blank.csv": ("", "HEADER_FIELD_COUNT"),
}


def test_every_file_is_checked(spark, folder):
    for name, (first, _) in HEADERS.items():
        (folder / name).write_text("\n".join([first, line(), HEADER]) + "\n")
    raw = ingest_lines(spark, str(folder.parent), DAY)
    found = {r.source_file_name.rsplit("/", 1)[-1]: r.violation for r in check_contract(raw, MEMBER_CONTRACT).collect()}
    assert found == {name: violation for name, (_, violation) in HEADERS.items() if violation}
    with pytest.raises(ContractError, match="HEADER_"):
        require_contract(raw, MEMBER_CONTRACT)


def test_first_lines_come_from_the_register(spark, folder, small_splits, tmp_path):
    for name in "ab":
        (folder / f"{name}.csv").write_text("".join(f"|{name}|{n}\n" for n in range(1, 40_000)))
    root = str(tmp_path / "landed")
    target = landing.landing_folder(root, DAY, 0)
    land(text_lines(spark.read, str(folder), ".*"), target)
    register = index_splits(spark, root, target, "member", DAY, heads=True)
    assert register.lines == 2 * 39_999 and register.files == 2
    heads = first_lines(spark, root, target)
    assert sorted(r.raw_record for r in heads.collect()) == ["|a|1", "|b|1"]
    assert "/lines" not in heads._jdf.queryExecution().executedPlan().toString()


def test_a_large_register_is_not_broadcast(spark, folder, monkeypatch):
    for number in range(30):
        (folder / f"{number}.csv").write_text("|D|1\n")

    def forced(limit):
        monkeypatch.setattr(landing, "MAX_BROADCAST_BYTES", limit)
        return "strategy=broadcast" in ingest_lines(spark, str(folder.parent), DAY)._jdf.queryExecution().logical().toString()

    assert forced(64 << 20) and not forced(30 * landing.SPLIT_ROW_BYTES)


def test_json_documents(spark, tmp_path):
    folder = tmp_path / "redemption" / DAY
    folder.mkdir(parents=True)
    (folder / "redemptions.json").write_text('{"a": 1}\n\n \t \n[{"a": 2}, {"a": 3}]\n{"a": "é"}\n')
    raw = ingest_json(spark, str(folder.parent), DAY)
    rows = raw.select("source_row_number", F.to_json("raw_record").alias("doc")).orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.doc) for r in rows] == [(1, '{"a":1}'), (2, '[{"a":2},{"a":3}]'), (3, '{"a":"é"}')]


def test_json_file_as_one_document(spark, tmp_path):
    folder = tmp_path / "redemption" / DAY
    folder.mkdir(parents=True)
    (folder / "redemptions.json").write_text('{\n "a": 1,\n "b": [\n 2]\n}\n')
    raw = ingest_json(spark, str(folder.parent), DAY, whole_file=True)
    assert [r.doc for r in raw.select(F.to_json("raw_record").alias("doc")).collect()] == ['{"a":1,"b":[2]}']


def test_malformed_json_fails_the_load(spark, tmp_path):
    folder = tmp_path / "redemption" / DAY
    folder.mkdir(parents=True)
    (folder / "redemptions.json").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(MalformedDocumentError, match="1 lines"):
        ingest_json(spark, str(folder.parent), DAY)


def test_files_are_loaded_once(spark, folder, tmp_path):
    landing_root, raw_root = str(tmp_path), str(tmp_path / "raw")

    def load():
        return load_feed(spark, landing_root, raw_root, FeedSource("member", r".*\.csv"), DAY).loads

    def visible():
        lines, count = loaded_lines(spark, raw_root, DAY)
        records = sorted(r.raw_record for r in raw_member(lines).collect())
        assert len(records) == count
        return records

    assert load() == 0 and visible() == []
    (folder / "a.csv").write_text("|D|1\n|D|2\n")
    assert load() == 1 and visible() == ["|D|1", "|D|2"]
    assert load() == 0 and visible() == ["|D|1", "|D|2"]
    (folder / "b.csv").write_text("|D|3\n")
    os.utime(folder / "b.csv", (1_000_000_000, 1_000_000_000))  # new to us, however old it is
    assert load() == 1 and visible() == ["|D|1", "|D|2", "|D|3"]
    numbers = {(r.source_file_name[-5:], r.source_row_number) for r in loaded_lines(spark, raw_root, DAY)[0].collect()}
    assert numbers == {("a.csv", 1), ("a.csv", 2), ("b.csv", 1)}


def test_a_changed_file_replaces_its_lines(spark, folder, tmp_path):
    landing_root, raw_root, source = str(tmp_path), str(tmp_path / "raw"), FeedSource("member", ".*")

    def load():
        result = load_feed(spark, landing_root, raw_root, source, DAY)
        lines, count = loaded_lines(spark, raw_root, DAY)
        rows = sorted((r.source_file_name[-5:], r.source_row_number, r.raw_text) for r in lines.collect())
        assert len(rows) == count
        return (result.status, result.files, result.lines, result.replaced_files), [(name, text) for name, _, text in rows]

    (folder / "a.csv").write_text("1\n2\n")
    (folder / "b c.csv").write_text("3\n")
    (folder / "e.csv").write_text("")
    first = [("c.csv", "3"), ("a.csv", "1"), ("a.csv", "2")]
    assert load() == (("LOADED", 2, 3, 0), sorted(first))
    assert load()[0] == ("SKIPPED", 0, 0, 0)
    (folder / "a.csv").write_text("1\n2 mended\n4\n")
    (folder / "e.csv").write_text("5\n")
    second = [("c.csv", "3"), ("a.csv", "1"), ("a.csv", "2 mended"), ("a.csv", "4"), ("e.csv", "5")]
    assert load() == (("LOADED", 2, 4, 1), sorted(second))
    assert load()[0] == ("SKIPPED", 0, 0, 0)
    (folder / "b c.csv").write_text("")  # an emptied file takes its lines back
    (folder / "n.csv").write_text("6\n")
    (folder / "a.csv").write_text("7\n")
    assert load() == (("LOADED", 2, 2, 2), [("a.csv", "7"), ("e.csv", "5"), ("n.csv", "6")])
    assert load()[0] == ("SKIPPED", 0, 0, 0)
    (folder / "e.csv").unlink()  # one that is gone does not
    (folder / "n.csv").write_text("")
    assert load() == (("LOADED", 0, 0, 1), [("a.csv", "7"), ("e.csv", "5")])
    (folder / "n.csv").write_text("8\n")
    assert load()[1] == [("a.csv", "7"), ("e.csv", "5"), ("n.csv", "8")]
    assert load()[0] == ("SKIPPED", 0, 0, 0)


def test_a_failed_load_is_invisible_and_repeated(spark, folder, tmp_path):
    landing_root, raw_root = str(tmp_path), str(tmp_path / "raw")
    (folder / "a.csv").write_text("|D|1\n")

    def refuse(target):
        raise ContractError("not today")

    with pytest.raises(ContractError, match="not today"):
        load_feed(spark, landing_root, raw_root, FeedSource("member", ".*"), DAY, check=refuse)
    assert loaded_lines(spark, raw_root, DAY)[1] == 0
    (folder / "a.csv").write_text("|D|1 mended\n")
    assert load_feed(spark, landing_root, raw_root, FeedSource("member", ".*"), DAY).loads == 1
    assert [r.raw_text for r in loaded_lines(spark, raw_root, DAY)[0].collect()] == ["|D|1 mended"]


def test_headers_are_read_before_anything_is_landed(spark, folder, tmp_path):
    landing_root, raw_root, source = str(tmp_path), str(tmp_path / "raw"), FeedSource("member", ".*")
    header = f"|H|{'|'.join(MEMBER_CONTRACT.header)}"

    def load():
        return load_feed(spark, landing_root, raw_root, source, DAY, check_heads=lambda heads: require_contract(heads, MEMBER_CONTRACT)).lines

    (folder / "a b+c%.csv").write_bytes(f"{header}\r\n|D|1\n".encode())
    (folder / "empty.csv").write_text("")
    (folder / "bad.csv").write_text("|H|Other\n" + "|D|1\n" * 1000)
    (folder / "long.csv").write_text("x" * (heads.MOST_BYTES + 10))
    with pytest.raises(ContractError, match="2 files .*bad.csv"):
        load()
    assert not os.path.exists(raw_root)  # nothing was landed
    (folder / "bad.csv").write_text(f"{header}\n|D|2")
    (folder / "long.csv").unlink()
    assert load() == 4 and load() == 0
    (folder / "bad.csv").write_text("|H|Other\n|D|3\n")
    with pytest.raises(ContractError, match="HEADER_FIELD_COUNT"):
        load()
    assert sorted(r.raw_text for r in loaded_lines(spark, raw_root, DAY)[0].collect()) == ["|D|1", "|D|2", header, header]


def test_first_line_of_files(tmp_path):
    (tmp_path / "a b").write_bytes(b"one\r\r\ntwo")
    assert heads.first_line(f"file:{tmp_path}/a%20b") == "one\r"
    assert heads.first_line(f"file:{tmp_path}/missing") is None and heads.first_line("nowhere://x/y") is None


def test_documents_are_parsed_once(spark, tmp_path):
    folder = tmp_path / "redemption" / DAY
    folder.mkdir(parents=True)
    (folder / "redemptions.json").write_text('{"member_id": 7, "redemptions": [{"txn_id": "T"}]}\n[1, 2]\nnull\n')
    raw = ingest_json(spark, str(folder.parent), DAY)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan.lower() and "parseJson" not in plan
    assert sorted((r.raw_text, r.kind) for r in raw.selectExpr("raw_text", "schema_of_variant(raw_record) as kind").collect()) == [
        ("[1, 2]", "ARRAY<BIGINT>"), ("null", "VOID"), ('{"member_id": 7, "redemptions": [{"txn_id": "T"}]}', "OBJECT<member_id: BIGINT, redemptions: ARRAY<OBJECT<txn_id: STRING>>>"),
    ]


def test_a_refused_file_may_be_taken_away(spark, folder, tmp_path):
    landing_root, raw_root, source = str(tmp_path), str(tmp_path / "raw"), FeedSource("member", ".*")
    (folder / "good.csv").write_text("|D|good\n")
    (folder / "bad.csv").write_text("|D|bad\n")

    def refuse(target):
        raise ContractError("no")

    with pytest.raises(ContractError):
        load_feed(spark, landing_root, raw_root, source, DAY, check=refuse)
    (folder / "bad.csv").unlink()
    (folder / "mended.csv").write_text("|D|mended\n")
    load_feed(spark, landing_root, raw_root, source, DAY)
    load_feed(spark, landing_root, raw_root, source, DAY)
    assert sorted(r.raw_text for r in loaded_lines(spark, raw_root, DAY)[0].collect()) == ["|D|good", "|D|mended"]


def test_whole_files_are_loaded_once(spark, tmp_path):
    folder = tmp_path / "redemption" / DAY
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{\n"a": 1\n}\n')
    source = FeedSource("redemption", r".*\.json", whole_file=True)
    assert load_feed(spark, str(tmp_path), str(tmp_path / "raw"), source, DAY, json=True).loads == 1
    lines, count = loaded_lines(spark, str(tmp_path / "raw"), DAY)
    assert count == 1 and lines.first().raw_text == '{\n"a": 1\n}\n'


def test_missing_folder_has_no_new_files(spark, tmp_path):
    assert ingest_new(spark, str(tmp_path / "none"), str(tmp_path / "cp"), lambda batch, load: None) == 0
