"""The daily batch: files to raw, judged, current, routed and curated tables, published together."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.dates import check_batch_id
from feedlake.operators.checks import check_suite
from feedlake.operators.contract import require_contract
from feedlake.operators.ledger import FAILED, RUNNING, SUCCESS, ledger_event, ledger_state
from feedlake.operators.merge import upsert
from feedlake.operators.parse import flatten_redemptions
from feedlake.operators.routing import affected_partitions, changed_keys, movements, project
from feedlake.operators.versions import conflicts, latest_members, split_conflicts
from feedlake.plans import stages
from feedlake.schemas import (
    COUNTRIES,
    DQ_QUARANTINE,
    LINEAGE,
    MEMBER_ATTRIBUTES,
    MEMBER_CONTRACT,
    MEMBER_CURRENT,
    MEMBER_EVALUATED,
    MEMBER_SOURCE,
    REDEMPTION,
    REDEMPTION_EVALUATED,
    REDEMPTION_SOURCE,
    REDEMPTION_STAGING,
    FeedContract,
    FeedSource,
)
from feedlake.sources.landing import NoFilesError, first_lines, loaded_lines, raw_member, raw_redemption
from feedlake.sources.scratch import small_frame, temporary
from feedlake.sources.tables import Lake
from feedlake.streaming.load_once import load_feed

FEED_TYPE = "PIPELINE"
CONFLICTING_VERSIONS = "batch_id string, member_id string, source_feed_timestamp timestamp_ntz, key_rows bigint"
BASE, RECENT = "base", "recent"
# Changes to members and curated transactions are folded into the base when they reach this share of its rows.
FOLD_SHARE = 0.2
# Rows of a day up to which its members are looked up by value, so that only buckets that can hold them are read.
LOOKUP_ROWS = 1000
MEMBER_KEY, REDEMPTION_KEY = ["member_id"], ["txn_id"]


def ledger_path(lake: Lake) -> str:
    return f"{lake.root}/control/ledger"


def raw_root(lake: Lake, feed: str) -> str:
    return f"{lake.root}/raw/{feed}"


def run_batch(
    lake: Lake,
    landing: str,
    batch_id: str,
    contract: FeedContract = MEMBER_CONTRACT,
    member_source: FeedSource = MEMBER_SOURCE,
    redemption_source: FeedSource = REDEMPTION_SOURCE,
) -> dict[str, int]:
    """Process the files delivered for one day and publish all tables at the end.

    Files already loaded are not loaded again, so a rerun gives the same tables.
    If anything fails, no table changes and the ledger names the error.
    """
    check_batch_id(batch_id)
    spark = lake.spark
    ledger_event(spark, ledger_path(lake), batch_id, FEED_TYPE, RUNNING)
    try:
        lake.refresh()
        version = lake.next_version()
        run_ts = F.localtimestamp()
        # The feeds do not depend on each other until redemptions look members up.
        with ThreadPoolExecutor(2) as pool:
            inherit = inheritable_thread_target(spark)
            members = pool.submit(
                inherit(_members), lake, landing, batch_id, contract, member_source, version, run_ts
            )
            staged = pool.submit(inherit(_stage_redemptions), lake, landing, batch_id, redemption_source, version)
        counts, known = members.result()
        loaded, flattened = staged.result()
        counts |= loaded | _redemptions(lake, batch_id, version, run_ts, flattened, known)
        lake.commit(batch_id)
    except Exception as error:
        lake.discard()
        ledger_event(spark, ledger_path(lake), batch_id, FEED_TYPE, FAILED, error=str(error))
        raise
    loaded = counts["member_staged"] + counts["redemption_accepted"]
    rejected = counts["member_rejected"] + counts["member_conflicting"] + counts["redemption_rejected"]
    ledger_event(spark, ledger_path(lake), batch_id, FEED_TYPE, SUCCESS, loaded, rejected)
    return counts


def _members(
    lake: Lake, landing: str, batch_id: str, contract: FeedContract, source: FeedSource, version: int, run_ts: Column
) -> tuple[dict[str, int], list[DataFrame]]:
    spark, root = lake.spark, raw_root(lake, "member")

    def check(target: str) -> None:
        require_contract(first_lines(spark, root, target), contract)

    # Headers are checked before anything is landed, and once more as landed, as files may have come in between.
    loaded = load_feed(spark, landing, root, source, batch_id, check=check, check_heads=lambda heads: require_contract(heads, contract))
    lines, line_count = loaded_lines(spark, root, batch_id)
    if not line_count:
        raise NoFilesError(f"batch {batch_id} has no lines in any {source.folder} file")

    # One pass over the raw lines; valid and rejected rows go to folders of their own.
    evaluated, seen = lake.write_batch(
        stages.evaluate_members(raw_member(lines), contract),
        "member_evaluated",
        MEMBER_EVALUATED,
        version,
        batch_id,
        split_by="is_valid",
        valid=F.count_if("is_valid"),
    )
    staged = stages.member_staging(evaluated)

    pairs = conflicts(staged, "member_id", "source_feed_timestamp", list(MEMBER_ATTRIBUTES))
    pairs, clashes = lake.write_batch(
        pairs.withColumn("batch_id", F.lit(batch_id)), "conflicting_versions", CONFLICTING_VERSIONS, version, batch_id
    )
    if clashes["rows"]:
        bad, good = split_conflicts(staged, pairs.drop("batch_id"), "member_id", "source_feed_timestamp")
    else:
        bad, good = small_frame(spark, [], DQ_QUARANTINE), staged.where("member_id is not null")
    _, clashing = lake.write_batch(bad, "conflicting_members", DQ_QUARANTINE, version, batch_id)

    known = _hold_members(lake, latest_members(good), seen["valid"], version, run_ts)

    counts = {
        "member_files_loaded": loaded.files,
        "member_lines_loaded": loaded.lines,
        "member_files_replaced": loaded.replaced_files,
        "member_lines": line_count,
        "member_staged": seen["valid"],
        "member_rejected": seen["rows"] - seen["valid"],
        "member_conflicting": clashing["rows"],
    }
    return counts, known


def _hold_members(lake: Lake, newest: DataFrame, newest_rows: int, version: int, run_ts: Column) -> list[DataFrame]:
    """Merge a day's latest rows into the current members; returns the tables that have the ids known then, each in its buckets.

    A day costs what it delivers, not what there is: only the members it names are looked up and merged, and they are kept in
    a slot of recent changes. Base and country tables are rewritten, countries as far as they differ, when the
    recent changes outgrow a share of the base.
    """
    base, recent = (lake.read_entity("member_current", MEMBER_CURRENT, MEMBER_KEY, slot) for slot in (BASE, RECENT))
    if int(lake.spark.conf.get("spark.sql.shuffle.partitions")) != lake.buckets:
        newest = lake.in_buckets(newest, MEMBER_KEY)  # else the latest rows are in their buckets already
    if base is None:
        changes = stages.merge_members(None, newest, run_ts, unique=True)
    else:
        named = newest.select(*MEMBER_KEY)
        held = _named(base, named, newest_rows)
        if recent is not None:
            held = upsert(held, recent.join(named, MEMBER_KEY, "left_semi"), MEMBER_KEY, unique=True)
        changes = stages.merge_members(held, newest, run_ts, unique=True)
        if recent is not None:
            changes = upsert(recent, changes, MEMBER_KEY, unique=True)
    changed_rows = lake.row_count("member_current", RECENT) + newest_rows
    if base is not None and changed_rows <= FOLD_SHARE * lake.row_count("member_current", BASE):
        recent = lake.write_entity(changes, "member_current", MEMBER_CURRENT, version, MEMBER_KEY, RECENT)
        return [base.select(*MEMBER_KEY), recent.select(*MEMBER_KEY)]
    folded = changes if base is None else upsert(base, changes, MEMBER_KEY, unique=True)
    after = lake.write_entity(folded, "member_current", MEMBER_CURRENT, version, MEMBER_KEY, BASE)
    lake.empty_slot("member_current", RECENT, version)
    touched = affected_partitions(base, after, "member_id", "country", LINEAGE)
    affected = sorted(row.country for row in touched.where(F.col("country").isin(*COUNTRIES)).collect())
    routed = project(after, "country", affected)
    lake.write_projection(routed, "member_country", MEMBER_CURRENT, version, "country", affected, MEMBER_KEY)
    return [after.select(*MEMBER_KEY)]


def _named(base: DataFrame, named: DataFrame, rows: int) -> DataFrame:
    """Members of the base that a day names in at most so many rows.

    A small day's ids, at most `LOOKUP_ROWS`, become values of a filter, by which Spark leaves out all other buckets and what the
    files' statistics rule out; a larger one would touch most buckets anyway and is joined, bucket by bucket.
    """
    if rows <= LOOKUP_ROWS:
        return base.where(F.col("member_id").isin([row.member_id for row in named.collect()]))
    return base.join(named, MEMBER_KEY, "left_semi")


def _stage_redemptions(
    lake: Lake, landing: str, batch_id: str, source: FeedSource, version: int
) -> tuple[dict[str, int], DataFrame]:
    root = raw_root(lake, "redemption")
    loaded = load_feed(lake.spark, landing, root, source, batch_id, json=True)
    lines, _ = loaded_lines(lake.spark, root, batch_id)
    flattened = flatten_redemptions(raw_redemption(lines))
    counts = {
        "redemption_files_loaded": loaded.files,
        "redemption_lines_loaded": loaded.lines,
        "redemption_files_replaced": loaded.replaced_files,
    }
    return counts, lake.write_batch(flattened, "redemption_staging", REDEMPTION_STAGING, version, batch_id)[0]


def _redemptions(
    lake: Lake, batch_id: str, version: int, run_ts: Column, staged: DataFrame, members: list[DataFrame]
) -> dict[str, int]:
    with temporary(lake.spark):  # what is known of repeated and unknown keys is needed until the rows are written
        evaluated, seen = lake.write_batch(
            stages.evaluate_redemptions(staged, members, buckets=lake.buckets),
            "redemption_evaluated",
            REDEMPTION_EVALUATED,
            version,
            batch_id,
            split_by="is_valid",
            valid=F.count_if("is_valid"),
        )
    _curate(lake, stages.accepted_redemptions(evaluated), seen["valid"], version, run_ts)
    return {
        "redemption_flattened": seen["rows"],
        "redemption_accepted": seen["valid"],
        "redemption_rejected": seen["rows"] - seen["valid"],
    }


def _curate(lake: Lake, accepted: DataFrame, accepted_rows: int, version: int, run_ts: Column) -> None:
    """Upsert a batch into the curated transactions.

    These grow without end, so a batch must not rewrite them all. Changes since
    the last full write are kept in a slot of their own, which a batch rewrites,
    and are folded into the base when they outgrow a share of it.
    """
    base, recent = (lake.read_entity("redemption", REDEMPTION, REDEMPTION_KEY, slot) for slot in (BASE, RECENT))
    if recent is None:
        accepted = lake.in_buckets(accepted, REDEMPTION_KEY)
    changes = stages.merge_redemptions(recent, accepted, run_ts, unique=True)  # copies of an id are never accepted
    changed_rows = lake.row_count("redemption", RECENT) + accepted_rows
    if base is not None and changed_rows <= FOLD_SHARE * lake.row_count("redemption", BASE):
        lake.write_entity(changes, "redemption", REDEMPTION, version, REDEMPTION_KEY, RECENT)
    else:
        folded = stages.merge_redemptions(base, changes, unique=True)
        lake.write_entity(folded, "redemption", REDEMPTION, version, REDEMPTION_KEY, BASE)
        lake.empty_slot("redemption", RECENT, version)


# -- published tables ------------------------------------------------------------


def read_raw_member(lake: Lake, batch_id: str | None = None) -> DataFrame:
    return raw_member(loaded_lines(lake.spark, raw_root(lake, "member"), batch_id)[0])


def read_raw_redemption(lake: Lake, batch_id: str | None = None) -> DataFrame:
    return raw_redemption(loaded_lines(lake.spark, raw_root(lake, "redemption"), batch_id)[0])


def read_member_evaluated(lake: Lake) -> DataFrame:
    return lake.read("member_evaluated", MEMBER_EVALUATED)


def read_member_staging(lake: Lake) -> DataFrame:
    return stages.member_staging(read_member_evaluated(lake))


def read_dq_quarantine(lake: Lake) -> DataFrame:
    return stages.member_quarantine(read_member_evaluated(lake), lake.read("conflicting_members", DQ_QUARANTINE))


def read_member_current(lake: Lake) -> DataFrame:
    base, recent = (lake.read_entity("member_current", MEMBER_CURRENT, MEMBER_KEY, slot) for slot in (BASE, RECENT))
    if base is None:
        return small_frame(lake.spark, [], MEMBER_CURRENT)
    return base if recent is None else upsert(base, recent, MEMBER_KEY, unique=True)


def read_member_countries(lake: Lake) -> DataFrame:
    """All country tables together, recent changes routed in; filter on `country` for one of them.

    Every country is read in its buckets, less the members that changed, which are looked up bucket by bucket.
    """
    routed = lake.read_projection("member_country", MEMBER_CURRENT, "country", MEMBER_KEY)
    recent = lake.read_entity("member_current", MEMBER_CURRENT, MEMBER_KEY, RECENT)
    if recent is not None:
        changed = changed_keys(recent, "member_id")
        routed = [rows.join(changed, MEMBER_KEY, "left_anti").select(rows.columns) for rows in routed]
        routed.append(project(recent, "country", COUNTRIES))
    return reduce(DataFrame.unionByName, routed) if routed else small_frame(lake.spark, [], MEMBER_CURRENT)


def read_redemption_staging(lake: Lake) -> DataFrame:
    return lake.read("redemption_staging", REDEMPTION_STAGING)


def read_redemption_evaluated(lake: Lake) -> DataFrame:
    return lake.read("redemption_evaluated", REDEMPTION_EVALUATED)


def read_redemption_quarantine(lake: Lake) -> DataFrame:
    return stages.redemption_quarantine(read_redemption_evaluated(lake))


def read_redemption(lake: Lake) -> DataFrame:
    base, recent = (lake.read_entity("redemption", REDEMPTION, REDEMPTION_KEY, slot) for slot in (BASE, RECENT))
    if base is None:
        return small_frame(lake.spark, [], REDEMPTION)
    return base if recent is None else stages.merge_redemptions(base, recent, unique=True)


def create_views(lake: Lake) -> list[str]:
    """Temporary views of everything published, one per table and one per country; returns their names.

    The views show what is published at the time of the call.
    """
    routed = read_member_countries(lake)
    views = {
        "raw_member_feed": read_raw_member(lake),
        "raw_redemption_feed": read_raw_redemption(lake),
        "member_dq_evaluated": read_member_evaluated(lake),
        "member_staging": read_member_staging(lake),
        "dq_quarantine": read_dq_quarantine(lake),
        "member_current": read_member_current(lake),
        **{f"member_{country.lower()}": project(routed, "country", [country]) for country in COUNTRIES},
        "redemption_staging": read_redemption_staging(lake),
        "redemption_dq_evaluated": read_redemption_evaluated(lake),
        "redemption_dq_quarantine": read_redemption_quarantine(lake),
        "redemption": read_redemption(lake),
        "batch_run": read_ledger(lake),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def suite(lake: Lake) -> DataFrame:
    """All checks over the published tables."""
    staged = read_member_staging(lake)
    pairs = lake.read("conflicting_versions", CONFLICTING_VERSIONS).select(
        "member_id", "source_feed_timestamp", "key_rows"
    )
    _, eligible = split_conflicts(staged, pairs, "member_id", "source_feed_timestamp")
    current = read_member_current(lake)
    held_before = eligible.select("member_id", "country").distinct()
    return check_suite(
        {
            "member_current": current,
            "member_staging": staged,
            "member_eligible": eligible,
            "member_country": read_member_countries(lake),
            "member_moved": movements(held_before, current, "member_id", "country"),
            "redemption": read_redemption(lake),
            "redemption_staging": read_redemption_staging(lake),
            "redemption_evaluated": read_redemption_evaluated(lake),
        }
    )


def read_ledger(lake: Lake) -> DataFrame:
    return ledger_state(lake.spark, ledger_path(lake))
