"""Registered queries: each takes (spark, sf_dir) and returns a frame over the derived feeds or the tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.documents import text_at
from feedlake.operators import checks
from feedlake.operators.contract import check_contract
from feedlake.operators.keyed import with_exists, with_key_size
from feedlake.operators.merge import upsert
from feedlake.operators.parse import flatten_redemptions, parse_lines
from feedlake.operators.routing import changed_keys, movements, project, reroute
from feedlake.operators.rules import reason_counts
from feedlake.operators.versions import conflicts, latest, latest_members, split_conflicts
from feedlake.plans import daily, feeds, stages
from feedlake.plans.feeds import BATCHES, FILE_SOURCES
from feedlake.schemas import COUNTRIES, MEMBER_ATTRIBUTES, MEMBER_CONTRACT, ContractError
from feedlake.sources.landing import (
    MalformedDocumentError,
    NoFilesError,
    first_lines,
    ingest_json,
    ingest_lines,
    ingest_summary,
    land,
    loaded_lines,
)
from feedlake.sources.scratch import delete_folder, exists, materialise, new_folder, small_frame
from feedlake.sources.tables import Lake
from feedlake.streaming.load_once import ingest_new, load_feed

FIRST, SECOND = BATCHES
ROW = ["batch_id", "source_row_number"]
CURRENT = ["member_id", *MEMBER_ATTRIBUTES, "batch_id", "source_row_number"]
TXN = ["txn_id", "member_id", "feed_date", "txn_date", "partner", "miles_redeemed", "status"]
PATTERN = FILE_SOURCES["member"].pattern


def _day(df: DataFrame, batch_id: str) -> DataFrame:
    return df.where(F.col("batch_id") == batch_id)


def _file_no() -> Column:
    """The file's number; written files have names that differ from run to run."""
    return F.regexp_extract("source_file_name", r"file_no=(\d+)", 1).cast("long").alias("file_no")


# -- stages shared by several queries, each ending where a table would be written ------------


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.evaluate_members(feeds.raw_member_feed(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written before valid rows are taken: Spark moves that test to the raw lines, where every rule would split and parse them anew.
    return stages.member_staging(materialise(_evaluated(spark, sf_dir), "evaluated"))


def _conflicts(staged: DataFrame) -> DataFrame:
    return conflicts(staged, "member_id", "source_feed_timestamp", list(MEMBER_ATTRIBUTES))


def _split(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_conflicts(staged, _conflicts(staged), "member_id", "source_feed_timestamp")


def _latest_of_day(staged: DataFrame, batch_id: str) -> DataFrame:
    return latest_members(_split(_day(staged, batch_id))[1])


def _states(staged: DataFrame, order: tuple[str, ...]) -> list[DataFrame]:
    """Current members after each batch, in the order in which the batches are processed."""
    states: list[DataFrame] = []
    for batch_id in order:
        merged = stages.merge_members(states[-1] if states else None, _latest_of_day(staged, batch_id), unique=True)
        states.append(materialise(merged, f"members-{batch_id}"))
    return states


def _flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(flatten_redemptions(feeds.raw_redemption_feed(spark, sf_dir)), "flattened")


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Flattened and evaluated transactions; each day looks members up as they are after that day."""
    # The feeds do not depend on each other until members are looked up.
    with ThreadPoolExecutor(2) as pool:
        inherit = inheritable_thread_target(spark)
        flattening = pool.submit(inherit(_flattened), spark, sf_dir)
        merging = pool.submit(inherit(lambda: _states(_staged(spark, sf_dir), BATCHES)))
    flattened = flattening.result()
    first, second = (
        state.select(F.lit(batch_id).alias("batch_id"), "member_id") for batch_id, state in zip(BATCHES, merging.result())
    )
    return flattened, stages.evaluate_redemptions(flattened, first.unionByName(second), ["batch_id", "member_id"])


def _redemptions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Flattened and evaluated transactions, both written as tables."""
    flattened, evaluated = _judged(spark, sf_dir)
    return flattened, materialise(evaluated, "evaluated")


def _curated(evaluated: DataFrame) -> DataFrame:
    curated = None
    for batch_id in BATCHES:
        curated = stages.merge_redemptions(curated, stages.accepted_redemptions(_day(evaluated, batch_id)), unique=True)
    return curated


# -- files -----------------------------------------------------------------------------------


_deliveries: dict[tuple, str] = {}


def _delivered(spark: SparkSession, sf_dir: str, table: str, variant: object, write: Callable[[str, str], None]) -> str:
    """A landing folder with the files of both days; files are input, written once per state of their table."""
    key = (spark.sparkContext.applicationId, feeds.state(spark, sf_dir, table), variant)
    if key not in _deliveries:
        landing = feeds.new_landing(spark)
        for batch_id in BATCHES:
            write(landing, batch_id)
        _deliveries[key] = landing
    return _deliveries[key]


def _member_files(spark: SparkSession, sf_dir: str, headers: tuple[str, ...] = (feeds.HEADER,)) -> str:
    return _delivered(
        spark, sf_dir, "customer", headers,
        lambda landing, batch_id: feeds.write_member_files(spark, sf_dir, landing, batch_id, headers),
    )


def _ingested_members(spark: SparkSession, landing: str) -> DataFrame:
    days = [ingest_lines(spark, f"{landing}/member", batch_id, PATTERN) for batch_id in BATCHES]
    return days[0].unionByName(days[1])


def raw_member_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _ingested_members(spark, _member_files(spark, sf_dir))
    return raw.select(
        "batch_id",
        _file_no(),
        "source_row_number",
        "record_type",
        "raw_record",
        F.col("source_feed_timestamp").cast("date").alias("feed_date"),
    )


def raw_redemption_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _delivered(
        spark, sf_dir, "orders", "documents",
        lambda landing, batch_id: feeds.write_redemption_files(spark, sf_dir, landing, batch_id),
    )
    days = [ingest_json(spark, f"{landing}/redemption", batch_id, PATTERN) for batch_id in BATCHES]
    raw = days[0].unionByName(days[1])
    return raw.select(
        "batch_id",
        _file_no(),
        "source_row_number",
        "raw_text",
        text_at(F.col("raw_record"), "$.member_id").alias("member_id"),
    )


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines passed on by three calls over one folder: first day, nothing new, second day added."""
    landing, sink_root = feeds.new_landing(spark), new_folder(spark, "loads")
    checkpoint = new_folder(spark, "load-checkpoint")
    loaded = []

    for call, batch_id in enumerate((FIRST, None, SECOND), start=1):

        def sink(batch: DataFrame, load: int, call: int = call) -> None:
            land(batch, f"{sink_root}/call={call}/load={load}")

        if batch_id:
            feeds.write_member_files(spark, sf_dir, landing, batch_id)
        ingest_new(spark, f"{landing}/member", checkpoint, sink, PATTERN)
        loaded.append(_passed_on(spark, f"{sink_root}/call={call}", call))
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


def _passed_on(spark: SparkSession, folder: str, call: int) -> DataFrame:
    """Number of lines below a folder, which is missing if nothing was passed on."""
    ddl = "raw_text string"
    files = spark.read.option("recursiveFileLookup", "true").schema(ddl)
    lines = files.parquet(folder) if exists(spark, folder) else small_frame(spark, [], ddl)
    return lines.agg(F.count("*").alias("row_count")).select(F.lit(call).alias("call_no"), "row_count")


def redelivered_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines loaded and visible after four calls: first day, nothing changed, one file delivered anew, and the same file emptied.

    The file that comes anew is that of the smallest customers, each line in capitals and all lines twice.
    """
    landing, root = feeds.new_landing(spark), new_folder(spark, "raw")
    source = FILE_SOURCES["member"]
    seen = []
    for call in (1, 2, 3, 4):
        if call == 1:
            feeds.write_member_files(spark, sf_dir, landing, FIRST)
        if call == 3:
            feeds.rewrite_first_member_file(spark, sf_dir, landing, FIRST)
        if call == 4:
            feeds.empty_first_member_file(spark, landing, FIRST)
        loaded = load_feed(spark, landing, root, source, FIRST)
        lines, _ = loaded_lines(spark, root, FIRST)
        counted = lines.agg(
            F.count("*").alias("visible_lines"),
            F.count_if(F.col("raw_text") == F.upper("raw_text")).alias("in_capitals"),
            F.max("source_row_number").alias("last_line"),
        )
        told = [F.lit(call).alias("call_no"), F.lit(loaded.status).alias("status")]
        numbers = {"lines_loaded": loaded.lines, "files_replaced": loaded.replaced_files}
        seen.append(counted.select(*told, *(F.lit(n).cast("long").alias(name) for name, n in numbers.items()), *counted.columns))
    return reduce(DataFrame.unionByName, seen)


def pattern_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per file where the pattern leaves out every file with an odd number."""
    landing = _member_files(spark, sf_dir)
    raw = ingest_lines(spark, f"{landing}/member", FIRST, r".*/file_no=\d*[02468]/[^/]*\.txt")
    return ingest_summary(raw).select("batch_id", _file_no(), "row_count")


def array_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents delivered as arrays of one: each stays one array."""
    landing = feeds.new_landing(spark)
    feeds.write_redemption_files(spark, sf_dir, landing, FIRST, "[%s]")
    raw = ingest_json(spark, f"{landing}/redemption", FIRST, PATTERN)
    return raw.select(
        _file_no(), "source_row_number", F.schema_of_variant("raw_record").startswith("ARRAY").alias("is_array"),
        text_at(F.col("raw_record"), "$[0].member_id").alias("member_id"),
    )


def malformed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible lines per day where the documents of the first day are broken off and its load fails as a whole."""
    landing, root = feeds.new_landing(spark), new_folder(spark, "raw")
    source = FILE_SOURCES["redemption"]
    feeds.write_redemption_files(spark, sf_dir, landing, FIRST, "{%s")
    feeds.write_redemption_files(spark, sf_dir, landing, SECOND)
    for batch_id in BATCHES:
        try:
            load_feed(spark, landing, root, source, batch_id, json=True)
        except MalformedDocumentError:
            continue
    days = [
        loaded_lines(spark, root, batch_id)[0].agg(F.count("*").alias("visible_lines")).select(F.lit(batch_id).alias("batch_id"), "visible_lines")
        for batch_id in BATCHES
    ]
    return days[0].unionByName(days[1])


def file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _ingested_members(spark, _member_files(spark, sf_dir))
    return ingest_summary(raw).select("batch_id", _file_no(), "row_count")


def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of all files, as the daily batch reads them from the register of splits, against the contract."""
    landing, root = _member_files(spark, sf_dir, feeds.HEADER_VARIANTS), new_folder(spark, "raw")
    heads = []
    for batch_id in BATCHES:
        load_feed(spark, landing, root, FILE_SOURCES["member"], batch_id, check=lambda target: heads.append(first_lines(spark, root, target)))
    return check_contract(reduce(DataFrame.unionByName, heads), MEMBER_CONTRACT).select("batch_id", _file_no(), "violation")


# -- members ---------------------------------------------------------------------------------


def member_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(feeds.raw_member_feed(spark, sf_dir), MEMBER_CONTRACT)
    dates = [f"{field.name}_raw" for field in MEMBER_CONTRACT.fields if field.date_format]
    return parsed.select(
        *ROW, "record_type", "source_field_count", *(field.name for field in MEMBER_CONTRACT.fields), *dates
    )


def member_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir).select(*ROW, "source_field_count", "dq_reason", "is_valid")


def member_dq_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_counts(_evaluated(spark, sf_dir))


def member_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stages.member_staging(_evaluated(spark, sf_dir))
    return staged.select(*ROW, "source_file_name", "member_id", *MEMBER_ATTRIBUTES)


def member_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = materialise(_evaluated(spark, sf_dir), "evaluated")
    bad, _ = _split(stages.member_staging(evaluated))
    return stages.member_quarantine(evaluated, bad).select(*ROW, "raw_record", "dq_reason")


def member_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _conflicts(stages.member_staging(_evaluated(spark, sf_dir)))
    return found.select("member_id", F.col("source_feed_timestamp").cast("date").alias("version_date"), "key_rows")


def member_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, good = _split(_staged(spark, sf_dir))
    return latest_members(good).select(CURRENT)


def member_current_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(_staged(spark, sf_dir), BATCHES)[-1].select(CURRENT)


def member_current_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second day is processed first; the first day, arriving late, must not overwrite it."""
    return _states(_staged(spark, sf_dir), (SECOND, FIRST))[-1].select(CURRENT)


def member_current_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both days processed, then the first one once more."""
    return _states(_staged(spark, sf_dir), (FIRST, SECOND, FIRST))[-1].select(CURRENT)


def country_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir)
    first, second = _states(staged, BATCHES)
    changed = changed_keys(_day(staged, SECOND), "member_id")
    routed = reroute(project(first, "country", COUNTRIES), second, changed, "member_id", "country", COUNTRIES)
    return routed.select("country", "member_id", "batch_id", "state", "age")


def country_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _states(_staged(spark, sf_dir), BATCHES)
    return movements(first, second, "member_id", "country")


def member_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch: lines delivered, not details, accepted, rejected, and accepted ones in conflict."""
    raw = feeds.raw_member_feed(spark, sf_dir)
    evaluated = materialise(_evaluated(spark, sf_dir), "evaluated")
    bad, _ = _split(stages.member_staging(evaluated))
    return checks.reconcile_members(raw, evaluated, bad)


# -- redemptions -----------------------------------------------------------------------------


def redemption_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_redemptions(feeds.raw_redemption_feed(spark, sf_dir)).select(*ROW, "pos", *TXN)


def redemption_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, evaluated = _judged(spark, sf_dir)
    return evaluated.select(*ROW, "pos", "dq_reason", "is_valid")


def redemption_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, evaluated = _judged(spark, sf_dir)
    values = [name for name in TXN if name != "feed_date"]
    return stages.redemption_quarantine(evaluated).select(*ROW, "pos", *values, "dq_reason")


def redemption_curated_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, evaluated = _redemptions(spark, sf_dir)
    return _curated(evaluated).select(*TXN, *ROW)


def redemption_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    flattened, evaluated = _redemptions(spark, sf_dir)
    return checks.reconcile(flattened, evaluated, _curated(evaluated))


# -- checks ----------------------------------------------------------------------------------


def check_member_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _states(_staged(spark, sf_dir), BATCHES)[-1]
    return checks.verdict("member_unique", checks.repeated_keys(current, ["member_id"]))


def check_country_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir)
    first, second = _states(staged, BATCHES)
    changed = changed_keys(_day(staged, SECOND), "member_id")
    routed = reroute(project(first, "country", COUNTRIES), second, changed, "member_id", "country", COUNTRIES)
    return checks.verdict("country_routing", checks.misrouted(second, routed, "member_id"))


def check_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir)
    current = _states(staged, (SECOND, FIRST))[-1]
    wrong = checks.not_latest(current, _split(staged)[1], staged, "member_id", "source_feed_timestamp")
    return checks.verdict("latest_wins", wrong)


def check_txn_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, evaluated = _redemptions(spark, sf_dir)
    return checks.verdict("txn_unique", checks.repeated_keys(_curated(evaluated), ["txn_id"]))


# The same checks over tables into which faults were put, so that each has something to find.


def _numbered(place: int) -> Column:
    """Members whose number ends in this digit."""
    return F.coalesce(F.col("member_id").try_cast("long") % 10 == place, F.lit(False))


def check_member_unique_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some members are there twice."""
    current = _states(_staged(spark, sf_dir), BATCHES)[-1]
    twice = current.unionByName(current.where(_numbered(3)))
    return checks.verdict("member_unique", checks.repeated_keys(twice, ["member_id"]))


def check_country_routing_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some members are in two countries and some in none."""
    current = _states(_staged(spark, sf_dir), BATCHES)[-1]
    routed = project(current, "country", COUNTRIES).where(~_numbered(3))
    routed = routed.unionByName(routed.where(_numbered(4)).withColumn("country", F.lit("XXX")))
    return checks.verdict("country_routing", checks.misrouted(current, routed, "member_id"))


def check_latest_wins_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some members are held in an older version and some are missing."""
    staged = _staged(spark, sf_dir)
    current = _states(staged, BATCHES)[-1].where(~_numbered(4))
    older = F.col("source_feed_timestamp") - F.expr("interval 1 day")
    held = current.withColumn("source_feed_timestamp", F.when(_numbered(3), older).otherwise(F.col("source_feed_timestamp")))
    wrong = checks.not_latest(held, _split(staged)[1], staged, "member_id", "source_feed_timestamp")
    return checks.verdict("latest_wins", wrong)


def check_txn_unique_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some transactions are there twice."""
    curated = _curated(_redemptions(spark, sf_dir)[1])
    twice = curated.unionByName(curated.where("txn_id like '%3-0'"))
    return checks.verdict("txn_unique", checks.repeated_keys(twice, ["txn_id"]))


def check_reconcile_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some accepted transactions are lost."""
    flattened, evaluated = _redemptions(spark, sf_dir)
    return checks.reconcile(flattened, evaluated, _curated(evaluated).where("txn_id not like '%3-0'"))


def check_country_movement_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some members that moved are still where they were, too."""
    first, second = _states(_staged(spark, sf_dir), BATCHES)
    moved = movements(project(first, "country", COUNTRIES), project(second, "country", COUNTRIES), "member_id", "country")
    stayed = project(first, "country", COUNTRIES).join(moved.where(_numbered(3) | _numbered(4)).select("member_id"), "member_id", "left_semi")
    routed = project(second, "country", COUNTRIES).unionByName(stayed)
    return checks.verdict("country_movement", checks.unmoved(moved, routed, "member_id", "country"))


def check_unknown_member_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some members with accepted transactions are no members any more."""
    evaluated = _redemptions(spark, sf_dir)[1]
    current = _states(_staged(spark, sf_dir), BATCHES)[-1].where(~_numbered(3))
    return checks.verdict("unknown_member_quarantined", checks.unknown_member_accepted(evaluated, current))


def check_idempotent_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun has put some rejected transactions into quarantine once more and some accepted ones into the curated table."""
    evaluated = _redemptions(spark, sf_dir)[1]
    curated = _curated(evaluated)
    twice = curated.unionByName(curated.where("txn_id like '%3-0'"))
    again = evaluated.unionByName(evaluated.where("not is_valid and pos = 0"))
    return checks.verdict("idempotent", checks.run_twice(twice, again))


def daily_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Both days processed from files. Every query processes them itself, so that its time and disk are those of its whole work.

    The files are deleted when they are loaded, as all tables are made from RAW.
    """
    landing, lake = feeds.new_landing(spark), Lake(spark, new_folder(spark, "lake"))
    for batch_id in BATCHES:
        feeds.write_day(spark, sf_dir, landing, batch_id)
        run_day(lake, landing, batch_id)
    delete_folder(spark, landing)
    return lake


def run_day(lake: Lake, landing: str, batch_id: str) -> dict[str, int]:
    return daily.run_batch(
        lake, landing, batch_id, member_source=FILE_SOURCES["member"], redemption_source=FILE_SOURCES["redemption"]
    )


def _row_counts(lake: Lake, name: str) -> DataFrame:
    """Rows of every published table, as one row each, written while the state is as it is now."""
    tables = {
        "dq_quarantine": daily.read_dq_quarantine(lake),
        "member_country": daily.read_member_countries(lake),
        "member_current": daily.read_member_current(lake),
        "member_staging": daily.read_member_staging(lake),
        "raw_member": daily.read_raw_member(lake),
        "redemption": daily.read_redemption(lake),
        "redemption_quarantine": daily.read_redemption_quarantine(lake),
        "redemption_staging": daily.read_redemption_staging(lake),
    }
    counted = [df.agg(F.count("*").alias(name)).select(F.lit(table).alias("table_name"), name) for table, df in tables.items()]
    return materialise(reduce(DataFrame.unionByName, counted), name)


def check_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table after the first day, and after running it again over files that are all loaded."""
    landing, lake = feeds.new_landing(spark), Lake(spark, new_folder(spark, "lake"))
    feeds.write_day(spark, sf_dir, landing, FIRST)
    run_day(lake, landing, FIRST)
    before = _row_counts(lake, "rows_after_run")
    run_day(lake, landing, FIRST)
    return before.join(_row_counts(lake, "rows_after_rerun"), "table_name", "full_outer")


def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.suite(daily_lake(spark, sf_dir))


def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = daily.read_ledger(daily_lake(spark, sf_dir))
    return state.select("batch_id", "feed_type", "status", "rows_loaded", "rows_rejected", "error_message")


def daily_member_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current members as the daily batch publishes them."""
    current = daily.read_member_current(daily_lake(spark, sf_dir))
    return current.select("member_id", *MEMBER_ATTRIBUTES, "batch_id", _file_no())


def daily_member_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country tables as the daily batch publishes them."""
    routed = daily.read_member_countries(daily_lake(spark, sf_dir))
    return routed.select("country", "member_id", "batch_id", "state", "age")


def daily_redemption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated transactions as the daily batch publishes them."""
    return daily.read_redemption(daily_lake(spark, sf_dir)).select(*TXN, "batch_id")


def daily_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members per country, asked of the published views in SQL."""
    daily.create_views(daily_lake(spark, sf_dir))
    per_view = [f"select '{country}' as country, count(*) as members from member_{country.lower()}" for country in COUNTRIES]
    return spark.sql(" union all ".join([*per_view, "select 'ALL', count(*) from member_current"]))


def daily_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a member's row was updated after it was created, and whether its lines have their time of loading."""
    lake = daily_lake(spark, sf_dir)
    current = daily.read_member_current(lake).select("member_id", (F.col("updated_at") > F.col("created_at")).alias("updated_later"))
    staged = daily.read_member_staging(lake).groupBy("member_id").agg(F.bool_and(F.col("ingestion_timestamp") <= F.localtimestamp()).alias("loaded_before_now"))
    return current.join(staged, "member_id")


def failed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of two days that fail: one has files with wrong headers, the other no member file."""
    landing, lake = feeds.new_landing(spark), Lake(spark, new_folder(spark, "lake"))
    feeds.write_member_files(spark, sf_dir, landing, FIRST, feeds.HEADER_VARIANTS[1:])
    feeds.write_redemption_files(spark, sf_dir, landing, FIRST)
    feeds.write_redemption_files(spark, sf_dir, landing, SECOND)
    for batch_id in BATCHES:
        try:
            run_day(lake, landing, batch_id)
        except (ContractError, NoFilesError):
            continue
    lines = daily.read_raw_member(lake).groupBy("batch_id").agg(F.count("*").alias("visible_lines"))
    published = daily.read_member_current(lake).agg(F.count("*").alias("members"))
    ledger = daily.read_ledger(lake).select(
        "batch_id", "status", F.col("error_message").contains("HEADER_").alias("names_header"), F.col("completed_at").isNotNull().alias("completed"), "rows_loaded"
    )
    return ledger.join(lines, "batch_id", "left").join(F.broadcast(published))


# -- the same operators on the tables themselves -----------------------------------------------


def events_props_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feeds.table(spark, sf_dir, "events")
    return events.select("event_id", text_at(F.try_parse_json("props"), "$.k").try_cast("int").alias("k"))


def orders_latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    last = latest(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return last.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def events_upsert_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user, built up from three deliveries of ten days, the middle one arriving last."""
    events = feeds.table(spark, sf_dir, "events")
    delivery = F.least(F.expr("(day(ts) - 1) div 10"), F.lit(2))
    state = None
    for part in (0, 2, 1):
        last = latest(events.where(delivery == part), ["user_id"], [F.desc("ts"), F.desc("event_id")])
        state = upsert(state, last, ["user_id"], version="ts", unique=True)
    return state.select("user_id", "event_id", "event_type", "value")


def orders_known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the number of orders of its customer, and whether the customer is in credit."""
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = feeds.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    sized = with_key_size(orders, ["o_custkey"], "customer_orders")
    return with_exists(sized, customers, ["o_custkey"], "in_credit")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_member_ingest": raw_member_ingest,
    "raw_redemption_ingest": raw_redemption_ingest,
    "incremental_ingest": incremental_ingest,
    "redelivered_file": redelivered_file,
    "pattern_ingest": pattern_ingest,
    "array_ingest": array_ingest,
    "malformed_ingest": malformed_ingest,
    "ingest_summary": file_summary,
    "contract_check": contract_check,
    "member_parse": member_parse,
    "member_dq": member_dq,
    "member_dq_reason_counts": member_dq_reason_counts,
    "member_staging": member_staging,
    "member_quarantine": member_quarantine,
    "member_conflicts": member_conflicts,
    "member_latest": member_latest,
    "member_current_merge": member_current_merge,
    "member_current_late": member_current_late,
    "member_current_rerun": member_current_rerun,
    "member_reconcile": member_reconcile,
    "country_projection": country_projection,
    "country_movement": country_movement,
    "redemption_flatten": redemption_flatten,
    "redemption_dq": redemption_dq,
    "redemption_quarantine": redemption_quarantine,
    "redemption_curated_merge": redemption_curated_merge,
    "redemption_reconcile": redemption_reconcile,
    "check_member_unique": check_member_unique,
    "check_country_routing": check_country_routing,
    "check_latest_wins": check_latest_wins,
    "check_txn_unique": check_txn_unique,
    "check_member_unique_found": check_member_unique_found,
    "check_country_routing_found": check_country_routing_found,
    "check_latest_wins_found": check_latest_wins_found,
    "check_txn_unique_found": check_txn_unique_found,
    "check_reconcile_found": check_reconcile_found,
    "check_country_movement_found": check_country_movement_found,
    "check_unknown_member_found": check_unknown_member_found,
    "check_idempotent_found": check_idempotent_found,
    "check_idempotent": check_idempotent,
    "check_suite": check_suite,
    "batch_ledger": batch_ledger,
    "daily_member_current": daily_member_current,
    "daily_member_countries": daily_member_countries,
    "daily_redemption": daily_redemption,
    "daily_views": daily_views,
    "daily_audit": daily_audit,
    "failed_batches": failed_batches,
    "events_props_extract": events_props_extract,
    "orders_latest_per_customer": orders_latest_per_customer,
    "events_upsert_by_user": events_upsert_by_user,
    "orders_known_customers": orders_known_customers,
}
