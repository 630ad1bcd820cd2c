"""The registered queries once more, as SQL over the test tables.

Written against the meaning of each query, not after its plan: windows where the
queries aggregate, unions where they merge, `not exists` where they join.
"""

from __future__ import annotations

from feedlake.plans.feeds import (
    BATCHES,
    CUSTOMERS_PER_FILE,
    HEADER,
    HEADER_VARIANTS,
    MEMBER_AGAIN,
    MEMBER_CONTRADICTED,
    MEMBER_COPIED,
    MEMBER_LINE,
    ORDERS_PER_FILE,
    REDEMPTION_AGAIN,
    REDEMPTION_DOCUMENT,
)
from feedlake.schemas import COUNTRIES, MEMBER_ATTRIBUTES

FIRST, SECOND = BATCHES
ATTRIBUTES = ", ".join(MEMBER_ATTRIBUTES)
DOMAIN = ", ".join(f"'{country}'" for country in COUNTRIES)



def _days(again: str) -> str:
    return f"unnest(case when {again} then [{FIRST}, {SECOND}] else [{FIRST}] end)"


MEMBER_FEED = f"""
member_feed as (
  select cast(b as varchar) as batch_id, k, v, k * 4 + v + 2 as source_row_number,
         'member/' || cast(b as varchar) || '/member_profile_feed.csv' as source_file_name,
         {MEMBER_LINE} as raw_record
  from (select *, unnest([0] || case when {MEMBER_CONTRADICTED} then [1] else [] end
                             || case when {MEMBER_COPIED} then [2] else [] end) as v
        from (select c_custkey as k, c_name, c_mktsegment, c_acctbal, {_days(MEMBER_AGAIN)} as b from customer) c) c
)"""


def _part(number: int) -> str:
    return f"nullif(trim(split_part(raw_record, '|', {number})), '')"


def _date(text: str, fmt: str) -> str:
    return f"case when length({text}) = 8 then cast(try_strptime({text}, '{fmt}') as date) end"


PARSED = f"""
parsed as (
  select *, {_date('enrollment_date_raw', '%Y%m%d')} as enrollment_date,
         {_date('last_flight_date_raw', '%Y%m%d')} as last_flight_date, {_date('dob_raw', '%d%m%Y')} as dob
  from (
    select batch_id, source_file_name, source_row_number, raw_record, 'D' as record_type,
           cast(length(raw_record) - length(replace(raw_record, '|', '')) - 1 as integer) as source_field_count,
           {_part(3)} as member_name, {_part(4)} as member_id, {_part(5)} as enrollment_date_raw,
           {_part(6)} as last_flight_date_raw, {_part(7)} as tier_code, {_part(8)} as agent_name, {_part(9)} as state,
           {_part(10)} as country, {_part(11)} as dob_raw, {_part(12)} as is_active
    from member_feed where split_part(raw_record, '|', 2) = 'D') f
)"""

JUDGED = f"""
judged as (
  select *, dq_reason is null as is_valid,
    cast(date_diff('year', dob, as_of) as integer)
      - case when dob + to_years(cast(date_diff('year', dob, as_of) as integer)) > as_of then 1 else 0 end as age,
    date_diff('day', last_flight_date, as_of) > 90 as stale_member
  from (
    select *, cast(strptime(batch_id, '%Y%m%d') as date) as as_of, nullif(concat_ws('; ',
      case when source_field_count <> 10 then 'FIELD_COUNT_MISMATCH' end,
      case when member_name is null then 'MEMBER_NAME_MISSING' end,
      case when member_id is null then 'MEMBER_ID_MISSING' end,
      case when enrollment_date_raw is null then 'ENROLLMENT_DATE_MISSING' end,
      case when enrollment_date_raw is not null and enrollment_date is null then 'ENROLLMENT_DATE_INVALID' end,
      case when last_flight_date_raw is not null and last_flight_date is null then 'LAST_FLIGHT_DATE_INVALID' end,
      case when dob_raw is not null and dob is null then 'DOB_INVALID' end,
      case when country is null then 'COUNTRY_MISSING' end,
      case when country not in ({DOMAIN}) then 'COUNTRY_UNSUPPORTED' end,
      case when is_active is null then 'IS_ACTIVE_MISSING' when is_active not in ('A', 'I') then 'IS_ACTIVE_INVALID' end,
      case when length(member_name) > 255 then 'MEMBER_NAME_TOO_LONG' end,
      case when length(member_id) > 18 then 'MEMBER_ID_TOO_LONG' end,
      case when length(tier_code) > 5 then 'TIER_CODE_TOO_LONG' end,
      case when length(agent_name) > 255 then 'AGENT_NAME_TOO_LONG' end,
      case when length(state) > 5 then 'STATE_TOO_LONG' end,
      case when length(country) > 5 then 'COUNTRY_TOO_LONG' end), '') as dq_reason
    from parsed) p
)"""

STAGED = "staged as (select * from judged where is_valid)"
CLASHES = f"""
clashes as (
  select batch_id, member_id, count(*) as key_rows from staged
  group by batch_id, member_id having count(distinct row({ATTRIBUTES})) > 1
)"""
CLEAN = """
clean as (
  select s.* from staged s
  where not exists (select 1 from clashes c where c.batch_id = s.batch_id and c.member_id = s.member_id)
)"""
DAILY = """
daily as (
  select * from clean
  qualify row_number() over (partition by batch_id, member_id order by source_file_name, source_row_number) = 1
)"""
CURRENT = """
current_members as (
  select * from daily qualify row_number() over (partition by member_id order by batch_id desc) = 1
)"""
MEMBERS = (MEMBER_FEED, PARSED, JUDGED, STAGED, CLASHES, CLEAN, DAILY, CURRENT)

REDEMPTION_FEED = f"""
redemption_feed as (
  select cast(b as varchar) as batch_id, o_orderkey, o_orderkey + 1 as source_row_number, {REDEMPTION_DOCUMENT} as raw_text
  from (select *, {_days(REDEMPTION_AGAIN)} as b from orders) o
)"""
FLATTENED = f"""
flattened as (
  select batch_id, source_row_number, pos, member_id, {_date("feed_text", '%Y%m%d')} as feed_date, txn_id,
         {_date("txn_text", '%Y%m%d')} as txn_date, partner, try_cast(miles_text as decimal(18,0)) as miles_redeemed, status
  from (
    select batch_id, source_row_number, cast(pos as integer) as pos, raw_text::json->>'member_id' as member_id,
           raw_text::json->>'feed_date' as feed_text, value->>'txn_id' as txn_id, value->>'txn_date' as txn_text,
           value->>'partner' as partner, value->>'miles_redeemed' as miles_text, value->>'status' as status
    from (
      select *, unnest(elements) as value, generate_subscripts(elements, 1) - 1 as pos
      from (select *, json_extract(raw_text::json, '$.redemptions[*]') as elements from redemption_feed) d) e) f
)"""
# A member counts as known on a day if some row of that day or an earlier one made it current.
REDEMPTIONS = f"""
redemptions as (
  select *, dq_reason is null as is_valid from (
    select *, nullif(concat_ws('; ',
      case when member_id is null then 'MEMBER_ID_MISSING' end,
      case when txn_id is null then 'TXN_ID_MISSING' end,
      case when txn_date is null then 'TXN_DATE_INVALID_OR_MISSING' end,
      case when feed_date is null then 'FEED_DATE_INVALID_OR_MISSING' end,
      case when miles_redeemed is null or miles_redeemed < 0 then 'MILES_REDEEMED_INVALID' end,
      case when status is null or status not in ('COMPLETED', 'PENDING', 'CANCELLED') then 'STATUS_INVALID' end,
      case when partner is null then 'PARTNER_MISSING' end,
      case when count(*) over (partition by batch_id, txn_id) > 1 then 'DUPLICATE_TXN_ID' end,
      case when member_id is not null and not exists (
        select 1 from daily m where m.member_id = f.member_id and m.batch_id <= f.batch_id) then 'MEMBER_NOT_FOUND' end),
      '') as dq_reason
    from flattened f) g
)"""
CURATED = """
curated as (
  select * from redemptions where is_valid
  qualify row_number() over (partition by txn_id order by batch_id desc) = 1
)"""
EVERYTHING = (*MEMBERS, REDEMPTION_FEED, FLATTENED, REDEMPTIONS, CURATED)


def _with(ctes: tuple[str, ...], select: str) -> str:
    return f"with {', '.join(ctes)}\n{select}"


FILES = f"""
files as (
  select batch_id, k // {CUSTOMERS_PER_FILE} as file_no, k * 4 + v as place, raw_record from member_feed
  union all
  select distinct batch_id, k // {CUSTOMERS_PER_FILE}, -1, '{HEADER}' from member_feed
)"""
REDELIVERED = f"""
kept as (
  select count(*) as n, count(*) filter (where raw_record = upper(raw_record)) as capitals, coalesce(max(line_no), 0) as last_line
  from (select *, row_number() over (partition by file_no order by place) as line_no from files where batch_id = '{FIRST}' and file_no > 0) f),
first_file as (
  select count(*) - 1 as d, count(*) filter (where raw_record = upper(raw_record)) as old_capitals
  from files where batch_id = '{FIRST}' and file_no = 0)"""
TXN = "txn_id, member_id, feed_date, txn_date, partner, miles_redeemed, status"


def _verdict(name: str, violations: str) -> str:
    return f"""select '{name}' as check_name, case when count(*) = 0 then 'PASS' else 'FAIL' end as status,
  cast(count(*) as bigint) as violations from ({violations}) x"""


def _ends_in(*digits: int) -> str:
    return f"coalesce(try_cast(member_id as bigint) % 10 in ({', '.join(map(str, digits))}), false)"


DUPLICATE_MEMBERS = "select member_id from current_members group by member_id having count(*) > 1"
MISROUTED = f"""select member_id from current_members where country in ({DOMAIN}) group by member_id having count(*) <> 1
  union select member_id from current_members where country is null or country not in ({DOMAIN})"""
OUTDATED = """select c.member_id from current_members c
  where c.batch_id <> (select max(batch_id) from clean s where s.member_id = c.member_id)"""
STILL_THERE = """select d.member_id from daily d join current_members c using (member_id)
  where d.country <> c.country and exists (
    select 1 from current_members r where r.member_id = d.member_id and r.country = d.country)"""
DUPLICATE_TXNS = "select txn_id from curated group by txn_id having count(*) > 1"
UNKNOWN_ACCEPTED = """select txn_id from redemptions r
  where is_valid and not exists (select 1 from current_members m where m.member_id = r.member_id)"""
RECONCILED = """
  select f.batch_id, cast(f.n as bigint) as flattened, cast(r.accepted as bigint) as accepted,
         cast(r.quarantined as bigint) as quarantined, cast(r.lost as bigint) as accepted_not_curated
  from (select batch_id, count(*) as n from flattened group by batch_id) f
  join (select batch_id, count(*) filter (where is_valid) as accepted, count(*) filter (where not is_valid) as quarantined,
               count(*) filter (where is_valid and txn_id not in (select txn_id from curated)) as lost
        from redemptions group by batch_id) r on r.batch_id = f.batch_id"""
UNRECONCILED = f"select * from ({RECONCILED}) z where flattened <> accepted + quarantined or accepted_not_curated <> 0"
REPEATED_REJECTS = """select 1 from redemptions where not is_valid
  group by batch_id, source_row_number, pos having count(*) > 1"""
REPEATED = f"{DUPLICATE_TXNS.replace('select txn_id', 'select 1', 1)} union all {REPEATED_REJECTS}"

FIRST_DAY_ROWS = {
    "dq_quarantine": f"""select count(*) filter (where not is_valid)
      + (select sum(key_rows) from clashes where batch_id = '{FIRST}') as n from judged where batch_id = '{FIRST}'""",
    "member_country": f"select count(*) as n from daily where batch_id = '{FIRST}' and country in ({DOMAIN})",
    "member_current": f"select count(*) as n from daily where batch_id = '{FIRST}'",
    "member_staging": f"select count(*) as n from staged where batch_id = '{FIRST}'",
    "raw_member": f"""select count(*) + (select count(distinct k // {CUSTOMERS_PER_FILE}) from member_feed) as n
      from member_feed where batch_id = '{FIRST}'""",
    "redemption": f"select count(*) as n from redemptions where batch_id = '{FIRST}' and is_valid",
    "redemption_quarantine": f"select count(*) as n from redemptions where batch_id = '{FIRST}' and not is_valid",
    "redemption_staging": f"select count(*) as n from flattened where batch_id = '{FIRST}'",
}

CURRENT_COLUMNS = f"member_id, {ATTRIBUTES}, batch_id, source_row_number"
ROW = "batch_id, source_row_number"
CURRENT_SELECT = f"select {CURRENT_COLUMNS} from current_members"

ORACLE: dict[str, str] = {
    "raw_member_ingest": _with(
        (MEMBER_FEED, FILES),
        """select batch_id, file_no, row_number() over (partition by batch_id, file_no order by place) as source_row_number,
  split_part(raw_record, '|', 2) as record_type, raw_record, cast(strptime(batch_id, '%Y%m%d') as date) as feed_date
  from files""",
    ),
    "raw_redemption_ingest": _with(
        (REDEMPTION_FEED,),
        f"""select batch_id, file_no, row_number() over (partition by batch_id, file_no order by o_orderkey) as source_row_number,
  raw_text, raw_text::json->>'member_id' as member_id
  from (select *, o_orderkey // {ORDERS_PER_FILE} as file_no from redemption_feed) f""",
    ),
    "incremental_ingest": _with(
        (MEMBER_FEED, FILES),
        f"""select cast(case batch_id when '{FIRST}' then 1 else 3 end as integer) as call_no, count(*) as row_count
  from files group by batch_id union all select 2, 0""",
    ),
    "redelivered_file": _with(
        (MEMBER_FEED, FILES, REDELIVERED),
        """select 1 as call_no, 'LOADED' as status, n + d + 1 as lines_loaded, 0::bigint as files_replaced,
  n + d + 1 as visible_lines, capitals + old_capitals as in_capitals, greatest(last_line, d + 1) as last_line from kept, first_file
  union all
  select 2, 'SKIPPED', 0, 0, n + d + 1, capitals + old_capitals, greatest(last_line, d + 1) from kept, first_file
  union all
  select 3, 'LOADED', 2 * d + 1, 1, n + 2 * d + 1, capitals + 2 * d + 1, greatest(last_line, 2 * d + 1) from kept, first_file
  union all
  select 4, 'LOADED', 0, 1, n, capitals, nullif(last_line, 0) from kept, first_file""",
    ),
    "pattern_ingest": _with(
        (MEMBER_FEED, FILES),
        f"""select batch_id, file_no, count(*) as row_count from files
  where batch_id = '{FIRST}' and file_no % 2 = 0 group by batch_id, file_no""",
    ),
    "array_ingest": _with(
        (REDEMPTION_FEED,),
        f"""select o_orderkey // {ORDERS_PER_FILE} as file_no,
  row_number() over (partition by o_orderkey // {ORDERS_PER_FILE} order by o_orderkey) as source_row_number,
  true as is_array, raw_text::json->>'member_id' as member_id from redemption_feed where batch_id = '{FIRST}'""",
    ),
    "malformed_ingest": _with(
        (REDEMPTION_FEED,),
        f"""select '{FIRST}' as batch_id, 0::bigint as visible_lines
  union all select '{SECOND}', count(*) from redemption_feed where batch_id = '{SECOND}'""",
    ),
    "ingest_summary": _with(
        (MEMBER_FEED, FILES), "select batch_id, file_no, count(*) as row_count from files group by batch_id, file_no"
    ),
    "contract_check": _with(
        (MEMBER_FEED,),
        f"""select batch_id, file_no, violation from (
    select batch_id, file_no, case
        when len(string_split(header, '|')) <> 12 then 'HEADER_FIELD_COUNT'
        when split_part(header, '|', 2) <> 'H' then 'HEADER_RECORD_TYPE'
        when header <> '{HEADER}' then 'HEADER_NAMES' end as violation
    from (
      select batch_id, file_no, case (file_no + case batch_id when '{FIRST}' then 0 else 2 end) % 4
        {' '.join(f"when {index} then '{text}'" for index, text in enumerate(HEADER_VARIANTS))} end as header
      from (select distinct batch_id, k // {CUSTOMERS_PER_FILE} as file_no from member_feed) n) h) c
  where violation is not null""",
    ),
    "member_parse": _with(
        (MEMBER_FEED, PARSED),
        f"""select {ROW}, record_type, source_field_count, member_name, member_id, enrollment_date, last_flight_date, tier_code,
  agent_name, state, country, dob, is_active, enrollment_date_raw, last_flight_date_raw, dob_raw from parsed""",
    ),
    "member_dq": _with(MEMBERS[:3], f"select {ROW}, source_field_count, dq_reason, is_valid from judged"),
    "member_dq_reason_counts": _with(
        MEMBERS[:3],
        """select reason, count(*) as hits
  from (select unnest(string_split(dq_reason, '; ')) as reason from judged where dq_reason is not null) r group by reason""",
    ),
    "member_staging": _with(MEMBERS[:4], f"select {ROW}, source_file_name, member_id, {ATTRIBUTES} from staged"),
    "member_quarantine": _with(
        MEMBERS[:5],
        f"""select {ROW}, raw_record, dq_reason from judged where not is_valid
  union all
  select s.batch_id, s.source_row_number, s.raw_record, 'MEMBER_ID_SAME_VERSION_CONFLICT'
  from staged s join clashes c on c.batch_id = s.batch_id and c.member_id = s.member_id""",
    ),
    "member_conflicts": _with(
        MEMBERS[:5],
        "select member_id, cast(strptime(batch_id, '%Y%m%d') as date) as version_date, key_rows from clashes",
    ),
    "member_latest": _with(MEMBERS, CURRENT_SELECT),
    "member_current_merge": _with(MEMBERS, CURRENT_SELECT),
    "member_current_late": _with(MEMBERS, CURRENT_SELECT),
    "member_current_rerun": _with(MEMBERS, CURRENT_SELECT),
    "member_reconcile": _with(
        MEMBERS[:5],
        """select d.batch_id, d.delivered, d.delivered - j.details as other_lines, j.accepted, j.rejected, c.conflicting
  from (select batch_id, count(*) as delivered from member_feed group by batch_id) d
  join (select batch_id, count(*) as details, count(*) filter (where is_valid) as accepted,
               count(*) filter (where not is_valid) as rejected from judged group by batch_id) j on j.batch_id = d.batch_id
  join (select batch_id, cast(sum(key_rows) as bigint) as conflicting from clashes group by batch_id) c
    on c.batch_id = d.batch_id""",
    ),
    "country_projection": _with(
        MEMBERS, f"select country, member_id, batch_id, state, age from current_members where country in ({DOMAIN})"
    ),
    "country_movement": _with(
        MEMBERS,
        f"""select a.member_id, a.country as from_country, c.country as to_country
  from (select * from daily where batch_id = '{FIRST}') a join current_members c on c.member_id = a.member_id
  where a.country <> c.country""",
    ),
    "redemption_flatten": _with((REDEMPTION_FEED, FLATTENED), f"select {ROW}, pos, {TXN} from flattened"),
    "redemption_dq": _with(EVERYTHING, f"select {ROW}, pos, dq_reason, is_valid from redemptions"),
    "redemption_quarantine": _with(
        EVERYTHING,
        f"""select {ROW}, pos, txn_id, member_id, txn_date, partner, miles_redeemed, status, dq_reason
  from redemptions where not is_valid""",
    ),
    "redemption_curated_merge": _with(EVERYTHING, f"select {TXN}, {ROW} from curated"),
    "redemption_reconcile": _with(EVERYTHING, RECONCILED),
    "check_member_unique": _with(MEMBERS, _verdict("member_unique", DUPLICATE_MEMBERS)),
    "check_country_routing": _with(MEMBERS, _verdict("country_routing", MISROUTED)),
    "check_latest_wins": _with(MEMBERS, _verdict("latest_wins", OUTDATED)),
    "check_txn_unique": _with(EVERYTHING, _verdict("txn_unique", DUPLICATE_TXNS)),
    "check_member_unique_found": _with(
        MEMBERS, _verdict("member_unique", f"select member_id from current_members where {_ends_in(3)}")
    ),
    "check_country_routing_found": _with(
        MEMBERS,
        _verdict(
            "country_routing",
            f"select member_id from current_members where country in ({DOMAIN}) and {_ends_in(3, 4)} union {MISROUTED}",
        ),
    ),
    "check_latest_wins_found": _with(
        MEMBERS, _verdict("latest_wins", f"select member_id from current_members where {_ends_in(3, 4)}")
    ),
    "check_txn_unique_found": _with(
        EVERYTHING, _verdict("txn_unique", "select txn_id from curated where txn_id like '%3-0'")
    ),
    "check_reconcile_found": _with(
        EVERYTHING, RECONCILED.replace("from curated)", "from curated where txn_id not like '%3-0')")
    ),
    "check_country_movement_found": _with(
        MEMBERS,
        _verdict(
            "country_movement",
            f"""select a.member_id from daily a join current_members c on c.member_id = a.member_id
  where a.batch_id = '{FIRST}' and a.country <> c.country and a.country in ({DOMAIN}) and c.country in ({DOMAIN})
    and {_ends_in(3, 4).replace('member_id', 'a.member_id')}""",
        ),
    ),
    "check_unknown_member_found": _with(
        EVERYTHING,
        _verdict(
            "unknown_member_quarantined", f"select distinct member_id from redemptions where is_valid and {_ends_in(3)}"
        ),
    ),
    "check_idempotent_found": _with(
        EVERYTHING,
        _verdict(
            "idempotent",
            """select txn_id from curated where txn_id like '%3-0'
  union all select txn_id from redemptions where not is_valid and pos = 0""",
        ),
    ),
    "check_idempotent": _with(
        EVERYTHING,
        "\nunion all\n".join(
            f"select '{name}' as table_name, cast(n as bigint) as rows_after_run, cast(n as bigint) as rows_after_rerun from ({sql}) t"
            for name, sql in FIRST_DAY_ROWS.items()
        ),
    ),
    "check_suite": _with(
        EVERYTHING,
        "\nunion all\n".join(
            (
                _verdict("member_unique", DUPLICATE_MEMBERS),
                _verdict("country_routing", MISROUTED),
                _verdict("latest_wins", OUTDATED),
                _verdict("country_movement", STILL_THERE),
                _verdict("txn_unique", DUPLICATE_TXNS),
                _verdict("unknown_member_quarantined", UNKNOWN_ACCEPTED),
                _verdict("redemption_reconcile", UNRECONCILED),
                _verdict("idempotent", REPEATED),
            )
        ),
    ),
    "batch_ledger": _with(
        EVERYTHING,
        """select m.batch_id, 'PIPELINE' as feed_type, 'SUCCESS' as status, m.accepted + r.accepted as rows_loaded,
  m.rejected + c.conflicting + r.rejected as rows_rejected, cast(null as varchar) as error_message
  from (select batch_id, count(*) filter (where is_valid) as accepted, count(*) filter (where not is_valid) as rejected
        from judged group by batch_id) m
  join (select batch_id, cast(sum(key_rows) as bigint) as conflicting from clashes group by batch_id) c
    on c.batch_id = m.batch_id
  join (select batch_id, count(*) filter (where is_valid) as accepted, count(*) filter (where not is_valid) as rejected
        from redemptions group by batch_id) r on r.batch_id = m.batch_id""",
    ),
    "daily_member_current": _with(
        MEMBERS,
        f"""select member_id, {ATTRIBUTES}, batch_id, ((source_row_number - 2) // 4) // {CUSTOMERS_PER_FILE} as file_no
  from current_members""",
    ),
    "daily_member_countries": _with(
        MEMBERS, f"select country, member_id, batch_id, state, age from current_members where country in ({DOMAIN})"
    ),
    "daily_redemption": _with(EVERYTHING, f"select {TXN}, batch_id from curated"),
    "daily_views": _with(
        MEMBERS,
        f"""select d.country, count(c.member_id) as members
  from (select unnest([{DOMAIN}]) as country) d left join current_members c on c.country = d.country group by d.country
  union all select 'ALL', count(*) from current_members""",
    ),
    "daily_audit": _with(
        MEMBERS,
        f"""select c.member_id, c.batch_id = '{SECOND}' and exists (
    select 1 from daily d where d.member_id = c.member_id and d.batch_id = '{FIRST}') as updated_later, true as loaded_before_now
  from current_members c""",
    ),
    "failed_batches": f"""select batch_id, 'FAILED' as status, batch_id = '{FIRST}' as names_header, true as completed,
  cast(null as bigint) as rows_loaded, cast(null as bigint) as visible_lines, 0::bigint as members
  from (select unnest(['{FIRST}', '{SECOND}']) as batch_id) b where exists (select 1 from customer)""",
    "events_props_extract": "select event_id, try_cast(props::json->>'k' as integer) as k from events",
    "orders_latest_per_customer": """select o_custkey, o_orderkey, o_orderstatus, o_totalprice from orders
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
    "events_upsert_by_user": """select user_id, event_id, event_type, value from events
  qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "orders_known_customers": """select o_orderkey, o_custkey, count(*) over (partition by o_custkey) as customer_orders,
  o_custkey is not null and exists (select 1 from customer c where c.c_custkey = o.o_custkey and c.c_acctbal > 0) as in_credit
  from orders o""",
}
