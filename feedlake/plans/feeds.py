"""The two feeds derived from the test tables, as frames and as files.

Customers become member lines, orders become redemption documents. The texts are
SQL expressions that Spark and other engines read alike, so the same feed can be
built on both sides of a comparison. Two days are delivered. On the second day
members in credit are delivered again, many in another country, and orders that
were not finished are delivered again, open ones now completed. The texts hold
every kind of defect that the rules name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.dates import batch_date
from feedlake.functions.text import record_type
from feedlake.schemas import MEMBER_CONTRACT, FeedSource
from feedlake.sources.landing import delivered_files
from feedlake.sources.scratch import empty_file, materialise, new_folder, replace_file, small_frame

BATCHES = ("20260926", "20260927")
FILE_SOURCES = {
    "member": FeedSource("member", r".*\.txt"),
    "redemption": FeedSource("redemption", r".*\.txt"),
}
CUSTOMERS_PER_FILE = 1_000
ORDERS_PER_FILE = 10_000

# Who is delivered again on the second day, and whose lines are repeated within a day.
MEMBER_AGAIN = "c_acctbal > 0"
MEMBER_CONTRADICTED = "k % 29 = 3"
MEMBER_COPIED = "k % 31 = 4"
# k: customer key, b: day, v: 0 the line itself, 1 a contradicting line, 2 an exact copy.
MEMBER_LINE = """
'|' || case when k % 211 = 10 then 'X' else 'D' end
|| '|' || case when k % 97 = 5 then '' when k % 101 = 7 then repeat('N', 256) else c_name end
|| '|' || case when k % 89 = 3 then ' ' when k % 103 = 9 then cast(k as string) || repeat('0', 18) else cast(k as string) end
|| '|' || case when k % 37 = 1 then '' when k % 41 = 2 then '20200230'
    else '20' || lpad(cast(10 + k % 15 as string), 2, '0') || lpad(cast(1 + k % 12 as string), 2, '0')
         || lpad(cast(1 + k % 28 as string), 2, '0') end
|| '|' || case when k % 11 = 0 then '' when k % 43 = 4 then '2026-01-01'
    else '2026' || lpad(cast(1 + k % 9 as string), 2, '0') || lpad(cast(1 + (k * 5) % 28 as string), 2, '0') end
|| '|' || case when k % 53 = 0 then 'PLATINUM' when k % 7 = 0 then '' else 'GOLD' end
|| '|' || case when k % 107 = 12 then repeat('A', 256) else ' Agent ' || c_mktsegment || ' ' end
|| '|' || case when v = 1 then 'ZZ' when k % 83 = 11 then 'STATEXX' else 'S' || cast(k % 50 as string) end
|| '|' || case (k + b) % 16 when 0 then 'USA' when 1 then 'IND' when 2 then 'PHIL' when 3 then 'CAN' when 4 then 'AU'
    when 5 then 'CHN' when 6 then 'BRA' when 7 then 'GBR' when 8 then 'JPN' when 9 then 'ARE'
    when 10 then 'FRA' when 11 then 'DEU' when 12 then 'SGP' when 13 then '' when 14 then 'NZLAND' else 'usa' end
|| '|' || case when k % 13 = 0 then '' when k % 47 = 6 then '31021980' when k % 59 = 1 then '29022000'
    else lpad(cast(1 + k % 28 as string), 2, '0') || lpad(cast(1 + k % 12 as string), 2, '0') || cast(1950 + k % 50 as string) end
|| '|' || case when k % 61 = 0 then '' when k % 67 = 0 then 'X' when k % 5 = 0 then 'I' else 'A' end
|| case when k % 71 = 8 then '|EXTRA' else '' end
"""

# Headers of the files for the contract check: right, a wrong name, a field too many, a detail line first.
HEADER = "|H|" + "|".join(MEMBER_CONTRACT.header)
HEADER_VARIANTS = (HEADER, HEADER.replace("Tier_Code", "tier_code"), HEADER + "|Post_Code", HEADER.replace("|H|", "|D|"))

REDEMPTION_AGAIN = "o_orderstatus <> 'F'"


def _transaction(place: int) -> str:
    return f"""
'{{"txn_id":' || case when o_orderkey % 83 = 5 then 'null'
    when o_orderkey % 79 = 6 then '"RXDUP' || cast(o_orderkey % 5 as string) || '"'
    else '"RX' || cast(o_orderkey as string) || '-{place}"' end
|| ',"txn_date":' || case when o_orderkey % 73 = {place} then '"20269999"'
    else '"2026' || lpad(cast(1 + o_orderkey % 9 as string), 2, '0') || lpad(cast(1 + o_orderkey % 28 as string), 2, '0') || '"' end
|| ',"partner":' || case when o_orderkey % 69 = {place} then 'null' else '"' || o_orderpriority || '"' end
|| ',"miles_redeemed":' || case when o_orderkey % 57 = 3 then '-5' when o_orderkey % 57 = 4 then '"abc"'
    when o_orderkey % 57 = 5 then '100.6' else cast(o_orderkey % 1000 as string) end
|| ',"status":"' || case when o_orderstatus = 'F' or (o_orderstatus = 'O' and b = 20260927) then 'COMPLETED'
    when o_orderstatus = 'O' then 'PENDING' when o_orderstatus = 'P' then 'CANCELLED' else 'X' end
|| case when o_orderkey % 77 = 1 then '?' else '' end || '"}}'
"""


REDEMPTION_DOCUMENT = f"""
'{{"member_id":' || case when o_orderkey % 91 = 2 then 'null' when o_orderkey % 87 = 7 then '"NOPE"'
    else '"' || cast(o_custkey as string) || '"' end
|| ',"feed_date":"' || case when o_orderkey % 95 = 4 then 'bad' else cast(b as string) end || '","redemptions":['
|| case when o_orderkey % 17 = 0 then ''
    else {_transaction(0)} || case when o_orderkey % 4 = 0 then ',' || {_transaction(1)} else '' end end
|| ']}}'
"""

_feeds: dict[tuple, DataFrame] = {}


def state(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Names, sizes and times of a table's files, by which a change is noticed."""
    files = delivered_files(spark, f"{sf_dir}/{name}.parquet", ".*")
    return tuple(sorted(files.select("file_path", "file_size", F.unix_micros("file_modified")).collect()))


def _once(spark: SparkSession, sf_dir: str, name: str, source: str, key: str, build, text: str) -> DataFrame:
    """A feed is input: it is written once per application and state of its source's files, and read from there.

    A table that is one small file would make the feed one file too, which a
    single task then reads; its rows are spread over the cores, before any text is made of them.
    """
    place = (spark.sparkContext.applicationId, name, state(spark, sf_dir, source))
    if place not in _feeds:
        spread = build(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, key)
        _feeds[place] = materialise(_with_text(spread, text), f"feed-{name}")
    return _feeds[place]


def _with_text(rows: DataFrame, name: str) -> DataFrame:
    """The batch and the keys of a feed's rows, and the text that they are delivered as."""
    made, *keys = {"raw_record": (MEMBER_LINE, "k", "v"), "raw_text": (REDEMPTION_DOCUMENT, "o_orderkey")}[name]
    return rows.select(F.col("b").cast("string").alias("batch_id"), *keys, F.expr(made).alias(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days(df: DataFrame, again: str) -> DataFrame:
    first, second = (F.lit(int(day)) for day in BATCHES)
    return df.withColumn("b", F.explode(F.when(F.expr(again), F.array(first, second)).otherwise(F.array(first))))


def _member_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the member lines are made of, a row for each."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), "c_name", "c_mktsegment", "c_acctbal"
    )
    variants = F.array(F.lit(0), F.when(F.expr(MEMBER_CONTRADICTED), 1), F.when(F.expr(MEMBER_COPIED), 2))
    return _days(customers, MEMBER_AGAIN).withColumn("v", F.explode(F.array_compact(variants)))


def _redemption_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the redemption documents are made of, a row for each."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return _days(orders, REDEMPTION_AGAIN)


def member_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "member", "customer", "k", _member_rows, "raw_record")


def redemption_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "redemption", "orders", "o_orderkey", _redemption_rows, "raw_text")


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "source_feed_timestamp": batch_date(F.col("batch_id")).cast("timestamp_ntz"),
            "ingestion_timestamp": F.localtimestamp(),
        }
    )


def raw_member_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The member feed in the shape of the raw table, as if each day were one file."""
    lines = member_lines(spark, sf_dir)
    return _stamped(
        lines.select(
            record_type(F.col("raw_record")).alias("record_type"),
            "raw_record",
            "batch_id",
            F.concat(F.lit("member/"), "batch_id", F.lit("/member_profile_feed.csv")).alias("source_file_name"),
            (F.col("k") * 4 + F.col("v") + 2).alias("source_row_number"),
        )
    )


def raw_redemption_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The redemption feed in the shape of the raw table, as if each day were one file."""
    documents = redemption_documents(spark, sf_dir)
    return _stamped(
        documents.select(
            "raw_text",
            F.parse_json("raw_text").alias("raw_record"),
            "batch_id",
            F.concat(F.lit("redemption/"), "batch_id", F.lit("/member_redemptions.json")).alias("source_file_name"),
            (F.col("o_orderkey") + 1).alias("source_row_number"),
        )
    )


def _write_files(rows: DataFrame, text: Column, folder: str, batch_id: str) -> None:
    """Write `text` by `file_no` and `place`: one file per file number, lines in order of place.

    The text is made of the rows when they are in their places, so that only what it is made of is shuffled.
    """
    (
        rows.repartition("file_no")
        .sortWithinPartitions("file_no", "place")
        .select("file_no", text.alias("text"))
        .write.mode("append")
        .partitionBy("file_no")
        .text(f"{folder}/{batch_id}")
    )


def write_member_files(
    spark: SparkSession, sf_dir: str, landing: str, batch_id: str, header_variants: tuple[str, ...] = (HEADER,)
) -> None:
    """The member lines of a day as files of a thousand customers each, every one with a header line."""
    lines = _member_rows(spark, sf_dir).where(F.col("b") == int(batch_id))
    lines = lines.withColumn("file_no", F.expr(f"k div {CUSTOMERS_PER_FILE}"))
    day = BATCHES.index(batch_id)
    variant = ((F.col("file_no") + 2 * day) % len(header_variants) + 1).cast("int")
    headers = lines.select("file_no").distinct().select(
        "file_no",
        F.lit(-1).cast("long").alias("place"),
        F.element_at(F.array(*(F.lit(text) for text in header_variants)), variant).alias("header"),
    )
    details = lines.withColumn("place", F.col("k") * 4 + F.col("v"))
    rows = details.unionByName(headers, allowMissingColumns=True)
    text = F.when(F.col("place") == -1, F.col("header")).otherwise(F.expr(MEMBER_LINE))
    _write_files(rows, text, f"{landing}/member", batch_id)


def rewrite_first_member_file(spark: SparkSession, sf_dir: str, landing: str, batch_id: str) -> None:
    """Deliver the file of the smallest customers anew under its name: every line in capitals, and the details twice."""
    folder = f"{landing}/member/{batch_id}/file_no=0"
    name = delivered_files(spark, folder, ".*").first().file_path
    lines = member_lines(spark, sf_dir).where((F.col("batch_id") == batch_id) & F.expr(f"k div {CUSTOMERS_PER_FILE} = 0"))
    twice = lines.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"), "k", "v", F.upper("raw_record").alias("text"))
    header = small_frame(spark, [(0, -1, 0, HEADER.upper())], "copy int, k bigint, v int, text string")
    rows = header.unionByName(twice).coalesce(1).sortWithinPartitions("copy", "k", "v").select("text")
    anew = new_folder(spark, "anew")
    rows.write.text(anew)
    replace_file(spark, delivered_files(spark, anew, r".*/part-[^/]*").first().file_path, name)


def empty_first_member_file(spark: SparkSession, landing: str, batch_id: str) -> None:
    """Take everything out of the file of the smallest customers."""
    empty_file(spark, delivered_files(spark, f"{landing}/member/{batch_id}/file_no=0", ".*").first().file_path)


def write_redemption_files(spark: SparkSession, sf_dir: str, landing: str, batch_id: str, line: str = "%s") -> None:
    """The redemption documents of a day as files of ten thousand orders each, one document per line, put into `line`."""
    rows = _redemption_rows(spark, sf_dir).where(F.col("b") == int(batch_id)).withColumns(
        {"file_no": F.expr(f"o_orderkey div {ORDERS_PER_FILE}"), "place": F.col("o_orderkey")}
    )
    _write_files(rows, F.format_string(line, F.expr(REDEMPTION_DOCUMENT)), f"{landing}/redemption", batch_id)


def write_day(spark: SparkSession, sf_dir: str, landing: str, batch_id: str) -> None:
    write_member_files(spark, sf_dir, landing, batch_id)
    write_redemption_files(spark, sf_dir, landing, batch_id)


def new_landing(spark: SparkSession) -> str:
    return new_folder(spark, "delivered")
