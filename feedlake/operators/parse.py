"""Raw lines and documents to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.dates import strict_date
from feedlake.functions.documents import text_at, whole_number
from feedlake.functions.text import blank_to_null, pipe_parts
from feedlake.schemas import FeedContract


def parse_lines(raw: DataFrame, contract: FeedContract) -> DataFrame:
    """Typed fields of every detail line; lines of other types are left out.

    A date field appears twice, as `<name>_raw` text and as a date that is NULL
    when the text is no valid date, so that rules can tell absent from invalid.
    """
    details = (
        raw.withColumn("_parts", pipe_parts(F.col("raw_record")))
        .withColumn("record_type", F.coalesce(F.get("_parts", 1), F.lit("")))
        .where(F.col("record_type") == contract.record_type)
        .withColumn("source_field_count", F.size("_parts") - 2)
    )
    texts = {
        f"{field.name}_raw" if field.date_format else field.name: blank_to_null(F.get("_parts", index + 2))
        for index, field in enumerate(contract.fields)
    }
    dates = {
        field.name: strict_date(F.col(f"{field.name}_raw"), field.date_format)
        for field in contract.fields
        if field.date_format
    }
    return details.withColumns(texts).withColumns(dates).drop("_parts")


def flatten_redemptions(raw: DataFrame) -> DataFrame:
    """One row per element of `redemptions`, with its position in the document.

    Documents whose `redemptions` is absent, null, empty or a scalar give no
    row. An object in place of the array gives one row per value.
    """
    # Document-level values are taken out first, so that no row carries the document along.
    documents = raw.select(
        "batch_id",
        "source_file_name",
        "source_row_number",
        text_at(F.col("raw_record"), "$.member_id").alias("member_id"),
        strict_date(text_at(F.col("raw_record"), "$.feed_date"), "yyyyMMdd").alias("feed_date"),
        F.try_variant_get("raw_record", "$.redemptions", "variant").alias("redemptions"),
        "ingestion_timestamp",
    )
    elements = documents.lateralJoin(raw.sparkSession.tvf.variant_explode(F.col("redemptions").outer()))
    return elements.select(
        "batch_id",
        "source_file_name",
        "source_row_number",
        "pos",
        "member_id",
        "feed_date",
        text_at(F.col("value"), "$.txn_id").alias("txn_id"),
        strict_date(text_at(F.col("value"), "$.txn_date"), "yyyyMMdd").alias("txn_date"),
        text_at(F.col("value"), "$.partner").alias("partner"),
        whole_number(text_at(F.col("value"), "$.miles_redeemed")).alias("miles_redeemed"),
        text_at(F.col("value"), "$.status").alias("status"),
        "ingestion_timestamp",
    )
