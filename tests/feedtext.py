"""Small literal feeds for tests."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import functions as F

HEADER = "|H|Member_Name|Member_Id|Enrollment_Date|Last_Flight_Date|Tier_Code|Agent_Name|State|Country|DOB|Is_Active"


def line(name="Ann", member="1", enrolled="20100115", flight="20260901", tier="GOLD", agent="Bo", state="NY",
         country="USA", dob="03051985", active="A", kind="D", more=""):
    return f"|{kind}|{name}|{member}|{enrolled}|{flight}|{tier}|{agent}|{state}|{country}|{dob}|{active}{more}"


def raw(spark, lines, batch_id="20260926", file="member/20260926/member_profile_feed.csv"):
    rows = [(text, batch_id, file, number) for number, text in enumerate(lines, start=2)]
    frame = spark.createDataFrame(
        rows, "raw_record string, batch_id string, source_file_name string, source_row_number long"
    )
    return frame.selectExpr(
        "split_part(raw_record, '|', 2) as record_type",
        "*",
        "to_date(batch_id, 'yyyyMMdd')::timestamp_ntz as source_feed_timestamp",
        "localtimestamp() as ingestion_timestamp",
    )


def raw_json(spark, documents, batch_id="20260926", file="redemption/20260926/member_redemptions.json"):
    texts = [text if isinstance(text, str) else json.dumps(text) for text in documents]
    rows = [(text, batch_id, file, number) for number, text in enumerate(texts, start=1)]
    frame = spark.createDataFrame(rows, "raw_text string, batch_id string, source_file_name string, source_row_number long")
    return frame.withColumns(
        {"raw_record": F.parse_json("raw_text"), "ingestion_timestamp": F.localtimestamp()}
    )


def txn(txn_id="T1", date="20260901", partner="Hotel", miles=100, status="COMPLETED"):
    return {"txn_id": txn_id, "txn_date": date, "partner": partner, "miles_redeemed": miles, "status": status}


def document(member="1", feed_date="20260926", redemptions=()):
    return {"member_id": member, "feed_date": feed_date, "redemptions": list(redemptions)}


def deliver(landing, batch_id, members=None, documents=None, header=HEADER, file="member_profile_feed.csv"):
    """Write files as they would be delivered for one day."""
    if members is not None:
        folder = Path(landing) / "member" / batch_id
        folder.mkdir(parents=True, exist_ok=True)
        (folder / file).write_text("\n".join([header, *members]) + "\n")
    if documents is not None:
        folder = Path(landing) / "redemption" / batch_id
        folder.mkdir(parents=True, exist_ok=True)
        texts = [text if isinstance(text, str) else json.dumps(text) for text in documents]
        (folder / "member_redemptions.json").write_text("\n".join(texts) + "\n")
