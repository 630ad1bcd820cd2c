"""From documents to token ids, in five stages over `documents`.

quality: documents that the line-wise classifier rejects go. near_duplicates: of each group of near-duplicates (five-word shingles,
similarity 0.8 or more) the document with the smallest id stays. decontamination: documents with ten consecutive words
of a benchmark item go, and those with all words of an item that has fewer than ten, one after another. personal_data: personal data is replaced by marks such as <EMAIL>. tokens: every text is
encoded, and decoded again as a check. The last stage adds its results to the columns of the documents; a column
that is named like a result gives way to it.

Each stage reads all that its predecessor kept and is written as Parquet before the next begins. Further columns pass
through unchanged, whatever their names. Null and empty texts are judged like any text without words: the quality stage scores them,
nothing links them, and they have no tokens. Rows without an id are never dropped as duplicates; of rows that repeat an id and a text
one stays. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import bbit_minhash, byte_bpe, labelled, line_crf, pii_votes, wu_manber
from feedlake.llm.queries import RANKS
from feedlake.llm.tables import read, written

#: Score from which a document's quality is good enough.
QUALITY = 0.3
#: Numbers of documents up to which they are broadcast, 8 bytes each.
BROADCAST_IDS = 1 << 20


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[str], str]:
    """The documents with numbered columns, so that no name can clash with an operator's; the names, and the text's."""
    names = [f"c{number}" for number in range(len(docs.columns))]
    return docs.toDF(*names), names, names[docs.columns.index("text")]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are good enough; labels of held-out documents are not learned from."""
    model = line_crf.fit(docs, read(spark, sf_dir, "labels"), labelled.remainder("doc_id", 5) != 0)
    own, names, text = _numbered(docs)
    scored = line_crf.score(own, model, names, text=text)
    return scored.where(F.col("score") >= QUALITY).select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    judged = written(bbit_minhash.near_duplicates(docs.select("doc_id", "text")), "judged")
    by_id = judged.where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone = _checked(written(by_id.where("not kept").select("doc_id"), "gone"))
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = written(by_id.where("kept and n > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return left
    repeated = _checked(repeated)
    once = left.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return left.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def _checked(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item: ten words, or the whole item if it has fewer."""
    own, names, text = _numbered(docs)
    found = wu_manber.search(own, read(spark, sf_dir, "benchmark"), names, text=text)
    return found.where(F.size("hit") == 0).select(*names).toDF(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars follows the text."""
    clean = pii_votes.redact(docs, pii_votes.fit(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, the number of these, and digests of the ids and of the text that they decode to."""
    own, names, text = _numbered(docs)
    both_ways = byte_bpe.encode(own, RANKS, names, text=text, decoded=True)
    results = {
        "n_tokens": F.size("ids").cast("long"), "ids": F.col("ids"), "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    }
    kept = [F.col(own_name).alias(name) for own_name, name in zip(names, docs.columns) if name not in results]
    return both_ways.select(*kept, *(value.alias(name) for name, value in results.items()))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Trained scores and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
