"""The pipeline's stages, each on its own input, against brute force."""

import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from feedlake.llm import byte_bpe, queries
from test_near_duplicates import brute_near
from test_texts import LIBRARY, brute_hits

SF_DIR = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, score double, hit string, c0 int, node string"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "tokens"]


def test_quality_keeps_what_scores_well(spark, documents):
    kept = corpus_pipeline.quality(spark, documents, SF_DIR)
    judged = queries.op3_line_crf(spark, SF_DIR)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in judged.where("predicted = 1").collect()}


def test_one_of_each_group_stays(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    kept = corpus_pipeline.near_duplicates(spark, documents, SF_DIR)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(doc for doc, (_, _, stays) in brute_near(rows, 5).items() if stays)


def test_contaminated_documents_go(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = corpus_pipeline.decontamination(spark, documents, SF_DIR)
    want = {r.doc_id for r in documents.collect() if not brute_hits(r.text, items, 10)[1]}
    assert kept.columns == documents.columns and {r.doc_id for r in kept.collect()} == want
    assert len(want) < documents.count()


def test_items_of_few_words_count_as_a_whole(spark, tmp_path):
    spark.createDataFrame([(1, "seldom met"), (2, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["was Seldom met there", "seldom was met", "met seldom", " ".join(f"w{i}" for i in range(9)), " ".join(f"w{i}" for i in range(1, 11)), ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()} == {1, 2, 3, 5}


def test_personal_data_and_tokens(spark, documents):
    clean = corpus_pipeline.personal_data(spark, documents, SF_DIR)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert clean.columns == documents.columns and len(texts) == documents.count()
    assert not any("@" in text for text in texts.values()) and any("<EMAIL>" in text for text in texts.values())
    assert clean.where("n_chars <> length(text)").count() == 0
    for r in corpus_pipeline.tokens(spark, clean, SF_DIR).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows_pass_every_stage(spark, documents):
    rng = random.Random(1)
    row = lambda doc, text: (doc, text, None, "src", None if text is None else len(text), 0.1, "x", 5, "n")
    plain = " ".join(rng.choice(["thonor", "tione", "of", "the", "and", "estan"]) for _ in range(80)) + "."
    rows = [row(None, plain), row(7, plain), row(7, plain), row(9, plain), row(1, None), row(2, ""), row(3, "x" * 50000), row(3, "y z")]
    docs = spark.createDataFrame(rows, EXTRA)
    once = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert sorted((str(r.doc_id), (r.text or "")[:3]) for r in once.collect()) == sorted([("None", plain[:3]), ("7", plain[:3]), ("1", ""), ("2", ""), ("3", "xxx"), ("3", "y z")])
    for name, stage in corpus_pipeline.STAGES[2:4]:
        made = stage(spark, docs, SF_DIR)
        assert made.dtypes == docs.dtypes and made.count() == len(rows), name
    assert corpus_pipeline.quality(spark, docs, SF_DIR).dtypes == docs.dtypes
    told = corpus_pipeline.tokens(spark, docs.withColumnsRenamed({"hit": "ids", "node": "decoded"}), SF_DIR)
    assert told.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "c0", "decoded", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r.text), r.decoded, r.n_tokens == len(r.ids)) for r in told.collect()) == sorted((str(r[1]), "n", True) for r in rows)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).collect() == [], name


def test_run_puts_the_stages_together(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert 0 < got.count() <= 200 and got.select("doc_id").distinct().count() == got.count()
    first = got.first()
    decoded = byte_bpe.Encoder(queries.RANKS).decode(first.ids)
    assert hashlib.sha256(decoded).hexdigest() == first.decoded_sha256
    assert first.ids_sha256 == hashlib.sha256(" ".join(map(str, first.ids)).encode()).hexdigest()
    assert np.all(np.array(first.ids) >= 0)
