"""The two classifiers: their algorithms against brute force, their accuracy on held-out documents."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import labelled, line_crf, queries, toxic_segments
from feedlake.llm.tables import written

# The smaller table has some 30 toxic documents to learn from in four languages, too few to ask much of a word model.
TABLES = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOCS = "doc_id long, text string"


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(2)
    lengths = np.array([1, 4, 2, 5, 1])
    unary, transition = rng.normal(size=lengths.sum()) * 3, rng.normal(size=(2, 2))
    marginal, expected, log_z = line_crf.forward_backward(unary, lengths, transition)
    start, pairs = 0, np.zeros((2, 2))
    for chain, n in enumerate(lengths):
        weights = {}
        for states in itertools.product((0, 1), repeat=int(n)):
            weights[states] = np.exp(sum(unary[start + i] * s for i, s in enumerate(states)) + sum(transition[a, b] for a, b in zip(states, states[1:])))
        total = sum(weights.values())
        assert np.isclose(log_z[chain], np.log(total))
        for i in range(n):
            assert np.isclose(marginal[start + i], sum(w for s, w in weights.items() if s[i]) / total)
        for states, weight in weights.items():
            for a, b in zip(states, states[1:]):
                pairs[a, b] += weight / total
        start += n
    assert np.allclose(expected, pairs)


def test_line_features_see_repeats_and_symbols():
    lines = [b"The quiet river runs.", b"no no no no no no", b"a$$$ b%%% c###", b"", b"The quiet river runs."]
    features, lengths = line_crf.line_features(b"\n".join(lines))
    assert lengths.tolist() == [len(line) for line in lines] and features.shape == (5, line_crf.N_FEATURES)
    assert features[1, 11] > 0.8 and features[0, 11] == 0  # words that repeat the one before
    assert features[4, 13] == 1 and features[0, 13] == 0  # a line seen before
    assert features[3, 14] == 1 and features[2, 15] == 1  # an empty line; many symbols
    one, _ = line_crf.line_features(b"")
    assert one.shape == (1, line_crf.N_FEATURES) and np.isfinite(one).all()


def brute_segments(values):
    """Maximal scoring segments by their definition: the best one, then those to its left and right."""
    if not values or max(values) <= 0:
        return []
    best = max(((sum(values[i:j]), -(j - i), i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)))
    _, _, i, j = best
    return brute_segments(values[:i]) + [(i, j)] + [(i2 + j, j2 + j) for i2, j2 in brute_segments(values[j:])]


@pytest.mark.parametrize("seed", range(30))
def test_maximal_segments(seed):
    rng = random.Random(seed)
    values = [rng.choice([-0.53, -0.53, -0.53, 1.0 + rng.random(), 0.2 + rng.random()]) for _ in range(24)]
    scoring = [(at, value) for at, value in enumerate(values) if value > 0]
    got = toxic_segments.maximal_segments(scoring, -0.53)
    assert [(start, end) for start, end, _ in got] == brute_segments(values)
    assert all(np.isclose(score, sum(values[start:end])) for start, end, score in got)


@pytest.mark.parametrize("name,label,sf_dir", [("op3_line_crf", "quality", TABLES[0]), ("op7_toxic_segments", "toxic", TABLES[1])])
def test_held_out_accuracy(spark, name, label, sf_dir):
    found = written(queries.QUERIES[name](spark, sf_dir), "judged")
    judged = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out")
    wrong = judged.agg(
        F.avg((F.col("predicted") != F.col(label)).cast("int")).alias("all"),
        F.avg(F.when(F.col(label) == 0, F.col("predicted"))).alias("taken_for_1"),
    ).first()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found.count() == documents.count() and found.where("score is null or score < 0 or score > 1").count() == 0
    assert wrong["all"] <= 0.03 and wrong["taken_for_1"] <= 0.02


def test_passages_are_found_and_clean_text_is_left(spark):
    rng = random.Random(6)
    words = [f"word{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(300)]
    rows, labels = [], []
    for n in range(300):
        own = [rng.choice(words) for _ in range(60)]
        if n % 6 == 0:
            own[20:20] = ["vileness", rng.choice(words), "vileness"]
        rows.append((n, " ".join(own)))
        labels.append((n, 1, int(n % 6 == 0)))
    rows += [(900, None), (901, ""), (902, "vileness vileness " * 3), (902, "vileness vileness " * 3)]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxic_segments.fit(docs, known, labelled.remainder("doc_id", 3) != 1)
    found = {r.doc_id: r for r in toxic_segments.score(docs, model, ["doc_id"]).collect()}
    assert all((found[n].score >= 0.7) == (n % 6 == 0) for n in range(300))
    passage = found[0].passages[0]
    assert (passage.start, passage.end) == (20, 23) and passage.expected < toxic_segments.SIGNIFICANT
    assert found[900].score == found[901].score < 0.3 and found[902].score > 0.9


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], DOCS + "")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    every = labelled.remainder("doc_id", 5) >= 0
    for operator in (line_crf, toxic_segments):
        model = operator.fit(docs, none, every)
        assert model is None
        assert {r.doc_id: r.score for r in operator.score(docs, model, ["doc_id"]).collect()} == {1: 0.5, 2: 0.5}
        assert operator.score(docs.limit(0), model, ["doc_id"]).collect() == []


def test_sample_is_bounded_and_ignores_odd_labels(spark):
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(50)] + [(None, "x")], DOCS)
    known = spark.createDataFrame([(n, n % 2) for n in range(50)] + [(3, 0), (3, 1), (4, None), (5, 7), (None, 1)], "doc_id long, quality int")
    every = labelled.remainder("doc_id", 5) != 0
    got = labelled.sample(docs, known, "quality", every, 10, "few").collect()
    assert len(got) == len({r.doc_id for r in got}) == 10
    whole = {r.doc_id: r.label for r in labelled.sample(docs, known, "quality", every, 1000, "all").collect()}
    assert whole[3] == 1 and whole[4] == 0 and None not in whole
