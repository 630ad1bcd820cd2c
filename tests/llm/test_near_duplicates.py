"""Near-duplicate texts and vectors, and repeated passages, against brute force."""

import hashlib
import random

import numpy as np
import pytest

from feedlake.llm import bbit_minhash, cross_polytope, phrase_automata
from feedlake.llm.graph import components

DOCS = "doc_id long, text string"


def reachable(nodes, links):
    root = {node: node for node in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {node: find(node) for node in nodes}


def brute_sets(text, size):
    own = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    width = min(size, len(own))
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)} if own else set()


def brute_near(rows, size):
    sets = {doc: brute_sets(text, size) for doc, text in rows}
    docs = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(docs) for b in docs[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    roots = reachable(docs, links)
    return {doc: (len(sets[doc]), roots[doc], roots[doc] == doc) for doc in docs}


def family(rng, words, copies, changes):
    base = [rng.choice(words) for _ in range(120)]
    made = []
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(len(own))] = rng.choice(words)
        made.append(" ".join(own))
    return made


@pytest.mark.parametrize("seed,chunk", [(1, 1 << 18), (2, 300)])
def test_families_of_near_copies(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(bbit_minhash, "CHUNK", chunk)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = family(rng, words, 90, 8) + family(rng, words, 40, 14) + family(rng, words[:40], 30, 20) + family(rng, words, 10, 0)
    texts += ["", None, "  \n\t ", "One two", "one  two", "one two three four", "One Two three\nfour", "ein Wort", "é é é é é", "É é é é é"]
    ids = rng.sample(range(10000), len(texts))
    rows = list(zip(ids, texts))
    want = brute_near(rows, 4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in bbit_minhash.near_duplicates(spark.createDataFrame(rows, DOCS), size=4).collect()}
    assert got == want
    assert len({component for _, component, _ in want.values()}) < len(want)


def test_near_duplicates_of_odd_tables(spark):
    empty = spark.createDataFrame([], f"{DOCS}, n_shingles int, band string")
    assert bbit_minhash.near_duplicates(empty).collect() == []
    text = "a b c d e f g"
    rows = [(3, text, 1, "x"), (3, text, 1, "x"), (None, text, 1, "x"), (9, text.upper(), 2, "y"), (4, None, 0, None)]
    got = bbit_minhash.near_duplicates(spark.createDataFrame(rows, f"{DOCS}, n_shingles int, band string"))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == sorted([(3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, False), (9, 3, 3, False), (4, 0, 4, True)], key=str)


def test_near_copies_without_an_id(spark):
    own = [f"w{i}" for i in range(100)]
    changed = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(own))
    rows = [(3, changed(0, 1, 2, 3, 4, 5, 6, 7, 8, 9)), (None, changed()), (9, changed(*range(90, 100))), (None, "a b c d e f g"), (None, "q r s t u v")]
    assert brute_near([rows[0], rows[2]], 5)[9][1] == 9
    got = bbit_minhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted([(3, 3, True), (None, 3, False), (9, 3, False), (None, None, True), (None, None, True)], key=str)


def test_estimate_and_signature():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for shared in (200, 500, 900):
        a = np.unique(np.concatenate([pool[:shared], pool[1000 : 2000 - shared]]))
        b = np.unique(np.concatenate([pool[:shared], pool[2000 : 3000 - shared]]))
        exact = shared / (len(a) + len(b) - shared)
        estimate = bbit_minhash.estimates(bbit_minhash.signature(a), bbit_minhash.signature(b)[None])[0]
        assert abs(estimate - exact) < 5 * np.sqrt(exact * (1 - exact) / bbit_minhash.MINIMA)


def test_components_of_chains_stars_and_loops(spark):
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("100", f"{i}") for i in range(200, 230)] + [("300", "300"), ("301", "302"), ("302", "301")]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    want = reachable({x for link in links for x in link} - {"300"}, [x for x in links if x != ("300", "300")])
    assert got == want
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []


def vector_rows(rng):
    centres = rng.normal(size=(12, 24))
    near = [c + rng.normal(size=24) * s for c in centres for s in (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3)]
    vectors = [[float(np.float32(x)) for x in v] for v in [*near, *rng.normal(size=(60, 24))]]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[1]], None, [], [0.0] * 24, [None] + vectors[0][1:], [float("nan")] + vectors[0][1:], [float("inf")] * 24, [1.0, 0.0, 0.0], [1.0, 0.0, 0.01], [5.0], [1e38] * 24]
    return list(zip(rng.permutation(5000)[: len(vectors)].tolist(), vectors))


@pytest.mark.parametrize("chunk", [1024, 4])
def test_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(cross_polytope, "CHUNK", chunk)
    rows = vector_rows(np.random.default_rng(4))
    usable = {i: np.array(v, dtype=float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = []
    for a, x in usable.items():
        for b, y in usable.items():
            if a < b and len(x) == len(y) and (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= 0.95:
                links.append((a, b))
    roots = reachable([i for i, _ in rows], links)
    want = {i: (sum(i in link for link in links), roots[i], roots[i] == i) for i, _ in rows}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cross_polytope.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got == want and len(links) > 50


def test_vector_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * side
    keys_a, keys_b = (cross_polytope._keys(*cross_polytope.hashes(x), 64) for x in (a, b))
    met = ((keys_a == keys_b[..., :1]).any(axis=2) | (keys_b == keys_a[..., :1]).any(axis=2)).any(axis=1)
    assert met.mean() > 0.999


def test_no_vectors(spark):
    assert cross_polytope.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, node string")).collect() == []


def brute_kept(rows, window):
    words = [(doc, [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]) for doc, text in rows]
    first = {}
    for doc, own in words:
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(doc, first.get(key, doc))
    want = {}
    for doc, own in words:
        gone = {i + k for i in range(len(own) - window + 1) if first[tuple(own[i : i + window])] < doc for k in range(window)}
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        want[doc] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return want


@pytest.mark.parametrize("seed,shard,copy", [(3, 4096, 16384), (4, 3, 5)])
def test_repeated_passages(spark, monkeypatch, seed, shard, copy):
    monkeypatch.setattr(phrase_automata, "SHARD_ANCHORS", shard)
    monkeypatch.setattr(phrase_automata, "COPY_SEGMENTS", copy)
    rng = random.Random(seed)
    some = lambda n, of=4000: [f"v{rng.randrange(of)}é" for _ in range(n)]
    passages = [some(rng.randrange(48, 200)) for _ in range(8)] + [some(90, 2), ["same"] * 130]
    texts = []
    for _ in range(60):
        own = some(rng.randrange(0, 80))
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            start = rng.randrange(20)
            own += passage[start : len(passage) - rng.randrange(20)] + some(rng.randrange(0, 30))
        texts.append(rng.choice([" ", "\n", " \t "]).join(own))
    texts += [texts[5], texts[5].upper(), texts[40], "", None, " ".join(some(49))]
    rows = list(zip(rng.sample(range(1000), len(texts)), texts))
    want = brute_kept(rows, 50)
    found = phrase_automata.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == want
    for r in found:
        assert r.kept is None or hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
    assert sum(n for _, n, _ in want.values()) > 500


def test_a_passage_in_many_groups_of_copies(spark, monkeypatch):
    for name, value in (("SHARD_ANCHORS", 4), ("SHARD_PASSAGES", 8), ("KEY_PASSAGES", 3)):
        monkeypatch.setattr(phrase_automata, name, value, raising=False)
    searched, mapped = [], phrase_automata._mapped
    monkeypatch.setattr(phrase_automata, "_mapped", lambda df, of, ddl: searched.append(df) or mapped(df, of, ddl) if getattr(of, "func", of) is phrase_automata._searched else mapped(df, of, ddl))
    rng = random.Random(8)
    some = lambda n: [f"v{rng.randrange(4000)}" for _ in range(n)]
    passage, texts = some(70), []
    for _ in range(60):
        group = some(40) + passage + some(40)
        texts += [" ".join(some(5) + group), " ".join(group + some(5))]
    rows = list(zip(rng.sample(range(1000), len(texts)), texts))
    found = phrase_automata.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_kept(rows, 50)
    assert len(searched) == 2
    for together in searched:
        in_shards = [r["count"] for r in together.where("unit is null").groupBy("shard", "copy").count().collect()]
        assert max(in_shards) < 30
    least = searched[0].where("unit is null").groupBy("key").count().agg({"count": "max"}).first()[0]
    assert least == 3 and searched[1].where("unit is null and size(split(string(words), ' ')) <> 50").count() == 0


def test_the_automaton_tells_the_places():
    own = [b"w%d" % i for i in range(100)]
    shard = phrase_automata.Shard([(1, b" ".join(own[:70]), 20, 0, 20)])
    for before in (0, 7, 35):
        segment = b" ".join([b"x"] * before + own[:70] + [b"w20", b"y"] * 3)
        assert shard.covered(2, segment, 0, 20) == [(before, before + 70)] and shard.covered(1, segment, 0, 20) == []


def test_repeats_of_odd_tables(spark):
    assert phrase_automata.remove_repeats(spark.createDataFrame([], f"{DOCS}, unit int")).collect() == []
    text = " ".join(f"x{i}" for i in range(60))
    rows = [(3, text, 1), (3, text, 1), (None, text, 1), (9, f"{text} more", 2)]
    got = phrase_automata.remove_repeats(spark.createDataFrame(rows, f"{DOCS}, unit int")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in got) == [("3", 60, 0), ("3", 60, 0), ("9", 61, 60), ("None", 60, 0)]
