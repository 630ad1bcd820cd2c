"""Formatting, encoding, search and personal data against brute force."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.llm import byte_bpe, chat_format, length_histogram, pii_votes, queries, wu_manber

TURNS = "conv_id long, turn long, role string, parts " + chat_format.PARTS
LIBRARY = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(queries.RANKS), special_tokens={})
OWN = byte_bpe.Encoder(queries.RANKS)


def ids_of(text):
    return np.frombuffer(OWN.encode(text), np.int32).tolist()


# -- chat formatting ---------------------------------------------------------


def part(kind=None, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_become_ordered_placeholders(spark):
    turns = [
        (1, 0, "user", [part("text", "see <|image_1|> "), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=1.5), part("text", " and "), part("document", ref="c.pdf", pages=3)]),
        (1, 1, "assistant", [part("text", "a|b"), part("text", " <\\|im_end|>"), part("video", "?"), part(None, None)]),
        (1, 2, None, None),
    ]
    rows = {r.turn: r for r in chat_format.format_turns(spark.createDataFrame(turns, TURNS)).collect()}
    assert rows[0].formatted == "<|im_start|>user\nsee <\\|image_1|> <|image_1|><|audio_2|> and <|document_3|><|im_end|>\n"
    assert [tuple(x) for x in rows[0].attachments] == [(1, "image", "a.png", 3), (2, "audio", "b.wav", 38), (3, "document", "c.pdf", 3072)]
    assert rows[0].expanded_tokens == 3 + 38 + 3072 and rows[0].loss_chars == 0
    assert rows[1].formatted[rows[1].loss_start :][: rows[1].loss_chars] == "a|b <\\\\|im_end|>?"
    assert rows[2].formatted == "<|im_start|>\n<|im_end|>\n" and rows[2].attachments == []
    assert chat_format.read_back(rows[1].formatted) == ("assistant", "a|b <\\|im_end|>?")


ODD = st.text(alphabet="<\\|>im_endstar \nx", max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(ODD, ODD), min_size=1, max_size=40))
def test_any_text_and_role_come_back(spark, turns):
    frame = spark.createDataFrame([(1, number, role, text) for number, (role, text) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    made = chat_format.format_turns(frame.select("conv_id", "turn", "role", chat_format.text_parts(frame.text).alias("parts"))).orderBy("turn").collect()
    assert [chat_format.read_back(r.formatted) for r in made] == turns


def test_digests_of_odd_conversations(spark):
    empty = spark.createDataFrame([], TURNS + ", formatted string, content string")
    assert chat_format.conversation_digests(chat_format.format_turns(empty)).collect() == []
    rows = [(None, 0, "user", [part("text", "x")]), (7, 1, "assistant", [part("text", "b")]), (7, 1, "assistant", [part("text", "a")]), (7, 1, "assistant", [part("text", "a")]), (7, None, "user", [part("text", None)])]
    rows += [(9, n, "assistant", [part("text", "é" * n)]) for n in range(3000)]
    got = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_turns(spark.createDataFrame(rows, TURNS))).collect()}
    assert got[7].n_turns == 4 and got[7].loss_sha256 == hashlib.sha256(b"aab").hexdigest()
    assert got[7].turns_sha256 == hashlib.sha256(b"user\n\nassistant\na\nassistant\na\nassistant\nb\n").hexdigest()
    tied = [(1, 1, "user", [part("text", "<|")]), (1, 1, "user", [part("text", "<a")]), (1, 1, "u|z", [part("text", "")]), (1, 1, "u~", [part("text", "")]), (1, 1, "u\n", [part("text", "")])]
    of_ties = chat_format.conversation_digests(chat_format.format_turns(spark.createDataFrame(tied, TURNS))).first()
    assert of_ties.turns_sha256 == hashlib.sha256(b"".join(f"{r}\n{p[0][1]}\n".encode() for _, _, r, p in sorted(tied, key=lambda t: (t[2], t[3][0][1])))).hexdigest()
    assert got[9].n_turns == 3000 and got[9].loss_chars == 3000 * 2999 // 2 and got[None].n_turns == 1


# -- byte-level BPE ------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abtheinor \n\t'srelé漢0", max_size=200)))
def test_same_ids_as_the_library(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids_of(text)) == text.encode()
    assert not any(OWN.queue.words) and not OWN.queue.buckets


@pytest.mark.parametrize("alphabet", ["a", "ab", "abtheinor", "漢字é"])
def test_very_long_pre_tokens(alphabet):
    rng = random.Random(3)
    text = "".join(rng.choice(alphabet) for _ in range(60000))
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_a_merge_may_open_one_of_a_lower_rank(tmp_path):
    # "ab" then "abc" of a lower rank than "ab": the second "ab" has to wait.
    tokens = [bytes([byte]) for byte in range(256)] + [b"abc", b"cab", b"ab", b"aba", b"ca", b"bc a", b"abab"]
    ranks = {token: rank for rank, token in enumerate(tokens)}
    library = tiktoken.Encoding("few", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    with open(tmp_path / "few.tiktoken", "wb") as file:
        file.writelines(base64.b64encode(token) + b" %d\n" % rank for token, rank in ranks.items())
    own, rng = byte_bpe.Encoder(str(tmp_path / "few.tiktoken")), random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 40)))
        assert np.frombuffer(own.encode(text), np.int32).tolist() == library.encode_ordinary(text)


def test_cache_overflow_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_TOKENS", 5)
    own, text = byte_bpe.Encoder(queries.RANKS), " ".join(f"wörd{n} thing{n}" for n in range(50)) * 2
    assert np.frombuffer(own.encode(text), np.int32).tolist() == LIBRARY.encode_ordinary(text)
    assert len(own.cache) <= 5


def test_encoding_of_odd_tables(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (3, "", None), (4, "z" * 100000 + " é", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = byte_bpe.encode(docs, queries.RANKS, ["doc_id"])
    found = sorted((r.doc_id, bytes(r.decoded)) for r in byte_bpe.decode(encoded, queries.RANKS, ["doc_id"]).collect())
    assert found == sorted((r.doc_id, bytes(r.decoded)) for r in byte_bpe.encode(docs, queries.RANKS, ["doc_id"], decoded=True).collect())
    nothing = byte_bpe.decode(encoded.select("doc_id", F.lit(None).cast("array<int>").alias("ids")), queries.RANKS, ["doc_id"])
    assert {bytes(r.decoded) for r in nothing.collect()} == {b""}
    assert found == sorted((doc, (text or "").encode()) for doc, text, _ in rows)
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == sorted((doc, LIBRARY.encode_ordinary(text or "")) for doc, text, _ in rows)
    assert byte_bpe.encode(docs.limit(0), queries.RANKS, ["doc_id"]).collect() == []


# -- token counts ----------------------------------------------------------------


def test_histogram_answers_every_limit(spark, monkeypatch):
    monkeypatch.setattr(length_histogram, "RANGE", 8)
    rng = random.Random(5)
    texts = ["the " * rng.randrange(120) for _ in range(300)] + [None, ""]
    docs = spark.createDataFrame([(text, 1) for text in texts], "text string, length int")
    lengths = [len(LIBRARY.encode_ordinary(text or "")) for text in texts]
    table = length_histogram.limits(length_histogram.histogram(docs, queries.RANKS))
    rows = {r.length: r for r in table.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for limit, row in rows.items():
        assert row.n_docs == lengths.count(limit)
        assert (row.docs_fitting, row.docs_longer) == (sum(n <= limit for n in lengths), sum(n > limit for n in lengths))
        assert (row.tokens_fitting, row.tokens_longer) == (sum(n for n in lengths if n <= limit), sum(n for n in lengths if n > limit))
        assert row.truncated_tokens == sum(min(n, limit) for n in lengths)
        assert (row.rank_from, row.rank_to) == (sum(n < limit for n in lengths), row.docs_fitting)
    for share in (0.0, 0.1, 0.5, 0.99, 1.0):
        want = min(n for n in lengths if sum(m <= n for m in lengths) >= share * len(lengths))
        assert length_histogram.quantile(table, share).first().length == want
    none = length_histogram.limits(length_histogram.histogram(docs.limit(0), queries.RANKS))
    assert none.collect() == [] and length_histogram.quantile(none, 0.5).collect() == []


# -- decontamination -----------------------------------------------------------------


def brute_hits(text, items, size):
    split = lambda value: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value or ""))
    own, hit, found = split(text), set(), set()
    for item, value in items:
        words = split(value)
        m = min(size, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            for at in range(len(own) - m + 1):
                if own[at : at + m] == words[i : i + m]:
                    hit.update(range(at, at + m))
                    found.add(item)
    return len(own), sorted(hit), sorted(found)


@pytest.mark.parametrize("shard_bytes", [1 << 24, 400])
def test_windows_of_every_length(spark, shard_bytes):
    rng = random.Random(8)
    pick = lambda n, of: " ".join(f"{rng.choice('AbÉ')}{rng.randrange(of)}" for _ in range(n))
    items = [(n, pick(rng.choice([1, 2, 3, 9, 10, 11, 25]), 6)) for n in range(25)] + [(90, None), (91, " -- "), (92, pick(40, 900)), (92, pick(40, 900)), (93, "alone")]
    texts = [pick(rng.randrange(60), 6) for _ in range(30)] + [None, "", "!?", "Alone.", "x " + items[-3][1] + "\n" + items[-2][1].upper()]
    docs = spark.createDataFrame([(n, text, 1) for n, text in enumerate(texts)] + [(0, texts[0], 1)], "doc_id long, text string, hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = wu_manber.search(docs, bench, ["doc_id"], shard_bytes=shard_bytes).collect()
    want = {n: brute_hits(text, items, 10) for n, text in enumerate(texts)}
    assert len(got) == len(texts) + 1
    assert all((r.n_words, r.hit, r["items"]) == want[r.doc_id] for r in got)


def test_empty_benchmark_and_documents(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in wu_manber.search(docs, bench, ["doc_id"]).collect()] == [(1, 3, [], [])]
    assert wu_manber.search(docs.limit(0), bench, ["doc_id"]).collect() == []


# -- personal data ---------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append(("card", *m.span()))
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]


PIECES = ["a", "b.", "@", "1", "2", "25", "4", "-", " ", "+", "(", ")", ".", "%", "_", "é", "0000", "1.2.3.4", "a@b.c", "4111111111111111", "+1 (555) 555-0100", "x@y.com_z@w.org"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40))
def test_base_spans_are_those_of_the_patterns(pieces):
    text = "".join(pieces)
    assert [span[:3] for span in pii_votes.base_matches(text) if span[3]] == brute_spans(text)


def test_loose_spans_join_and_base_spans_stay(spark):
    rows = [(n, f"mail a{n}@mail.example.com or call +1 (555) 555-01{n:02} now") for n in range(40)]
    rows += [(100, "write to jo [at] mail [dot] com"), (101, "phone 555-123-4567 today"), (102, "version 1.2.3 build 555-123-456789"), (103, None), (104, ""), (105, "plain words only"), (105, "plain words only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii_votes.fit(docs)
    found = {r.doc_id: [tuple(x) for x in r.spans] for r in pii_votes.find(docs, model, ["doc_id"]).collect()}
    for n, text in rows[:40]:
        assert [span[:3] for span in found[n]] == brute_spans(text) and all(span[3] for span in found[n])
    assert found[100] == [("email", 9, 31, False)] and found[101] == [("phone", 6, 18, False)]
    assert found[102] == found[103] == found[104] == found[105] == []
    clean = {r.doc_id: r.text for r in pii_votes.redact(docs, model).collect()}
    assert clean[3] == "mail <EMAIL> or call <PHONE> now" and clean[101] == "phone <PHONE> today" and clean[103] is None
    assert all(0.55 <= p <= 0.99 for p in model.reliability.values()) and model.reliability["email", "base"] > 0.9


@pytest.mark.parametrize("text,span", [("Call (555) 123-4567", (5, 19)), ("555.123.4567", (0, 12)), ("звоните (555) 123-4567", (8, 22)), ("电话 555.123.4567。", (3, 15))])
def test_local_phones_in_texts_without_other_signs(spark, text, span):
    assert [(start, end, base) for start, end, base, _ in pii_votes.candidates(text)] == [(*span, False)]
    docs = spark.createDataFrame([(1, text), (2, "phone (555) 987-6543 at noon")], "doc_id long, text string")
    model = pii_votes.fit(docs)
    assert sum(r.n for r in pii_votes.pattern_counts(docs).collect()) == 2
    clean = {r.doc_id: r.text for r in pii_votes.redact(docs, model).collect()}
    assert clean == {1: text[: span[0]] + "<PHONE>" + text[span[1] :], 2: "phone <PHONE> at noon"}


def test_personal_data_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, spans string")
    model = pii_votes.fit(docs)
    assert pii_votes.find(docs, model, ["doc_id"]).collect() == [] and pii_votes.redact(docs, model).collect() == []


def test_long_runs_take_linear_time():
    for text in ("555-123-4567 a@b.cc " * 50000, "(555) 123-4567 a [at] b.cc " * 20000, "1" * 200000, "a" * 200000 + "@", "1." * 60000, "+" + "1 " * 100000, "@" * 100000):
        assert pii_votes.candidates(text) is not None
    model = pii_votes.Model({}, {}, np.ones(pii_votes._features([]).shape[1]))
    assert len(pii_votes.spans("(555) 123-4567 a [at] b.cc, " * 20000, model)) == 2000 * len(pii_votes.spans("(555) 123-4567 a [at] b.cc, " * 10, model)) > 0
