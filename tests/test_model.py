"""Random feeds over several days, in any order and with reruns, against a plain model of the rules."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from feedtext import document, line, raw, raw_json, txn

from feedlake.operators.parse import flatten_redemptions
from feedlake.operators.routing import changed_keys, project, reroute
from feedlake.operators.versions import conflicts, latest_members, split_conflicts
from feedlake.plans import stages
from feedlake.schemas import COUNTRIES, MEMBER_ATTRIBUTES
from feedlake.sources.scratch import materialise

DAYS = ("20260926", "20260927", "20260928")


def random_members(rng):
    """(member, country, state, valid) per line."""
    rows = []
    for _ in range(rng.randrange(5, 25)):
        valid = rng.random() < 0.8
        rows.append((f"m{rng.randrange(8)}", rng.choice(COUNTRIES[:4]), rng.choice(["", "S1", "S2"]), valid))
    return rows


def random_documents(rng):
    """(member, [(txn, status, valid)]) per document."""
    return [
        (
            rng.choice([f"m{rng.randrange(10)}", None]),
            [
                (rng.choice([f"t{rng.randrange(12)}", None]), rng.choice(["COMPLETED", "PENDING"]), rng.random() < 0.8)
                for _ in range(rng.randrange(0, 4))
            ],
        )
        for _ in range(rng.randrange(1, 10))
    ]


class Model:
    """The same in dictionaries, one row at a time."""

    def __init__(self):
        self.current, self.routed, self.curated = {}, {}, {}

    def run(self, day, members, documents):
        valid = [(m, c, s or None) for m, c, s, ok in members if ok]
        by_member = {}
        for member, country, state in valid:
            by_member.setdefault(member, set()).add((country, state))
        clashing = {member for member, values in by_member.items() if len(values) > 1}
        for member, values in by_member.items():
            if member not in clashing and (member not in self.current or day > self.current[member][0]):
                self.current[member] = (day, *next(iter(values)))
        for member in by_member:
            self.routed.pop(member, None)
            if member in self.current:
                self.routed[member] = self.current[member][1]

        flat = [(m, t, s, ok) for m, txns in documents for t, s, ok in txns]
        copies = Counter(t for _, t, _, _ in flat)
        reasons = []
        for member, txn_id, status, ok in flat:
            found = [
                reason
                for reason, applies in (
                    ("MEMBER_ID_MISSING", member is None),
                    ("TXN_ID_MISSING", txn_id is None),
                    ("PARTNER_MISSING", not ok),
                    ("DUPLICATE_TXN_ID", copies[txn_id] > 1),
                    ("MEMBER_NOT_FOUND", member is not None and member not in self.current),
                )
                if applies
            ]
            reasons.append("; ".join(found) or None)
            if not found:
                self.curated[txn_id] = (day, member, status)
        return Counter(reasons), sum(m in clashing for m, _, _ in valid)


def run_stages(spark, state, day, members, documents):
    lines = [line(member=m, country=c, state=s, name="Ann" if ok else "") for m, c, s, ok in members]
    evaluated = stages.evaluate_members(raw(spark, lines, batch_id=day))
    staged = materialise(stages.member_staging(evaluated), "model")
    pairs = conflicts(staged, "member_id", "source_feed_timestamp", list(MEMBER_ATTRIBUTES))
    bad, good = split_conflicts(staged, pairs, "member_id", "source_feed_timestamp", hot_rows=3)
    current = materialise(stages.merge_members(state.get("current"), latest_members(good)), "model")
    changed = changed_keys(staged, "member_id")
    if "routed" in state:
        routed = reroute(state["routed"], current, changed, "member_id", "country", COUNTRIES)
    else:
        routed = project(current, "country", COUNTRIES)

    texts = [document(m, day, [txn(t, status=s, partner="P" if ok else None) for t, s, ok in txns]) for m, txns in documents]
    flattened = materialise(flatten_redemptions(raw_json(spark, texts, batch_id=day)), "model")
    judged = materialise(stages.evaluate_redemptions(flattened, current, hot_rows=2), "model")
    curated = stages.merge_redemptions(state.get("curated"), stages.accepted_redemptions(judged))
    state |= {"current": current, "routed": materialise(routed, "model"), "curated": materialise(curated, "model")}
    return Counter(r.dq_reason for r in judged.collect()), bad.count()


@pytest.mark.parametrize("seed", range(4))
def test_against_model(spark, seed):
    rng = random.Random(seed)
    feeds = {day: (random_members(rng), random_documents(rng)) for day in DAYS}
    order = rng.sample(DAYS, 3) + [rng.choice(DAYS)]
    model, state = Model(), {}
    for day in order:
        expected = model.run(day, *feeds[day])
        assert run_stages(spark, state, day, *feeds[day]) == expected
        assert {r.member_id: (r.batch_id, r.country, r.state) for r in state["current"].collect()} == model.current
        routed = state["routed"].collect()
        assert {r.member_id: r.country for r in routed} == model.routed and len(routed) == len(model.routed)
        curated = state["curated"].collect()
        assert {r.txn_id: (r.batch_id, r.member_id, r.status) for r in curated} == model.curated
        assert len(curated) == len(model.curated)
