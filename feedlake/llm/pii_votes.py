"""Personal data by weak supervision: labelers vote on spans, their reliabilities are estimated, a classifier decides.

Candidates are the matches of four base patterns (email, ip, card, phone), valid or not, and of looser patterns of the
same kinds: addresses written out, numbers of other layouts. Labelers vote yes, no or nothing on each: the base check
itself (digits, Luhn sum, parts up to 255), a gazetteer (name endings, card prefixes, reserved addresses), the words around, and whether
the span stands alone. Candidates are counted by kind, votes and shape over all documents; those counts, a few
hundred at most, are all that expectation-maximisation needs to estimate each labeler's reliability and the
probability of each pattern. A logistic span classifier is trained on these probabilities.

Spans are base matches that are valid, always, and loose candidates that the classifier takes and that overlap none of
them. A base match that fails its check is evidence for the labelers, but never a span itself.
Positions are code points, the end excluded. Each text is searched on its own, in time linear in its length; null
and empty texts have no spans. Repeated rows give repeated results, an empty table an empty one; other columns are
not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm import arrow
from feedlake.llm.labelled import logistic, sigmoid

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("base", "gazetteer", "context", "alone")
#: Code points on either side that the context labeler reads.
CONTEXT = 32

# The gazetteer, and words that speak for or against a kind.
ENDINGS = frozenset("com org net edu gov io co info biz de fr es it uk eu us ca au jp cn in br ru nl ch at be se no pl example test".split())
CARD_PREFIXES = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65")
SPEAKS = {
    "email": re.compile(r"e-?mail|contact|courriel|correo|write to|address|adresse", re.I),
    "ip": re.compile(r"\bip\b|host|server|login|addr|client|connect", re.I),
    "card": re.compile(r"card|visa|master|credit|debit|karte|carte|tarjeta|pay", re.I),
    "phone": re.compile(r"phone|\btel\b|call|fax|mobile|cell|telefon|téléphone|teléfono|whatsapp", re.I),
}
AGAINST = re.compile(r"version|\bv\.?$|token|hash|sha\d|commit|isbn|issn|order|invoice|serial|chapter|section|release|build|doi|uuid", re.I)

_TAIL = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[(\[]\x20?dot\x20?[)\]]\x20?[A-Za-z0-9-]{1,63}){1,4}", re.I)
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping addresses: each sign is met once, so that long runs without one cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
            start -= 1
        tail = _TAIL.match(text, at) if start < at else None
        free = tail.end() if tail else at + 1
        if tail:
            yield start, free
        at = text.find("@", free)


def base_matches(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, valid) of all matches of the base patterns; by kind, then start."""
    found = [("email", start, end, True) for start, end in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    if "." in text:
        for match in _IP.finditer(text):
            found.append(("ip", *match.span(), all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in match[0].split("."))))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if len(digits) >= 9:
            found.append(("card", *match.span(), 16 <= len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for match in _PHONE.finditer(text):
            found.append(("phone", *match.span(), 8 <= sum(map(str.isdigit, match[0])) <= 15))
    return found


def _loose_matches(text: str) -> list[tuple[str, int, int]]:
    found = []
    if re.search(r"[(\[]\x20?at\x20?[)\]]", text, re.I):
        found += [("email", *match.span()) for match in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        found += [("phone", *match.span()) for match in _LOCAL_PHONE.finditer(text)]
    return found


def _gazetteer(kind: str, span: str) -> int:
    if kind == "email":
        ending = re.split(r"[.\s)\]]+", span.rstrip(")] "))[-1].lower()
        return 1 if ending in ENDINGS else 0
    digits = "".join(filter(str.isdigit, span))
    if kind == "card":
        return 1 if digits.startswith(CARD_PREFIXES) else -1
    if kind == "ip":
        return -1 if span.startswith(("0.", "127.", "255.")) or span.count(".0") >= 2 else 0
    return -1 if len(set(digits)) <= 2 else 0


def _size(length: int) -> int:
    return min(length // 4, 6)


def _sides(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]


def described(text: str, kind: str, start: int, end: int, base: int) -> tuple:
    """Kind, votes and shape of a candidate; `base` is the base check's vote."""
    span = text[start:end]
    before, after = _sides(text, start, end)
    context = -1 if AGAINST.search(before) else 1 if SPEAKS[kind].search(before) or SPEAKS[kind].search(after) else 0
    joined = before[-1:].isalnum() or before[-1:] in ("=", "#", "_", "/") or after[:1].isalnum() or after[:1] in ("_", "/")
    shape = (_size(sum(map(str.isdigit, span))), sum(not x.isalnum() for x in span) > 2)
    return (kind, base, _gazetteer(kind, span), context, -1 if joined else 1, *shape)


class Taken:
    """Stretches of a text, to be asked which others overlap one of them."""

    def __init__(self, stretches: Iterable[tuple[int, int]]):
        ordered = sorted(stretches)
        self.starts = [start for start, _ in ordered]
        self.ends = list(accumulate((end for _, end in ordered), max))

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def candidates(text: str) -> list[tuple[int, int, bool, tuple]]:
    """(start, end, base, description) of all candidates; loose ones overlapping no valid base match."""
    found = [(start, end, valid, described(text, kind, start, end, 1 if valid else -1)) for kind, start, end, valid in base_matches(text)]
    taken = Taken((start, end) for start, end, valid, _ in found if valid)
    for kind, start, end in _loose_matches(text):
        if not taken.meets(start, end):
            found.append((start, end, False, described(text, kind, start, end, 0)))
    return found


_DESCRIPTION = "kind string, base int, gazetteer int, context int, alone int, size int, parted boolean"


def pattern_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Candidates of all documents counted by kind, votes and shape; at most a few hundred rows."""
    ddl = f"{_DESCRIPTION}, n long"
    schema = arrow.arrow_schema(ddl)

    def count(batches):
        counts: Counter = Counter()
        for part in arrow.slices(batches, text):
            for value in arrow.texts(part, text):
                counts.update(description for *_, description in candidates(value.decode()))
        rows = [(*description, n) for description, n in counts.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)

    counted = arrow.mapped(docs.select(text), count, ddl)
    return counted.groupBy(*[name for name in counted.columns if name != "n"]).agg(F.sum("n").alias("n"))


@dataclass
class Model:
    reliability: dict[tuple[str, str], float]
    prior: dict[str, float]
    weights: np.ndarray

    def probability(self, descriptions: list[tuple]) -> np.ndarray:
        return sigmoid(_features(descriptions) @ self.weights)


def _features(descriptions: list[tuple]) -> np.ndarray:
    """Votes, votes by kind, size and layout of candidates, and a constant."""
    rows = np.zeros((len(descriptions), 2 * len(LABELERS) + 2 * len(KINDS) + 2))
    for row, (kind, *votes, size, parted) in zip(rows, descriptions):
        for number, vote in enumerate(votes):
            row[2 * number + (vote > 0)] = vote != 0
        row[2 * len(LABELERS) + KINDS.index(kind)] = 1
        row[2 * len(LABELERS) + len(KINDS) + KINDS.index(kind)] = parted
        row[-2] = size / 6
        row[-1] = 1
    return rows


def reliabilities(patterns: list[tuple], rounds: int = 50) -> tuple[dict, dict, np.ndarray]:
    """Expectation-maximisation over counted patterns: how often a labeler that votes is right, the share of
    personal data by kind, and the probability of each pattern.

    A labeler starts out as right in four of five votes; the numbers are smoothed with eight such votes, so that a labeler that hardly
    votes, or a kind that is never seen, keeps them. Labelers stay better than chance.
    """
    right = {(kind, name): 0.95 if name == "base" else 0.8 for kind in KINDS for name in LABELERS}
    share = dict.fromkeys(KINDS, 0.5)
    n = np.array([row[-1] for row in patterns], dtype=float)
    posterior = np.zeros(len(patterns))
    for _ in range(rounds):
        for number, (kind, *rest) in enumerate(patterns):
            odds = np.log(share[kind] / (1 - share[kind]))
            for name, vote in zip(LABELERS, rest[: len(LABELERS)]):
                odds += vote * np.log(right[kind, name] / (1 - right[kind, name]))
            posterior[number] = sigmoid(np.array([odds]))[0]
        for kind in KINDS:
            own = np.array([row[0] == kind for row in patterns], dtype=bool)
            share[kind] = float(np.clip((posterior[own] @ n[own] + 4) / (n[own].sum() + 8), 0.01, 0.99))
            for column, name in enumerate(LABELERS, start=1):
                votes = np.array([row[column] for row in patterns], dtype=float) * own
                agree = (posterior * (votes > 0) + (1 - posterior) * (votes < 0)) @ n
                start = 0.95 if name == "base" else 0.8
                right[kind, name] = float(np.clip((agree + 8 * start) / (np.abs(votes) @ n + 8), 0.55, 0.99))
    return right, share, posterior


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Reliabilities and the span classifier from the candidates of all documents."""
    rows = pattern_counts(docs, text).orderBy(*[name.split()[0] for name in _DESCRIPTION.split(", ")]).collect()
    patterns = [tuple(row) for row in rows]
    if not patterns:
        return Model({}, {}, np.zeros(_features([]).shape[1]))
    right, share, posterior = reliabilities(patterns)
    features = _features([row[:-1] for row in patterns])
    n = np.array([row[-1] for row in patterns], dtype=float)
    both = np.concatenate([features, features])
    answers = np.concatenate([np.ones(len(n)), np.zeros(len(n))])
    weights = logistic(both, answers, 1.0, np.concatenate([n * posterior, n * (1 - posterior)]))
    return Model(right, share, weights)


def spans(text: str, model: Model) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of a text's personal data, by kind and start."""
    found = candidates(text)
    loose = [item for item in found if not item[2] and item[3][1] == 0]
    chosen = [(description[0], start, end, True) for start, end, base, description in found if base]
    if loose:
        likely = model.probability([description for *_, description in loose]) > 0.5
        # Loose matches of a kind do not overlap one another.
        for kind in dict.fromkeys(description[0] for *_, description in loose):
            taken = Taken((start, end) for _, start, end, _ in chosen)
            chosen += [
                (kind, start, end, False) for (start, end, _, description), good in zip(loose, likely)
                if good and description[0] == kind and not taken.meets(start, end)
            ]
    return sorted(chosen, key=lambda span: (KINDS.index(span[0]), span[1], span[2]))


def redacted(text: str, found: list[tuple[str, int, int, bool]]) -> str:
    """The text with a mark such as <EMAIL> in place of each span; of overlapping spans they share one, the first kind."""
    parts, at = [], 0
    for kind, start, end, _ in sorted(found, key=lambda span: (span[1], span[2])):
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and `spans` of every document."""

    def make():
        def found(values: list[bytes]) -> dict:
            told = [[dict(zip(("kind", "start", "end", "base"), span)) for span in spans(value.decode(), model)] for value in values]
            return {"spans": told}

        return found

    return arrow.per_text(docs, "spans array<struct<kind:string,start:int,end:int,base:boolean>>", make, keep, text)


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with personal data replaced in `text`; null stays null."""
    schema = docs.schema

    def run(batches):
        shape = arrow.to_arrow_schema(schema)
        place = schema.names.index(text)
        for part in arrow.slices(batches, text):
            values = [None if value is None else redacted(value, spans(value, model)) for value in part.column(text).to_pylist()]
            columns = [pa.array(values, shape.field(place).type) if number == place else part.column(number).cast(shape.field(number).type) for number in range(len(shape))]
            yield pa.RecordBatch.from_arrays(columns, schema=shape)

    return arrow.mapped(docs, run, schema)
