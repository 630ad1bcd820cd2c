"""Toxicity by maximum-scoring segments.

Words and their beginnings have log-odds in toxic against other documents, shrunk by a Dirichlet prior in
proportion to their frequency in the whole corpus, as large as the toxic training text. A word scores the highest of its
significantly positive log-odds; all words without any share one score, which is negative. A word counts once per document,
as one that a document repeats would otherwise seem frequent. A linear scan finds all maximal scoring segments of a document. Scores
of the best segments of random texts follow an extreme-value law, exp(-K n exp(-lambda s)) for n words; with lambda
from the word frequencies and K from the training documents that are not toxic, each segment has an expected number of
equals by chance, and those under `SIGNIFICANT` are the toxic passages. A document's evidence is the sum of
-ln(expected) over its passages; a logistic curve turns it into the score.

Labels come from a bounded sample (`TRAIN_DOCS`), from which the words and beginnings that may become significant come; their
frequencies are counted over all documents. The lexicon is bounded by the sample and is all that is sent to executors.

Null and empty texts have no words and no evidence. Without both labels all scores are 0.5. Repeated rows give repeated
results, an empty table an empty one; other columns are never looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm import arrow
from feedlake.llm.labelled import logistic, sample, sigmoid
from feedlake.llm.tables import written

#: Labelled documents to learn from, at most.
TRAIN_DOCS = 20000
#: Toxic training documents that must hold a word before it can score on its own.
LEAST_DOCS = 3
#: How many standard deviations from 0 log-odds are significant, and the log-odds that count at least.
DEVIATIONS, LEAST_ODDS = 4.0, 1.0
#: Lengths in bytes of the beginnings of words that are counted, and the mark that ends one.
STEMS, STEM = (3, 4, 5, 6, 7), b"-"
#: Words whose score a worker remembers.
REMEMBERED = 1 << 18
SIGNIFICANT = 0.05

_SPACED = bytes(byte + 32 if 0x41 <= byte <= 0x5A else byte if 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20 for byte in range(256))


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters; characters beyond ASCII count as letters."""
    return text.translate(_SPACED).split()


def keys(word: bytes) -> list[bytes]:
    """A word and its proper beginnings, as they are counted."""
    return [word, *(word[:size] + STEM for size in STEMS if size < len(word))]


def maximal_segments(scores: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a word sequence; linear in the words that score.

    `scores` holds position and score of the words that score on their own; every other word scores `other`, below 0.
    """
    # Start, end, sum before the start, sum up to the end, and the nearest earlier segment with a lower sum before it.
    kept: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for position, value in scores:
        total += (position - at) * other
        at = position + 1
        start, end, left, right = position, position + 1, total, total + value
        total = right
        while True:
            back = len(kept) - 1
            while back >= 0 and kept[back][2] >= left:
                back = kept[back][4]
            if back < 0 or kept[back][3] >= right:
                break
            start, left = kept[back][0], kept[back][2]
            del kept[back:]
        kept.append((start, end, left, right, back))
    return [(start, end, right - left) for start, end, left, right, _ in kept]


@dataclass
class Model:
    lexicon: dict[bytes, float]
    other: float
    rate: float
    scale: float
    curve: np.ndarray
    known: dict = field(default_factory=dict)

    def scoring(self, own: list[bytes]) -> list[tuple[int, float]]:
        """Position and score of the words that score on their own."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(own).difference(known):
            known[word] = max((self.lexicon[key] for key in keys(word) if key in self.lexicon), default=None)
        return [(at, value) for at, value in enumerate(map(known.__getitem__, own)) if value is not None]

    def passages(self, own: list[bytes]) -> list[tuple[int, int, float, float]]:
        """Significant toxic passages: first word, end, score, and the expected number of equals by chance."""
        scoring = self.scoring(own)
        found = []
        for start, end, value in maximal_segments(scoring, self.other) if scoring else ():
            expected = self.scale * len(own) * math.exp(-self.rate * value)
            if expected < SIGNIFICANT:
                found.append((start, end, value, expected))
        return found

    def evidence(self, own: list[bytes]) -> float:
        return math.log1p(sum(-math.log(max(expected, 1e-300)) for *_, expected in self.passages(own)))


def _counted(df: DataFrame, fold, ddl: str, by: list[str]) -> DataFrame:
    """Counts that `fold` makes of a task's slices, a dictionary from keys to numbers, summed over all tasks."""
    schema = arrow.arrow_schema(ddl)

    def count(batches):
        rows = fold(arrow.slices(batches, "text"))
        for start in range(0, len(rows), 1 << 16):
            columns = zip(*rows[start : start + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(c, kind.type) for c, kind in zip(columns, schema)], schema=schema)

    counted = df.mapInArrow(count, ddl)
    return counted.groupBy(*by).agg(*[F.sum(name).alias(name) for name in counted.columns if name not in by])


def label_counts(chosen: DataFrame) -> DataFrame:
    """(word, toxic, clean, toxic_docs): documents' words by label, and words and beginnings among them; the empty word stands for all."""

    def fold(parts):
        counts = {0: Counter(), 1: Counter()}
        in_docs: Counter = Counter()
        for part in parts:
            for label, text in zip(part.column("label").to_pylist(), arrow.texts(part)):
                own = set(words(text))
                counts[label].update(own)
                counts[label][b""] += len(own)
                if label:
                    in_docs.update({key for word in own for key in keys(word)})
        spread = {label: Counter() for label in counts}
        for label, of_label in counts.items():
            for word, n in of_label.items():
                for key in keys(word) if word else (b"",):
                    spread[label][key] += n
        return [(word, spread[1][word], spread[0][word], in_docs[word]) for word in spread[0].keys() | spread[1].keys()]

    return _counted(chosen.select("text", "label"), fold, "word binary, toxic long, clean long, toxic_docs long", ["word"])


def corpus_counts(docs: DataFrame, vocabulary: set[bytes]) -> DataFrame:
    """(word, n_words): these words and beginnings in all documents; the empty word stands for all words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def fold(parts):
        wanted = shared.value
        total: Counter = Counter()
        for part in parts:
            counted: Counter = Counter()
            for text in arrow.texts(part):
                counted.update(set(words(text)))
            total[b""] += counted.total()
            for word, n in counted.items():
                for key in keys(word):
                    if key in wanted:
                        total[key] += n
        return list(total.items())

    return _counted(docs.select("text"), fold, "word binary, n_words long", ["word"])


def _rate(probabilities: np.ndarray, scores: np.ndarray) -> float:
    """The positive root of sum p exp(rate s) = 1; the mean score is negative and one score positive."""
    low, high = 0.0, 1.0
    total = lambda rate: float((probabilities * np.exp(np.clip(rate * scores, -700, 700))).sum())
    while total(high) < 1 and high < 1e6:
        low, high = high, high * 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return max(high, 1e-6)


def fit(docs: DataFrame, labels: DataFrame, training, label: str = "toxic", rows: int = TRAIN_DOCS) -> Model | None:
    """A model of the labelled documents for which `training` holds; None without both labels among them."""
    chosen = sample(docs, labels, label, training, rows, "toxic-sample")
    totals = {row["label"]: row["n"] for row in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    counted = written(label_counts(chosen), "toxic-counts")
    n_toxic, n_clean = counted.where(F.col("word") == F.lit(b"")).select("toxic", "clean").first()
    # Only what is twice as frequent in toxic text can become significant, whatever its prior.
    likelier = F.col("toxic") * F.lit(n_clean) > 2 * F.col("clean") * F.lit(n_toxic)
    table = counted.where((F.col("word") != F.lit(b"")) & (F.col("toxic_docs") >= LEAST_DOCS) & likelier).orderBy("word").toArrow()
    seen = {word: (toxic, clean) for word, toxic, clean in zip(*(table[name].to_pylist() for name in ("word", "toxic", "clean")))}
    background = corpus_counts(docs, set(seen)).toArrow()
    everywhere = dict(zip(background["word"].to_pylist(), background["n_words"].to_pylist()))
    n_all = max(everywhere.pop(b"", 1), 1)

    def odds(toxic: float, clean: float, share: float) -> tuple[float, float]:
        """Log-odds of a word and their standard deviation under the prior."""
        prior = max(share * n_toxic, 0.01)
        inside, outside = toxic + prior, clean + prior
        value = math.log(inside / max(2 * n_toxic - inside, 1e-9)) - math.log(outside / max(n_clean + n_toxic - outside, 1e-9))
        return value, math.sqrt(1 / inside + 1 / outside)

    lexicon = {}
    for word, (toxic, clean) in seen.items():
        value, deviation = odds(toxic, clean, everywhere.get(word, 0) / n_all)
        if value > LEAST_ODDS and value > DEVIATIONS * deviation:
            lexicon[word] = value
    values, of_value = np.unique(np.array([*lexicon.values()]), return_inverse=True)
    clean = np.bincount(of_value, [seen[word][1] for word in lexicon], len(values)) if lexicon else np.zeros(0)
    shares = (clean + 0.5) / (n_clean + 0.5 * (len(values) + 1))
    rest = max(1 - shares.sum(), 1e-6)
    in_toxic = sum(seen[word][0] for word in lexicon) / max(n_toxic, 1)
    other = min(math.log(max(1 - in_toxic, 0.5) / rest), -0.05)
    model = Model(lexicon, other, 1.0, 1.0, np.zeros(2))
    if lexicon:
        model.rate = _rate(np.array([*shares, rest]), np.array([*values, other]))
        model.scale = _scale(chosen, model, n_clean)
    graded = arrow.per_text(chosen, "evidence double", lambda: _evidence(model), ["label"]).groupBy("label", "evidence").agg(F.count("*").alias("n")).toArrow()
    x, n = graded["evidence"].to_numpy(), graded["n"].to_numpy()
    model.curve = logistic(np.column_stack([x, np.ones(len(x))]), graded["label"].to_numpy(), 1e-2, n)
    return model


def _evidence(model: Model):
    return lambda values: {"evidence": [model.evidence(words(value)) for value in values]}


def _scale(chosen: DataFrame, model: Model, n_clean: int) -> float:
    """K: segments above the lowest scoring word in clean training documents, against what exp(-rate s) alone gives."""
    least = min(model.lexicon.values())

    def make():
        def count(values: list[bytes]) -> dict:
            made = []
            for value in values:
                own = words(value)
                made.append(sum(s >= least for *_, s in maximal_segments(model.scoring(own), model.other)))
            return {"n_segments": made}

        return count

    found = arrow.per_text(chosen.where("label = 0"), "n_segments long", make, []).agg(F.sum("n_segments")).first()[0] or 0
    return (found + 0.5) / (max(n_clean, 1) * math.exp(-model.rate * least))


def score(docs: DataFrame, model: Model | None, keep: list[str], name: str = "score", text: str = "text") -> DataFrame:
    """The kept columns, the toxicity score, and the passages as (first word, end, score, expected by chance)."""

    def make():
        def scores(values: list[bytes]) -> dict:
            if model is None:
                return {name: [0.5] * len(values), "passages": [[] for _ in values]}
            found = [model.passages(words(value)) for value in values]
            evidence = np.array([math.log1p(sum(-math.log(max(e, 1e-300)) for *_, e in passages)) for passages in found])
            told = [[dict(zip(("start", "end", "score", "expected"), passage)) for passage in passages] for passages in found]
            return {name: sigmoid(evidence * model.curve[0] + model.curve[1]), "passages": told}

        return scores

    return arrow.per_text(docs, f"{name} double, passages array<struct<start:int,end:int,score:double,expected:double>>", make, keep, text)
