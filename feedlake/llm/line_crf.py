"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's features are shares of character classes, word lengths, words that repeat the one
before and lines seen before in the document; its state also sees the features of the neighbouring lines, and
neighbouring states influence each other. Lines inherit the label of their document for training. The marginals from
the forward-backward pass are averaged by line length, and a logistic curve turns the average into the score.

Training uses a bounded sample of labelled documents (`TRAIN_DOCS`), whose line features are the only thing that
comes to the driver. All documents are scored whole, one after another, without a shuffle.

Null and empty texts have one empty line and get the score of that line. Without any usable label all scores are 0.5.
Repeated rows give repeated results, an empty table an empty one; other columns are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm import arrow
from feedlake.llm.labelled import logistic, sample, sigmoid

#: Labelled documents to learn from, at most; with some 15 lines each they are a few MB of features.
TRAIN_DOCS = 4000
STEPS, RATE, RIDGE = 200, 0.1, 1e-3

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "symbol": b"#$%&*@^~=+_<>{}[]\\/`", "bar": b"|", "mark": b"!?", "stop": b".,;:'\"()-", "space": b" \t\r\x0b\x0c",
}
_OTHER = len(_CLASSES)
_CLASS_OF = np.full(256, _OTHER, dtype=np.uint8)
for _number, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[np.frombuffer(_bytes, dtype=np.uint8)] = _number
_SPACE = list(_CLASSES).index("space")
#: Multiplier of the running hash by which words are compared.
_BASE = np.uint32(0x01000193)
N_FEATURES = 16


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line, and the lines' lengths in bytes."""
    lines = text.split(b"\n")
    data = np.frombuffer(text + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts
    size = np.maximum(lengths, 1)
    kind = _CLASS_OF[data]
    kind[ends] = _SPACE
    shares = np.empty((len(ends), _OTHER + 1), dtype=np.float32)
    for number in range(_OTHER + 1):
        shares[:, number] = np.add.reduceat(kind == number, starts, dtype=np.int32) / size
    # Words by their bounds, and whether each equals the word before it in its line.
    blank = kind == _SPACE
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    first, last = edge[::2], edge[1::2]
    of_line = np.searchsorted(ends, first)
    n_words = np.bincount(of_line, minlength=len(ends))
    repeats = np.zeros(len(ends))
    if len(first) > 1:
        powers = np.cumprod(np.full(len(data), _BASE, dtype=np.uint32), dtype=np.uint32)
        running = np.concatenate([np.zeros(1, np.uint32), np.cumsum(data * powers, dtype=np.uint32)])
        spelled = running[last] - running[first]
        length = last - first
        shift = powers[first[1:] - first[:-1] - 1]
        same = (length[1:] == length[:-1]) & (of_line[1:] == of_line[:-1]) & (spelled[:-1] * shift == spelled[1:])
        repeats = np.bincount(of_line[1:][same], minlength=len(ends))
    seen: set[bytes] = set()
    again = np.zeros(len(ends), dtype=np.float32)
    for number, line in enumerate(lines):
        again[number] = line in seen and bool(line)
        seen.add(line)
    words = np.maximum(n_words, 1)
    word_length = (lengths * (1 - shares[:, _SPACE])) / words
    features = np.column_stack(
        [
            shares, np.log1p(lengths) / 8, word_length / 16, repeats / words, repeats > 0.1 * words,
            again, lengths == 0, shares[:, list(_CLASSES).index("symbol")] > 0.05,
        ]
    ).astype(np.float32)
    return features, lengths


def with_neighbours(features: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zero at the ends), whether at an end, and a constant."""
    n = len(features)
    wide = np.zeros((n, 3 * N_FEATURES + 3), dtype=np.float32)
    wide[:, :N_FEATURES] = features
    wide[1:, N_FEATURES : 2 * N_FEATURES] = features[:-1]
    wide[:-1, 2 * N_FEATURES : 3 * N_FEATURES] = features[1:]
    wide[0, -3], wide[-1, -2], wide[:, -1] = 1, 1, 1
    return wide


def forward_backward(unary: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of the good state, expected transitions, and log partitions of many chains at once.

    `unary` is the log-odds of good, chain after chain; `transition` is 2 by 2 in log space.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    n, longest = len(sizes), int(sizes[0]) if len(sizes) else 0
    step = np.exp(transition)
    alpha = np.empty((len(unary), 2))
    scale = np.empty(len(unary))
    weight = np.column_stack([np.exp(-np.maximum(unary, 0)), np.exp(np.minimum(unary, 0))])
    log_z = np.zeros(n)
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    state = None
    for at in range(longest):
        rows = starts[: active[at]] + at
        state = weight[rows] if at == 0 else (state[: active[at]] @ step) * weight[rows]
        total = state.sum(axis=1)
        state /= total[:, None]
        alpha[rows], scale[rows] = state, total
        log_z[: active[at]] += np.log(total)
    log_z_by_chain = np.empty(n)
    log_z_by_chain[order] = log_z
    log_z_by_chain += np.add.reduceat(np.maximum(unary, 0), np.cumsum(lengths) - lengths)
    marginal = np.empty(len(unary))
    expected = np.zeros((2, 2))
    beta = np.ones((n, 2))
    for at in range(longest - 1, -1, -1):
        rows = starts[: active[at]] + at
        both = alpha[rows] * beta[: active[at]]
        marginal[rows] = both[:, 1] / both.sum(axis=1)
        if at:
            inward = weight[rows] * beta[: active[at]] / scale[rows][:, None]
            expected += (alpha[rows - 1].T @ inward) * step
            beta[: active[at]] = inward @ step.T
    return marginal, expected, log_z_by_chain


@dataclass
class Model:
    weights: np.ndarray
    transition: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    curve: np.ndarray


def _average(marginal: np.ndarray, line_lengths: np.ndarray, chains: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the marginals of each chain, as log-odds."""
    starts = np.cumsum(chains) - chains
    weight = line_lengths + 1.0
    mean = np.add.reduceat(marginal * weight, starts) / np.add.reduceat(weight, starts)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def train(wide: np.ndarray, line_lengths: np.ndarray, chains: np.ndarray, labels: np.ndarray) -> Model:
    """Fit by gradient steps (Adam) on the mean log-likelihood of the lines' inherited labels."""
    centre, spread = wide.mean(axis=0), wide.std(axis=0)
    centre[-1], spread[-1] = 0, 1
    spread[spread < 1e-4] = 1
    x = (wide - centre) / spread
    y = np.repeat(labels, chains).astype(float)
    joint = np.zeros((2, 2))
    for value in (0, 1):
        joint[value, value] = (chains[labels == value] - 1).sum()
    theta = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for number in range(1, STEPS + 1):
        marginal, expected, _ = forward_backward(x @ theta[:-4], chains, theta[-4:].reshape(2, 2))
        gradient = np.concatenate([x.T @ (marginal - y), (expected - joint).ravel()]) / len(y) + RIDGE * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= RATE * (first / (1 - 0.9**number)) / (np.sqrt(second / (1 - 0.99**number)) + 1e-8)
    model = Model(theta[:-4], theta[-4:].reshape(2, 2), centre, spread, np.zeros(2))
    marginal, _, _ = forward_backward(x @ model.weights, chains, model.transition)
    odds = _average(marginal, line_lengths, chains)
    model.curve = logistic(np.column_stack([odds, np.ones(len(odds))]), labels)
    return model


def fit(docs: DataFrame, labels: DataFrame, training, label: str = "quality", rows: int = TRAIN_DOCS) -> Model | None:
    """A model of the labelled documents for which `training` holds; None without both labels among them."""
    ddl = "label int, n_lines int, lengths array<int>, features binary"
    schema = arrow.arrow_schema(ddl)

    def featured(batches):
        for part in arrow.slices(batches, "text"):
            made = [line_features(value) for value in arrow.texts(part)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("label").cast(pa.int32()), pa.array([len(f) for f, _ in made], pa.int32()),
                    pa.array([n for _, n in made], pa.list_(pa.int32())),
                    pa.array([f.tobytes() for f, _ in made], pa.binary()),
                ],
                schema=schema,
            )

    chosen = sample(docs, labels, label, training, rows, "quality-sample")
    rows_of = chosen.orderBy("doc_id", F.xxhash64("text")).select("label", "text").mapInArrow(featured, ddl).toArrow()
    answers = rows_of["label"].to_numpy()
    if len(set(answers.tolist())) < 2:
        return None
    chains = rows_of["n_lines"].to_numpy().astype(np.int64)
    parts = [np.frombuffer(data, dtype=np.float32).reshape(-1, N_FEATURES) for data in rows_of["features"].to_pylist()]
    wide = np.concatenate([with_neighbours(part) for part in parts])
    lengths = np.concatenate([np.asarray(part) for part in rows_of["lengths"].to_pylist()])
    return train(wide, lengths, chains, answers)


def score(docs: DataFrame, model: Model | None, keep: list[str], name: str = "score", text: str = "text") -> DataFrame:
    """The kept columns and the quality score of each document."""

    def make():
        def scores(values: list[bytes]) -> dict:
            if model is None:
                return {name: [0.5] * len(values)}
            made = [line_features(value) for value in values]
            chains = np.array([len(features) for features, _ in made])
            lengths = np.concatenate([n for _, n in made])
            unary = np.concatenate([((with_neighbours(f) - model.centre) / model.spread) @ model.weights for f, _ in made])
            marginal, _, _ = forward_backward(unary, chains, model.transition)
            odds = _average(marginal, lengths, chains)
            return {name: sigmoid(odds * model.curve[0] + model.curve[1])}

        return scores

    return arrow.per_text(docs, f"{name} double", make, keep, text)


def line_marginals(text: bytes, model: Model) -> np.ndarray:
    """The probability of good for every line of one text."""
    features, _ = line_features(text)
    unary = ((with_neighbours(features) - model.centre) / model.spread) @ model.weights
    return forward_backward(unary, np.array([len(features)]), model.transition)[0]
