"""Toxicity scores from a factorization machine over hashed terms.

Terms of a text are its words in lower case, without marks around them, and the first 4 and 5 characters of
longer words; each is hashed to one of 2**BITS places. The machine adds a weight for each term and, for each
pair of terms, the product of their factor vectors, so a pair (an insult with a group's name) can weigh more
or less than its terms alone. Weights and factors are fitted together on a bounded sample of labelled documents, and
scores are calibrated on a fifth of it that is kept apart; every document is scored from its whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.llm.tables import chunks

BITS = 18
FACTORS = 4
#: The bound of the sample that the machine is fitted on: this many labelled documents at most, taken in the
#: order of a hash of the id.
SAMPLE = 20_000
EPOCHS = 8
PREFIXES = (4, 5)
WORD = re.compile(r"[^\W\d_]+")


class Terms(dict):
    """Places of a word's terms, remembered for the words met so far (at most ``most``)."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> tuple[int, ...]:
        from xxhash import xxh64_intdigest

        parts = [f"w {word}", *(f"{n} {word[:n]}" for n in PREFIXES if len(word) >= n)]
        places = tuple(xxh64_intdigest(p) & ((1 << BITS) - 1) for p in parts)
        if len(self) >= self.most:
            self.clear()
        self[word] = places
        return places


def terms_of(text: str | None, known: Terms) -> np.ndarray:
    """The different places of a text's terms, in order."""
    words = set(WORD.findall((text or "").lower()))
    return np.unique(np.fromiter((p for w in words for p in known[w]), np.int32))


class Machine:
    """score = sigmoid(bias + weights of the terms + products of their factors, these over 1 + the sum of squared inputs).

    A factor is stored times its term's input; ``inputs`` say how much a term can count in pairs.
    """

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray, inputs: np.ndarray):
        self.bias, self.weights, self.factors, self.inputs = bias, weights, factors, inputs

    def alone(self, places: np.ndarray) -> float:
        """What the terms say one by one."""
        return self.bias + float(self.weights[places].sum())

    def pairs(self, places: np.ndarray) -> float:
        """The sum over all pairs of different terms, from the sum of their factors."""
        own, inputs = self.factors[places], self.inputs[places]
        total = own.sum(0)
        return 0.5 * float(total @ total - (own * own).sum()) / (1.0 + float(inputs @ inputs))

    def raw(self, places: np.ndarray) -> float:
        return self.alone(places) + self.pairs(places)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


#: Steps for the weights and the factors, the pull to zero of both, and what smooths a term's ratio of kinds.
STEP, FACTOR_STEP, PULL, FACTOR_PULL, SMOOTH = 0.005, 0.3, 1e-3, 1e-2, 10
#: Toxic rows weigh at most so much in the fit, and in the calibration.
POSITIVE_WEIGHT, CALIBRATION_WEIGHT = 4.0, 2.0
#: The spread that factors start with, and the most that a step moves one.
START, MOST = 0.3, 0.2
#: Inputs of pairs: a term counts by its own ratio of kinds up to CAP, and by its rarity up to FLOOR, as two terms that
#: say nothing alone can do so together; terms of fewer than LEAST documents of the sample are in no pair.
CAP, FLOOR, LEAST = 3.0, 0.5, 5
#: One of so many documents of the sample is kept for the calibration.
CALIBRATION = 5


def term_scales(rows: list[np.ndarray], truth: np.ndarray) -> np.ndarray:
    """How much each term counts: the size of its log ratio between the kinds, smoothed so that rare terms count little."""
    n, bad = len(truth), int((truth == 1).sum())
    count = lambda kind: np.bincount(np.concatenate([np.zeros(0, np.int32), *(x for x, y in zip(rows, truth) if y == kind)]), minlength=1 << BITS)
    with_bad, with_good = count(1), count(0)
    ratio = np.log((with_bad + SMOOTH * bad / n) / (bad + SMOOTH)) - np.log((with_good + SMOOTH * (n - bad) / n) / (n - bad + SMOOTH))
    return np.abs(ratio).astype(np.float32)


def pair_inputs(rows: list[np.ndarray], scales: np.ndarray) -> np.ndarray:
    held = np.bincount(np.concatenate([np.zeros(0, np.int32), *rows]), minlength=1 << BITS)
    n = max(len(rows), 1)
    rarity = np.log(n / np.maximum(held, 1)) / max(1.0, np.log(n / LEAST))
    return np.where(held >= LEAST, np.minimum(scales, CAP) + FLOOR * rarity, 0).astype(np.float32)


def calibrated(raw: np.ndarray, truth: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift that make sigmoid(slope * raw + shift) likeliest, with the weight of toxic rows; Newton steps."""
    bad = int((truth == 1).sum())
    good = len(truth) - bad
    slope, shift = 1.0, 0.0
    if not good or not bad:
        return slope, shift
    # targets a little inside 0 and 1, so that kinds that are apart have an answer
    target = np.where(truth == 1, (bad + 1) / (bad + 2), 1 / (good + 2))
    weight = np.where(truth == 1, min(CALIBRATION_WEIGHT, max(1.0, good / bad)), 1.0)
    for _ in range(steps):
        guess = sigmoid(slope * raw + shift)
        miss, curve = weight * (guess - target), weight * guess * (1 - guess)
        matrix = np.array([[(curve * raw * raw).sum(), (curve * raw).sum()], [(curve * raw).sum(), curve.sum()]]) + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(matrix, [(miss * raw).sum(), miss.sum()]), -1, 1)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    # a model that says the opposite of the labels is no better turned round
    return (float(slope), float(shift)) if slope > 0 else (1.0, 0.0)


def fitted(rows: list[np.ndarray], truth: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Stochastic gradient steps for a fixed number of rounds; toxic rows, the rarer kind, weigh more.

    Without labels of both kinds the score is their constant rate.
    """
    random = np.random.Generator(np.random.PCG64(seed))
    places = 1 << BITS
    good, bad = int((truth == 0).sum()), int((truth == 1).sum())
    if not good or not bad:
        rate = (bad + 0.5) / (good + bad + 1) if good + bad else 0.25
        zeros = (np.zeros(shape, np.float32) for shape in (places, (places, FACTORS), places))
        return Machine(float(np.log(rate / (1 - rate))), *zeros)
    scales = term_scales(rows, truth)
    inputs = pair_inputs(rows, scales)
    weights = np.zeros(places, np.float32)
    factors = random.normal(0, START, (places, FACTORS)).astype(np.float32)
    bias, extra = float(np.log(bad / good)), min(POSITIVE_WEIGHT, max(1.0, good / bad))
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            x, y = rows[i], int(truth[i])
            if not len(x):
                continue
            scale, even = scales[x], inputs[x]
            even = (even / np.sqrt(1.0 + float(even @ even)))[:, None]
            own = factors[x] * even
            total = own.sum(0)
            guess = bias + float(weights[x] @ scale) + 0.5 * float(total @ total - (own * own).sum())
            miss = float(sigmoid(guess) - y) * (extra if y else 1.0)
            if abs(miss) < 1e-3:
                continue
            bias -= STEP * miss
            weights[x] -= STEP * (miss * scale + PULL * weights[x])
            factors[x] -= np.clip(FACTOR_STEP * (miss * (total - own) * even + FACTOR_PULL * factors[x]), -MOST, MOST)
    return Machine(bias, weights * scales, factors * inputs[:, None], inputs)


def fitted_and_calibrated(rows: list[np.ndarray], truth: np.ndarray) -> Machine:
    """Fitted on all but each CALIBRATION-th row, which tell slope and shift of its scores."""
    apart = np.arange(len(rows)) % CALIBRATION == CALIBRATION - 1
    model = fitted([r for r, kept in zip(rows, apart) if not kept], truth[~apart])
    raw = np.array([model.raw(r) for r, kept in zip(rows, apart) if kept])
    slope, shift = calibrated(raw, truth[apart])
    return Machine(slope * model.bias + shift, np.float32(slope) * model.weights, np.float32(slope**0.5) * model.factors, model.inputs)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE) -> Machine:
    """Fit on at most ``most`` labelled documents (``labels``: the id column and ``toxic`` 0 or 1).

    The sample is one task's work and has a fixed bound; rows with a null id, label or text are left out.
    """
    truth = labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    chosen = truth.distinct().orderBy(F.xxhash64("id"), "id", "toxic").limit(most)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).dropna()
    # the sample has a fixed bound, so it is sent to the documents and only its own rows are shuffled
    rows = rows.join(F.broadcast(chosen), "id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms()
        for batch in batches:
            terms = [terms_of(t, known).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(terms, pa.binary())], ["id", "toxic", "terms"])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat([pd.DataFrame({"id": [], "toxic": [], "terms": []}), *batches])
        sample = sample.sort_values(["id", "toxic", "terms"])[:most]
        model = fitted_and_calibrated([np.frombuffer(t, np.int32) for t in sample.terms], sample.toxic.to_numpy(np.int64))
        used = np.flatnonzero((model.weights != 0) | (model.inputs != 0))
        yield pd.DataFrame(
            {
                "bias": [model.bias],
                "places": [used.astype(np.int32).tobytes()],
                "weights": [model.weights[used].tobytes()],
                "factors": [model.factors[used].tobytes()],
                "inputs": [model.inputs[used].tobytes()],
            }
        )

    sample = rows.mapInArrow(hashed, "id long, toxic int, terms binary").repartition(1)
    found = sample.mapInPandas(fit, "bias double, places binary, weights binary, factors binary, inputs binary").first()
    model = fitted([], np.zeros(0))
    if found:
        model.bias = found.bias
        used = np.frombuffer(found.places, np.int32)
        model.weights[used] = np.frombuffer(found.weights, np.float32)
        model.factors[used] = np.frombuffer(found.factors, np.float32).reshape(-1, FACTORS)
        model.inputs[used] = np.frombuffer(found.inputs, np.float32)
    return model


def scored(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``score`` (0 to 1) of every row; a null or empty text gets the score of no terms.

    The machine that is sent to the tasks has a fixed size: (2 + FACTORS) * 4 * 2**BITS bytes, 6 MB.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights, model.factors, model.inputs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Machine(*sent.value), Terms()
        for batch in batches:
            for chunk in chunks(batch, "text"):
                raw = [own.raw(terms_of(t, known)) for t in chunk.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(sigmoid(np.array(raw, float)))], ["id", "score"])

    return rows.mapInArrow(score, "id long, score double")
