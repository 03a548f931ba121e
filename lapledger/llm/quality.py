"""Quality rules whose cutoffs keep the share of falsely rejected documents under a proven limit.

Method: risk-controlled thresholds. Labelled documents are the holdout (the rules themselves learn nothing).
For each stratum and rule, cutoffs are tested from lax to strict, as a fixed sequence that ends at the first
cutoff whose exact binomial test does not exclude a false-rejection rate over the limit. The error level is
shared between all strata and rules (Bonferroni). Of the cutoffs that pass, the one that rejects most bad and
fewest good labelled documents is taken; a stratum with too few labels proves nothing and its rule stays off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.llm.tables import Shelf, chunks
from lapledger.llm.words import run_hashes, word_hashes, words_of

#: Cutoffs are thousandths of a rule's value; LEVELS + 1 stands for a rule that is off.
LEVELS = 1000
RULES = ("symbols", "dup_lines", "repeats", "capitals")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATS = 20  # hundredths
#: A good document rejected by a rule costs as much as this many bad ones let through.
GOOD_WEIGHT = 10

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    seen, lines, repeated = set(), 0, 0
    for line in (text or "").split("\n"):
        if line.strip("\t\n\x0b\x0c\r "):
            lines += 1
            repeated += line in seen
            seen.add(line)
    return lines, repeated


def _repeats(runs: np.ndarray, n_words: int) -> int:
    """Words inside runs that are found twice or more."""
    if n_words <= WINDOW:
        return 0
    _, which, times = np.unique(runs, return_inverse=True, return_counts=True)
    edge = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(times[which] > 1)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def counts_of(texts: pa.Array) -> pd.DataFrame:
    words = words_of(texts)
    data, bounds, starts = words.data, words.bounds, words.text_starts
    n_words = np.diff(bounds)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    lead = inside & ((data & 0xC0) != 0x80)
    capital = (data >= 65) & (data <= 90)
    latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    capital[: len(latin)] |= latin
    runs = run_hashes(word_hashes(words), WINDOW)
    lines = [_lines(t) for t in texts.to_pylist()]
    frame = pd.DataFrame(
        {
            "n_words": n_words.astype(np.int64),
            "word_chars": _per_text(lead, starts),
            "n_symbols": _per_text(np.isin(data, list(SYMBOLS.encode())), starts),
            "n_dup_lines": np.array([x[1] for x in lines], np.int64),
            "n_repeat_words": np.array(
                [_repeats(runs[a : max(a, b - WINDOW + 1)], b - a) for a, b in zip(bounds[:-1], bounds[1:])], np.int64
            ),
        }
    )
    part = lambda x, of: np.clip(LEVELS * x // np.maximum(of, 1), 0, LEVELS).astype(np.int32)
    frame["symbols"] = part(frame.n_symbols, frame.n_words)
    frame["dup_lines"] = part(frame.n_dup_lines, np.array([x[0] for x in lines], np.int64))
    frame["repeats"] = part(frame.n_repeat_words, frame.n_words)
    frame["capitals"] = part(_per_text(capital, starts), frame.word_chars)
    return frame


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Counts and rule values of each document: ``id``, ``stratum`` (null: empty), the counts, one int per rule.

    A null text is empty. One row per row of ``docs``, whatever repeats; other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = f"id long, stratum string, {COUNTS}, " + ", ".join(f"{r} int" for r in RULES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                found = pa.RecordBatch.from_pandas(counts_of(chunk.column(2)), preserve_index=False)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), chunk.column(1), *found.columns], ["id", "stratum", *found.schema.names]
                )

    return rows.mapInArrow(count, schema).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATS * F.col("n_words")),
    )


def excludes(rejected: int, n: int, limit: float, level: float) -> bool:
    """Whether so few rejections of n would occur with at most this probability if the rate were the limit."""
    if n <= 0 or rejected >= n * limit:
        return False
    log = lambda k: (
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(limit) + (n - k) * math.log1p(-limit)
    )
    return math.fsum(math.exp(log(k)) for k in range(rejected + 1)) <= level


def cutoff_of(good: np.ndarray, bad: np.ndarray, limit: float, level: float) -> int:
    """The cutoff (values of at least it are rejected) from counts of labelled documents by value 0 to LEVELS."""
    n = int(good.sum())
    best, best_gain, wrong, right = LEVELS + 1, 0, 0, 0
    for cut in range(LEVELS, 0, -1):
        wrong += int(good[cut])
        right += int(bad[cut])
        if not excludes(wrong, n, limit, level):
            break
        if (gain := right - GOOD_WEIGHT * wrong) > best_gain:
            best, best_gain = cut, gain
    return best


def cutoffs(rated: DataFrame, labels: DataFrame, limit: float, level: float, strata: int) -> DataFrame:
    """A row for each labelled stratum: ``stratum`` and ``cut_<rule>``. Only counts by value leave the documents."""
    tests = max(1, strata) * len(RULES)
    labelled = (
        rated.filter(~F.col("base_failed"))
        .join(labels, "id")
        .select("stratum", "good", F.explode(F.create_map(*[x for r in RULES for x in (F.lit(r), F.col(r))])).alias("rule", "value"))
        .groupBy("stratum", "rule", "value")
        .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    )
    share, one = limit / len(RULES), level / tests

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        result = {"stratum": key[0]}
        for rule in RULES:
            own = rows[rows.rule == rule]
            good, bad = np.zeros(LEVELS + 1, np.int64), np.zeros(LEVELS + 1, np.int64)
            good[own.value], bad[own.value] = own.good, own.bad
            result[f"cut_{rule}"] = cutoff_of(good, bad, share, one)
        return pd.DataFrame([result])

    return labelled.groupBy("stratum").applyInPandas(choose, "stratum string, " + ", ".join(f"cut_{r} int" for r in RULES))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    limit: float = 0.04,
    level: float = 0.05,
) -> DataFrame:
    """The signals of each document, the cutoffs of its stratum and ``kept``.

    ``labels`` has the id column and ``quality`` (1 good, 0 bad); rows with a null in either are ignored, an id
    labelled both ways counts both times. With probability 1 - ``level`` at least, in every stratum all rules
    together reject at most the share ``limit`` of the good documents that pass the base rules. Rows with a null
    id are judged too. No labels, or no documents: only the base rules hold. Ties on a cutoff are rejected.
    """
    shelf = Shelf(docs.sparkSession, "quality")
    rated = shelf.put(signals(docs, id_col, text_col, stratum_col), "signals")
    truth = (
        labels.select(F.col(id_col).cast("long").alias("id"), (F.col("quality") == 1).cast("long").alias("good")).dropna().distinct()
    )
    strata = rated.select("stratum").distinct().count()
    chosen = cutoffs(rated, truth, limit, level, strata)
    over = [F.col(r) >= F.coalesce(F.col(f"cut_{r}"), F.lit(LEVELS + 1)) for r in RULES]
    rejected = over[0] | over[1] | over[2] | over[3]
    return rated.join(chosen, "stratum", "left").withColumn("kept", ~(F.col("base_failed") | rejected))
