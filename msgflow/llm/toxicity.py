"""Toxic passages by maximum-scoring segment search.

1. Words are scored by their log odds between toxic and other labelled documents, with a Dirichlet prior that follows the
   rates of all of them. A word whose log odds is significant (signed root of the likelihood ratio statistic above
   ``SIGNIFICANT``) scores so much; a word that is not takes that of its longest beginning (of ``STEMS`` letters) that is, or else costs ``DRIFT``.
2. A linear scan finds all maximal segments of positive total, each bounded by the passages around it (disjoint segments
   such that no extension scores more). Runs of words at DRIFT are one step.
3. The best segment of n background words scores x or more with probability 1 - exp(-E), E = K n exp(-lambda x): lambda
   solves E0[exp(lambda s)] = 1 over the words of the other documents, K is fitted to their segments. A logistic curve
   over -log10 of that turns the passage's significance into the share of labels that are 1.

The table of scores is fitted to a bounded sample of labelled rows, ``per_class`` of each label (least hash of id and
text), so its size is bounded too; it goes to the tasks with the code. Every whole text is scanned.

A null or empty text has no segment and scores like any text without one. Unlabelled rows and null labels teach nothing;
where either label is missing all scores are 0. Labels of one id that disagree count once each. Equal texts get equal
scores. Extra columns are returned unchanged if asked for, unless named as a result column. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.llm.common import stored, text_of, uniform

LETTERS = re.compile(r"[^\W\d_]+")
STEMS = (8, 7, 6, 5, 4, 3)
SIGNIFICANT = 5.0
PRIOR = 500.0  # pseudo-counts of all words together
LEAST = 5  # toxic documents that a word must be in
DRIFT = 0.1
MEMO = 300_000  # words that a task remembers or counts at once
TOXIC_COLUMNS = ("score", "predicted", "segments")
SEGMENTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    decay: float = 1.0
    scale: float = 1e-6
    intercept: float = -20.0
    slope: float = 0.0

    def significance(self, best: float, n: int) -> float:
        """-log10 of the chance that n background words have a segment as good."""
        if best <= 0:
            return 0.0
        log_e = math.log(self.scale * max(n, 1)) - self.decay * best
        chance = -math.expm1(-math.exp(min(log_e, 50.0)))
        return -log_e / math.log(10) if log_e < -30 else -math.log10(max(chance, 1e-300))

    def probability(self, best: float, n: int) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.intercept + self.slope * self.significance(best, n)))))


def maximal_segments(steps: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of positive steps (start, end, score) with drift between them, in linear time.

    A candidate keeps the running total left of it and at its end. It looks back for the nearest candidate that starts
    lower; if that one ends lower too, the two and what is between are one better segment.
    """
    found: list[list] = []  # start, end, total before, total after, index of the nearest candidate that starts lower
    total, at = 0.0, 0
    for start, end, score in steps:
        total -= DRIFT * (start - at)
        new = [start, end, total, total + score, -1]
        total, at = total + score, end
        while True:
            back = len(found) - 1
            while back >= 0 and found[back][2] >= new[2]:
                back = found[back][4]
            if back < 0 or found[back][3] >= new[3]:
                new[4] = back
                found.append(new)
                break
            new = [found[back][0], new[1], found[back][2], new[3], -1]
            del found[back:]
    return [(s, e, after - before) for s, e, before, after, _ in found]


class Scanner:
    """Scores of words, remembered within a task."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def score(self, word: str) -> float:
        value = self.model.words.get(word)
        if value is None:
            begins = (self.model.stems.get(word[:k]) for k in STEMS if len(word) >= k)
            value = next((v for v in begins if v is not None), 0.0)
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[word] = value
        return value

    def scan(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """Maximal segments (first word, word after the last, score) and the number of words."""
        tokens = LETTERS.findall((text or "").lower())
        known, fresh = self.memo.get, self.score
        hits = []
        for at, word in enumerate(tokens):
            value = known(word)
            if value is None:
                value = fresh(word)
            if value:
                hits.append((at, at + 1, value))
        return maximal_segments(hits), len(tokens)


def log_odds(one: int, other: int, n_one: float, n_other: float) -> float:
    """Log odds ratio of a word under a Dirichlet prior at its rate in both together."""
    prior = PRIOR * (one + other) / (n_one + n_other)
    a, b = one + prior, other + prior
    return math.log(a / (n_one + PRIOR - a)) - math.log(b / (n_other + PRIOR - b))


def evidence(one: Column, other: Column, n_one: float, n_other: float) -> Column:
    """Root of the likelihood ratio statistic of two rates; 0 where the first is the lower."""
    rate = (one + other) / F.lit(n_one + n_other)
    parts = [F.when(k > 0, k * F.log(k / (n * rate))).otherwise(0.0) for k, n in ((one, n_one), (other, n_other))]
    return F.when(one / n_one > rate, F.sqrt(F.greatest(2 * sum(parts), F.lit(0.0)))).otherwise(0.0)


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton steps, slightly ridged; the slope is not negative."""
    w = np.array([math.log((y.sum() + 1) / (len(y) - y.sum() + 1)), 0.0])
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = design.T @ (design * (p * (1 - p))[:, None]) + np.diag([1e-3, 1e-1])
        w = w + np.linalg.solve(h, design.T @ (y - p) - np.array([0.0, 1e-1]) * w)
    return float(w[0]), float(max(w[1], 0.0))


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 5_000) -> Model | None:
    """Fit to labelled documents that ``learn`` (a condition on doc_id) admits. ``labels`` has doc_id and toxic."""
    marked = labels.where(F.coalesce(learn, F.lit(False)) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    share = {k: min(1.0, per_class / n) for k, n in counts.items()}
    draw = uniform(F.lit("toxic"), F.col("doc_id").cast("string"))
    bound = F.when(F.col("toxic") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    # Some 2 * per_class ids: small enough for any task.
    chosen = F.broadcast(marked.where(draw < bound))
    sample = docs.select("doc_id", text_of(F.col("text")).alias("text")).join(chosen, "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            names = list(dict.fromkeys([*tally[0], *tally[1]]))
            counts = [pa.array([t[w] for w in names], pa.int64()) for t in tally]
            for t in tally:
                t.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["word", "other", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"].to_pylist()):
                found = set(LETTERS.findall(text.as_py().lower()))
                tally[toxic].update(found)
                for k in STEMS:
                    tally[toxic].update({f"{w[:k]}*" for w in found if len(w) >= k})
                tally[toxic][""] += len(found)
                if len(tally[0]) + len(tally[1]) >= MEMO:
                    yield flush()
        yield flush()

    tally = sample.select("text", "toxic").mapInArrow(count, "word string, other long, toxic long")
    tally = tally.groupBy("word").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    # The sums over all words have the empty name.
    tally = stored(tally.where((F.col("word") == "") | (F.col("toxic") >= LEAST)), "toxic-words")
    sums = tally.where(F.col("word") == "").first()
    n_one, n_other = float(sums["toxic"]), float(sums["other"])
    if not n_one or not n_other:
        return None
    clear = evidence(F.col("toxic"), F.col("other"), n_one, n_other) > SIGNIFICANT
    found = tally.where(clear & (F.col("word") != "")).collect()
    scores = {r["word"]: log_odds(r["toxic"], r["other"], n_one, n_other) for r in found}
    words = {w: s for w, s in scores.items() if not w.endswith("*")}
    stems = {w[:-1]: s for w, s in scores.items() if w.endswith("*")}
    model = Model(words, stems)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        for batch in batches:
            rows = [scanner.scan(x.as_py()) for x in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["toxic"].cast(pa.int32()),
                    pa.array([n for _, n in rows], pa.int64()),
                    pa.array([[s for *_, s in found] for found, _ in rows], pa.list_(pa.float64())),
                ],
                ["toxic", "n", "scores"],
            )

    scanned = sample.select("text", "toxic").mapInArrow(scan, "toxic int, n long, scores array<double>").collect()
    clean = [r for r in scanned if r["toxic"] == 0]
    n_clean = sum(r["n"] for r in clean) + 1
    hits = [s for r in clean for s in r["scores"]]
    # lambda: hits at their rate, drift elsewhere. Bisection; the sum is below 1 before the root and above behind it.
    rates = hits or [max([*words.values(), *stems.values(), 1.0])]
    low, high = 1e-3, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        total = sum(math.exp(min(middle * s, 500.0)) for s in rates) / n_clean + math.exp(-DRIFT * middle)
        low, high = (middle, high) if total < 1 else (low, middle)
    model.decay = low
    expected = sum(r["n"] for r in clean) * math.exp(-low * min(rates)) or 1.0
    model.scale = max(len(hits), 0.5) / expected
    x = np.array([model.significance(max(r["scores"], default=0.0), r["n"]) for r in scanned])
    y = np.array([float(r["toxic"]) for r in scanned])
    # Back to the shares of all labelled rows: a class sampled in part weighs more.
    model.intercept, model.slope = _fit_curve(np.minimum(x, 50.0), y)
    model.intercept += math.log(share[0] / share[1])
    return model


def detect(docs: DataFrame, model: Model | None, threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (text and the columns to keep, doc_id if not given) with score, predicted and segments.

    Segments are (start, end, score) in words, end not included.
    """
    keep = ["doc_id"] if keep is None else [c for c in keep if c not in TOXIC_COLUMNS]
    source = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    kept = [f for f in source.schema if f.name != "_text"]
    schema = T.StructType(
        [
            *kept,
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
            T.StructField("segments", SEGMENTS),
        ]
    )
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model or Model({}, {}))
        for batch in batches:
            scores, found = [], []
            for x in batch.column(batch.num_columns - 1):
                segments, n = scanner.scan(x.as_py())
                best = max((s for *_, s in segments), default=0.0)
                scores.append(model.probability(best, n) if model else 0.0)
                found.append([{"start": s, "end": e, "score": v} for s, e, v in segments])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                    pa.array(found, arrow),
                ],
                [f.name for f in schema],
            )

    return source.mapInArrow(run, schema)
