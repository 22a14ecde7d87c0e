"""Language ID by a byte-level convolutional network, trained in numpy and applied to windows of fixed length.

Every text is cut into windows of ``LENGTH`` bytes (A-Z lower-cased); neighbours overlap by the widest filter less one,
so every n-gram of every byte is seen once. Bytes are embedded, filters of several widths slide over them, each keeps
its maximum over the window, and a softmax layer turns the maxima into class scores. The scores of a text are the mean
of its windows' log probabilities by bytes; the prediction is the best, its softmax the score.

Training uses a bounded sample: about ``per_class`` documents of each label, those least by a hash of id and text, and
``WINDOWS`` windows spread evenly over each. Labels are known by counting them, so the driver holds one row per label and
the sampled windows, nothing that grows with the input.

A null text, an empty text and one without a letter are `und` with score 0; so is everything where no row has a label.
With one label the score is 1. Labels that are null teach nothing. Equal texts get equal predictions, repeated rows too.
Extra columns are returned unchanged if asked for, unless named as a result column. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.llm.common import ASCII_LOWER, text_of, uniform

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 6
PAD = 256
WINDOWS = 4
BATCH = 256  # windows that go through the network at once
UNKNOWN = "und"
LANGUAGE_COLUMNS = ("lang_pred", "score")


@dataclass
class Model:
    classes: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]  # one (width * EMBED, FILTERS) each
    biases: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, list]:
        """Filter maxima of windows of byte ids, and what the gradient needs."""
        embedded = self.embed[ids]
        n = len(ids)
        maxima, traces = [], []
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases):
            places = LENGTH - width + 1
            view = np.lib.stride_tricks.sliding_window_view(embedded, width, axis=1).transpose(0, 1, 3, 2)
            columns = view.reshape(n * places, width * EMBED)
            scores = (columns @ weights).reshape(n, places, FILTERS)
            best = scores.argmax(1)
            top = np.take_along_axis(scores, best[:, None], 1)[:, 0] + bias
            maxima.append(np.maximum(top, 0))
            traces.append((columns, best, top, places))
        return np.concatenate(maxima, 1), traces

    def log_probabilities(self, ids: np.ndarray) -> np.ndarray:
        logits = self.pooled(ids)[0] @ self.dense + self.bias
        logits -= logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte ids of all windows of a text, and the bytes that each has to itself."""
    raw = np.frombuffer(text.translate(ASCII_LOWER).encode("utf-8", "replace"), dtype=np.uint8)
    stride = LENGTH - max(WIDTHS) + 1
    count = max(1, -(-(len(raw) - max(WIDTHS) + 1) // stride))
    ids = np.full((count - 1) * stride + LENGTH, PAD, dtype=np.int16)
    ids[: len(raw)] = raw[: len(ids)]
    cut = np.lib.stride_tricks.sliding_window_view(ids, LENGTH)[::stride]
    own = np.full(count, stride, dtype=np.float64)
    own[-1] = max(1, len(raw) - (count - 1) * stride)
    return cut, own


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def fit(ids: np.ndarray, labels: list[str], epochs: int = 12, seed: int = 7) -> Model:
    """Train on windows of byte ids. Adam, and a gradient that reaches each filter's best place only."""
    classes = sorted(set(labels))
    target = np.array([classes.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    wide = FILTERS * len(WIDTHS)
    params = [
        rng.normal(0, 0.5, (PAD + 1, EMBED)),
        *[rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)) for w in WIDTHS],
        *[np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.1, (wide, len(classes))),
        np.zeros(len(classes)),
    ]
    params = [p.astype(np.float32) for p in params]
    k = len(WIDTHS)
    model = Model(classes, params[0], params[1 : k + 1], params[k + 1 : 2 * k + 1], params[-2], params[-1])
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = len(target) / (len(classes) * np.bincount(target, minlength=len(classes)))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(target))
        for start in range(0, len(order), 64):
            part = order[start : start + 64]
            hidden, traces = model.pooled(ids[part])
            logits = hidden @ model.dense + model.bias
            shares = np.exp(logits - logits.max(1, keepdims=True))
            shares /= shares.sum(1, keepdims=True)
            shares[np.arange(len(part)), target[part]] -= 1
            delta = (shares * weight[target[part]][:, None] / len(part)).astype(np.float32)
            grads = [np.zeros_like(p) for p in params]
            grads[-2], grads[-1] = hidden.T @ delta, delta.sum(0)
            back = delta @ model.dense.T
            for i, (width, (columns, best, top, places)) in enumerate(zip(WIDTHS, traces)):
                flow = back[:, i * FILTERS : (i + 1) * FILTERS] * (top > 0)
                rows = np.arange(len(part))[:, None] * places + best
                grads[1 + i] = np.einsum("nfc,nf->cf", columns[rows], flow)
                grads[1 + k + i] = flow.sum(0)
                source = (flow[:, :, None] * model.filters[i].T[None]).reshape(len(part), FILTERS, width, EMBED)
                spots = ids[part][np.arange(len(part))[:, None, None], best[:, :, None] + np.arange(width)]
                np.add.at(grads[0], spots, source)
            step += 1
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, label: Column, learn: Column, per_class: int = 500) -> Model | None:
    """Fit to a sample of the documents (doc_id, text) that ``learn`` admits; None where none has a label and a letter."""
    rows = docs.select(
        text_of(F.col("text")).alias("text"),
        label.cast("string").alias("label"),
        uniform(F.col("doc_id").cast("string"), F.col("text")).alias("draw"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    ).where(F.col("learn") & F.col("label").isNotNull() & (F.col("text") != ""))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("label") == name, F.lit(min(1.0, per_class / n))).otherwise(share)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, bytes]] = []
            for text, name in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                if has_letter(text):
                    cut, _ = windows(text)
                    spread = np.unique(np.linspace(0, len(cut) - 1, WINDOWS).astype(int))
                    out += [(name, cut[i].astype("<i2").tobytes()) for i in spread]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], ["label", "ids"]
            )

    # At most WINDOWS * per_class windows of a label, but for chance.
    found = rows.where(F.col("draw") < share).select("text", "label").mapInArrow(sample, "label string, ids binary")
    found = sorted((r["label"], bytes(r["ids"])) for r in found.collect())
    if not found:
        return None
    ids = np.frombuffer(b"".join(x[1] for x in found), dtype="<i2").reshape(-1, LENGTH)
    return fit(ids, [x[0] for x in found])


def predict_texts(model: Model | None, texts: Iterator[str | None]) -> tuple[list[str], list[float]]:
    """Predictions of texts in order. Windows of several texts share a run of the network; long texts take several."""
    totals: list[np.ndarray | None] = []
    pending: list[tuple[int, np.ndarray, np.ndarray]] = []
    waiting = 0

    def run() -> None:
        nonlocal pending, waiting
        if not pending:
            return
        ids = np.concatenate([x[1] for x in pending])
        scores = model.log_probabilities(ids)
        at = 0
        for place, cut, own in pending:
            totals[place][:-1] += own @ scores[at : at + len(cut)]
            totals[place][-1] += own.sum()
            at += len(cut)
        pending, waiting = [], 0

    for place, text in enumerate(texts):
        if model is None or not has_letter(text):
            totals.append(None)
            continue
        totals.append(np.zeros(len(model.classes) + 1))
        cut, own = windows(text)
        for start in range(0, len(cut), BATCH):
            pending.append((place, cut[start : start + BATCH], own[start : start + BATCH]))
            waiting += len(pending[-1][1])
            if waiting >= BATCH:
                run()
    run()
    names, shares = [], []
    for total in totals:
        if total is None:
            names.append(UNKNOWN)
            shares.append(0.0)
            continue
        mean = total[:-1] / total[-1]
        odds = np.exp(mean - mean.max())
        names.append(model.classes[int(mean.argmax())])
        shares.append(float(odds.max() / odds.sum()))
    return names, shares


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (text and the columns to keep, doc_id if not given) with lang_pred and score."""
    keep = ["doc_id"] if keep is None else [c for c in keep if c not in LANGUAGE_COLUMNS]
    source = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    kept = [f for f in source.schema if f.name != "_text"]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            names, shares = predict_texts(model, (x.as_py() for x in column))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(shares, pa.float64())],
                [f.name for f in schema],
            )

    return source.mapInArrow(score, schema)
