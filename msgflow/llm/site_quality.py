"""Quality by hierarchical empirical Bayes: the document's own evidence, shrunk site rates behind it.

1. Evidence. A logistic model over shape features of a text (lengths, shares of symbols, capitals, digits, marks), fitted
   by Newton steps to a bounded sample of labelled rows, gives every document a log likelihood ratio good : bad; the
   labels' own odds are taken out of it.
2. Sites. Documents are counted by host and by path (a section of a host) in one grouped aggregation: how many, and how
   many good. A labelled document counts as its label, one without as its probability under the model.
3. Shrinking. A host's rate is Beta distributed around the global rate; a path's rate around its host's posterior mean.
   The strength of either prior, in documents, comes from the spread of the rates by moments, so a site with few
   documents stays at its prior and one with many speaks for itself.
4. A document's posterior odds are its path's odds, without its own count, times its likelihood ratio.

A third of all documents may share a host: rows are pre-aggregated before the shuffle, and only one row per path goes on.
Texts are read once; they are not shuffled.

A null host or path is a site of its own. A null text is empty; an empty text has features like any other. Labels that are
null or not 0 or 1 count as none; where either label is missing, evidence is neutral and the global rate is that of the
labels there are (a half where there are none). Repeated rows count each. An id with several labels has the least. Extra
columns are returned unchanged if asked for, unless named as a result column. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import WORD, stored, text_of, uniform

QUALITY_COLUMNS = ("evidence", "host_rate", "path_rate", "score", "keep")
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0


def features(text: Column) -> list[Column]:
    """Shape of a text. Shares are of its characters or words; all are bounded, but for the logarithm of its length."""
    plain = text_of(text)
    size = F.char_length(plain).cast("double")
    n_words = F.regexp_count(plain, F.lit(WORD)).cast("double")

    def share(pattern: str, of: Column) -> Column:
        # A few more characters than there are, so that one capital in a short text is no high share.
        return F.regexp_count(plain, F.lit(pattern)) / (of + F.lit(25.0))

    return [
        F.log1p(n_words),
        F.least(size / F.greatest(n_words, F.lit(1.0)), F.lit(40.0)) / 10,
        share(r"[^\p{L}\p{Nd}\s.,]", size) * 5,
        share(r"\p{Lu}", size) * 5,
        share(r"\p{Nd}", size) * 5,
        share(r"(?:^|\s)[^\p{L}\p{Nd}\s]+(?=\s|$)", n_words) * 5,
        share(r"[^\p{L}\p{Nd}\s.,]{2,}(?=\s|$)", n_words) * 5,
    ]


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic model (the constant first), ridged; classes weigh the same, so that odds are even."""
    design = np.concatenate([np.ones((len(x), 1)), x], 1)
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    ridge = np.diag([1e-6] + [1e-1] * x.shape[1])
    w = np.zeros(design.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge
        w = w + np.linalg.solve(h, design.T @ (weight * (y - p)) - ridge @ w)
    return w


def train(marked: DataFrame, per_class: int = 5_000) -> tuple[np.ndarray | None, float]:
    """(weights, rate of label 1). ``marked`` has x (features), label (0, 1 or null) and draw."""
    counts = marked.where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r["label"]: r["n"] for r in counts}
    rate = n.get(1, 0) / sum(n.values()) if n else 0.5
    if set(n) != {0, 1}:
        return None, rate
    share = F.when(F.col("label") == 1, F.lit(min(1.0, per_class / n[1]))).otherwise(F.lit(min(1.0, per_class / n[0])))
    rows = marked.where(F.col("label").isNotNull() & (F.col("draw") < share)).select("x", "label").collect()
    rows.sort(key=lambda r: (r["label"], list(r["x"])))
    return fit(np.array([r["x"] for r in rows]), np.array([float(r["label"]) for r in rows])), rate


def _strength(groups: DataFrame, n: str, good: str, prior: Column) -> float:
    """Strength of a Beta prior by moments: how much group rates vary beyond what their sizes alone explain."""
    rate = F.col(good) / F.col(n)
    # Sum of n (rate - prior)^2 is about sum of prior (1 - prior) (1 + (n - 1) rho); strength is 1 / rho - 1.
    row = groups.agg(
        F.sum(F.col(n) * (rate - prior) ** 2).alias("seen"),
        F.sum(prior * (1 - prior)).alias("alone"),
        F.sum(prior * (1 - prior) * (F.col(n) - 1)).alias("extra"),
    ).first()
    if not row["extra"]:
        return LEAST_STRENGTH
    rho = (row["seen"] - row["alone"]) / row["extra"]
    return MOST_STRENGTH if rho <= 0 else float(min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / rho - 1)))


def site_quality(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = 0.5, keep: list[str] | None = None
) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with evidence (log likelihood ratio), host_rate, path_rate, score and keep.

    ``labels`` has doc_id and quality (0 or 1). ``keep`` is score >= threshold.
    """
    names = ["doc_id"] if keep is None else [c for c in keep if c not in QUALITY_COLUMNS]
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("_label"))
    rows = docs.select(
        F.struct(*[F.col(c) for c in names]).alias("row"),
        F.col("doc_id").alias("_id"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        F.array(*features(F.col("text"))).alias("x"),
        uniform(F.lit("quality"), F.col("doc_id").cast("string")).alias("draw"),
    )
    rows = rows.join(known, F.col("_id") == F.col("doc_id"), "left")
    # One short row per document; texts are not read again.
    marked = stored(rows.select("row", "host", "path", "x", "draw", F.col("_label").cast("int").alias("label")), "evidence")
    weights, rate = train(marked)
    if weights is None:
        weights = np.zeros(len(features(F.lit(""))) + 1)
    ratio = F.lit(float(weights[0])) + sum(F.col("x")[i] * F.lit(float(w)) for i, w in enumerate(weights[1:]))
    ratio = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), ratio))
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    own = F.lit(rate) * F.exp("evidence") / (F.lit(rate) * F.exp("evidence") + F.lit(1 - rate))
    judged = marked.withColumn("evidence", ratio).withColumn("good", F.coalesce(F.col("label").cast("double"), own))
    site = [F.coalesce(F.col(c), F.lit("")).alias(f"_{c}") for c in ("host", "path")]
    site += [F.col(c).isNull().alias(f"_no_{c}") for c in ("host", "path")]
    by_path = ["_host", "_no_host", "_path", "_no_path"]
    by_host = by_path[:2]
    judged = judged.select("row", "evidence", "good", *site)
    paths = judged.groupBy(*by_path).agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good_n"))
    hosts = paths.groupBy(*by_host).agg(F.sum("n").alias("host_n"), F.sum("good_n").alias("host_good"))
    # Both are asked several times below: one row per path, one per host.
    paths, hosts = stored(paths, "paths"), stored(hosts, "hosts")
    overall = hosts.agg((F.sum("host_good") / F.sum("host_n")).alias("rate")).first()["rate"]
    overall = min(max(overall if overall is not None else rate, 1e-6), 1 - 1e-6)
    strength = _strength(hosts, "host_n", "host_good", F.lit(overall))
    host_rate = (F.col("host_good") + F.lit(strength * overall)) / (F.col("host_n") + F.lit(strength))
    hosts = hosts.select(*by_host, host_rate.alias("host_rate"))
    paths = paths.join(hosts, by_host)
    inner = _strength(paths, "n", "good_n", F.col("host_rate"))
    # Small per document tables meet the rows by site; adaptive execution splits a hot one.
    found = judged.join(paths, by_path)
    count = F.col("n") - 1 + F.lit(inner)
    path_rate = (F.col("good_n") - F.col("good") + F.lit(inner) * F.col("host_rate")) / count
    path_rate = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), path_rate))
    found = found.withColumn("path_rate", path_rate)
    odds = F.col("path_rate") / (1 - F.col("path_rate")) * F.exp("evidence")
    return found.withColumn("score", odds / (1 + odds)).select(
        "row.*", "evidence", "host_rate", "path_rate", "score", (F.col("score") >= F.lit(threshold)).alias("keep")
    )
