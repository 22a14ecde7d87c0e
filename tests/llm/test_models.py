"""Scores, mixing, shards and sketches: brute force, exact laws, held-out accuracy, and the odd cases."""

from __future__ import annotations

import hashlib
import itertools
import math
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from msgflow.llm import fingerprints, hidden_markov, language_id, mixing, sharding, site_quality, toxicity
from msgflow.llm import queries as Q

BASE = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "7 !! 8"), (None, "null id"), (6, "same"), (6, "same"), (7, "w " * 3000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s" if i else None, i, 0.5, 1) for i, t in rows], SCHEMA)


def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(0)
    chain = hidden_markov.Chain.start(np.full(hidden_markov.CLASSES, 1 / hidden_markov.CLASSES))
    chain.move = rng.dirichlet(np.ones(hidden_markov.STATES), hidden_markov.STATES)
    texts = [[5, 9, 0], [0], [7, 7, 2, 0]]
    want = []
    for text in texts:
        total = 0.0
        for path in itertools.product(range(hidden_markov.STATES), repeat=len(text)):
            p, before = 1.0, 0
            for state, symbol in zip(path, text):
                p *= chain.move[before, state] * chain.emit[symbol, state]
                before = state
            total += p
        want.append(math.log10(total))
    ids = np.array([x for t in texts for x in t])
    got = chain.log10(ids, np.array([len(t) for t in texts]))
    assert got == pytest.approx(want)


def test_hidden_markov_counts(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(9001, None), (9002, ""), (None, "the of")], "doc_id long, text string"))
    rows = docs.collect()
    got = {r["doc_id"]: r for r in Q.hidden_markov.score(docs, Q.remainder(F.col("doc_id"), 10) == 0).collect()}
    counts, texts = Counter(), {}
    for i, text in rows:
        words = [*(text or "").encode().lower().split(), b""]
        texts[i] = words
        if i is None or zlib.crc32(str(i).encode()) % 10:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    for i, words in texts.items():
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (len(words), sum(counts[w] > 0 for w in words))
        assert (r["train_tokens"], r["base_score"]) == (total, pytest.approx(base))
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert hidden_markov.score(docs.limit(0), F.lit(False)).collect() == []


def plain_baum_welch(texts, shares):
    """Forward and backward over every whole text in float64, until a round gains too little."""
    chain, before = hidden_markov.Chain.start(shares), -np.inf
    while True:
        counts, fit = np.zeros((hidden_markov.STATES + hidden_markov.CLASSES, hidden_markov.STATES)), 0.0
        for text in texts:
            alpha = [np.eye(hidden_markov.STATES)[0]]
            for c in text:
                ahead = (alpha[-1] @ chain.move) * chain.emit[c]
                fit += math.log(ahead.sum())
                alpha.append(ahead / ahead.sum())
            beta = np.ones(hidden_markov.STATES)
            for t in range(len(text), 0, -1):
                counts[hidden_markov.STATES + text[t - 1]] += alpha[t] * beta / (alpha[t] @ beta)
                pair = alpha[t - 1][:, None] * chain.move * (chain.emit[text[t - 1]] * beta)
                counts[: hidden_markov.STATES] += pair / pair.sum()
                beta = chain.move @ (chain.emit[text[t - 1]] * beta)
                beta /= beta.sum()
        chain = hidden_markov.Chain.of_counts(counts, shares)
        if fit - before < hidden_markov.LEAST_GAIN * sum(map(len, texts)):
            return chain
        before = fit


def test_baum_welch_covers_all_texts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(40)]
    sizes = [0, 1, 3, 127, 128, 129, 300, 700, *rng.integers(1, 60, 30).tolist()]
    rows = [(i, " ".join(rng.choice(words[:20] if i % 2 else words[15:], n))) for i, n in enumerate(sizes)]
    docs = frame(spark, rows).repartition(3)
    packed = hidden_markov.blocks(docs, F.col("doc_id") == 5)
    _, class_tokens, _ = hidden_markov.word_counts(packed)
    words_only = class_tokens.copy()
    words_only[0] = 0
    shares = (words_only + hidden_markov.ADD) / (words_only + hidden_markov.ADD).sum()
    texts = [[*map(hidden_markov.class_of, hidden_markov.tokens(t)), 0] for i, t in rows if i != 5]
    want = plain_baum_welch(texts, shares)

    def here(*_):
        raise AssertionError("the driver trains")

    monkeypatch.setattr(hidden_markov.Chain, "expected", here)  # the workers have their own
    got = hidden_markov.train(packed, class_tokens)
    assert got.move == pytest.approx(want.move, abs=1e-3)
    assert got.emit == pytest.approx(want.emit, abs=1e-3)


def lanes_of(rng, sizes):
    """Lanes of texts of random classes, each text ending in class 0."""
    lanes = np.zeros((max(sizes), len(sizes)), dtype=np.uint16)
    for lane, size in enumerate(sizes):
        lanes[:size, lane] = rng.integers(0, 60, size)
        lanes[size - 1, lane] = 0
    return lanes, np.array(sizes, dtype=np.int64)


def test_expected_counts_of_lanes(monkeypatch):
    """Lanes of unequal size, cut into steps anywhere, give the counts of every text alone."""
    rng = np.random.default_rng(5)
    shares = np.full(hidden_markov.CLASSES, 1 / hidden_markov.CLASSES)
    chain = hidden_markov.Chain.start(shares)
    lanes, sizes = lanes_of(rng, [23, 23, 17, 9, 2, 1])
    want, fit = np.zeros((hidden_markov.STATES + hidden_markov.CLASSES, hidden_markov.STATES)), 0.0
    for lane, size in zip(lanes.T, sizes):
        counts, gain = plain_counts(chain, lane[:size].tolist())
        want, fit = want + counts, fit + gain
    for step, every in ((1, 8), (6, 1), (24, 8), (1 << 20, 4)):
        monkeypatch.setattr(hidden_markov, "STEP_TOKENS", step)
        counts, gain = chain.expected(lanes, sizes, every)
        assert counts == pytest.approx(want, rel=1e-4, abs=1e-5)
        assert gain == pytest.approx(fit, rel=1e-6)


def test_values_too_small_for_the_scaling():
    """Nine empty texts in a row are unlikelier than float32 can hold: they are scaled at every token."""
    chain = hidden_markov.Chain.start(np.full(hidden_markov.CLASSES, 1 / hidden_markov.CLASSES))
    lanes, sizes = np.zeros((9, 2), dtype=np.uint16), np.array([9, 9])
    want, fit = plain_counts(chain, [0] * 9)
    counts, gain = chain.expected(lanes, sizes)
    assert counts == pytest.approx(2 * want, rel=1e-4, abs=1e-5) and gain == pytest.approx(2 * fit, rel=1e-6)


def test_sums_over_texts(monkeypatch):
    monkeypatch.setattr(hidden_markov, "SUM_TOKENS", 10)
    lengths, rng = np.array([1, 35, 1, 1, 12, 9, 40]), np.random.default_rng(7)
    ids, values = rng.integers(0, 30, lengths.sum()), rng.integers(0, 1000, 30)
    got = hidden_markov.text_sums(values, ids, np.cumsum(lengths) - lengths)
    assert got.tolist() == [int(values[x].sum()) for x in np.split(ids, np.cumsum(lengths)[:-1])]


def test_words_numbered_in_blocks():
    texts = ["", " ", "A b\tC\n\x0b\x0c\r d b", "  lead", "trail  ", "\u00c9 \u00c0B c  x \x1c\x1d\x85 y", "x"]
    for part in (pa.array(texts), pa.array(["cut", *texts]).slice(1), pa.array(["x"])):
        ids, lengths, words = hidden_markov.numbered(part, 2)
        want = [[*hidden_markov.tokens(t), b""] for t in part.to_pylist()]
        assert [words[i] for i in ids] == [w for t in want for w in t]
        assert lengths.tolist() == [len(t) for t in want] and len(set(words)) == len(words)


def plain_counts(chain, text):
    counts, fit = np.zeros((hidden_markov.STATES + hidden_markov.CLASSES, hidden_markov.STATES)), 0.0
    alpha = [np.eye(hidden_markov.STATES)[0]]
    for c in text:
        ahead = (alpha[-1] @ chain.move) * chain.emit[c]
        fit += math.log(ahead.sum())
        alpha.append(ahead / ahead.sum())
    beta = np.ones(hidden_markov.STATES)
    for t in range(len(text), 0, -1):
        counts[hidden_markov.STATES + text[t - 1]] += alpha[t] * beta / (alpha[t] @ beta)
        pair = alpha[t - 1][:, None] * chain.move * (chain.emit[text[t - 1]] * beta)
        counts[: hidden_markov.STATES] += pair / pair.sum()
        beta = chain.move @ (chain.emit[text[t - 1]] * beta)
        beta /= beta.sum()
    return counts, fit


def test_expected_counts_are_cheap():
    """A round costs a token what some 60 additions to a table do (before: 130), and little memory beside its forward values."""
    rng = np.random.default_rng(6)
    chain = hidden_markov.Chain.start(np.full(hidden_markov.CLASSES, 1 / hidden_markov.CLASSES))
    lanes, sizes = lanes_of(rng, [600] * 500)
    flat, weights = lanes.ravel().astype(np.intp), rng.random(lanes.size)

    def seconds(run):
        spent = []
        for _ in range(5):
            start = time.process_time()
            run()
            spent.append(time.process_time() - start)
        return min(spent)

    addition = seconds(lambda: [np.bincount(flat, weights, hidden_markov.CLASSES) for _ in range(12)]) / 12
    assert seconds(lambda: chain.expected(lanes, sizes)) < 90 * addition
    tracemalloc.start()
    try:
        chain.expected(lanes, sizes)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.7 * lanes.size * 4 * (hidden_markov.STATES + 1)


def test_training_rows_are_single_texts(spark):
    """A task reads training texts a row each, not the blocks of its share of the input."""
    rows = [(i, " ".join(f"w{k}" for k in range(i))) for i in range(40)] + [(40, None)]
    packed = hidden_markov.blocks(frame(spark, rows).coalesce(1), F.col("doc_id") % 4 == 1)
    got = [bytes(r["classes"]) for r in hidden_markov.training_texts(packed).collect()]
    texts = [[*map(hidden_markov.class_of, hidden_markov.tokens(t or "")), 0] for i, t in rows if i % 4 != 1]
    assert sorted(got) == sorted(np.array(x, dtype=np.uint16).tobytes() for x in texts)


def test_lanes_hold_every_text():
    sizes = np.array([1, 5000, 300, 1, 70, 256, 2000, 9])
    groups = list(hidden_markov._lanes(sizes, 4000))
    assert sorted(i for g in groups for lane in g for i in lane) == list(range(len(sizes)))
    for g in groups:
        lengths = [sizes[lane].sum() for lane in g]
        assert lengths == sorted(lengths, reverse=True) and (len(g) * lengths[0] <= 4000 or len(g) == 1)
    assert list(hidden_markov._lanes(sizes[:0])) == []


def test_language_held_out(spark):
    out = Q.op4_byte_network(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    model = language_id.Model(["a"], *[None] * 5)
    got = language_id.predict(frame(spark, ODD[:3]), None, ["doc_id", "size", "score"])
    assert [(r["lang_pred"], r["score"]) for r in got.collect()] == [("und", 0.0)] * 3
    assert not language_id.has_letter("7 !!") and language_id.has_letter("é") and model.classes == ["a"]
    assert language_id.train(frame(spark, ODD), F.col("lang"), F.lit(True)) is None


def test_windows_cover_every_byte():
    for n in (1, 255, 256, 257, 509, 5000):
        text = "".join(chr(97 + k % 26) for k in range(n))
        cut, own = language_id.windows(text)
        assert own.sum() == n and cut.shape[1] == language_id.LENGTH
        stride = language_id.LENGTH - max(language_id.WIDTHS) + 1
        joined = np.concatenate([*[w[:stride] for w in cut[:-1]], cut[-1]])
        assert bytes(joined[joined < language_id.PAD].astype(np.uint8)).decode() == text


def plain_segments(scores):
    """The best segment, then the same on either side of it."""
    best, where = 0.0, None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > best + 1e-12:
                best, where = total, (a, b + 1)
    if where is None:
        return []
    a, b = where
    right = [(x + b, y + b, s) for x, y, s in plain_segments(scores[b:])]
    return [*plain_segments(scores[:a]), (a, b, best), *right]


def test_segments():
    rng = np.random.default_rng(4)
    for _ in range(150):
        scores = np.where(rng.random(40) < 0.25, rng.integers(1, 9) * 0.17 + rng.random(40), -toxicity.DRIFT)
        steps = [(k, k + 1, float(s)) for k, s in enumerate(scores) if s > 0]
        got = toxicity.maximal_segments(steps)
        want = plain_segments(scores.tolist())
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert [x[2] for x in got] == pytest.approx([x[2] for x in want])


def test_toxicity(spark):
    rows = Q.op5_toxic_segments(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    clean = [r for r in rows if labels.get(r["doc_id"]) == 0]
    toxic = [r for r in rows if labels.get(r["doc_id"]) == 1]
    assert sum(r["predicted"] for r in clean) <= 0.05 * len(clean)
    assert sum(r["predicted"] for r in toxic) >= 0.5 * len(toxic)
    assert all(0 <= r["score"] <= 1 for r in rows)
    got = toxicity.detect(frame(spark, ODD), None, keep=["doc_id", "size"]).collect()
    assert [(r["score"], r["predicted"], r["segments"]) for r in got] == [(0.0, 0, [])] * len(ODD)


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = site_quality.site_quality(docs, labels, F.col("source"), F.col("lang"))
    rows = out.join(labels, "doc_id").collect()
    assert sum(r["keep"] == (r["quality"] == 1) for r in rows) >= 0.9 * len(rows)
    odd = frame(spark, ODD)
    got = site_quality.site_quality(odd, labels.limit(0), F.col("source"), F.col("lang"), keep=["doc_id", "score", "size"])
    assert len(got.collect()) == len(ODD) and got.columns == ["doc_id", "size", *site_quality.QUALITY_COLUMNS]
    assert site_quality.site_quality(odd.limit(0), labels, F.col("source"), F.col("lang")).collect() == []


def test_mix(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(0, 60)), None, s, 1, 0.0, 1) for i in range(600) for s in [rng.choice(["a", "b", "c", "d", None], p=[0.02, 0.6, 0.2, 0.1, 0.08])]]
    docs = spark.createDataFrame([(i, t, n, None if s == "None" else s, *x) for i, t, n, s, *x in rows], SCHEMA)
    got = mixing.mix(docs, keep=["doc_id", "source", "size", "n_chars"]).collect()
    assert sorted(got) == sorted(mixing.mix(docs.repartition(7), keep=["doc_id", "source", "size", "n_chars"]).collect())
    taken, size, target = defaultdict(int), {}, {}
    for r in got:
        taken[r["source"]] += r["taken"]
        size[r["source"]], target[r["source"]] = r["source_size"], r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    free = {s: target[s] / (5, 2, 1)[k % 3] for k, s in enumerate(order) if target[s] < 2 * size[s]}
    assert max(free.values()) == pytest.approx(min(free.values()))
    assert all(target[s] <= 2 * size[s] and abs(taken[s] - target[s]) <= 60 for s in size)
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns and whole.count() == sum(r["repeats"] for r in got)
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mix(frame(spark, ODD[:3])).count() == 3


def test_hilbert_curve_is_a_walk(spark):
    for n, bits in ((2, 3), (3, 2)):
        cells = [tuple(c) for c in itertools.product(range(1 << bits), repeat=n)]
        table = spark.createDataFrame(cells, [f"d{k}" for k in range(n)])
        place = sharding.hilbert_index([F.col(f"d{k}") for k in range(n)], bits)
        walk = [tuple(r[:n]) for r in table.select("*", place.alias("h")).orderBy("h").collect()]
        assert len(set(walk)) == len(cells)
        assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(walk, walk[1:]))


def test_shards(spark):
    rows = [*ODD, *[(i, f"t{i % 9}") for i in range(10, 90)]]
    docs = frame(spark, rows)
    dimensions = {"source": F.col("source"), "n_chars": F.col("n_chars"), "score": F.col("score")}
    got = sharding.hilbert_shards(docs, dimensions, shards=7, keep=["doc_id", "text", "size"], piece_rows=10).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        assert (r["size"], r["text_crc32"]) == (len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) == set(range(7)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.hilbert_shards(docs.limit(0), dimensions).collect() == []


def test_fingerprints(spark):
    rows = [*ODD[:5], *ODD[6:], (20, "a\nb\nc\nd é ü"), (21, "a\nb\nc\nd é ü"), (22, "zz " * 200), (23, "line\n" * 9 + "end")]
    got = fingerprints.fingerprints(frame(spark, rows), keep=["doc_id", "text", "size"]).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0], r[1]))
    want = Counter()
    for k, (i, text) in enumerate(ordered):
        half = len(text) // 2
        edited = text[: len(text) - half] + ordered[(k + 1) % len(ordered)][1][:half]
        want[(i, len(text), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    by = {r["doc_id"]: r for r in got}
    assert by[20]["fingerprint"] == by[21]["fingerprint"] != by[22]["fingerprint"] and by[20]["near_next"] == 1.0
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert fingerprints.fingerprints(frame(spark, [])).collect() == []


def test_likeness_is_exact(spark):
    rng = np.random.default_rng(8)
    pairs = []
    for n in (0, 1, 3, 30, 400):
        for share in (0.0, 0.3, 1.0):
            one = rng.integers(-(2**62), 2**62, n)
            other = np.where(rng.random(n) < share, rng.integers(-(2**62), 2**62, n), one)
            pairs.append((one.tolist(), other.tolist()))
    table = spark.createDataFrame(pairs, "one array<long>, other array<long>")
    rows = table.select("*", fingerprints.likeness(F.col("one"), F.col("other")).alias("x")).collect()
    for r in rows:
        differing = len(set(r["one"]) ^ set(r["other"]))
        assert r["x"] == pytest.approx(1 - differing / (len(r["one"]) + len(r["other"])) if r["one"] else 1.0)
