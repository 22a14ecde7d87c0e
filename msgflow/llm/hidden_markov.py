"""Language model scoring with a hidden Markov model.

A text is its words (runs of anything but ASCII white space, A-Z lower-cased) and one end token. Latent states emit word
classes, a class emits its words; one state emits the end token only and leads to the state of a text's first word. So
P(text) = P(classes) * product of P(word | class), where a word's share of its class is (c + 0.1) / (C + 0.1 (V + 1)) with
one unseen word per class. The class of a word is its last four bytes, hashed: the tables of the latent part have a size
that does not depend on the corpus, while the words' counts cover all of it.

1. ``blocks``: tasks cut their texts into blocks of some ``BLOCK_BYTES``, number the words of each, and store the numbers
   and the block's vocabulary with its training counts, packed by hash bucket of the word.
2. ``word_counts``: per bucket, counts of a word are summed over blocks and sent back to each of them. A block has a word
   once, so a frequent word is as many entries as there are blocks, and no table of all words exists anywhere.
3. ``train``: Baum-Welch. ``training_texts`` stores the classes of training texts, a row each. Every task runs forward and
   backward passes over its training texts from their first to their last token, many side by side; expected counts are
   summed per task, then per slice of the model over all tasks. Every round covers every training token, from a start that
   only the seed and the shares of classes decide. Rounds end when one gains less than ``LEAST_GAIN`` nats a token in the
   summed log likelihood; nothing else bounds them.
4. ``score``: a block meets its word counts, and the scaled forward recursion gives the exact likelihood of every text
   from its first to its last token, many texts side by side.

Nulls: a null text is empty: one end token. A null id never is held out. Repeated rows count and are scored each. A corpus
without training texts has N = V = 0, and all words are unseen. An empty table gives no rows. Only doc_id, text and the
condition are read; other columns are joined back by id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import pieces_for, stored, text_of

CLASSES = 8192  # 0 is the end token's
STATES = 12  # 0 emits the end token
LANE = 256  # tokens side by side run through lanes of at least this length
LANE_TOKENS = 768 << 10  # in a set of lanes
STEP_TOKENS = 16 << 10  # of a set, whose emissions are looked up and added up at once
SUM_TOKENS = 256 << 10  # whose values are added up at once
SCALED = 8  # tokens between two scalings
FAINT = 1e-27  # a sum over states that is too near to the least that float32 can hold
LEAST_GAIN = 1e-4
SLICES = 16  # of the expected counts
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 32 << 20  # of text for each bucket of words
ADD = 0.1
END = b""

PACKED = (
    "block long, bucket int, doc_ids array<long>, held_out array<boolean>, lengths binary, ids binary, classes binary, "
    "words binary, counts binary"
)
PACKED_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("bucket", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("held_out", pa.list_(pa.bool_())),
        ("lengths", pa.binary()),
        ("ids", pa.binary()),
        ("classes", pa.binary()),
        ("words", pa.binary()),
        ("counts", pa.binary()),
    ]
)


def class_of(word: bytes) -> int:
    return 1 + zlib.crc32(word[-4:]) % (CLASSES - 1) if word else 0


def tokens(text: str) -> list[bytes]:
    """Words of a text as UTF-8; bytes lower-case A-Z and split at ASCII white space only."""
    return text.encode("utf-8", "replace").lower().split()


def numbered(texts: pa.Array, rows: int = 1 << 10) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of texts (strings), all ``tokens`` as numbers, how many each has, and the words that the numbers stand for."""
    parts, sizes = [], []
    for first in range(0, len(texts), rows):  # the words of some texts at a time: only their numbers stay
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(first, rows)))
        parts.append(split.flatten().dictionary_encode())
        sizes.append(np.diff(split.offsets.to_numpy()))
    coded = pa.chunked_array(parts).unify_dictionaries()
    dictionary = coded.chunk(0).dictionary
    words = dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    end = pc.index(dictionary, "").as_py()
    if end < 0:
        end = len(words)
        words.append(END)
    ids = np.concatenate([x.indices.to_numpy() for x in coded.chunks])
    kept = ids != end  # white space around a text leaves empty words
    before = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum(kept, out=before[1:])
    stops = before[np.cumsum(np.concatenate(sizes), dtype=np.int64)]
    return np.insert(ids[kept], stops, end), np.diff(stops, prepend=0).astype(np.int32) + np.int32(1), words


def _pack(block: int, doc_ids: list, held_out: list, texts: pa.Array, buckets: int) -> Iterator[dict]:
    """The rows of a block: its texts as word numbers, and its vocabulary by bucket."""
    ids, lengths, words = numbered(texts)
    learn = np.repeat(~np.array(held_out, dtype=bool), lengths)
    counts = np.bincount(ids[learn], minlength=len(words)).astype(np.int64)
    classes = np.fromiter(map(class_of, words), dtype=np.uint16, count=len(words))
    yield {
        "block": block,
        "doc_ids": doc_ids,
        "held_out": held_out,
        "lengths": lengths.tobytes(),
        "ids": ids.tobytes(),
        "classes": classes.tobytes(),
    }
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), dtype=np.int64, count=len(words))
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for start, end in zip(edges, [*edges[1:], len(order)]):
        part = order[start:end]
        yield {
            "block": block,
            "bucket": int(bucket[part[0]]),
            "ids": part.astype(np.int32).tobytes(),
            "words": b"\n".join([words[i] for i in part]),
            "counts": counts[part].tobytes(),
        }


def blocks(docs: DataFrame, held_out: Column) -> DataFrame:
    """Packed blocks, stored. Rows with a bucket are vocabulary, those without are texts."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of(F.col("text")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    size = source.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = pieces_for(docs.sparkSession, size, BUCKET_BYTES)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        serial, held, room = 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            texts = rows["text"].combine_chunks()
            for row in _pack(base + serial, rows["doc_id"].to_pylist(), rows["held_out"].to_pylist(), texts, buckets):
                yield pa.RecordBatch.from_pylist([row], schema=PACKED_ARROW)

        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64)
            first = 0
            while first < batch.num_rows:  # as many texts as fill the block
                before = int(ends[first - 1]) if first else 0
                last = min(int(np.searchsorted(ends, before + BLOCK_BYTES - room)) + 1, batch.num_rows)
                held.append(batch.slice(first, last - first))
                room += int(ends[last - 1]) - before
                first = last
                if room >= BLOCK_BYTES:
                    yield from flush()
                    serial, held, room = serial + 1, [], 0
        if held:
            yield from flush()
            held.clear()
        pa.default_memory_pool().release_unused()  # the worker goes on to other stages

    return stored(source.mapInArrow(pack, PACKED), "blocks")


def word_counts(packed: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(block, ids, counts over the corpus) packed and stored; tokens and distinct words of every class."""

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        sums: dict[bytes, int] = {}
        lists = [bytes(w).split(b"\n") for w in rows["words"]]
        for words, counts in zip(lists, rows["counts"]):
            for word, n in zip(words, np.frombuffer(counts, np.int64).tolist()):
                sums[word] = sums.get(word, 0) + n
        seen = np.fromiter(sums.values(), np.int64, len(sums))
        classes = np.fromiter(map(class_of, sums), np.int64, len(sums))
        found = [np.fromiter(map(sums.__getitem__, words), np.int64, len(words)).tobytes() for words in lists]
        out = pd.DataFrame({"block": rows["block"], "ids": rows["ids"], "counts": found})
        out["n"], out["v"] = None, None
        used = np.unique(classes[seen > 0])
        stats = {
            "block": None,
            "ids": used.astype(np.int32).tobytes(),
            "n": np.bincount(classes, seen, CLASSES)[used].astype(np.int64).tolist(),
            "v": np.bincount(classes, seen > 0, CLASSES)[used].astype(np.int64).tolist(),
        }
        stats["counts"] = None
        classed = pd.DataFrame([stats])
        classed["k"] = [used.tolist()]
        out["k"] = None
        return pd.concat([out.astype(object), classed.astype(object)])[["block", "ids", "counts", "k", "n", "v"]]

    schema = "block long, ids binary, counts binary, k array<long>, n array<long>, v array<long>"
    vocabulary = packed.where(F.col("bucket").isNotNull()).select("block", "bucket", "ids", "words", "counts")
    counted = stored(vocabulary.groupBy("bucket").applyInPandas(total, schema), "word-counts")
    each = counted.where(F.col("block").isNull()).select(F.explode(F.arrays_zip("k", "n", "v")).alias("x"))
    rows = each.groupBy("x.k").agg(F.sum("x.n").alias("n"), F.sum("x.v").alias("v")).collect()  # CLASSES rows at most
    sums = np.zeros((2, CLASSES))
    for r in rows:
        sums[:, r["k"]] = r["n"], r["v"]
    return counted.where(F.col("block").isNotNull()).select("block", "ids", "counts"), sums[0], sums[1]


@dataclass
class Chain:
    """Transitions (state, state) and emissions (class, state)."""

    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def start(shares: np.ndarray, seed: int = 3) -> Chain:
        rng = np.random.default_rng(seed)
        emit = shares[:, None] * np.exp(rng.normal(0, 1.0, (CLASSES, STATES)))
        emit[0], emit[:, 0] = 0, 0
        emit /= np.maximum(emit.sum(0), 1e-300)
        emit[0, 0] = 1
        move = np.full((STATES, STATES), 0.1 / STATES) + np.eye(STATES) * 0.9
        move[0], move[0, 0] = 1 / (STATES - 1), 1e-6
        return Chain(move / move.sum(1, keepdims=True), emit)

    @staticmethod
    def of_counts(counts: np.ndarray, shares: np.ndarray) -> Chain:
        """The most likely chain for expected counts, smoothed: emissions toward the corpus, transitions by a constant."""
        move, emit = counts[:STATES] + 0.5, counts[STATES:].copy()
        emit[:, 1:] += 20.0 * shares[:, None]
        emit[0], emit[:, 0] = 0, 0
        emit /= np.maximum(emit.sum(0), 1e-300)
        emit[0, 0] = 1
        return Chain(move / move.sum(1, keepdims=True), emit)

    def expected(self, lanes: np.ndarray, sizes: np.ndarray, every: int = SCALED) -> tuple[np.ndarray, float]:
        """Expected transitions and emissions of lanes (time, lane) of classes, one array (STATES + CLASSES, STATES), and
        the log likelihood. A lane is whole texts and has ``sizes`` tokens; the longest lane comes first.

        Emissions are taken relative to the class's highest, so values only shrink, and are scaled ``every`` so many tokens.
        Where they shrink too far for float32 between two scalings, the lanes are done again with one at each token.
        Only the forward values are held for all tokens; the rest is made a block of ``STEP_TOKENS`` at a time.
        """
        length, n = lanes.shape
        peak = self.emit.max(1)
        move, emit = self.move.astype(np.float32), (self.emit / peak[:, None]).astype(np.float32)
        back, ones = np.ascontiguousarray(move.T), np.ones((STATES, STATES), dtype=np.float32)
        active = np.searchsorted(-sizes, -np.arange(length), side="left").tolist()
        block = max(STEP_TOKENS // n, 1)
        alpha = np.empty((length, n, STATES), dtype=np.float32)
        scale = np.ones((-(-length // every), n, STATES), dtype=np.float32)  # the same for all states
        for begin in range(0, length, block):
            arriving = emit.take(lanes[begin : begin + block], axis=0)
            for t, k in enumerate(active[begin : begin + block], begin):
                now = alpha[t, :k]
                if t:
                    np.dot(alpha[t - 1, :k], move, out=now)
                    now *= arriving[t - begin, :k]
                else:  # every lane starts behind an end token
                    np.multiply(arriving[0], move[0], out=now)
                if t % every == 0:
                    total = scale[t // every, :k]
                    np.dot(now, ones, out=total)
                    now /= total
                if k < n:
                    alpha[t, k:] = 0
        last = alpha[sizes - 1, np.arange(n)].sum(1)
        if every > 1 and not np.minimum(scale.min(), last.min()) >= FAINT:
            del alpha, scale
            return self.expected(lanes, sizes, 1)
        fit = np.log(scale[:, :, 0], dtype=np.float64).sum() + np.log(last, dtype=np.float64).sum()
        moves, emits = np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES))
        ending = np.repeat(1 / last, STATES).reshape(n, STATES)
        carried, reached = np.empty_like(ending), 0
        for begin in reversed(range(0, length, block)):
            chunk = lanes[begin : begin + block]
            arriving = emit.take(chunk, axis=0)
            beta = np.empty_like(arriving)
            beta[-1, :reached] = carried[:reached]
            for place in reversed(range(len(chunk))):
                t, k = begin + place, active[begin + place]
                if k > reached:
                    beta[place, reached:k] = ending[reached:k]
                    reached = k
                now = arriving[place, :k]
                now *= beta[place, :k]
                if t % every == 0:
                    now /= scale[t // every, :k]
                np.dot(now, back, out=beta[place - 1, :k] if place else carried[:k])
                if k < n:
                    arriving[place, k:], beta[place, k:] = 0, 0
            if not begin:
                moves[0] += arriving[0].sum(0)
            first = max(begin, 1)
            before = alpha[first - 1 : begin + len(chunk) - 1]
            moves += np.matmul(before.transpose(0, 2, 1), arriving[first - begin :]).sum(0)
            beta *= alpha[begin : begin + len(chunk)]
            flat, found = chunk.ravel().astype(np.intp), beta.reshape(-1, STATES)
            emits[0, 0] += found[:, 0].sum()  # no other class has state 0
            for s in range(1, STATES):
                emits[s] += np.bincount(flat, found[:, s], CLASSES)
        fit += np.bincount(lanes.ravel(), minlength=CLASSES) @ np.log(peak)  # class 0, which pads lanes, has 1
        return np.concatenate([moves * self.move, emits.T]), float(fit)

    def log10(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Exact log10 likelihood of texts of classes, each ending in class 0: the scaled forward recursion."""
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        sizes = lengths[order]
        out = np.zeros(len(lengths))
        alpha = np.tile(np.eye(STATES)[0], (len(order), 1))
        active = len(order)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            while active and sizes[active - 1] <= t:
                active -= 1
            if active < len(alpha) or t % SCALED == 0:
                scale = alpha.sum(1)
                out[: len(alpha)] += np.log10(scale)
                alpha = alpha[:active] / scale[:active, None]
            alpha = (alpha @ self.move) * self.emit[ids[starts[:active] + t]]
        out[:active] += np.log10(alpha.sum(1))
        result = np.empty_like(out)
        result[order] = out
        return result


def _lanes(sizes: np.ndarray, room: int = LANE_TOKENS) -> Iterator[list[list[int]]]:
    """Texts of these sizes dealt to lanes, a set of lanes at a time: of some ``room`` tokens, or one text if longer.

    A lane is a long text and the short ones that fit beside the longest text of its set.
    """
    order = np.argsort(-sizes, kind="stable").tolist()
    first, last = 0, len(order) - 1
    while first <= last:
        length = max(int(sizes[order[first]]), LANE)
        group = []
        while first <= last and len(group) < max(room // length, 1):
            lane, used = [order[first]], int(sizes[order[first]])
            first += 1
            while first <= last and used + sizes[order[last]] <= length:
                lane.append(order[last])
                used += int(sizes[order[last]])
                last -= 1
            group.append((used, lane))
        yield [lane for _, lane in sorted(group, reverse=True)]


def training_texts(packed: DataFrame) -> DataFrame:
    """The classes of every training text, a row each and stored: a batch of rows has a size that the input doesn't change."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                (row,) = batch.slice(place, 1).to_pylist()
                lengths = np.frombuffer(row["lengths"], np.int32)
                stream = np.frombuffer(row["classes"], np.uint16)[np.frombuffer(row["ids"], np.int32)]
                ends = np.cumsum(lengths, dtype=np.int64)
                bounds = zip(row["held_out"], (ends - lengths).tolist(), ends.tolist())
                texts = [stream[start:end].tobytes() for out, start, end in bounds if not out]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["classes"])

    texts = packed.where(F.col("bucket").isNull()).select("held_out", "lengths", "ids", "classes")
    return stored(texts.mapInArrow(run, "classes binary"), "training")


def _training_lanes(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Classes of texts (binary) as lanes (time, lane), and the size of every lane."""
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] // 2
    stream, lengths, bounds = np.frombuffer(texts.buffers()[2], np.uint16), np.diff(ends), ends.tolist()
    for group in _lanes(lengths):
        sizes = np.array([lengths[lane].sum() for lane in group], dtype=np.int64)
        lanes = np.zeros((len(group), sizes[0]), dtype=np.uint16)
        for row_of, lane, size in zip(lanes, group, sizes.tolist()):
            np.concatenate([stream[bounds[i] : bounds[i + 1]] for i in lane], out=row_of[:size])
        yield np.ascontiguousarray(lanes.T), sizes


def train(packed: DataFrame, class_tokens: np.ndarray, least_gain: float = LEAST_GAIN) -> Chain:
    """Baum-Welch, every round over all training texts, until a round gains less than ``least_gain`` a token (nats)."""
    words_only = class_tokens.copy()
    words_only[0] = 0
    shares = (words_only + ADD) / (words_only + ADD).sum()
    total = class_tokens.sum()

    def expect(chain: Chain):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, fit = np.zeros((STATES + CLASSES, STATES)), 0.0
            for batch in batches:
                for lanes, sizes in _training_lanes(batch["classes"].cast(pa.binary())):
                    counts, gain = chain.expected(lanes, sizes)
                    sums += counts
                    fit += gain
            slices = [x.tobytes() for x in [*np.array_split(sums, SLICES), np.array([fit])]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES + 1), pa.int32()), pa.array(slices, pa.binary())], ["slice", "sums"]
            )

        return run

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        sums = np.sum([np.frombuffer(x, np.float64) for x in rows["sums"]], axis=0)
        return pd.DataFrame({"slice": rows["slice"].iloc[:1], "sums": [sums.tobytes()]})

    chain = Chain.start(shares)
    if not total:
        return chain
    # A task sends one model, so a round has as many tasks as there are cores.
    texts = training_texts(packed).coalesce(packed.sparkSession.sparkContext.defaultParallelism)
    before = -np.inf
    while True:
        sums = texts.mapInArrow(expect(chain), "slice int, sums binary").groupBy("slice")
        rows = sorted(sums.applyInPandas(add, "slice int, sums binary").collect())  # SLICES rows, one model, and its fit
        *slices, fit = [np.frombuffer(bytes(r["sums"]), np.float64) for r in rows]
        chain = Chain.of_counts(np.concatenate(slices).reshape(-1, STATES), shares)
        if fit[0] - before < least_gain * total:
            return chain
        before = fit[0]


def text_sums(values: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the words' values over each text, some texts at a time."""
    firsts = np.unique(np.searchsorted(starts, np.arange(0, len(ids), SUM_TOKENS)))
    firsts = firsts[firsts < len(starts)].tolist()
    out = np.empty(len(starts), dtype=values.dtype)
    for first, last in zip(firsts, [*firsts[1:], len(starts)]):
        end = starts[last] if last < len(starts) else len(ids)
        out[first:last] = np.add.reduceat(values[ids[starts[first] : end]], starts[first:last] - starts[first])
    return out


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every text.

    Texts for which ``held_out`` is true teach nothing.
    """
    packed = blocks(docs, held_out)
    counted, class_tokens, class_words = word_counts(packed)
    chain = train(packed, class_tokens)
    total, distinct = class_tokens.sum(), class_words.sum()
    base_unit = np.log10(total + ADD * (distinct + 1))
    class_unit = np.log10(class_tokens + ADD * (class_words + 1))

    def run(texts: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for row in texts.to_dict("records"):
            ids, lengths = np.frombuffer(row["ids"], np.int32), np.frombuffer(row["lengths"], np.int32)
            classes = np.frombuffer(row["classes"], np.uint16)
            known = np.zeros(len(classes), dtype=np.int64)
            for place, n in zip(counts["ids"], counts["counts"]):
                known[np.frombuffer(place, np.int32)] = np.frombuffer(n, np.int64)
            weight = np.log10(known + ADD)
            inside = weight - class_unit[classes]
            inside[classes == 0] = 0.0  # its class has the end token only
            starts = np.cumsum(lengths) - lengths
            latent = chain.log10(classes[ids], lengths.astype(np.int64))
            parts.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array(row["doc_ids"], dtype="Int64"),
                        "held_out": np.array(row["held_out"], dtype=bool),
                        "n_tokens": lengths.astype(np.int64),
                        "n_known": text_sums((known > 0).astype(np.int64), ids, starts),
                        "train_tokens": np.int64(total),
                        "base_score": text_sums(weight, ids, starts) - lengths * base_unit,
                        "score": text_sums(inside, ids, starts) + latent,
                    }
                )
            )
        return pd.concat(parts)

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    texts = packed.where(F.col("bucket").isNull()).select("block", "doc_ids", "held_out", "lengths", "ids", "classes")
    return texts.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(run, schema)
