"""Phrases of words that occur together, counted inside the distinct chunks of a prefix-free parsing.

1. ``parse``: a text's pieces (between punctuation and line breaks) are cut in front of trigger words, which a hash of the
   word alone decides: the same passage is cut the same way wherever it stands. A chunk is its own words and up to three
   that follow in its piece; an n-gram belongs to the chunk that has its first word among its own, so overlaps count once.
   ``dictionary``: the distinct chunks of a language with their frequencies in the parse; copies shrink to one row here.
2. ``blocks``: tasks gather chunks to some ``BLOCK_BYTES`` a row, stored.
3. ``frequent_marks``: each block's n-grams as sorted hashes with their weight, dealt by ranges of the hash; a range adds up
   its blocks and gives each of them back those of its hashes that reach ``least`` over all blocks. A block has a hash once,
   so a frequent n-gram is as many entries as there are blocks. Hashes that collide only add up to more, so no frequent
   n-gram is lost.
4. ``counted``: a block names the n-grams that its frequent hashes leave by words (numbers of pairs are numbered anew level by level,
   no hashes), and their exact weights are added by (language, phrase).
5. ``collocations``: cuts, scores, and drops by joins on (language, phrase); the first ``top`` of each language.

Memory of a task follows BLOCK_BYTES and ``RANGE_ENTRIES``, not the corpus. Null texts are empty, null languages are
``und``. Repeated rows count. A corpus without frequent phrases, or without rows, gives no rows. Only text and lang are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgflow.llm.common import pieces_for, stored, text_of

LONGEST = 4  # words of a phrase
LEAST = 30
TOP = 2000
TRIGGER = 24  # one word in so many starts a chunk
BLOCK_BYTES = 4 << 20
RANGE_ENTRIES = 4 << 20  # hashes of a range, where no n-gram repeats
SPARE_BITS = 10  # of a hash, above those that number the n-grams
BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)

CHUNK = pa.schema([("lang", pa.string()), ("tail", pa.int32()), ("chunk", pa.string()), ("n", pa.int64())])
BLOCK = pa.schema([("block", pa.int64()), ("n_words", pa.int64()), ("langs", pa.list_(pa.string())), ("size", pa.int64()), ("body", pa.binary()), ("meta", pa.binary())])
ENTRY = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("hashes", pa.binary()), ("weights", pa.binary()), ("n", pa.int64())])
MARK = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary())])
FOUND = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("f", pa.int64())])


class _Triggers(dict):
    """Whether a word starts a chunk."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) > 1 << 19:
            self.clear()
        self[word] = out = zlib.crc32(word) % TRIGGER == 0
        return out


def chunks_of(text: bytes, triggers: _Triggers) -> Iterator[tuple[int, bytes]]:
    """(words of overlap, chunk) of a lower-cased text: pieces are cut in front of trigger words."""
    for piece in text.translate(BREAKS).split(b"\n"):
        words = piece.split()
        if not words:
            continue
        begin = 0
        for cut in [i for i, w in enumerate(words) if i and triggers[w]]:
            end = min(len(words), cut + LONGEST - 1)
            yield end - cut, b" ".join(words[begin:end])
            begin = cut
        yield 0, b" ".join(words[begin:])


def parse(docs: DataFrame, lang: Column, text: Column) -> DataFrame:
    """lang, tail, chunk and how often a task met it in some texts."""
    source = docs.select(F.coalesce(lang.cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triggers, met, held = _Triggers(), Counter(), 0

        def flush() -> pa.RecordBatch:
            tails = pa.array([k[1] for k in met], type=pa.int32())
            bodies = pa.array([k[2] for k in met], type=pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in met], type=pa.string()), tails, bodies, pa.array(met.values(), type=pa.int64())], schema=CHUNK)

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = body.as_buffer().to_pybytes().lower()
                met.update((name, tail, chunk) for tail, chunk in chunks_of(raw, triggers))
                held += len(raw)
                if held >= BLOCK_BYTES:
                    yield flush()
                    met, held = Counter(), 0
        if met:
            yield flush()

    return source.mapInArrow(run, "lang string, tail int, chunk string, n long")


def dictionary(docs: DataFrame, lang: Column, text: Column) -> DataFrame:
    """The distinct chunks of each language: lang, tail (its words that belong to the next chunk), chunk, frequency n."""
    return parse(docs, lang, text).groupBy("lang", "tail", "chunk").agg(F.sum("n").alias("n"))


def blocks(chunks: DataFrame) -> DataFrame:
    """Chunks packed to blocks, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, base = 0, TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            langs = sorted({x[0] for x in held})
            number = {n: i for i, n in enumerate(langs)}
            body = b"\n".join([x[2] for x in held])
            meta = np.array([(number[x[0]], x[1], x[3]) for x in held], dtype="<i8").T.tobytes()
            n_words = body.count(b" ") + len(held)
            packed, extra = (pa.compress(x, codec="zstd", asbytes=True) for x in (body, meta))
            return pa.RecordBatch.from_pylist([{"block": base + made, "n_words": n_words, "langs": langs, "size": len(body), "body": packed, "meta": len(held).to_bytes(8, "little") + extra}], schema=BLOCK)

        for batch in batches:
            columns = [batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()), batch.column(3)]
            for row in zip(*[c.to_numpy(zero_copy_only=False).tolist() for c in columns]):
                held.append(row)
                size += len(row[2]) + 32
                if size >= BLOCK_BYTES:
                    yield flush()
                    held, size, made = [], 0, made + 1
        if held:
            yield flush()

    names = "block long, n_words long, langs array<string>, size long, body binary, meta binary"
    return stored(chunks.select("lang", "tail", "chunk", "n").mapInArrow(run, names), "chunks")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def opened(row: dict) -> tuple[bytes, np.ndarray]:
    """The chunks of a block, a line each, and for each the place of its language, its tail and its weight."""
    n = int.from_bytes(row["meta"][:8], "little")
    meta = np.frombuffer(pa.decompress(row["meta"][8:], decompressed_size=24 * n, codec="zstd", asbytes=True), dtype="<i8").reshape(3, n)
    return pa.decompress(row["body"], decompressed_size=row["size"], codec="zstd", asbytes=True), meta


def unpacked(row: dict) -> tuple[list[bytes], np.ndarray]:
    """The same with the chunks one by one."""
    body, meta = opened(row)
    return body.split(b"\n"), meta


def _ends(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word ends in chunks that are a line each, and how many words each chunk has."""
    raw = np.frombuffer(body, dtype=np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    last = np.append(np.flatnonzero(raw[ends] == 10), len(ends))
    return np.append(ends, len(raw)), np.diff(last, prepend=-1)


class Block:
    """The words of a block: numbers into its vocabulary, and for each place how many words may follow and its weight."""

    def __init__(self, row: dict):
        self.body, meta = opened(row)
        self.langs = row["langs"]
        self.ends, lengths = _ends(self.body)
        total = len(self.ends)
        split = pc.ascii_split_whitespace(pa.array([self.body], type=pa.binary()).cast(pa.string()))
        coded = split.flatten().dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        inside = np.arange(total) - np.repeat(ends - lengths, lengths)
        self.room = np.repeat(lengths, lengths) - inside  # words from here to the chunk's end
        self.own = self.room > np.repeat(meta[1], lengths)
        self.lang = np.repeat(meta[0], lengths)
        self.weight = np.repeat(meta[2], lengths)

    def hashes(self) -> list[np.ndarray]:
        """A hash of the n-gram at each place, for n from 1; only those with ``starts(n)`` mean something."""
        word = pd.util.hash_array(self.words)[self.codes].astype(np.uint64)
        tongue = pd.util.hash_array(np.array(self.langs, dtype=object)).astype(np.uint64)[self.lang]
        out = [_mixed(word ^ tongue)]
        for n in range(2, LONGEST + 1):
            ahead = np.zeros(len(word), dtype=np.uint64)
            ahead[: max(len(word) - n + 1, 0)] = word[n - 1 :]
            out.append(_mixed(out[-1] * np.uint64(0xD6E8FEB86659FD93) + ahead + np.uint64(n)))
        return out

    def starts(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.own & (self.room >= n))

    def entries(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The block's n-grams as ascending hashes of ``bits`` bits, and their weights."""
        hashed = self.hashes()
        at = [self.starts(n) for n in range(1, LONGEST + 1)]
        keys = np.concatenate([h[a] for h, a in zip(hashed, at)]) >> np.uint64(64 - bits)
        weights = np.concatenate([self.weight[a] for a in at])
        return _summed(keys, weights, bits)

    def phrases(self, frequent: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
        """lang, phrase, k and weight of the n-grams whose hash is among ``frequent``, by exact numbers of their words."""
        names = np.zeros(len(self.codes), dtype=np.int64)
        places = Places(frequent, bits)
        reached = np.ones(len(self.codes) + 1, dtype=bool)  # whether the n-gram of the level before is frequent, by place
        for n, hashed in enumerate(self.hashes(), 1):
            at = self.starts(n)
            # A frequent n-gram begins and ends with frequent ones; its end may belong to the next chunk.
            at = at[reached[at] & (reached[at + 1] | ~self.own[np.minimum(at + 1, len(self.own) - 1)])] if n > 1 else at
            keys = hashed[at] >> np.uint64(64 - bits)
            near = places.of(keys)
            at, near = at[near >= 0], near[near >= 0]
            reached[:] = False
            reached[at] = True
            if not len(at):
                break
            before = self.lang[at] if n == 1 else names[at]  # a frequent n-gram's beginning is frequent, so it has a number
            pair = before * len(self.words) + self.codes[at + n - 1]
            first, number = _numbered(near, pair, len(frequent))
            names[at] = number
            weight = np.bincount(number, minlength=len(first)) if (self.weight[at] == 1).all() else _added(number, self.weight[at], len(first))
            begin = at[first]
            spans = zip(np.where(begin > 0, self.ends[begin - 1] + 1, 0).tolist(), self.ends[begin + n - 1].tolist())
            text = [self.body[a:b] for a, b in spans]  # a chunk's words stand one space apart
            langs = pa.DictionaryArray.from_arrays(pa.array(self.lang[begin]), pa.array(self.langs, type=pa.string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([langs, pa.array(text, type=pa.binary()).cast(pa.string()), pa.array(np.full(len(text), n, dtype=np.int32)), pa.array(weight.astype(np.int64))], schema=FOUND)


class Places:
    """Where numbers are in ascending distinct numbers of ``bits`` bits, which are spread evenly: by their first bits."""

    def __init__(self, known: np.ndarray, bits: int):
        self.known = np.append(known, np.uint64(1 << 63))
        width = min(bits, max(len(known), 1).bit_length() + 1)
        self.shift = np.uint64(bits - width)
        self.starts = np.searchsorted(known, np.arange(1 << width, dtype=np.uint64) << self.shift)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        place = self.starts[(keys >> self.shift).astype(np.int64)]
        late = np.flatnonzero(self.known[place] < keys)
        while len(late):
            place[late] += 1
            late = late[self.known[place[late]] < keys[late]]
        place[self.known[place] != keys] = -1
        return place


def _numbered(near: np.ndarray, pair: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct pair is found first, and the number of each row's pair. ``near``, below ``n``, is a hash's place."""
    met = np.full(n, -1, dtype=np.int64)
    met[near[::-1]] = np.arange(len(near) - 1, -1, -1)
    if (pair[met[near]] == pair).all():  # no two pairs share a hash
        used = met >= 0
        return met[used], (np.cumsum(used) - 1)[near]
    _, first, number = np.unique(pair, return_index=True, return_inverse=True)
    return first, number


def _added(number: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, number, weight)
    return out


def _summed(keys: np.ndarray, weights: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ``bits`` bits, ascending and distinct, with the sums of their weights."""
    if not len(keys):
        return keys, weights
    if int(weights.max()) >> (64 - bits):
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    else:  # the weight fits into the bits that are free: one plain sort
        room = np.uint64(64 - bits)
        both = np.sort((keys << room) | weights.astype(np.uint64))
        keys = both >> room
        weights = (both & np.uint64((1 << (64 - bits)) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights, first)


def _deltas(keys: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte by byte, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _undone(body: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(body, decompressed_size=8 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel(), dtype=np.uint64)


def frequent_marks(packed: DataFrame, least: int, bits: int, parts: int) -> DataFrame:
    """block, part, n, hashes: those of a block's hashes whose weights over all blocks reach ``least``, ascending."""
    shift = np.uint64(bits - int(math.log2(parts)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, weights = Block(row).entries(bits)
                part = (keys >> shift).astype(np.int64)
                edges = np.searchsorted(part, np.arange(parts + 1))
                rows = [
                    {
                        "block": row["block"],
                        "part": p,
                        "hashes": _deltas(keys[a:b]),
                        "weights": pa.compress(weights[a:b].astype("<i8").tobytes(), codec="zstd", asbytes=True),
                        "n": b - a,
                    }
                    for p, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist()))
                    if b > a
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=ENTRY)

    def mark(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [_undone(r["hashes"], r["n"]) for r in rows]
        weights = [np.frombuffer(pa.decompress(r["weights"], decompressed_size=8 * r["n"], codec="zstd", asbytes=True), dtype="<i8") for r in rows]
        every, sums = _summed(np.concatenate(keys), np.concatenate(weights), bits)
        frequent = every[sums >= least]
        out = []
        for r, own in zip(rows, keys):
            near = np.minimum(np.searchsorted(frequent, own), max(len(frequent) - 1, 0))
            kept = own[frequent[near] == own] if len(frequent) else own[:0]
            if len(kept):
                out.append({"block": r["block"], "part": r["part"], "n": len(kept), "hashes": _deltas(kept)})
        return pa.Table.from_pylist(out, schema=MARK)

    dealt = packed.mapInArrow(deal, "block long, part long, hashes binary, weights binary, n long")
    return dealt.groupBy("part").applyInArrow(mark, "block long, part long, n long, hashes binary")


def counted(packed: DataFrame, marks: DataFrame, least: int, bits: int) -> DataFrame:
    """lang, phrase, k (words), f: every n-gram of at least ``least`` occurrences."""

    def name(content: pa.Table, marked: pa.Table) -> pa.Table:
        rows = content.to_pylist()
        if not rows:
            return FOUND.empty_table()
        block = Block(rows[0])
        parts = sorted(marked.to_pylist(), key=lambda r: r["part"])
        frequent = np.concatenate([_undone(r["hashes"], r["n"]) for r in parts]) if parts else np.zeros(0, dtype=np.uint64)
        found = list(block.phrases(frequent, bits))
        return pa.Table.from_batches(found, schema=FOUND)

    met = packed.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(name, "lang string, phrase string, k int, f long")
    return met.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def scored(frequent: DataFrame) -> DataFrame:
    """Of each frequent phrase of two words or more: a, and l, r, score of its lowest-scoring cut (ties: the first)."""
    phrases = frequent.where("k >= 2").select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    head = F.expr("substring_index(phrase, ' ', cut)")
    cuts = phrases.withColumn("head", head).withColumn("rest", F.expr("substring(phrase, length(head) + 2)"))
    known = frequent.select("lang", "phrase", "f")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("cast(2000000 as decimal(8,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    cuts = cuts.withColumn("score", score)
    best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def held_by_longer(frequent: DataFrame) -> DataFrame:
    """lang, phrase, longer: the highest count of a longer frequent phrase that has the phrase inside."""
    words = F.split("phrase", " ")

    def inside(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.col("k") - (n - 1))
        return F.when(F.col("k") > n, F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " ")))

    inner = [inside(n) for n in range(2, LONGEST)]
    longer = frequent.where("k >= 3").select("lang", "f", F.explode(F.flatten(F.array_compact(F.array(*inner)))).alias("phrase"))
    return longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, lang: Column | None = None, text: Column | None = None, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    lang, text = F.col("lang") if lang is None else lang, F.col("text") if text is None else text
    spark = docs.sparkSession
    packed = blocks(dictionary(docs, lang, text))
    amount = LONGEST * (packed.agg(F.sum("n_words").alias("n")).first()["n"] or 0)
    bits = min(63, math.ceil(math.log2(amount + 2)) + SPARE_BITS)
    parts = 1 << math.ceil(math.log2(pieces_for(spark, amount, RANGE_ENTRIES)))
    marks = stored(frequent_marks(packed, least, bits, parts), "marks")
    frequent = stored(counted(packed, marks, least, bits), "phrases")
    return ranked(frequent, totals(packed), top)


def totals(packed: DataFrame) -> DataFrame:
    """lang, n: words of a language, from the dictionary's chunks without their overlaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                body, (lang, tail, weight) = opened(row)
                n = _added(lang, (_ends(body)[1] - tail) * weight, len(row["langs"]))
                yield pa.RecordBatch.from_arrays([pa.array(row["langs"], type=pa.string()), pa.array(n)], names=["lang", "n"])

    return packed.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def ranked(frequent: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of a language that no longer phrase of nearly the same count holds."""
    rows = scored(frequent).join(held_by_longer(frequent), ["lang", "phrase"], "left")
    rows = rows.where(F.coalesce(F.expr("cast(100 as decimal(3,0)) * longer < cast(80 as decimal(3,0)) * a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return rows.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
