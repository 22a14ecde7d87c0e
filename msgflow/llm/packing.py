"""Packing of tokenised documents into sequences of a fixed number of tokens.

1. ``pieces``: tasks tokenise whole texts, put an end token behind each, and cut what is longer than a sequence. A tokenizer
   that splits at white space gives a word the same ids wherever it stands, so a worker keeps the ids of words it has met
   (of ``KEPT_WORDS``, the half met most stays) and the tokenizer sees new words only, many in one call.
2. The histogram of piece lengths (at most ``capacity`` rows) goes to the driver, where ``configurations`` solves the
   configuration program and rounds it.
3. ``pack``: pieces are numbered within their length. A length of many pieces is cut into buckets by hash; buckets are
   counted, so a number is the pieces in buckets before plus the place in the own bucket, and no task has all pieces of a
   length. A length's numbers map to sequences and offsets by the table of configurations, which ``capacity`` bounds too.

A null text is empty: one end token. Repeated rows are packed each; a null id is kept as null. An empty table gives no rows.
Only id and text are read. With ``keep_ids`` the pieces carry their token ids, and ``sequences`` puts them together.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgflow.llm import configurations
from msgflow.llm.common import stored, text_of

CAPACITY = 4096
END_ID = 1
KEPT_WORDS = 900_000
STOPS = b".,;:!?"
SIMPLE = "\u0250"  # letters below keep their number in normal form
CALL_WORDS = 2000
SLAB_BYTES = 1 << 20
BUCKET_ROWS = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_kept: dict[int, "WordIds"] = {}  # of this worker process, by the vocabulary's checksum


class WordIds:
    """Token ids of words, from the tokenizer where a word is new."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True  # the special tokens' strings in a text are ordinary text
        ends = self.tokenizer.get_vocab()
        self.last = np.zeros(max(ends.values()) + 1, dtype=bool)
        self.last[[i for token, i in ends.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.begin, self.table, self.used = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

    def forget_rare(self) -> None:
        """Keep the half of the words that was met most."""
        used = np.pad(self.used, (0, len(self.number) - len(self.used)))
        kept = np.sort(np.argsort(-used, kind="stable")[: KEPT_WORDS // 2])
        kept = kept[used[kept] > 1]
        words, (ids, sizes) = list(self.number), self._take(kept)
        self.forget()
        self._add([words[i] for i in kept.tolist()], ids, sizes)
        self.used = used[kept] // 2

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.table = np.concatenate([self.table, ids])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])

    def _take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words one after the other, and each word's number of ids."""
        sizes = self.begin[codes + 1] - self.begin[codes]
        return self.table[np.repeat(self.begin[codes] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))], sizes

    def learn(self, words: set[bytes]) -> None:
        """Take the ids of new words, many in a call. A word of Latin letters has one token that ends a word, its last; for
        others the places of the tokens tell words apart. A stop behind a letter is a token of its own, so such a word's ids
        are those of its two parts."""
        ended = [w for w in words if w[-1] in STOPS and w[-2:-1].isalpha()]
        parts = [(w[:-1], w[-1:]) for w in ended]
        plain = list((words.difference(ended) | {x for p in parts for x in p}) - self.number.keys())
        plain = [w.decode() for w in plain]
        others = []
        simple = []
        for w in plain:
            (simple if w.isalpha() and max(w) < SIMPLE and w.lower().isalpha() else others).append(w)
        for at in range(0, len(simple), CALL_WORDS):
            part = simple[at : at + CALL_WORDS]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            sizes = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
            if len(sizes) == len(part):
                self._add([w.encode() for w in part], ids, sizes)
            else:
                others.extend(part)
        for at in range(0, len(others), CALL_WORDS):
            part = others[at : at + CALL_WORDS]
            found = self.tokenizer.encode_batch([" ".join(part)], add_special_tokens=False)[0]
            starts = np.cumsum([0, *(len(w) + 1 for w in part[:-1])])
            places = np.fromiter((o[0] for o in found.offsets), dtype=np.int64, count=len(found.ids))
            sizes = np.bincount(np.searchsorted(starts, places, side="right") - 1, minlength=len(part))
            self._add([w.encode() for w in part], np.array(found.ids, dtype=np.uint32), sizes)
        if ended:
            ids, sizes = self._take(np.fromiter((self.number[x] for p in parts for x in p), dtype=np.int64, count=2 * len(parts)))
            self._add(ended, ids, sizes[::2] + sizes[1::2])

    def of(self, texts: list[list[bytes]]) -> Iterator[np.ndarray]:
        """The ids of each text, given as its words."""
        if len(self.number) > KEPT_WORDS:
            self.forget_rare()
        lengths = [len(x) for x in texts]
        words = list(chain.from_iterable(texts))
        codes = np.fromiter(map(self.number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        new = np.flatnonzero(codes < 0).tolist()
        if new:
            self.learn({words[i] for i in new})
            codes[new] = [self.number[words[i]] for i in new]
        self.used = np.bincount(codes, minlength=len(self.number)) + np.pad(self.used, (0, len(self.number) - len(self.used)))
        flat, sizes = self._take(codes)
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *lengths])]
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield flat[begin:end]


def words_of(text: bytes) -> list[bytes]:
    """Words at ASCII white space. A-Z is lowered, as the tokenizer lowers it anyway, but not in texts with combining marks:
    there a small letter and a mark may join where a capital and a mark don't."""
    return (text if b"\xcc" in text or b"\xcd" in text else text.lower()).split()


def splits_at_space(vocabulary: str) -> bool:
    """Whether a tokenizer file gives words ids of their own: it lowers case, and its pattern keeps no white space."""
    rules = json.loads(vocabulary)
    steps = (rules.get("normalizer") or {}).get("normalizers", [])
    split = ((rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    kept = split.get("behavior") == "Removed" and split.get("invert") and split.get("pattern", {}).get("Regex", "")
    return {"type": "Lowercase"} in steps and rules["model"].get("end_of_word_suffix") == "</w>" and bool(kept) and kept.endswith(r"|[^\s\p{L}\p{N}]+")


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece; ``vocabulary`` is the text of a tokenizer file."""
    if not splits_at_space(vocabulary):
        raise ValueError("the tokenizer must drop white space and case, so that words have ids of their own")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file, whatever the corpus

    def cut(keys: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        mark = zlib.crc32(shared.value.encode())
        if mark not in _kept:
            _kept.clear()
            _kept[mark] = WordIds(shared.value)
        rows: list[tuple] = []
        bodies: list[np.ndarray] = []
        for key, ids in zip(keys, _kept[mark].of([words_of(t) for t in texts])):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            for piece, start in enumerate(range(0, len(ids), capacity)):
                body = ids[start : start + capacity]
                rows.append((key, piece, start, len(body), zlib.crc32(body.tobytes())))
                if keep_ids:
                    bodies.append(body)
        columns = list(zip(*rows))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        arrays = [pa.array(c, type=k) for c, k in zip(columns, kinds)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if keep_ids:
            arrays.append(pa.array([b.astype(np.int32) for b in bodies], type=pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                texts.append(text.as_buffer().to_pybytes())
                size += len(texts[-1])
                if size >= SLAB_BYTES:
                    yield from cut(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield from cut(keys, texts)

    return source.mapInArrow(run, PIECES + (", ids array<int>" if keep_ids else ""))


def fills(packed: list[tuple[configurations.Configuration, int]]) -> dict[str, np.ndarray]:
    """By length and first number: how many of the length a sequence has, the first sequence, and the offset there."""
    rows, used, sequence = [], Counter(), 0
    for chosen, amount in packed:
        offset = 0
        for length, times in sorted(Counter(chosen).items(), reverse=True):
            rows.append((length, used[length], times, sequence, offset))
            used[length] += times * amount
            offset += times * length
        sequence += amount
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "number", "times", "sequence", "offset"), table.T))


def numbered(found: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``found`` with a column number: gapless from 0 within a length, the same on every run."""
    buckets = [max(1, -(-counts.get(n, 0) // BUCKET_ROWS)) for n in range(max(counts, default=0) + 1)]
    hashed = F.xxhash64("doc_id", "piece", "ids_crc32")
    bucket = F.pmod(hashed, F.element_at(F.lit(buckets).cast("array<long>"), F.col("length").cast("int") + 1))
    rows = found.withColumn("bucket", bucket)
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("place", F.row_number().over(place) - 1).join(sizes, ["length", "bucket"])
    return rows.withColumn("number", F.col("before") + F.col("place")).drop("bucket", "before", "place")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset: every piece in one sequence, offsets gapless from 0."""
    found = stored(pieces(docs, vocabulary, capacity, end_id, keep_ids), "pieces")
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # ``capacity`` rows at most
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        histogram[length] = n
    table = fills(configurations.pack(histogram, capacity)[0])
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = shared.value
        first = np.searchsorted(rule["length"], np.arange(capacity + 2))
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            length, number = batch.column(at["length"]).to_numpy(), batch.column(at["number"]).to_numpy()
            row = np.zeros(len(length), dtype=np.int64)
            for n in np.unique(length):
                mine = length == n
                low, high = first[n], first[n + 1]
                row[mine] = low + np.searchsorted(rule["number"][low:high], number[mine], side="right") - 1
            inside = number - rule["number"][row]
            sequence = rule["sequence"][row] + inside // rule["times"][row]
            offset = rule["offset"][row] + inside % rule["times"][row] * length
            kept = [n for n in batch.schema.names if n != "number"]
            arrays = [batch.column(at[n]) for n in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "sequence_id", "offset"])

    rows = numbered(found, counts).select(*found.columns, "number")
    names = PIECES + (", ids array<int>" if keep_ids else "") + ", sequence_id long, offset long"
    return rows.mapInArrow(place, names)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of a packing with ``keep_ids``: sequence_id, ids and the pieces in it; at most ``capacity`` tokens each."""
    part = F.struct("offset", "doc_id", "piece", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return rows.select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"))).alias("parts"),
    )
