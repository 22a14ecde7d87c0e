"""N-gram Jaccard join by PartEnum signatures.

The set of a text is its distinct word shingles of five (fewer words: all of them as one; no words: none). Two texts link
when their sets have a Jaccard similarity of 3/4 or more.

1. Bands. Sizes are cut into bands whose ends lie so far apart that linked sets are in the same or in adjacent bands. A
   set goes to its band's instance, and to the next one if a set of that band could link with it.
2. Signatures. An instance partitions the domain of shingles by a hash into as many parts as its largest size asks for. A
   set's signatures are its projections on each part that is not empty. Linked sets of sizes s and t differ in at most
   (s + t) / 7 shingles, and each spoils one part at most; so with k the most that any partner may differ, a set agrees
   with every partner on all but k of its parts. The enumerated subsets of parts are the single ones.
3. Exactness. A set with more than k parts that are not empty shares a signature with each of its partners. The few that
   have fewer (small sets in crowded parts) add their single shingles as signatures, which they share among each other.
4. Count filter. A set with p parts needs p - k agreements with a partner, so sets with fewer repeated signatures than
   that, among all sets, have no link and leave: texts that merely share a passage do.
5. Prefixes. Sets that are equal become one, and the filter runs again. A set then keeps all but the n - 1 signatures that
   most sets have, n being the agreements it needs: of the signatures that two partners share, the one that fewest sets
   have is kept by both. Passages that many texts share join no others.
6. Families. Sets that share a kept signature, directly or through others, are a family: every link is inside one. A
   family is compared in blocks of some ``BLOCK`` sets, a task for each block and each pair of blocks, by counting common
   shingles exactly. A task returns a spanning forest of its links, so a group of near copies is as many rows as it has
   members, and no link between components is missed.

Signatures travel as packed arrays, one row per batch of sets and bucket of signatures; a bucket answers with one packed row
per batch, and a batch adds up its own. Buckets are as many as the texts ask for. Sets are compared by the 64-bit hashes of
their shingles. A batch numbers its sets in the order of the rows, so ``docs`` should be a stored table; where a task that
ran again met another order, the query fails.

Rows of equal id are one node of the graph, each row with its own n_shingles. A null id has no links and a null
component. A null or empty text has no shingles and is its own component. Extra columns are not returned: join by id.
Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import pieces_for, stored, text_of
from msgflow.llm.components import components

WIDTH = 5
PARTS = 0.45  # of an instance, for each shingle of its largest sets
FLUSH = 1_000_000  # signatures that a task holds
BATCH_SETS = 30_000  # a task holds; two owners each, in 16 bits
BUCKET_BYTES = 32 << 20  # of text for each bucket of signatures
BLOCK = 2048  # sets of a family that are compared in one task
BROADCAST_IDS = 1_000_000  # 8 bytes each; beyond it texts are shuffled to the ids
U = np.uint64


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x + U((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """Hashes of words, remembered up to a number of them."""

    MOST = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=U)
    codes = np.fromiter(map(hashes.__getitem__, words), U, len(words))
    width = min(WIDTH, len(codes))
    rolled = np.full(len(codes) - width + 1, width, dtype=U)
    for i in range(width):
        rolled = rolled * U(0x100000001B3) + codes[i : len(codes) - width + 1 + i]
        rolled ^= rolled >> U(29)
    return np.unique(mix(rolled))


def band_of(size: int) -> tuple[int, int, int]:
    """(number, least size, largest size) of a size's band: 1, 2-3, 4-7, 8-14, ... each end 16/9 of its start."""
    number, low, high = 0, 1, 1
    while size > high:
        number, low = number + 1, high + 1
        high = max(low, low * 16 // 9)
    return number, low, high


def instances(size: int) -> list[tuple[int, int]]:
    """(number, largest size) of the instances a set of that size goes to."""
    number, _, high = band_of(size)
    out = [(number, high)]
    low = high + 1
    if 4 * size >= 3 * low:
        out.append((number + 1, max(low, low * 16 // 9)))
    return out


def signatures(shingles: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """For each instance of a set: its signatures, and the agreements that any partner gives."""
    out = []
    size = len(shingles)
    mixed = mix(shingles, 1)
    for number, most in instances(size):
        may_differ = (size + min(most, 4 * size // 3)) // 7
        parts = max(1, round(PARTS * most)) if may_differ else 1
        part = (mix(shingles, 2) % U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.diff(part[order], prepend=-1))
        sums = np.add.reduceat(mixed[order], starts)
        found = mix(sums + part[order][starts].astype(U) * U(0xD6E8FEB86659FD93), 10 + 2 * number)
        need = len(found) - may_differ
        if need < 1:
            found, need = np.concatenate([found, mix(shingles, 11 + 2 * number)]), 1
        out.append((found, need))
    return out


#: What a batch knows of a set: its id, size and hash, and of either instance its signatures and the agreements it needs.
INFO = np.dtype(
    [("id", "<i8"), ("known", "?"), ("size", "<i8"), ("high", "<i8"), ("low", "<i8"), ("n", "<i4", 2), ("need", "<i4", 2)]
)
#: A batch's signatures in a bucket, or, with ``pieces``, what it knows of its sets and how many such rows it has.
PACKED_SQL = "bucket int, batch long, pieces int, signatures binary, owners binary, info binary"
PACKED = pa.schema(
    [
        ("bucket", pa.int32()),
        ("batch", pa.int64()),
        ("pieces", pa.int32()),
        *[(f, pa.binary()) for f in ("signatures", "owners", "info")],
    ]
)


def by_bucket(values: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, places of its signatures in order)."""
    bucket = (values % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    return [(int(bucket[part[0]]), part) for part in np.split(order, edges[1:]) if len(part)]


class Packer:
    """Gathers signatures of sets and gives them out by bucket. A batch is what is given out at once.

    A signature's owner is the place of its set in the batch, twice that and the instance; ascending, it travels as steps
    of two bytes, so a set costs the same however many buckets there are.
    """

    def __init__(self, buckets: int):
        self.buckets, self.batch = buckets, TaskContext.get().partitionId() << 32
        self.clear()

    def clear(self) -> None:
        self.found, self.owners, self.info, self.held = [], [], [], 0

    def add(self, node: int | None, size: int, digest: tuple[int, int], found: list[tuple[np.ndarray, int]]) -> None:
        for instance, (values, _) in enumerate(found):
            self.found.append(values)
            self.owners.append(2 * len(self.info) + instance)
            self.held += len(values)
        n = ([len(values) for values, _ in found] + [0, 0])[:2]
        need = ([need for _, need in found] + [1 << 30, 1 << 30])[:2]
        self.info.append((node or 0, node is not None, size, *digest, n, need))

    def full(self) -> bool:
        return self.held >= FLUSH or len(self.info) >= BATCH_SETS

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.info:
            return
        values = np.concatenate([*self.found, np.empty(0, U)])
        owner = np.repeat(np.array(self.owners, dtype=np.int64), [len(x) for x in self.found])
        parts = by_bucket(values, self.buckets)
        # What is known of the sets rides in a row of its own, to a bucket that changes.
        spread = (self.batch + (self.batch >> 32)) % self.buckets
        rows = [(spread, self.batch, len(parts), b"", b"", np.array(self.info, dtype=INFO).tobytes())]
        for bucket, part in parts:
            steps = np.diff(owner[part], prepend=0).astype("<u2")
            rows.append((bucket, self.batch, None, values[part].tobytes(), steps.tobytes(), b""))
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, PACKED)], schema=PACKED)
        self.batch += 1
        self.clear()


def _repeated(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray]:
    """Of a bucket: its signatures and their owners by row, where rows begin, and how many sets have each signature."""
    values = [np.frombuffer(x.as_py(), U) for x in rows["signatures"]]
    owner = [np.cumsum(np.frombuffer(x.as_py(), "<u2"), dtype=np.int32) for x in rows["owners"]]
    starts = np.cumsum([0, *map(len, values)]).tolist()
    values, owner = np.concatenate(values), np.concatenate(owner)
    order = np.argsort(values, kind="stable")
    first = np.flatnonzero(np.diff(values[order], prepend=~values[order][:1]))
    times = np.empty(len(values), dtype=np.int32)
    times[order] = np.repeat(*[np.diff([*first, len(values)]).astype(np.int32)] * 2)
    return values, owner, starts, times


def _back(rows: pa.Table, give) -> pa.Table:
    """Rows of a bucket sent back to their batches, with (owners, counts, signatures) that ``give`` makes of each."""
    values, owner, starts, times = _repeated(rows)
    out = []
    for r, start, end in zip(rows.select(["batch", "pieces", "info"]).to_pylist(), starts, starts[1:]):
        hit = start + np.flatnonzero(times[start:end] > 1)
        found = give(owner[hit], times[hit], values[hit])
        out.append(r | dict(zip(("owners", "counts", "signatures"), [x.tobytes() for x in found])))
    return pa.Table.from_pylist(out, schema=BACK)


BACK_SQL = "batch long, pieces int, info binary, owners binary, counts binary, signatures binary"
BACK = pa.schema(
    [
        ("batch", pa.int64()),
        ("pieces", pa.int32()),
        *[(f, pa.binary()) for f in ("info", "owners", "counts", "signatures")],
    ]
)


def _count(rows: pa.Table) -> pa.Table:
    """How many repeated signatures of the bucket the sets of a batch have, as packed rows of the batch."""

    def give(owner: np.ndarray, _times: np.ndarray, _values: np.ndarray) -> tuple:
        mine, counts = np.unique(owner, return_counts=True)
        return mine.astype("<i4"), counts.astype("<i4"), np.empty(0, U)

    return _back(rows, give)


def _hits(rows: pa.Table) -> pa.Table:
    """The repeated signatures of the bucket and how many sets have them, as packed rows of their batches."""
    return _back(rows, lambda owner, times, values: (owner.astype("<i4"), times.astype("<i4"), values))


def _batch(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """What a batch knows of its sets; all its owners, counts and signatures."""
    pieces = [x for x in rows["pieces"].to_pylist() if x is not None]
    if len(pieces) != 1 or rows.num_rows != pieces[0] + 1:
        raise RuntimeError("a task that ran again read its rows in another order: store the documents first")
    info = np.frombuffer(b"".join(rows["info"].to_pylist()), INFO)
    return info, [np.frombuffer(b"".join(rows[f].to_pylist()), t) for f, t in (("owners", "<i4"), ("counts", "<i4"), ("signatures", U))]


COUNTED = "id long, known boolean, size long, high long, low long, able boolean"


def _able(rows: pa.Table) -> pa.Table:
    """Every set of a batch, and whether it has enough repeated signatures in an instance."""
    info, (owner, counts, _) = _batch(rows)
    n = np.bincount(owner, counts, 2 * len(info)).reshape(-1, 2)
    able = (n >= info["need"]).any(axis=1)
    return pa.table({**{f: np.ascontiguousarray(info[f]) for f in ("id", "known", "size", "high", "low")}, "able": able})


def _prefixes(buckets: int):
    """The signatures by which a set meets every partner: all but the ``need - 1`` that most sets have.

    Partners agree on ``need`` signatures at least, so the one of these that fewest sets have is among them for both.
    """

    def run(rows: pa.Table) -> pa.Table:
        info, (owner, times, values) = _batch(rows)
        order = np.lexsort((values, times, owner))
        owner, values = owner[order], values[order]
        counts = np.bincount(owner, minlength=2 * len(info))
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        kept = place <= (counts - info["need"].ravel())[owner]
        ids, values = info["id"][owner[kept] // 2], values[kept]
        parts = by_bucket(values, buckets)
        rows = [(bucket, values[part].tobytes(), ids[part].tobytes()) for bucket, part in parts]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows), POSTED.types)], schema=POSTED) if rows else POSTED.empty_table()

    return run


POSTED_SQL = "bucket int, signatures binary, ids binary"
POSTED = pa.schema([("bucket", pa.int32()), ("signatures", pa.binary()), ("ids", pa.binary())])


EDGES = "u long, v long"
EDGES_ARROW = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _edges(pairs: np.ndarray) -> pa.Table:
    return pa.Table.from_arrays([pa.array(pairs[:, i], pa.int64()) for i in (0, 1)], schema=EDGES_ARROW)


def _hung(ids: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A forest of the groups that ``number`` names (in order): (id, least id of its component), for all but the least."""
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    least = np.repeat(np.minimum.reduceat(ids, starts), np.diff([*starts, len(ids)])) if len(ids) else ids
    pairs = np.unique(np.stack([ids, least], 1)[ids != least], axis=0)
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    for x, y in pairs.tolist():
        a, b = top(x), top(y)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([(x, top(x)) for x in list(root)], dtype=np.int64).reshape(-1, 2)


def _neighbours(rows: pa.Table) -> pa.Table:
    """A forest of the sets that share a signature of the bucket: a row a set at most."""
    values, ids = [np.frombuffer(b"".join(rows[f].to_pylist()), t) for f, t in (("signatures", U), ("ids", np.int64))]
    order = np.argsort(values, kind="stable")
    number = np.cumsum(np.diff(values[order], prepend=values[order][:1]) != 0)
    return _edges(_hung(ids[order], number))


def forest(sets: list[np.ndarray], one: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of ``one`` and of ``other`` (flags by place), as pairs of places."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[codes] > 1
    owner, codes = owner[shared], codes[shared]
    order = np.argsort(codes, kind="stable")
    posted = owner[order]
    first = np.searchsorted(codes[order], np.arange(len(counts)))
    until = np.searchsorted(codes[order], np.arange(len(counts)), side="right")
    at = np.searchsorted(owner, np.arange(len(sets) + 1))
    root = list(range(len(sets)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for x in np.flatnonzero(one).tolist():
        mine = codes[at[x] : at[x + 1]]
        if not len(mine):
            continue
        lengths = until[mine] - first[mine]
        places = np.repeat(first[mine] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(posted[places], minlength=len(sets))
        linked = (100 * common >= 75 * (sizes[x] + sizes - common)) & other & (common > 0)
        for y in np.flatnonzero(linked).tolist():
            a, b = top(x), top(y)
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((x, y))
    return found


def _compare(rows: pa.Table) -> pa.Table:
    """Links of the block pairs of a task: the sets of block i against those of block j of a family."""
    keys = list(zip(rows["family"].to_pylist(), rows["i"].to_pylist(), rows["j"].to_pylist()))
    tasks: dict[tuple, list[int]] = {}
    for place, key in enumerate(keys):
        tasks.setdefault(key, []).append(place)
    ids, block = rows["id"].to_numpy(), rows["block"].to_numpy()
    out = []
    for (_, i, j), places in tasks.items():
        sets = [np.frombuffer(rows["set"][p].as_py(), U) for p in places]
        mine = block[places]
        out += [(ids[places[x]], ids[places[y]]) for x, y in forest(sets, mine == i, mine == j)]
    return _edges(np.array(out, dtype=np.int64).reshape(-1, 2))


def _sign_texts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, hashes = Packer(buckets), WordHashes()
        for batch in batches:
            for node, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                shingles = shingle_set(text.as_py(), hashes)
                digest, found = (0, 0), []
                if len(shingles):
                    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), "<i8").tolist()
                    found = signatures(shingles) if node is not None else []
                packer.add(node, len(shingles), digest, found)
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    return run


def _sign_sets(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets)
        for batch in batches:
            for node, raw in zip(batch["id"].to_pylist(), batch["set"]):
                packer.add(node, 0, (0, 0), signatures(np.frombuffer(raw.as_py(), U)))
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        found = [shingle_set(x.as_py(), hashes).tobytes() for x in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.binary())], ["id", "set"])


def _family_links(sets: DataFrame, families: DataFrame, buckets: int) -> DataFrame:
    """(u, v): a spanning forest of the links inside every family. ``families`` has (u, v): v names the family of u."""
    sizes = families.groupBy("v").agg(F.ceil((F.count(F.lit(1)) + 1) / BLOCK).cast("int").alias("blocks"))
    member = families.join(sizes, "v").select("u", "v", "blocks").union(sizes.select("v", "v", "blocks"))
    member = member.select(F.col("u").alias("id"), F.col("v").alias("family"), "blocks")
    blocked = sets.join(member, "id")
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = blocked.select("id", "set", "family", "block", "blocks", partner.alias("_p"))
    i, j = F.least("block", "_p"), F.greatest("block", "_p")
    # Families of one block share tasks; a block pair of a larger one has its own.
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(buckets))).otherwise(
        F.xxhash64("family", i, j)
    )
    keyed = paired.select("id", "set", "family", "block", i.alias("i"), j.alias("j"), task.alias("task"))
    return keyed.groupBy("task").applyInArrow(_compare, EDGES)


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    size = source.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = pieces_for(spark, size, BUCKET_BYTES)
    signed = source.mapInArrow(_sign_texts(buckets), PACKED_SQL)
    counted = signed.groupBy("bucket").applyInArrow(_count, BACK_SQL).groupBy("batch").applyInArrow(_able, COUNTED)
    info = stored(counted, "signed")
    own = F.when(F.col("known"), F.col("id")).alias("doc_id")
    sets_of = info.where(F.col("known") & (F.col("size") > 0))
    first = sets_of.groupBy("high", "low").agg(F.min("id").alias("rep"))
    # Of equal sets one goes on.
    chosen = sets_of.where("able").groupBy("high", "low").agg(F.min("id").alias("doc_id"))
    chosen = stored(chosen.select("doc_id").distinct(), "candidates")
    hint = F.broadcast if chosen.count() <= BROADCAST_IDS else (lambda frame: frame)
    again = source.join(hint(chosen), "doc_id", "left_semi")
    sets = stored(again.mapInArrow(_sets, "id long, set binary"), "sets").where(F.length("set") > 0)
    weight = sets.agg(F.sum(F.length("set")).alias("n")).first()["n"] or 0
    buckets = pieces_for(spark, weight, BUCKET_BYTES)

    # Again among the candidates, now that equal sets are one.
    signed = sets.mapInArrow(_sign_sets(buckets), PACKED_SQL)
    hits = signed.groupBy("bucket").applyInArrow(_hits, BACK_SQL)
    posted = hits.groupBy("batch").applyInArrow(_prefixes(buckets), POSTED_SQL)
    families = components(posted.groupBy("bucket").applyInArrow(_neighbours, EDGES))
    edges = _family_links(sets, families, buckets)
    # Equal sets hang on the least id that has them; so rows of one id meet, too.
    same = sets_of.join(first, ["high", "low"]).select(F.col("id").alias("u"), F.col("rep").alias("v"))
    found = components(edges.union(same))
    rows = info.join(found, F.col("known") & (F.col("id") == F.col("u")), "left")
    component = F.when(F.col("known"), F.coalesce("v", "id"))
    return rows.select(own, F.col("size").alias("n_shingles"), component.alias("component_id"))
