"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A text is the set of its paragraphs: lines, the long ones cut after every so many characters. How many follows from the
text's length in powers of two (an eighth of it, 32 at least and 4,096 at most), so that a short text is not one
paragraph and a long one is its lines. A paragraph is a 64-bit digest. A sketch has cells in three tables; every digest goes to one cell of each table, and a cell keeps a count, the
exclusive or of its digests and that of their checksums. Sketches of two versions subtract cell by cell: what both have
cancels. A cell left with one digest shows it (its checksum agrees); taking it out of its other cells frees more, until
all cells are empty and the differing digests of either side are known. Where peeling stops early, the sketch is built
again with twice the cells and other hash functions.

A sketch has as many blocks as its text's size asks for, and a digest belongs to one block; blocks are peeled and
enlarged on their own, so the work is linear in the text. The fingerprint is the sketch with one block, as text: equal
texts have equal fingerprints. The likeness of two versions is 1 - differing / (digests of one + digests of the other).

``with_next`` pairs every document with the one after it by id (after the last, the first). Ids are cut into ranges at
quantiles, the first document of a range is also put at the end of the range before, and a window per range reads the
next text: texts are shuffled once, and no task sees more than its range.

A null text is empty; an empty text has no paragraphs, and two empty texts are alike (1). A null id comes after all
others. Documents of equal id are ordered by text; repeated rows are each other's next. A single document is its own
next. An empty table gives no rows. Extra columns are returned unchanged if asked for, unless named as a result column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgflow.llm.common import pieces_for, text_of

TABLES = 3
CELLS = 30  # of a block, at first
LOAD = 16  # digests of both sides together that a block is made for
LEVELS = 8  # doublings; then the sets themselves are compared, which no run has needed
GRAINS = tuple(32 << i for i in range(8))  # characters of a paragraph at most
PER_TEXT = 8  # a text is cut into some so many
RANGE_BYTES = 64 << 20
FINGERPRINT_COLUMNS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

NO_LONGS = "array<bigint>"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def grain_of(n_chars: Column) -> Column:
    """The most characters a paragraph of a text of that length may have."""
    wanted = n_chars / PER_TEXT
    out = F.lit(GRAINS[-1])
    for grain in reversed(GRAINS[:-1]):
        out = F.when(wanted <= grain, F.lit(grain)).otherwise(out)
    return out


def digests(text: Column, grain: Column) -> Column:
    """The set of paragraph digests of a text."""

    def runs(most: int) -> Column:
        return F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{most}}}"), F.lit(0))

    parts = runs(GRAINS[-1])
    for most in GRAINS[:-1]:
        parts = F.when(grain == most, runs(most)).otherwise(parts)
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _entry(digest: Column, width: Column, seed: Column, sign: int | Column) -> Column:
    """A digest with its checksum and its cell in each table of ``width`` cells."""
    spots = [
        (F.pmod(F.xxhash64(digest, seed, F.lit(t)), width) + width * F.lit(t)).cast("int").alias(f"s{t}")
        for t in range(TABLES)
    ]
    signed = F.lit(sign) if isinstance(sign, int) else sign
    return F.struct(signed.alias("sign"), digest.alias("key"), _check(digest).alias("check"), *spots)


def _in_cell(entry: Column, at: Column) -> Column:
    return (entry["s0"] == at) | (entry["s1"] == at) | (entry["s2"] == at)


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit("check"), digest)


def _sum(entries: Column) -> Column:
    return F.aggregate(entries, F.lit(0), lambda acc, e: acc + e["sign"])


def _xor(entries: Column, field: str) -> Column:
    return F.aggregate(entries, F.lit(0).cast("long"), lambda acc, e: acc.bitwiseXOR(e[field]))


def _cells(entries: Column, width: Column) -> Column:
    """Cells of entries (sign, key, check, spots), ``width`` in each table: an array of (n, key, check)."""

    def cell(all_entries: Column, at: Column) -> Column:
        return let(
            F.filter(all_entries, lambda e: _in_cell(e, at)),
            lambda mine: F.struct(
                _sum(mine).alias("n"), _xor(mine, "key").alias("key"), _xor(mine, "check").alias("check")
            ),
        )

    places = F.sequence(F.lit(0), width * F.lit(TABLES) - F.lit(1))
    return let(entries, lambda e: F.transform(places, lambda at: cell(e, at)))


def sketch(keys: Column, width: Column, seed: Column) -> Column:
    """The cells of a set of digests."""
    return _cells(F.transform(keys, lambda k: _entry(k, width, seed, 1)), width)


def subtracted(one: Column, other: Column, width: Column, seed: Column) -> Column:
    """sketch(one) minus sketch(other). Sketches are linear: the digests of the other side enter with a minus sign."""
    plus = F.transform(one, lambda k: _entry(k, width, seed, 1))
    minus = F.transform(other, lambda k: _entry(k, width, seed, -1))
    return _cells(F.concat(plus, minus), width)


def peel(sketched: Column, width: Column, seed: Column) -> Column:
    """Digests that a subtracted sketch shows: the array of those found, null if it could not be emptied."""
    start = F.struct(sketched.alias("cells"), F.array().cast(NO_LONGS).alias("found"), F.lit(True).alias("more"))

    def take(cell: Column, at: Column, pure: Column) -> Column:
        return let(
            F.filter(pure, lambda p: _in_cell(p, at)),
            lambda mine: F.when(F.size(mine) == 0, cell).otherwise(
                F.struct(
                    (cell["n"] - _sum(mine)).alias("n"),
                    cell["key"].bitwiseXOR(_xor(mine, "key")).alias("key"),
                    cell["check"].bitwiseXOR(_xor(mine, "check")).alias("check"),
                )
            ),
        )

    def pure_of(state: Column) -> Column:
        shown = F.filter(
            state["cells"], lambda c: ((c["n"] == 1) | (c["n"] == -1)) & (c["check"] == _check(c["key"]))
        )
        # A digest is pure in up to three cells; its sign is the same in all.
        signed = F.array_distinct(F.transform(shown, lambda c: F.struct(c["n"].alias("sign"), c["key"].alias("key"))))
        return F.transform(signed, lambda s: _entry(s["key"], width, seed, s["sign"]))

    def step(state: Column) -> Column:
        return let(
            pure_of(state),
            lambda pure: F.struct(
                F.transform(state["cells"], lambda c, at: take(c, at, pure)).alias("cells"),
                F.concat(state["found"], pure["key"]).alias("found"),
                (F.size(pure) > 0).alias("more"),
            ),
        )

    # A round frees one digest at least, and no more digests than cells can be found.
    rounds = F.sequence(F.lit(0), width * F.lit(TABLES))
    done = F.aggregate(rounds, start, lambda s, _: F.when(s["more"], step(s)).otherwise(s))
    return let(
        done,
        lambda s: F.when(
            F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)), s["found"]
        ),
    )


def _blocks(keys: Column, n_blocks: Column) -> Column:
    """A set of digests as an array of blocks. Two steps, so that the work is not blocks times digests."""

    def split(tagged: Column, coarse: Column, fine: Column) -> Column:
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), coarse - 1),
                lambda i: let(
                    F.filter(tagged, lambda x: F.floor(x["g"] / fine) == i),
                    lambda part: F.transform(
                        F.sequence(F.lit(0), fine - 1),
                        lambda j: F.filter(part, lambda x: x["g"] % fine == j)["k"],
                    ),
                ),
            )
        )

    side = F.ceil(F.sqrt(n_blocks)).cast("int")
    tagged = F.transform(
        keys, lambda k: F.struct(k.alias("k"), F.pmod(F.xxhash64(F.lit("block"), k), side * side).cast("int").alias("g"))
    )
    return let(tagged, lambda t: split(t, side, side))


def _differing(one: Column, other: Column) -> Column:
    """Number of differing digests of a block, by peeling; larger sketches until one can be emptied."""

    def attempt(level: Column) -> Column:
        width, seed = level["width"], level["seed"]
        return F.size(peel(subtracted(one, other, width, seed), width, seed))

    # size of null is -1: not emptied.
    levels = F.array(*[F.struct(F.lit(CELLS // TABLES << i).alias("width"), F.lit(i).alias("seed")) for i in range(LEVELS)])
    tried = F.aggregate(levels, F.lit(-1), lambda n, level: F.when(n >= 0, n).otherwise(attempt(level)))
    exact = F.size(F.array_except(one, other)) + F.size(F.array_except(other, one))
    return let(tried, lambda n: F.when(n >= 0, n).otherwise(exact))


def likeness(one: Column, other: Column) -> Column:
    """1 - differing / all digests of both sides, from 0 to 1; 1 where both are empty."""
    blocks = F.greatest(F.ceil((F.size(one) + F.size(other)) / LOAD), F.lit(1)).cast("int")
    parts = let(
        blocks, lambda g: F.zip_with(_blocks(one, g), _blocks(other, g), lambda a, b: _differing(a, b))
    )
    total = F.size(one) + F.size(other)
    differing = F.aggregate(parts, F.lit(0), lambda acc, n: acc + n)
    return F.when(total == 0, F.lit(1.0)).otherwise(1 - differing / total)


def fingerprint(keys: Column) -> Column:
    """The sketch with one block as text: count and digests of every cell."""
    cells = sketch(keys, F.lit(CELLS // TABLES), F.lit(0))
    return F.array_join(F.transform(cells, lambda c: F.concat(c["n"].cast("string"), F.lit(":"), F.hex(c["key"]))), " ")


def range_of(value: Column, cuts: list) -> Column:
    """Number of cuts that are not above the value. Two steps, as for blocks."""
    if not cuts:
        return F.lit(0)
    every = max(1, int(len(cuts) ** 0.5))
    points = F.array(*[F.lit(c) for c in cuts])
    coarse = F.array(*[F.lit(c) for c in cuts[every - 1 :: every]])
    passed = F.size(F.filter(coarse, lambda c: c <= value)) * every
    return passed + F.size(F.filter(F.slice(points, passed + 1, F.lit(every)), lambda c: c <= value))


def with_next(docs: DataFrame, keep: list[str] | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(row, text, next_text) for every row of ``docs`` (doc_id, text); row holds the columns to keep."""
    keep = ["doc_id"] if keep is None else keep
    spark = docs.sparkSession
    # One row for the driver: size, least id, and a cut for every range.
    weight = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("first")).first()
    ranges = pieces_for(spark, weight["bytes"] or 0, range_bytes)
    cuts = []
    if ranges > 1 and weight["first"] is not None:
        shares = [i / ranges for i in range(1, ranges)]
        found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * ranges)).alias("cuts")).first()["cuts"]
        cuts = sorted({c for c in found if c > weight["first"]})
    last = F.lit(len(cuts))
    own = F.when(F.col("doc_id").isNull(), last).otherwise(range_of(F.col("doc_id"), cuts))
    opens = F.col("doc_id").isin(cuts) if cuts else F.lit(False)
    before = F.when(F.col("doc_id").eqNullSafe(F.lit(weight["first"])), last).when(opens, own - 1)
    places = F.array_compact(
        F.array(
            F.struct(own.alias("range"), F.lit(False).alias("tail")),
            F.when(before.isNotNull(), F.struct(before.alias("range"), F.lit(True).alias("tail"))),
        )
    )
    spread = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"),
        F.col("doc_id").alias("_id"),
        text_of(F.col("text")).alias("text"),
        F.explode(places).alias("_p"),
    ).select("row", "_id", "text", "_p.range", "_p.tail")
    order = Window.partitionBy("range").orderBy("tail", F.col("_id").asc_nulls_last(), "text")
    return spread.withColumn("next_text", F.lead("text").over(order)).where(~F.col("tail")).select("row", "text", "next_text")


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many, or all, of
    the next document. ``keep`` lists the columns to return (doc_id if not given).
    """
    keep = ["doc_id"] if keep is None else [c for c in keep if c not in FINGERPRINT_COLUMNS]
    rows = with_next(docs, keep).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    head = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half)
    edited = F.concat(head, F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    rows = rows.withColumns({"grain": grain_of(F.col("n_chars")), "edited_grain": grain_of(F.char_length("edited"))})
    # Versions are compared at the grain of the text; the edited text's own fingerprint has its own grain.
    rows = rows.select(
        "row",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text"), F.col("grain")).alias("one"),
        digests(F.col("edited"), F.col("grain")).alias("two"),
        F.when(F.col("grain") != F.col("edited_grain"), digests(F.col("edited"), F.col("edited_grain"))).alias("own"),
        digests(F.col("next_text"), F.col("grain")).alias("three"),
    )
    return rows.select(
        "row.*",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("one")).alias("fingerprint"),
        fingerprint(F.coalesce("own", "two")).alias("edited_fingerprint"),
        likeness(F.col("one"), F.col("two")).alias("near_edited"),
        likeness(F.col("one"), F.col("three")).alias("near_next"),
    )
