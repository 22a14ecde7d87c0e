"""Sharding along a Hilbert curve over several metadata dimensions.

1. Each dimension is quantised to 2**bits levels of nearly equal row counts. Numbers are binned by magnitude (16 bins to
   a power of two), texts by the two bytes that follow the prefix common to all values; both tables have at most 65,536
   rows whatever the input, and keep order, so a level is a range of values.
2. The levels of a row are a cell of a cube; the cell's place on the Hilbert curve is its sort key. Neighbours on the
   curve differ in one level by one, so a run of the curve is a compact box in every dimension at once.
3. Rows are numbered along the curve and cut into runs. The number of a row is that of the rows in cells before, plus
   those in pieces of its cell before, plus its place in its piece. A cell is split by a hash of id and text into pieces
   of at most some ``piece_rows`` rows, so a cell with a third of all rows is many tasks; nothing is sampled, and a lost
   executor recomputes the same numbers.

``rows`` is the law: run lengths differ by at most one. ``manifest`` has what a reader prunes by: per shard, the least
and greatest value of every dimension.

Nulls are the least value of a dimension. Empty texts, ties and repeated rows are rows like any other: equal rows may
land in neighbouring shards, each gets a slot of its own. An empty table gives no rows. Columns of the input that bear a
result's name give way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.llm.common import stored, text_of

SHARD_COLUMNS = ("size", "text_crc32", "law", "hilbert", "shard", "slot", "grown_shard")
FINE = 16


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """Place of a cell on the Hilbert curve. Levels are integers of ``bits`` bits; the index has bits * dimensions.

    Levels are read from the highest bit down: each bit plane first undoes the rotation that the planes above it
    caused, then the Gray code of the whole is taken back.
    """
    axes, n = [level.cast("long") for level in levels], len(levels)

    def bit(value: Column, at: int) -> Column:
        return F.shiftright(value, at).bitwiseAND(F.lit(1)) == 1

    def turn(axis: int, at: int):
        low = F.lit((1 << at) - 1).cast("long")

        def step(s: Column) -> Column:
            first, own = s[0], s[axis]
            swap = first.bitwiseXOR(own).bitwiseAND(low)
            turned = [s[i] for i in range(n)]
            other = first if axis == 0 else first.bitwiseXOR(swap)
            turned[0] = F.when(bit(own, at), first.bitwiseXOR(low)).otherwise(other)
            if axis:
                turned[axis] = F.when(bit(own, at), own).otherwise(own.bitwiseXOR(swap))
            return F.array(*turned)

        return step

    # One array column per step: a plain expression would repeat its operands at every step and double in size each time.
    state = F.array(*axes)
    for at in range(bits - 1, 0, -1):
        for axis in range(n):
            state = F.transform(F.array(state), turn(axis, at))[0]

    def gray(s: Column) -> Column:
        planes = [s[0]]
        for i in range(1, n):
            planes.append(s[i].bitwiseXOR(planes[-1]))
        return F.array(*planes)

    state = F.transform(F.array(state), gray)[0]

    def interleave(s: Column) -> Column:
        flip = reduce(
            lambda acc, at: acc.bitwiseXOR(F.when(bit(s[n - 1], at), F.lit((1 << at) - 1).cast("long")).otherwise(F.lit(0).cast("long"))),
            range(bits - 1, 0, -1),
            F.lit(0).cast("long"),
        )
        flipped = [s[i].bitwiseXOR(flip) for i in range(n)]
        out = F.lit(0).cast("long")
        for at in range(bits - 1, -1, -1):
            for value in flipped:
                out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(value, at).bitwiseAND(F.lit(1)))
        return out

    return F.transform(F.array(state), interleave)[0]


def _number_bin(value: Column) -> Column:
    """Order-keeping bin of a number: sign, power of two, and 16 steps between powers. Null is least, NaN greatest."""
    size = F.abs(value.cast("double"))
    power = F.floor(F.log2(F.greatest(size, F.lit(2.0**-500))))
    step = F.floor((size / F.pow(F.lit(2.0), power) - 1) * FINE)
    step = F.greatest(F.lit(0), F.least(step, F.lit(FINE - 1)))
    place = F.when(size == 0, F.lit(0)).otherwise((F.least(power, F.lit(500)) + 501) * FINE + step + 1)
    signed = F.when(value.cast("double") < 0, -place).otherwise(place)
    return F.when(value.isNull(), F.lit(-30000)).when(F.isnan(value.cast("double")), F.lit(30000)).otherwise(signed).cast("int")


def _text_bin(value: Column, skip: int) -> Column:
    """Order-keeping bin of a text: its two bytes after ``skip``. Null is least."""
    two = F.rpad(F.hex(F.substring(value.cast("binary"), skip + 1, 2)), 4, "0")
    return F.when(value.isNull(), F.lit(-1)).otherwise(F.conv(two, 16, 10).cast("int"))


def _bins(docs: DataFrame, dimensions: dict[str, Column]) -> dict[str, Column]:
    """The bin of every dimension. Texts need the least and greatest value, one row for the driver."""
    kinds = docs.select(*[c.alias(name) for name, c in dimensions.items()]).schema
    texts = [f.name for f in kinds if isinstance(f.dataType, T.StringType)]
    skip = {}
    if texts:
        ends = docs.agg(*[f(dimensions[t]).alias(f"{f.__name__}_{t}") for t in texts for f in (F.min, F.max)]).first()
        for t in texts:
            low, high = ((ends[f"{k}_{t}"] or "").encode() for k in ("min", "max"))
            skip[t] = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    return {
        name: _text_bin(column, skip[name]) if name in skip else _number_bin(column)
        for name, column in dimensions.items()
    }


def hilbert_shards(
    docs: DataFrame,
    dimensions: dict[str, Column],
    shards: int = 24,
    bits: int = 5,
    keep: list[str] | None = None,
    piece_rows: int = 1_000_000,
) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with size, text_crc32, law, hilbert, shard, slot and grown_shard (null: `rows`).

    ``dimensions`` maps a name to a column of numbers or texts; bits times dimensions is at most 15, which bounds the
    table of cells. ``keep`` lists the columns to return (doc_id if not given).
    """
    if not dimensions or bits * len(dimensions) > 15:
        raise ValueError("one dimension at least, and no more than 15 bits in all")
    keep = ["doc_id"] if keep is None else [c for c in keep if c not in SHARD_COLUMNS]
    names = [f"_d{i}" for i in range(len(dimensions))]
    bins = _bins(docs, dict(zip(names, dimensions.values())))
    spread = F.xxhash64(F.col("doc_id").cast("string"), text_of(F.col("text")))
    slim = docs.select(*[bins[n].alias(n) for n in names])
    # The cells with their rows: bins first, so that what follows is a bounded table.
    cells = slim.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    cells = stored(cells, "hilbert-bins")
    levels = {n: F.broadcast(f) for n, f in _levels_of(cells, names, bits).items()}  # at most 65,536 rows each
    place = hilbert_index([F.col(f"{n}_level") for n in names], bits).cast("int")
    counted = cells
    for n in names:
        counted = counted.join(levels[n], n)
    counted = counted.select(place.alias("hilbert"), "_n").groupBy("hilbert").agg(F.sum("_n").alias("_n"))
    # At most 2**15 cells: their running sum is one small task.
    order = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select(
        "hilbert",
        F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_cell_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
        F.ceil(F.col("_n") / F.lit(piece_rows)).alias("_pieces"),
    )
    counted = F.broadcast(stored(counted, "hilbert-cells"))

    def placed(columns: list[Column]) -> DataFrame:
        frame = docs.select(*columns, *[bins[n].alias(n) for n in names], spread.alias("_spread"))
        for n in names:
            frame = frame.join(levels[n], n)
        frame = frame.withColumn("hilbert", place).drop(*names, *[f"{n}_level" for n in names])
        piece = F.pmod("_spread", F.col("_pieces")).cast("int")
        return frame.join(counted, "hilbert").withColumn("_piece", piece)

    pieces = placed([]).groupBy("hilbert", "_piece").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("hilbert").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("hilbert", "_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_piece_before"))
    text = text_of(F.col("text"))
    rows = placed(
        [
            F.struct(*[F.col(c) for c in keep]).alias("_row"),
            F.col("doc_id").alias("_id"),
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        ]
    )
    within = F.row_number().over(Window.partitionBy("hilbert", "_piece").orderBy("_spread", "_id")) - 1
    rows = rows.withColumn("_within", within).join(pieces, ["hilbert", "_piece"])
    rank = F.col("_cell_before") + F.col("_piece_before") + F.col("_within")
    rows = rows.withColumn("_rank", rank)
    # The first (total mod shards) runs have one row more.
    short = F.floor(F.col("_total") / F.lit(shards))
    longer = F.col("_total") % F.lit(shards)
    edge = longer * (short + 1)
    shard = F.when(F.col("_rank") < edge, F.floor(F.col("_rank") / (short + 1))).otherwise(
        longer + F.floor((F.col("_rank") - edge) / F.greatest(short, F.lit(1)))
    )
    start = F.col("shard") * short + F.least(F.col("shard"), longer)
    return rows.withColumn("shard", shard.cast("int")).select(
        "_row.*",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "hilbert",
        "shard",
        (F.col("_rank") - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _levels_of(cells: DataFrame, names: list[str], bits: int) -> dict[str, DataFrame]:
    """Level of every bin of every dimension: the share of rows before the middle of the bin."""
    out = {}
    for name in names:
        counts = cells.groupBy(name).agg(F.sum("_n").alias("_n"))
        order = Window.orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        middle = F.coalesce(F.sum("_n").over(order), F.lit(0)) + F.col("_n") / F.lit(2.0)
        share = middle / F.sum("_n").over(Window.partitionBy())
        out[name] = counts.select(name, F.floor(share * F.lit(1 << bits)).cast("int").alias(f"{name}_level"))
    return out


def manifest(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """Per shard: rows, bytes, and the least and greatest value of the given columns."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"), *ends)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order inside each file, so that footers prune by every dimension."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
