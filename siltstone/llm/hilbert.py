"""Sharding along a Hilbert curve over several metadata dimensions, DataFrame operations only.

Each dimension is cut into 2**bits steps in its own order; a document's steps give its place on the curve.
Rows are range-sorted by that place and cut into runs of equal row counts, so that every shard covers a
compact box of all dimensions at once and files can be skipped by the least and greatest of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.order import with_total_before
from siltstone.session import written

BITS = 6
# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33
_OUT = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")


def ordered(column: Column, dtype: str) -> Column:
    """The column itself, or its text where the type has no order that all values can be sorted by."""
    return column.cast("string") if dtype.startswith(("map", "array", "struct", "variant")) else column


def _cuts(rows: DataFrame, name: str, steps: int) -> list:
    """Up to ``steps`` - 1 ascending cut points of a column, whole values at equal shares of its distinct ones.

    Distinct values are counted, not rows, so a value that holds a third of all rows takes one step only, and
    no more values than steps have one each. They are numbered range by range; only the cut points are collected.
    """
    values = written(rows.select(name).where(F.col(name).isNotNull()).distinct(), "hilbert-values")
    count = values.count()
    numbered = with_total_before(values.withColumn("_one", F.lit(1)), [name], "_one", "_at")
    first = F.expr(f"_at > 0 and (_at * {steps}L) div {max(count, 1)}L > ((_at - 1) * {steps}L) div {max(count, 1)}L")
    return [row[0] for row in numbered.where(first).orderBy("_at").select(name).collect()]


def _step(column: Column, cuts: list, dtype: str) -> Column:
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*(F.lit(c).cast(dtype) for c in cuts)), lambda cut: cut <= column))
    return F.when(column.isNull(), 0).otherwise(below).cast("int")


def hilbert_index(steps: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a point whose coordinates are integers below 2**bits.

    Works from the highest bit down on an array of coordinates: first undo the turns that lower-order cubes
    take, one (bit, coordinate) at a time, then turn the Gray code into a number.
    """
    n = len(steps)
    if n * bits > 62:
        raise ValueError("the curve's index would not fit a long")
    point = F.array(*(s.cast("long") for s in steps))

    def swapped(x: Column, turn: Column) -> Column:
        bit, i = turn["bit"], turn["i"]
        mask = bit - F.lit(1).cast("long")
        first, own = F.element_at(x, 1), F.element_at(x, i + 1)
        exchange = first.bitwiseXOR(own).bitwiseAND(mask)
        inverted = own.bitwiseAND(bit) != 0
        new_first = F.when(inverted, first.bitwiseXOR(mask)).otherwise(first.bitwiseXOR(exchange))
        new_own = F.when(inverted, own).otherwise(own.bitwiseXOR(exchange))
        return F.transform(x, lambda v, at: F.when(at == 0, new_first).when(at == i, new_own).otherwise(v))

    turns = F.array(
        *(
            F.struct(F.lit(1 << b).cast("long").alias("bit"), F.lit(i).alias("i"))
            for b in range(bits - 1, 0, -1)
            for i in range(n)
        )
    )
    turned = F.aggregate(turns, point, swapped) if bits > 1 else point
    # Gray code: each coordinate takes over the changes of those before it.
    gray = F.aggregate(
        turned,
        F.array().cast("array<bigint>"),
        lambda done, v: F.concat(done, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0))))),
    )
    last = F.element_at(gray, -1)
    flips = F.aggregate(
        F.array(*(F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1))) if bits > 1 else F.array().cast("array<bigint>"),
        F.lit(0).cast("long"),
        lambda t, bit: F.when(last.bitwiseAND(bit) != 0, t.bitwiseXOR(bit - 1)).otherwise(t),
    )

    def interleaved(x: Column, t: Column) -> Column:
        places = [(b, i) for b in range(bits - 1, -1, -1) for i in range(n)]
        out = F.lit(0).cast("long")
        for k, (b, i) in enumerate(places):
            one = F.shiftright(F.get(x, i).bitwiseXOR(t), b).bitwiseAND(F.lit(1).cast("long"))
            out = out + F.shiftleft(one, len(places) - 1 - k)
        return out

    packed = F.transform(F.array(F.struct(gray.alias("x"), flips.alias("t"))), lambda p: interleaved(p["x"], p["t"]))
    return F.get(packed, 0)


def _carried_names(carry: Sequence[str]) -> list[str]:
    """Names of the carried columns in the result: their own, unless one of the result's or another carried one."""
    taken = set(_OUT) | {c.lower() for c in carry}
    names = []
    for name in carry:
        if name.lower() in _OUT:
            name = f"carried_{name}"
            while name.lower() in taken:
                name = f"carried_{name}"
            taken.add(name.lower())
        names.append(name)
    return names


def shard_documents(
    docs: DataFrame,
    shards: int,
    dimensions: Mapping[str, Column] | None = None,
    carry: Sequence[str] = (),
    bits: int = BITS,
) -> DataFrame:
    """All rows in ``shards`` runs along the curve, their row counts at most one apart.

    Reads doc_id and text. ``dimensions`` are the columns to order by, language, source and size of the
    text unless told otherwise. Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32 (0 for a
    NULL text, which has no bytes), law (``rows``), shard from 0, slot in the shard from 0 without gaps, grown_shard (NULL: under
    this law more shards move many rows), curve, and the columns in ``carry``. Rows at one place of the curve
    are ordered by checksum and doc_id, so equal texts stand together. NULLs come first; a NULL text has size
    8. A carried column of a name that is returned anyway, in any case, gets ``carried_`` before its name. Fewer
    rows than shards leave shards empty. No row in gives no row out.
    """
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    if dimensions is None:
        dimensions = {n: F.col(n) for n in ("lang", "source") if n in docs.columns} | {"size": size}
    names = [f"_d{i}" for i in range(len(dimensions))]
    of = dict(zip(names, dimensions.values()))
    of = {n: ordered(of[n], dtype) for n, dtype in docs.select(*(c.alias(n) for n, c in of.items())).dtypes}
    keyed = docs.select(
        F.col("doc_id").alias("_id"),
        size.alias("_size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("_crc"),
        *(c.alias(n) for n, c in of.items()),
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("_carry") if carry else F.lit(None).cast("int").alias("_carry"),
    )
    kinds = dict(keyed.dtypes)
    curve = hilbert_index([_step(F.col(n), _cuts(keyed, n, 1 << bits), kinds[n]) for n in names], bits)
    order = ["_curve", "_crc", "_id"]
    # Written once, so that no position can shift if a task is redone.
    placed = written(
        keyed.withColumn("_curve", curve)
        .drop(*names)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "hilbert-order",
    ).withColumn("_range", F.shiftright("_place", _PARTITION_BIT))
    # One small row per range.
    held = placed.groupBy("_range").agg(F.count("*").alias("_held"), F.min("_place").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        held.select("_range", (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first")).alias("_offset")),
        "hilbert-offsets",
    )
    rows = placed.count()
    position = F.col("_place") + F.col("_offset")
    located = placed.join(offsets, "_range").withColumn("_at", position)
    # Shard s holds the positions from s * rows / shards, rounded down, up to where the next one starts.
    shard = F.expr(f"cast(((_at + 1) * {shards}L - 1) div {max(rows, 1)}L as int)")
    located = located.withColumn("_shard", shard)
    start = F.expr(f"(_shard * {max(rows, 1)}L) div {shards}L")
    return located.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        (F.col("_at") - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_curve").alias("curve"),
        *(F.col("_carry").getField(c).alias(n) for c, n in zip(carry, _carried_names(carry))),
    )
