"""Mixing sources to target weights by iterative proportional fitting (raking), DataFrame operations only.

Documents are summed to cells, one per combination of source, language and topic, before anything else
happens. The cells' token weights are then scaled to one margin after the other until all margins hold at
once. The ratio of a cell's weight to its tokens, times one factor for the token budget, is the
probability with which each of its documents is kept. The draw is a hash of the document's id: the same
document is kept or left out wherever and however often the job runs.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import written

#: Cells that one partition holds; a larger table of cells is spread over several.
CELLS = 100_000
#: Sweeps between two looks at the error, and looks at most.
SWEEPS = 4
LOOKS = 25
TOLERANCE = 1e-6
#: A mapping whose shares leave less than this leaves nothing.
LEFT = 1e-9

Target = Mapping[str | None, float] | float


def token_count(text: Column) -> Column:
    """Words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by the make-up of the whole text: symbols, numbers, lists, or prose."""
    size = F.greatest(F.length(text), F.lit(1))
    symbols = F.length(text) - F.length(F.translate(text, "%*&$#@<>{}[]|=\\/^~_+", ""))
    digits = F.length(text) - F.length(F.translate(text, "0123456789", ""))
    lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    return (
        F.when(text.isNull() | (F.length(text) == 0), "empty")
        .when(symbols / size >= 0.05, "symbols")
        .when(digits / size >= 0.02, "numbers")
        .when(size / lines < 120, "lists")
        .otherwise("prose")
    )


def _shares(cells: DataFrame, name: str, target: Target) -> DataFrame:
    """(value, share) of one margin, shares adding up to 1 over the values that occur.

    A number tempers the present shares: their power, 1 as they are, 0 all equal. A mapping gives shares by
    value; values it does not name divide what is left in proportion to their tokens. If it leaves nothing,
    they keep their present shares and the named ones divide the rest: only a value named with share 0 is
    left out.
    """
    present = cells.groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("tokens"))
    if isinstance(target, Mapping):
        if any(share < 0 for share in target.values()):
            raise ValueError("a share is negative")
        given = sum(target.values())
        left = 1.0 - given
        named = F.lit(None).cast("double")
        for value, share in target.items():
            named = F.when(F.col("value").eqNullSafe(F.lit(value)), F.lit(float(share))).otherwise(named)
        present = present.withColumn("named", named)
        row = present.agg(
            F.sum(F.when(F.col("named").isNull(), F.col("tokens"))).alias("unnamed"), F.sum("tokens").alias("all")
        ).first()
        unnamed, scale = row["unnamed"] or 1, 1.0
        if left < LEFT and row["unnamed"]:
            left = unnamed / row["all"]
            scale = (1.0 - left) / given if given else 1.0
        raw = F.coalesce(F.col("named") * F.lit(scale), F.lit(left) * F.col("tokens") / F.lit(float(unnamed)))
    else:
        raw = F.pow(F.col("tokens").cast("double"), F.lit(float(target)))
    shares = present.where("tokens > 0").select("value", raw.alias("raw"))
    total = shares.agg(F.sum("raw")).first()[0] or 1.0
    return shares.select("value", (F.col("raw") / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, Target]) -> DataFrame:
    """``cells`` (the target columns and tokens) with ``weight``: tokens scaled so that each margin has its shares.

    Weights add up to 1 and keep the cells' odds ratios. Cells without tokens get weight 0. Margins that no
    scaling can meet at once, because cells are missing, end as near as the last sweep came: ``gap`` is the
    largest distance between what a value of the cell holds in the end and its share, next to 0 where all
    margins of the cell are met.
    """
    names = list(targets)
    parts = max(1, -(-cells.count() // CELLS))
    # One partition for a table this small: the sums below then need no shuffle at all.
    state = cells.coalesce(1) if parts == 1 else cells.repartition(parts, *names)
    for k, name in enumerate(names):
        shares = _shares(cells, name, targets[name]).select(F.col("value").alias(f"_v{k}"), F.col("share").alias(f"_s{k}"))
        state = state.join(written(shares, "mixing-shares"), F.col(name).eqNullSafe(F.col(f"_v{k}")), "left")
        state = state.withColumn(f"_s{k}", F.coalesce(f"_s{k}", F.lit(0.0))).drop(f"_v{k}")
    state = written(state.withColumn("weight", F.col("tokens").cast("double")), "mixing-cells").coalesce(parts)

    def now(name: str) -> Column:
        # A value's cells, one per combination with the other margins: rows of a few numbers that spill.
        return F.sum("weight").over(Window.partitionBy(name))

    gap = F.greatest(F.lit(0.0), F.lit(0.0), *(F.abs(now(name) - F.col(f"_s{k}")) for k, name in enumerate(names)))
    last = None
    for _ in range(LOOKS):
        for _ in range(SWEEPS):
            for k, name in enumerate(names):
                scaled = F.when(F.col("_now") > 0, F.col("weight") * F.col(f"_s{k}") / F.col("_now")).otherwise(0.0)
                state = state.withColumn("_now", now(name)).withColumn("weight", scaled).drop("_now")
        state = written(state, "mixing-cells").coalesce(parts)
        off = state.select(gap.alias("gap")).agg(F.max("gap")).first()[0] or 0.0
        if off < TOLERANCE or (last is not None and abs(last - off) < TOLERANCE / 10):
            break
        last = off
    return state.withColumn("gap", gap).drop(*(f"_s{k}" for k in range(len(names))))


def with_probability(cells: DataFrame, budget: float) -> DataFrame:
    """Raked cells with the probability of keeping a document, so that ``budget`` of all tokens is expected.

    A probability is at most 1. What a full cell cannot give is asked of the others in proportion, which is
    settled by repeating the sum over the cells until no further cell is full.
    """
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    cells = cells.withColumn("ratio", ratio)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    wanted, factor, full = budget * total, 0.0, -1
    while True:
        capped = F.col("ratio") * F.lit(factor) >= 1
        row = cells.agg(
            F.coalesce(F.sum(F.when(capped, F.col("tokens"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(capped, 1)).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        full = row["full"]
        factor = max(factor, (wanted - row["taken"]) / row["open"])
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * F.lit(factor)))


def draw(key: Column, seed: int) -> Column:
    """A fixed number in [0, 1) for each key."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame, targets: Mapping[str, Target], budget: float, key: str = "doc_id", seed: int = 0
) -> DataFrame:
    """``docs`` with weight, probability, kept and gap, named ``mix_...``.

    ``docs`` must hold the columns named by ``targets`` and a column mix_tokens. weight is the factor on the
    document's tokens that makes all margins hold; kept says whether the draw takes the document; gap is how far
    the document's values are from their shares in the end, where the margins cannot all hold. NULL is a
    value of a margin like any other. Documents without tokens have weight and probability 0 unless their
    cell holds tokens. Rows of one key share their draw.
    """
    names = list(targets)
    cells = docs.groupBy(*names).agg(F.sum("mix_tokens").alias("tokens"))
    cells = written(cells, "mixing-cells")
    fitted = written(with_probability(rake(cells, targets), budget), "mixing-fitted")
    renamed = fitted.select(*(F.col(n).alias(f"_c_{n}") for n in names), "ratio", "probability", "gap")
    on = reduce(lambda a, b: a & b, (docs[n].eqNullSafe(renamed[f"_c_{n}"]) for n in names))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    return docs.join(renamed, on).select(
        *(docs[c] for c in docs.columns),
        (F.col("ratio") * F.lit(float(total))).alias("mix_weight"),
        F.col("probability").alias("mix_probability"),
        (draw(docs[key], seed) < F.col("probability")).alias("mix_kept"),
        F.col("gap").alias("mix_gap"),
    )
