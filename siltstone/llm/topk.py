"""Exact top-k inner products by norm buckets.

All vectors are put in order of falling length and cut into buckets of equal row counts, so a bucket has a
greatest length and a third of all rows of one length fill several. The longest bucket gives each query a
first threshold: its k-th best product so far. A query then visits only the buckets whose greatest length
can still reach that threshold, always a run from the first. In a bucket the threshold over both lengths is
the least cosine a vector must have. Where that is high, vectors are pruned by single coordinates: a unit
vector that close to the query has its coordinates in narrow ranges. Where it is low, only vectors too
short are pruned. What is left is multiplied in full.

Queries are put in order of how far they reach and cut into blocks, so those of a block visit much the same
buckets. A block of queries and a bucket that one of them visits meet in one task, which holds nothing else;
buckets that no query of a block visits are not sent to it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.order import with_total_before
from siltstone.session import written

BUCKET_ROWS = 8_192
QUERY_ROWS = 4_096
#: Least cosine from which coordinates prune better than lengths, and coordinates looked at.
COORDINATES_FROM = 0.8
COORDINATES = 4
_NONE = pd.DataFrame({"at": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
_EXACT_SINGLE, _EXACT_DOUBLE, _LONG = 2.0**24, 2.0**53, (1 << 63) - 1


def grid_vector(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; NULL for a NULL vector or one with a NULL or non-finite component."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _matrix(rows: pd.Series) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros, in a type that holds all products exactly."""
    width = max((len(v) for v in rows), default=0)
    if all(len(v) == width for v in rows) and len(rows):
        out = np.array(rows.tolist(), dtype=np.int64).reshape(len(rows), width)
    else:
        out = np.zeros((len(rows), width), dtype=np.int64)
        for i, v in enumerate(rows):
            out[i, : len(v)] = v
    return out


def _fitted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices of one width and of a type in which every product and partial sum is exact."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    top = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * width
    kind = np.float32 if top < _EXACT_SINGLE else np.float64 if top < _EXACT_DOUBLE else object
    return a.astype(kind), b.astype(kind)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > k and scores.dtype != object:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def search_bucket(queries: pd.DataFrame, bucket: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of a bucket for each query (at, vec_id, vector, norm, theta), none below the query's theta.

    ``at`` tells rows apart: only the query's own row is no candidate.
    """
    bucket = bucket.sort_values(["norm", "vec_id"], ascending=[False, True])
    q, p = _fitted(_matrix(queries["vector"]), _matrix(bucket["vector"]))
    ids, norms = bucket["vec_id"].to_numpy(), bucket["norm"].to_numpy(dtype=np.float64)
    own, q_own = bucket["at"].to_numpy(), queries["at"].to_numpy()
    q_ids, q_norms = queries["vec_id"].to_numpy(), queries["norm"].to_numpy(dtype=np.float64)
    theta = queries["theta"].to_numpy(dtype=np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where((theta > 0) & (q_norms > 0), theta / (q_norms * norms[0]), -1.0)
        # A hair of room: lengths are rounded.
        shortest = np.where((theta > 0) & (q_norms > 0), theta / q_norms * (1 - 1e-9), 0.0)
    reach = np.searchsorted(-norms, -shortest, side="right")
    by_coordinate = (cosine >= COORDINATES_FROM) & (cosine <= 1 + 1e-9)
    found = []

    def keep(row: int, scores: np.ndarray, rows: np.ndarray) -> None:
        fine = (scores >= theta[row]) & (own[rows] != q_own[row])
        scores, near = scores[fine], ids[rows[fine]]
        best = _best(scores, near, k)
        found.append((np.full(len(best), q_own[row]), np.full(len(best), q_ids[row]), near[best], scores[best]))

    for row in np.flatnonzero(by_coordinate & (reach > 0)):
        end, unit = reach[row], q[row].astype(np.float64) / q_norms[row]
        close, rest = cosine[row] * (1 - 1e-9), np.sqrt(max(0.0, 1 - cosine[row] ** 2))
        stays = np.arange(end)
        for at in np.argsort(-np.abs(unit))[:COORDINATES]:
            side = rest * np.sqrt(max(0.0, 1 - unit[at] ** 2)) + 1e-9
            part = p[stays, at].astype(np.float64) / norms[stays]
            # A cosine of ``close`` or more bounds how far each coordinate is from the query's own; the upper
            # or lower side opens up to 1 where the query's coordinate allows it.
            low = -1.0 if unit[at] < -close else close * unit[at] - side
            high = 1.0 if unit[at] > close else close * unit[at] + side
            stays = stays[(part >= low) & (part <= high)]
        keep(row, p[stays] @ q[row], stays)
    plain = np.flatnonzero(~by_coordinate & (reach > 0))
    plain = plain[np.argsort(-reach[plain], kind="stable")]
    for lo in range(0, len(plain), 256):
        rows = plain[lo : lo + 256]
        products = q[rows] @ p[: reach[rows].max()].T
        for row, scores in zip(rows, products):
            keep(row, scores, np.arange(len(scores)))
    if not found:
        return _NONE
    out = pd.DataFrame({n: np.concatenate(c) for n, c in zip(_NONE.columns, zip(*found))})
    if out["score"].dtype == object:
        out["score"] = out["score"].map(lambda s: max(-_LONG - 1, min(_LONG, int(s))))
    return out.astype({"score": "int64"})


def _task(k: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        queries, bucket = frame[frame["asks"]], frame[~frame["asks"]]
        if not len(queries) or not len(bucket):
            return _NONE
        return search_bucket(queries, bucket, k)

    return run


def top_products(
    vectors: DataFrame,
    queries: Column,
    k: int,
    vector: str = "vector",
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """For each row that meets ``queries``, the k others of highest inner product: query_id, rank, vec_id, score.

    Reads vec_id and ``vector``, an array of integers. Ties go to the smaller vec_id; with k others or fewer
    all are returned. Rows without vec_id or vector take no part. Rows that repeat a vec_id are rows of their own:
    each is a candidate, also for the other, and each that asks gets its own k rows. Vectors of unequal length are filled with zeros. A score beyond the range of a long
    becomes its end. No query gives no row.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<bigint>").alias("vector"))
    rows = rows.where("vec_id is not null and vector is not null")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("norm", F.sqrt(square)).withColumn("asks", queries)
    placed = with_total_before(
        rows.withColumn("_falling", -F.col("norm")).withColumn("_one", F.lit(1)), ["_falling", "vec_id"], "_one", "at"
    )
    placed = placed.select(
        "at", "vec_id", "vector", "norm", "asks", F.expr(f"cast(at div {bucket_rows} as int)").alias("bucket")
    )
    placed = written(placed, "topk-buckets")
    longest = placed.groupBy("bucket").agg(F.max("norm").alias("norm")).orderBy("bucket").collect()  # one per bucket
    asking = placed.where("asks").select("at", "vec_id", "vector", "norm")
    blocks = max(1, -(-asking.count() // query_rows))

    def met(questions: DataFrame, buckets: DataFrame, start: int) -> DataFrame:
        """Best rows for each question (block, reach, theta) in the buckets from ``start`` to its reach."""
        visited = F.explode(F.sequence(F.lit(start), F.col("reach") - 1)).alias("bucket")
        questions = questions.where(F.col("reach") > start)
        asked = questions.select("block", visited, F.lit(True).alias("asks"), "at", "vec_id", "vector", "norm", "theta")
        # A few numbers per block, written: the join to them is planned by their true size.
        runs = questions.groupBy("block").agg(F.max("reach").alias("reach"))
        held = buckets.join(written(runs.select("block", visited), "topk-visits"), "bucket").select(
            "block", "bucket", F.lit(False).alias("asks"), "at", "vec_id", "vector", "norm",
            F.lit(None).cast("double").alias("theta"),
        )
        pairs = asked.unionByName(held).groupBy("block", "bucket")
        return pairs.applyInPandas(_task(k), "at long, query_id long, vec_id long, score long")

    least = F.lit(float("-inf"))
    any_block = F.pmod(F.xxhash64("at"), F.lit(blocks)).alias("block")
    first = met(asking.select("*", any_block, F.lit(1).alias("reach"), least.alias("theta")), placed.where("bucket = 0"), 0)
    first = written(first, "topk-first")
    worst = first.groupBy("at").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    theta = written(worst.where(F.col("n") >= k).select("at", "worst"), "topk-theta")

    norms = np.array([-r["norm"] for r in longest])

    @F.pandas_udf("int")
    def buckets_in_reach(norm: pd.Series, theta: pd.Series) -> pd.Series:
        with np.errstate(divide="ignore", invalid="ignore"):
            shortest = np.where((theta > 0) & (norm > 0), theta / norm * (1 - 1e-9), 0.0)
        return pd.Series(np.searchsorted(norms, -shortest, side="right").astype(np.int32))

    # A hair of room, where a long is rounded to a double.
    floor = F.col("worst").cast("double") - F.abs(F.col("worst").cast("double")) * 1e-12
    bounded = asking.join(theta, "at", "left").withColumn("theta", F.coalesce(floor, least))
    bounded = bounded.withColumn("reach", buckets_in_reach("norm", "theta")).withColumn("_one", F.lit(1))
    bounded = with_total_before(bounded, ["reach", "at"], "_one", "_asked")
    bounded = written(bounded.withColumn("block", F.expr(f"_asked div {query_rows}")), "topk-questions")
    found = first.unionByName(met(bounded, placed, 1))
    ranked = Window.partitionBy("at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
