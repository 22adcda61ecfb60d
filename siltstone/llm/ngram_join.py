"""N-gram Jaccard self-join as a blocked sparse product of the document by n-gram incidence matrix.

The columns (n-grams) are cut into blocks by hash range. Documents of sizes that can meet the threshold
differ in few n-grams, so with more blocks than that difference two linked documents agree on whole
blocks of columns: equal block sums name the pairs of row groups whose product is not bounded away
beforehand. With spare blocks they agree on several, so each document may leave out its lightest ones, which
say least: a single n-gram of a common passage names no group. Those groups are then multiplied, block of columns by block of columns; overlap counts add
up and pairs whose count cannot reach the size-derived bound any more are dropped on the way. No pair is sampled
or left out: every linked pair is found and every link is counted in full, with n-grams told apart by 64-bit hashes.

Where large groups could hurt:

* Equal block sums are combined within a task first (one document stands for all), so a block shared by a
  third of all documents sends one row per task, not one per document.
* Documents with equal n-gram sets are one row of the matrix with a weight.
* A group of more rows than a task should hold is first drawn anew by its rows' rarest n-grams, exactly, so that
  texts which only have common passages part. What is still too large is cut by size class and hash; only classes
  whose sizes can meet the threshold are multiplied, each pair of cuts in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.components import connected_components
from siltstone.llm.shingles import mix, shingle_set
from siltstone.session import written

#: Block sums in a bucket (12 to 16 bytes each) and rows of a product block: what a task holds.
BUCKET_SUMS = 4_000_000
BLOCK_ROWS = 1_024
BLOCK_GRAMS = 4_000_000
#: Columns multiplied at once.
PANEL = 2_048
#: Sums gathered in a task before they are sent off.
FLUSH_SUMS = 500_000
#: Bits of a filter of doc_ids, at least (one bitmap of Spark's) and at most (8 MB).
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 26


class Threshold:
    """Jaccard similarity of at least ``num / den``, in integers only."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the threshold must be above 0 and at most 1")
        self.num, self.den = num, den

    def holds(self, overlap, size_a, size_b):
        return self.den * overlap >= self.num * (size_a + size_b - overlap)

    def least_overlap(self, size_a, size_b):
        """Least overlap that holds: overlap * (den + num) >= num * (a + b)."""
        total = self.num * (size_a + size_b)
        return -(-total // (self.den + self.num))

    def size_classes(self, largest: int) -> np.ndarray:
        """First size of each class. A size and one that can meet the threshold are in one class or in adjacent ones."""
        firsts = [1]
        while firsts[-1] <= largest:
            firsts.append(firsts[-1] * self.den // self.num + 1)
        return np.array(firsts, dtype=np.int64)

    def blocks(self, first_size: int) -> tuple[int, int]:
        """Blocks for pairs whose smaller size is in the class of ``first_size``, and most n-grams they differ in.

        The spare blocks make up for those that happen to hold none or one of a document's n-grams.
        """
        last_size = first_size * self.den // self.num
        differ = last_size * (self.den - self.num) // self.num
        return differ + 1 + (differ // 4 + 3 if differ else 0), differ

    def most_differing(self, size_a: int, size_b: int) -> int:
        """Most n-grams in which linked sets of these sizes can differ."""
        return (size_a + size_b) * (self.den - self.num) // (self.den + self.num)


def block_sums(grams: np.ndarray, threshold: Threshold, firsts: np.ndarray) -> np.ndarray:
    """Sums that name what a document holds in its heaviest blocks of columns, for its size class and the one below.

    A linked document differs from this one in ``differ`` n-grams at most, so all but ``differ`` of the filled blocks
    are equal in both at least. With the blocks in one order, by weight and sum, which depends on what they hold alone,
    the first equal one is therefore among the first ``differ`` + 1 of either. Where no more blocks are filled, two linked
    documents could agree on empty ones alone, and all blocks have their sums.
    """
    own = int(np.searchsorted(firsts, len(grams), side="right")) - 1
    running = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])
    out = []
    for kind in {own, max(own - 1, 0)}:
        count, differ = threshold.blocks(int(firsts[kind]))
        # The largest partner: of this document as the smaller one, or of the class below.
        largest = len(grams) * threshold.den // threshold.num if kind == own else int(firsts[own]) - 1
        differ = min(differ, threshold.most_differing(len(grams), largest))
        at = ((grams >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        edges = np.searchsorted(at, np.arange(count + 1, dtype=np.uint64))
        sums = running[edges[1:]] - running[edges[:-1]]
        weights = edges[1:] - edges[:-1]
        place = np.arange(count, dtype=np.uint64) + np.uint64(kind << 32)
        sums = mix(sums + mix(place))
        if np.count_nonzero(weights) > differ:
            sums = sums[np.lexsort((sums, -weights))[: differ + 1]]
        out.append(sums)
    return np.concatenate(out)


def linked_runs(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows with equal keys keep the one of the least node, and link the others to it.

    Returns positions to keep, and the two ends of the links.
    """
    order = np.lexsort((nodes, keys))
    sorted_keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    sizes = np.diff(np.append(starts, len(order)))
    leaders = np.repeat(nodes[order[starts]], sizes)
    members = nodes[order]
    apart = members != leaders
    return order[starts], members[apart], leaders[apart]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as (a, b), one per node that is not its component's least."""
    if not len(a):
        return a, b
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    pairs = np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)]), axis=1)
    x, y = pairs
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    apart = label != np.arange(len(nodes))
    return nodes[apart], nodes[label[apart]]


_SIGNED = "kind string, doc_id long, n long, h1 long, h2 long, other long, bucket int, sums binary, docs binary"
_FOUND = "kind string, doc_id long, n long, h1 long, h2 long, other long"


def _signature_batches(words: int, threshold: Threshold, buckets: int):
    """Per document its size and digest; links found within the task; block sums by bucket."""

    def facts(ids, sizes, digests) -> pd.DataFrame:
        halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        out = pd.DataFrame({"kind": "doc", "doc_id": ids, "n": sizes, "h1": halves[:, 0], "h2": halves[:, 1]})
        out["bucket"] = np.arange(len(out)) % buckets
        return out

    def flush(sums, docs) -> Iterator[pd.DataFrame]:
        keys = np.concatenate(sums)
        nodes = np.concatenate(docs)
        keep, a, b = linked_runs(keys, nodes)
        a, b = forest(a, b)
        if len(a):
            yield pd.DataFrame({"kind": "link", "doc_id": a, "other": b, "bucket": np.arange(len(a)) % buckets})
        keys, nodes = keys[keep], nodes[keep]
        of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # keys are sorted, so these are
        edges = np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))
        full = [i for i in range(buckets) if edges[i] < edges[i + 1]]
        yield pd.DataFrame(
            {
                "kind": "sums",
                "bucket": np.array(full, dtype=np.int32),
                "sums": [keys[edges[i] : edges[i + 1]].tobytes() for i in full],
                "docs": [nodes[edges[i] : edges[i + 1]].tobytes() for i in full],
            }
        )

    names = [part.split()[0] for part in _SIGNED.split(", ")]

    def typed(frame: pd.DataFrame) -> pd.DataFrame:
        blank = {c: None for c in ("sums", "docs") if c not in frame}
        # No NULLs, which would make floats of the numbers on their way to the next function.
        for c in ("doc_id", "n", "h1", "h2", "other"):
            if c not in frame:
                frame[c] = 0
        return frame.assign(**blank)[names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        firsts = threshold.size_classes(1 << 20)
        held, sums, docs = 0, [], []
        for batch in batches:
            ids, sizes, digests = [], [], []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                grams = shingle_set(text, words)
                ids.append(doc_id)
                sizes.append(len(grams))
                digests.append(xxhash.xxh3_128_digest(grams.tobytes()))
                if len(grams):
                    if len(grams) >= firsts[-1]:
                        firsts = threshold.size_classes(2 * len(grams))
                    own = block_sums(grams, threshold, firsts)
                    sums.append(own)
                    docs.append(np.full(len(own), doc_id, dtype=np.int64))
                    held += len(own)
                if held >= FLUSH_SUMS:
                    yield from map(typed, flush(sums, docs))
                    held, sums, docs = 0, [], []
            if ids:
                yield typed(facts(ids, sizes, digests))
        if held:
            yield from map(typed, flush(sums, docs))

    return run


def _bucket_links(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows of one bucket: facts and links pass, equal block sums of different tasks become links."""
    names = [part.split()[0] for part in _FOUND.split(", ")]
    passed = frame.loc[frame["kind"] != "sums", names]
    packed = frame.loc[frame["kind"] == "sums"]
    if not len(packed):
        return passed
    keys = np.frombuffer(b"".join(packed["sums"]), dtype=np.uint64)
    nodes = np.frombuffer(b"".join(packed["docs"]), dtype=np.int64)
    _, a, b = linked_runs(keys, nodes)
    a, b = forest(a, b)
    if not len(a):
        return passed
    links = pd.DataFrame({"kind": "link", "doc_id": a, "n": 0, "h1": 0, "h2": 0, "other": b})[names]
    return pd.concat([passed, links]) if len(passed) else links


def overlaps(sets: list[np.ndarray], threshold: Threshold, split: int | None = None):
    """Pairs (i, j) of rows whose sets meet the threshold, by products of column panels.

    With ``split``, only pairs of a row before it and a row from it on; else all pairs i < j.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    grams, columns, shared = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = shared[columns] > 1  # a column of one row adds to no overlap
    rows, columns = rows[keep], columns[keep]
    used, columns = np.unique(columns, return_inverse=True)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    if split is None:
        left = right = np.arange(len(sets))
    else:
        left, right = np.arange(split), np.arange(split, len(sets))
    need = threshold.least_overlap(sizes[left][:, None], sizes[right][None, :])
    possible = np.minimum(sizes[left][:, None], sizes[right][None, :]) >= need
    if split is None:
        possible &= left[:, None] < right[None, :]
    count = np.zeros(possible.shape, dtype=np.float32)
    rest = np.bincount(rows, minlength=len(sets))
    for start in range(0, len(used), PANEL):
        lo, hi = np.searchsorted(columns, [start, start + PANEL])
        panel = np.zeros((len(sets), min(PANEL, len(used) - start)), dtype=np.float32)
        panel[rows[lo:hi], columns[lo:hi] - start] = 1
        count += panel[left] @ panel[right].T
        rest -= np.bincount(rows[lo:hi], minlength=len(sets))
        # What is still to come cannot lift these pairs over their bound.
        possible &= count + np.minimum(rest[left][:, None], rest[right][None, :]) >= need
        if not possible.any():
            break
    i, j = np.nonzero(possible & (count >= need))
    return left[i], right[j]


_ROWS = "task long, side int, grp long, doc_id long, weight long, grams binary"
_LINKS = "doc_id long, other long, links long"


def _multiply(words: int, threshold: Threshold):
    """All groups of one task: exact links between their rows, as a forest and as counts per row."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        frame = frame.drop_duplicates(["grp", "side", "doc_id", "grams"])
        for _, group in frame.groupby("grp", sort=False):
            group = group.sort_values("side", kind="stable")
            sets = [np.frombuffer(g, dtype=np.uint64) for g in group["grams"]]
            ids, weight = group["doc_id"].to_numpy(), group["weight"].to_numpy()
            crossed = group["side"].max() > 0
            first = int((group["side"] <= 1).sum())
            if crossed and (first == 0 or first == len(group)):
                continue
            i, j = overlaps(sets, threshold, first if crossed else None)
            if not len(i):
                continue
            links = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
            a, b = forest(ids[i], ids[j])
            out.append(pd.DataFrame({"doc_id": a, "other": b, "links": 0}))
            out.append(pd.DataFrame({"doc_id": ids, "other": ids, "links": links.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"doc_id": [], "other": [], "links": []}, dtype="int64")

    return run


def _sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[shingle_set(t, words).tobytes() for t in batch["text"]])

    return run


def ngram_jaccard_join(
    docs: DataFrame,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    block_rows: int = BLOCK_ROWS,
    block_grams: int = BLOCK_GRAMS,
    bucket_sums: int = BUCKET_SUMS,
) -> DataFrame:
    """Links between documents whose sets of ``words``-word shingles have Jaccard similarity ``num / den`` or more.

    Reads ``doc_id`` and ``text``; other columns are ignored, whatever their names. Returns one row per
    input row: doc_id, n_shingles, component_id (least doc_id reachable by links, itself included) and
    n_links (number of other documents linked with it). Words are runs of other characters than blank and
    the bytes 9 to 13, with A-Z lower-cased; a text of fewer words is one shingle of all of them.

    NULL, empty and blank texts have no shingle and no link; they are components of their own. A row
    without doc_id gets its size, component NULL and no link. Rows of the same doc_id count as one
    document with the links of each. No row in gives no row out.
    """
    threshold = Threshold(num, den)
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.where("doc_id is not null")

    # About one gram per six bytes of text, and two block sums per (den - num) / num of the grams.
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    sums = 2.2 * size / 6 * (den - num) / num + 1
    buckets = max(1, int(-(-sums // bucket_sums)), int(spark.conf.get("spark.sql.shuffle.partitions")))

    signed = known.mapInPandas(_signature_batches(words, threshold, buckets), _SIGNED)
    found = written(signed.groupBy("bucket").applyInPandas(_bucket_links, _FOUND), "ngram-signatures")
    facts = found.where("kind = 'doc'").select("doc_id", "n", "h1", "h2")

    candidates = connected_components(found.where("kind = 'link'"), "doc_id", "other")
    groups = candidates.select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))
    # Equal sets are one row of the matrix. They have all block sums in common, so they share a group.
    members = written(facts.distinct().join(groups, "doc_id"), "ngram-members")
    classes = members.groupBy("grp", "h1", "h2", "n").agg(
        F.min("doc_id").alias("doc_id"), F.countDistinct("doc_id").alias("weight")
    )
    classes = written(classes, "ngram-classes")

    links = _product(docs, classes, threshold, words, block_rows, block_grams)
    linked = connected_components(links.where("doc_id <> other"), "doc_id", "other")
    counts = links.groupBy("doc_id").agg(F.sum("links").alias("links"))

    by_class = (
        classes.join(linked.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .join(counts, "doc_id", "left")
        .select(
            "grp", "h1", "h2", "n",
            F.coalesce("component", "doc_id").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    placed = (
        members.join(by_class, ["grp", "h1", "h2", "n"])
        .groupBy("doc_id")
        .agg(F.min("component").alias("component"), F.max("n_links").alias("n_links"))
    )
    result = facts.join(placed, "doc_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    nameless = (
        docs.where("doc_id is null")
        .mapInPandas(_sizes(words), "n long")
        .select(
            F.lit(None).cast("long").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.lit(None).cast("long").alias("component_id"),
            F.lit(0).cast("long").alias("n_links"),
        )
    )
    return result.unionByName(nameless)


def _sizes(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [len(shingle_set(t, words)) for t in batch["text"]]}, dtype="int64")

    return run


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with _perhaps: false only where ``ids`` has no such doc_id, so that few texts go through a join with them.

    The bitmaps of hashed doc_ids are bounded, whatever the number of ``ids``, and therefore broadcast by hint.
    """
    count, bits = ids.count(), LEAST_BITS
    while bits < min(16 * count, MOST_BITS):
        bits *= 2

    def place() -> Column:
        return F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(bits).cast("long"))

    def part() -> Column:
        return F.shiftright(place(), LEAST_BITS.bit_length() - 1)

    maps = ids.select(part().alias("_ngram_part"), F.bitmap_bit_position(place() + 1).alias("at"))
    maps = written(
        maps.groupBy("_ngram_part").agg(F.bitmap_construct_agg("at").alias("_ngram_map")), "ngram-filter"
    )
    joined = docs.join(F.broadcast(maps), part() == F.col("_ngram_part"), "left")
    at = F.pmod(place(), F.lit(LEAST_BITS)).cast("int")
    octet = F.conv(F.hex(F.substring("_ngram_map", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(octet / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2))
    return joined.withColumn("_perhaps", F.coalesce(bit == 1, F.lit(False))).drop("_ngram_part", "_ngram_map")


def _spread_grams(words: int, slots: int):
    """N-grams of (grp, h1, text) rows by slot of their hash, many rows packed together.

    ``h1`` names the set of n-grams; a text of the same doc_id with another set is left out.
    """

    def flush(grps, docs, sets) -> pd.DataFrame:
        grams = np.concatenate(sets)
        sizes = [len(s) for s in sets]
        of = ((grams >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
        order = np.argsort(of, kind="stable")
        columns = [np.repeat(np.array(x, dtype=np.int64), sizes)[order] for x in (grps, docs)] + [grams[order]]
        edges = np.searchsorted(of[order], np.arange(slots + 1, dtype=np.uint64))
        full = [i for i in range(slots) if edges[i] < edges[i + 1]]
        packed = ([c[edges[i] : edges[i + 1]].tobytes() for i in full] for c in columns)
        return pd.DataFrame(dict(zip(("slot", "grps", "docs", "grams"), (np.array(full, dtype=np.int32), *packed))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grps, docs, sets, held = [], [], [], 0
        for batch in batches:
            for grp, doc, text in zip(batch["grp"].tolist(), batch["h1"].tolist(), batch["text"].tolist()):
                grams = shingle_set(text, words)
                named = np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), dtype="<i8")[0] == doc
                if len(grams) and named:
                    grps.append(grp), docs.append(doc), sets.append(grams)
                    held += len(grams)
                if held >= FLUSH_SUMS:
                    yield flush(grps, docs, sets)
                    grps, docs, sets, held = [], [], [], 0
        if held:
            yield flush(grps, docs, sets)

    return run


def _holders(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group, document and n-gram of a slot's entries, each once, and how many documents of the group hold it."""
    grps, docs = (np.frombuffer(b"".join(frame[c]), dtype=np.int64) for c in ("grps", "docs"))
    grams = np.frombuffer(b"".join(frame["grams"]), dtype=np.uint64)
    order = np.lexsort((docs, grams, grps))
    grps, docs, grams = grps[order], docs[order], grams[order]
    new_gram = np.concatenate([[True], (grps[1:] != grps[:-1]) | (grams[1:] != grams[:-1])])
    once = new_gram | np.concatenate([[True], docs[1:] != docs[:-1]])
    grps, docs, grams, new_gram = grps[once], docs[once], grams[once], new_gram[once]
    starts = np.flatnonzero(new_gram)
    sizes = np.diff(np.append(starts, len(docs)))
    return grps, docs, grams, np.repeat(sizes, sizes)


def _own_grams(frame: pd.DataFrame) -> pd.DataFrame:
    """Per row the n-grams that no other row of its group holds."""
    _, docs, _, held = _holders(frame)
    found, counts = np.unique(docs[held == 1], return_counts=True)
    return pd.DataFrame({"h1": found, "own": counts})


def _shared_grams(frame: pd.DataFrame) -> pd.DataFrame:
    grps, docs, grams, held = _holders(frame)
    both = held > 1
    return pd.DataFrame({"grp": grps[both], "h1": docs[both], "gram": grams[both].view(np.int64), "held": held[both]})


def _refined(docs: DataFrame, rows: DataFrame, threshold: Threshold, words: int, block_grams: int) -> DataFrame:
    """(h1, grp): smaller groups for the ``rows`` (grp, doc_id, h1, n) of groups too large for a task.

    A row with a link holds ``num / den`` of its n-grams in common with another, so a row with more n-grams of its
    own than that leaves room for has no link and goes. Of the others, linked ones share one of their rarest n-grams,
    as many as may differ and one more, in one order of all n-grams by rarity. Rows that meet on such an n-gram form
    the new groups; what thousands of texts have in common is rare in none of them and joins nothing.
    """
    # As many slots as the n-grams need: each adds a row per document it has n-grams of.
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slots = max(1, -(-4 * int(total) // block_grams))

    docs = _marked(docs, rows.select("doc_id")).where("_perhaps").drop("_perhaps")

    def by_slot(of: DataFrame, what, schema: str) -> DataFrame:
        texts = docs.join(of.select("grp", "doc_id", "h1"), "doc_id").select("grp", "h1", "text")
        spread = texts.mapInPandas(_spread_grams(words, slots), "slot int, grps binary, docs binary, grams binary")
        return spread.repartition(slots, "slot").groupBy("slot").applyInPandas(what, schema)

    num, den = threshold.num, threshold.den
    own = by_slot(rows, _own_grams, "h1 long, own long").groupBy("h1").agg(F.sum("own").alias("own"))
    open_ = written(
        rows.join(own, "h1", "left")
        .where(den * (F.col("n") - F.coalesce("own", F.lit(0))) >= num * F.col("n"))
        .select("grp", "doc_id", "h1", "n"),
        "ngram-open",
    )
    shared = by_slot(open_, _shared_grams, "grp long, h1 long, gram long, held long").join(
        open_.select("h1", "n").distinct(), "h1"
    )
    # n - ceil(num * n / den) + 1 of a row's n-grams are looked at, those of its own before all others.
    mine = Window.partitionBy("grp", "h1")
    looked_at = F.expr(f"n - (n * {num} + {den - 1}) div {den} + 1") - (F.col("n") - F.count("*").over(mine))
    rank = F.row_number().over(mine.orderBy("held", "gram"))
    ranked = shared.withColumns({"rank": rank, "most": looked_at}).where("rank <= most")
    first = written(ranked.select("grp", "gram", "h1"), "ngram-rarest")
    least = first.groupBy("grp", "gram").agg(F.min("h1").alias("least"))
    edges = first.join(least, ["grp", "gram"]).where("h1 <> least").select("h1", "least").distinct()
    return connected_components(edges, "h1", "least").select(F.col("node").alias("h1"), F.col("component").alias("grp"))


def _product(docs, classes, threshold: Threshold, words: int, block_rows: int, block_grams: int) -> DataFrame:
    """(doc_id, other, links): the forest of links between rows, and each row's links on a row to itself."""
    cuts = F.greatest(F.ceil(F.col("rows") / block_rows), F.ceil(F.col("grams") / block_grams))

    def sizes_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("grp").agg(F.count("*").alias("rows"), F.sum("n").alias("grams")).where("rows > 1")

    sized = written(sizes_of(classes).withColumn("cuts", cuts), "ngram-sizes")
    grouped = classes.select("grp", "doc_id", "n", "weight", "h1")
    large = sized.where("cuts > 1").select("grp")
    if not large.isEmpty():
        # Block sums name candidates; chains of them can hold much of a corpus, so large groups are drawn anew.
        rows = written(grouped.join(large, "grp"), "ngram-large")
        anew = rows.drop("grp").join(_refined(docs, rows, threshold, words, block_grams), "h1")
        grouped = written(grouped.join(large, "grp", "left_anti").unionByName(anew), "ngram-groups")
        sized = written(sizes_of(grouped).withColumn("cuts", cuts), "ngram-sizes")
    rows = grouped.join(sized, "grp")

    # Whole groups: many of them share a task, by hash, so that a task holds about one block.
    total = sized.where(cuts <= 1).agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("grams"), F.lit(0))).first()
    tasks = max(1, -(-total[0] // block_rows), -(-total[1] // block_grams))
    whole = rows.where("cuts = 1").select(
        F.pmod(F.xxhash64("grp"), F.lit(tasks)).alias("task"),
        F.lit(0).alias("side"),
        F.lit(0).cast("long").alias("part"),
        "grp", "doc_id", "weight",
    )

    # Cut groups: by size class and hash. Each pair of cuts that can hold a linked pair is a task.
    firsts = threshold.size_classes(grouped.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0])
    kind = F.size(F.filter(F.lit([int(x) for x in firsts]), lambda first: first <= F.col("n")))
    cut = rows.where("cuts > 1").withColumn("kind", kind)
    kinds = cut.groupBy("grp", "kind").agg(F.count("*").alias("r"), F.sum("n").alias("g"))
    pieces = F.greatest(F.ceil(2 * F.col("r") / block_rows), F.ceil(2 * F.col("g") / block_grams))
    kinds = written(kinds.select("grp", "kind", pieces.alias("pieces")), "ngram-cuts")
    cut = cut.join(kinds, ["grp", "kind"])
    above = kinds.select("grp", (F.col("kind") - 1).alias("kind"), F.col("pieces").alias("above"))
    below = kinds.select("grp", (F.col("kind") + 1).alias("kind"), F.col("pieces").alias("below"))
    cut = cut.join(above, ["grp", "kind"], "left").join(below, ["grp", "kind"], "left")
    mine = F.pmod(F.xxhash64("doc_id"), F.col("pieces"))

    def partners(count, name):
        """One struct per cut numbered below ``count``."""
        return F.when(count > 0, F.transform(F.sequence(F.lit(0).cast("long"), count - 1), name)).otherwise(
            F.expr("cast(array() as array<struct<low:long,i:long,j:long,side:int>>)")
        )

    def pair(low, i, j, side):
        return F.struct(
            low.cast("long").alias("low"), i.cast("long").alias("i"), j.cast("long").alias("j"), side.alias("side")
        )

    k, zero = F.col("kind"), F.lit(0)
    # Pairs within a class are (low = 2 * kind, i <= j); pairs with the class above are (2 * kind + 1, i, j).
    within = partners(
        F.col("pieces"),
        lambda x: pair(
            2 * k,
            F.least(x, mine),
            F.greatest(x, mine),
            F.when(x == mine, 0).when(mine < x, 1).otherwise(2),
        ),
    )
    upwards = partners(F.coalesce("above", zero.cast("long")), lambda x: pair(2 * k + 1, mine, x, F.lit(1)))
    downwards = partners(F.coalesce("below", zero.cast("long")), lambda x: pair(2 * k - 1, x, mine, F.lit(2)))
    split = cut.select(
        "grp", "doc_id", "weight", F.explode(F.concat(within, upwards, downwards)).alias("p")
    ).select(
        (F.shiftrightunsigned(F.xxhash64("grp", "p.low", "p.i", "p.j"), 1) + F.lit(tasks)).alias("task"),
        F.col("p.side").alias("side"),
        F.lit(1).cast("long").alias("part"),
        F.when(F.lit(True), F.xxhash64("grp", "p.low", "p.i", "p.j")).alias("grp"),
        "doc_id", "weight",
    )
    wanted = written(whole.unionByName(split).select("task", "side", "grp", "doc_id", "weight"), "ngram-rows")

    # Each text that some product needs is turned into its set once, before it is copied to its tasks.
    needed = wanted.select("doc_id").distinct()
    texts = _marked(docs, needed).where("_perhaps").drop("_perhaps")
    sets = texts.join(needed, "doc_id", "left_semi").mapInPandas(_sets(words), "doc_id long, text binary")
    rows = wanted.join(sets.withColumnRenamed("text", "grams"), "doc_id")
    links = rows.select("task", "side", "grp", "doc_id", "weight", "grams").groupBy("task")
    return written(links.applyInPandas(_multiply(words, threshold), _LINKS), "ngram-links")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Documents less those linked, directly or not, with a document of a smaller doc_id.

    Keeps the columns of ``docs``. Rows without doc_id stay. Of several rows of one doc_id one stays.
    """
    joined = ngram_jaccard_join(docs, **options)
    verdicts = written(
        joined.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("component_id").alias("first"), F.count("*").alias("copies")),
        "ngram-verdicts",
    )
    dropped = verdicts.where("doc_id <> first").select(F.col("doc_id").alias("_dropped"))
    marked = _marked(docs, dropped.select(F.col("_dropped").alias("doc_id")))
    open_ = marked.where("_perhaps").join(dropped, F.col("doc_id").cast("long") == F.col("_dropped"), "left_anti")
    kept = marked.where("not _perhaps").unionByName(open_).drop("_perhaps")
    repeated = verdicts.where("copies > 1 and doc_id = first").select(F.col("doc_id").alias("_repeated"))
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, F.col("doc_id").cast("long") == F.col("_repeated"), "left_semi")
    single = kept.join(repeated, F.col("doc_id").cast("long") == F.col("_repeated"), "left_anti")
    return single.unionByName(once.dropDuplicates(["doc_id"]))
