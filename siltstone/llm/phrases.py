"""Collocations from a weighted de Bruijn graph of word n-grams.

The longest grams (4 words) are the edges, their first and last three words the nodes they join. Every place
of a piece gives one gram: a whole edge, or at the end of the piece the shorter one that is left. Only these
are counted. The count of a shorter phrase is the flow out of it, the sum over all counted grams that begin
with it, plus its correction: the times a piece ends with it.

1. A task counts its own grams in NumPy and sends them off as blocks: sorted, dictionary-coded and
   compressed. A gram goes where its first two words hash to, so that flows of three and two words are
   sums over neighbours there. Hash buckets are dealt to tasks by an exact histogram of all places; a bucket
   that is too large for a task is cut by its last words, and its shorter flows are partial sums.
2. Flows are added up by Spark; edges and nodes below the least count go.
3. Unary paths of what is left (nodes with one edge in and one out) are compacted by pointer doubling.
   What a longer phrase covers is worked out path by path, so a passage gives two rows per word and not five.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shingles import mix
from siltstone.session import written

EDGE = 4
#: What parts pieces, and A-Z in lower case. Words are parted by blank and tab.
_STOPS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes(range(256)).lower().translate(bytes.maketrans(_STOPS, b"\n" * len(_STOPS)))
#: Ends a piece; no UTF-8 text holds this byte.
_END = b"\xff"

#: Places gathered in a task before they are counted, and words known at once.
FLUSH_PLACES = 2_000_000
FLUSH_WORDS = 600_000
#: Hash buckets of the histogram: its size does not depend on the data.
BUCKETS = 1 << 14
#: Places dealt to a counting task.
TASK_PLACES = 1_000_000
#: Edges of a compacted path that are one row.
PATH_ROW = 1_024


class _Words(dict):
    """Number of each word, given when it is first asked for; 0 ends a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class _Places:
    """Word numbers of the texts at hand, by language."""

    def __init__(self):
        self.words = _Words()
        self.held: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, text: str) -> None:
        data = text.encode("utf-8", "replace").translate(_LOWER).replace(b"\n", b" \xff ").split()
        data.append(_END)
        ids = np.fromiter(map(self.words.__getitem__, data), dtype=np.int32, count=len(data))
        self.held.setdefault(lang, []).append(ids)
        self.size += len(ids)

    def full(self) -> bool:
        return self.size >= FLUSH_PLACES or len(self.words) >= FLUSH_WORDS

    def grams(self) -> tuple[list[bytes], np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]]:
        """Words in order, their hashes, and per language the distinct grams (rows of word places, 0 for none) with counts."""
        order = sorted(self.words)  # the end mark is above every word
        place = np.zeros(len(order), dtype=np.int64)
        words = order[:-1]
        place[np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words))] = np.arange(1, len(words) + 1)
        hashes = np.array([0, *map(xxhash.xxh64_intdigest, words)], dtype=np.uint64)
        return words, hashes, {lang: self._counted(place[np.concatenate(ids)]) for lang, ids in self.held.items()}

    @staticmethod
    def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        padded = np.concatenate([ids, np.zeros(EDGE - 1, dtype=ids.dtype)])
        columns = [padded[k : k + len(ids)].copy() for k in range(EDGE)]
        for k in range(2, EDGE):
            columns[k][columns[k - 1] == 0] = 0
        full = ids > 0
        high = columns[0][full] << 32 | columns[1][full]
        low = columns[2][full] << 32 | columns[3][full]
        return _summed(high, low, np.ones(len(high), dtype=np.int64))


def _summed(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (high, low) rows and the sums of ``n``."""
    if not len(high):
        return np.empty((0, 2), dtype=np.int64), n
    order = np.lexsort((low, high))
    high, low, n = high[order], low[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    return np.stack([high[first], low[first]], axis=1), np.add.reduceat(n, first)


def _columns(grams: np.ndarray) -> list[np.ndarray]:
    """The four word columns of packed grams."""
    mask = (1 << 32) - 1
    return [grams[:, 0] >> 32, grams[:, 0] & mask, grams[:, 1] >> 32, grams[:, 1] & mask]


def _bucket(lang: str, hashes: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    salt = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    return (mix(hashes[first] * np.uint64(3) + mix(hashes[second] + salt)) >> np.uint64(64 - 14)).astype(np.int64)


def _loads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct grams per hash bucket, as the tasks will send them."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for found in _gathered(batches):
        _, hashes, by_lang = found.grams()
        for lang, (grams, _) in by_lang.items():
            w1, w2, _, _ = _columns(grams)
            total += np.bincount(_bucket(lang, hashes, w1, w2), minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pd.DataFrame({"bucket": some, "n": total[some]})


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[_Places]:
    places = _Places()
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            places.add(lang, text)
            if places.full():
                yield places
                places = _Places()
    if places.size:
        yield places


def deal(loads: np.ndarray, task_places: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First task and number of tasks of each bucket, and all tasks: small buckets share one, large ones have several."""
    cuts = np.maximum(1, -(-loads // task_places))
    first = np.zeros(len(loads), dtype=np.int64)
    task = held = 0
    for bucket in np.argsort(-loads, kind="stable").tolist():
        if cuts[bucket] > 1:
            first[bucket] = task
            task += int(cuts[bucket])
            continue
        if held and held + loads[bucket] > task_places:
            task, held = task + 1, 0
        first[bucket] = task
        held += int(loads[bucket])
    return first, cuts, task + 1


def _blocks(first: np.ndarray, cuts: np.ndarray):
    """Counted grams of a task's texts, one compressed block per language and counting task."""

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=3)
        for found in _gathered(batches):
            words, hashes, by_lang = found.grams()
            for lang, (grams, n) in by_lang.items():
                if not len(grams):
                    continue
                w1, w2, w3, w4 = _columns(grams)
                bucket = _bucket(lang, hashes, w1, w2)
                tail = mix(hashes[w3] * np.uint64(5) + mix(hashes[w4] + np.uint64(7))) >> np.uint64(1)
                task = first[bucket] + tail.astype(np.int64) % cuts[bucket]
                order = np.argsort(task, kind="stable")
                edges = np.flatnonzero(np.diff(task[order], prepend=-1, append=-1))
                rows = []
                for lo, hi in zip(edges[:-1], edges[1:]):
                    own = order[lo:hi]
                    table = np.stack([w1[own], w2[own], w3[own], w4[own]])
                    used, coded = np.unique(table, return_inverse=True)
                    coded = coded.reshape(table.shape) + (0 if used[0] == 0 else 1)
                    spelt = b"\n".join([words[i - 1] for i in used if i])
                    numbers = np.concatenate([coded, n[own][None, :]]).astype("<u4")
                    planes = np.ascontiguousarray(numbers.reshape(-1).view(np.uint8).reshape(-1, 4).T).tobytes()
                    data = len(own).to_bytes(4, "little") + planes + spelt
                    rows.append((int(task[own[0]]), lang, bool((cuts[bucket[own]] == 1).all()), packer.compress(data)))
                yield pd.DataFrame(rows, columns=["task", "lang", "whole", "block"])

    return go


def _flows(least: int):
    """All grams and flows of one counting task, per language."""

    def unpacked(block: bytes, known: dict[bytes, int]) -> np.ndarray:
        data = zstandard.ZstdDecompressor().decompress(block)
        count = int.from_bytes(data[:4], "little")
        planes = np.frombuffer(data, dtype=np.uint8, count=count * 20, offset=4).reshape(4, -1)
        numbers = np.ascontiguousarray(planes.T).view("<u4").reshape(5, count).astype(np.int64)
        spelt = data[4 + count * 20 :].split(b"\n")
        here = np.fromiter((known.setdefault(w, len(known) + 1) for w in spelt), dtype=np.int64, count=len(spelt))
        here = np.concatenate([[0], here])
        numbers[:EDGE] = here[numbers[:EDGE]]
        return numbers

    def go(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (lang, whole), own in frame.groupby(["lang", "whole"], sort=False):
            known: dict[bytes, int] = {}
            w1, w2, w3, w4, n = np.concatenate([unpacked(b, known) for b in own["block"]], axis=1)
            words = ["", *(w.decode("utf-8", "replace") for w in known)]
            grams, n = _summed(w1 << 32 | w2, w3 << 32 | w4, n)
            columns = _columns(grams)
            for size in range(EDGE, 0, -1):
                # Flow out of each phrase of this size, what ends with it included.
                has = columns[size - 1] > 0
                if not has.any():
                    continue
                key = [c[has] for c in columns[:size]]
                changed = np.any([np.diff(k, prepend=-1) != 0 for k in key], axis=0)
                at = np.flatnonzero(changed)
                flow = np.add.reduceat(n[has], at)
                if size > 1 and whole:
                    at, flow = at[flow >= least], flow[flow >= least]
                spelt = [" ".join(map(words.__getitem__, w)) for w in zip(*(k[at].tolist() for k in key))]
                out.append(pd.DataFrame({"lang": lang, "phrase": spelt, "words": size, "f": flow}))
        if not out:
            return pd.DataFrame({"lang": [], "phrase": [], "words": [], "f": []})
        return pd.concat(out)

    return go


def phrase_counts(docs: DataFrame, least: int, task_places: int = TASK_PLACES) -> DataFrame:
    """lang, phrase, words, f: every phrase of 1 to 4 words, those of more than one only if found ``least`` times.

    Counted over all places of all texts of ``docs`` (text, lang); a language that is NULL is ``und``.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    loads = np.zeros(BUCKETS, dtype=np.int64)
    found = texts.mapInPandas(_loads, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in found.collect():  # at most BUCKETS rows
        loads[row["bucket"]] = row["n"]
    first, cuts, tasks = deal(loads, task_places)
    blocks = texts.mapInPandas(_blocks(first, cuts), "task int, lang string, whole boolean, block binary")
    flows = (
        blocks.repartition(tasks, "task").groupBy("task").applyInPandas(_flows(least), "lang string, phrase string, words int, f long")
    )
    counted = flows.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return written(counted.where((F.col("words") == 1) | (F.col("f") >= least)), "phrase-counts")


def _head(phrase: str, words: int):
    return F.substring_index(phrase, " ", words)


def _tail(phrase: str, words: int):
    return F.substring_index(phrase, " ", -words)


def compact_paths(edges: DataFrame) -> DataFrame:
    """Unary paths of the graph of ``edges`` (lang, phrase, f): lang, path, part, words and weights.

    ``words`` are the words of the path in order, ``weights`` the counts of its edges; an edge is one path's. A
    path of more than ``PATH_ROW`` edges takes several rows, numbered by ``part``. Pointers to the edge before are
    doubled until all have reached their path's first edge. Edges on a cycle without a branch never do; each of
    them is a path of its own.
    """
    nodes = edges.select("lang", "phrase", "f", _head("phrase", EDGE - 1).alias("source"), _tail("phrase", EDGE - 1).alias("sink"))
    nodes = written(nodes.withColumn("edge", F.monotonically_increasing_id()), "phrase-edges")
    # The one edge in, and the one out, of nodes that have just one of each.
    into = nodes.groupBy("lang", F.col("sink").alias("node")).agg(F.count("*").alias("ins"), F.min("edge").alias("before"))
    out = nodes.groupBy("lang", F.col("source").alias("node")).agg(F.count("*").alias("outs"), F.min("edge").alias("edge"))
    unary = into.where("ins = 1").join(out.where("outs = 1"), ["lang", "node"]).where("edge <> before").select("edge", "before")
    pointers = written(
        nodes.select("edge").join(unary, "edge", "left").select(
            "edge", F.coalesce("before", "edge").alias("to"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("steps")
        ),
        "phrase-pointers",
    )
    rounds = max(1, pointers.count()).bit_length() + 1
    for _ in range(rounds):
        ahead = pointers.select(F.col("edge").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        pointers = written(
            pointers.join(ahead, "to").select("edge", F.col("next").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved")),
            "phrase-pointers",
        )
        if pointers.where("moved").isEmpty():
            break
    # Pointers that still move are on a cycle.
    placed = nodes.join(
        pointers.select(
            "edge",
            F.when(F.col("moved"), F.col("edge")).otherwise(F.col("to")).alias("path"),
            F.when(F.col("moved"), 0).otherwise(F.col("steps")).alias("place"),
        ),
        "edge",
    )
    rows = placed.groupBy("lang", "path", F.expr(f"place div {PATH_ROW}").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("place", "phrase", "f"))).alias("run")
    )
    start = F.split(F.col("run")[0]["phrase"], " ")
    later = F.transform(F.slice("run", F.lit(2), F.size("run")), lambda e: F.substring_index(e["phrase"], " ", -1))
    return rows.select("lang", "path", "part", F.concat(start, later).alias("words"), F.col("run.f").alias("weights"))


def _covered_by_paths(paths: DataFrame) -> DataFrame:
    """lang, phrase, cover: nodes and word pairs of each path, with the greatest count of an edge that holds them."""
    size = F.size("words")

    def inside(width: int):
        def one(i):
            lo = F.greatest(i - (EDGE - width), F.lit(0))
            hi = F.least(i, F.size("weights") - 1)
            return F.struct(
                F.array_join(F.slice("words", i + 1, F.lit(width)), " ").alias("phrase"),
                F.array_max(F.slice("weights", lo + 1, hi - lo + 1)).alias("cover"),
            )

        return F.transform(F.sequence(F.lit(0), size - width), one)

    spread = F.concat(*(inside(width) for width in range(2, EDGE)))
    return paths.select("lang", F.inline(spread))


def mine_phrases(
    docs: DataFrame, least: int = 30, cover_num: int = 80, cover_den: int = 100, limit: int = 2_000, scale: int = 2_000_000,
    task_places: int = TASK_PLACES,
) -> DataFrame:
    """Collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts (``text``, ``lang``; other columns are ignored) are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and the
    bytes 10 to 13, and pieces into words at blanks and tabs. ``n`` counts all words of the language, ``a`` all places
    of a phrase of 2 to 4 words found at least ``least`` times. A cut after the first k words gives the counts ``l`` and
    ``r`` of both parts and the score floor(scale * a / (l + r)); the lowest-scoring cut counts, the smallest k among
    equal ones. A phrase goes if a longer one that holds it has cover_num / cover_den of its count or more. The first
    ``limit`` of each language by score, count and phrase (UTF-8 order) are ranked from 1.

    NULL and empty texts have no word; a NULL lang is ``und``; repeated rows count each time; no row gives no row.
    """
    counts = phrase_counts(docs, least, task_places)
    totals = counts.where("words = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = written(counts.where(F.col("f") >= least), "phrase-frequent")

    edges = frequent.where(F.col("words") == EDGE)
    candidates = frequent.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    nodes = frequent.where(F.col("words") == EDGE - 1)
    covered = _covered_by_paths(compact_paths(edges))
    for part in (_head, _tail):
        covered = covered.unionByName(nodes.select("lang", part("phrase", 2).alias("phrase"), F.col("f").alias("cover")))
    covered = covered.groupBy("lang", "phrase").agg(F.max("cover").alias("cover"))
    # Exact in decimals, whatever the counts.
    wide = "decimal(19,0)"
    held = (F.col("cover").cast(wide) * cover_den) >= (F.col("a").cast(wide) * cover_num)
    free = candidates.join(covered, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False)))

    cuts = free.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("rest"),
    )
    part = frequent.select("lang", F.col("phrase").alias("part"), "f")
    cut = cuts.join(part.toDF("lang", "first", "l"), ["lang", "first"]).join(part.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr(f"(cast({int(scale)} as decimal(19,0)) * cast(a as {wide})) div (cast(l as {wide}) + cast(r as {wide}))")
    lowest = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
