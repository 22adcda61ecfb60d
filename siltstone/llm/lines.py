"""Line dedup by a sharded minimal perfect hash over distinct line hashes.

Lines are counted as 128-bit hashes, once per document and combined before the shuffle. Hashes met in two
documents or more are cut by their leading bits into shards of bounded size. Each shard is a file: a minimal
perfect hash that gives every one of its hashes a place of its own, and at that place a 64-bit fingerprint
and a count. Documents are then read once more; their lines probe the arrays shard by shard, through a
bounded memory of loaded shards, and no line is joined or shuffled. A line that is not in the arrays was met
in one document only.

The perfect hash is a stack of bit arrays. On each, a hash alone at its place is settled there; the others go
on to the next, smaller array. The place is the number of set bits before it in the whole stack.
"""

from __future__ import annotations

import pickle
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shingles import mix
from siltstone.llm.storage import Draft, open_folder, publish
from siltstone.session import fresh_path, written

#: Hashes in a shard (16 bytes each and some bits) and bytes of shards that a task keeps loaded.
SHARD_HASHES = 1 << 20
LOADED_BYTES = 256 << 20
#: Lines, and characters of their texts, that probe together; the more, the less often a shard is loaded again.
PROBED_LINES, PROBED_CHARS = 500_000, 64 << 20
LEVELS = 24
_BLANK = " \t\n\x0b\x0c\r"


def line_key(line: str) -> bytes:
    """A line without white space at its ends, A-Z lower-cased."""
    return line.strip(_BLANK).encode("utf-8", "replace").lower()


class LineIndex:
    """Counts by hash for one shard."""

    def __init__(self, low: np.ndarray, high: np.ndarray, counts: np.ndarray):
        """``low`` places a hash and ``high`` is its fingerprint; pairs are distinct."""
        self.sizes, bits, taken = [], [], []
        left = np.arange(len(low))
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, -(-len(left) * 3 // 2 // 64) * 64)
            at = self._at(low[left], level, size)
            alone = np.bincount(at, minlength=size)[at] == 1
            array = np.zeros(size, dtype=bool)
            array[at[alone]] = True
            # Settled hashes in the order of their places.
            taken.append(left[alone][np.argsort(at[alone], kind="stable")])
            bits.append(array)
            self.sizes.append(size)
            left = left[~alone]
        stack = np.concatenate(bits) if bits else np.zeros(0, dtype=bool)
        self.bits = np.packbits(stack, bitorder="little").view("<u8")
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])[:-1].astype("<u4")
        order = np.concatenate(taken) if taken else left
        self.fingerprints, self.counts = high[order], counts[order].astype("<u4")
        # Hashes that no level parts (equal placing halves) are kept one by one.
        self.rest = {(int(low[i]), int(high[i])): int(counts[i]) for i in left}

    @staticmethod
    def _at(low: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = mix(low + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1))
        return (((mixed >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)

    def count(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Count of each hash, 1 where it has no entry."""
        out = np.ones(len(low), dtype=np.int64)
        left, base = np.arange(len(low)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._at(low[left], level, size)
            word = self.bits[at >> 6]
            bit = (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            place = self.ranks[at[hit] >> 6].astype(np.int64) + below
            asked = left[hit]
            same = self.fingerprints[place] == high[asked]
            out[asked[same]] = self.counts[place[same]]
            left, base = left[~hit], base + size
        for i in left if self.rest else ():
            out[i] = self.rest.get((int(low[i]), int(high[i])), 1)
        return out

    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.bits, self.ranks, self.fingerprints, self.counts))

    def dumps(self) -> bytes:
        return pickle.dumps((self.sizes, self.bits, self.ranks, self.fingerprints, self.counts, self.rest))

    @classmethod
    def loads(cls, data: bytes) -> LineIndex:
        index = cls.__new__(cls)
        index.sizes, index.bits, index.ranks, index.fingerprints, index.counts, index.rest = pickle.loads(data)
        return index


def _split(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _keys(least: int) -> Callable[[list[str]], list[bytes | None]]:
    """Digest of each line's key, None for a key of fewer than ``least`` code points."""

    def run(lines: list[str]) -> list[bytes | None]:
        out = []
        for line in lines:
            bare = line.strip(_BLANK)
            key = bare.encode("utf-8", "replace").lower()
            out.append(xxhash.xxh3_128_digest(key) if len(bare) >= least else None)
        return out

    return run


def _counted(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = _keys(least)
        for batch in batches:
            digests: list[bytes] = []
            for text in batch["text"]:
                digests += {d for d in digest(_split(text)) if d is not None}
            if digests:
                halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                frame = pd.DataFrame({"low": halves[:, 0], "high": halves[:, 1]})
                yield frame.groupby(["low", "high"], sort=False).size().rename("docs").reset_index()

    return run


def _shard_of(low: np.ndarray, shards: int) -> np.ndarray:
    return ((low.view(np.uint64) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _built(folder: str):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        low, high = (frame[c].to_numpy(dtype=np.int64).view(np.uint64) for c in ("low", "high"))
        index = LineIndex(low, high, frame["docs"].to_numpy())
        draft = Draft(folder)
        draft.write(index.dumps())
        draft.close()
        shard = int(frame["shard"].iloc[0])
        row = {"shard": shard, "draft": draft.name, "name": f"shard-{shard:06d}.mph", "file_bytes": draft.size}
        return pd.DataFrame([{**row, "hashes": len(frame)}])

    return run


class Loaded:
    """Shards of a folder, the last used ones kept up to a number of bytes."""

    def __init__(self, folder: str, names: dict[int, str], most: int):
        self.folder, self.names, self.most = folder, names, most
        self.held: OrderedDict[int, LineIndex] = OrderedDict()

    def __getitem__(self, shard: int) -> LineIndex | None:
        if shard in self.held:
            self.held.move_to_end(shard)
        elif shard in self.names:
            system, root = open_folder(self.folder)
            with system.open_input_stream(f"{root}/{self.names[shard]}", compression=None) as stream:
                self.held[shard] = LineIndex.loads(stream.read())
            while len(self.held) > 1 and sum(i.nbytes() for i in self.held.values()) > self.most:
                self.held.popitem(last=False)
        return self.held.get(shard)


def _probed(folder: str, names: dict[int, str], shards: int, least: int, min_docs: int):
    def counts(loaded: Loaded, digests: list[bytes | None]) -> np.ndarray:
        asked = np.array([i for i, d in enumerate(digests) if d is not None], dtype=np.int64)
        out = np.zeros(len(digests), dtype=np.int64)
        if not len(asked):
            return out
        halves = np.frombuffer(b"".join(d for d in digests if d is not None), dtype="<u8").reshape(-1, 2)
        of = _shard_of(np.ascontiguousarray(halves[:, 0]).view(np.int64), shards)
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(shards + 1))
        for shard in np.flatnonzero(np.diff(edges)):
            own = order[edges[shard] : edges[shard + 1]]
            index = loaded[int(shard)]
            out[asked[own]] = 1 if index is None else index.count(halves[own, 0], halves[own, 1])
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest, loaded = _keys(least), Loaded(folder, names, LOADED_BYTES)

        def judged(rows: list[tuple], digests: list[bytes | None]) -> pd.DataFrame:
            drop = counts(loaded, digests) >= min_docs
            out, at = [], 0
            for doc_id, text, n in rows:
                gone = drop[at : at + n]
                at += n
                kept = text if not gone.any() else "\n".join(x for x, d in zip(_split(text), gone) if not d)
                out.append((doc_id, n, int(gone.sum()), kept or ""))
            frame = pd.DataFrame(out, columns=["doc_id", "n_lines", "n_dropped", "kept"])
            return frame.astype({"doc_id": "Int64"})

        rows, digests, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = digest(_split(text))
                rows.append((None if pd.isna(doc_id) else int(doc_id), text, len(found)))
                digests += found
                held += len(text or "")
                if len(digests) >= PROBED_LINES or held >= PROBED_CHARS:
                    yield judged(rows, digests)
                    rows, digests, held = [], [], 0
        if rows:
            yield judged(rows, digests)

    return run


def build_line_index(docs: DataFrame, folder: str, least: int = 1, shard_hashes: int = SHARD_HASHES) -> tuple[DataFrame, int]:
    """Write the index of ``docs`` below ``folder``; returns its files and the number of shards."""
    counted = (
        docs.select(F.col("text").cast("string").alias("text"))
        .mapInPandas(_counted(least), "low long, high long, docs long")
        .groupBy("low", "high")
        .agg(F.sum("docs").alias("docs"))
        .where("docs > 1")
    )
    counted = written(counted, "line-counts")
    shards = max(1, -(-counted.count() // shard_hashes))

    @F.pandas_udf("long")
    def shard_of(low: pd.Series) -> pd.Series:
        return pd.Series(_shard_of(low.to_numpy(dtype=np.int64), shards))

    files = (
        counted.withColumn("shard", shard_of("low"))
        .groupBy("shard")
        .applyInPandas(_built(folder), "shard long, draft string, name string, file_bytes long, hashes long")
    )
    return publish(files, folder), shards


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, least: int = 1, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_lines, n_dropped and the text kept.

    Texts are cut at ``\\n``; NULL and empty texts are one empty line. A line counts by what is left without
    white space at its ends, A-Z lower-cased. Lines of at least ``least`` code points found in ``min_docs``
    documents or more go, in every document; the others stay as they are. Each row counts as one document,
    also one that repeats a doc_id or has none. ``folder`` is where the index goes, below the shared folder
    unless told otherwise.
    """
    if min_docs < 2:
        raise ValueError("a line met in one document only is not indexed")
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "line-index")
    files, shards = build_line_index(docs, folder, least)
    names = {r["shard"]: r["name"] for r in files.select("shard", "name").collect()}  # one per shard
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(
        _probed(folder, names, shards, least, min_docs), "doc_id long, n_lines long, n_dropped long, kept string"
    )


def digest_kept(lines: DataFrame) -> DataFrame:
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
