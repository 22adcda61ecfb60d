"""Token ids in directly addressable codes: any token can be read without decoding what stands before it.

An id is cut into chunks of 8 bits, lowest first. Level k holds, one after the other, the k-th chunk of every
id that has one, and a bitmap that says which of them go on to level k + 1. A directory with the number of
set bits before each 512th position turns a place on one level into the place on the next by one look-up
and a count over at most eight words. Files hold whole documents in ascending order of doc_id, those without one
first. A reader opens a file by its header and reads only those parts of its sections that it is asked for.

Layout of a file, little-endian: a JSON header with the sizes of the sections, its length in front; the
doc_ids; the tokens before each document; then per level the chunks, the bitmap and the directory, both empty on the
last level, from which no id goes on.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.order import with_total_before
from siltstone.llm.storage import Draft, manifest, open_folder, publish
from siltstone.session import written

CHUNK_BITS = 8
#: Positions per entry of a rank directory.
RANK_EVERY = 512
#: Tokens after which a file is closed; a longer document is a file of its own.
FILE_TOKENS = 8_000_000
SHARD_TOKENS = 16_000_000
#: Words a worker remembers the ids of, in each of two generations, and new words encoded as one text.
WORDS = 300_000
JOINED_WORDS = 64
#: Texts and characters encoded at once; a longer text is encoded alone.
PART_TEXTS, PART_CHARS = 256, 2_000_000
#: Documents and tokens read at once; a longer document is read alone.
FRAME_DOCS, FRAME_TOKENS = 50_000, 1_000_000
#: Stands for no doc_id in files, whose header counts how many of their first documents have none.
NO_ID = -(1 << 63)
#: Stops between an ASCII letter and white space or the end. The search goes from stop to stop.
_STOPS = re.compile(rb"[.,;:!?](?<=[a-z].)[.,;:!?]*(?=[\x20\x09-\x0D]|\Z)")

_DRAFTS = (
    "draft string, name string, file_bytes long, shard int, number int, docs long, tokens long, "
    "first_doc long, last_doc long, sha256 string"
)


# --- the code ------------------------------------------------------------------------------------


class Level:
    """One level: chunks, which of them go on, and the set bits before each 512th position."""

    def __init__(self, chunks: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.chunks, self.bits, self.ranks = chunks, bits, ranks

    @classmethod
    def build(cls, chunks: np.ndarray, goes_on: np.ndarray) -> Level:
        padded = np.zeros(-(-len(goes_on) // RANK_EVERY) * RANK_EVERY, dtype=bool)
        padded[: len(goes_on)] = goes_on
        held = padded.reshape(-1, RANK_EVERY).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(held)[:-1]]) if len(held) else held
        return cls(chunks, np.packbits(padded, bitorder="little").view("<u8"), ranks.astype("<u4"))

    def goes_on(self, at: np.ndarray) -> np.ndarray:
        return (self.bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def goes_on_between(self, lo: int, hi: int) -> np.ndarray:
        """The same for positions from ``lo`` to before ``hi``."""
        octets = self.bits[lo >> 6 : (hi - 1 >> 6) + 1].view(np.uint8)
        return np.unpackbits(octets, bitorder="little")[lo & 63 : (lo & 63) + hi - lo].view(bool)

    def rank_of(self, at: int) -> int:
        """Set bits before one position, from slices alone."""
        block = at // RANK_EVERY
        held = self.bits[block * (RANK_EVERY // 64) : (at >> 6) + 1]
        below = int(held[-1]) & ((1 << (at & 63)) - 1)
        return int(self.ranks[block : block + 1][0]) + int(np.bitwise_count(held[:-1]).sum()) + below.bit_count()

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        words = RANK_EVERY // 64
        first = at // RANK_EVERY * words
        out = self.ranks[at // RANK_EVERY].astype(np.int64)
        word = at >> 6
        for k in range(words):
            out += np.where(first + k < word, np.bitwise_count(self.bits[np.minimum(first + k, word)]), 0)
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(self.bits[word] & below)


class Codes:
    """Ids in levels; ``get`` reads any of them."""

    def __init__(self, levels: list[Level], count: int):
        self.levels, self.count = levels, count

    @classmethod
    def build(cls, ids: np.ndarray) -> Codes:
        levels, rest = [], ids.astype(np.uint32)
        while True:
            goes_on = rest >= 1 << CHUNK_BITS
            chunks = (rest & 0xFF).astype(np.uint8)
            rest = rest[goes_on] >> CHUNK_BITS
            if not len(rest):
                last = Level(chunks, np.empty(0, dtype="<u8"), np.empty(0, dtype="<u4"))
                return cls([*levels, last], len(ids))
            levels.append(Level.build(chunks, goes_on))

    def get(self, at: np.ndarray) -> np.ndarray:
        """The ids at these positions, in this order."""
        at = np.asarray(at, dtype=np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.count):
            raise IndexError("no such token")
        out = np.zeros(len(at), dtype=np.uint32)
        open_ = np.arange(len(at))
        for k, level in enumerate(self.levels):
            if not len(open_):
                break
            out[open_] |= level.chunks[at].astype(np.uint32) << np.uint32(CHUNK_BITS * k)
            if level is self.levels[-1]:
                break
            more = level.goes_on(at)
            open_, at = open_[more], level.rank(at[more])
        return out


    def span(self, lo: int, hi: int) -> np.ndarray:
        """The ids from ``lo`` to before ``hi``: each level's part is one run, found by one rank."""
        if not 0 <= lo <= hi <= self.count:
            raise IndexError("no such token")
        out = np.zeros(hi - lo, dtype=np.uint32)
        open_ = np.arange(hi - lo)
        for k, level in enumerate(self.levels):
            if lo == hi:
                break
            out[open_] |= level.chunks[lo:hi].astype(np.uint32) << np.uint32(CHUNK_BITS * k)
            if level is self.levels[-1]:
                break
            more = level.goes_on_between(lo, hi)
            lo = level.rank_of(lo)
            open_ = open_[more]
            hi = lo + len(open_)
        return out


class Section:
    """An array in a file; only what is sliced is read."""

    def __init__(self, stream: pa.NativeFile, kind: str, offset: int, size: int):
        self.stream, self.kind, self.offset = stream, np.dtype(kind), offset
        self.count = size // self.kind.itemsize

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, part: slice) -> np.ndarray:
        lo, hi, _ = part.indices(self.count)
        width = self.kind.itemsize
        data = self.stream.read_at(max(hi - lo, 0) * width, self.offset + lo * width)
        return np.frombuffer(data, dtype=self.kind)


class TokenFile:
    """Documents of one file: their ids in order and their codes. The first ``nameless`` ones have no doc_id."""

    def __init__(self, doc_ids: np.ndarray | Section, starts: np.ndarray | Section, codes: Codes, nameless: int = 0):
        self.doc_ids, self.starts, self.codes, self.nameless = doc_ids, starts, codes, nameless

    @classmethod
    def build(cls, doc_ids: list[int], lengths: list[int], ids: np.ndarray, nameless: int = 0) -> TokenFile:
        starts = np.concatenate([[0], np.cumsum(np.array(lengths, dtype=np.int64))])
        return cls(np.array(doc_ids, dtype="<i8"), starts.astype("<i8"), Codes.build(ids), nameless)

    def to_bytes(self) -> bytes:
        parts = [self.doc_ids, self.starts]
        for level in self.codes.levels:
            parts += [level.chunks, level.bits, level.ranks]
        head = {
            "format": "dac-2", "chunk_bits": CHUNK_BITS, "rank_every": RANK_EVERY, "docs": len(self.doc_ids),
            "nameless": self.nameless, "tokens": self.codes.count, "levels": [len(x.chunks) for x in self.codes.levels],
            "sections": [p.nbytes for p in parts],
        }
        text = json.dumps(head).encode()
        return b"".join([len(text).to_bytes(8, "little"), text, *(p.tobytes() for p in parts)])

    @classmethod
    def open(cls, stream: pa.NativeFile) -> TokenFile:
        """A file read by its parts, as they are asked for."""
        size = int.from_bytes(stream.read_at(8, 0), "little")
        head, at = json.loads(stream.read_at(size, 8)), 8 + size
        if head["format"] not in ("dac-1", "dac-2") or head["chunk_bits"] != CHUNK_BITS or head["rank_every"] != RANK_EVERY:
            raise ValueError("not a file of this format")
        parts = []
        for kind, length in zip(["<i8", "<i8"] + ["<u1", "<u8", "<u4"] * len(head["levels"]), head["sections"]):
            parts.append(Section(stream, kind, at, length))
            at += length
        levels = [Level(*parts[2 + 3 * k : 5 + 3 * k]) for k in range(len(head["levels"]))]
        return cls(parts[0], parts[1], Codes(levels, head["tokens"]), head["nameless"])

    @classmethod
    def from_bytes(cls, data: bytes) -> TokenFile:
        """A file held in memory, for looking up single tokens anywhere."""
        file = cls.open(pa.BufferReader(data))
        levels = [Level(x.chunks[:], x.bits[:], x.ranks[:]) for x in file.codes.levels]
        return cls(file.doc_ids[:], file.starts[:], Codes(levels, file.codes.count), file.nameless)

    def tokens(self, document: int) -> np.ndarray:
        """Ids of the n-th document of the file."""
        lo, hi = self.starts[document : document + 2]
        return self.codes.span(int(lo), int(hi))

    def frames(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The documents in runs of bounded size: number of the first, starts with the end of the last, and ids."""
        lo = 0
        while lo < len(self.doc_ids):
            starts = self.starts[lo : min(lo + FRAME_DOCS, len(self.doc_ids)) + 1]
            docs = max(1, int(np.searchsorted(starts, starts[0] + FRAME_TOKENS, side="right")) - 1)
            starts = starts[: docs + 1]
            yield lo, starts, self.codes.span(int(starts[0]), int(starts[-1]))
            lo += docs


# --- encoding texts -------------------------------------------------------------------------------


class WordEncoder:
    """Ids of a text by a tokenizer that drops white space and never joins what it parts.

    Such a tokenizer gives a text the ids of its words in a row. Words are parted at the six ASCII white
    space bytes only, all of which the tokenizer treats as white space, and looked up in a bounded memory
    of two generations. New ones are encoded by the tokenizer, many as one text with a word of one known id
    between them; where that id does not come out once per gap, they are encoded one by one.

    Where the tokenizer lower-cases and keeps letters apart from punctuation (``folds``), words that differ
    in A-Z or in stops at their end share an entry.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode("utf-8").lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.folds = self._folds()
        self.gap, self.gap_id = self._gap()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _folds(self) -> bool:
        """Whether case and the gap before a stop make no difference, by trial on every letter."""
        letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
        pairs = [(f"{a.upper()}{b}{s}", f"{a}{b} {s}") for a in letters for b in letters for s in (".", ",", "!?")]
        ids = [[e.ids for e in self.tokenizer.encode_batch_fast(list(side), add_special_tokens=False)] for side in zip(*pairs)]
        return ids[0] == ids[1]

    def _gap(self) -> tuple[bytes, int | None]:
        """A short word of ASCII letters that is one token of its own, and its id; learnt late, so rare in other words."""
        words: dict[str, int] = {}
        for token, number in self.tokenizer.get_vocab().items():
            word = token.removesuffix("</w>")
            if word.isascii() and word.isalpha():
                words[word] = max(number, words.get(word, 0))
        for word in sorted(words, key=lambda w: (max(len(w), 3), -words[w]))[:1_000]:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            if len(ids) == 1:
                return b" " + word.encode() + b" ", ids[0]
        return b" ", None

    def folded(self, text: str | None) -> bytes:
        """The text in UTF-8; where the tokenizer folds, with A-Z lower-cased and stops parted from words."""
        data = text.encode("utf-8", "replace") if text else b""
        # The marks U+0300 to U+037F may join a capital otherwise than its small letter.
        if self.folds and b"\xcc" not in data and b"\xcd" not in data:
            low = data.lower()
            if not any(s in low for s in self.special):
                data = _STOPS.sub(rb" \g<0>", low)
        return data

    def _ids(self, words: list[bytes]) -> list[np.ndarray]:
        texts = [w.decode("utf-8") for w in words]
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[bytes]) -> None:
        self.young[b""] = b""  # between two white spaces
        new = []
        for word in words - {b""}:
            held = self.old.get(word)
            if held is None:
                new.append(word)
            else:
                self.young[word] = held
        groups = [new[lo : lo + JOINED_WORDS] for lo in range(0, len(new), JOINED_WORDS)]
        alone = []
        for group, ids in zip(groups, self._ids([self.gap.join(g) for g in groups])):
            gaps = np.flatnonzero(ids == self.gap_id) if self.gap_id is not None else np.empty(0, dtype=np.int64)
            if len(gaps) != len(group) - 1:
                alone += group
                continue
            data, edges = ids.tobytes(), [0, *(4 * gaps + 4).tolist(), 4 * len(ids) + 4]
            for word, lo, hi in zip(group, edges, edges[1:]):
                self.young[word] = data[lo : hi - 4]
        for word, ids in zip(alone, self._ids(alone)):
            self.young[word] = ids.tobytes()

    def remembered(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words, learnt where they are new."""
        missing = set(words).difference(self.young)
        if missing:
            if len(self.young) + len(missing) > WORDS:
                self.old, self.young = self.young, {}
                missing = set(words)
            self.learn(missing)
        return list(map(self.young.__getitem__, words))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; none for NULL.

        Arrow parts the texts and numbers their words, so that Python looks up each word once, and copies the ids.
        """
        words = pc.ascii_split_whitespace(pa.array([self.folded(t) for t in texts], pa.large_string()))
        numbered = words.values.dictionary_encode()
        ids = self.remembered(numbered.dictionary.cast(pa.large_binary()).to_pylist())
        copied = pa.array(ids, pa.large_binary()).take(numbered.indices)
        if not len(copied):
            return [b""] * len(texts)
        _, ends, data = copied.buffers()
        edges = np.frombuffer(ends, dtype=np.int64)[words.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [bytes(data[lo:hi]) for lo, hi in zip(edges, edges[1:])]


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """The encoder of this worker, with what it has learnt in the tasks before."""
    return WordEncoder(path)


def _parts(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Runs of rows whose texts are few and short enough to be encoded at once."""
    lo = held = 0
    for at, text in enumerate(batch["text"]):
        if at > lo and (at - lo >= PART_TEXTS or held + len(text or "") > PART_CHARS):
            yield batch.iloc[lo:at]
            lo, held = at, 0
        held += len(text or "")
    if lo < len(batch):
        yield batch.iloc[lo:]


def _codec() -> pa.Codec:
    """Each document's ids are compressed from the encoding task to the writing one, on disk and in the shuffle."""
    return pa.Codec("zstd", 5)


def _encoded(path: str, end_id: int, narrow: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, codec = _encoder(path), _codec()
        for batch in batches:
            for part in _parts(batch):
                ids = [e + end for e in encoder.encode(part["text"].tolist())]
                sizes = [len(i) // 4 for i in ids]
                if narrow:
                    ids = [np.frombuffer(i, dtype="<u4").astype("<u2").tobytes() for i in ids]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(), "named": part["named"].to_numpy(), "n_tokens": sizes,
                        "crc": [zlib.crc32(i) for i in ids], "ids": [codec.compress(i, asbytes=True) for i in ids],
                    }
                )

    return run


# --- files ------------------------------------------------------------------------------------------


def _writer(folder: str, file_tokens: int, narrow: bool):
    kind = np.dtype("<u2" if narrow else "<u4")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _encoder.cache_clear()  # the memory is for the files now
        codec = _codec()
        shard, number = None, 0
        docs: list[int] = []
        sizes: list[int] = []
        parts: list[bytes] = []
        nameless = held = 0

        def flush() -> pd.DataFrame:
            data = TokenFile.build(docs, sizes, np.frombuffer(b"".join(parts), dtype=kind), nameless).to_bytes()
            draft = Draft(folder)
            draft.write(data)
            draft.close()
            row = {
                "draft": draft.name, "name": f"shard-{shard:06d}/{number:05d}.dac", "file_bytes": draft.size,
                "shard": shard, "number": number, "docs": len(docs), "tokens": held,
                "first_doc": docs[0], "last_doc": docs[-1], "sha256": hashlib.sha256(data).hexdigest(),
            }
            docs.clear(), sizes.clear(), parts.clear()
            return pd.DataFrame([row])

        for batch in batches:
            columns = (batch[c] for c in ("shard", "doc_id", "named", "n_tokens", "ids"))
            for own, doc, named, size, ids in zip(*columns):
                if docs and (own != shard or held + size > file_tokens):
                    yield flush()
                    nameless = held = 0
                    number = number + 1 if own == shard else 0
                elif own != shard:
                    number = 0
                shard = own
                docs.append(int(doc))
                sizes.append(int(size))
                held += int(size)
                nameless += not named
                parts.append(codec.decompress(ids, int(size) * kind.itemsize, asbytes=True))
        if docs:
            yield flush()

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    file_tokens: int = FILE_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) with the tokenizer file and write them below ``folder``; returns the manifest.

    ``end_id`` closes each document. NULL and empty texts are documents of that one token. Rows without
    doc_id come first, rows that repeat a doc_id follow one another; either are written by one task, which
    closes a file after ``file_tokens``. Other columns are ignored. Exact running token counts cut the documents
    into shards, so files do not depend on the layout of the input. No row in gives no file.
    """
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = json.load(file)
    largest = max([end_id, *vocabulary["model"]["vocab"].values(), *(t["id"] for t in vocabulary["added_tokens"])])
    narrow = largest < 1 << 16
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.col("doc_id").cast("long").isNotNull().alias("named"),
        F.col("text").cast("string").alias("text"),
    )
    encoded = written(
        texts.mapInPandas(
            _encoded(tokenizer, end_id, narrow), "doc_id long, named boolean, n_tokens long, crc long, ids binary"
        ),
        "dac-ids",
    )
    running = with_total_before(encoded.select("doc_id", "n_tokens"), ["doc_id"], "n_tokens", "before")
    starts = (
        running.groupBy(F.expr(f"before div {int(shard_tokens)}").alias("shard"))
        .agg(F.min("doc_id").alias("first"))
        .orderBy("shard")
        .collect()  # one number per shard
    )
    cuts = np.array([r["first"] for r in starts[1:]], dtype=np.int64)

    @F.pandas_udf("int")
    def shard_of(doc: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, doc.to_numpy(dtype=np.int64), side="right").astype(np.int32))

    placed = encoded.withColumn("shard", shard_of("doc_id")).repartitionById(len(cuts) + 1, "shard")
    ordered = placed.sortWithinPartitions("shard", "doc_id", "named", "crc")
    return publish(ordered.mapInPandas(_writer(folder, file_tokens, narrow), _DRAFTS), folder)


_READ = "doc_id long, named boolean, start long, n_tokens long"


def _reader(folder: str, name: str, of):
    """Rows of files by bounded frames; column ``name`` is ``of`` a document's ids as 32-bit integers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = open_folder(folder)
        for batch in batches:
            for path, base in zip(batch["name"], batch["base"]):
                with system.open_input_file(f"{root}/{path}") as stream:
                    file = TokenFile.open(stream)
                    for first, starts, ids in file.frames():
                        data = memoryview(ids.astype("<u4").tobytes())
                        edges = (4 * (starts - starts[0])).tolist()
                        yield pd.DataFrame(
                            {
                                "doc_id": file.doc_ids[first : first + len(starts) - 1],
                                "named": np.arange(first, first + len(starts) - 1) >= file.nameless,
                                "start": starts[:-1] + base,
                                "n_tokens": np.diff(starts),
                                name: [of(data[lo:hi]) for lo, hi in zip(edges, edges[1:])],
                            }
                        )

    return run


def _read(spark: SparkSession, folder: str, name: str, kind: str, of) -> DataFrame:
    files = manifest(spark, folder)
    # One row per file.
    before = Window.orderBy("shard", "number").rowsBetween(Window.unboundedPreceding, -1)
    based = written(files.select("name", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")), "dac-files")
    count = max(1, min(based.count(), 10_000))
    rows = based.repartition(count, "name").mapInPandas(_reader(folder, name, of), f"{_READ}, {name} {kind}")
    return rows.withColumn("doc_id", F.when(F.col("named"), F.col("doc_id"))).drop("named")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens before the document in all files), n_tokens and ids, read from the files."""
    return _read(spark, folder, "ids", "binary", bytes)


def digest_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids, read from the files."""
    return _read(spark, folder, "ids_crc32", "long", zlib.crc32)
