"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of the id pairs that end together.

Side A is a byte-level tokenizer, side B a piece model. Places where tokens of both end cut a text into
groups, and the two tokens that end there are linked. How often an id pair is linked in the whole corpus is
counted outside memory:

1. A task encodes its documents, and sorts (B id, A id, document) records of a bounded number of links. They
   are radix-partitioned by B id and spilled as a run: one file of zstd blocks, each radix a section in B-major order.
2. A task takes one radix of a bounded set of runs and merges their sections by a heap over the last keys of their
   blocks. Equal pairs meet, so it puts out one partial count per pair, which Spark adds up over the sets. A hot B id
   is spread over all sets of runs and arrives as partial counts.
3. Pair counts, of a number that the two vocabularies bound, are kept in B-major order with a mark on those
   that are the highest of their B id. A task streams its sections past them and adds up what each document gets.

Runs lie in the shared folder under private names, and rows name those that count: a task that is lost and run
again leaves files that nobody reads.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.pieces import Model, calls
from siltstone.llm.storage import Draft, open_folder
from siltstone.session import fresh_path, written

#: Bits of a record from the top: radix, B id, A id, document of the run.
RADIX_BITS, ID_BITS, ROW_BITS = 4, 18, 24
RADIXES = 1 << RADIX_BITS
#: Links and documents of a run, records of a block, and runs merged at once on average.
RUN_LINKS = 4_000_000
RUN_ROWS = 1 << 18
BLOCK_RECORDS = 1 << 16
FAN_IN = 24

#: Words a task remembers the ids of, in each of two generations.
WORDS = 120_000

_BYTE_PIECE = 6
# A blank between two characters that no reading of white space includes: byte-level tokens end before it.
_GAP = re.compile(r"(?<=[^\s\u180e]) (?=[^\s\u180e])")
_EDGE = re.compile(r"[\s\u180e]")


# --- one text under both tokenizers ------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes_a(tokenizer) -> list[bytes]:
    letters = _byte_letters()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    out = [b""] * (max(tokenizer.get_vocab().values()) + 1)
    for entry, i in tokenizer.get_vocab().items():
        out[i] = entry.encode() if entry in special else bytes(letters[c] for c in entry)
    return out


def token_bytes_b(model: Model) -> list[bytes]:
    return [
        bytes([int(piece[3:5], 16)]) if kind == _BYTE_PIECE else piece.replace("▁".encode(), b" ")
        for piece, kind in model.pieces
    ]


class _WordIds:
    """Ids of a blank and a text by a byte-level tokenizer, word by word.

    Its tokens start anew at every blank between two other characters, so the words' ids in a row are the text's.
    Words are looked up in a bounded memory of two generations; new ones are encoded many in a row, and their ids
    parted by the bytes they spell. What has white space at an edge is not remembered.
    """

    def __init__(self, tokenizer, spelt: list[bytes], sizes: np.ndarray):
        self.tokenizer, self.spelt, self.sizes = tokenizer, spelt, sizes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encoded(self, words: list[str], apart: bool) -> Iterator[tuple[str, bytes]]:
        """Ids of each word with a blank before it, in texts of many words or each ``apart``."""
        step = 1 if apart else 500
        texts = ["".join([" " + w for w in words[i : i + step]]) for i in range(0, len(words), step)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(itertools.chain.from_iterable(ids), dtype="<u4")
        if b"".join(map(self.spelt.__getitem__, flat.tolist())) != "".join(texts).encode("utf-8", "replace"):
            raise ValueError("the tokens of side A do not spell its texts: it has to be a byte-level tokenizer")
        ends = np.cumsum(self.sizes[flat])
        stops = np.cumsum([len(w.encode("utf-8", "replace")) + 1 for w in words])
        at = np.searchsorted(ends, stops)
        if not np.array_equal(ends[np.minimum(at, len(ends) - 1)], stops):
            raise ValueError("the byte-level tokenizer does not keep words apart")
        data, places = flat.tobytes(), ((at + 1) * 4).tolist()
        return zip(words, (data[lo:hi] for lo, hi in zip([0, *places[:-1]], places)))

    def _learn(self, words: set[str]) -> None:
        if len(self.young) + len(words) > WORDS:
            self.old, self.young = self.young, {}
        new = []
        for word in words:
            held = self.old.get(word)
            if held is None:
                new.append(word)
            else:
                self.young[word] = held
        if new:
            self.young.update(self._encoded(new, apart=False))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [t.split(" ") for t in texts]
        new = {w for w in set().union(*cut) if w not in self.young}
        edged: dict[str, bytes] = {}
        loose = {w for w in new if not w or _EDGE.match(w[0]) or _EDGE.match(w[-1])}
        if loose:
            cut = [words if loose.isdisjoint(words) else _GAP.split(t) for words, t in zip(cut, texts)]
            apart = {w for words in cut for w in words if not w or _EDGE.match(w[0]) or _EDGE.match(w[-1])}
            edged = dict(self._encoded(sorted(apart), apart=True))
        for _ in range(2):  # again if a new generation has begun
            missing = {w for w in set().union(*cut) if w not in self.young and w not in edged}
            if missing:
                self._learn(missing)
        found = self.young
        if edged:
            return [
                np.frombuffer(b"".join([edged[w] if w in edged else found[w] for w in words]), dtype="<u4") for words in cut
            ]
        return [np.frombuffer(b"".join(map(found.__getitem__, words)), dtype="<u4") for words in cut]


class Aligned:
    """Documents of one call that have tokens, one after the other."""

    def __init__(self, rows, a, b, n_a, n_b, ends_a, ends_b, edges):
        self.rows, self.a, self.b, self.n_a, self.n_b = rows, a, b, n_a, n_b
        self.ends_a, self.ends_b = ends_a, ends_b
        #: First byte of each document, and the end of the last.
        self.edges = edges
        size = int(edges[-1]) + 1
        on_a, on_b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        on_a[ends_a] = True
        on_b[ends_b] = True
        #: Whether a token is the last of its group.
        self.last_a, self.last_b = on_b[ends_a], on_a[ends_b]
        self.link_a, self.link_b = a[self.last_a], b[self.last_b]
        self.link_doc = np.searchsorted(edges[1:], ends_a[self.last_a], side="left")
        self.n_links = np.bincount(self.link_doc, minlength=len(rows))

    def groups_text(self, decimal: np.ndarray, digits: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document; ``decimal`` and ``digits`` spell the ids."""
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        end_a, end_b = np.flatnonzero(self.last_a) + 1, np.flatnonzero(self.last_b) + 1
        start_b = np.concatenate([[0], end_b[:-1]])
        place_a = np.arange(len(self.a)) + start_b[group_a]
        place_b = np.arange(len(self.b)) + end_a[group_b]
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        marks = np.empty(len(ids), dtype=np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        marks[place_a] = np.where(self.last_a, ord("|"), ord(","))
        marks[place_b] = np.where(self.last_b, ord(";"), ord(","))
        letters, sizes = decimal[ids], digits[ids]
        letters[np.arange(len(ids)), sizes] = marks
        flat = letters[np.arange(letters.shape[1]) <= sizes[:, None]].tobytes()
        tokens = np.cumsum(self.n_a + self.n_b)
        ends = np.cumsum(sizes + 1)[tokens - 1]
        starts = np.concatenate([[0], ends[:-1]])
        return [flat[lo : hi - 1] for lo, hi in zip(starts.tolist(), ends.tolist())]


class Aligner:
    """Both tokenizers; texts come without special tokens, strings of such tokens are plain text."""

    def __init__(self, a_file: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        self.bytes_a, self.bytes_b = token_bytes_a(self.a), token_bytes_b(Model(b_model))
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << ID_BITS:
            raise ValueError("a vocabulary is too large for the records")
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        self.words = _WordIds(self.a, self.bytes_a, self.sizes_a)
        spelt = [str(i).encode() for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        width = len(spelt[-1]) + 1
        self.decimal = np.frombuffer(b"".join(s.ljust(width) for s in spelt), dtype=np.uint8).reshape(-1, width)
        self.digits = np.array([len(s) for s in spelt])

    def align(self, texts: list[str]) -> Aligned | None:
        """Texts that both sides spell alike; None if there are none."""
        rows = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in rows]
        if not rows:
            return None
        a = self.words.encode(given)
        b = self.b.encode(given, num_threads=1)
        source = [b" " + t.encode("utf-8", "replace") for t in given]
        # Side A spells every word of a text, or has raised an error.
        spell = self.bytes_b.__getitem__
        same = [b"".join(map(spell, y)) == s for y, s in zip(b, source)]
        if not all(same):
            rows, a, b, source = ([x for x, ok in zip(side, same) if ok] for side in (rows, a, b, source))
        if not rows:
            return None
        n_a, n_b = np.array(list(map(len, a))), np.array(list(map(len, b)))
        flat_a = np.concatenate(a).astype(np.int64)
        flat_b = np.fromiter(itertools.chain.from_iterable(b), dtype=np.int64, count=int(n_b.sum()))
        edges = np.concatenate([[0], np.cumsum([len(s) for s in source])])
        return Aligned(
            np.array(rows), flat_a, flat_b, n_a, n_b, np.cumsum(self.sizes_a[flat_a]), np.cumsum(self.sizes_b[flat_b]), edges
        )


# --- runs -----------------------------------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    """Byte planes of an array, one after the other, so that equal high bytes stand together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unpacked(data: bytes, kind: str, count: int) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(-1, count)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


class Run:
    """Links of a bounded number of documents, to be spilled as one file."""

    def __init__(self):
        self.name = random.SystemRandom().getrandbits(62)
        self.links: list[np.ndarray] = []
        self.held = self.rows = 0

    def add(self, aligned: Aligned) -> None:
        b = aligned.link_b.astype(np.uint64)
        row = (self.rows + aligned.rows[aligned.link_doc]).astype(np.uint64)
        record = (b & np.uint64(RADIXES - 1)) << np.uint64(2 * ID_BITS + ROW_BITS)
        record |= b << np.uint64(ID_BITS + ROW_BITS)
        record |= aligned.link_a.astype(np.uint64) << np.uint64(ROW_BITS)
        self.links.append(record | row)
        self.held += len(record)

    def spill(self, folder: str) -> pd.DataFrame:
        """Write the sections; one row per radix that has one."""
        links = np.concatenate(self.links) if self.links else np.empty(0, dtype=np.uint64)
        links.sort()
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(links)), dtype=bool), links[1:] != links[:-1]]))
        times = np.diff(np.append(first, len(links))).astype(np.uint32)
        records = links[first]
        edges = np.searchsorted(records >> np.uint64(2 * ID_BITS + ROW_BITS), np.arange(RADIXES + 1, dtype=np.uint64))
        draft, packer, rows = Draft(folder), zstandard.ZstdCompressor(level=3), []
        for radix in range(RADIXES):
            start = draft.size
            for lo in range(int(edges[radix]), int(edges[radix + 1]), BLOCK_RECORDS):
                hi = min(lo + BLOCK_RECORDS, int(edges[radix + 1]))
                steps = np.diff(records[lo:hi], prepend=np.uint64(0))
                block = packer.compress(_packed(steps) + _packed(times[lo:hi]))
                draft.write(np.array([hi - lo, len(block)], dtype="<u4").tobytes() + block)
            if draft.size > start:
                rows.append((radix, start, draft.size - start))
        draft.close()
        table = pd.DataFrame(rows, columns=["radix", "at", "size"])
        return table.assign(kind="section", run=self.name, file=draft.name, run_rows=self.rows)


def read_section(folder: str, file: str, at: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of a section in order: pairs (B id above A id), documents and times."""
    system, root = open_folder(folder)
    unpacker = zstandard.ZstdDecompressor()
    with system.open_input_file(f"{root}/{file}") as stream:
        end = at + size
        while at < end:
            count, length = np.frombuffer(stream.read_at(8, at), dtype="<u4").tolist()
            data = unpacker.decompress(stream.read_at(length, at + 8))
            at += 8 + length
            records = np.cumsum(_unpacked(data[: 8 * count], "<u8", count), dtype=np.uint64)
            pairs = (records >> np.uint64(ROW_BITS)) & np.uint64((1 << 2 * ID_BITS) - 1)
            rows = records & np.uint64((1 << ROW_BITS) - 1)
            yield pairs, rows.astype(np.int64), _unpacked(data[8 * count :], "<u4", count)


def merge_counts(sections: list[Iterator]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sum of times per pair over sections in the same order, by a heap over the last pairs of their blocks.

    What is not above the least last pair is complete in the blocks at hand, but for that pair itself, which may
    go on in the next block and is held back.
    """
    heap: list[tuple[int, int]] = []
    blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def advance(i: int) -> None:
        block = next(sections[i], None)
        if block is not None:
            pairs, _, times = block
            blocks[i] = pairs, times.astype(np.int64)
            heapq.heappush(heap, (int(pairs[-1]), i))

    for i in range(len(sections)):
        advance(i)
    held_pairs, held_times = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    while heap:
        bound, least = heapq.heappop(heap)
        taken = [(held_pairs, held_times)]
        for i in list(blocks):
            pairs, times = blocks[i]
            cut = int(np.searchsorted(pairs, np.uint64(bound), side="right"))
            if cut:
                taken.append((pairs[:cut], times[:cut]))
                blocks[i] = pairs[cut:], times[cut:]
        del blocks[least]
        advance(least)
        pairs, times = (np.concatenate(x) for x in zip(*taken))
        order = np.argsort(pairs, kind="stable")
        pairs, times = pairs[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        pairs, times = pairs[first], np.add.reduceat(times, first)
        held_pairs, held_times = pairs[-1:], times[-1:]
        if len(pairs) > 1:
            yield pairs[:-1], times[:-1]
    if len(held_pairs):
        yield held_pairs, held_times


# --- over all documents -----------------------------------------------------------------------------------

_SPILLED = (
    "kind string, run long, row long, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, "
    "radix int, at long, size long, file string, run_rows long"
)
_NUMBERS = [c.split()[0] for c in _SPILLED.split(", ") if c.split()[1] != "string"]


def _typed(frame: pd.DataFrame) -> pd.DataFrame:
    whole = frame.reindex(columns=[c.split()[0] for c in _SPILLED.split(", ")])
    return whole.astype({c: "Int64" for c in _NUMBERS} | {c: object for c in ("kind", "groups_sha256", "file")})


def _spilling(a_file: str, b_model: bytes, folder: str, run_links: int):
    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, run = Aligner(a_file, b_model), Run()
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for lo, hi in calls(texts):
                n_a, n_b, n_links = (np.zeros(hi - lo, dtype=np.int64) for _ in range(3))
                digests = [""] * (hi - lo)
                aligned = aligner.align(texts[lo:hi])
                if aligned is not None:
                    at = aligned.rows
                    n_a[at], n_b[at], n_links[at] = aligned.n_a, aligned.n_b, aligned.n_links
                    for i, text in zip(at.tolist(), aligned.groups_text(aligner.decimal, aligner.digits)):
                        digests[i] = hashlib.sha256(text).hexdigest()
                    run.add(aligned)
                yield _typed(
                    pd.DataFrame(
                        {
                            "kind": "doc", "run": run.name, "row": run.rows + np.arange(hi - lo),
                            "doc_id": batch["doc_id"].iloc[lo:hi].astype("Int64").array,
                            "n_a": n_a, "n_b": n_b, "n_links": n_links, "groups_sha256": digests,
                        }
                    )
                )
                run.rows += hi - lo
                if run.held >= run_links or run.rows >= RUN_ROWS:
                    yield _typed(run.spill(folder))
                    run = Run()
        if run.rows:
            yield _typed(run.spill(folder))

    return go


def _sections(batches: Iterator[pd.DataFrame]) -> list[tuple]:
    """The sections of one task: one radix of a bounded set of runs."""
    columns = ["radix", "run", "run_rows", "file", "at", "size"]
    return [tuple(r) for batch in batches for r in batch[columns].itertuples(index=False)]


def _counting(folder: str):
    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sections = [read_section(folder, file, at, size) for _, _, _, file, at, size in _sections(batches)]
        for pairs, times in merge_counts(sections):
            b, a = pairs >> np.uint64(ID_BITS), pairs & np.uint64((1 << ID_BITS) - 1)
            yield pd.DataFrame({"b": b.astype(np.int32), "a": a.astype(np.int32), "n": times})

    return go


def _crediting(folder: str, counts: str):
    def known(radix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of a radix in order, with their counts and marks: bounded by the vocabularies."""
        system, root = open_folder(f"{counts}/radix={radix}")
        from pyarrow import fs

        files = [f for f in system.get_file_info(fs.FileSelector(root)) if f.base_name.endswith(".parquet")]
        tables = [pq.read_table(f.path, filesystem=system, partitioning=None) for f in files]
        b, a, n, best = (np.concatenate([t[c].to_numpy() for t in tables]) for c in ("b", "a", "n", "best"))
        pairs = b.astype(np.uint64) << np.uint64(ID_BITS) | a.astype(np.uint64)
        order = np.argsort(pairs, kind="stable")
        return pairs[order], n[order].astype(np.int64), best[order].astype(np.int64)

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = None
        for radix, run, rows, file, at, size in _sections(batches):
            table = table or known(radix)
            sums, best = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
            for pairs, places, times in read_section(folder, file, at, size):
                found = np.searchsorted(table[0], pairs)
                np.add.at(sums, places, table[1][found] * times)
                np.add.at(best, places, table[2][found] * times)
            some = np.flatnonzero(sums)
            yield pd.DataFrame({"run": run, "row": some, "count_sum": sums[some], "n_best": best[some]})

    return go


def align_corpus(docs: DataFrame, a_path: str, b_path: str, run_links: int = RUN_LINKS) -> tuple[DataFrame, DataFrame]:
    """Alignment of every row of ``docs`` (doc_id, text), and the counts of linked id pairs.

    The first table has one row per row of ``docs``: doc_id, n_a, n_b (tokens of either side), n_groups, n_links,
    n_best (links whose pair is the most frequent one of its B id, ties included), count_sum (counts of its links'
    pairs, added up) and groups_sha256 (digest of ``a1,a2|b1;a3|b2,b3``, '' without tokens). The second has b, a, n
    and best of every linked pair.

    NULL and empty texts, and texts that side B does not spell byte by byte, have no tokens and no links: zeros. A side A
    that is not a byte-level tokenizer is an error.
    Rows are told apart by where they lie, so NULL and repeated doc_ids keep a row each with its own figures; other
    columns are ignored; no row gives empty tables.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as file:
        a_file = file.read()
    with open(b_path, "rb") as file:
        b_model = file.read()
    folder = fresh_path(spark, "alignment-runs")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spilled = written(texts.mapInPandas(_spilling(a_file, b_model, folder, run_links), _SPILLED), "alignment-spilled")

    sections = spilled.where("kind = 'section'").select("radix", "run", "run_rows", "file", "at", "size")
    runs = sections.agg(F.countDistinct("run")).first()[0]
    sets = max(1, -(-runs // FAN_IN))
    task = (F.pmod("run", F.lit(sets)) * RADIXES + F.col("radix")).cast("int")
    dealt = sections.withColumn("task", task).repartitionById(sets * RADIXES, "task")

    parts = dealt.mapInPandas(_counting(folder), "b int, a int, n long")
    pairs = written(parts.groupBy("b", "a").agg(F.sum("n").alias("n")), "alignment-pairs")
    highest = pairs.groupBy("b").agg(F.max("n").alias("most"))
    marked = pairs.join(highest, "b").select("b", "a", "n", (F.col("n") == F.col("most")).alias("best"))
    counts = fresh_path(spark, "alignment-counts")
    radix = (F.col("b") % RADIXES).alias("radix")
    by_radix = marked.select(radix, "b", "a", "n", "best").repartition(RADIXES, "radix").sortWithinPartitions("radix", "b", "a")
    by_radix.write.partitionBy("radix").parquet(counts)

    credited = dealt.mapInPandas(_crediting(folder, counts), "run long, row long, count_sum long, n_best long")
    none = F.lit(None).cast("long")
    document = ("doc_id", "n_a", "n_b", "n_links", "groups_sha256")
    rows = spilled.where("kind = 'doc'").select("run", "row", F.struct(*document).alias("doc"), none.alias("count_sum"), none.alias("n_best"))
    credits = credited.select("run", "row", F.lit(None).cast(rows.schema["doc"].dataType).alias("doc"), "count_sum", "n_best")
    whole = rows.unionByName(credits).groupBy("run", "row").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        F.coalesce(F.sum("count_sum"), F.lit(0)).alias("count_sum"),
        F.coalesce(F.sum("n_best"), F.lit(0)).alias("n_best"),
    )
    documents = whole.select(
        "doc.doc_id", "doc.n_a", "doc.n_b", F.col("doc.n_links").alias("n_groups"), "doc.n_links", "n_best", "count_sum",
        "doc.groups_sha256",
    )
    return documents, marked


def aligned_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, group (from 0), start and end in bytes of a blank and the text, a_ids and b_ids of every group.

    Rows without tokens, as ``align_corpus`` has it, have no group.
    """
    with open(a_path, encoding="utf-8") as file:
        a_file = file.read()
    with open(b_path, "rb") as file:
        b_model = file.read()

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(a_file, b_model)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            ids = batch["doc_id"].astype("Int64").array
            for lo, hi in calls(texts):
                x = aligner.align(texts[lo:hi])
                if x is None:
                    continue
                ends = x.ends_a[x.last_a]
                first = np.concatenate([[0], np.cumsum(x.n_links)[:-1]])
                yield pd.DataFrame(
                    {
                        "doc_id": ids[lo:hi][x.rows[x.link_doc]],
                        "group": np.arange(len(ends)) - first[x.link_doc],
                        "start": np.concatenate([[0], ends[:-1]]) - x.edges[x.link_doc],
                        "end": ends - x.edges[x.link_doc],
                        "a_ids": np.split(x.a, np.flatnonzero(x.last_a)[:-1] + 1),
                        "b_ids": np.split(x.b, np.flatnonzero(x.last_b)[:-1] + 1),
                    }
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInPandas(
        go, "doc_id long, group long, start long, end long, a_ids array<long>, b_ids array<long>"
    )
