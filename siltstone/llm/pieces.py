"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for.

A text is normalised here, not by the library: at each place the longest key of the model's compiled
character map (a double-array trie with its replacement strings) is taken, else one character as it is.
Beside every normalised byte stands the original byte it came from. The normalised text is then cut by the
same model with its own normaliser switched off, and each piece is projected back to a span of original bytes.
The spans of a text lie one after the other and cover it, but for what the normaliser removed at an end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the model format: field numbers and kinds of pieces.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_CHARSMAP, _DUMMY_PREFIX, _REMOVE_SPACES, _ESCAPE_SPACES = 2, 3, 4, 5
_SPACE_AS_SUFFIX = 24
MARK = "▁".encode()

#: Bytes of text handed to the library at once; a longer text goes alone.
CALL_BYTES = 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """Number, value and raw bytes of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        start = at
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at : at + size]
            at += size
        yield tag >> 3, value, data[start:at]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out + bytes([value]))


def _flag(number: int, value: bool) -> bytes:
    return _varint(number << 3) + bytes([value])


class Model:
    """What a model file says about pieces and normalisation."""

    def __init__(self, data: bytes):
        self.data = data
        self.charsmap = b""
        self.dummy_prefix = self.remove_spaces = self.escape_spaces = True
        self.space_as_suffix = False
        self.pieces: list[tuple[bytes, int]] = []
        others = []
        for number, value, raw in _fields(data):
            if number != _NORMALIZER:
                others.append(raw)
            if number == _PIECE:
                own = {n: v for n, v, _ in _fields(value)}
                self.pieces.append((own.get(1, b""), own.get(3, _NORMAL)))
            elif number == _TRAINER:
                self.space_as_suffix = any(n == _SPACE_AS_SUFFIX and v for n, v, _ in _fields(value))
            elif number == _NORMALIZER:
                own = {n: v for n, v, _ in _fields(value)}
                self.charsmap = own.get(_CHARSMAP, b"")
                self.dummy_prefix = bool(own.get(_DUMMY_PREFIX, 1))
                self.remove_spaces = bool(own.get(_REMOVE_SPACES, 1))
                self.escape_spaces = bool(own.get(_ESCAPE_SPACES, 1))
        off = _flag(_DUMMY_PREFIX, False) + _flag(_REMOVE_SPACES, False) + _flag(_ESCAPE_SPACES, self.escape_spaces)
        #: The same model for texts that are normalised already.
        self.plain = b"".join(others) + _varint(_NORMALIZER << 3 | 2) + _varint(len(off)) + off

    def piece_sizes(self) -> np.ndarray:
        """Normalised bytes each piece stands for; -1 where that depends on the text."""
        sizes = {_BYTE: 1, _UNKNOWN: -1, _CONTROL: 0}
        return np.array([sizes.get(kind, len(piece)) for piece, kind in self.pieces], dtype=np.int64)


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes whose values point at replacement strings."""

    def __init__(self, data: bytes):
        size = int.from_bytes(data[:4], "little") if data else 0
        self.units = np.frombuffer(data, dtype="<u4", count=size // 4, offset=4 if data else 0).tolist()
        self.strings = data[4 + size :] if data else b""

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)

    def _walk(self, data: bytes, at: int) -> Iterator[tuple[int, int | None]]:
        """Place after each byte that a key can begin with, and the value of the key that ends there, if one does."""
        units = self.units
        node = self._offset(units[0]) if units else 0
        while units and at < len(data):
            node ^= data[at]
            if node >= len(units) or units[node] & 0x800000FF != data[at]:
                return
            unit = units[node]
            node ^= self._offset(unit)
            at += 1
            yield at, units[node] & 0x7FFFFFFF if unit & 0x100 else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """End of the longest key at this place, and what replaces it."""
        found = None
        for end, value in self._walk(data, at):
            if value is not None:
                found = end, value
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]

    def begins(self, data: bytes) -> tuple[bool, bool]:
        """Whether keys begin with these bytes, and whether they are a key themselves."""
        end, value = 0, None
        for end, value in self._walk(data, 0):
            pass
        return end == len(data), end == len(data) and value is not None


class Normaliser:
    """Normalised bytes of a text, and the original byte that each of them came from."""

    def __init__(self, model: Model):
        self.model = model
        self.map = CharacterMap(model.charsmap)
        symbols = sorted((p.decode() for p, kind in model.pieces if kind == _USER), key=len, reverse=True)
        self.symbols = "|".join(map(re.escape, symbols))
        self.finders: dict[frozenset[str], re.Pattern | None] = {}

    def _finder(self, letters: frozenset[str]) -> re.Pattern | None:
        """Pattern of all places in a text of these characters where a key or a symbol can begin."""
        if letters not in self.finders:
            alone, leads = [], []
            for c in sorted(letters):
                begins, key = self.map.begins(c.encode())
                if begins:
                    (alone if key else leads).append(c)
            seconds = [d for d in sorted(letters) if any(self.map.begins((c + d).encode())[0] for c in leads)]
            parts = [self.symbols] if self.symbols else []
            if alone:
                parts.append("[" + "".join(map(re.escape, alone)) + "]")
            if seconds:
                parts.append(f"[{''.join(map(re.escape, leads))}](?=[{''.join(map(re.escape, seconds))}])")
            if len(self.finders) > 1_000:
                self.finders.clear()
            self.finders[letters] = re.compile("|".join(parts), re.S) if parts else None
        return self.finders[letters]

    def _replacements(self, text: str, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """First byte, end and new bytes of each replaced run, from left to right and by longest prefix."""
        if not (self.map.units or self.symbols):
            return
        finder = self._finder(frozenset(text))
        if finder is None:
            return
        symbol = re.compile(self.symbols) if self.symbols else None
        at = place = 0  # the same place in characters and in bytes
        ascii_only = len(text) == len(data)
        while found := finder.search(text, at):
            place += found.start() - at if ascii_only else len(text[at : found.start()].encode())
            at = found.start()
            own = symbol.match(text, at) if symbol else None
            if own:
                end, new = place + len(own.group().encode()), own.group().encode()
            else:
                end, new = self.map.longest(data, place) or (place + len(text[at].encode()), text[at].encode())
            yield place, end, new
            at += end - place if ascii_only else len(data[place:end].decode())
            place = end

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end the place in the UTF-8 bytes of ``text``."""
        model, data = self.model, text.encode("utf-8", "replace")
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        parts: list[np.ndarray] = []
        places: list[np.ndarray] = []
        after_space = only_blanks = model.remove_spaces

        def keep(codes: np.ndarray, origin: np.ndarray) -> None:
            nonlocal after_space
            if len(codes):
                parts.append(codes)
                places.append(origin)
                after_space = model.remove_spaces and codes[-1] == 0x20

        def copied(lo: int, hi: int) -> None:
            codes = np.frombuffer(data, dtype=np.uint8, count=hi - lo, offset=lo)
            origin = np.arange(lo, hi)
            if model.remove_spaces:
                space = codes == 0x20
                again = space & np.concatenate([[after_space], space[:-1]])
                codes, origin = codes[~again], origin[~again]
            keep(codes, origin)

        done = 0
        for lo, hi, new in self._replacements(text, data):
            if done < lo:
                copied(done, lo)
            only_blanks = only_blanks and new == b" "
            if after_space:
                new = new.lstrip(b" ")
            keep(np.frombuffer(new, dtype=np.uint8), np.full(len(new), lo))
            done = hi
        if done < len(data):
            copied(done, len(data))
        if not parts and only_blanks:
            return b"", np.array([len(data)])
        codes = np.concatenate([np.empty(0, dtype=np.uint8), *parts])
        origin = np.concatenate([np.empty(0, dtype=np.int64), *places])
        ends = np.append(origin, len(data))
        mark = MARK if model.escape_spaces else b" "
        if model.escape_spaces:
            width = np.where(codes == 0x20, len(MARK), 1)
            ends = np.append(np.repeat(origin, width), len(data))
            normal = codes.tobytes().replace(b" ", MARK)
        else:
            normal = codes.tobytes()
        before, behind = (0, 0) if not model.dummy_prefix else (0, 1) if model.space_as_suffix else (1, 0)
        normal = mark * before + normal
        ends = np.concatenate([np.repeat(ends[:1], before * len(mark)), ends])
        if model.remove_spaces:
            while normal.endswith(mark):
                normal = normal[: -len(mark)]
                ends = ends[: len(normal) + 1]
        if behind:
            normal += mark
            ends = np.append(ends, np.repeat(ends[-1:], len(mark)))
        return normal, ends


class PieceEncoder:
    """Ids and original byte spans of texts, and back from ids to text."""

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = Model(data)
        self.normaliser = Normaliser(self.model)
        self.sizes = self.model.piece_sizes()
        self.cutter = SentencePieceProcessor(model_proto=self.model.plain)
        self.decoder = SentencePieceProcessor(model_proto=data)

    def _sizes(self, ids: np.ndarray, normal: str) -> np.ndarray:
        sizes = self.sizes[ids]
        if (sizes < 0).any():
            # An unknown piece is spelt as the text has it.
            spelt = self.cutter.encode(normal, out_type=str, num_threads=1)
            sizes = np.where(sizes < 0, [len(p.encode()) for p in spelt], sizes)
        return sizes

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Per text its ids, and the original bytes at which its pieces start, with the end of the last one."""
        normal, ends = zip(*(self.normaliser(t or "") for t in texts)) if texts else ((), ())
        strings = [n.decode() for n in normal]
        for ids, string, size, origin in zip(
            self.cutter.encode(strings, num_threads=1), strings, map(len, normal), ends
        ):
            at = np.zeros(len(ids) + 1, dtype=np.int64)
            np.cumsum(self._sizes(np.array(ids, dtype=np.int64), string), out=at[1:])
            if at[-1] != size:
                raise ValueError("the pieces do not spell the normalised text")
            yield ids, origin[at]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.decoder.decode(ids, num_threads=1) if ids else []


def calls(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``CALL_BYTES`` together."""
    lo = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if held and held + size > CALL_BYTES:
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(texts):
        yield lo, len(texts)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, starts, ends and decoded of each row of ``docs`` (doc_id, text) by the model file.

    ``starts`` and ``ends`` are byte places in the UTF-8 of the text, one pair per id; a byte piece has its
    own byte, and a replaced run belongs to the piece that holds its last normalised byte. NULL and empty texts
    have no ids and decode to ''. Rows are independent: NULL and repeated doc_ids stay as they are, other columns
    are ignored, no row gives no row. The model file (its size does not depend on the data) goes to the tasks.
    """
    data = _model_bytes(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = PieceEncoder(data)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for lo, hi in calls(texts):
                found = list(encoder.encode(texts[lo:hi]))
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].iloc[lo:hi].astype("Int64").array,
                        "ids": [ids for ids, _ in found],
                        "starts": [places[:-1] for _, places in found],
                        "ends": [places[1:] for _, places in found],
                        "decoded": encoder.decode([ids for ids, _ in found]),
                    }
                )

    return _texts(docs).mapInPandas(
        run, "doc_id long, ids array<int>, starts array<long>, ends array<long>, decoded string"
    )


def digest_documents(docs: DataFrame, model: str) -> DataFrame:
    """Digests of what ``encode_documents`` gives: n_tokens, ids_sha256, decoded_sha256, spans_sha256.

    Hashed where they are made, so that ids do not leave the task. ``ids_sha256`` is over decimal ids joined by
    commas, ``spans_sha256`` over the places where pieces start and the last one ends, as 64-bit little-endian.
    """
    data = _model_bytes(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = PieceEncoder(data)
        decimal = [str(i) for i in range(len(encoder.sizes))]
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for lo, hi in calls(texts):
                found = list(encoder.encode(texts[lo:hi]))
                decoded = encoder.decode([ids for ids, _ in found])
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].iloc[lo:hi].astype("Int64").array,
                        "n_tokens": [len(ids) for ids, _ in found],
                        "ids_sha256": [_hex(",".join(map(decimal.__getitem__, ids)).encode()) for ids, _ in found],
                        "decoded_sha256": [_hex(text.encode()) for text in decoded],
                        "spans_sha256": [_hex(places.astype("<i8").tobytes()) for _, places in found],
                    }
                )

    return _texts(docs).mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string"
    )


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
