"""Piece spans, phrase graph and tokenizer alignment: against the libraries and by brute force, odd inputs included."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import alignment, phrases, pieces, queries

ODD = [
    (1, "en", None), (2, "en", ""), (3, None, " \t "), (4, "en", "The cat sat. The cat sat!"), (4, "en", "the cat sat"),
    (None, "de", "ein Wort, zwei Worte"), (5, "en", "▁x▁ y"), (6, "de", "<s>  </s><|endoftext|> <0x41>"),
    (7, "en", "日本語 ﬁ \U0001f600 é é\x00"), (8, "en", " ".join(f"w{i % 97}" for i in range(30_000))), (9, "en", "ha " * 80),
    (10, "en", "a b " * 50), (11, "de", "\n\r\x0b\x0c"),
]
CLASHING = ("ids", "words", "run", "row", "task", "block", "kind", "b", "a", "n", "score", "phrase", "path", "rank", "cover")


def _docs(spark, rows=ODD):
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    return df.withColumns({name: F.lit("x") for name in CLASHING})


def _library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECE_MODEL))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- pieces -----------------------------------------------------------------------------------------


def test_pieces_of_documents_are_the_library_s(spark):
    library = _library()
    path = queries.tokenizer_path(queries.PIECE_MODEL)
    expected, texts = Counter(), {}
    for doc, _, text in ODD:
        ids = library.encode(text or "")
        expected[doc, len(ids), _sha(",".join(map(str, ids))), _sha(library.decode(ids))] += 1
    rows = pieces.digest_documents(_docs(spark), path).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == expected
    for r in pieces.encode_documents(_docs(spark), path).collect():
        assert len(r.ids) == len(r.starts) == len(r.ends) and r.starts[1:] == r.ends[:-1]
        texts.setdefault(r.doc_id, []).append(r)
    (whole,) = texts[7]
    data = ODD[8][2].encode()
    assert whole.starts[0] == 0 and whole.ends[-1] == len(data)
    spelt = [library.id_to_piece(i) for i in whole.ids]
    for piece, lo, hi in zip(spelt, whole.starts, whole.ends):
        if not piece.startswith("<0x"):
            assert data[lo:hi].decode().replace(" ", "▁") == piece.removeprefix("▁" if lo == 0 else "")
        else:
            assert data[lo:hi] == bytes([int(piece[3:5], 16)])
    assert pieces.encode_documents(_docs(spark, []), path).count() == 0


def test_pieces_of_given_documents(spark):
    library = _library()
    expected = {}
    for d in queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect():
        ids = library.encode(d.text or "")
        expected[d.doc_id] = (len(ids), _sha(",".join(map(str, ids))), _sha(library.decode(ids)))
    found = queries.QUERIES["op11_piece_spans"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected


def _double_array(keys: dict[bytes, int]) -> bytes:
    """A trie as the compiled character map holds it, by trying places for each node's children in turn."""
    tree: dict = {}
    for key, value in keys.items():
        at = tree
        for byte in key:
            at = at.setdefault(byte, {})
        at[-1] = value
    units, used = {}, {0}

    def place(at: int, node: dict, label: int) -> None:
        letters = [c if c >= 0 else 0 for c in node]
        base = next(b for b in range(1, 1 << 20) if not any(b ^ c in used for c in letters))
        used.update(base ^ c for c in letters)
        units[at] = (at ^ base) << 10 | (0x100 if -1 in node else 0) | label
        for c, child in node.items():
            if c == -1:
                units[base] = child | 1 << 31
            else:
                place(base ^ c, child, c)

    place(0, tree, 0)
    table = np.zeros((max(units) | 255) + 1, dtype="<u4")
    for at, unit in units.items():
        table[at] = unit
    return table.tobytes()


REPLACED = {
    "\ufb01": "fi", "e\u0301": "\u00e9", "\u00e9": "e", "\t": " ", "\u3000": "  ", "\u200b": "", "ab": "X y", "abc": "z ",
    "\uff21\uff22": "AB", "\uff21": "A", "q\u0301\u0302": " q",
}


def _model(dummy: bool, remove: bool, escape: bool) -> bytes:
    """The given model with a character map of our own."""
    with open(queries.tokenizer_path(queries.PIECE_MODEL), "rb") as file:
        data = file.read()
    strings, keys = b"", {}
    for key, new in REPLACED.items():
        keys[key.encode()] = len(strings)
        strings += new.encode() + b"\0"
    trie = _double_array(keys)
    charsmap = len(trie).to_bytes(4, "little") + trie + strings
    spec = pieces._varint(2 << 3 | 2) + pieces._varint(len(charsmap)) + charsmap
    spec += pieces._flag(3, dummy) + pieces._flag(4, remove) + pieces._flag(5, escape)
    kept = b"".join(raw for number, _, raw in pieces._fields(data) if number != 3)
    return kept + pieces._varint(3 << 3 | 2) + pieces._varint(len(spec)) + spec


@pytest.mark.parametrize("options", [(True, True, True), (True, False, True), (False, True, True), (False, False, False)])
def test_character_map_takes_the_longest_prefix(options):
    from sentencepiece import SentencePieceProcessor

    data = _model(*options)
    library, own = SentencePieceProcessor(model_proto=data), pieces.PieceEncoder(data)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from([*REPLACED, "a", "b", "c", " ", "  ", "q", "e", "\u0301", "▁", "x y", "ß", "\U0001f600"]), max_size=12))
    def check(parts):
        text = "".join(parts)
        ((ids, places),) = own.encode([text])
        assert ids == library.encode(text)
        assert (np.diff(places) >= 0).all() and 0 <= places[0] and places[-1] <= len(text.encode())

    check()


def test_replaced_runs_belong_to_original_bytes():
    own = pieces.PieceEncoder(_model(True, True, True))
    normal, origin = own.normaliser("  x\t\ufb01 e\u0301")
    assert normal.decode() == "▁x▁fi▁\u00e9"
    #                          mark     x  tab      f, i  blank    both bytes of the accented letter, end
    assert origin.tolist() == [2, 2, 2, 2, 3, 3, 3, 4, 4, 7, 7, 7, 8, 8, 11]


# --- phrases ------------------------------------------------------------------------------------------


def _phrases(rows, least, limit=2_000):
    counts, total = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(words)
            for k in range(1, 5):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {
            q[i : i + k]
            for q, b in candidates.items()
            for k in range(2, len(q))
            for i in range(len(q) - k + 1)
            if 100 * b >= 80 * c[q[i : i + k]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("task_places", [1_000_000, 40])
def test_phrases_equal_counting(spark, task_places):
    rows = [(lang, text) for _, lang, text in ODD] * 3
    docs = _docs(spark, ODD * 3).repartition(5)
    found = phrases.mine_phrases(docs, least=3, task_places=task_places)
    assert sorted(map(tuple, found.collect())) == _phrases(rows, 3)
    assert phrases.mine_phrases(_docs(spark, []), least=3).count() == 0


def test_phrases_past_64_bits_and_few_words(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FLUSH_PLACES", 50)  # many small counts of the same grams
    rows = [("en", "aa bb cc dd ee ff aa"), ("fr", "aa")] * 40
    docs = _docs(spark, [(i, *r) for i, r in enumerate(rows)])
    found = phrases.mine_phrases(docs, least=30, scale=1 << 62)
    assert [(r.phrase, r.a, r.l, r.r, r.score) for r in found.orderBy("rank").limit(1).collect()] == [
        ("bb cc dd ee", 40, 40, 40, 1 << 61)
    ]


def test_paths_are_compacted(spark):
    edges = [("en", p, f) for p, f in [("a b c d", 5), ("b c d e", 4), ("c d e f", 6), ("x b c d", 2), ("u v u v", 3), ("v u v u", 3), ("h h h h", 9)]]
    rows = phrases.compact_paths(spark.createDataFrame(edges, "lang string, phrase string, f long")).collect()
    found = sorted((" ".join(r.words), r.weights) for r in rows)
    assert found == [
        ("a b c d", [5]), ("b c d e f", [4, 6]), ("h h h h", [9]), ("u v u v", [3]), ("v u v u", [3]), ("x b c d", [2])
    ]


def test_long_paths_take_several_rows(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PATH_ROW", 7)
    words = [f"w{i}" for i in range(60)]
    edges = [("en", " ".join(words[i : i + 4]), i + 1) for i in range(57)]
    rows = phrases.compact_paths(spark.createDataFrame(edges, "lang string, phrase string, f long")).orderBy("part").collect()
    assert len({r.path for r in rows}) == 1 and [len(r.weights) for r in rows] == [7] * 8 + [1]
    assert [w for r in rows for w in r.weights] == list(range(1, 58))
    assert rows[1].words == words[7:17]


def test_large_buckets_are_cut_and_small_ones_shared():
    loads = np.zeros(phrases.BUCKETS, dtype=np.int64)
    loads[[3, 5, 9, 11]] = [1_000, 40, 30, 50]
    first, cuts, tasks = phrases.deal(loads, 100)
    assert cuts[3] == 10 and cuts[5] == cuts[9] == cuts[11] == 1
    held = Counter()
    for bucket in (5, 9, 11):
        held[int(first[bucket])] += int(loads[bucket])
    assert max(held.values()) <= 100 and min(held) >= 10 and max(held) < tasks


# --- alignment ----------------------------------------------------------------------------------------


def _alignment(rows):
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.tokenizer_path(queries.BYTE_TOKENIZER))
    a.encode_special_tokens = True
    b = _library()
    letters = alignment._byte_letters()
    found, counts = [], Counter()
    for doc, text in rows:
        text = text or ""
        source = (" " + text).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text)
        spelt_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        spelt_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        if not text or b"".join(spelt_a) != source or b"".join(spelt_b) != source:
            found.append((doc, 0, 0, [], []))
            continue
        ends_a, ends_b = ({int(e): i for i, e in enumerate(np.cumsum([len(x) for x in s]))} for s in (spelt_a, spelt_b))
        groups, links, last = [], [], (0, 0)
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a[end], ends_b[end]
            groups.append((ids_a[last[0] : i + 1], ids_b[last[1] : j + 1]))
            links.append((ids_b[j], ids_a[i]))
            last = i + 1, j + 1
        counts.update(links)
        found.append((doc, len(ids_a), len(ids_b), links, groups))
    most = {}
    for (b_id, _), n in counts.items():
        most[b_id] = max(n, most.get(b_id, 0))
    out = []
    for doc, n_a, n_b, links, groups in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == most[p[0]] for p in links)
        out.append((doc, n_a, n_b, len(links), len(links), best, sum(counts[p] for p in links), _sha(text) if n_a else ""))
    return Counter(out), counts, most


def _paths():
    return queries.tokenizer_path(queries.BYTE_TOKENIZER), queries.tokenizer_path(queries.PIECE_MODEL)


@pytest.mark.parametrize("run_links", [4_000_000, 500])
def test_alignment_equals_counting(spark, run_links):
    expected, counts, most = _alignment([(doc, text) for doc, _, text in ODD])
    docs, pairs = alignment.align_corpus(_docs(spark).repartition(3), *_paths(), run_links=run_links)
    assert Counter(map(tuple, docs.collect())) == expected
    assert {(r.b, r.a): (r.n, r.best) for r in pairs.collect()} == {p: (n, n == most[p[0]]) for p, n in counts.items()}


def test_alignment_of_nothing(spark):
    docs, pairs = alignment.align_corpus(_docs(spark, []), *_paths())
    assert docs.count() == 0 and pairs.count() == 0
    docs, _ = alignment.align_corpus(_docs(spark, ODD[:3]), *_paths())
    assert sorted((r.doc_id, r.n_links) for r in docs.collect())[:2] == [(1, 0), (2, 0)]


def test_alignment_of_given_documents(spark):
    rows = queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    expected, _, _ = _alignment([(r.doc_id, r.text) for r in rows])
    assert Counter(map(tuple, queries.QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001").collect())) == expected


def test_groups_spell_both_sides(spark):
    text = "Straße, naïve \U0001f600 x"
    rows = alignment.aligned_groups(_docs(spark, [(1, "de", text), (2, "de", None)]), *_paths()).orderBy("group").collect()
    source = (" " + text).encode()
    aligner = alignment.Aligner(open(_paths()[0]).read(), open(_paths()[1], "rb").read())
    assert [r.start for r in rows] == [0, *(r.end for r in rows[:-1])] and rows[-1].end == len(source)
    for r in rows:
        for ids, spelt in ((r.a_ids, aligner.bytes_a), (r.b_ids, aligner.bytes_b)):
            assert b"".join(spelt[i] for i in ids) == source[r.start : r.end]


def test_block_merge_adds_up_equal_pairs():
    draw = np.random.default_rng(3)
    expected, sections = Counter(), []
    for _ in range(5):
        pairs = np.sort(draw.integers(0, 40, 200).astype(np.uint64))
        times = draw.integers(1, 4, 200).astype(np.uint32)
        for p, n in zip(pairs.tolist(), times.tolist()):
            expected[p] += n
        sections.append(iter([(pairs[i : i + 13], None, times[i : i + 13]) for i in range(0, 200, 13)]))
    found = [(p, n) for pairs, times in alignment.merge_counts(sections) for p, n in zip(pairs.tolist(), times.tolist())]
    assert found == sorted(expected.items())
