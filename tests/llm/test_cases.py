"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, and brute-force answers."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.llm import dac, hilbert, lines, mixing, ngram_join, queries, templates, topk, toxicity, urls, warc
from siltstone.session import fresh_path, written

LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
TEXTS = [
    (1, None), (2, ""), (3, " \t "), (4, "a b c d e f g h"), (5, "A b c d e f g h"), (5, "a b c d e f g h"),
    (6, LONG), (7, "one\ntwo\none"), (8, "ñandú; ΣΑΣ! \U0001f600"),
]
EXTRA = ("grp", "kind", "n", "bucket", "value", "_row", "ids", "shard", "window", "item_id", "weight", "size", "score")


def _docs(spark, rows=TEXTS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text")})
    return df.withColumns({name: F.lit("x") for name in EXTRA})


def test_ngram_join_cases(spark):
    rows = ngram_join.ngram_jaccard_join(_docs(spark), words=3, num=90, den=100).collect()
    assert len(rows) == len(TEXTS)
    components = {r.doc_id: r.component_id for r in rows}
    assert components == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8}
    assert all(r.n_shingles == 0 and r.n_links == 0 for r in rows if r.doc_id <= 3)
    assert ngram_join.ngram_jaccard_join(_docs(spark, [])).count() == 0
    kept = ngram_join.keep_one(_docs(spark))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert kept.columns == _docs(spark).columns


def _near_texts():
    draw = random.Random(5)
    out = []
    for base in range(4):
        words = [f"b{base}w{draw.randrange(10_000)}" for _ in range(120)]
        for _ in range(30):
            own = list(words)
            for _ in range(draw.randrange(4)):
                own[draw.randrange(len(own))] = f"z{draw.randrange(10_000)}"
            out.append(" ".join(own[: len(own) - draw.randrange(12)]))
    return list(enumerate(out))


def test_ngram_join_equals_all_pairs(spark):
    docs = _near_texts()
    sets = {}
    for i, text in docs:
        w = text.split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    links = {i: set() for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i != j and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                links[i].add(j)
    expected = {}
    for i in sorted(sets):
        todo = [] if i in expected else [i]
        while todo:
            at = todo.pop()
            if at not in expected:
                expected[at] = i
                todo += links[at]
    spread = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for sizes in ({}, {"block_rows": 6, "block_grams": 500, "bucket_sums": 200}):
        found = {r.doc_id: r for r in ngram_join.ngram_jaccard_join(spread, **sizes).collect()}
        assert {i: r.component_id for i, r in found.items()} == expected
        assert {i: r.n_links for i, r in found.items()} == {i: len(x) for i, x in links.items()}


def test_line_dedup_equals_counting(spark):
    rows = [(i, f"Head {i % 3}\n  same LINE\t\n{'x' if i % 2 else 'y'}\n") for i in range(14)] + [(99, None), (99, "")]
    docs = _docs(spark, rows)
    keys = lambda text: [x.strip(" \t\n\x0b\x0c\r").lower() for x in (text or "").split("\n")]
    met = {}
    for _, text in rows:
        for key in set(keys(text)):
            met[key] = met.get(key, 0) + 1
    expected = []
    for doc_id, text in rows:
        gone = [bool(k) and met[k] >= 5 for k in keys(text)]
        kept = "\n".join(x for x, d in zip((text or "").split("\n"), gone) if not d)
        expected.append((doc_id, len(gone), sum(gone), kept))
    found = lines.drop_repeated_lines(docs, min_docs=5).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert lines.drop_repeated_lines(_docs(spark, []), min_docs=5).count() == 0
    assert lines.drop_repeated_lines(_docs(spark), min_docs=2).count() == len(TEXTS)


def test_line_index_gives_each_hash_its_count():
    draw = np.random.default_rng(3)
    low, high = (draw.integers(0, 1 << 63, 5_000, dtype=np.uint64) for _ in range(2))
    low[:40] = low[0]  # placing halves that no level parts
    counts = draw.integers(2, 90, 5_000)
    index = lines.LineIndex.loads(lines.LineIndex(low, high, counts).dumps())
    assert np.array_equal(index.count(low, high), counts)
    assert (index.count(low ^ np.uint64(1 << 62), high ^ np.uint64(5)) == 1).all()


def test_top_products_equal_all_products(spark):
    draw = random.Random(9)
    rows = [(i, [draw.randrange(-6, 7) for _ in range(6)]) for i in range(60)]
    rows += [(60, [0] * 6), (61, rows[3][1]), (62, rows[3][1])]
    # Repeated ids: one with its own vector, one as a query with another.
    rows += [(3, rows[3][1]), (8, [6, 0, 0, 0, 0, 6])]
    odd = [(None, [1] * 6), (70, None)]
    df = spark.createDataFrame(rows + odd, "vec_id long, vector array<long>").withColumn("norm", F.lit("x"))
    expected = []
    for own, (q, a) in enumerate(rows):
        if q % 4 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), v) for i, (v, b) in enumerate(rows) if i != own)[:5]
            expected += [(q, k + 1, v, -s) for k, (s, v) in enumerate(scores)]
    found = topk.top_products(df, F.col("vec_id") % 4 == 0, 5, bucket_rows=7, query_rows=4).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert topk.top_products(df.limit(0), F.col("vec_id") % 4 == 0, 5).count() == 0


def test_top_products_send_only_visited_buckets(spark, monkeypatch):
    """Short rows that no query can reach are in no (block, bucket) pair; far-reaching queries share a block."""
    rows = [(i, [900 - i, 1]) for i in range(40)] + [(40 + i, [1, i % 2]) for i in range(400)] + [(999, [0, 0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    visits = []

    def kept(frame, name):
        out = written(frame, name)
        visits.extend(map(tuple, out.collect()) if name == "topk-visits" else [])
        return out

    monkeypatch.setattr(topk, "written", kept)
    asks = F.col("vec_id").isin(0, 4, 8, 12, 999)
    found = topk.top_products(df, asks, 3, bucket_rows=20, query_rows=4).collect()
    expected = []
    for q, a in rows:
        if q in (0, 4, 8, 12, 999):
            scores = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in rows if v != q)[:3]
            expected += [(q, k + 1, v, -s) for k, (s, v) in enumerate(scores)]
    assert sorted(map(tuple, found)) == sorted(expected)
    # Of the other 22 buckets, each is met by the block of the zero vector alone.
    assert sorted(bucket for _, bucket in visits if bucket > 0) == list(range(1, 23))


def test_warc_round_trip(spark):
    big = "é" * 600
    rows = [(1, "http://a/x", big), (2, "http://a/y", big), (3, None, None), (4, "http://a/z", "s"), (5, "u", "s"), (6, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    folder = fresh_path(spark, "warc-test")
    warc.write_warc(pages, folder)
    found = {r.page_id: r for r in warc.read_warc(spark, folder).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6}
    for page, _, html in rows:
        data = (html or "").encode()
        assert (found[page].payload_bytes, found[page].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        if page != 1:
            assert (found[page].record_type, found[page].refers_to, bytes(found[page].payload)) == ("response", None, data)
    assert (found[1].record_type, found[1].refers_to) == ("revisit", 2)


def test_url_filter_cases(spark):
    to = lambda u: f'<link rel="canonical" href="{u}">'
    rows = [
        (1, "http://a.com/x", to("https://www.example.com/de/y")),  # alias of a blocked page
        (2, "http://b.com/", to("http://a.com/x")),
        (3, "http://example.net/en/1", to("http://a.com/x")),  # explicit allow stands
        (4, "http://EXAMPLE.net/fr", None),
        (5, None, "x"), (6, "no scheme", ""), (7, "http://c.org/", "<p>"), (7, "http://notexample.com/de/", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("rule", F.lit("x"))
    found = urls.filter_urls(pages, urls.rule_table(spark, queries.URL_RULES)).collect()
    got = sorted((r.page_id, r.host, r.rule, r.verdict, r.reason) for r in found if r.page_id != 5)
    assert [(p, v, why) for p, _, _, v, why in got] == [
        (1, "block", "alias"), (2, "block", "alias"), (3, "allow", "rule"), (4, "block", "rule"),
        (6, "allow", "default"), (7, "allow", "default"), (7, "allow", "default"),
    ]
    assert [(r.host, r.path, r.verdict) for r in found if r.page_id == 5] == [("", "", "allow")]
    assert urls.filter_urls(pages.limit(0), urls.rule_table(spark, queries.URL_RULES)).count() == 0


ITEM = "Maria bought 12 apples for 3 dollars and gave 12 of them to her brother in Paris before lunch on the way home"


def test_templates_find_new_values_as_far_as_they_are_consistent(spark):
    other = ITEM.replace("Maria", "Anna").replace("12", "15").replace("3 d", "4 d").replace("Paris", "Rome")
    uneven = ITEM.replace("12", "15", 1).replace("gave 12", "gave 17")
    rows = [(101, f"intro words here. {ITEM}."), (102, f"Some {other} end"), (103, uneven), (104, "nothing of it " * 9)]
    # No 13 words in a row are left that are the item's, or give each value one other.
    rows.append((105, uneven.replace("apples", "pears").replace("her", "his").replace("lunch", "dinner")))
    bench = [(1, ITEM), (2, None), (3, "too short"), (None, ITEM)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    docs = _docs(spark, rows + TEXTS)
    found = {(r.doc_id, r.item_id): r for r in templates.contaminated(docs, items).collect()}
    assert set(found) == {(101, 1), (102, 1), (103, 1)} and found[103, 1].run >= 13
    assert found[101, 1].replaced == 0 and found[102, 1].replaced > 0
    kept = templates.keep_uncontaminated(docs, items)
    assert kept.count() == len(rows + TEXTS) - 3 and kept.columns == docs.columns
    assert templates.contaminated(docs.limit(0), items).count() == 0
    assert templates.keep_uncontaminated(docs, items.limit(0)).count() == docs.count()


def test_templates_find_copies_whatever_their_case_and_slots(spark):
    cats = "in Paris. The cat sat on a mat near Oslo. The dog ran by"
    bench = [
        (1, "the quick brown fox jumps over a lazy dog while seven small birds watch it"),
        (2, "Compute 12, 15, 18, 21, 24, 27, 30, 33, 36, 39, 42, 44 and 45"),
        (3, cats),
        (4, "Tom had 12 pears and ate some of them on a warm day by the old mill with his 12 friends"),
        (5, "who wrote it"), (6, "seven plus 8 is what number"), (7, "..."),
    ]
    rows = [
        (201, "BEFORE IT. " + bench[0][1].upper() + " AND AFTER"), (202, bench[0][1].title()),
        (203, "so " + bench[1][1] + "."), (204, cats.replace(".", "")),
        # A copy but for its last value.
        (205, bench[3][1].replace("his 12", "his 19")),
        (206, "I asked Who Wrote It, who wrote it"), (207, "SEVEN PLUS 8 IS WHAT NUMBER"), (208, "seven plus 9 is what number"),
        (209, "who wrote"), (210, None),
    ]
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = [(r.doc_id, r.item_id, r.replaced) for r in templates.contaminated(_docs(spark, rows), items).collect()]
    assert {(d, i) for d, i, _ in found} == {
        (201, 1), (202, 1), (203, 2), (204, 3), (205, 4), (206, 5), (207, 6)
    }
    assert len(found) == 7 and all(replaced == 0 for _, _, replaced in found)


def test_toxicity_cases(spark):
    docs = _docs(spark)
    empty = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, empty)
    rows = toxicity.scored_documents(docs, model).collect()
    assert len(rows) == len(TEXTS) and {r.score for r in rows} == {0.5}
    texts = [(i, "you vile rotten swine" if i % 2 else "a calm and sunny day") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1, 7)], "doc_id long, toxic int")
    model = toxicity.fit(_docs(spark, texts), labels)
    assert model.score("vile swine") > 0.5 > model.score("sunny day")
    assert 0 <= model.score(None) == model.score("") <= 1
    assert toxicity.keep_clean(docs, model, 2.0).columns == docs.columns


def test_raking_meets_its_margins(spark):
    rows = [(i, "ab"[i % 2], "xyz"[i % 3], 1 + i % 5) for i in range(300)] + [(900, None, "x", 4), (901, "a", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, s string, l string, mix_tokens long").withColumn("tokens", F.lit("x"))
    targets = {"s": {"a": 0.7, "b": 0.29, None: 0.01}, "l": {"x": 0.5, "y": 0.3, "z": 0.2}}
    found = mixing.mix(docs, targets, 0.2).collect()
    assert len(found) == len(rows)
    total = sum(r.mix_weight * r.mix_tokens for r in found)
    for name, target in targets.items():
        for value, share in target.items():
            held = sum(r.mix_weight * r.mix_tokens for r in found if r[name] == value)
            assert held / total == pytest.approx(share, abs=1e-3)
    assert max(r.mix_gap for r in found) < 1e-3
    kept = sum(r.mix_tokens * r.mix_probability for r in found)
    assert kept == pytest.approx(0.2 * sum(r[3] for r in rows), rel=1e-6)
    assert mixing.mix(docs.limit(0), targets, 0.2).count() == 0


def test_margins_that_cannot_all_hold_show_their_gap(spark):
    rows = [(i, "ab"[i % 2], "xy"[i % 2], 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, s string, l string, mix_tokens long")
    found = mixing.mix(docs, {"s": {"a": 0.9, "b": 0.1}, "l": {"x": 0.1, "y": 0.9}}, 0.2).collect()
    assert len(found) == 40 and all(r.mix_gap == pytest.approx(0.8, abs=1e-3) for r in found)


def test_mixing_keeps_languages_without_a_target(spark):
    langs = ["en", "de", "fr", "es", "it", None]
    rows = [(i, langs[i % 6], f"s{i % 2}", "prose", 10 + i % 7) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, topic string, mix_tokens long")
    found = queries.mixed(docs).collect()
    assert len(found) == len(rows) and all(r.mix_probability > 0 for r in found)
    assert {r.lang for r in found if r.mix_kept} == set(langs)
    total = sum(r[4] for r in rows)
    now = {x: sum(r[4] for r in rows if r[1] == x) / total for x in langs}
    share = {x: sum(r.mix_weight * r.mix_tokens for r in found if r.lang == x) / total for x in langs}
    rest = 1 - now["it"] - now[None]
    expected = now | {x: rest * s for x, s in queries.MIX_TARGETS["lang"].items()}
    assert share == pytest.approx(expected, abs=1e-4)
    named = {"lang": {"en": 1.0, "it": 0.0}}
    assert {r.mix_probability for r in mixing.mix(docs, named, 0.2).collect() if r.lang == "it"} == {0.0}


def test_hilbert_curve_takes_single_steps(spark):
    cells = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    rows = cells.select("x", "y", hilbert.hilbert_index([F.col("x"), F.col("y")], 3).alias("at")).collect()
    path = sorted(rows, key=lambda r: r["at"])
    assert [r["at"] for r in path] == list(range(64))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(path, path[1:]))


def test_shard_cases(spark):
    rows = hilbert.shard_documents(_docs(spark), 4, carry=["text"]).collect()
    assert len(rows) == len(TEXTS) and {r.shard for r in rows} == {0, 1, 2, 3}
    assert {(r["size"], r.text_crc32) for r in rows if r.text is None} == {(8, 0)}
    assert hilbert.shard_documents(_docs(spark, []), 4).count() == 0


def test_carried_columns_may_have_any_name(spark):
    docs = _docs(spark).withColumns({"Curve": F.lit("c"), "shard": F.lit("s"), "carried_shard": F.lit("t"), "size": F.lit(-1)})
    carry = ["text", "Curve", "shard", "carried_shard", "size"]
    rows = hilbert.shard_documents(docs, 2, carry=carry).collect()
    assert len(rows) == len(TEXTS)
    assert {(r.carried_Curve, r.carried_carried_shard, r.carried_shard, r.carried_size) for r in rows} == {("c", "s", "t", -1)}
    assert {r.shard for r in rows} == {0, 1} and min(r["size"] for r in rows) == 8


def test_shards_hold_few_values_of_each_dimension(spark):
    """Sources that differ late in their names and shares between 0 and 1, against the order worked out by hand."""
    draw = random.Random(5)
    rows = [(i, f"t{i}", f"https://source-{draw.randrange(8)}", draw.randrange(8) / 10) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, share double")
    dims = {"source": F.col("source"), "share": F.col("share")}
    out = hilbert.shard_documents(docs, 16, dims, carry=["source", "share"], bits=3).collect()
    cells = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    place = {(r.x, r.y): r.at for r in cells.select("x", "y", hilbert.hilbert_index([F.col("x"), F.col("y")], 3).alias("at")).collect()}
    steps = [{v: k for k, v in enumerate(sorted({r[c] for r in rows}))} for c in (2, 3)]
    crc = {r.doc_id: r.text_crc32 for r in out}
    order = sorted(rows, key=lambda r: (place[steps[0][r[2]], steps[1][r[3]]], crc[r[0]], r[0]))
    wanted = {r[0]: (at * 16 // 800, at % 50) for at, r in enumerate(order)}
    assert {r.doc_id: (r.shard, r.slot) for r in out} == wanted
    for shard in range(16):
        mine = [r for r in out if r.shard == shard]
        assert len({r.source for r in mine}) * len({r.share for r in mine}) <= 16


def test_dimensions_of_any_type(spark):
    docs = spark.createDataFrame([(1, "a", None, {"k": 1}), (2, "b", float("nan"), None), (None, None, 0.5, {})], "doc_id long, text string, x double, m map<string,int>")
    rows = hilbert.shard_documents(docs, 2, {"x": F.col("x"), "m": F.col("m")}).collect()
    assert sorted((r.shard, r.slot) for r in rows) in ([(0, 0), (0, 1), (1, 0)], [(0, 0), (1, 0), (1, 1)])


def test_codes_give_any_token():
    draw = np.random.default_rng(1)
    ids = np.where(draw.random(20_000) < 0.3, draw.integers(0, 200, 20_000), draw.integers(0, 1 << 22, 20_000)).astype("<u4")
    file = dac.TokenFile.from_bytes(dac.TokenFile.build([4, 9], [15_000, 5_000], ids).to_bytes())
    at = draw.integers(0, 20_000, 3_000)
    assert np.array_equal(file.codes.get(at), ids[at])
    for lo, hi in [(0, 20_000), (63, 64), (64, 700), (511, 1_537), (7, 7), (19_999, 20_000), (20_000, 20_000)]:
        assert np.array_equal(file.codes.span(lo, hi), ids[lo:hi])
    assert np.array_equal(file.tokens(1), ids[15_000:])
    with pytest.raises(IndexError):
        file.codes.span(0, 20_001)


def test_words_encode_as_whole_texts():
    encoder = dac.WordEncoder(queries.tokenizer_path())
    texts = [
        None, "", "Don't. IT'S, 'S. a's.", "A).", "J̌ AB. x", "İ. İ, ", "x.\ty,\x0bz", "a.́ b",
        "<|endoftext|>. A", "<|STARTOFTEXT|> Ab.", "1.5. 2,", "AA... b!?", "\x1c a. \x1c b\x85c.", "a.\x00 b",
        "q,​z", "ǅ. ß!?", LONG,
    ]
    for text, ids in zip(texts, encoder.encode(texts)):
        whole = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole, text


def test_token_file_cases(spark):
    folder = fresh_path(spark, "tokens-test")
    dac.write_tokens(_docs(spark), folder, queries.tokenizer_path(), 1, file_tokens=50, shard_tokens=100)
    rows = sorted(dac.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(i for i, _ in TEXTS)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    assert all(r.n_tokens == 1 for r in rows if r.doc_id <= 3)
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)


def test_documents_without_id_are_the_first_in_the_files(spark):
    folder = fresh_path(spark, "tokens-test")
    docs = _docs(spark, [(None, "x"), (3, "a b"), (-(1 << 63), "c"), (None, None), (-4, "d")])
    dac.write_tokens(docs, folder, queries.tokenizer_path(), 1, file_tokens=3, shard_tokens=4)
    rows = sorted(dac.digest_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, -(1 << 63), -4, 3]
    assert sorted(r.n_tokens for r in rows[:2]) == [1, 2] and rows[4].n_tokens == 3
    empty = fresh_path(spark, "tokens-test")
    dac.write_tokens(_docs(spark, []), empty, queries.tokenizer_path(), 1)
    assert dac.read_tokens(spark, empty).count() == 0


def test_files_are_read_by_parts(monkeypatch):
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 900, 60).tolist()
    ids = draw.integers(0, 70_000, sum(sizes)).astype("<u4")
    data = dac.TokenFile.build(list(range(60)), sizes, ids).to_bytes()
    monkeypatch.setattr(dac, "FRAME_TOKENS", 800)
    monkeypatch.setattr(dac, "FRAME_DOCS", 7)
    file, seen = dac.TokenFile.open(pa.BufferReader(data)), []
    for first, starts, part in file.frames():
        assert first == len(seen) and (len(starts) == 2 or len(part) <= 800) and len(starts) <= 8
        assert np.array_equal(part, ids[starts[0] : starts[-1]])
        seen += np.diff(starts).tolist()
    assert seen == sizes
    assert np.array_equal(file.tokens(59), ids[-sizes[-1] :])


def test_words_are_encoded_alike_joined_and_across_generations(monkeypatch):
    monkeypatch.setattr(dac, "WORDS", 40)
    encoder = dac.WordEncoder(queries.tokenizer_path())
    gap = encoder.gap.decode().strip()
    texts = [" ".join(f"{w}{k % 7}{chr(97 + k % 26)}." for k in range(n)) for n, w in enumerate(["q", "Zü", gap, "1", "ß"] * 8)]
    texts += [f"{gap} {gap}x x{gap} a", gap.upper(), "e\u0301 " + gap]
    for lo in range(0, len(texts), 5):
        part = texts[lo : lo + 5]
        for text, ids in zip(part, encoder.encode(part)):
            assert np.frombuffer(ids, dtype="<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_common_passages_name_no_groups_of_the_ngram_join():
    draw = np.random.default_rng(7)
    threshold = ngram_join.Threshold(80, 100)
    firsts = threshold.size_classes(1 << 10)
    common = draw.integers(0, 1 << 64, 10, dtype=np.uint64)
    texts = [np.concatenate([common, draw.integers(0, 1 << 64, 190, dtype=np.uint64)]) for _ in range(60)]
    sums = [ngram_join.block_sums(np.sort(t), threshold, firsts) for t in texts]
    _, a, b = ngram_join.linked_runs(np.concatenate(sums), np.repeat(np.arange(60), [len(s) for s in sums]))
    assert len(ngram_join.forest(a, b)[0]) < 10


@pytest.mark.parametrize("num", [50, 80, 90, 100])
def test_linked_sets_share_a_block_sum(num):
    draw = np.random.default_rng(num)
    threshold = ngram_join.Threshold(num, 100)
    firsts = threshold.size_classes(1 << 12)
    met = 0
    for _ in range(2_000):
        size = int(draw.integers(1, 120))
        one = draw.integers(0, 1 << 64, size, dtype=np.uint64)
        less, more = draw.integers(0, size // 3 + 1), draw.integers(0, size // 2 + 1)
        other = np.concatenate([one[less:], draw.integers(0, 1 << 64, more, dtype=np.uint64)])
        if len(other) and threshold.holds(size - less, size, len(other)):
            met += 1
            assert np.intersect1d(*(ngram_join.block_sums(np.sort(x), threshold, firsts) for x in (one, other))).size
    assert met > 20


def test_token_ids_are_encoded_once_per_worker_and_kept_compressed(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(dac, "written", lambda df, name: kept.append(df) or written(df, name))
    rows = [(i, " ".join(f"word{j % 9} {i}" for j in range(400))) for i in range(30)] + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dac.write_tokens(docs, str(tmp_path / "out"), queries.tokenizer_path(), 1)
    held = kept[0].agg(F.sum(F.length("ids")).alias("bytes"), F.sum("n_tokens").alias("tokens")).first()
    assert held.bytes < held.tokens
    tokenizer = dac.WordEncoder(queries.tokenizer_path()).tokenizer
    found = sorted((-1 if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in dac.read_tokens(spark, str(tmp_path / "out")).collect())
    assert found == sorted((-1 if d is None else d, tokenizer.encode(t or "").ids + [1]) for d, t in rows)
    assert dac._encoder(queries.tokenizer_path()) is dac._encoder(queries.tokenizer_path())


def test_filter_of_doc_ids_loses_none_and_lets_few_others_pass(spark):
    docs = spark.range(60_000).selectExpr("cast(id * 7919 - 1000 as string) as doc_id", "'x' as text").union(_docs(spark, [(None, "")]).selectExpr("cast(doc_id as string)", "text"))
    ids = docs.where("doc_id % 5 = 0").select("doc_id")
    marked = ngram_join._marked(docs, ids)
    assert marked.columns == ["doc_id", "text", "_perhaps"] and marked.count() == 60_001
    assert marked.join(ids, "doc_id").where("not _perhaps").count() == 0
    assert marked.join(ids, "doc_id", "left_anti").where("_perhaps").count() < 6_000
    assert ngram_join._marked(docs, ids.limit(0)).where("_perhaps").count() == 0


@pytest.mark.parametrize("largest", [200, 40_000, 1 << 31])
def test_last_level_of_a_token_file_has_no_bitmap(largest):
    ids = np.random.default_rng(3).integers(0, largest, 5_000).astype(np.uint32)
    data = dac.TokenFile.build([1, 2], [3_000, 2_000], ids).to_bytes()
    assert len(data) < 5_000 * sum(1.13 if largest > 1 << 8 * k + 8 else 1 for k in range(4) if largest > 1 << 8 * k) + 600
    for file in (dac.TokenFile.from_bytes(data), dac.TokenFile.open(pa.BufferReader(data))):
        assert [file.tokens(d).tolist() for d in (0, 1)] == [ids[:3_000].tolist(), ids[3_000:].tolist()]
    at = np.array([4_999, 0, 17, 17])
    assert dac.TokenFile.from_bytes(data).codes.get(at).tolist() == ids[at].tolist()
    assert dac.TokenFile.from_bytes(dac.TokenFile.build([7], [0], ids[:0]).to_bytes()).tokens(0).tolist() == []
