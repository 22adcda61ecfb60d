"""Registered queries over whole tables: against SQL where it states the result, else against brute force."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from siltstone.llm import queries
from siltstone.session import written
from tests.compare import differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _table(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), queries.ORACLES[name], SF_DIR) == ""


def test_toxicity_parts_the_labels(spark):
    rows = queries.QUERIES["op2_toxicity"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d["doc_id"] for d in _table("documents"))
    toxic = {x["doc_id"]: x["toxic"] for x in _table("labels")}
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = {k: [r.score for r in rows if r.held_out and toxic.get(r.doc_id) == k] for k in (0, 1)}
    assert all(held.values())
    pairs = [(a > b) + (a == b) / 2 for a in held[1] for b in held[0]]
    assert np.mean(pairs) >= 0.9


def test_shards_are_even_and_whole(spark):
    rows = queries.QUERIES["op7_hilbert_sharding"](spark, SF_DIR).collect()
    texts = {d["doc_id"]: d["text"] for d in _table("documents")}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    held = Counter(r.shard for r in rows)
    assert set(held) == set(range(24)) and max(held.values()) - min(held.values()) <= 1
    for shard, n in held.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_token_files_hold_what_the_tokenizer_gives(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    start, expected = 0, []
    for d in sorted(_table("documents"), key=lambda d: d["doc_id"]):
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        expected.append((d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    found = queries.QUERIES["op10_token_files"](spark, SF_DIR)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found.collect()) == expected


def test_benchmark_passages_are_found(spark):
    found = {(r.doc_id, r.item_id) for r in queries.QUERIES["op3_template_decontamination"](spark, SF_DIR).collect()}
    items = {b["item_id"]: " ".join((b["text"] or "").split()) for b in _table("benchmark")}
    copies = {
        (d["doc_id"], item)
        for d in _table("documents")
        for item, text in items.items()
        if len(text.split()) >= 13 and text in " ".join((d["text"] or "").split())
    }
    assert copies <= found


def test_benchmark_runs_are_found_whatever_their_case(spark):
    found = {(r.doc_id, r.item_id) for r in queries.QUERIES["op3_template_decontamination"](spark, SF_DIR).collect()}
    runs = {}
    for item in _table("benchmark"):
        words = re.findall(r"[^\W_]+", (item["text"] or "").casefold())
        for at in range(len(words) - 12):
            runs.setdefault(tuple(words[at : at + 13]), set()).add(item["item_id"])
    held = set()
    for d in _table("documents"):
        words = re.findall(r"[^\W_]+", (d["text"] or "").casefold())
        for at in range(len(words) - 12):
            held |= {(d["doc_id"], item) for item in runs.get(tuple(words[at : at + 13]), ())}
    assert held <= found


def test_mixing_keeps_every_row_and_a_fixed_draw(spark):
    rows = queries.QUERIES["op5_mix_to_targets"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d["doc_id"] for d in _table("documents"))
    assert all(0 <= r.mix_probability <= 1 for r in rows)
    tokens = sum(r.mix_tokens for r in rows)
    expected = sum(r.mix_tokens * r.mix_probability for r in rows)
    assert expected <= tokens * queries.MIX_BUDGET * (1 + 1e-6)
    again = queries.QUERIES["op5_mix_to_targets"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows if r.mix_kept} == {r.doc_id for r in again if r.mix_kept}


def test_pipeline_stages(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), f"test-{name}")
        after = docs.count()
        assert set(columns) <= set(docs.columns) and 0 < after <= before, name
        assert docs.select("doc_id").distinct().count() == after
        before = after
    texts = {json.dumps(r.text) for r in docs.select("text").collect() if (r.text or "").strip()}
    assert len(texts) == docs.where("trim(text) <> ''").count()
