"""Registered corpus queries against DuckDB, and the pipeline against a brute-force version of its stages."""

import base64
import hashlib
import os
import random
import sys
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from cases import awkward_texts, frame, prose  # noqa: E402
from test_llm_graphs import plain_boilerplate, plain_groups  # noqa: E402
from test_llm_texts import plain_quality, words_of  # noqa: E402

import corpus_pipeline  # noqa: E402
from airlens.llm import mixing, quality_bands  # noqa: E402
from airlens.llm.registry import ORACLE, QUERIES, RANK_FILE  # noqa: E402

SF = "/root/testdata/sf0.001"


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr(tuple(round(r[k], 6) if isinstance(r[k], float) else r[k] for k in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    told = con.execute(ORACLE[name])
    columns = [c[0] for c in told.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == comparable(columns, told.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def plain_bands(raw):
    """Is the text as compressible as texts of its length are, whole and in its full chunks of 2 KB?"""
    def ratio(part):
        return len(part) / len(zstandard.ZstdCompressor(level=3).compress(part))

    if not raw:
        return True
    low, high = next((lo, hi) for below, lo, hi in quality_bands.LENGTH_BANDS if len(raw) < below)
    chunks = [raw[k:k + 2048] for k in range(0, len(raw) - 2047, 2048)]
    bad = sum(not 1.15 <= ratio(c) <= 4.0 for c in chunks)
    return low <= ratio(raw) <= high and 4 * bad <= len(chunks)


def test_quality_verdicts_match_brute_force(spark):
    r = random.Random(3)
    noise = "".join(chr(r.randrange(33, 0x3000)) + " " * (k % 5 == 0) for k in range(9000))
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + awkward_texts() + [
        noise, "word " * 3000, prose(5, 900), prose(5, 900) + noise, prose(6, 700) + " same" * 900]
    rows = quality_bands.quality_report(frame(spark, texts, list(range(len(texts))))).collect()
    for x in rows:
        text = texts[x.doc_id] or ""
        assert x.kept == (not plain_quality(text)[5] and plain_bands(text.encode())), x
    assert 1 < sum(not x.kept and not x.base_failed for x in rows) < len(rows)


def plain_mix(docs):
    """Documents drawn after raking token weights in plain Python."""
    cell, tokens = {}, defaultdict(float)
    for d in docs:
        topic = next((t for t, marks in mixing.TOPICS if any(m in d["text"] for m in marks)), "prose")
        cell[d["doc_id"]] = (d["source"], d["lang"], topic)
        tokens[cell[d["doc_id"]]] += len(words_of(d["text"]))
    weight = dict(tokens)
    for _ in range(mixing.SWEEPS):
        for m in range(3):
            now, goal = defaultdict(float), defaultdict(float)
            for c in tokens:
                now[c[m]] += weight[c]
                goal[c[m]] += tokens[c]
            total = sum(g ** mixing.TEMPER for g in goal.values())
            weight = {c: w * goal[c[m]] ** mixing.TEMPER / total / now[c[m]] for c, w in weight.items()}
    largest = max(weight[c] / tokens[c] for c in tokens)
    out = []
    for d in docs:
        digest = hashlib.md5(d["text"].encode()).hexdigest()
        u = int(hashlib.md5(f"{mixing.SEED}:{d['doc_id']}:{digest}".encode()).hexdigest()[:8], 16) / 2**32
        c = cell[d["doc_id"]]
        if u < weight[c] / tokens[c] / largest:
            out.append(d)
    return out


def test_pipeline_matches_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [r.asDict() for r in table.collect()]
    docs = [d for d in docs if not plain_quality(d["text"])[5] and plain_bands(d["text"].encode())]
    assert len(docs) < table.count()
    for d, gone in zip(docs, plain_boilerplate([d["text"] for d in docs])):
        d["text"] = "\n".join(x for k, x in enumerate(d["text"].split("\n")) if k not in gone)
    docs = [d for d in docs if d["text"].strip(" ")]
    first = {i: low for i, _, low in plain_groups([(d["doc_id"], d["text"]) for d in docs])}
    docs = plain_mix([d for d in docs if first[d["doc_id"]] == d["doc_id"]])
    with open(public_tokenizers.path(RANK_FILE), "rb") as f:
        ranks = {base64.b64decode(t): int(rank) for t, rank in (line.split() for line in f.read().splitlines())}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = set()
    for d in docs:
        ids = reference.encode_ordinary(d["text"])
        expected.add((d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                      hashlib.sha256(d["text"].encode()).hexdigest()))
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == expected


def test_pipeline_stages_keep_the_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_pipeline_without_a_character_count(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").drop("n_chars")
    out = corpus_pipeline.line_dedup(spark, docs, SF)
    assert out.columns == docs.columns and 0 < out.count() <= docs.count()
