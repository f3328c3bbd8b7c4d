from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from funnelguard.llm import packing, quality, secret_scan, simhash
from funnelguard.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def documents():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())


def test_one_query_for_each_operator():
    numbers = Counter(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == Counter(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{Path(SF) / f'{table}.parquet'}'")
    rel = con.sql(oracle_sql()[name])
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    assert Counter(tuple(r) for r in df.collect()) == Counter(tuple(r[i] for i in order) for r in rel.fetchall())


def test_bpe_query(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for d, t in documents().items():
        ids = encoding.encode_ordinary(t)
        want[d] = (len(ids), sha(" ".join(map(str, ids)).encode()), sha(t.encode()))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries()["op4_byte_bpe"](spark, SF).collect()}
    assert got == want


def test_simhash_and_secret_queries_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries()["op8_simhash_near_dedup"](spark, SF).collect()}
    assert got == {r.doc_id: (r.fp % 2 ** 64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    got = {r.doc_id: (r.n_hex, r.base_sha256, r.spans) for r in queries()["op9_secret_scans"](spark, SF).collect()}
    assert got == {r.doc_id: (r.n_hex, hashlib.sha256(r.base.encode()).hexdigest(), r.spans) for r in secret_scan.scan(docs).collect()}


def test_fingerprint_query(spark):
    texts = documents()
    order = sorted(texts)
    got = {r.doc_id: r for r in queries()["op6_document_fingerprints"](spark, SF).collect()}
    for k, d in enumerate(order):
        t, following = texts[d], texts[order[(k + 1) % len(order)]]
        q = len(t) // 4
        assert got[d].n_chars == len(t)
        assert got[d].edited_sha256 == hashlib.sha256((t[: len(t) - q] + following[:q]).encode()).hexdigest()
    same = {}
    for d in order:
        assert same.setdefault(texts[d], got[d].fingerprint) == got[d].fingerprint
    assert len(set(same.values())) == len(same)


def test_pipeline_against_its_stages_in_python(spark):
    """Every stage's decisions over all that the one before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = documents()
    model = quality.train(docs, labels)
    kept = {r.doc_id for r in quality.classify(docs, model).filter("predicted = 1").collect()}
    last = {}
    for d in sorted(kept):
        last["".join(c.lower() if "A" <= c <= "Z" else c for c in texts[d])] = d
    kept = set(last.values())
    rows = sorted(kept)
    fps = [simhash.fingerprint(texts[d].encode()) for d in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    kept = {min(rows[i] for i in range(len(rows)) if label[i] == k) for k in set(label)}
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs.filter(docs.doc_id.isin(list(kept)))).collect()}
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for d, t in clean.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID]
        a = 0
        while a < len(ids):
            b = a + ((len(ids) % 1024 or 1024) if a == 0 else 1024)
            want[d, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))] += 1
            a = b
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in got) == want
    assert all(sum(r.length for r in got if r.sequence_id == s) <= 1024 for s in {r.sequence_id for r in got})


def test_stages_keep_the_columns_and_take_odd_rows(frame, edge_texts, spark):
    df = frame([*enumerate(edge_texts), (3, "\n"), (None, "x y")], extra=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, SF).columns == df.columns
        assert stage(spark, frame([], extra=True), SF).collect() == []
    assert {n for n, _ in corpus_pipeline.STAGES} == {"quality classifier", "exact dedup", "SimHash near-dedup", "secret scans", "best-fit packing"}
    assert corpus_pipeline.STAGES[-1][1](spark, df, SF).count() >= df.count()
