"""The queries with links, copies and repeats against their SQL, on tables made to hold them."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as E
from tools.check_oracle import digest


def compare(spark, folder, name, table):
    got = E.queries()[name](spark, str(folder))
    rows = [tuple(r) for r in got.collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    rel = con.sql(E.oracle_sql()[name])
    want = rel.fetchall()
    assert sorted(got.columns) == sorted(rel.columns)
    assert digest(got.columns, rows)[1] == digest(rel.columns, want)[1]
    return [dict(zip(got.columns, r)) for r in rows]


def write_documents(folder, texts):
    n = len(texts)
    pq.write_table(pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(["en"] * n),
                             "source": pa.array(["s"] * n), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}),
                   f"{folder}/documents.parquet")


def made_texts():
    rng = np.random.default_rng(5)
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(words, n))
    shared, texts = say(70), []
    for i in range(40):
        base = say(int(rng.integers(5, 300)))
        near = base.split(" ")
        near[int(rng.integers(len(near)))] = "changed"
        texts += [base, base, " ".join(near), f"{base} {shared} {base[:40]}"]
    return texts + [None, "", "   ", "a", "a b", "A B", "ab " * 500, "ab " * 490, "x" * 3000, "x" * 49, "x" * 50]


def test_vectors_with_links_nulls_and_copies(spark, tmp_path):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((40, 64)) + 2.0  # a common mean
    vecs = [(c + rng.standard_normal(64) * 0.05).tolist() for c in centre for _ in range(5)]
    vecs += [vecs[0], vecs[0], vecs[7], (np.array(vecs[3]) * 4).tolist(), None, [0.0] * 64, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] * 64]
    ids = rng.permutation(len(vecs)).tolist()
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vecs, pa.list_(pa.float64())),
                             "label": pa.array([0] * len(vecs), pa.int32())}), f"{tmp_path}/embeddings.parquet")
    rows = compare(spark, tmp_path, "op2_itq", "embeddings")
    assert sum(r["n_links"] for r in rows) > 800 and sum(not r["kept"] for r in rows) > 150


def test_documents_with_near_copies(spark, tmp_path):
    write_documents(tmp_path, made_texts())
    rows = compare(spark, tmp_path, "op9_setsketch", "documents")
    assert sum(not r["kept"] for r in rows) > 40


def test_documents_with_repeated_bytes(spark, tmp_path):
    write_documents(tmp_path, made_texts())
    rows = compare(spark, tmp_path, "op10_suffixes", "documents")
    assert sum(r["n_spans"] > 1 for r in rows) > 10
    assert any(0 < r["n_removed"] < r["n_bytes"] for r in rows)


def test_documents_with_repeated_words(spark, tmp_path):
    write_documents(tmp_path, made_texts())
    rows = compare(spark, tmp_path, "op7_recompression", "documents")
    assert sum(r["n_removed"] > 0 for r in rows) > 40
