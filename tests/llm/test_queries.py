"""The registered queries: SQL parity, keys, and the pipeline's stages."""

import ast
import hashlib
import os

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from lectio.llm import order_minhash as O
from lectio.llm import quality_ledger as Q
from lectio.llm.queries import LLM_ORACLES, LLM_QUERIES
from lectio.sources.tables import DRIVER_TABLES

from ..conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_registered():
    assert set(LLM_QUERIES) <= set(E.queries()) and set(LLM_ORACLES) <= set(E.oracle_sql())
    assert {k.split("_")[0] for k in LLM_QUERIES if k != "rule_ablations"} == {"pipeline", *(f"op{n}" for n in range(1, 14))}


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_sql_parity(spark, con, name):
    df = LLM_QUERIES[name](spark, SF001)
    got = sorted(map(repr, (tuple(r) for r in df.select(sorted(df.columns)).collect())))
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({LLM_ORACLES[name]})").fetchall()
    assert got == sorted(map(repr, want))


def test_only_the_entry_guards_the_import():
    """Nothing outside imports the subpackage, and inside nothing swallows a
    failed import."""
    for folder, _, names in os.walk(ROOT):
        for name in names:
            path = os.path.join(folder, name)
            inside = "/llm/" in path or name == "corpus_pipeline.py"
            if not name.endswith(".py") or "/." in path:
                continue
            tree = ast.parse(open(path, encoding="utf-8").read())
            imported = {getattr(n, "module", None) or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)}
            imported |= {a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names}
            if not inside and name != "__spark_entry__.py":
                assert not [m for m in imported if m.startswith(("lectio.llm", "corpus_pipeline"))], path
            if inside and "/tests/" not in path:
                caught = {x.id for n in ast.walk(tree) if isinstance(n, ast.ExceptHandler) and n.type for x in ast.walk(n.type)
                          if isinstance(x, ast.Name)}
                assert not caught & {"ImportError", "ModuleNotFoundError"}, path


def test_pipeline_stages(spark):
    """Each stage against a plain restatement on the rows it is given."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, SF001)
        rows = out.collect()
        texts = {r.doc_id: r.text for r in before}
        if name == "quality_rules":
            mask = Q.policy_mask(Q.CURRENT)
            bad = {r.doc_id for r in Q.quality_ledger(docs).collect() if r.failed_bits & mask}
            assert {r.doc_id for r in rows} == set(texts) - bad and bad
        elif name == "exact_dedup":
            last = {}
            for r in sorted(before, key=lambda r: r.doc_id):
                last["".join(c.lower() if c.isascii() else c for c in r.text)] = r.doc_id
            assert sorted(r.doc_id for r in rows) == sorted(last.values())
        elif name == "near_dedup":
            labels = {r.doc_id: O.shingles(O.words_of(r.text))[1] for r in before}
            kept = {r.doc_id for r in rows}
            ids = sorted(labels)
            links = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if O.aligned(labels[a], labels[b]) >= O.THRESHOLD}
            up = {i: i for i in ids}
            for a, b in sorted(links) * 3:
                up[a] = up[b] = min(up[a], up[b])
            assert kept == {i for i in ids if up[i] == i}
        elif name == "source_mix":
            assert {r.doc_id for r in rows} <= set(texts) and len(rows) > len(before)
        else:
            assert len(rows) == len(before)
            for r in rows:
                assert r.ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
                assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
            break
        assert out.columns == columns
        docs = spark.createDataFrame(rows, docs.schema)
    assert corpus_pipeline.run(spark, SF001).agg(F.sum("n_tokens")).first()[0] == sum(r.n_tokens for r in rows)
