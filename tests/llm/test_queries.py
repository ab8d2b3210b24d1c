"""The registered corpus queries against their DuckDB statements, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from crashlake.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


CONTRACTS = {
    "op1_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op2_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op4_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op6_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op8_topk_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op9_lm_score": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op10_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op11_filter_audit": {"part": "string", "filter_order": "string", "step": "int", "kept": "bigint", "removed": "bigint", "redundant": "bigint", "unique_fails": "bigint", "good_lost": "bigint", "toxic_lost": "bigint", "shapley": "bigint"},
    "op12_spelling": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op13_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns_of_the_contract(spark, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in CONTRACTS[name]} == CONTRACTS[name]
