"""Every query with SQL against DuckDB; the others against brute force are in the operators' tests."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracle import TABLES, rows_sorted  # noqa: E402

from pricemart.llm.queries import QUERIES  # noqa: E402
from pricemart.llm.sql import SQL  # noqa: E402

from .conftest import SF  # noqa: E402


def test_registered():
    names = set(QUERIES) | {"pipeline"}
    assert names <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mix", "token_files"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    sc, sr = rows_sorted(df.columns, df.collect())
    res = con.execute(SQL[name])
    dc, dr = rows_sorted([d[0] for d in res.description], res.fetchall())
    assert sc == dc
    assert sr == dr


@pytest.mark.parametrize("name", sorted({*QUERIES, "pipeline"} - {"op8_revisits", "op11_whitening"}))
def test_odd_rows(spark, odd, tmp_path, name):
    """One result row per document (flagged ones only for op6, mixed ones for the pipeline, pieces that make up the whole of each
    document for op13), on nulls, ties and long texts."""
    _write(spark, tmp_path, odd)
    rows = E.queries()[name](spark, str(tmp_path)).collect()
    if name == "pipeline":
        assert {r.doc_id for r in rows} <= {r.doc_id for r in odd.collect()}
    elif name == "op6_suffix_dedup":
        assert {r.doc_id for r in rows} == {6, 7}
    elif name == "op13_packing":
        first = [r for r in rows if r.start == 0]
        assert sorted(str(r.doc_id) for r in first) == sorted(str(r.doc_id) for r in odd.collect())
        assert sum(r.length for r in rows) == sum(r.doc_tokens for r in first)
    else:
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in odd.collect())


@pytest.mark.parametrize("name", sorted({*QUERIES, "pipeline"}))
def test_empty_tables(spark, tmp_path, odd, name):
    _write(spark, tmp_path, odd.limit(0), rows=False)
    spark.read.parquet(f"{SF}/pages.parquet").limit(0).write.parquet(f"{tmp_path}/pages.parquet")
    assert E.queries()[name](spark, str(tmp_path)).collect() == []


def _write(spark, to, docs, rows=True):
    docs.write.parquet(f"{to}/documents.parquet")
    bench = [(1, prose_of(10)), (None, None), (2, ""), (2, "one two"), (2, "one two")]
    spark.createDataFrame(bench if rows else [], "item_id long, text string").write.parquet(f"{to}/benchmark.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{to}/embeddings.parquet")
    labels = [(6, 1, 0), (None, 1, 1), (10, 0, 1), (10, 0, 1), (8, None, None), (99, 1, 1)]
    spark.createDataFrame(labels if rows else [], "doc_id long, quality int, toxic int").write.parquet(f"{to}/labels.parquet")


def prose_of(n):
    return " ".join(f"b{i}" for i in range(n))
