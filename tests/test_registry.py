import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract

DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()
FAST = ["catalog_clean", "chunk_documents", "vector_topk", "image_catalog", "sft_validate", "customer_update", "trip_boxplot", "rouge_scores",
        "rouge_stemming", "first_tests", "summary_file", "text_files", "summary_csv", "keyed_customers", "object_listing"]


def test_every_query_has_a_name_and_most_have_sql():
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries)
    without = {n for n in set(queries) - set(sql) if n != "pipeline" and not n.startswith("op")}
    assert without == {"rouge_full_scores"}


def test_flagship_query_gives_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "chunk_id", "distance"] and df.count() > 0


@pytest.mark.parametrize("name", FAST)
def test_query_matches_its_sql(spark, name):
    from tools.check_queries import rows_of
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = contract.queries()[name](spark, DIR)
    want = db.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_imports_without_the_llm_folders(tmp_path, with_pipeline):
    root = os.path.dirname(os.path.abspath(contract.__file__))
    shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", "*.md"))
    if not with_pipeline and (pipeline := tmp_path / "copy" / "corpus_pipeline.py").exists():
        pipeline.unlink()
    code = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if n == 'pipeline' or n.startswith('op')), len(e.queries()) > 50)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120, check=False)
    assert out.stdout.strip() == "[] True", out.stderr
