import ast
import pathlib

import duckdb
import pytest

import ferry.llm
from ferry.llm.oracle import ORACLE
from ferry.llm.queries import QUERIES
from tests.conftest import SF_SMALL

KEYS = {"op1": "op1_jaccard_join", "op2": "op2_token_files", "op3": "op3_language_ecoc", "op4": "op4_ring_sharding",
        "op5": "op5_decontamination", "op6": "op6_quality_mcd", "op7": "op7_chat_format", "op8": "op8_warc_normaliser",
        "op9": "op9_best_fit_packing", "op10": "op10_edit_token_counts",
        "op11": "op11_conversation_repair",
        "op12": "op12_spelling_variants", "op13": "op13_suffix_dedup"}


def test_one_query_per_operator():
    assert set(QUERIES) == set(KEYS.values())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(cursor.fetchall(), key=str)
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=str) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert len({r.doc_id for r in rows}) == n


def test_nothing_else_imports_this_subpackage():
    root = pathlib.Path(ferry.llm.__file__).parent.parent
    for path in root.rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] \
                if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path
