"""The registered training-data queries over the smallest tables."""

import pytest

from stockyard.llm.oracle import ORACLE
from stockyard.llm.queries import QUERIES
from tools.oracle_check import digest, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ("embeddings", "query_id rank vec_id score"),
    "op2": ("documents", "doc_id held_out lang_pred score"),
    "op3": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op4": ("documents", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    "op5": ("documents", "doc_id n_pretokens n_tokens"),
    "op6": ("pages", "page_id host path rule verdict score"),
    "op7": ("documents", "doc_id held_out score predicted"),
    "op8": ("documents", "doc_id n_bytes n_removed n_spans kept_sha256"),
    "op9": ("documents", "doc_id n_words n_hit n_items items_sha256 contaminated"),
    "op10": ("documents", "doc_id fingerprint component_id"),
    "op11": ("documents", "lang rank phrase a l r n score"),
    "op12": ("documents", "doc_id n_features weight score rank"),
    "op13": ("documents", "doc_id n_shingles component_id kept"),
}


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in QUERIES] == [*COLUMNS, "pipeline"]


@pytest.mark.parametrize("name", [q for q in QUERIES if q != "pipeline"])
def test_query(spark, name):
    table, columns = COLUMNS[name.split("_")[0]]
    got = QUERIES[name](spark, SF)
    assert got.columns == columns.split()
    rows = [tuple(r) for r in got.collect()]
    source = spark.read.parquet(f"{SF}/{table}.parquet")
    if name.startswith("op1_"):
        queries = source.where("vec_id % 50 = 0").count()
        assert len(rows) == 5 * queries
    elif not name.startswith("op11_"):
        assert len(rows) == source.count()
    if name in ORACLE:
        cur = duck(SF).execute(ORACLE[name])
        assert digest(got.columns, rows)[0] == digest([d[0] for d in cur.description], cur.fetchall())[0]
