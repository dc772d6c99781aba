"""Every registered query of the operators at the smallest scale, with its SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from corpusloom.llm.oracle import ORACLE_SQL
from corpusloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: "doc_id n_tokens ids_sha256 decoded_sha256",
    2: "doc_id start n_tokens ids_crc32",
    3: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    4: "query_id rank vec_id score",
    5: "doc_id piece piece_start length bin_id bin_offset capacity",
    6: "doc_id fingerprint component_id",
    7: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    8: "page_id host path rule verdict",
    9: "doc_id n_bytes n_removed n_spans kept_sha256",
    10: "doc_id size text_crc32 law shard slot grown_shard",
    11: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    12: "doc_id leaf subroot root proof_sha256 folded_root verified",
    13: "doc_id n_words n_hit n_items items_sha256 contaminated",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[int(name[2:].split("_")[0])].split()
    rows = df.collect()
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if df.columns[0] == "doc_id" and "piece" not in df.columns:
        ids = sorted(r[0] for r in duck.execute("select doc_id from documents").fetchall())
        assert sorted(r.doc_id for r in rows) == ids
    if name in ORACLE_SQL:
        cursor = duck.execute(ORACLE_SQL[name])
        columns = [c[0] for c in cursor.description]
        assert canonical(rows, df.columns) == canonical(cursor.fetchall(), columns)


def test_entry_registers_them():
    assert QUERIES.items() <= entry.queries().items() and entry.queries()["pipeline"] is corpus_pipeline.run
    assert ORACLE_SQL.items() <= entry.oracle_sql().items()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
