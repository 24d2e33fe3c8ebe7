"""The registered queries over the smallest tables, against DuckDB where SQL can express them."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from skyledger.llm.oracle import ORACLE
from skyledger.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no generated tables")
COLUMNS = {
    1: "doc_id size source_size target taken",
    2: "doc_id start n_tokens ids_crc32",
    3: "doc_id held_out n_tokens n_known train_tokens base_score score",
    4: "vec_id n_links component_id kept",
    5: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    6: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    7: "doc_id held_out score predicted",
    8: "doc_id fingerprint component_id",
    9: "doc_id piece start length ids_crc32 sequence_id offset",
    10: "doc_id size text_crc32 law shard slot grown_shard",
    11: "vec_id code error label_error codebooks_sha256",
    12: "vec_id component n deviation whitened explained identity_error",
    13: "page_id host path rule verdict",
}


def test_registered():
    found = contract.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found
    assert set(ORACLE) <= set(contract.oracle_sql()) and set(contract.oracle_sql()) <= set(found)
    assert [sum(name.startswith(f"op{n}_") for name in found) for n in COLUMNS] == [1] * len(COLUMNS)


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns_and_rows(spark, number):
    (name,) = (q for q in QUERIES if q.startswith(f"op{number}_"))
    result = QUERIES[name](spark, FOLDER)
    rows = result.collect()
    assert result.columns == COLUMNS[number].split()
    if number not in (4, 5, 9, 11, 12, 13):
        assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if name in ORACLE:
        duck = duckdb.connect()
        for table in ("documents", "embeddings", "conversations", "pages"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        expected = duck.sql(f"SELECT {', '.join(result.columns)} FROM ({ORACLE[name]})").fetchall()
        assert sorted(map(tuple, rows)) == sorted(expected)
