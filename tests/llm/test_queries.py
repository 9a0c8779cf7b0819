"""The registered queries over the given tables, and their SQL where there is any."""

import duckdb
import pytest

from orelode.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id n_shingles component_id",
    "op2": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3": "doc_id n_words n_removed kept_sha256",
    "op4": "vec_id n_links component_id kept",
    "op5": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op6": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op8": "doc_id held_out lang_pred score",
    "op9": "doc_id size source_size target taken",
    "op10": "page_id url text n_chars",
    "op11": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op12": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13": "vec_id component n deviation whitened explained identity_error",
}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_its_columns_for_every_row(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = COLUMNS[name.split("_")[0]].split()
    assert frame.columns[: len(expected)] == expected
    read = {"vec_id": "embeddings", "page_id": "pages", "conv_id": "conversations"}.get(expected[0], "documents")
    rows = spark.read.parquet(f"{SF_DIR}/{read}.parquet").select(expected[0]).distinct()
    found = frame.select(expected[0]).filter(f"{expected[0]} >= 0")
    assert name.startswith("op12") or found.distinct().count() == rows.count()
    many = ("op5", "op12", "op13")
    assert name.startswith(many) or found.count() == rows.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, engine, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    ours = sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)
    cursor = engine.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert ours == sorted((tuple(row[i] for i in places) for row in cursor.fetchall()), key=repr)
