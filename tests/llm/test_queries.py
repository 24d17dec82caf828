"""Every registered query of the operators over a small table; those with SQL against DuckDB."""

import zlib

import duckdb
import pytest
from fixtures import SCHEMA, documents, prose
from marlstone.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    "op1_benchmark_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op2_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op7_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9_kd_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op11_linear_grouping_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op12_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op13_fill_in_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    more = [(200 + k, prose(40 + k, k % 9) + " " + prose(30, 500), "en", "s", k) for k in range(40)]
    rows = [r for r in documents() if r[0] is not None and r[0] not in (1, 13)] + [r for r in documents() if r[0] in (1, 13)][:1] + more
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, prose(30, 500)), (2, "word"), (3, None), (4, prose(80, 1))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(200 + k, k % 3 % 2, k % 2) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    talk = [(k // 5, k % 5, ("system", "user", "assistant")[k % 3], f"Line {k}.") for k in range(60)]
    spark.createDataFrame(talk, "conv_id long, turn int, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return str(d), rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, name):
    d, rows = folder
    df = QUERIES[name](spark, d)
    got = df.collect()
    if name.startswith("op11"):  # one row a piece
        n = len([r for r in got if r.piece == 0])
    else:
        n = len(got)
    assert n == (12 if name.startswith("op12") else len(rows)) and df.columns[: len(COLUMNS.get(name, []))] == COLUMNS.get(name, [])
    if "held_out" in df.columns:
        folds, out = (7, 2) if name.startswith("op2") else (5, 0)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in got)
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet/*.parquet'")
        made = con.execute(ORACLE_SQL[name])
        names = [c[0] for c in made.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(tuple(str(r[c]) for c in sorted(names)) for r in got) == sorted(tuple(str(dict(zip(names, r))[c]) for c in sorted(names)) for r in made.fetchall())


def test_empty_tables(spark, folder, tmp_path):
    d, _ = folder
    for t in ("documents", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{d}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
