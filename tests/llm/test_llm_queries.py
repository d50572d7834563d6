"""Every query of the subpackage on the small tables; those with SQL against it."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from pagewright.llm.expected_sql import EXPECTED_SQL
from pagewright.llm.queries import QUERIES

COLUMNS = {
    1: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    2: "doc_id n_tokens ids_sha256 decoded_sha256",
    3: "page_id payload_bytes payload_digest record_type refers_to",
    4: "doc_id n_bytes n_removed n_spans kept_sha256",
    5: "doc_id held_out score predicted",
    6: "doc_id n_words n_base first_word last_word base_labels labels score",
    7: "doc_id n_words n_hit n_items items_sha256 contaminated",
    8: "doc_id held_out lang_pred score",
    9: "doc_id size text_crc32 law shard slot grown_shard",
    10: "doc_id class_id",
    11: "lang rank phrase a l r n score",
    12: "doc_id n_words n_removed kept_sha256",
    13: "item_id rank doc_id score",
}


def test_all_are_registered():
    assert set(QUERIES) < set(entry_points.queries()) and "pipeline" in entry_points.queries()
    assert set(EXPECTED_SQL) <= set(entry_points.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, tiny):
    df = QUERIES[name](spark, tiny)
    assert set(COLUMNS[int(name[2:].split("_")[0])].split()) <= set(df.columns)
    rows = [r.asDict() for r in df.collect()]
    table = "pages" if name == "op3_warc" else "documents"
    if name not in ("op11_collocations", "op13_search"):
        assert len(rows) == spark.read.parquet(f"{tiny}/{table}.parquet").count()
    if name in EXPECTED_SQL:
        connection = duckdb.connect()
        for t in ("documents", "pages", "benchmark"):
            connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
        answer = connection.execute(EXPECTED_SQL[name])
        names = [d[0] for d in answer.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted((tuple(r) for r in answer.fetchall()), key=repr)
        assert sorted((tuple(r[n] for n in names) for r in rows), key=repr) == want
