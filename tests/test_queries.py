"""Every registered query against its SQL, run by DuckDB on the same files."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import plan_of
from pagewright.expected_sql import expected_sql
from pagewright.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
EXPECTED = expected_sql()


@pytest.fixture(scope="module")
def database(tiny):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tiny}/{table}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9) + 0.0
    return value


def sorted_rows(rows, names):
    return sorted((tuple(comparable(row[n]) for n in names) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_equals_sql(name, spark, tiny, database):
    df = QUERIES[name](spark, tiny)
    answer = database.execute(EXPECTED[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    expected = [dict(zip(columns, row)) for row in answer.fetchall()]
    assert sorted_rows(df.collect(), columns) == sorted_rows(expected, columns)


def test_sql_has_no_stray_entries():
    assert set(EXPECTED) == set(QUERIES)
    assert entry_points.queries().keys() >= QUERIES.keys()
    assert entry_points.oracle_sql().items() >= EXPECTED.items()


def test_entry_runs(spark, tiny):
    df = entry_points.entry(spark)
    assert df.columns == ["page_id", "section_index", "title", "n_texts"]
    assert df.count() > 0


def test_entry_imports_without_the_optional_parts(tmp_path):
    """As where the optional subpackage and the pipeline file are not installed."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/pagewright", tmp_path / "pagewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    told = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(EXPECTED))]


@pytest.mark.parametrize("library", ["ahocorasick", "xxhash", "public_tokenizers"])
def test_entry_imports_without_a_library_of_the_optional_parts(library):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    told = f"import sys; sys.modules['{library}'] = None; import __spark_entry__ as e; assert e.queries().keys() >= set(e.QUERIES)"
    subprocess.run([sys.executable, "-c", told], cwd=root, check=True)


def test_a_missing_part_of_the_core_is_an_error(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/pagewright", tmp_path / "pagewright", ignore=shutil.ignore_patterns("skew.py", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode and "pagewright.operators.skew" in out.stderr


@pytest.mark.parametrize(
    "name, keys",
    [
        ("ordered_content", ["page_id", "section_index", "text_index"]),
        ("section_text_counts", ["page_id", "section_index"]),
        ("flow_sections", ["page_id", "section_index"]),
        ("sample_rows", ["conv_id", "turn"]),
    ],
)
def test_order_of_rows(name, keys, spark, tiny):
    rows = [tuple(r[k] for k in keys) for r in QUERIES[name](spark, tiny).collect()]
    assert rows == sorted(rows)


def test_top_words_order(spark, tiny):
    rows = [(-r.word_count, r.word) for r in QUERIES["top_words"](spark, tiny).collect()]
    assert rows == sorted(rows) and len(rows) == 100


def test_the_pruned_read_prunes(spark, tiny):
    assert "dynamicpruning" in plan_of(QUERIES["pruned_read"](spark, tiny))


def test_describing_a_table_writes_nothing(spark, tiny, monkeypatch):
    from pagewright.sinks import tables

    QUERIES["flow_document_tables"](spark, tiny)
    monkeypatch.setattr(tables, "save_table", None)
    assert [r.col_name for r in QUERIES["describe_table"](spark, tiny).collect()][:2] == ["page_id", "section_index"]
