"""Every catalogue query against its SQL, and that the entry file stands without the training-data operators."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import catalog

ROOT, DATA = Path(__file__).resolve().parent.parent, "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda v: "null" if v is None or v != v else str(int(v)) if isinstance(v, (bool, float)) and v == int(v) else str(v)
    return sorted(tuple(one(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    want = duck.execute(catalog.ORACLES[name])
    names = [x[0] for x in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_optional_folders(tmp_path):
    """A copy without the folders that may be deleted still imports and keeps all other queries."""
    import shutil

    shutil.copytree(ROOT / "tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'active_stock' in q and 'pipeline' not in q and not any(x[:2] == 'op' and x[2:3].isdigit() for x in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr


@pytest.mark.parametrize("name", ["range_semi_anti", "active_stock"])
def test_filters_and_columns_reach_the_scan(spark, name):
    plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "o_comment" not in plan
    if name == "range_semi_anti":
        assert "PushedFilters: [IsNotNull(o_orderdate)" in plan or "GreaterThanOrEqual(o_orderdate" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def same_as_sql(spark, tmp_path, name, **tables):
    """The query and its SQL over tables given as SQL."""
    duck = duckdb.connect()
    for t, sql in tables.items():
        duck.execute(f"COPY ({sql}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        duck.execute(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet'")
    got, want = catalog.QUERIES[name](spark, str(tmp_path)), duck.execute(catalog.ORACLES[name])
    names = [x[0] for x in want.description]
    got, want = rows(got.columns, [tuple(r) for r in got.collect()]), rows(names, want.fetchall())
    assert got == want
    return got


@pytest.mark.parametrize("name", ["doc_rules", "mention_counts"])
def test_words_beside_letters_beyond_ascii(spark, tmp_path, name):
    texts = ["Zu und dasßbeö und", "éof the", "of theé", "das", "dasx", "the thé", "éthe th", "the\x0bthx", "of\x0bthe", "oder-das", "das_", "1das", "ofé! license", "", None]
    same_as_sql(spark, tmp_path, name, documents="SELECT * FROM (VALUES " + ", ".join(f"({i + 1}::BIGINT, {'NULL' if t is None else chr(39) + t + chr(39)})" for i, t in enumerate(texts)) + ") AS d (doc_id, text)")


def test_fetches_within_a_second_of_the_bounds(spark, tmp_path):
    times = ["2024-01-10 00:00:00", "2024-01-10 00:00:00.000001", "2024-01-10 00:00:00.999999", "2024-01-09 23:59:59.5", "2024-01-09 00:00:00", "2024-01-08 23:59:59.999999", "2024-01-09 00:00:00.5"]
    values = ", ".join(f"({i}::BIGINT, {10 + i}::BIGINT, TIMESTAMP '{t}', 'view')" for i, t in enumerate(times))
    got = same_as_sql(spark, tmp_path, "fetch_log", events=f"SELECT * FROM (VALUES {values}) AS e (event_id, user_id, ts, event_type)")
    assert [r[0] for r in got if "fresh" in r] == ["10", "13", "14", "16"]


def test_references_cut_short(spark, tmp_path):
    pages = ["<p>a &amp;&amp&am <b>x</b> &amp;lt; &amp;amp; &lt;b&gt; &quot; &copy; &middot;", "<p>&ampx; &notit; &copy2 &; &#; &lt", "", None]
    got = same_as_sql(spark, tmp_path, "html_lines", pages="SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, {'NULL' if p is None else chr(39) + p + chr(39)})" for i, p in enumerate(pages)) + ") AS p (page_id, html)")
    assert got[0] == ("0", 'a &&amp&am x &lt; &amp; <b> " © ·')


def test_words_of_blank_texts(spark, tmp_path):
    codes = [[], [32, 32], [10], [160], [160, 65, 98, 32, 160], [0x3000, 0xC9, 32, 0x2009, 66], [9, 160, 65], [65, 11, 66, 12, 99], None]
    values = ", ".join(f"({i}::BIGINT, {'NULL' if c is None else ' || '.join(['chr(' + str(x) + ')' for x in c]) or chr(39) * 2})" for i, c in enumerate(codes))
    assert len(same_as_sql(spark, tmp_path, "text_functions", documents=f"SELECT * FROM (VALUES {values}) AS d (doc_id, text)")) == len(codes)
