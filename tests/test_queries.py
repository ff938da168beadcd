"""Every query with SQL gives the same rows as DuckDB."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from loomstep.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
SLOW = {"padded_core", "gbt_cv", "gain_share", "select_features"}


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return float(value) + 0.0 if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql and n not in SLOW])
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    got = QUERIES[name].run(spark, SF)
    columns = sorted(got.columns)
    own = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    rel = con.sql(QUERIES[name].sql)
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert own == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)


def test_boosted_trees(spark):
    assert [r["fold"] for r in QUERIES["gbt_cv"].run(spark, SF).orderBy("fold").collect()] == [1, 2]
    assert sum(r["gain_share"] for r in QUERIES["gain_share"].run(spark, SF).collect()) == pytest.approx(1)
    best = {r["rank"]: r["feature"] for r in QUERIES["select_features"].run(spark, SF).collect()}
    assert best[1] == "feature_01" and best[2] in ("feature_00", "responder_1")


def test_entry_without_the_llm_folder(tmp_path):
    """The entry works where corpus_pipeline.py and the llm folder are gone, and does not hide errors inside them."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))"
    shutil.copytree(f"{root}/loomstep", tmp_path / "loomstep", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES)), "False"], done.stderr
    (tmp_path / "loomstep" / "llm").mkdir()
    (tmp_path / "loomstep" / "llm" / "__init__.py").write_text("import no_such_module\n")
    (tmp_path / "corpus_pipeline.py").write_text("import loomstep.llm\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode and "no_such_module" in done.stderr
