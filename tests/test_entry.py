"""The entry module, and the rest of the library without the training-data subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"
SAMPLE = ["score_summary", "score_per_family", "leaderboard_rank", "caps_per_taxon", "gallery_query_split", "hard_shortlist", "dedup_exact", "gate_release", "upsert_last_wins"]


def rows(found):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in found)


@pytest.mark.parametrize("name", SAMPLE)
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {t.stem} AS SELECT * FROM read_parquet('{t}')")
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert rows(tuple(r) for r in df.select(*cols).collect()) == rows(want)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_stands_alone():
    """No module outside the subpackage imports it."""
    for p in [*(ROOT / "gleanery").rglob("*.py"), *(ROOT / "tests").glob("*.py")]:
        if "llm" not in p.relative_to(ROOT).parts and p != Path(__file__).resolve():
            assert "gleanery.llm" not in p.read_text(encoding="utf-8"), p
    code = "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['gleanery.llm'] = None; import __spark_entry__ as e; assert 'score_summary' in e.queries() and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
