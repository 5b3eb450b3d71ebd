"""Each registered query on the smallest tables: columns, types, one row for each input row, thresholds, ids."""

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_urlfilter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op3_linededup": {"doc_id": "bigint", "text": "string", "n_lines": "bigint", "n_dropped": "bigint"},
    "op4_htmltext": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op5_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op6_langid": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op7_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_fingerprint": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op10_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op11_qualityrules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean", "votes": "string", "posterior": "double"},
    "op12_tokenalign": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
}
THRESHOLDS = {"op1_quality": 0.3, "op7_toxicity": 0.7}


@pytest.mark.parametrize("name", COLUMNS)
def test_query_keeps_its_contract(spark, name):
    out = entry.queries()[name](spark, DATA)
    assert dict(out.dtypes) == COLUMNS[name]
    key = out.columns[0]
    rows = out.collect()
    table = {"doc_id": "documents", "page_id": "pages"}[key]
    ids = duckdb.sql(f"SELECT {key} FROM read_parquet('{DATA}/{table}.parquet') ORDER BY 1").fetchall()
    assert sorted(r[key] for r in rows) == [i for (i,) in ids]
    if "score" in out.columns:
        assert all(0 <= r.score <= 1 for r in rows)
    if name in THRESHOLDS:
        assert all(r.predicted == int(r.score >= THRESHOLDS[name]) for r in rows)
    if "held_out" in out.columns:
        import zlib

        of, rest = (3, 1) if name == "op7_toxicity" else (5, 0)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % of == rest) for r in rows)
    if name == "op4_htmltext":
        assert all(r.n_chars == len(r.text) for r in rows)
    if name == "op9_fingerprint":
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    if name == "op11_qualityrules":
        assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and r.kept == (not r.base_failed and r.posterior >= 0.5) for r in rows)
    if name == "op10_simhash":
        assert all(len(r.fingerprint) == 16 and r.component_id <= r.doc_id for r in rows)
