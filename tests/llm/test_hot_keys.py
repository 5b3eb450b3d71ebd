"""A third of all rows under one key, with bounds so small that hot and cool keys go their own ways: results stay those of one plain join."""

import functools

import pytest
from pyspark.sql import functions as F

from gleanery.llm import htmltext, linededup, simhash
from gleanery.operators.skew import join_spread


@pytest.fixture
def spread(monkeypatch):
    """Joins with hot keys apart from the others, whatever the table's size."""

    def use(module):
        made = []

        def joined(*a, **k):
            made.append(join_spread(*a, **k | {"least": 3, "hot_keys": 10, "few": 0}))
            return made[-1]

        monkeypatch.setattr(module, "join_spread", joined)
        return made

    return use


def test_line_templates(spark, spread):
    rows = [(k, f"one line that {k % 7} shares\n{'the hot line of all' if k % 3 == 0 else f'own line number of {chr(97 + k % 26)}{k}'}\nlast words {k}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    whole = sorted(map(tuple, linededup.drop_lines(df).collect()))
    made = spread(linededup)
    assert sorted(map(tuple, linededup.drop_lines(df).collect())) == whole and made
    assert "BroadcastHashJoin" in made[0]._jdf.queryExecution().executedPlan().toString()
    assert sum(n for *_, n in whole) > 300


def test_fingerprints(spark, spread):
    rows = [(k, "the same words in every third text of all" if k % 3 == 0 else f"text {k} of its own {k * 7} words {k * 11}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, simhash.near_duplicates(df).collect()))
    spread(simhash)
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == whole
    assert {c for k, _, c in whole if k % 3 == 0} == {0}


def test_hosts(spark, monkeypatch):
    rows = [(k, f"http://{'hot' if k % 3 else f'h{k % 11}'}.org/", f"<body><article><h1>T {k}</h1><div>Share</div><p>text {k}</article>") for k in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(map(tuple, htmltext.main_text(df).select("page_id", "text").collect()))
    monkeypatch.setattr(htmltext, "join_spread", functools.partial(lambda *a, f=join_spread, **k: f(*a, **k | {"least": 3, "hot_keys": 10, "few": 0})))
    assert sorted(map(tuple, htmltext.main_text(df).withColumn("x", F.lit(1)).select("page_id", "text").collect())) == whole
