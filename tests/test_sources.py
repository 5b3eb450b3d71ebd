"""Sources, sinks, streaming and the command line on small files."""

import json

import pytest
from pyspark.sql import functions as F

from gleanery import cli
from gleanery.operators import coverage, tasks
from gleanery.sources import config, files, rest, transforms
from gleanery.streaming import ledger

OBS = {"id": 7, "uuid": "u", "observed_on": "", "observed_on_string": "2020", "quality_grade": "research", "captive": False, "license_code": "CC-BY", "uri": None, "user": {"id": 1, "login": "ann", "name": "Ann"}, "taxon": {"id": 2, "name": "T a", "rank": "species"}, "photos": [{"id": 5, "license_code": "CC0", "url": None, "original_url": "o", "user": {"id": 3, "login": ""}}, {"id": 6, "license_code": None, "url": "u2"}]}
OCC = {"key": 9, "references": "https://www.inaturalist.org/observations/12/x", "datasetName": "d", "media": [{"identifier": "m"}]}
FILE = {"pageid": 1, "title": "File:A b.jpg", "categories": [{"title": "Category:X"}], "templates": [{"title": "Template:Cc-by-4.0"}, {"title": "Template:Cc-by-layout"}], "imageinfo": [{"url": "http://f", "extmetadata": {"LicenseShortName": {"value": "<b>CC-BY-4.0</b>"}, "Artist": {"value": "<a>Bo</a>"}}}]}


def raw(spark, record, ddl):
    return spark.createDataFrame([(json.dumps(record),)], "v string").select(F.from_json("v", ddl).alias("r")).select("r.*")


def test_transforms(spark):
    o = transforms.observations(raw(spark, OBS, transforms.OBSERVATION), "d")
    row = o.first()
    assert (row.observation_id, row.observed_on, row.license, row.source_url, row.photos_count) == (7, "2020", "cc-by", "https://www.inaturalist.org/observations/7", 2)
    assert [(m.photo_id, m.license, m.creator, m.media_url) for m in transforms.media_rows(o).collect()] == [(5, "cc0", "Ann", "o"), (6, None, "ann", "u2")]
    c = transforms.occurrences(raw(spark, OCC, transforms.OCCURRENCE), "d").first()
    assert (c.gbif_id, c.identity.inaturalist_observation_id, c.is_inaturalist_republication, c.media_count) == (9, 12, True, 1)
    f = transforms.files(raw(spark, FILE, transforms.FILE), "d").first()
    assert (f.file_name, f.license, f.creator, f.attribution, f.needs_review, f.file_page_url) == ("A b.jpg", "cc-by", "Bo", "Bo", False, "https://commons.wikimedia.org/wiki/File:A_b.jpg")
    assert transforms.files(raw(spark, FILE | {"missing": ""}, transforms.FILE), "d").count() == 0
    k = transforms.checklist(spark.createDataFrame([(" A  b ", "odd"), ("", "present"), ("C", None)], "name string, status string")).collect()
    assert [(r.original_name, r.normalized_name, r.membership_status) for r in k] == [("A  b", "a b", "uncertain"), ("C", "c", "present")]
    g = transforms.catalog(spark.createDataFrame([("A b", "sp.", "weird", "x; ;y")], "name string, rank string, status string, synonyms string"), "s").first()
    assert (g["rank"], g.taxonomic_status, g.synonyms) == ("species", "accepted", ["x", "y"])
    assert "latitude" not in transforms.reduced_snapshot(raw(spark, OBS, transforms.OBSERVATION), "now").columns


def test_saved_pages(spark, tmp_path):
    for n, ids in enumerate(([1, 2], [3], [])):
        (tmp_path / f"page{n}.json").write_text(json.dumps({"results": [OBS | {"id": i} for i in ids]}))
    (tmp_path / "bare.json").write_text(json.dumps([OBS | {"id": 4}]))
    (tmp_path / "named.json").write_text(json.dumps({"results": {"5": OBS | {"id": 5}}}))
    df = rest.scan_pages(spark, str(tmp_path), transforms.OBSERVATION)
    assert sorted(r.id for r in df.collect()) == [1, 2, 3, 4, 5]
    assert rest.scan_pages(spark, str(tmp_path), transforms.OBSERVATION, max_records=2).count() == 2


def test_calls_are_paced_and_tried_again():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    answers = [(429, {"Retry-After": "7"}, ""), (503, {}, ""), TimeoutError(), (200, {}, '{"a": 1}')]

    def get(url, params):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    call = rest.Caller(get, per_second=2.0, clock=lambda: now[0], sleep=sleep)
    assert call("u", {}) == {"a": 1} and slept == [7.0, 2.0, 4.0]
    for wrong, tries in (((404, {}, ""), 1), ((500, {}, ""), 5)):
        answers[:] = [wrong] * 5
        with pytest.raises(RuntimeError):
            call("u", {})
        assert len(answers) == 5 - tries
    answers[:], slept[:] = [(200, {}, "{}")] * 2, []
    call("u", {})
    call("u", {})
    assert slept[-1] == 0.5


def test_questions_of_the_services():
    s = rest.SERVICES
    q = rest.question(s["observations"], {"taxon": 1, "place": 2, "pageSize": 999, "licenses": "CC-BY,CC0"}, -3)
    assert (q["per_page"], q["page"], q["photo_license"], q["taxon_id"], q["order_by"]) == (200, 1, "CC-BY,CC0", 1, "id") and "id_above" not in q
    assert rest.question(s["observations"], {}, 1, 55)["id_above"] == 55
    assert rest.question(s["occurrences"], {"country": "PL", "pagesize": 0}, -5) | {"limit": 1, "offset": 0} == rest.question(s["occurrences"], {"country": "PL", "pagesize": 0}, -5)
    assert rest.question(s["files"], {"search": "x", "pageSize": 99})["gsrlimit"] == 50


TOTAL = 23


def test_live_scans_page_and_go_on(spark):
    total = TOTAL

    def fake_service(url, params):
        """Offline: total records by id, in the paging of each service."""
        ids = list(range(1, total + 1))
        if "inaturalist" in url:
            low = [i for i in ids if i > int(params.get("id_above", 0))]
            n, page = int(params["per_page"]), int(params["page"])
            return 200, {}, json.dumps({"results": [{"id": i} for i in low[(page - 1) * n : page * n]]})
        if "gbif" in url:
            n, at = int(params["limit"]), int(params["offset"])
            return 200, {}, json.dumps({"results": [{"id": i} for i in ids[at : at + n]], "endOfRecords": at + n >= total})
        n, at = int(params["gsrlimit"]), int(params.get("gsroffset", 0))
        more = {"continue": {"gsroffset": at + n}} if at + n < total else {}
        return 200, {}, json.dumps({"query": {"pages": [{"id": i} for i in ids[at : at + n]]}} | more)

    ids = lambda df: sorted(json.loads(r.record)["id"] for r in df.collect())
    for service in rest.SERVICES:
        rows = rest.scan_service(spark, service, fake_service, pageSize=5, perSecond=10_000).collect()
        assert sorted(json.loads(r.record)["id"] for r in rows) == list(range(1, TOTAL + 1))
        middle = json.loads(next(r.cursor for r in rows if json.loads(r.record)["id"] == 10))
        assert ids(rest.scan_service(spark, service, fake_service, cursor=middle, pageSize=5, perSecond=10_000)) == list(range(11, TOTAL + 1))
    paged = rest.scan_service(spark, "occurrences", fake_service, max_records=20, pageSize=5, pagesPerTask=2, perSecond=10_000)
    assert ids(paged) == list(range(1, 21)) and len(rest.PagedReader({"service": "occurrences", "maxRecords": "20", "pageSize": "5", "pagesPerTask": "2"}, fake_service).partitions()) == 2
    assert ids(rest.scan_service(spark, "observations", fake_service, cursor={"after": 17}, pageSize=5, perSecond=10_000)) == list(range(18, TOTAL + 1))


def test_runs_score_and_ledger(spark, tmp_path, capsys):
    (tmp_path / "t.jsonl").write_text("\n".join(json.dumps({"task_id": f"t{k}", "image_sha256": "i", "correct_taxon": "G a", "candidates": ["G a", "H b"], "synonyms_accepted": [], "meta": {"family": "F"}}) for k in range(3)) + "\n\n")
    (tmp_path / "p.jsonl").write_text(json.dumps({"task_id": "t0", "image_sha256": "i", "predictions": [{"taxon": "G a", "score": 1.0, "matched": True, "raw": "G a"}], "finish_reason": "stop", "provider": {"refusal": None}}))
    cli.run(["score", "--tasks", str(tmp_path / "t.jsonl"), "--predictions", str(tmp_path / "p.jsonl")])
    first = json.loads(capsys.readouterr().out.splitlines()[0])
    assert first["top1"] == pytest.approx(1 / 3) and first["missing"] == 2
    for run, top1 in (("a", 0.5), ("b", 0.75)):
        (tmp_path / "runs" / run).mkdir(parents=True)
        (tmp_path / "runs" / run / "manifest.json").write_text(json.dumps({"model_id": run, "suite": "s", "tasks_hash": "h"}))
        (tmp_path / "runs" / run / "scores.json").write_text(json.dumps({"tasks": 3, "tasks_hash": "h", "top1": top1}))
    cli.run(["leaderboard", "--runs", str(tmp_path / "runs")])
    assert "| 1 | b | 3 | 0.7500 |" in capsys.readouterr().out
    t = spark.createDataFrame([("x",), ("y",)], "task_id string")
    files.append_ledger(files.run_pending(t, None, files.constant_adapter("G a"), "task_id string, taxon string").where("task_id = 'x'"), str(tmp_path / "ledger"))
    done = spark.read.schema("task_id string, taxon string").json(str(tmp_path / "ledger"))
    rest_ = files.run_pending(t, done, files.perfect_adapter({"y": "H b"}), "task_id string, taxon string").collect()
    assert [(r.task_id, r.taxon) for r in rest_] == [("y", "H b")]
    q = ledger.first_of_each(ledger.follow_ledger(spark, str(tmp_path / "ledger"), "task_id string, taxon string").withColumn("ts", F.to_timestamp(F.lit("2020-01-01")))).writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("seen").count() == 1


def test_readers(spark, tmp_path):
    (tmp_path / "c.csv").write_text("﻿name,status\nA b,present\nC d,\n", encoding="utf-8")
    assert files.read_checklist(spark, str(tmp_path / "c.csv")).columns == ["name", "status"]
    for body in ([{"taxon": "a"}], {"candidates": [{"taxon": "a"}]}, {"media": [{"taxon": "a"}]}):
        (tmp_path / "k.json").write_text(json.dumps(body))
        assert [r.taxon for r in files.read_candidates(spark, str(tmp_path / "k.json"), "taxon:string").collect()] == ["a"]
    (tmp_path / "e.json").write_text(json.dumps({"sources": [{"id": "e1", "title": "T"}]}))
    assert files.read_evidence(spark, str(tmp_path / "e.json")).first().id == "e1"
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text(json.dumps({"models": [{"id": "x", "url": "${HOST}/v1", "key_env": "K"}]}))
    entry = config.registry(str(tmp_path / "m"))["x"]
    assert config.resolve(entry, {"HOST": "http://h"})["url"] == "http://h/v1" and "key_env" not in config.describe(entry)
    (tmp_path / "m" / "b.json").write_text(json.dumps({"id": "x"}))
    with pytest.raises(ValueError):
        config.registry(str(tmp_path / "m"))


def test_names_and_labels(spark):
    taxa = spark.createDataFrame([("A b",), ("C d",), ("E f",)], "taxon string")
    found = spark.createDataFrame([("A b", 0, "A x", "wrong"), ("A b", 1, "a B", None), ("C d", 0, "C x", "first"), ("C d", 1, "C y", "second")], "taxon string, place int, name string, common_name string")
    assert {r.taxon: r.common_name for r in coverage.common_names(taxa, found).collect()} == {"A b": None, "C d": "first", "E f": None}
    rows = spark.createDataFrame([("t", "A b", ["A b", "C d"])], "task_id string, correct_taxon string, candidates array<string>")
    r = tasks.relabel(rows, spark.createDataFrame([("C d", "Dee")], "taxon string, common_name string")).first()
    assert (r.correct_taxon, r.candidates, r.latin) == ("A b", ["A b", "Dee (C d)"], "A b")
    assert coverage.photo_codes(["CC0-1.0", "cc-by"]) == "CC-BY,CC0" and coverage.photo_codes([]) == "cc0,cc-by,cc-by-nc"
    import random

    got = tasks.python_order(rows, 42, "task_id", "candidates", 2).first().picked
    assert got == random.Random("42:t").sample(["A b", "C d"], 2)


def test_runs_go_on_only_as_they_were():
    h = files.run_hash("t", {"model": "m"}, {"seed": 1}, "c")
    assert h == files.run_hash("t", {"model": "m"}, {"seed": 1}, "c") != files.run_hash("t", {"model": "n"}, {"seed": 1}, "c")
    files.may_go_on(None, h, False, False)
    files.may_go_on({"run_hash": h, "status": "running"}, h, True, True)
    for previous, resume, there in ((None, True, True), ({"run_hash": h}, False, True), ({"run_hash": "x"}, True, True), ({"run_hash": h, "status": "complete"}, True, True)):
        with pytest.raises(ValueError):
            files.may_go_on(previous, h, resume, there)


def test_objects_are_checked_and_repaired():
    import hashlib

    good = hashlib.sha256(b"x").hexdigest()
    assert files.checked_object(b"x", good, None) == (b"x", False)
    assert files.checked_object(b"broken", good, lambda d: b"x") == (b"x", True) == files.checked_object(None, good, lambda d: b"x")
    for digest, stored in ((good, b"y"), (good.upper(), b"x"), ("../up", b"x")):
        with pytest.raises(ValueError):
            files.checked_object(None, digest, lambda d, s=stored: s)
