"""Services followed as streams, and one rate for all tasks."""

import json
import time

import pytest

from gleanery.sources import rest


def service(log, count):
    """A transport whose records are as many as the file ``count`` says; calls are written to ``log`` with their times."""

    def get(url, params):
        with open(count) as f:
            ids = list(range(1, int(f.read()) + 1))
        with open(log, "a") as f:
            f.write(json.dumps([time.time(), params]) + "\n")
        if "inaturalist" in url:
            low = [i for i in ids if i > int(params.get("id_above", 0))]
            return 200, {}, json.dumps({"results": [{"id": i} for i in low[: int(params["per_page"])]]})
        if "gbif" in url:
            n, at = int(params["limit"]), int(params["offset"])
            return 200, {}, json.dumps({"results": [{"id": i} for i in ids[at : at + n]], "endOfRecords": at + n >= len(ids)})
        n, at = int(params["gsrlimit"]), int(params.get("gsroffset", 0))
        more = {"continue": {"gsroffset": at + n}} if at + n < len(ids) else {}
        return 200, {}, json.dumps({"query": {"pages": [{"id": i} for i in ids[at : at + n]]}} | more)

    return get


def drain(spark, name, get, place, **options):
    df = rest.stream_service(spark, name, get, perSecond=10_000, pageSize=5, **options)
    query = df.writeStream.format("parquet").option("checkpointLocation", f"{place}/state").start(f"{place}/out")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sorted(json.loads(r.record)["id"] for r in spark.read.parquet(f"{place}/out").collect())


@pytest.mark.parametrize("name", ["observations", "occurrences", "files"])
def test_a_stream_goes_on_where_it_stopped(spark, tmp_path, name):
    log, count = tmp_path / "log", tmp_path / "count"
    count.write_text("23")
    get = service(str(log), str(count))
    assert drain(spark, name, get, tmp_path, pagesPerBatch=2) == list(range(1, 24))
    before = [json.loads(x)[1] for x in log.read_text().splitlines()]
    log.write_text("")
    if name == "files":  # the service said that it was at its end
        assert drain(spark, name, get, tmp_path, pagesPerBatch=2) == list(range(1, 24)) and log.read_text() == ""
        return
    count.write_text("31")
    assert drain(spark, name, get, tmp_path, pagesPerBatch=2) == list(range(1, 32))
    after = [json.loads(x)[1] for x in log.read_text().splitlines()]
    where = "id_above" if name == "observations" else "offset"
    assert min(int(p[where]) for p in after) == 23 and max(int(p[where]) for p in before) == 23


@pytest.mark.parametrize("name", ["observations", "occurrences", "files"])
def test_a_batch_is_read_again_alike(tmp_path, name):
    log, count = tmp_path / "log", tmp_path / "count"
    count.write_text("23")
    reader = rest.PagedStream({"service": name, "pageSize": "5", "pagesPerBatch": "2", "perSecond": "10000"}, service(str(log), str(count)))
    at, seen = reader.initialOffset(), []
    while True:
        rows, end = reader.read(at)
        rows = list(rows)
        if not rows:
            break
        count.write_text("40" if name == "observations" else "23")  # more has come since
        assert list(reader.readBetweenOffsets(at, end)) == rows
        count.write_text("23")
        seen += [json.loads(r)["id"] for r, _ in rows]
        at = json.loads(json.dumps(end))
    assert seen == list(range(1, 24))


def test_eight_tasks_keep_one_interval(spark, tmp_path):
    log, count = tmp_path / "log", tmp_path / "count"
    count.write_text("60")
    rows = rest.scan_service(spark, "occurrences", service(str(log), str(count)), max_records=48, pageSize=2, pagesPerTask=3, perSecond=10).collect()
    assert len(rows) == 48
    times = sorted(json.loads(x)[0] for x in log.read_text().splitlines())
    assert len(times) == 24
    # A call is stamped a little after it is made: no tenth of a second has two.
    assert len({int(t * 10) for t in times}) >= 22 and times[-1] - times[0] > 2.0


def test_turns_of_several_callers():
    now = [100.0]

    def sleep(s):
        now[0] += s

    made = []
    calls = [rest.Caller(lambda u, p: (200, {}, "{}"), 2.0, clock=lambda: now[0], sleep=sleep, turn=(k, 3)) for k in range(3)]
    for k in (0, 1, 2, 2, 0, 0, 1):
        calls[k]("u", {})
        made.append((k, now[0]))
    assert all(round(t * 2) % 3 == k and abs(t * 2 - round(t * 2)) < 1e-6 for k, t in made)
    assert all(b - a >= 0.5 - 1e-6 for (_, a), (_, b) in zip(made, made[1:], strict=False))
