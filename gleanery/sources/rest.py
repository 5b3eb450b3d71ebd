"""Paged JSON services as a Spark data source.

``scan_service`` reads a service of SERVICES through an injected transport, a function (or its name, ``module:name``) that
takes (url, params) and returns (status, headers, body), so that no network library is assumed. Services with numbered pages or offsets are
read by one task for each range of places; those that hand out a token, or are followed by the last id, by one task. Tasks share one rate: of n tasks each
calls at the beginning of every n-th interval of the clock that all machines show. Every row carries the
cursor from which a later scan goes on. Pages saved earlier are read by ``scan_pages``, as any file that Spark reads.

``stream_service`` follows a service: offsets are cursors, so a stream that is started again on its checkpoint goes on behind the last page that it has committed. A service that
allows a call a second gains nothing by several readers, so one reads, a few pages a batch.
"""

from __future__ import annotations

import importlib
import json
import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

Get = Callable[[str, dict], tuple[int, dict, str]]


@dataclass(frozen=True)
class Service:
    """``ask``: option -> (parameter, least, most), numbers being held within the bounds. ``size`` and ``place`` are the parameters of a page's length
    and of where it starts; ``first`` and ``step`` say how places run on, a step of None by token. ``found`` is the way to a page's records."""

    url: str
    fixed: dict[str, object]
    ask: dict[str, tuple[str, int | None, int | None]]
    size: str
    place: str
    first: int
    step: int | str | None
    found: tuple[str, ...]
    after: str | None = None


# Addresses, parameter names, bounds and answers' shapes of the three services.
SERVICES = {
    "observations": Service(
        "https://api.inaturalist.org/v1/observations", {"order_by": "id", "order": "asc", "photos": "true"},
        {"taxon": ("taxon_id", None, None), "place": ("place_id", None, None), "grade": ("quality_grade", None, None), "licenses": ("photo_license", None, None), "pageSize": ("per_page", 1, 200)},
        "per_page", "page", 1, 1, ("results",), "id_above",
    ),
    "occurrences": Service(
        "https://api.gbif.org/v1/occurrence/search", {"media_type": "StillImage"},
        {"taxon": ("taxon_key", None, None), "country": ("country", None, None), "pageSize": ("limit", 1, 1000)}, "limit", "offset", 0, "size", ("results",),
    ),
    "files": Service(
        "https://commons.wikimedia.org/w/api.php",
        {"action": "query", "format": "json", "formatversion": "2", "generator": "search", "gsrnamespace": 6, "prop": "imageinfo|categories|templates", "iiprop": "timestamp|user|url|size|sha1|mime|extmetadata", "cllimit": "50", "tllimit": "50"},
        {"search": ("gsrsearch", None, None), "pageSize": ("gsrlimit", 1, 50)}, "gsrlimit", "gsroffset", 0, None, ("query", "pages"),
    ),
}
LONGEST_WAIT = 60.0


def question(service: Service, options: dict, place: object = None, after: object = None) -> dict:
    """The parameters of one call."""
    out = dict(service.fixed)
    for option, (name, least, most) in service.ask.items():
        if (value := options.get(option.lower(), options.get(option))) is not None:
            out[name] = value if least is None else sorted((least, int(value), most))[1]
    out.setdefault(service.size, next(most for name, _, most in service.ask.values() if name == service.size))
    if place is not None:
        out[service.place] = max(service.first, place) if isinstance(place, int) else place
    return out if after is None else out | {service.after: after}


class Caller:
    """Calls with a least interval between them; 429, server errors and broken connections are tried again, after the wait that the answer asks for or one that
    doubles."""

    def __init__(self, get: Get, per_second: float = 1.0, retries: int = 4, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, turn: tuple[int, int] = (0, 1)):
        self.get, self.gap, self.retries, self.clock, self.sleep, self.turn = get, 1 / per_second, retries, clock, sleep, turn
        self.free = float("-inf")

    def wait(self) -> None:
        """Until the interval since the last call is over; among several callers (``turn``: which of how many), until the beginning of an interval that is this one's."""
        k, n = self.turn
        if n > 1:
            now = self.clock()
            own = (math.floor(now / self.gap - k) // n + 1) * n + k  # the next interval whose number is k modulo n
            self.sleep(own * self.gap - now)
        elif (early := self.free - self.clock()) > 0:
            self.sleep(early)
        self.free = self.clock() + self.gap

    def __call__(self, url: str, params: dict) -> dict:
        wait = 1.0
        for left in range(self.retries, -1, -1):
            self.wait()
            asked = ""
            try:
                status, headers, body = self.get(url, params)
                if status < 300:
                    return json.loads(body)
                problem: Exception = RuntimeError(f"{url}: HTTP {status}")
                asked = str({k.lower(): v for k, v in headers.items()}.get("retry-after", ""))
                again = status == 429 or status // 100 == 5
            except (TimeoutError, ConnectionError) as e:
                problem, again = e, True
            if not again or not left:
                raise problem
            self.sleep(min(LONGEST_WAIT, float(asked) if asked.isdigit() else wait))
            wait = min(LONGEST_WAIT, 2 * wait)
        raise AssertionError


def follow(service: Service, call: Caller, options: dict, cursor: dict, most_pages: int | None = None) -> Iterator[tuple[dict, dict]]:
    """(record, cursor after its page) from a cursor on: {"place": where the next page starts} or {"after": the last id seen}. A page without records ends the
    scan, so does a service's own end mark, a missing token or a page that isn't full."""
    place, after, pages = cursor.get("place", service.first if service.step else None), cursor.get("after"), 0
    while most_pages is None or pages < most_pages:
        params = question(service, options, service.first if after is not None else place, after)
        page = call(service.url, params)
        records: object = page
        for key in service.found:
            records = records.get(key) if isinstance(records, dict) else None
        records = list(records.values()) if isinstance(records, dict) else records or []
        size, pages = params[service.size], pages + 1
        if not records:
            return
        if after is not None:
            after = records[-1]["id"]
        elif service.step is None:
            place = (page.get("continue") or {}).get(service.place)
        else:
            place += size if service.step == "size" else service.step
        nxt = {"after": after} if after is not None else {"place": place}
        yield from ((r, nxt) for r in records)
        if service.step is None and after is None and place is None or page.get("endOfRecords") or service.step is not None and len(records) < size:
            return


class Places(InputPartition):
    def __init__(self, cursor: dict, pages: int | None, turn: tuple[int, int] = (0, 1)):
        super().__init__(json.dumps([cursor, pages, turn]))


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, get: Get):
        self.options, self.get, self.service = options, get, SERVICES[options["service"]]
        self.cursor = json.loads(options.get("cursor", "{}"))
        self.most = int(options["maxRecords"]) if "maxRecords" in options else None
        self.each = int(options.get("pagesPerTask", 10))

    def partitions(self) -> list[Places]:
        """Ranges of places up to maxRecords where places can be counted, else one partition for all."""
        s = self.service
        if s.step is None or "after" in self.cursor or self.most is None:
            return [Places(self.cursor, None)]
        size = question(s, self.options)[s.size]
        pages, step = -(-self.most // size), size if s.step == "size" else s.step
        start = self.cursor.get("place", s.first)
        tasks = range(0, pages, self.each)
        return [Places({"place": start + k * step}, min(self.each, pages - k), (i, len(tasks))) for i, k in enumerate(tasks)] or [Places({"place": start}, 0)]

    def read(self, partition: Places) -> Iterator[tuple[str, str]]:
        cursor, pages, turn = json.loads(partition.value)
        clock = time.time if turn[1] > 1 else time.monotonic  # several tasks go by the clock that they have in common
        call = Caller(self.get, float(self.options.get("perSecond", 1)), int(self.options.get("retries", 4)), clock, turn=tuple(turn))
        for record, after in follow(self.service, call, self.options, cursor, pages):
            yield json.dumps(record, ensure_ascii=False), json.dumps(after)


class PagedStream(SimpleDataSourceStreamReader):
    """A service as a stream of pages. An offset is the cursor behind the last record: the last id, the number of records, or the service's token; at the end of a service that
    hands out tokens it stays. A batch has ``pagesPerBatch`` pages at most."""

    def __init__(self, options: dict, get: Get):
        self.options, self.service = options, SERVICES[options["service"]]
        self.call = Caller(get, float(options.get("perSecond", 1)), int(options.get("retries", 4)))
        self.pages = int(options.get("pagesPerBatch", 10))

    def initialOffset(self) -> dict:
        # Numbered pages would shift as records come in: such a service is followed by its ids.
        start = {"after": 0} if self.service.after else {"place": self.service.first}
        return json.loads(self.options.get("cursor", "{}")) or start

    def _rows(self, start: dict, most_pages: int | None) -> Iterator[tuple[dict, dict]]:
        """(record, cursor behind it)."""
        if start.get("ended"):
            return
        for n, (record, behind) in enumerate(follow(self.service, self.call, self.options, start, most_pages), 1):
            if "after" in start:
                yield record, {"after": record["id"]}
            elif self.service.step == "size":
                yield record, {"place": start["place"] + n}
            else:
                yield record, behind if behind["place"] is not None else {"ended": True, "records": start.get("records", 0) + n}

    def read(self, start: dict) -> tuple[Iterator[tuple[str, str]], dict]:
        rows = list(self._rows(start, self.pages))  # a few pages
        return iter([(json.dumps(r, ensure_ascii=False), json.dumps(c)) for r, c in rows]), rows[-1][1] if rows else start

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple[str, str]]:
        """The same rows again, for a batch that broke off after its offset was written."""
        last = False
        for record, cursor in self._rows(start, None):
            if "after" in end and record["id"] > end["after"] or "place" in end and isinstance(end["place"], int) and self.service.step == "size" and cursor["place"] > end["place"]:
                return
            if self.service.step is None and last and cursor != end:
                return
            last = cursor == end
            yield json.dumps(record, ensure_ascii=False), json.dumps(cursor)

    def commit(self, end: dict) -> None:
        return


def paged_json(transport: str | Get) -> type[DataSource]:
    """The data source over a transport."""

    def get(url: str, params: dict) -> tuple[int, dict, str]:
        if callable(transport):
            return transport(url, params)
        module, _, name = transport.partition(":")
        return getattr(importlib.import_module(module), name)(url, params)

    class PagedJson(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged_json"

        def schema(self) -> str:
            return "record string, cursor string"

        def reader(self, schema) -> PagedReader:
            return PagedReader(self.options, get)

        def simpleStreamReader(self, schema) -> PagedStream:
            return PagedStream(self.options, get)

    return PagedJson


def parsed(raw: DataFrame, ddl: str) -> DataFrame:
    """Records (column ``record``) under a declared schema; a record that doesn't fit is an error."""
    return raw.select(F.from_json("record", ddl, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def scan_service(spark: SparkSession, service: str, transport: str | Get, max_records: int | None = None, cursor: dict | None = None, **options) -> DataFrame:
    """(record, cursor) of a live service."""
    spark.dataSource.register(paged_json(transport))
    given = {"service": service, "cursor": json.dumps(cursor or {})} | {k: str(v) for k, v in options.items()}
    out = spark.read.format("paged_json").options(**given, **({} if max_records is None else {"maxRecords": str(max_records)})).load()
    return out if max_records is None else out.limit(max_records)


def stream_service(spark: SparkSession, service: str, transport: str | Get, cursor: dict | None = None, **options) -> DataFrame:
    """(record, cursor) of a live service as a stream: new records come as the service has them, none twice."""
    spark.dataSource.register(paged_json(transport))
    given = {"service": service, "cursor": json.dumps(cursor or {})} | {k: str(v) for k, v in options.items()}
    return spark.readStream.format("paged_json").options(**given).load()


def scan_pages(spark: SparkSession, path: str, ddl: str, key: str = "results", max_records: int | None = None) -> DataFrame:
    """Records of saved pages, one JSON file a page, on any file system that Spark reads: a page is an array, or an object with the records under ``key``, as an
    array or by name."""
    text = spark.read.option("wholetext", True).text(path, pathGlobFilter="*.json")
    under = F.get_json_object("value", f"$.{key}")
    body = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(under)
    many = F.when(F.ltrim(body).startswith("{"), F.map_values(F.from_json(body, "map<string,string>"))).otherwise(F.from_json(body, "array<string>"))
    out = parsed(text.select(F.explode(many).alias("record")), ddl)
    return out.limit(max_records) if max_records is not None else out
