"""Releases, publication and frozen suites on a shared file system.

Everything goes through Hadoop's file system or Spark's readers and writers, so a path may be one that only Spark opens. A Python data source
writer's tasks have no handle to that file system, so tables are written by Spark's own committers; what a writer's commit would gather
from its tasks (names, sizes, digests of files) is a table here, made by a job over the files that lie there and stored beside them: nothing grows on the driver.

A folder is built beside its place and moved there whole; on any failure what was built goes. What counts as finished carries a mark, written last and only if there is none.
Tables are told by the digest of their rows (``operators.merkle``), which doesn't depend on files, and each file by its sha256."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import merkle
from gleanery.session import cut
from gleanery.sources.files import RELEASE_TABLES
from gleanery.sources.store import Store, inventory

MARK, META, SUMS = "COMPLETE", "release.json", "checksums"
#: Rows of a file at most, so that no file outgrows what one task reads.
FILE_ROWS = 5_000_000


def row_text(df: DataFrame):
    """A row as one text: its columns by name, as JSON with nulls."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})


def content(df: DataFrame) -> dict:
    """{rows, digest} of a table, whatever its files and their order."""
    return merkle.root(merkle.tree(df, row_text(df))).first().asDict()


def write_table(df: DataFrame, path: str, keys: list[str]) -> None:
    """Rows in the keys' order over as many files as there are parts."""
    ordered = df.select(*sorted(df.columns)).orderBy(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    ordered.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)


def _building(spark: SparkSession, target: str, fill: Callable[[Store], dict]) -> dict:
    """What ``fill`` puts into a new folder beside ``target``, moved there whole; nothing is left if it fails."""
    if Store(spark, target).exists():
        raise FileExistsError(target)
    work = Store(spark, f"{target.rstrip('/')}.building-{uuid.uuid4().hex}")
    try:
        out = fill(work)
        work.move_to(target)
    except BaseException:
        work.delete()
        raise
    return out


def _seal(spark: SparkSession, store: Store, names: list[str]) -> str:
    """Write the checksums of all files of the tables as a table beside them; its digest."""
    each = [inventory(spark, f"{store.root}/{n}").withColumn("name", F.concat(F.lit(f"{n}/"), "name")) for n in names]
    rows = each[0]
    for df in each[1:]:
        rows = rows.unionByName(df)
    rows.orderBy("name").write.parquet(f"{store.root}/{SUMS}")
    return content(spark.read.parquet(f"{store.root}/{SUMS}"))["digest"]


def build_release(tables: dict[str, DataFrame], out: str, version: str, built_at: str, **more) -> dict:
    """A release folder: a Parquet table of many files for each artifact, the table ``checksums`` (name, sha256, bytes) of their files, and ``release.json``
    with version, counts, content digests, the checksums' own digest and whatever else is given."""
    spark = next(iter(tables.values())).sparkSession

    def fill(work: Store) -> dict:
        meta = {**more, "version": version, "built_at": built_at, "counts": {}, "content": {}}
        for name, keys in RELEASE_TABLES.items():
            write_table(tables[name], f"{work.root}/{name}.parquet", keys)
            found = content(spark.read.parquet(f"{work.root}/{name}.parquet"))
            meta["counts"][name], meta["content"][name] = found["rows"], found["digest"]
        meta["checksums"] = _seal(spark, work, [f"{n}.parquet" for n in RELEASE_TABLES])
        work.put_json(META, meta)
        return meta

    return _building(spark, out, fill)


def _violations(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "name string, problem string")


def changed_files(spark: SparkSession, root: str) -> DataFrame:
    """(name, problem): files that are missing, new, or differ from the checksums beside them."""
    store = Store(spark, root)
    listed = spark.read.parquet(f"{root}/{SUMS}")
    lie = None
    for name in [t for t in store.tables() if t != SUMS]:
        one = inventory(spark, f"{root}/{name}").withColumn("name", F.concat(F.lit(f"{name}/"), "name"))
        lie = one if lie is None else lie.unionByName(one)
    lie = lie if lie is not None else listed.limit(0)
    both = listed.join(lie.toDF("name", "found", "size"), "name", "full")
    problem = F.when(F.col("found").isNull(), "missing").when(F.col("sha256").isNull(), "not in the checksums").when((F.col("found") != F.col("sha256")) | (F.col("size") != F.col("bytes")), "checksum mismatch")
    return both.select("name", problem.alias("problem")).where("problem is not null")


def verify_release(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """(name, problem) of all that is wrong with a release folder; no rows if nothing is. Files are read where the executors are. Only if they are
    all as listed are the tables' rows counted and digested."""
    store = Store(spark, root)
    missing = [(n, "missing") for n in [*(f"{t}.parquet" for t in RELEASE_TABLES), META, SUMS] if not store.exists(n)]
    if missing:
        return _violations(spark, missing)
    try:
        meta = store.get_json(META)
    except ValueError:
        return _violations(spark, [(META, "can't be read")])
    wrong = [(META, f"version {meta.get('version')!r} is not {version!r}")] if version and meta.get("version") != version else []
    if content(spark.read.parquet(f"{root}/{SUMS}"))["digest"] != meta.get("checksums"):
        wrong.append((SUMS, "checksum mismatch"))
    files = cut(changed_files(spark, root))
    if not files.limit(1).count():
        for name in RELEASE_TABLES:
            found = content(spark.read.parquet(f"{root}/{name}.parquet"))
            if (found["rows"], found["digest"]) != (meta["counts"].get(name), meta["content"].get(name)):
                wrong.append((f"{name}.parquet", "rows differ from release.json"))
    return files.unionByName(_violations(spark, wrong))


def publish(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a verified release to its immutable place; False if the same one is there already.

    Every table is a job and has a mark of its own, so a publication that broke off goes on behind the last table that was finished; a table is marked only after its rows
    were read back and have the digest that release.json says. The whole is marked ``COMPLETE`` last, and a marked one is never written again: another release
    under its name raises FileExistsError."""
    src, dst = Store(spark, source), Store(spark, target)
    meta = src.get_json(META)
    if dst.exists(MARK):
        if dst.get_json(MARK).get("content") != meta["content"]:
            raise FileExistsError(f"{target} is published with other content")
        return False
    wrong = verify_release(spark, source).limit(20).collect()
    if wrong:
        raise ValueError("; ".join(f"{r.name}: {r.problem}" for r in wrong))
    stage = Store(spark, f"{target.rstrip('/')}.staging")
    for name, keys in RELEASE_TABLES.items():
        wanted = {"rows": meta["counts"][name], "digest": meta["content"][name]}
        if stage.exists(f"{name}.done"):
            if stage.get_json(f"{name}.done") == wanted:
                continue
            stage.delete(f"{name}.done")  # of another release
        stage.delete(f"{name}.parquet")
        write_table(spark.read.parquet(f"{source}/{name}.parquet"), f"{stage.root}/{name}.parquet", keys)
        if content(spark.read.parquet(f"{stage.root}/{name}.parquet")) != wanted:
            raise ValueError(f"{name} was not copied whole")
        stage.put_json(f"{name}.done", wanted)
    stage.delete(SUMS)
    stage.delete(META)
    sums = _seal(spark, stage, [f"{n}.parquet" for n in RELEASE_TABLES])
    stage.put_json(META, {**meta, "checksums": sums})
    for name in RELEASE_TABLES:
        stage.delete(f"{name}.done")
    dst.delete()  # without a mark: of a publication that broke off
    stage.move_to(target)
    return Store(spark, target).put_json(MARK, {"version": meta["version"], "content": meta["content"], "checksums": sums})


def put_objects(objects: DataFrame, root: str) -> int:
    """Append to the object store at ``root`` those of ``objects`` (sha256, content) that it lacks; how many. Content is stored under its digest, once:
    an object whose content has another one raises ValueError, and a run that broke off goes on with what is missing."""
    spark = objects.sparkSession
    wrong = objects.where(F.sha2("content", 256) != F.lower("sha256")).select("sha256").limit(5).collect()
    if wrong:
        raise ValueError(f"content has another digest: {', '.join(r.sha256 for r in wrong)}")
    new = objects.select(F.lower("sha256").alias("sha256"), F.length("content").cast("long").alias("bytes"), "content")
    if Store(spark, root).exists():
        new = new.join(spark.read.parquet(root).select("sha256"), "sha256", "left_anti")
    new = cut(new.groupBy("sha256", "bytes").agg(F.first("content").alias("content")))
    n = new.count()
    if n:
        new.write.mode("append").parquet(root)
    return n


def suite_digest(tasks: DataFrame) -> str:
    return content(tasks)["digest"]


def publish_suite(tasks: DataFrame, objects: DataFrame, target: str, suite: str, wanted: str = "image_sha256") -> bool:
    """Freeze a suite at ``target``/``suite``: its objects, tasks, the inventory (sha256, bytes) of the objects that tasks want, and a mark, in that order. False if it is
    published already; another suite of that name raises FileExistsError; tasks whose objects are nowhere raise ValueError. Objects are shared by all suites
    under ``target``."""
    if not suite or suite in (".", "..") or "/" in suite or "\\" in suite:
        raise ValueError(f"not a folder's name: {suite!r}")
    spark, root = tasks.sparkSession, f"{target.rstrip('/')}/{suite}"
    store, pool, digest = Store(spark, root), f"{target.rstrip('/')}/objects", suite_digest(tasks)
    if store.exists(MARK):
        if store.get_json(MARK)["tasks"] != digest:
            raise FileExistsError(f"another suite {suite} is published")
        return False
    put_objects(objects, pool)
    asked = tasks.select(F.lower(wanted).alias("sha256")).where("sha256 is not null").distinct()
    missing = asked.join(spark.read.parquet(pool), "sha256", "left_anti") if Store(spark, pool).exists() else asked
    if gone := missing.limit(5).collect():
        raise ValueError(f"no object for {', '.join(r.sha256 for r in gone)}")
    store.delete()  # of a publication that broke off; objects stay
    tasks.write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{root}/tasks")
    held = spark.read.parquet(pool).join(asked, "sha256", "left_semi").select("sha256", "bytes") if Store(spark, pool).exists() else asked.withColumn("bytes", F.lit(0).cast("long"))
    held.write.parquet(f"{root}/inventory")
    return store.put_json(MARK, {"suite": suite, "tasks": digest, "inventory": content(spark.read.parquet(f"{root}/inventory"))["digest"]})


def restore_suite(spark: SparkSession, target: str, suite: str, out: str) -> dict:
    """Bring a published suite to ``out`` (tasks and objects), after everything has been verified: the mark, the inventory's and the tasks' digests, and every
    object's content against its digest and size. On any difference ValueError, and nothing is installed."""
    root, pool = f"{target.rstrip('/')}/{suite}", f"{target.rstrip('/')}/objects"
    mark = Store(spark, root).get_json(MARK)
    tasks, listed = spark.read.parquet(f"{root}/tasks"), spark.read.parquet(f"{root}/inventory")
    if mark.get("suite") != suite or content(listed)["digest"] != mark["inventory"] or suite_digest(tasks) != mark["tasks"]:
        raise ValueError(f"{suite} differs from its mark")

    def fill(work: Store) -> dict:
        n = listed.count()
        if n:
            held = spark.read.parquet(pool).join(listed, ["sha256", "bytes"], "left_semi").dropDuplicates(["sha256"])
            held.where((F.sha2("content", 256) == F.col("sha256")) & (F.length("content") == F.col("bytes"))).write.parquet(f"{work.root}/objects")
            good = spark.read.parquet(f"{work.root}/objects").select("sha256", "bytes")
            if bad := listed.join(good, ["sha256", "bytes"], "left_anti").limit(5).collect():
                raise ValueError(f"object missing or changed: {', '.join(r.sha256 for r in bad)}")
        tasks.write.parquet(f"{work.root}/tasks")
        if suite_digest(spark.read.parquet(f"{work.root}/tasks")) != mark["tasks"]:
            raise ValueError("tasks were not copied whole")
        work.put_json(MARK, mark)
        return {"suite": suite, "tasks": tasks.count(), "objects": n}

    return _building(spark, out, fill)
