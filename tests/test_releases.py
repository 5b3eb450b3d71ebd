"""Releases and suites on a path that only Spark's file system opens, and trees of digests against plain versions."""

import hashlib
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanery import cli
from gleanery.operators import merkle
from gleanery.sources import releases
from gleanery.sources.store import Store, inventory


@pytest.fixture
def place(spark, tmp_path):
    """(path by a mount that only Hadoop's file system knows, the folder behind it)."""
    name = f"t{random.randrange(10**9)}"
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{name}.link./in", f"file://{tmp_path}")
    return f"viewfs://{name}/in", tmp_path


def tables(spark, n=40):
    media = [(f"{k:064x}", f"loc/{k}", "c", "CC0-1.0", "r", "T a") for k in range(n)]
    return {
        "taxa": spark.createDataFrame([("T a", "x", "F")], "taxon string, authorship string, family string"),
        "media": spark.createDataFrame(media, "sha256 string, s3_uri string, creator string, license string, source_record string, taxon string").repartition(3),
        "attribution": spark.createDataFrame([(m[0], "c", "CC0-1.0", None) for m in media], "sha256 string, creator string, license string, attribution string"),
        "evidence": spark.createDataFrame([("e", "T a", "10.1/x", "", "", "")], "id string, taxon string, doi string, pmid string, isbn string, url string"),
        "danger_assessments": spark.createDataFrame([("T a", "none_known", "PL", "r", "e", "w", "2020-01-01", "draft")], "taxon string, category string, geographic_scope string, rationale string, evidence_ids string, reviewer string, review_date string, status string").limit(0),
    }


def problems(spark, root, version=None):
    return sorted(map(tuple, releases.verify_release(spark, root, version).collect()))


def test_release_is_built_verified_and_published(spark, place):
    root, folder = place
    meta = releases.build_release(tables(spark), f"{root}/r1", "v1", "now", license_profile="research")
    assert meta["counts"]["media"] == 40 and meta["counts"]["danger_assessments"] == 0 and meta["license_profile"] == "research"
    assert problems(spark, f"{root}/r1", "v1") == [] and problems(spark, f"{root}/r1", "v2")[0][0] == "release.json"
    again = releases.build_release(tables(spark), f"{root}/r2", "v1", "later")
    assert again["content"] == meta["content"]
    with pytest.raises(FileExistsError):
        releases.build_release(tables(spark), f"{root}/r1", "v1", "now")
    assert releases.publish(spark, f"{root}/r1", f"{root}/pub/v1") and not releases.publish(spark, f"{root}/r2", f"{root}/pub/v1")
    assert problems(spark, f"{root}/pub/v1") == [] and Store(spark, f"{root}/pub/v1").exists("COMPLETE")
    releases.build_release(tables(spark, 39), f"{root}/r3", "v1", "now")
    with pytest.raises(FileExistsError):
        releases.publish(spark, f"{root}/r3", f"{root}/pub/v1")
    part = next((folder / "r1" / "media.parquet").glob("part-*"))
    part.write_bytes(part.read_bytes() + b"x")
    part.with_name(f".{part.name}.crc").unlink()
    (folder / "r1" / "taxa.parquet" / "part-extra.parquet").write_bytes(b"y")
    assert [p for _, p in problems(spark, f"{root}/r1")] == ["checksum mismatch", "not in the checksums"]
    with pytest.raises(ValueError, match="checksum mismatch"):
        releases.publish(spark, f"{root}/r1", f"{root}/pub/v2")
    for f in (folder / "r2" / "media.parquet").glob("part-*"):
        f.unlink()
    assert {p for _, p in problems(spark, f"{root}/r2")} == {"missing"}
    Store(spark, f"{root}/r2").delete("release.json")
    assert problems(spark, f"{root}/r2") == [("release.json", "missing")]


def test_rows_changed_behind_valid_checksums_are_found(spark, place):
    root, _ = place
    releases.build_release(tables(spark), f"{root}/r", "v1", "now")
    store = Store(spark, f"{root}/r")
    store.delete("taxa.parquet")
    store.delete("checksums")
    spark.createDataFrame([("T b", "x", "F")], "taxon string, authorship string, family string").write.parquet(f"{root}/r/taxa.parquet")
    digest = releases._seal(spark, store, [f"{n}.parquet" for n in releases.RELEASE_TABLES])
    meta = store.get_json("release.json")
    store.delete("release.json")
    store.put_json("release.json", {**meta, "checksums": digest})
    assert problems(spark, f"{root}/r") == [("taxa.parquet", "rows differ from release.json")]


def test_a_task_that_dies_leaves_nothing(spark, place):
    root, folder = place
    t = tables(spark)
    t["media"] = t["media"].withColumn("creator", F.when(F.col("s3_uri") == "loc/7", F.raise_error(F.lit("lost"))).otherwise(F.col("creator")))
    with pytest.raises(Exception, match="lost"):
        releases.build_release(t, f"{root}/r", "v1", "now")
    assert [p.name for p in folder.iterdir()] == []


def test_a_publication_that_broke_off_goes_on(spark, place, monkeypatch):
    root, _ = place
    releases.build_release(tables(spark), f"{root}/r", "v1", "now")
    write, written = releases.write_table, []

    def some(df, path, keys):
        if "attribution" in path and not any("attribution" in p for p in written):
            written.append(path)
            raise OSError("gone")
        written.append(path)
        write(df, path, keys)

    monkeypatch.setattr(releases, "write_table", some)
    with pytest.raises(OSError, match="gone"):
        releases.publish(spark, f"{root}/r", f"{root}/pub")
    assert not Store(spark, f"{root}/pub").exists()
    assert releases.publish(spark, f"{root}/r", f"{root}/pub") and problems(spark, f"{root}/pub") == []
    assert sum("media" in p for p in written) == 1  # finished before, not written again


def test_conditional_put(spark, place):
    store = Store(spark, place[0])
    assert store.put("a/mark", b"x\x00\xff") and not store.put("a/mark", b"x\x00\xff") and store.get("a/mark") == b"x\x00\xff"
    with pytest.raises(FileExistsError):
        store.put("a/mark", b"other")
    with pytest.raises(FileNotFoundError):
        store.get("a/none")
    assert [(r.name, r.bytes, r.sha256) for r in inventory(spark, f"{place[0]}/a").collect()] == [("mark", 3, hashlib.sha256(b"x\x00\xff").hexdigest())]


def test_suite_published_and_restored(spark, place):
    root, folder = place
    blobs = [bytes([k]) * (k + 1) for k in range(30)]
    sha = [hashlib.sha256(b).hexdigest() for b in blobs]
    objects = spark.createDataFrame([(s, bytearray(b)) for s, b in zip(sha, blobs, strict=True)] + [(sha[0].upper(), bytearray(blobs[0]))], "sha256 string, content binary")
    tasks = spark.createDataFrame([(f"t{k}", sha[k % 20]) for k in range(50)] + [("none", None)], "task_id string, image_sha256 string")
    assert releases.publish_suite(tasks, objects, f"{root}/b", "s1") and not releases.publish_suite(tasks.repartition(4), objects, f"{root}/b", "s1")
    assert spark.read.parquet(f"{root}/b/objects").count() == 30
    assert releases.publish_suite(tasks.limit(3), objects, f"{root}/b", "s2") and spark.read.parquet(f"{root}/b/objects").count() == 30  # shared, put once
    with pytest.raises(FileExistsError):
        releases.publish_suite(tasks.limit(4), objects, f"{root}/b", "s2")
    with pytest.raises(ValueError, match="no object"):
        releases.publish_suite(spark.createDataFrame([("t", "f" * 64)], tasks.schema), objects, f"{root}/b", "s3")
    with pytest.raises(ValueError, match="another digest"):
        releases.put_objects(spark.createDataFrame([("e" * 64, bytearray(b"x"))], objects.schema), f"{root}/b/objects")
    for name in ("", ".", "a/b"):
        with pytest.raises(ValueError, match="folder"):
            releases.publish_suite(tasks, objects, root, name)
    got = releases.restore_suite(spark, f"{root}/b", "s1", f"{root}/local")
    assert got == {"suite": "s1", "tasks": 51, "objects": 20}
    held = {r.sha256: bytes(r.content) for r in spark.read.parquet(f"{root}/local/objects").collect()}
    assert held == {s: b for s, b in zip(sha[:20], blobs, strict=False)}
    # An object that was changed in place: nothing is installed.
    whole = spark.read.parquet(f"{root}/b/objects").collect()
    Store(spark, f"{root}/b").delete("objects")
    spark.createDataFrame([(r.sha256, r.bytes, bytearray(b"z" * r.bytes) if r.sha256 == sha[5] else r.content) for r in whole], "sha256 string, bytes long, content binary").write.parquet(f"{root}/b/objects")
    with pytest.raises(ValueError, match=sha[5]):
        releases.restore_suite(spark, f"{root}/b", "s1", f"{root}/other")
    assert sorted(p.name for p in folder.iterdir()) == ["b", "local"]


def test_commands(spark, place, capsys):
    root, _ = place
    for n, df in tables(spark).items():
        df.write.parquet(f"{root}/t/{n}.parquet")
    cli.run(["release-build", "--tables", f"{root}/t", "--out", f"{root}/r", "--version", "v", "--built-at", "now"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["counts"]["media"] == 40
    cli.run(["release-publish", "--release", f"{root}/r", "--target", f"{root}/p"])
    cli.run(["release-publish", "--release", f"{root}/r", "--target", f"{root}/p"])
    assert capsys.readouterr().out.splitlines()[-2:] == ["published", "published already"]
    with pytest.raises(SystemExit, match="version"):
        cli.run(["release-verify", "--release", f"{root}/p", "--version", "w"])


def plain_tree(texts, depth):
    from collections import Counter

    own = Counter(hashlib.sha256(b"" if t is None else b"=" + t.encode()).hexdigest() for t in texts)
    seal = lambda parts: hashlib.sha256(",".join(sorted(parts)).encode()).hexdigest()
    nodes = {(depth, p): (sum(n for d, n in own.items() if d[:depth] == p), seal(f"{d}:{n}" for d, n in own.items() if d[:depth] == p)) for p in {d[:depth] for d in own}}
    for level in range(depth - 1, -1, -1):
        below = {p: v for (k, p), v in nodes.items() if k == level + 1}
        for p in {q[:level] for q in below}:
            nodes[level, p] = (sum(v[0] for q, v in below.items() if q[:level] == p), seal(f"{q}:{v[1]}" for q, v in below.items() if q[:level] == p))
    return nodes


def test_trees_match_a_plain_version_at_any_partitioning(spark):
    rng = random.Random(1)
    texts = [rng.choice([None, "", "hot", f"r{rng.randrange(300)}"]) for _ in range(900)] + ["hot"] * 500
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for depth in (0, 1, 2):
        want = plain_tree(texts, depth)
        for parts in (1, 7):
            got = {(r.level, r.prefix): (r.rows, r.digest) for r in merkle.tree(df.repartition(parts), F.col("t"), depth).collect()}
            assert got == want
    assert merkle.root(merkle.tree(df, F.col("t"), leaf=4)).first().rows == 1400
    assert merkle.root(merkle.tree(df.limit(0), F.col("t"))).first().rows == 0
    assert merkle.depth_for(1024) == 0 and merkle.depth_for(1025) == 1 and merkle.depth_for(10**9) == 5


def test_difference_reads_only_leaves_that_differ(spark):
    rows = [(k, f"v{k}") for k in range(2000)]
    a = spark.createDataFrame([*rows, (1, "v1"), (None, None)], "k long, v string")
    b = spark.createDataFrame([(k, v if k != 77 else "new") for k, v in rows if k != 500] + [(9000, "more"), (9000, "more")], "k long, v string")
    text = F.to_json(F.struct("k", "v"), {"ignoreNullFields": "false"})
    want = {("a", 77, "v77", 1), ("a", 500, "v500", 1), ("a", 1, "v1", 1), ("a", None, None, 1), ("b", 77, "new", 1), ("b", 9000, "more", 2)}
    assert set(map(tuple, merkle.difference(a, b, text, 2).collect())) == want
    assert set(map(tuple, merkle.difference(a, b, text).collect())) == want
    trees = merkle.tree(a, text, 2), merkle.tree(b, text, 2)
    assert 0 < merkle.differing_leaves(*trees, 2).count() <= 6
    assert merkle.difference(a, a.repartition(5), text, 2).count() == 0 == merkle.difference(a.limit(0), b.limit(0), text).count()
