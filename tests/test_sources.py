"""Manifests of streams and of commits, and data sources in Python."""

from __future__ import annotations

import json
import shutil
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessaria.plans.running import bitmap
from tessaria.sources import files, python
from tessaria.sources.versions import Conflict, Versions
from tessaria.streaming import incremental
from tessaria.streaming.state import ON_DISK


def arriving(spark, folder):
    return spark.readStream.schema("id long, k int").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(str(folder))


def put(spark, folder, k, ids):
    spark.createDataFrame([(i, k) for i in ids], "id long, k int").coalesce(1).write.parquet(f"{folder}/k{k}")


def test_manifest_of_a_stream_keeps_ids_for_good(spark, tmp_path):
    """An id seen in the first file is not taken again from the last, whatever its time; no batch reads what was written."""
    settings = {k: spark.conf.get(k, None) for k in ON_DISK}
    for k, ids in enumerate(([1, 2, None], [3], [2, 4, 4], [1, 5])):
        put(spark, f"{tmp_path}/in", k, ids)
    incremental.manifest(arriving(spark, f"{tmp_path}/in"), "id", f"{tmp_path}/out")
    assert sorted((r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()), key=str) == [1, 2, 3, 4, 5, None]
    assert {k: spark.conf.get(k, None) for k in ON_DISK} == settings
    for part in Path(f"{tmp_path}/out").glob("part-*"):
        part.write_bytes(b"not to be read")
    put(spark, f"{tmp_path}/in", 9, [5, 6, None, 1])
    incremental.manifest(arriving(spark, f"{tmp_path}/in"), "id", f"{tmp_path}/out")
    new = [str(p) for p in Path(f"{tmp_path}/out").glob("part-*") if p.read_bytes() != b"not to be read"]
    assert [r.id for r in spark.read.parquet(*new).collect()] == [6]


def test_manifest_of_a_stream_that_was_stopped(spark, tmp_path):
    """A file that can't be read stops the stream in its third batch; started again, nothing is lost or doubled."""
    for k, ids in enumerate(([1, 2], [2, 3], [4], [1, 5])):
        put(spark, f"{tmp_path}/in", k, ids)
    bad = next(Path(f"{tmp_path}/in/k2").glob("part-*.parquet"))
    good = bad.read_bytes()
    bad.write_bytes(b"PAR1 is not enough")
    (bad.parent / f".{bad.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="(?i)stream"):
        incremental.manifest(arriving(spark, f"{tmp_path}/in"), "id", f"{tmp_path}/out", f"{tmp_path}/state")
    bad.write_bytes(good)
    incremental.manifest(arriving(spark, f"{tmp_path}/in"), "id", f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3, 4, 5]


def rows(spark, *ids):
    return spark.createDataFrame([(i, f"r{i}") for i in ids], "record_id long, name string")


def test_a_job_stopped_before_it_publishes_leaves_nothing(spark, tmp_path):
    table = Versions(spark, f"{tmp_path}/manifest")
    assert table.latest() == 0 and table.read(schema=rows(spark, 1).schema).count() == 0
    with pytest.raises(ValueError, match="no version"):
        table.read()
    table.append(rows(spark, 1, 2))
    table.stage(rows(spark, 3, 4))  # stopped here
    assert table.latest() == 1 and table.read().count() == 2 and len(table.abandoned()) == 1
    assert files.append_manifest(rows(spark, 2, 3, 3), table.path) == 2
    assert sorted(r.record_id for r in table.read().collect()) == [1, 2, 3]
    assert sorted(r.record_id for r in table.read(1).collect()) == [1, 2]
    wide = rows(spark, 7).withColumn("more", F.lit(1))
    table.append(wide)
    assert {r.record_id: r.more for r in table.read().collect()} == {1: None, 2: None, 3: None, 7: 1}
    assert table.compact() == 4 and sorted(r.record_id for r in table.read().collect()) == [1, 2, 3, 7] and table.read(1).count() == 2
    assert files.append_manifest(rows(spark, 7).limit(0), table.path) == 5 and table.read().count() == 4


def test_of_two_writers_of_one_version_one_is_first(spark, tmp_path):
    table = Versions(spark, f"{tmp_path}/manifest")
    table.append(rows(spark, 1))
    a, b = table.stage(rows(spark, 2)), table.stage(rows(spark, 2, 3))
    assert table.publish(1, a) == 2
    with pytest.raises(Conflict):
        table.publish(1, b)
    assert sorted(r.record_id for r in table.read().collect()) == [1, 2]
    assert not [p.name for p in Path(f"{tmp_path}/manifest/versions").iterdir() if "tmp" in p.name and not p.name.endswith(".crc")]

    calls = []

    def slow(held):
        calls.append(held.count())
        if len(calls) == 1:  # another writer comes between
            Versions(spark, table.path).append(rows(spark, 50))
        return rows(spark, 50, 60).join(held.select("record_id"), "record_id", "left_anti")

    table.append(slow)
    assert calls == [2, 3] and sorted(r.record_id for r in table.read().collect()) == [1, 2, 50, 60]


def test_writers_at_once(spark, tmp_path):
    path = f"{tmp_path}/manifest"
    jobs = [threading.Thread(target=files.append_manifest, args=(rows(spark, *range(k, k + 4)), path)) for k in range(5)]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    table = Versions(spark, path)
    assert sorted(r.record_id for r in table.read().collect()) == list(range(8)) and table.latest() == 5


@pytest.fixture(scope="module")
def images(tmp_path_factory):
    folder = tmp_path_factory.mktemp("images")
    for k in range(12):
        (folder / f"{'v' if k % 2 else 'w'}{k}.bmp").write_bytes(bitmap([k] * 40, 8))
    (folder / "broken.bmp").write_bytes(b"BM is not enough")
    (folder / "notes.txt").write_text("no image")
    (folder / "deeper").mkdir()
    (folder / "deeper" / "v99.bmp").write_bytes(bitmap([9] * 5 * 3, 5))
    return str(folder)


def test_images(spark, images):
    python.register(spark)
    read = spark.read.format("tessaria_images").option("partbytes", 600)
    got = {r.name: r for r in read.load(images).collect()}
    assert set(got) == {*(f"{'v' if k % 2 else 'w'}{k}.bmp" for k in range(12)), "v99.bmp"}
    assert all((r.width, r.height, r.size, r.total) == (8, 5, 120, 120 * k) for k in range(12) for r in [got[f"{'v' if k % 2 else 'w'}{k}.bmp"]])
    assert (got["v99.bmp"].width, got["v99.bmp"].height, got["v99.bmp"].total) == (5, 3, 405) and got["v99.bmp"].modified is not None
    assert read.load(images).rdd.getNumPartitions() > 3
    names = read.schema("bytes long, name string").load(images)  # no file is opened: the broken one is listed
    assert "broken.bmp" in {r.name for r in names.collect()} and names.columns == ["bytes", "name"]


def test_filters_reach_the_source(spark, images, tmp_path):
    python.register(spark)
    copy = shutil.copytree(images, f"{tmp_path}/images")
    for p in Path(copy).glob("w*.bmp"):
        p.unlink()
        p.symlink_to(f"{tmp_path}/nowhere")  # opening one of these would fail
    df = spark.read.format("tessaria_images").load(images).filter((F.col("name") == "v3.bmp") & (F.col("width") > 4))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the source has taken the filter on the name, so Spark makes only that on the width
    filters = [line for line in plan.splitlines() if "Filter (" in line]
    assert len(filters) == 1 and "width" in filters[0] and "v3.bmp" not in plan
    assert [r.total for r in df.collect()] == [360]
    assert spark.read.format("tessaria_images").load(images).filter(F.col("name").isin("v1.bmp", "w2.bmp")).count() == 2
    reader = python.ImageReader(T.StructType.fromDDL("name string, total long"), {"path": copy}, "*.bmp")
    reader.tests = [("prefix", "v")]
    opened = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert {r["name"] for r in opened} == {"v1.bmp", "v3.bmp", "v5.bmp", "v7.bmp", "v9.bmp", "v11.bmp", "v99.bmp"}


def test_annotations(spark, tmp_path):
    python.register(spark)
    folder = tmp_path / "coco"
    folder.mkdir()
    documents = [{"image": {"id": 1, "width": 5, "height": 6}, "annotations": [{"category": "é", "bbox": [1, 2, 3, 4]}, {"category": None}]}, {"image": {"id": 2}, "annotations": []}, {"annotations": [{"x": 1}]}]
    (folder / "a.json").write_text("\n".join(json.dumps(d) for d in documents) + "\n\n")
    (folder / "b.json").write_text(json.dumps({"image": {"id": 3}, "annotations": [{"category": "z"}]}))
    got = spark.read.format("tessaria_annotations").load(str(folder))
    assert sorted(((r.name, r.image_id, r.width, json.loads(r.annotation)) for r in got.collect()), key=str) == sorted([("a.json", 1, 5, {"category": "é", "bbox": [1, 2, 3, 4]}), ("a.json", 1, 5, {"category": None}), ("a.json", None, None, {"x": 1}), ("b.json", 3, None, {"category": "z"})], key=str)
    assert [r.image_id for r in got.filter("name = 'b.json'").collect()] == [3]


def test_listing(spark, images):
    import hashlib

    found = files.listing(spark, images, "v*.bmp")
    assert {r.name: r.length for r in found.collect()} == {f.name: f.stat().st_size for f in Path(images).rglob("v*.bmp")}
    assert "v3" not in found.filter("name = 'v3.bmp'")._jdf.queryExecution().executedPlan().toString() and found.filter("name = 'v3.bmp'").count() == 1
    sums = files.checksums(spark, images)
    assert {r.name: r.sha256 for r in sums.collect()} == {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in Path(images).rglob("*.*")}
    assert [r.sha256 for r in sums.filter(F.col("name").isin("notes.txt")).collect()] == [hashlib.sha256(b"no image").hexdigest()]
    assert files.listing(spark, images, "nothing*").count() == 0


def test_arrays_of_records_come_back_whole(spark, tmp_path):
    """More groups than tasks: each array has its own file, since a reader takes the first one of a file only."""
    rows = spark.range(0, 1000, 1, 3).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("name"))
    files.write_json_arrays(rows, f"{tmp_path}/many", per_file=20)
    back = files.read_json_array(spark, f"{tmp_path}/many", rows.schema).collect()
    assert sorted(back, key=lambda r: r.id) == sorted(rows.collect(), key=lambda r: r.id)
    assert all(len(json.loads(p.read_text())) <= 20 for p in Path(f"{tmp_path}/many").glob("part-*"))
    files.write_json_arrays(rows.limit(0), f"{tmp_path}/none")
    assert files.read_json_array(spark, f"{tmp_path}/none", rows.schema).count() == 0
