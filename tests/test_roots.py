from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from quayside.operators import bulk
from quayside.operators.land import arrow_uri, below, land_files, shared_root
from quayside.session import shared_dir


@pytest.mark.parametrize("given, mapped", [
    ("s3a://b/x", "s3://b/x"), ("s3n://b/x", "s3://b/x"), ("s3://b/x", "s3://b/x"), ("gs://b/x", "gs://b/x"),
    ("hdfs://n:8020/x", "hdfs://n:8020/x"), ("abfss://c@a/x", "abfss://c@a/x"), ("file:/x", "file:///x"), ("file:///x", "file:///x"),
])
def test_schemes(given, mapped):
    assert arrow_uri(given) == mapped


def test_unknown_scheme_fails_before_the_job(spark):
    with pytest.raises(ValueError, match="ftp"):
        shared_root(spark, "ftp://host/x")
    assert shared_root(spark, "/tmp/x") == "file:///tmp/x"


@pytest.mark.parametrize("path", ["../x", "/x", "a//b", "a/./b", "a/../../b"])
def test_paths_stay_below_the_root(path):
    with pytest.raises(ValueError, match="below"):
        below("/root", path, "name")


def frames(spark, path):
    return spark.createDataFrame(
        [("t", 0, path, 0, 0, "n", 0, 0, 1, True, bytearray(b"x"), False, "raw", ["old"])],
        "topic string, partition int, path string, rotation long, file_no long, name string, start_offset long, frame long, "
        "records long, last boolean, content binary, sealed boolean, framing string, siblings array<string>",
    )


def test_buckets_have_roots_of_their_own(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    for path in ("isolated/tenant", "tenant"):
        land_files(frames(spark, path), one, shared_dir(spark, "m"), "overwrite", roots={"isolated": two})
    assert os.listdir(f"{two}/tenant") == ["n"] and os.listdir(f"{one}/tenant") == ["n"]


def test_a_file_replaces_its_other_form(spark, tmp_path):
    os.makedirs(tmp_path / "p")
    (tmp_path / "p" / "old").write_text("stale")
    land_files(frames(spark, "p"), str(tmp_path), shared_dir(spark, "m"), "overwrite")
    assert os.listdir(tmp_path / "p") == ["n"]


def test_listing_leaves_out_only_what_is_ours(spark, tmp_path):
    for name in ("_dead_letter/a.json", ".hidden/b.json", "_x.json", "c/d.json", "_manifest/part-0", "c/.d.json." + "0" * 32):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    listed = {os.path.relpath(r["file"].removeprefix("file:"), tmp_path) for r in bulk.list_files(spark, str(tmp_path)).collect()}
    assert listed == {"_dead_letter/a.json", ".hidden/b.json", "_x.json", "c/d.json"}


def on_a_cluster(spark, **settings):
    context = SimpleNamespace(master="spark://host:7077", _jsc=spark.sparkContext._jsc)
    return SimpleNamespace(sparkContext=context, conf=settings, _jvm=spark._jvm)


def test_folders_that_a_cluster_shares_need_no_scheme(spark):
    cluster = on_a_cluster(spark, **{"spark.checkpoint.dir": "file:///shared/kept/", "spark.sql.warehouse.dir": "/tables"})
    assert shared_root(cluster, "/shared/kept/x") == "file:///shared/kept/x"
    assert shared_root(cluster, "/tables/x/y") == "file:///tables/x/y"
    for other in ("/shared/kept-not", "/tmp/x", "/shared/kept/../x"):
        with pytest.raises(ValueError, match="own disk"):
            shared_root(cluster, other)
    with pytest.raises(ValueError, match="own disk"):
        shared_root(on_a_cluster(spark), "/shared/kept/x")


def test_a_mounted_folder_is_written_where_it_lies(spark, tmp_path, ring):
    (tmp_path / "real").mkdir()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.dock.link./in", f"file://{tmp_path}/real")
    land_files(frames(spark, "p"), "viewfs://dock/in/new/root", shared_dir(spark, "m"), "overwrite")
    assert (tmp_path / "real/new/root/p/n").read_bytes() == b"x"
    sealed = bulk.seal_folder(spark, "viewfs://dock/in/new/root", "viewfs://dock/in/sealed", ring, "keys/seal-a")
    assert [(r["path"], r["name"]) for r in sealed.collect()] == [("p", "n.pgp")]
    for armor in (False, True):
        out = f"viewfs://dock/in/out-{armor}"
        bulk.seal_folder(spark, "viewfs://dock/in/new/root", f"{out}-sealed", ring, "keys/seal-a", armor)
        bulk.unseal_folder(spark, f"{out}-sealed", out, ring, "keys/seal-a", armor)
        assert (tmp_path / f"real/out-{armor}/p/n").read_bytes() == b"x"
