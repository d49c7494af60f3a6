"""Guard of a run's outputs: real locations, before any write."""

import json
import os

import pytest

from abode.plans import locations
from abode.plans.batch_run import RunConfig, read_mark, write_run
from abode.sinks import write_snapshot
from abode.sources import read_snapshot
from abode.streaming.file_ingest import IngestConfig, ingest_available, version_path
from tests.helpers import listing_frame, listing_row
from tests.test_sources_and_runs import GOOD, _write_lines

CFG = RunConfig(delete_seed=1, update_seed=2, delete_pct="0.02", update_pct="0.02")


@pytest.fixture()
def base(spark, scratch):
    folder = scratch("guard").replace("file:", "")
    write_snapshot(listing_frame(spark, [listing_row(i, f"{i} Main, Springfield") for i in range(1, 41)]), f"{folder}/v1")
    _write_lines(f"{folder}/batch", [json.dumps({**GOOD, "street_number": 900 + i, "source_id": i}) for i in range(10)])
    return folder


def files(folder):
    return sorted((os.path.join(d, f), os.path.getmtime(os.path.join(d, f))) for d, _, names in os.walk(folder) for f in names)


@pytest.mark.parametrize(
    "out, archive",
    [
        ("v2", "v1"),  # the archive on the snapshot that is read
        ("v2", "v2"),  # both outputs in one place
        ("v2", "v2/archive"),  # one inside the other
        ("v2/x", "v2"),
        ("v2", "v1/archive"),
        ("v1/v2", None),
        ("v1", None),
        ("v2", "batch"),
        ("v2", "v1.id_mark"),
        ("v2", "v2.id_mark"),
        ("v2", "."),  # holds everything
        ("link", None),  # a link to v1
        ("v2", "link/archive"),
        ("v2", "../{name}/v1"),
    ],
)
def test_overlapping_paths_raise_before_any_write(spark, base, out, archive):
    os.symlink(f"{base}/v1", f"{base}/link")
    before = files(base)
    name = os.path.basename(base)
    archive = archive and f"{base}/{archive.format(name=name)}"
    for form in ("{}", "file:{}", "file://{}"):
        with pytest.raises(ValueError):
            write_run(spark, f"{base}/v1", f"{base}/batch", form.format(f"{base}/{out}"), CFG, mode="overwrite", archive_out=archive)
    assert files(base) == before and read_snapshot(spark, f"{base}/v1").count() == 40


def test_existing_outputs_raise_before_any_write(spark, base):
    write_run(spark, f"{base}/v1", f"{base}/batch", f"{base}/v2", CFG, archive_out=f"{base}/a2")
    before = files(base)
    for out, archive in (("v2", "a3"), ("v3", "a2")):
        with pytest.raises(FileExistsError):
            write_run(spark, f"{base}/v1", f"{base}/batch", f"{base}/{out}", CFG, archive_out=f"{base}/{archive}")
    assert files(base) == before
    # a repeated run may overwrite its own outputs
    assert write_run(spark, f"{base}/v1", f"{base}/batch", f"{base}/v2", CFG, mode="overwrite", archive_out=f"{base}/a2") == 50
    assert read_mark(spark, f"{base}/v2") == 50


def test_neighbours_are_no_overlap(spark, base):
    real = locations.real_location(spark, f"{base}/v1")
    assert real == "file://" + os.path.realpath(f"{base}/v1")
    assert locations.real_location(spark, f"{base}/no/such//x/") == "file://" + os.path.realpath(base) + "/no/such/x"
    assert locations.real_location(spark, f"{base}/ba*/part-{{0,1}}") == "file://" + os.path.realpath(base)
    assert not locations.overlap(real, real + "0") and locations.overlap(real, real + "/x")


def test_default_file_system_and_mounts(spark, base):
    """A path without its scheme, and one by a mount, are where the file system says."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.abode.link./listings", f"file://{base}")
    assert locations.real_location(spark, "viewfs://abode/listings/v1") == locations.real_location(spark, f"{base}/v1")
    with pytest.raises(ValueError):
        locations.check_outputs(spark, {"in": f"{base}/v1"}, {"out": "viewfs://abode/listings/v1"})
    keep = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://abode/")
    try:
        with pytest.raises(ValueError):
            locations.check_outputs(spark, {"in": "/listings/v1"}, {"out": f"file:{base}/v1/x"})
    finally:
        conf.set("fs.defaultFS", keep)


def test_recreated_checkpoint_is_refused(spark, scratch):
    """A new stream at the old checkpoint's place starts at epoch 0 again; the versions stay."""
    folder = scratch("recreated").replace("file:", "")
    landing = _write_lines(f"{folder}/landing", [json.dumps({**GOOD, "street_number": 700 + i, "source_id": i}) for i in range(9)])
    cfg = IngestConfig(landing, f"{folder}/out", f"{folder}/ckpt", delete_pct="0.02", update_pct="0.02")
    ingest_available(spark, cfg)
    before = files(f"{folder}/out")
    os.rename(f"{folder}/ckpt", f"{folder}/ckpt_old")
    with pytest.raises(Exception, match="another checkpoint"):
        ingest_available(spark, cfg)
    assert files(f"{folder}/out") == before
    os.rename(f"{folder}/ckpt", f"{folder}/ckpt_new")
    os.rename(f"{folder}/ckpt_old", f"{folder}/ckpt")
    # the old stream goes on, also by another spelling of its checkpoint
    with open(f"{landing}/part-1.json", "w") as later:
        later.write(json.dumps({**GOOD, "street_number": 990, "source_id": 90}) + "\n")
    ingest_available(spark, IngestConfig(landing, f"{folder}/out", f"file:{folder}/ckpt", delete_pct="0.02", update_pct="0.02"))
    assert read_snapshot(spark, version_path(f"{folder}/out", 1)).count() == 10


def test_stream_outputs_are_guarded(spark, scratch):
    folder = scratch("guarded").replace("file:", "")
    landing = _write_lines(f"{folder}/out/v=0", [json.dumps(GOOD)])
    before = files(folder)
    with pytest.raises(Exception, match="overlaps|must write new"):
        ingest_available(spark, IngestConfig(landing, f"{folder}/out", f"{folder}/ckpt", delete_pct="0.02", update_pct="0.02"))
    assert [f for f in files(folder) if "ckpt" not in f[0]] == before
