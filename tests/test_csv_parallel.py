"""Parallel multi-line CSV against the engine's own multi-line reader, for every size of split."""

import os
import random

import pytest

from loanflow import fixtures as fx
from loanflow.session import scratch_path
from loanflow.sources import files
from loanflow.sources.csv_records import TASKS_PER_SLOT, _lines, read_loans_csv_parallel

SCHEMA = "a string, b string, c string"


def write(path, name, data):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", newline="") as f:
        f.write(data)


def same(spark, path, split, schema=SCHEMA):
    got = sorted(map(repr, read_loans_csv_parallel(spark, path, schema, split).collect()))
    want = sorted(map(repr, files.read_loans_csv(spark, path, schema).collect()))
    assert got == want
    return got


def field(rng):
    return rng.choice(["", "plain", " x ", '""', '"say ""hi"""', '"a,b"', '"line\nfeed"', '"\n\n"', '"' + "long " * rng.randrange(1, 30) + '\nend"', "é"])


@pytest.mark.parametrize("split", [7, 64, 1000, 1 << 20])
def test_same_rows_for_every_split_size(spark, split):
    rng = random.Random(split)
    path = scratch_path(spark, "csvp")
    for n in range(3):
        lines = [",".join(field(rng) for _ in range(rng.choice([1, 2, 3, 3, 3, 4]))) for _ in range(40)]
        write(path, f"p{n}.csv", "\n".join(["a,b,c", *lines]) + rng.choice(["", "\n", "\n\n\n"]))
    same(spark, path, split)


def test_odd_files(spark):
    path = scratch_path(spark, "csvp")
    write(path, "empty.csv", "")
    write(path, "header.csv", "a,b,c\n")
    write(path, "quoted_header.csv", '"a\nx","b ""q""",c\n1,"2\n2",3\n')
    write(path, "blank.csv", "\n\na,b,c\n\n4,5\n\n")
    write(path, "one.csv", 'a,b,c\n"' + "x\n" * 400 + '",y,z')
    for split in (5, 50, 100_000):
        assert len(same(spark, path, split)) == 3


def test_carriage_returns(spark):
    path = scratch_path(spark, "csvp")
    write(path, "dos.csv", 'a,b,c\r\n1,"two\r\nlines",3\r\n\r\n4,5,6\r\n')
    for split in (6, 1000):
        same(spark, path, split)


def test_one_file_is_read_by_several_tasks(spark, sf_small):
    path = scratch_path(spark, "csvp")
    files.write_loans_csv(fx.loan_bronze(spark, sf_small).coalesce(1), path)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    split = 1 << 17
    assert _lines(spark, path, split).rdd.getNumPartitions() >= 8
    got, want = read_loans_csv_parallel(spark, path, split_bytes=split), files.read_loans_csv(spark, path)
    assert got.schema == want.schema and got.count() == want.count() == 1500
    assert got.exceptAll(want).count() == 0


def test_small_splits_share_tasks(spark, sf_mid):
    """Splits of 1 KB give no more staged files than the cluster has slots for four tasks each, and the same records."""
    import glob

    path = scratch_path(spark, "csv")
    rows = fx.loan_bronze(spark, sf_mid).limit(400)
    files.write_loans_csv(rows, path)
    lines = _lines(spark, path, 1 << 10)
    assert lines.select("file", "start").distinct().count() > 100
    most = TASKS_PER_SLOT * spark.sparkContext.defaultParallelism
    assert lines.rdd.getNumPartitions() <= most
    got = read_loans_csv_parallel(spark, path, split_bytes=1 << 10)
    want = files.read_loans_csv(spark, path)
    assert got.count() == want.count() == 400 and got.exceptAll(want).count() == 0
    staged = glob.glob(f"{got.inputFiles()[0].removeprefix('file://').rpartition('/kind=')[0]}/kind=0/*.parquet")
    assert len(staged) <= most


def test_records_are_not_written_again(spark, sf_mid):
    """Only the pieces at the cuts are staged: a small part of the text, however it is cut; the session is the caller's."""
    from loanflow.session import checkpoint_root

    path, root = scratch_path(spark, "csv"), checkpoint_root(spark).removeprefix("file:") + "/loanflow"

    def size(top):
        return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(top) for f in names)

    files.write_loans_csv(fx.loan_bronze(spark, sf_mid), path, rows_per_file=5000)
    before, text = size(root), size(path.removeprefix("file:"))
    got = read_loans_csv_parallel(spark, path, split_bytes=1 << 18)
    assert size(root) - before < text / 20
    assert got.sparkSession is spark or got.sparkSession._jsparkSession.equals(spark._jsparkSession)
    want = files.read_loans_csv(spark, path)
    assert got.count() == want.count() == 15_000 and got.exceptAll(want).count() == 0
