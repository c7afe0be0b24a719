"""Tables replaced as a whole: readers see one version, and a refresh that dies changes nothing."""

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from medallion.sources import versions
from medallion.sources.tables import read_table, refresh_view, table_exists, write_append, write_overwrite

REPO = str(Path(__file__).resolve().parent.parent)

# Writes the first half of the rows, tells so and hangs.
HANGING = """
import sys, time
from pathlib import Path
from pyspark.sql import functions as F
from medallion.session import build_session
from medallion.sources.tables import write_overwrite

begun = sys.argv[2]

def slow(batches):
    for batch in batches:
        yield batch
        Path(begun).touch()
        time.sleep(600)

spark = build_session("refresh", "local[2]", spark__sql__execution__arrow__maxRecordsPerBatch="10")
write_overwrite(spark.range(1000, 2000, 1, 1).mapInArrow(slow, "id long"), sys.argv[1])
"""


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_readers_hold_their_version(spark, tmp_path):
    target = str(tmp_path / "t")
    write_overwrite(spark.range(3), target)
    held = read_table(spark, target)
    write_overwrite(spark.range(5), target)
    assert ids(held) == [0, 1, 2] and ids(read_table(spark, target)) == [0, 1, 2, 3, 4]


def test_a_table_may_be_rewritten_from_itself(spark, tmp_path):
    target = str(tmp_path / "t")
    write_overwrite(spark.range(3), target)
    for _ in range(4):
        refresh_view(spark, target, lambda s: read_table(s, target).select((F.col("id") * 2).alias("id")))
    assert ids(read_table(spark, target)) == [0, 16, 32]
    assert len(versions.published(spark, target)) == versions.KEEP
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]) == versions.KEEP


def test_failed_refresh_leaves_the_old_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    write_overwrite(spark.range(3), target)
    with pytest.raises(Exception, match="no more"):
        write_overwrite(spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("no more"))).otherwise(F.col("id")).alias("id")), target)
    assert ids(read_table(spark, target)) == [0, 1, 2]


def test_first_refresh_that_fails_makes_no_table(spark, tmp_path):
    target = str(tmp_path / "t")
    with pytest.raises(Exception, match="no more"):
        write_overwrite(spark.range(2).select(F.raise_error(F.lit("no more")).alias("id")), target)
    assert not table_exists(spark, target)
    write_overwrite(spark.range(1), target)
    assert table_exists(spark, target) and ids(read_table(spark, target)) == [0]


def test_files_without_versions_can_be_read_and_replaced(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.range(2).write.parquet(target)
    write_append(spark.range(2, 3), target)
    assert table_exists(spark, target) and ids(read_table(spark, target)) == [0, 1, 2]
    write_overwrite(spark.range(7, 8), target)
    write_append(spark.range(8, 9), target)
    assert ids(read_table(spark, target)) == [7, 8]


def test_refresh_killed_half_way(spark, tmp_path):
    """The process is killed while it writes: readers go on with the old rows, and the next refresh works."""
    target, begun = str(tmp_path / "t"), tmp_path / "begun"
    write_overwrite(spark.range(3), target)
    env = os.environ | {"PYTHONPATH": REPO, "SPARK_LOCAL_DIRS": str(tmp_path)}
    job = subprocess.Popen([sys.executable, "-c", HANGING, target, str(begun)], env=env, cwd=REPO, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, start_new_session=True)
    for _ in range(600):
        if begun.exists() or job.poll() is not None:
            break
        time.sleep(0.1)
    assert begun.exists()
    os.killpg(job.pid, 9)
    job.wait()
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]) == 2
    assert ids(read_table(spark, target)) == [0, 1, 2]
    for n in (4, 5, 6):
        write_overwrite(spark.range(n), target)
    assert ids(read_table(spark, target)) == [0, 1, 2, 3, 4, 5]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]) == versions.KEEP
