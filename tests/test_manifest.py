"""Copy-on-write replacement: what is rewritten, what a crash leaves behind."""
import os

import pytest
from pyspark.sql import functions as F

from topiary.sources import manifest as MF
from topiary.sources.store import replace_by_key


def stamps(spark, root):
    return {f: os.stat(MF._plain(f)).st_mtime_ns for f in MF.current(spark, root)[1]}


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def table(spark, tmp_path):
    root = str(tmp_path / "t")
    base = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("content"))
    MF.create(base.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id"), root)
    return root, base


def test_only_files_with_a_hit_are_rewritten(spark, table):
    root, base = table
    before = stamps(spark, root)
    upd = spark.createDataFrame([(3, "new"), (3, "newer"), (1000, "phantom")], "doc_id long, content string")
    assert len(before) == 5 and MF.replace(root, upd, "doc_id") == 1
    after = stamps(spark, root)
    assert len([f for f in before if after.get(f) == before[f]]) == 4 and len(after) == 5
    assert rows(MF.read(spark, root)) == rows(replace_by_key(base, upd, "doc_id"))
    assert MF.replace(root, upd.filter("doc_id = 1000"), "doc_id") == 0 and MF.current(spark, root)[0] == 2


def test_a_crash_before_the_manifest_changes_nothing(spark, table, monkeypatch):
    root, base = table
    before = stamps(spark, root)

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(MF, "_commit", dies)
        with pytest.raises(RuntimeError):
            MF.replace(root, base.withColumn("content", F.lit("x")), "doc_id")
    assert stamps(spark, root) == before and rows(MF.read(spark, root)) == rows(base)
    assert MF.replace(root, base.withColumn("content", F.lit("x")), "doc_id") == 5
    assert MF.read(spark, root).filter("content = 'x'").count() == 100


def test_two_writers_from_one_version(spark, table):
    root, base = table
    version, files = MF.current(spark, root)
    MF._commit(spark, root, version + 1, files)
    with pytest.raises(Exception, match="(?i)exist"):
        MF._commit(spark, root, version + 1, files)


def test_no_table(spark, tmp_path):
    assert MF.current(spark, str(tmp_path / "none")) == (0, [])
    assert MF.replace(str(tmp_path / "none"), spark.createDataFrame([(1, "a")], "doc_id long, content string"), "doc_id") == 0
    with pytest.raises(FileNotFoundError):
        MF.read(spark, str(tmp_path / "none"))
