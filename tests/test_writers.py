import os

import pytest
from pyspark.ml.linalg import Vectors

from quern import session as quern_session
from quern.session import drop_stages, fill_cores, measured_bytes, shared_folder, stage, tasks_for
from quern.sources import readers, writers


def lines(spark, path):
    return sorted(r[0] for r in spark.read.text(path).collect())


def test_key_values(spark, tmp_path):
    df = spark.createDataFrame([("Bye", 1), ("World", 2)], "word string, cnt bigint")
    path = str(tmp_path / "kv")
    writers.write_key_values(df, path, "word", "cnt")
    assert lines(spark, path) == ["Bye\t1", "World\t2"]
    assert sorted(map(tuple, readers.read_key_values(spark, path).collect())) == [("Bye", "1"), ("World", "2")]


def test_scores_in_both_layouts(spark, tmp_path):
    df = spark.createDataFrame([("u1", "c", 2.0)], "user_id string, item_id string, score double")
    writers.write_scores(df, str(tmp_path / "csv"))
    writers.write_scores(df, str(tmp_path / "tab"), layout="tab")
    assert lines(spark, str(tmp_path / "csv")) == ["u1,c,2.0"]
    assert lines(spark, str(tmp_path / "tab")) == ["u1\tc,2.0"]
    with pytest.raises(ValueError):
        writers.write_scores(df, str(tmp_path / "x"), layout="json")


def test_projection_in_both_layouts_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.dense([1.5, -2.0]), 3)], ["projection", "cluster"])
    path = str(tmp_path / "p")
    writers.write_projection(df, path)
    assert lines(spark, path) == ["1.5,-2.0,3"]
    writers.write_projection(df, path, layout="bracketed")
    assert lines(spark, path) == ['"[1.5,-2.0]",3']
    with pytest.raises(ValueError):
        writers.write_projection(df, path, layout="png")


def test_texts(spark, tmp_path, texts):
    writers.write_texts(texts("one", "two"), str(tmp_path / "t"), "value")
    assert lines(spark, str(tmp_path / "t")) == ["one", "two"]


def test_stage_round_trip_lies_in_the_shared_folder(spark):
    df = spark.createDataFrame([(1, "a", Vectors.dense([1.0]))], ["n", "s", "v"])
    staged = stage(df, "test")
    assert staged.collect() == df.collect()
    assert all(shared_folder(spark) in f for f in staged.inputFiles())


def test_measured_bytes_follow_the_strings(spark):
    short = spark.createDataFrame([("a",)] * 10, "s string")
    long = spark.createDataFrame([("a" * 1000,)] * 10, "s string")
    assert measured_bytes(long) - measured_bytes(short) == 9990
    assert measured_bytes(short.where("s = 'b'")) == 0


class _Conf:
    def __init__(self, **settings):
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


class _Session:
    class sparkContext:
        applicationId = "app-1"

    def __init__(self, settings):
        self.conf = _Conf(**settings)


def test_shared_folder_is_the_clusters_own_and_never_a_machine_local_one():
    folder = _Session({"spark.checkpoint.dir": "s3://bucket/ck/", "spark.master": "yarn"})
    assert shared_folder(folder) == "s3://bucket/ck"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session({"spark.master": "yarn"}))
    local = _Session({"spark.master": "local[2]"})
    assert shared_folder(local) == shared_folder(local) != quern_session.shared_folder(folder)


def test_task_counts_are_bounded(spark):
    cores = spark.sparkContext.defaultParallelism
    assert tasks_for(spark, 0) == cores
    assert tasks_for(spark, 10 * cores, per_task=1) == 10 * cores
    assert tasks_for(spark, 1e18) == quern_session.MOST_TASKS


def test_only_narrow_scans_are_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert fill_cores(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    assert fill_cores(spark.range(100, numPartitions=65)).rdd.getNumPartitions() == 65


def test_no_stage_table_of_a_run_is_left(spark):
    path = stage(spark.range(3), "left").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    drop_stages(spark)
    assert not os.path.exists(path)
