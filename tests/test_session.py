import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from quern import plans
from quern import session as S

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def tables(spark, name):
    folder = os.path.join(S.shared_folder(spark).removeprefix("file:"), f"quern-run-{name}")
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


@pytest.fixture
def ratings(spark, tmp_path):
    rows = [(f"u{n % 7}", f"i{n % 5}", n % 9 / 2) for n in range(60)]
    spark.createDataFrame(rows, "user_id string, item_id string, rating double").write.parquet(str(tmp_path / "ratings"))
    return str(tmp_path / "ratings")


def test_a_run_that_failed_is_resumed(spark, ratings):
    wanted = sorted(map(tuple, plans.recommend_scores(spark.read.parquet(ratings)).collect()))
    with pytest.raises(RuntimeError), S.resumable(spark, "again"):
        plans.recommend_scores(spark.read.parquet(ratings)).collect()
        made = tables(spark, "again")
        raise RuntimeError("killed")
    assert made and tables(spark, "again") == made
    folder = os.path.join(S.shared_folder(spark).removeprefix("file:"), "quern-run-again")
    before = {t: os.path.getmtime(os.path.join(folder, t, "_SUCCESS")) for t in made}
    os.remove(os.path.join(folder, made[0], "_SUCCESS"))  # this one was not finished
    with S.resumable(spark, "again"):
        found = sorted(map(tuple, plans.recommend_scores(spark.read.parquet(ratings)).collect()))
        after = {t: os.path.getmtime(os.path.join(folder, t, "_SUCCESS")) for t in tables(spark, "again")}
    assert found == wanted
    assert after.keys() == before.keys()
    assert [t for t in made if after[t] != before[t]] == [made[0]]
    assert tables(spark, "again") == []


def test_changed_inputs_and_plans_are_made_anew(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(5).write.parquet(path)
    with pytest.raises(RuntimeError), S.resumable(spark, "changed"):
        assert S.stage(spark.read.parquet(path), "t").count() == 5
        raise RuntimeError
    spark.range(9).write.mode("overwrite").parquet(path)
    with S.resumable(spark, "changed"):
        assert S.stage(spark.read.parquet(path), "t").count() == 9
        assert S.stage(spark.read.parquet(path).where(F.col("id") > 3), "t").count() == 5
        assert S.stage(spark.read.parquet(path).where(F.col("id") > 4), "t").count() == 4
    assert tables(spark, "changed") == []


def test_equal_tables_of_a_run_stay_apart(spark):
    with S.resumable(spark, "equal"):
        one, two = (S.stage(spark.range(3).withColumn("r", F.rand()), "t") for _ in range(2))
        assert len(tables(spark, "equal")) == 2 and one.count() == two.count() == 3


def test_one_run_at_a_time(spark):
    with S.resumable(spark, "one"):
        with pytest.raises(ValueError), S.resumable(spark, "two"):
            pass
    with pytest.raises(ValueError), S.resumable(spark, "../x"):
        pass


def test_another_driver_reads_what_a_killed_one_finished(tmp_path):
    """Two drivers, the first of which is killed after its first stage table."""
    code = textwrap.dedent(
        f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from quern import session as S
        spark = S.build_session("k", "local[2]", {{"spark.checkpoint.dir": sys.argv[1], "spark.ui.enabled": "false"}})
        with S.resumable(spark, "shared"):
            first = S.stage(spark.range(1000).selectExpr("id", "id % 7 AS k"), "first")
            if sys.argv[2] == "kill":
                os._exit(3)
            second = S.stage(first.groupBy("k").count(), "second")
            jobs = len(os.listdir(os.path.join(sys.argv[1], "quern-run-shared")))
            print("rows", second.count(), jobs, os.path.getmtime(next(
                os.path.join(sys.argv[1], "quern-run-shared", n, "_SUCCESS")
                for n in os.listdir(os.path.join(sys.argv[1], "quern-run-shared")) if n.startswith("first"))))
        print("left", os.path.exists(os.path.join(sys.argv[1], "quern-run-shared")))
        """
    )
    run = lambda how: subprocess.run([sys.executable, "-c", code, str(tmp_path), how], capture_output=True, text=True, timeout=300)
    assert run("kill").returncode == 3
    folder = tmp_path / "quern-run-shared"
    (made,) = folder.iterdir()
    time = os.path.getmtime(made / "_SUCCESS")
    out = run("on").stdout.splitlines()
    assert f"rows 7 2 {time}" in out and "left False" in out
