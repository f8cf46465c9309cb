"""Session building, shared stage tables and the size checks the operators use."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Rows one task should produce when an operator multiplies its input.
ROWS_PER_TASK = 5_000_000
#: Most tasks such a step asks for, and the session setting that replaces the number.
MOST_TASKS = 20_000
MOST_TASKS_SETTING = "spark.quern.most.tasks"

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(
    app: str = "quern", master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Session with the settings the jobs rely on; without `master` the launcher chooses it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for stage tables: the cluster's `spark.checkpoint.dir`.

    A machine-local folder is made only for a local master, where it is shared by definition.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="quern-")
    return _LOCAL_FOLDERS[app]


def _own_folder(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), f"quern-{spark.sparkContext.applicationId}")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(_own_folder(spark), f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a parquet table in the shared folder and read it back (K4).

    Used where several later jobs read one result: it is computed once, its lineage is cut, and a
    lost executor costs a re-read instead of a re-run. Inside `resumable` a table that an earlier driver
    finished is read instead.
    """
    run = _RUNS.get(df.sparkSession.sparkContext.applicationId)
    if run is None:
        path = new_path(df.sparkSession, label)
        df.write.parquet(path)
    else:
        path = run.path_of(df, label)
        if not run.finished(path):
            df.write.mode("overwrite").parquet(path)  # what a killed driver left half done goes
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Run:
    """The stage tables of one named run: the same table has the same path in every driver."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, os.path.join(shared_folder(spark), f"quern-run-{name}")
        self.times: dict[str, int] = {}

    def path_of(self, df: DataFrame, label: str) -> str:
        """A path named by digests of the plan, of the files it reads and of this package; equal ones are numbered."""
        plan = df._jdf.queryExecution().analyzed().canonicalized().treeString()
        # Stage tables before this one stand in the plan by their paths, and so by their digests.
        facts = [plan, df.schema.json(), *(self._file(f) for f in sorted(df.inputFiles())), _package_digest()]
        digest = hashlib.sha256("\n".join(facts).encode()).hexdigest()[:32]
        self.times[digest] = self.times.get(digest, 0) + 1
        return os.path.join(self.folder, f"{label}-{digest}-{self.times[digest]}")

    def _file(self, name: str) -> str:
        if name.startswith(self.folder) or f"/{os.path.basename(self.folder)}/" in name:
            return name.rsplit("/", 2)[-2]  # of a stage table, whose name says what it holds
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(path)
        return f"{name} {status.getLen()} {status.getModificationTime()}"

    def finished(self, path: str) -> bool:
        """Spark writes the marker when all of a table is there."""
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)

    def remove(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


_RUNS: dict[str, _Run] = {}


@contextmanager
def resumable(spark: SparkSession, name: str) -> Iterator[None]:
    """A run whose stage tables outlive a killed driver (K4).

    Stage tables made inside are named by what they hold: the plan, the files it reads with their sizes and times, and
    the package's code. A driver that runs the same work again under the same name reads those that are finished and makes
    the others. When the work inside ends well, all of the run's tables go; so write its results elsewhere before that.
    After an error they stay for the next attempt. One run at a time in an application; plans over data that the driver
    holds are told apart by their schema and order only.
    """
    app = spark.sparkContext.applicationId
    if app in _RUNS:
        raise ValueError("a resumable run is going on already")
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
        raise ValueError("a run's name is made of letters, digits, '.', '_' and '-'")
    run = _RUNS[app] = _Run(spark, name)
    try:
        yield
        run.remove()
    finally:
        del _RUNS[app]


@cache
def _package_digest() -> str:
    """Digest of the package's source files, as plans don't show the code of Python functions."""
    root = os.path.dirname(os.path.abspath(__file__))
    digest = hashlib.sha256()
    for folder, _, names in sorted(os.walk(root)):
        for name in sorted(n for n in names if n.endswith(".py")):
            with open(os.path.join(folder, name), "rb") as file:
                digest.update(name.encode() + file.read())
    return digest.hexdigest()


def drop_stages(spark: SparkSession) -> None:
    """Remove every stage table of this application.

    For the end of a run, when its results have been written elsewhere: lazy results read stage tables.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers of a local session find the package where the driver found it; a cluster is sent it by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    found = environment.get("PYTHONPATH", "")
    if root not in found.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, found]))


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory size of a row: a fixed part per column and the real string lengths."""
    width = F.lit(32 + 16 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return width.cast("long")


def measured_bytes(df: DataFrame) -> int:
    """In-memory size estimate of a whole DataFrame (one small aggregate)."""
    return int(df.agg(F.sum(row_bytes(df))).first()[0] or 0)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the measured size allows it; otherwise leave the join to Catalyst."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def tasks_for(spark: SparkSession, rows: float, per_task: int = ROWS_PER_TASK) -> int:
    """Partition count for a step that will produce `rows` rows: never fewer than the cores.

    Beyond `spark.quern.most.tasks` tasks (20,000 unless set) tasks grow instead.
    """
    cores = spark.sparkContext.defaultParallelism
    most = int(spark.conf.get(MOST_TASKS_SETTING, str(MOST_TASKS)))
    return int(max(cores, min(-(-rows // per_task), most)))


@contextmanager
def shuffle_tasks(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Let the shuffles of jobs that run inside have at least `tasks` partitions.

    For aggregations whose size was measured: unlike `repartition`, it keeps their map-side combine.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(max(tasks, int(before))))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def planned_with(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Plan and run the jobs inside with these session settings, and put back what was set before."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def fill_cores(scan: DataFrame) -> DataFrame:
    """Spread a file scan that has fewer splits than the session has cores.

    Parsing and tokenising are bound by the processor, so a handful of splits would leave cores
    idle. Inputs of more than 64 splits are left alone: moving them would cost more than it gains.
    Only for plain scans, as counting the splits of anything else may run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan.rdd.getNumPartitions()
    return scan.repartition(cores) if splits < cores and splits <= 64 else scan
