"""Tables that cut lineage, in the folder the cluster shares for that purpose."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: More partitions than any table has, so that ``compiled_apart`` joins none.
MANY_PARTITIONS = 1_000_000

_local_folders: dict[str, str] = {}
_made: ContextVar[list[str] | None] = ContextVar("paths of the open scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a scratch folder only on a local master without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="lullcast-")
    return _local_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside, here or by ``side_by_side``, are deleted at the end, also after
    a failure."""
    made: list[str] = []
    before = _made.set(made)
    try:
        yield
    finally:
        _made.reset(before)
        for path in made:
            _delete(spark, path)


def side_by_side(spark: SparkSession, threads: int, work: Callable, items: Sequence) -> list:
    """``work`` on every item, jobs of up to ``threads`` items at a time. Tables they write
    belong to the scratch that is open here."""
    jobs = [(copy_context(), item) for item in items]

    @inheritable_thread_target(spark)
    def run(job: tuple):
        context, item = job
        return context.run(work, item)

    with ThreadPool(max(1, min(threads, len(jobs)))) as pool:
        return pool.map(run, jobs)


def written(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, as a written table; all other tables written on the way are
    deleted, and after a failure this one, too. It belongs to the enclosing ``scratch``, if
    there is one, else to the caller (``discard``)."""
    path = new_path(spark, label)
    try:
        with scratch(spark):
            made = make()
            made.write.parquet(path)
    except BaseException:
        _delete(spark, path)
        raise
    return spark.read.schema(made.schema).parquet(path).select(*(f"`{c}`" for c in made.columns))


def _delete(spark: SparkSession, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative MLlib fits cut their own lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def compiled_apart(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions. Spark compiles what follows as a method of its own:
    together, many columns make one that is too long for the JIT compiler."""
    return df.coalesce(MANY_PARTITIONS)


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later jobs neither recompute it
    nor depend on an executor's cache."""
    path = new_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def materialize_by_series(
    df: DataFrame, label: str, keys: list[str], date: str, buckets: int | None = None
) -> DataFrame:
    """Write ``df`` bucketed by series, so that no later per-series job shuffles it.

    A bucket is read by one task whatever its size: give as many ``buckets`` as keep
    each below some hundred megabytes. By default there are four per core.
    Bucketing needs a catalogue entry, named after the folder; ``discard`` removes it.
    """
    if not keys:
        return materialize(df, label)
    path = new_path(df.sparkSession, label)
    n = buckets or 4 * df.sparkSession.sparkContext.defaultParallelism
    writer = df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys, date)
    writer.option("path", path).saveAsTable(_table_name(path), format="parquet")
    return df.sparkSession.table(_table_name(path))


def _table_name(path: str) -> str:
    return "lullcast_" + path.rsplit("/", 1)[-1].replace("-", "_")


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that ``materialize`` and its like have written, files and catalogue
    entries; nothing outside the shared folder."""
    shared = shared_folder(spark)
    bare = shared.removeprefix("file:").lstrip("/")
    files = [f for df in tables for f in df.inputFiles() if f"{bare}/" in f]
    for name in {f.split(f"{bare}/", 1)[1].split("/", 1)[0] for f in files}:
        if re.fullmatch(r"[\w-]+", name):
            _delete(spark, f"{shared}/{name}")
