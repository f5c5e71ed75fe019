"""Work tables in the folder that the cluster shares."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is used, and only for a local master:
    on a cluster a machine-local folder would lose data, so that raises.
    """
    path = spark.sparkContext.getConf().get(_KEY) or spark.conf.get(_KEY, None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_KEY} must name a folder that driver and executors share")
    global _LOCAL
    if _LOCAL is None:
        _LOCAL = "file://" + tempfile.mkdtemp(prefix="skein-")
    return _LOCAL


_LOCAL: str | None = None


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark)}/skein/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextlib.contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the work tables that were made inside; what was read from them must be done by then."""
    token = _MADE.set([])
    try:
        yield
    finally:
        made = _MADE.get()
        _MADE.reset(token)
        for path in made:
            delete(spark, path)


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    The result's lineage starts at the files, so a lost executor costs a read,
    and what reads it more than once does not compute it again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove ``path`` with the file system that holds it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
