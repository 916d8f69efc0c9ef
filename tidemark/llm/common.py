"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: blank, tab, newline, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, one machine) a temporary folder of this process stands in.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # Another caller of the session may have set it through the context.
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not known.isDefined() and not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = known.get() if known.isDefined() else f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.sparkContext.setCheckpointDir(root)
    return root if "://" in root or root.startswith("file:") else f"file://{root}"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application.

    Spark serves the archive from the driver, so executors need not share a
    folder or have the package installed.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    at = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with open(at, "wb") as f:
        f.write(body.getvalue())
    spark.sparkContext.addPyFile(at)
    _SHIPPED.add(app)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage and forget its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key for each row, and the key's name, which no column of ``docs`` has.

    Written out to the shared folder, so that a key stays the row's own.
    """
    key, at = "row_key", scratch(docs.sparkSession, "rows")
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    rows = docs.withColumn(key, F.monotonically_increasing_id())
    rows.write.parquet(at)
    return docs.sparkSession.read.schema(rows.schema).parquet(at), key


def give_back() -> None:
    """Return to the system what this process has freed."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs hold.

    Spark drops broadcasts and shuffle files once the driver's collector has
    found that no plan needs them, which in a large heap may be much later.
    """
    give_back()
    spark.sparkContext._jvm.System.gc()


def tidy(run):
    """``run`` over a task's batches; what it no longer needs then goes back to the system.

    Spark keeps Python workers for later tasks, and with them what their
    allocators hold.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


class Table:
    """Token ids by number, of words or pieces: one flat array and where each one's ids lie in it."""

    def __init__(self) -> None:
        self.ids, self.ends, self.n, self.size = np.empty(1 << 16, np.int32), np.zeros(1 << 16, np.int64), 0, 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.size + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.n + len(sizes) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.empty_like(self.ends)])
        self.ids[self.size : self.size + len(ids)] = ids
        self.ends[self.n + 1 : self.n + 1 + len(sizes)] = self.size + np.cumsum(sizes)
        self.n, self.size = self.n + len(sizes), self.size + len(ids)

    def pick(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these one after another, and how many each has."""
        starts = self.ends[numbers]
        sizes = self.ends[numbers + 1] - starts
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes


class Workspace:
    """Intermediate tables as Parquet below the shared folder, removed together."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.at, self.n = spark, scratch(spark, name), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.at}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        drop_path(self.spark, self.at)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a path through the cluster's own file system layer."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, use) -> Column:
    """use(value), with ``value`` computed once.

    What stands inside a lambda is otherwise computed again for each element;
    the variable of a transform over one element is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
