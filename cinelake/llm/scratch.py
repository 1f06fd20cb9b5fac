"""Tables kept in the folder all machines share, to cut lineage and to reuse results.

An operator releases the tables that its result does not read. What its result reads stays until ``clear``, or until the
driver's Python ends while the session still runs.

Tables are written in row groups of about ``ROW_GROUP_BYTES``, each of which is a batch of the reader at most. Parquet's own
128 MB, looked at only every 100 to 10,000 rows, would put hundreds of rows of a megabyte (index segments) into one batch.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

ROW_GROUP_BYTES = 16 << 20
CHECK_ROWS = 16  # after at most so many rows, the writer looks at the size of its row group and pages
WRITER = {"parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": CHECK_ROWS}

_OWN: dict[str, str] = {}
_LIVE: list[tuple[str, str]] = []  # (application, folder) of every Scratch not cleared yet


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only in local mode without that setting."""
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="cinelake-")
    return "file://" + _OWN[app]


def _delete(spark_context: SparkContext, path: str) -> None:
    p = spark_context._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark_context._jsc.hadoopConfiguration()).delete(p, True)


def mark() -> int:
    """The place in the list of live folders, for clear()."""
    return len(_LIVE)


def clear(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables of all operator calls after the mark. Results not written yet that read them are lost."""
    app = spark.sparkContext.applicationId
    for owner, base in _LIVE[since:]:
        if owner == app:
            _delete(spark.sparkContext, base)
    del _LIVE[since:]


@atexit.register
def _at_exit() -> None:
    context = SparkContext._active_spark_context
    for owner, base in _LIVE if context is not None else ():
        if owner == context.applicationId:
            _delete(context, base)


class Scratch:
    """Written tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.kept: list[tuple[DataFrame, str]] = []
        self.n = 0
        _LIVE.append((spark.sparkContext.applicationId, self.base))

    def keep(self, df: DataFrame, label: str = "t") -> DataFrame:
        """Write df as Parquet and read it back: later plans start from the files, which outlive executors."""
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{label}"
        df.write.options(**WRITER).mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.kept.append((out, path))
        return out

    def release(self, *needed: DataFrame) -> None:
        """Delete the files of all kept tables but these."""
        for df, path in self.kept:
            if not any(df is x for x in needed):
                _delete(self.spark.sparkContext, path)
        self.kept = [(df, path) for df, path in self.kept if any(df is x for x in needed)]
