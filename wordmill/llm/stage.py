"""Stage tables of the operators: written under the shared checkpoint folder, dropped when done."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wordmill.session import ensure_checkpoint_dir


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Begins the names of columns that operators add for a while; tables' own names do not begin so.
OWN = "\u0001"

#: A stage table of at most so many rows is read as one partition, so that group-bys and
#: joins among small tables need no exchange.
SMALL_ROWS = 50_000


class Stages:
    """Writes tables that are read more than once, and removes those no longer needed.

    A table cuts the lineage: a lost executor costs a re-read, not a recompute.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def cut(self, df: DataFrame, name: str, narrow: bool = True) -> DataFrame:
        """Write and reread ``df``.  ``narrow``: its rows are a few numbers, so a small table may be one partition."""
        path = stage_path(self.spark, name)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        rows = seen.get["n"]
        out = self.spark.read.schema(df.schema).parquet(path)
        if narrow and rows <= SMALL_ROWS:
            out = out.coalesce(1)
        out._stage = (path, rows)  # noqa: SLF001  (for rows and drop)
        return out

    @staticmethod
    def rows(table: DataFrame) -> int:
        """Rows of a table that ``cut`` returned."""
        return table._stage[1]  # noqa: SLF001

    def drop(self, *tables: DataFrame) -> None:
        """Remove stage tables that no later result reads."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(t._stage[0])  # noqa: SLF001
            p.getFileSystem(conf).delete(p, True)
