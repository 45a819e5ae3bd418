"""Stage tables in the shared folder of the session.

Stage tables cut lineage: they live on shared storage, so a lost executor
costs no recomputation of earlier stages, and their real size steers the
join strategy of everything that reads them.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Most bytes of files, and of shuffled rows, that a task of a stage reads. Stage tables and shuffles are dense (about 26 bytes a
#: line), so tasks of Spark's usual size hold millions of groups and spill.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """What runs inside reads at most `TASK_BYTES` per task; smaller values of the session stay, and all come back."""
    before = {key: spark.conf.get(key) for key in TASK_BYTES}
    for key, most in TASK_BYTES.items():
        spark.conf.set(key, f"{min(most, _bytes(before[key]))}b")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _bytes(size: str) -> int:
    """Bytes of a size as Spark writes it: a number, then perhaps b, k, m, g or t, as in `64MB`."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]?)[a-z]*", size.strip().lower()).groups()
    return int(number) << 10 * "bkmgt".index(unit or "b")


def shared_folder(spark: SparkSession) -> str:
    """Folder for stage tables: `spark.checkpoint.dir`, or a temporary one in local mode only."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlark-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/ledgerlark/{context.applicationId}"


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet under the shared folder and return a reader of it."""
    return write_once(df, f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Write `df` as Parquet to `path` and return a reader with the same schema."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_kept(df: DataFrame, path: str, origin: str) -> DataFrame:
    """Write `df` as `write_once`, then a manifest inside its folder that says what made it.

    The manifest is written when the table is complete, and goes with the folder
    when the table is overwritten. Readers of the table do not see it.
    """
    table = write_once(df, path)
    manifest = {"origin": origin, "schema": table.schema.json(), "rows": table.count()}
    line = df.sparkSession.range(1).select(F.lit(json.dumps(manifest)).alias("value"))
    line.coalesce(1).write.text(f"{path}/_manifest")
    return table


def read_kept(spark: SparkSession, path: str, origin: str) -> DataFrame | None:
    """Table that an earlier run has finished at `path` from the same origin, or None.

    A table without manifest, of another origin, or with other rows than it was
    written with, does not count. Any fault but a missing path is raised.
    """
    try:
        line = spark.read.schema("value string").text(f"{path}/_manifest").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    manifest = json.loads(line.value) if line else {"origin": None}
    if manifest["origin"] != origin:
        return None
    table = spark.read.schema(T.StructType.fromJson(json.loads(manifest["schema"]))).parquet(path)
    return table if table.count() == manifest["rows"] else None
