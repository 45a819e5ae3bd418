"""Removal of stage tables in the course of a job with many rounds."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame


def drop_stage(*tables: DataFrame) -> None:
    """Remove stage tables that nothing reads any more; shuffle files of finished steps go with the driver's garbage."""
    if not tables:
        return
    context = tables[0].sparkSession.sparkContext
    for folder in {name.rsplit("/", 1)[0] for table in tables for name in table.inputFiles()}:
        if f"/ledgerlark/{context.applicationId}/" in folder:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    context._jvm.System.gc()
