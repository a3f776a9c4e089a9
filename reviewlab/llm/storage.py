"""Hand-off tables and files in the cluster's shared folder.

Everything that one stage leaves for the next lies under the folder named by
``spark.checkpoint.dir`` (any file system that Spark and pyarrow both know),
so losing an executor loses nothing that was already written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from reviewlab.session import few, file_system, scratch_dir, stash

__all__ = ["few", "file_system", "in_batches", "scratch_dir", "stash"]

#: Rows of an Arrow batch, where the session has Spark's default of 10,000: whole texts
#: make such a batch tens of megabytes, held by the JVM and by Python at once.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_batches(rows: DataFrame) -> DataFrame:
    """``rows``, in a session whose Arrow batches suit whole texts; a value that was set stays."""
    conf = rows.sparkSession.conf
    if conf.get(_BATCH_CONF) == "10000":
        conf.set(_BATCH_CONF, str(BATCH_ROWS))
    return rows
