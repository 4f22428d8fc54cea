"""The run log: one row per pipeline run, with row counts and status taken from the writes themselves."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from drawdown.sources import files

RUN_LOG = (
    "as_of_date DATE, run_timestamp TIMESTAMP, pipeline_version STRING, triggered_by STRING, status STRING, "
    "rows_written_fact BIGINT, rows_written_dims BIGINT, is_correction BOOLEAN, correction_note STRING, "
    "correction_approved_by STRING, failed_layer STRING, run_id STRING"
)


class AuditedRun:
    """A run whose layers are written through it.

    ``with AuditedRun(...) as run`` logs the run as ``running``, then as
    ``success`` or, when a layer fails, as ``failed`` with the layer's name and
    the rows written up to it; the error goes on to the caller. Counts come from
    an observation on the frame being written, so nothing is read again to be
    counted. A correction must say why and who approved it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        run_id: str,
        as_of: date,
        run_ts: datetime | None = None,
        version: str = "1",
        triggered_by: str = "manual",
        note: str | None = None,
        approved_by: str | None = None,
    ):
        if triggered_by == "correction" and not (note and approved_by):
            raise ValueError("a correction needs a note and an approver")
        self.spark, self.path = spark, path
        self.run_id = f"{run_id}-{as_of:%Y%m%d}"
        self.head = (as_of, run_ts, version, triggered_by)
        self.correction = (triggered_by == "correction", note, approved_by)
        self.rows = {"fact": 0, "dim": 0, "view": 0}
        self.layer: str | None = None

    def __enter__(self) -> AuditedRun:
        self._log("running")
        return self

    def __exit__(self, kind, error, trace) -> bool:
        self._log("failed" if kind else "success", self.layer if kind else None)
        return False

    def write(self, name: str, df: DataFrame, writer: Callable[[DataFrame], None], kind: str = "view") -> None:
        """Write one layer and add the rows that went into it; ``kind`` is fact, dim or view."""
        self.layer = name
        seen = Observation()
        writer(df.observe(seen, F.count(F.lit(1)).alias("n")))
        self.rows[kind] += seen.get["n"]
        self.layer = None

    def _log(self, status: str, failed: str | None = None) -> None:
        """The run's row; it replaces what the run logged before."""
        row = (*self.head, status, self.rows["fact"], self.rows["dim"], *self.correction, failed, self.run_id)
        files.write_table(self.spark.createDataFrame([row], RUN_LOG), f"{self.path}/run={self.run_id}")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).option("recursiveFileLookup", "true").parquet(path)
