"""Run identity and session settings shared by every stage.

A ``RunContext`` replaces the module-level globals a notebook would use
(batch id, run timestamp, "today"): it is passed in explicitly so a run is
reproducible and two runs never share state by accident.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

# Settings the pipeline relies on. Time zone: unix seconds are converted to
# dates, which is only well defined in a fixed zone. AQE: runtime re-planning
# (broadcast conversion from measured sizes, skew splitting, partition
# coalescing) is what keeps the joins sound when a key is hot.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Settings for a session that has none of its own. A task of a shuffle's read side
# gets 16 MB (packed; sorted and hashed in memory, some fifteen times that) instead
# of 64, so its memory stops to grow with the input there.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
}


# Target bytes per task: scans, and reduce sides of shuffles (larger, so that
# map tasks times reduce tasks, the number of shuffle blocks, stays moderate).
TASK_BYTES = 256 * 1024 * 1024
SHUFFLE_BYTES = 1024 * 1024 * 1024


def sizing_settings(input_bytes: int, task_bytes: int = TASK_BYTES,
                    shuffle_bytes: int = SHUFFLE_BYTES) -> dict[str, str]:
    """Partition sizing for a stage that reads ``input_bytes``.

    The initial shuffle partition count is set so the stage's largest shuffle
    (the line-grain data) starts near ``shuffle_bytes`` per partition; AQE then
    merges partitions of smaller shuffles up to ``task_bytes``, so tasks fit in
    executor memory and spill gracefully.
    """
    partitions = max(200, -(-int(input_bytes) // shuffle_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
    }


def configure_session(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the pipeline's settings; with ``input_bytes``, also size
    partitions for a stage that reads that much (cluster runs; tests leave it
    out)."""
    settings = dict(SESSION_SETTINGS)
    if input_bytes:
        settings.update(sizing_settings(input_bytes))
    settings = {k: v for k, v in SESSION_DEFAULTS.items() if spark.conf.get(k, None) is None} | settings
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@dataclass(frozen=True)
class RunContext:
    """Identity of one pipeline run.

    ``as_of`` is the day that "future" is measured against; it is an argument
    instead of ``current_date()`` so a re-run over the same input gives the
    same tables.
    """

    batch_id: str
    run_ts: datetime
    as_of: date

    @staticmethod
    def new(as_of: date | None = None) -> "RunContext":
        now = datetime.now(timezone.utc)
        return RunContext(str(uuid.uuid4()), now, as_of or now.date())


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for reliable checkpoints.

    Read from the session; never invented here, because a machine-local
    folder does not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder every executor "
            "and the driver can reach (HDFS, object store, shared volume)")
    sc.setCheckpointDir(configured)
    return configured
