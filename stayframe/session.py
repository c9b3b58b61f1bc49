"""Session settings and the shared scratch location.

Operators never create sessions; tests and ``bench.py`` use ``local_session``.
``tune`` only sets runtime SQL options that change plans, never resources.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Options every job here relies on: zone-free times, AQE re-planning
# (coalescing, skew-join splitting even when it costs an extra shuffle,
# runtime broadcast choice from measured sizes).
RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_OPTIONS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    _narrow(spark)
    return importable(spark)


# Stored bytes of the tables read for each partition that a shuffle starts from,
# and shuffled bytes up to which AQE merges partitions: one task's sorts and hash
# tables take over a hundred times the bytes it reads where readings fan out.
BYTES_A_PARTITION = 4 << 20
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
_READ, _GIVEN = "stayframe.read.bytes", "stayframe.given."


def shuffle_width(spark: SparkSession) -> int:
    """Partitions a shuffle starts from (AQE merges small ones)."""
    return int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def widen(spark: SparkSession, path: str) -> None:
    """Let shuffles start from partitions in proportion to the tables a query
    reads, and stay near that size, so that what one task sorts or aggregates
    does not grow with them: every table read adds its bytes. The width never
    falls below the session's; ``tune`` gives the session's options back."""
    read = int(spark.conf.get(_READ, "0")) + stored_bytes(spark, path)
    spark.conf.set(_READ, str(read))
    wanted = -(-read // BYTES_A_PARTITION)
    if wanted > shuffle_width(spark):
        _hold(spark, INITIAL, str(wanted))
        _hold(spark, ADVISORY, str(BYTES_A_PARTITION))


def join_as_dealt(spark: SparkSession) -> None:
    """Let joins of this query run where both sides were dealt out alike by some
    of the join's keys, without another move; ``tune`` gives the option back.
    Only for keys that few rows share."""
    _hold(spark, CO_PARTITION, "false")


def _hold(spark: SparkSession, key: str, value: str) -> None:
    if spark.conf.get(_GIVEN + key, None) is None:
        spark.conf.set(_GIVEN + key, spark.conf.get(key, None) or "")
    spark.conf.set(key, value)


# Stored bytes read from which the fan-out of labs is bounded by what it is joined to.
FAN_OUT_BYTES = 16 << 20
# And from which joins with the stays shuffle by Spark's default options (below, they
# are broadcast, and blocks that come to the grid would move more often, not less).
GRID_BYTES = 192 << 20


def fans_out_far(spark: SparkSession) -> bool:
    """Whether a query's tables are so large that joins shuffle: a pass over
    the vitals that bounds the labs' fan-out then costs less than it saves."""
    return int(spark.conf.get(_READ, "0")) > FAN_OUT_BYTES


def grid_stays(spark: SparkSession) -> bool:
    """Whether a query's tables are so large that a dense grid should stay where
    it was dealt out, and what joins it come there."""
    return int(spark.conf.get(_READ, "0")) > GRID_BYTES


def _narrow(spark: SparkSession) -> None:
    spark.conf.set(_READ, "0")
    for k in (INITIAL, ADVISORY, CO_PARTITION):
        given = spark.conf.get(_GIVEN + k, None)
        if given is not None:
            spark.conf.set(k, given) if given else spark.conf.unset(k)
            spark.conf.unset(_GIVEN + k)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when it runs from a source folder.

    Workers that see the same folder (local runs, a shared mount) get it on
    their path; an installed package, or one shipped with ``--py-files``, is
    found without it.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, have]))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and local benchmarks; sets a checkpoint dir only if unset."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stayframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in RUNTIME_OPTIONS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the cluster; only when it is unset (as in
    local tests) is a folder under the system temp dir chosen and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set on this cluster")
        d = os.path.join(os.environ.get("TMPDIR", "/tmp"), "stayframe-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/stayframe/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made at ``scratch_path``; any other path is refused."""
    if not path.startswith(f"{checkpoint_dir(spark)}/stayframe/"):
        raise ValueError(f"not a scratch path: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
