"""Copy jobs that survive being lost: waves of bounded size, and a journal of those that are done."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark import schemas
from haulmark.operators.layout import FILES_PER_TASK, assign_groups, task_count
from haulmark.operators.ordered import running_sum
from haulmark.operators.transfer import CopyConf, copy_files, unfinished
from haulmark.plans.copying import routed
from haulmark.sources.logs import is_done

#: Bytes of one wave: what a lost job has to do again at most.
BYTES_PER_WAVE = 1 << 40

_COMMITS = "wave int, pairs bigint, failed bigint, bytes_copied bigint, committed_at timestamp"
#: What a plan keeps of its pairs.
_PLANNED = "src_file string, dest_file string, is_file boolean, file_size bigint, action string, may_grow boolean, expected_md5 string"
#: The commit that says that the plan is complete.
_PLAN = -1


@dataclass(frozen=True)
class Journal:
    """The record of one copy job, in a folder that all executors reach and that outlives the job.

    ``plan`` holds the pairs with their wave, ``results`` a RESULT row per pair, ``commits`` one row per finished wave.
    Everything is appended; what has no commit row does not count, whatever an interrupted job may have left.
    """

    spark: SparkSession
    path: str

    def commits(self) -> DataFrame:
        """One row per finished wave."""
        return self._commits().filter(F.col("wave") != _PLAN)

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMITS)

    def commit(self, wave: int, result: DataFrame | None = None) -> None:
        """Say that a wave is done; its results must be stored."""
        zero = F.lit(0).cast("bigint")
        row = self.spark.range(1).select(zero.alias("pairs"), zero.alias("failed"), zero.alias("bytes_copied")) if result is None else \
            result.agg(F.count("*").alias("pairs"), F.count_if(~is_done()).alias("failed"),
                       F.coalesce(F.sum("bytes_copied"), zero).alias("bytes_copied"))
        row.coalesce(1).select(F.lit(wave).alias("wave"), "pairs", "failed", "bytes_copied", F.current_timestamp().alias("committed_at")) \
            .write.mode("append").parquet(f"{self.path}/commits")

    def has_plan(self) -> bool:
        return not self._commits().filter(F.col("wave") == _PLAN).isEmpty()

    def plan(self) -> DataFrame:
        """All pairs, with ``wave``."""
        return self.spark.read.schema(f"{_PLANNED}, wave int").parquet(f"{self.path}/plan")

    def store_plan(self, pairs: DataFrame, bytes_per_wave: int) -> None:
        """Cut the pairs, in order of source and target, into waves of about ``bytes_per_wave`` and store them."""
        size = F.coalesce("file_size", F.lit(0).cast("bigint"))
        summed = running_sum(pairs, size, ["src_file", "dest_file"], name="_end")
        known = [c.split(" ")[0] for c in _PLANNED.split(", ")]
        waves = summed.select(*[c for c in known if c in pairs.columns], F.expr(f"(_end - coalesce(file_size, 0L)) div {bytes_per_wave}").cast("int").alias("wave"))
        waves.repartitionByRange("wave", "src_file").write.mode("overwrite").partitionBy("wave").parquet(f"{self.path}/plan")
        self.commit(_PLAN)

    def add_wave(self, pairs: DataFrame) -> None:
        """One more wave, for pairs that are to be copied again."""
        after = self.plan().agg(F.max("wave")).first()[0]
        pairs.drop("wave").write.mode("overwrite").parquet(f"{self.path}/plan/wave={(-1 if after is None else after) + 1}")

    def pending(self) -> list[int]:
        """Waves without commit row; there are about as many as the plan has ``bytes_per_wave``."""
        left = self.plan().select("wave").distinct().join(self.commits(), "wave", "left_anti")
        return sorted(r.wave for r in left.collect())

    def results(self) -> DataFrame:
        """RESULT rows of all finished waves, with ``wave``."""
        schema = T.StructType([*schemas.RESULT.fields, T.StructField("wave", T.IntegerType())])
        try:
            found = self.spark.read.schema(schema).parquet(f"{self.path}/results")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return found.join(self.commits().select("wave"), "wave", "left_semi")


def copy_in_waves(spark: SparkSession, journal: str, pairs: DataFrame | None = None, bytes_per_wave: int = BYTES_PER_WAVE,
                  nodes: int = 1, max_waves: int | None = None, retry_failed: bool = False, conf: CopyConf | None = None) -> DataFrame:
    """Copy pairs wave by wave and give the results of all finished waves (RESULT with ``wave``).

    The first call routes and cuts the plan and stores it in the folder ``journal``; a later one, after the job was lost
    or stopped, goes on with the waves that have no commit row, and takes no notice of ``pairs``.  A wave that was
    interrupted is copied again as a whole, to the same places.  Each wave has as many tasks as its bytes or its
    number of files ask for, at most as many as ``nodes`` can run.

    ``max_waves`` ends the call early, for instance with a maintenance window.  ``retry_failed`` adds one more wave for
    pairs that failed, once all others are done.
    """
    record = Journal(spark, journal.rstrip("/"))
    if not record.has_plan():
        if pairs is None:
            raise ValueError(f"{journal} holds no plan yet")
        record.store_plan(routed(pairs), bytes_per_wave)
    pending = record.pending()
    if retry_failed and not pending:
        failed = unfinished(record.plan(), record.results()).dropDuplicates(["src_file", "dest_file"])
        if not failed.isEmpty():
            record.add_wave(failed)
            pending = record.pending()
    for wave in pending[:max_waves]:
        rows = record.plan().filter(F.col("wave") == wave).drop("wave")
        tasks = task_count(rows, nodes, files_per_task=FILES_PER_TASK).first()["tasks"]
        result = copy_files(assign_groups(rows, tasks), replace(conf or CopyConf(), tasks=tasks))
        result.write.mode("overwrite").parquet(f"{record.path}/results/wave={wave}")
        record.commit(wave, result)
    return record.results()
