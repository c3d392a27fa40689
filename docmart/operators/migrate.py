"""Migration of staged rows to the mart: keyed once, loaded once, repeatable after a crash.

Staged batches, mart parts and flags are folders of Parquet parts, named by batch or run.  A run takes the rows that no
finished run has loaded, writes its mart part and then its flags; a part without flags was broken off and is never read.  The
same run again does the same, whatever was left behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .mart import dimension_keys


class Migration:
    """Staged and migrated rows of one table in a folder that the cluster shares.

    ``key`` are the columns by which a row is known, ``schema`` its columns with their types. ``dimensions`` are ``{name column: key column}``: names get
    a key when they are first loaded and keep it, a null name has none. Rows with equal keys in one batch: the one of greatest text stays.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: Sequence[str], dimensions: dict[str, str] | None = None) -> None:
        self.spark, self.folder, self.key, self.dimensions = spark, folder.rstrip("/"), list(key), dimensions or {}
        self.schema = spark.createDataFrame([], schema).schema
        self.columns = self.schema.names

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _types(self, more: str) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema) + f", {more}"

    def stage(self, rows: DataFrame, batch: int) -> None:
        """Put rows before the mart; the same batch again replaces itself."""
        text = F.to_json(F.struct(*self.columns), {"ignoreNullFields": "false"})
        own = rows.select(*self.columns, F.sha2(text, 256).alias("version"))
        one = Window.partitionBy(*self.key).orderBy(F.desc("version"))
        own.withColumn("_rn", F.row_number().over(one)).where("_rn = 1").drop("_rn").write.mode("overwrite").parquet(f"{self.folder}/staged/batch={batch}")

    def staged(self) -> DataFrame:
        """The last staged row of each key, with ``is_migrated``: whether a finished run has loaded just that row."""
        rows = self._read("staged", self._types("version string, batch int"))
        last = Window.partitionBy(*self.key).orderBy(F.desc("batch"))
        rows = rows.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")
        return self._flagged(rows, self._flags())

    def _flags(self) -> DataFrame:
        return self._read("flags", "version string, run int")

    def _flagged(self, rows: DataFrame, flags: DataFrame) -> DataFrame:
        done = flags.select("version").distinct().withColumn("_done", F.lit(True))
        return rows.join(done, "version", "left").withColumn("is_migrated", F.coalesce("_done", F.lit(False))).drop("_done")

    def run(self, run: int) -> None:
        """Load what no run before has loaded. Runs are numbered upward and are not made at once."""
        self.load(run)
        # the flags come last: they say that the part is whole
        part = self._read(f"mart/run={run}", self._types("version string"))
        part.select("version").write.mode("overwrite").parquet(f"{self.folder}/flags/run={run}")

    def load(self, run: int) -> None:
        """The first half of a run: its keys and its part of the mart."""
        before = self._flags().where(F.col("run") < run)
        pending = self._flagged(self.staged().drop("is_migrated"), before).where("not is_migrated").drop("is_migrated", "batch")
        for name, key in self.dimensions.items():
            known = self.dimension(name, run)
            fresh = dimension_keys(pending.where(F.col(name).isNotNull()).select(name), known, name, key).join(known.select(name), name, "left_anti")
            fresh.write.mode("overwrite").parquet(f"{self.folder}/dimensions/{name}/run={run}")
        pending.write.mode("overwrite").parquet(f"{self.folder}/mart/run={run}")

    def dimension(self, name: str, before: int | None = None) -> DataFrame:
        """The names of a dimension and their keys."""
        rows = self._read(f"dimensions/{name}", f"`{name}` {self.schema[name].dataType.simpleString()}, `{self.dimensions[name]}` bigint, run int")
        runs = self._flags().select("run").distinct()
        rows = rows.join(runs, "run", "left_semi") if before is None else rows.where(F.col("run") < before).join(runs, "run", "left_semi")
        return rows.drop("run").dropDuplicates([name])

    def mart(self) -> DataFrame:
        """The rows that finished runs have loaded, of each key the last, with their dimension keys and ``run``."""
        rows = self._read("mart", self._types("version string, run int")).join(self._flags().select("run").distinct(), "run", "left_semi")
        last = Window.partitionBy(*self.key).orderBy(F.desc("run"))
        rows = rows.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn", "version")
        for name in self.dimensions:
            rows = rows.join(self.dimension(name), name, "left")
        return rows
