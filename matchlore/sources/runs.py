"""A folder that many runs add rows to, each of them whole or not at all.

    rows/run=<run>/       what a run brought
    finished/run=<run>/   the keys of these rows
    committed/            one row per run, in one file that is written last

A run counts from the moment its row in ``committed`` is there. Whatever a broken run has left behind is not
read, and its keys count as unfinished; the same run started again takes its place.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlore.session import kept_table

_COMMITTED = T.StructType([T.StructField("run", T.StringType()), T.StructField("rows", T.LongType())])


@dataclass(frozen=True)
class RunFolder:
    """``schema`` is that of the rows; ``key`` names the column whose values are finished by a run.

    ``format`` is that of the rows (parquet, json, orc); keys and runs are Parquet.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    format: str = "parquet"

    def add(self, rows: DataFrame, run: str | None = None) -> int:
        """Writes the rows whose key is not finished, and returns how many they were.

        Without a name the run is named by time. Rows without a key are left out, as nothing could tell that they are finished.
        A run that brings nothing leaves no trace.
        """
        run = run or f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        if self.committed().filter(F.col("run") == run).limit(1).count():
            raise ValueError(f"run {run} is finished")
        self._write_rows(self.unfinished(rows), run)
        return self._commit(run)

    def unfinished(self, rows: DataFrame) -> DataFrame:
        """Rows whose key no committed run has brought."""
        named = rows.select(*self.schema.names).filter(F.col(self.key).isNotNull())
        return named.join(self.finished(), self.key, "left_anti")

    def committed(self) -> DataFrame:
        """(run, rows) of the runs that count."""
        return self._read("committed", _COMMITTED, "parquet")

    def finished(self) -> DataFrame:
        """The keys of all committed runs."""
        return self._keys().select(self.key).distinct()

    def read(self) -> DataFrame:
        """All rows of committed runs, with the run they came from.

        If runs at the same time have brought the same key, the rows of the first by name are taken. Which
        rows that leaves out is told by the keys alone, so the rows themselves are not shuffled where few repeat.
        """
        keys = self._keys()
        firsts = keys.groupBy(self.key).agg(F.min("run").alias("__first"), F.count(F.lit(1)).alias("__runs"))
        repeated = firsts.filter("__runs > 1").select(self.key, "__first")
        later = keys.join(repeated, self.key).filter(F.col("run") != F.col("__first")).select(self.key, "run")
        rows = self._of_committed("rows", self.schema, self.format)
        return rows.join(kept_table(later, "runs-later"), [self.key, "run"], "left_anti").select(*self.schema.names, "run")

    def _keys(self) -> DataFrame:
        return self._of_committed("finished", T.StructType([self.schema[self.key]]), "parquet")

    def _of_committed(self, part: str, schema: T.StructType, format_: str) -> DataFrame:
        read = self._read(part, T.StructType([*schema.fields, T.StructField("run", T.StringType())]), format_)
        return read.join(self.committed().select("run"), "run", "left_semi")

    def _read(self, part: str, schema: T.StructType, format_: str) -> DataFrame:
        options = {"mode": "FAILFAST"} if format_ == "json" else {}
        try:
            return self.spark.read.schema(schema).options(**options).format(format_).load(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write_rows(self, rows: DataFrame, run: str) -> None:
        rows.write.mode("overwrite").format(self.format).save(f"{self.path}/rows/run={run}")

    def _commit(self, run: str) -> int:
        """Keys are taken from the files that were written, so that they name just what is there."""
        written = self.spark.read.schema(self.schema).format(self.format).load(f"{self.path}/rows/run={run}")
        rows = written.count()
        if rows:
            written.select(self.key).distinct().write.mode("overwrite").parquet(f"{self.path}/finished/run={run}")
            one = self.spark.createDataFrame([(run, rows)], _COMMITTED).coalesce(1)
            one.write.mode("append").parquet(f"{self.path}/committed")
        return rows
