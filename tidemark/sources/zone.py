"""A landing zone: vendor files numbered once and laid out by month.

Vendor files come in any order, and their times change when they are copied.
So each file gets its number when it lands, in a ledger, and each row carries
``_arrival`` from then on: (drop, file, row). Raw stores keep the last landed
row of a key by it, whatever happens to the files. A folder may land again and
again: only files that the ledger doesn't have are taken.

Rows are written to ``drop=<n>/land_month=<yyyymm>``, the month of their text
date in any accepted shape, so that a window or a gap plan opens only the
months that it needs. A drop is there once its ledger entry is.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import lenient_date, month_key
from tidemark.operators.store import ARRIVAL, LAND_MONTH, cast_to
from tidemark.schema import LANDING
from tidemark.sources.landing import nan_as_null, where_days

DROP, LEDGER = "drop", "_ledger"
ARRIVAL_TYPE = T.StructType([
    T.StructField("drop", T.IntegerType()), T.StructField("file", T.IntegerType()), T.StructField("row", T.LongType())])
LEDGER_SCHEMA = T.StructType([T.StructField("file", T.IntegerType()), T.StructField("name", T.StringType()),
                              T.StructField("landed_at", T.TimestampNTZType())])


def _one_slash(path: Column) -> Column:
    """Local paths come as file:/x or file:///x."""
    return F.regexp_replace(path, "^file:/+", "file:/")


class LandingZone:
    """Landed data below one shared directory, one folder for each dataset."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, dataset: str) -> str:
        return f"{self.root}/{dataset}"

    def _optional(self, reader, path: str) -> DataFrame | None:
        try:
            return reader.load(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return None
            raise

    # ------------------------------------------------------------ ledger -----
    def ledger(self, dataset: str) -> DataFrame | None:
        """``drop``, ``file``, ``name`` and ``landed_at`` of every file landed; None if there is none."""
        schema = T.StructType(LEDGER_SCHEMA.fields + [T.StructField(DROP, T.IntegerType())])
        return self._optional(self.spark.read.schema(schema).format("parquet"), f"{self.path(LEDGER)}/{dataset}")

    def drops(self, dataset: str) -> list[int]:
        """Numbers of the drops that are there."""
        ledger = self.ledger(dataset)
        return [] if ledger is None else sorted(r[0] for r in ledger.select(DROP).distinct().collect())

    def _commit(self, dataset: str, drop: int, files: list[tuple[int, str]]) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        (self.spark.createDataFrame([(*f, now) for f in files], LEDGER_SCHEMA).coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.path(LEDGER)}/{dataset}/{DROP}={drop}"))

    # ------------------------------------------------------------ landing ----
    def _lay_out(self, dataset: str, rows: DataFrame, drop: int, date_col: str | None) -> None:
        fields = LANDING[dataset]
        arrival = F.struct(F.lit(drop).alias("drop"), F.col("_file").alias("file"), F.col("_row").alias("row"))
        out = cast_to(rows.withColumn(ARRIVAL, arrival.cast(ARRIVAL_TYPE)), fields, keep=(ARRIVAL,))
        month = F.lit(None).cast("int")
        if date_col is not None:
            kind = fields[date_col].dataType
            month = month_key(lenient_date(F.col(date_col), kind) if isinstance(kind, T.StringType) else F.col(date_col).cast("date"))
        (out.withColumn(LAND_MONTH, month).repartition(LAND_MONTH, F.pmod(F.xxhash64(*fields.fieldNames()), F.lit(self._spread())))
         .write.mode("errorifexists").partitionBy(LAND_MONTH).parquet(f"{self.path(dataset)}/{DROP}={drop}"))

    def _spread(self) -> int:
        """Tasks that a month's rows are dealt to: a hot month isn't one task's."""
        return max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8)

    def land(self, dataset: str, rows: DataFrame, date_col: str | None = "trade_date") -> int:
        """Land a batch that has no files, in the order of its rows; the drop's number."""
        drop = max(self.drops(dataset), default=0) + 1
        numbered = rows.withColumns({"_file": F.lit(0), "_row": F.monotonically_increasing_id()})
        self._lay_out(dataset, numbered, drop, date_col)
        self._commit(dataset, drop, [(0, "")])
        return drop

    def land_files(self, dataset: str, folder: str, date_col: str | None = "trade_date") -> int | None:
        """Land the parquet files below ``folder`` that the ledger doesn't have
        (by their names inside it), numbered by file time, then name. The
        drop's number, or None if all were there."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(folder).select("path", "modificationTime"))
        base = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        base = base.getFileSystem(self.spark._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/") + "/"
        named = files.select("modificationTime", _one_slash(F.col("path")).alias("path")).withColumn(
            "name", F.expr(f"substring(path, {len(base) + 1})"))
        ledger = self.ledger(dataset)
        if ledger is not None:
            named = named.join(ledger.select("name"), "name", "left_anti")
        new = sorted((r["modificationTime"], r["name"], r["path"]) for r in named.collect())
        if not new:
            return None
        drop = max(self.drops(dataset), default=0) + 1
        numbers = self.spark.createDataFrame([(i, path) for i, (_, _, path) in enumerate(new)], "_file int, _path string")
        rows = self.spark.read.schema(LANDING[dataset]).parquet(*[path for _, _, path in new])
        rows = rows.select("*", _one_slash(F.col("_metadata.file_path")).alias("_path"), F.col("_metadata.row_index").alias("_row"))
        self._lay_out(dataset, rows.join(numbers, "_path"), drop, date_col)
        self._commit(dataset, drop, [(i, name) for i, (_, name, _) in enumerate(new)])
        return drop

    # ------------------------------------------------------------ scans ------
    def read(self, dataset: str) -> DataFrame:
        """All landed rows with the contract's columns, ``_arrival`` and
        ``land_month`` (a partition column: filters on it prune directories)."""
        fields = T.StructType(LANDING[dataset].fields + [T.StructField(ARRIVAL, ARRIVAL_TYPE)])
        stored = T.StructType(fields.fields + [T.StructField(DROP, T.IntegerType()), T.StructField(LAND_MONTH, T.IntegerType())])
        drops = self.drops(dataset)
        if not drops:
            return self.spark.createDataFrame([], T.StructType(fields.fields + [stored[LAND_MONTH]]))
        path = self.path(dataset)
        rows = self.spark.read.schema(stored).option("basePath", path).parquet(*[f"{path}/{DROP}={n}" for n in drops])
        return nan_as_null(rows.drop(DROP))

    def read_window(self, dataset: str, lo: _dt.date, hi: _dt.date, date_col: str = "trade_date") -> DataFrame:
        """Landed rows of the days lo..hi, from their months only."""
        return where_days(in_months(self.read(dataset), F.lit(lo), F.lit(hi)), date_col, lo, hi)


def in_months(landing: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Landed rows of the months from day ``lo`` to day ``hi``; frames that
    aren't laid out by month come back as they are. The bounds may be scalars
    of the plan: Spark then prunes directories when the query runs."""
    if LAND_MONTH not in landing.columns:
        return landing
    return landing.where(F.col(LAND_MONTH).between(month_key(lo.cast("date")), month_key(hi.cast("date"))))
