"""Canonical and raw stores on parquet (S7, S9, S10 on disk).

Every table has a log: one entry for each commit, numbered, which names the
directories that make up the table from then on. Data are written to
directories of their own first and never changed; the entry, one small file,
makes them visible all at once. A load that dies before it leaves the table as
it was, over all months. Two loads that start from the same entry can't both
commit: the second fails. Older entries expire, and with them the directories
that only they name.

Two layouts:

* **Month-partitioned** (tables whose key holds a date: bars, FX, special
  treatment, and raw stores keyed by date). A key fixes its month. A commit
  writes ``commit=<n>/trade_month=<yyyymm>`` for the months of its batch.
  Canonical tables replace those months whole, so that reads need no merge.
  Raw stores append the batch as a *delta*: a read keeps each key's latest
  commit, and months with more than ``MOST_DELTAS`` are compacted, so what a
  merge writes is in proportion to its batch.
* **Snapshots** (tables keyed by instrument only). A commit writes the merged
  table as ``snapshot=<n>``.

Canonical bar tables keep their coverage beside the data, by the same commits
and months: (instrument, source, month) with first and last date. A month that
is replaced has its coverage replaced, so rows that change their source (Q16)
are retracted with no scan beyond the batch's months.

A raw store's columns are those of the vendor, so its schema is registered in
the log and every file is read with it: no file footers are merged. New
columns are added to it. A column whose type has to widen (number to text, for
one) has all months rewritten once, in one commit. The log also remembers in
which commits each column came, so that one added later is told from one lost.

Every write checks the batch first (required columns non-null, key unique),
so a bad batch writes nothing.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import lenient_date, month_key
from tidemark.operators.conform import guard_required
from tidemark.operators.coverage import coverage_summary
from tidemark.operators.store import (
    ARRIVAL, LAND_MONTH, align_to_spec, cast_to, check_upsert_columns, keep_latest, merge_keep_latest, relaxed_schema, same_keys, upsert)
from tidemark.schema import TableSpec
from tidemark.session import ensure_checkpoint_dir

MONTH, COMMIT, SNAPSHOT = "trade_month", "commit", "snapshot"
MANIFEST, ENTRY = "_manifest", "entry"
COVERAGE = "_coverage"
COVERAGE_KEYS = ("instrument_id", "source_id")
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # Spark's directory of null
MANIFEST_SCHEMA = T.StructType([
    T.StructField("commit", T.StringType(), False),
    T.StructField("keys", T.ArrayType(T.StringType()), True),  # of a raw store
    T.StructField("schema", T.StringType(), True),  # registered columns, as JSON
    T.StructField("rows", T.LongType(), True),
    T.StructField("months", T.ArrayType(T.StructType([  # directories of a month-partitioned table, oldest first
        T.StructField("month", T.IntegerType(), True), T.StructField("commit", T.StringType(), False)])), True),
    T.StructField("columns", T.ArrayType(T.StructType([  # first and last commit whose batch had each column
        T.StructField("name", T.StringType(), False), T.StructField("since", T.IntegerType(), False),
        T.StructField("until", T.IntegerType(), False)])), True),
    T.StructField("committed_at", T.TimestampNTZType(), False),
])
KEPT_COMMITS = 3  # so that a reader of the one before can finish
MOST_DELTAS = 8  # directories of a month of a raw store before it is compacted
# Default raw-store key when a dataset names none.
DEFAULT_RAW_KEYS = ("trade_date", "instrument_id")


class CommitConflict(RuntimeError):
    """Another load has committed to the table since this one began."""


def new_run_id() -> str:
    """Sortable run id: UTC time to the millisecond plus a random suffix."""
    now = _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%S%f")[:-3] + "-" + uuid.uuid4().hex[:8]


def months_of(month, df: DataFrame) -> set[int | None]:
    """The months of a batch: as many numbers as it has months."""
    return {r[0] for r in df.select(month.alias(MONTH)).distinct().collect()}


def batch_key_stats(df: DataFrame, keys) -> tuple[int, int]:
    """(rows, largest multiplicity of a key) of a batch in one partial
    aggregate; a hot key is pre-counted inside each map task."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    row = per_key.agg(F.sum("_n").alias("rows"), F.max("_n").alias("max_n")).first()
    return int(row["rows"] or 0), int(row["max_n"] or 0)


def counted(df: DataFrame, write) -> int:
    """Run ``write`` on ``df``; the number of rows it took, observed on the
    way (after any range partitioning, which reads its input twice)."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get["rows"])


class Store:
    """A store rooted at one shared directory (one sub-directory per table)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        ensure_checkpoint_dir(spark)

    # ------------------------------------------------------------ paths ------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read_parquet(self, path: str, schema: T.StructType | None = None) -> DataFrame | None:
        """Read parquet files; None when the path does not exist. ``schema``
        reads with the registered columns (files lacking one give nulls)."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
                return None
            raise

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    # ------------------------------------------------------------ log --------
    def _entries(self, name: str) -> list:
        """The table's log, newest first: the few entries still kept."""
        log = self._read_parquet(f"{self.path(MANIFEST)}/{name}",
                                 T.StructType(MANIFEST_SCHEMA.fields + [T.StructField(ENTRY, T.IntegerType())]))
        return [] if log is None else log.orderBy(F.desc(ENTRY)).collect()

    def _latest(self, name: str):
        """Newest entry of a table's log, or None."""
        return next(iter(self._entries(name)), None)

    @staticmethod
    def _next(entry) -> tuple[int, str]:
        """Number and directory name of the commit after ``entry``. Names sort by number."""
        n = 1 if entry is None else entry[ENTRY] + 1
        return n, f"{n:08d}-{uuid.uuid4().hex[:8]}"

    def _commit(self, name: str, before, commit: str, rows: int | None, schema: T.StructType | None = None,
                months: dict | None = None, keys=None, came=None) -> None:
        """Make ``commit`` the table's state. ``before`` is the entry that the
        load began with; ``months`` has each month's directories; ``came`` the
        columns of the batch."""
        n = 1 if before is None else before[ENTRY] + 1
        latest = self._latest(name)
        if (latest and latest[ENTRY]) != (before and before[ENTRY]):
            raise CommitConflict(f"{name}: commit {n} is already there")
        columns = {c["name"]: (c["since"], c["until"]) for c in (before["columns"] or [] if before else [])}
        columns |= {c: (columns.get(c, (n, n))[0], n) for c in came or ()}
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        dirs = None if months is None else [(m, c) for m, own in months.items() for c in own]
        row = (commit, None if keys is None else list(keys), None if schema is None else schema.json(), rows, dirs,
               [(c, *at) for c, at in columns.items()], now)
        try:
            (self.spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1)
             .write.mode("errorifexists").parquet(f"{self.path(MANIFEST)}/{name}/{ENTRY}={n}"))
        except AnalysisException as exc:
            if "PATH_ALREADY_EXISTS" in str(exc):
                raise CommitConflict(f"{name}: commit {n} is already there") from exc
            raise
        self._expire(name)

    def _expire(self, name: str) -> None:
        """Remove what the newest commits have replaced: entries, and the
        directories that only removed entries name."""
        entries = self._entries(name)
        kept, old = entries[:KEPT_COMMITS], entries[KEPT_COMMITS:]
        live = {d for e in kept for d in self._dirs(e)}
        for d in sorted({d for e in old for d in self._dirs(e)} - live):
            self._delete(f"{self.path(name)}/{d}")
            self._delete(f"{self.path(COVERAGE)}/{name}/{d}")
        for e in old:
            self._delete(f"{self.path(MANIFEST)}/{name}/{ENTRY}={e[ENTRY]}")

    @staticmethod
    def _dirs(entry, months=None) -> list[str]:
        """The directories of an entry; of some ``months`` only, if given."""
        if entry["months"] is None:
            return [f"{SNAPSHOT}={entry['commit']}"]
        return [f"{COMMIT}={d['commit']}/{MONTH}={NO_MONTH if d['month'] is None else d['month']}"
                for d in entry["months"] if months is None or d["month"] in months]

    @staticmethod
    def _by_month(entry) -> dict[int | None, list[str]]:
        out: dict[int | None, list[str]] = {}
        for d in (entry["months"] if entry else None) or ():
            out.setdefault(d["month"], []).append(d["commit"])
        return out

    def column_history(self, name: str) -> DataFrame:
        """``name``, ``since`` and ``until`` (first and last commit whose
        batch had the column) and ``state``: ``added`` if some batches came
        before it, ``lost`` if the newest batch lacks it, else ``kept``."""
        entry = self._latest(name)
        rows = [(c["name"], c["since"], c["until"]) for c in (entry["columns"] if entry else ())]
        first, last = min((r[1] for r in rows), default=0), max((r[2] for r in rows), default=0)
        state = F.when(F.col("until") < last, "lost").when(F.col("since") > first, "added").otherwise("kept")
        return self.spark.createDataFrame(rows, "name string, since int, until int").withColumn("state", state)

    # ------------------------------------------------------------ reads ------
    def _read_dirs(self, path: str, dirs: list[str], schema: T.StructType) -> DataFrame | None:
        """Directories below ``path`` with the registered columns (files that
        lack one give nulls), and their commit and month."""
        if not dirs:
            return None
        stored = T.StructType(schema.fields + [T.StructField(COMMIT, T.StringType()), T.StructField(MONTH, T.IntegerType())])
        return self.spark.read.schema(stored).option("basePath", path).parquet(*[f"{path}/{d}" for d in dirs])

    def _read_table(self, spec: TableSpec, entry, months=None) -> DataFrame | None:
        df = self._read_dirs(self.path(spec.name), self._dirs(entry, months), spec.schema)
        return None if df is None else align_to_spec(df.drop(COMMIT, MONTH), spec)

    def _read_raw_months(self, name: str, entry, months=None) -> DataFrame | None:
        """A raw store's rows, each key's latest. Months without deltas are
        read as they are; in others the newest commit of a key wins."""
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        by_month = self._by_month(entry)
        wanted = set(by_month) if months is None else set(by_month) & set(months)
        plain = {m for m in wanted if len(by_month[m]) == 1}
        one = self._read_dirs(self.path(name), self._dirs(entry, plain), schema)
        several = self._read_dirs(self.path(name), self._dirs(entry, wanted - plain), schema)
        parts = [] if one is None else [one.drop(COMMIT, MONTH)]
        if several is not None:
            parts.append(keep_latest(several.drop(MONTH), entry["keys"], COMMIT).drop(COMMIT))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def read_raw(self, name: str) -> DataFrame | None:
        """Stored frame of a raw store with its registered schema; None if there is none."""
        entry = self._latest(name)
        if entry is None:
            return None
        if entry["months"] is not None:
            return self._read_raw_months(name, entry)
        return self._read_parquet(f"{self.path(name)}/{self._dirs(entry)[0]}")

    def read_months(self, spec: TableSpec, months) -> DataFrame | None:
        """Rows of a month-partitioned canonical table in some months: only their directories are opened."""
        entry = self._latest(spec.name)
        return None if entry is None else self._read_table(spec, entry, set(months))

    def read_window(self, spec: TableSpec, lo: _dt.date, hi: _dt.date,
                    date_col: str = "trade_date") -> DataFrame | None:
        """A month-partitioned table between two dates: only the months'
        directories are opened, plus the exact date filter (row groups)."""
        entry = self._latest(spec.name)
        if entry is None:
            return None
        first, last = lo.year * 100 + lo.month, hi.year * 100 + hi.month
        df = self._read_table(spec, entry, {m for m in self._by_month(entry) if m is not None and first <= m <= last})
        if df is None:
            return self.spark.createDataFrame([], spec.schema)
        return df.where(F.col(date_col).between(F.lit(lo), F.lit(hi)))

    def read(self, spec: TableSpec) -> DataFrame | None:
        """A canonical table read with its registered columns: a column
        the stored files lack (added later) comes back as typed nulls, and
        files written before and after the addition read together. None when
        the table does not exist."""
        entry = self._latest(spec.name)
        if entry is None:
            return None
        if spec.partition_by:
            return self._read_table(spec, entry)
        df = self._read_parquet(f"{self.path(spec.name)}/{self._dirs(entry)[0]}", schema=spec.schema)
        return None if df is None else align_to_spec(df, spec)

    # ------------------------------------------------------------ coverage ---
    @staticmethod
    def keeps_coverage(spec: TableSpec) -> bool:
        """Month-partitioned instrument tables keep a coverage summary."""
        cols = set(spec.columns)
        return bool(spec.partition_by) and {"instrument_id", "source_id", "trade_date"} <= cols

    def coverage(self, spec: TableSpec) -> DataFrame | None:
        """Coverage summary ``(instrument_id, source_id, first_date,
        last_date)`` of a table: one row per instrument and source, merged
        from its months, so gap planning reads this instead of the table.
        None when the table keeps none or is not there."""
        entry = self._latest(spec.name)
        if entry is None or not self.keeps_coverage(spec):
            return None
        kept = T.StructType([spec.field(c) for c in COVERAGE_KEYS]
                            + [T.StructField(c, T.DateType()) for c in ("first_date", "last_date")])
        by_month = self._read_dirs(f"{self.path(COVERAGE)}/{spec.name}", self._dirs(entry), kept)
        if by_month is None:
            return self.spark.createDataFrame([], kept)
        return by_month.groupBy(*COVERAGE_KEYS).agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))

    # ------------------------------------------------------------ writes -----
    def _write_months(self, path: str, rows: DataFrame, month, keys) -> int:
        """Write ``rows`` below ``path`` by month; their number.

        Range-partitioned on (month, key): a month larger than one task's
        share is split across several tasks by key (a key holds at most one
        row per day, so no key is hot inside a month), and each task covers a
        contiguous run of months, so few files are written per month. Rows
        come out sorted by key inside each file (O1 layout).
        """
        order = [MONTH, *keys]
        dealt = rows.withColumn(MONTH, month).repartitionByRange(*order).sortWithinPartitions(*order)
        return counted(dealt, lambda df: df.write.mode("errorifexists").partitionBy(MONTH).parquet(path))

    def _write_coverage(self, spec: TableSpec, commit: str, months) -> None:
        """Coverage by month of a commit's months, from what it has written."""
        dirs = [f"{COMMIT}={commit}/{MONTH}={NO_MONTH if m is None else m}" for m in months]
        written = self._read_dirs(self.path(spec.name), dirs, spec.schema)
        if written is not None:
            (coverage_summary(written, "trade_date", (*COVERAGE_KEYS, MONTH)).repartition(MONTH)
             .write.mode("errorifexists").partitionBy(MONTH).parquet(f"{self.path(COVERAGE)}/{spec.name}/{COMMIT}={commit}"))

    def upsert(self, spec: TableSpec, incoming: DataFrame) -> int:
        """S10 on disk: replace stored rows whose key is in ``incoming``, add
        the rest, in one commit over all months; returns the number of
        incoming rows (0 for an empty batch).

        Checked before any write: all registered columns present (else
        ValueError with sorted names), required columns non-null, key unique.
        """
        if set(spec.columns) - set(incoming.columns) and incoming.isEmpty():
            return 0  # an empty batch writes nothing, whatever its columns
        incoming = guard_required(check_upsert_columns(incoming, spec), spec)
        # Materialize the batch once: it is checked before it is written. A
        # null in a required column fails here, so nothing is written.
        incoming = incoming.checkpoint(eager=True)
        date_keys = [k for k in spec.primary_key if isinstance(spec.field(k).dataType, T.DateType)]
        date_col = date_keys[0] if spec.partition_by and date_keys else None
        rows, max_n = batch_key_stats(incoming, spec.primary_key)
        if rows == 0:
            return 0
        if max_n > 1:
            raise ValueError(f"{spec.name}: duplicate primary key in incoming rows")
        entry = self._latest(spec.name)
        commit = self._next(entry)[1]
        if date_col is None:
            merged = upsert(self.read(spec), incoming, spec)
            n = counted(merged, lambda df: df.write.mode("errorifexists").parquet(f"{self.path(spec.name)}/{SNAPSHOT}={commit}"))
            self._commit(spec.name, entry, commit, n, spec.schema, came=spec.columns)
            return rows
        months = months_of(month_key(date_col), incoming)
        stored = None if entry is None else self._read_table(spec, entry, months)
        before = 0 if stored is None else stored.count()
        n = self._write_months(f"{self.path(spec.name)}/{COMMIT}={commit}", upsert(stored, incoming, spec), month_key(date_col),
                               list(spec.primary_key))
        if self.keeps_coverage(spec):
            self._write_coverage(spec, commit, months)
        total = (entry["rows"] if entry else 0) - before + n
        self._commit(spec.name, entry, commit, total, spec.schema, self._by_month(entry) | {m: [commit] for m in months},
                     came=spec.columns)
        return rows

    def merge_raw(
        self,
        name: str,
        incoming: DataFrame,
        keys=None,
        ordinal: str | None = None,
        date_col: str | None = None,
        sort_by=None,
    ) -> int:
        """S7 on disk: keep-latest merge of incoming rows over the raw store;
        returns the merged store's row count. An empty batch leaves the store
        alone and returns its count. ``keys`` defaults to (trade_date,
        instrument_id); ``sort_by`` (file layout only) defaults to the keys.
        Among incoming rows of a key the greatest ``ordinal`` wins; without
        one, the last that landed if the rows know it (landing scans), else
        the greatest row (:func:`merge_keep_latest`).

        With ``date_col`` (a DATE or text key) the store is month-partitioned
        and only the batch is written. Otherwise a new snapshot is written.
        Rows are sorted by key within each file (layout only, O1).
        """
        keys = list(keys or DEFAULT_RAW_KEYS)
        order = list(sort_by or keys)
        entry = self._latest(name)
        incoming = incoming.drop(LAND_MONTH)
        if incoming.isEmpty():
            return 0 if entry is None else entry["rows"]
        came = incoming.drop(ARRIVAL).columns
        commit = self._next(entry)[1]
        if date_col is not None:
            return self._merge_raw_months(name, entry, commit, incoming, keys, ordinal, date_col, order, came)
        merged = merge_keep_latest(self.read_raw(name), incoming, keys, ordinal)
        n = counted(merged.repartitionByRange(*order).sortWithinPartitions(*order),
                    lambda df: df.write.mode("errorifexists").parquet(f"{self.path(name)}/{SNAPSHOT}={commit}"))
        self._commit(name, entry, commit, n, merged.schema, keys=keys, came=came)
        return n

    def _merge_raw_months(self, name: str, entry, commit: str, incoming: DataFrame, keys, ordinal, date_col, order, came) -> int:
        landed = incoming.drop(ARRIVAL).schema
        schema, total = landed, 0
        if entry is not None:
            old = T.StructType.fromJson(json.loads(entry["schema"]))
            schema, total = relaxed_schema(self.spark, old, landed), entry["rows"]
            if any(schema[f.name].dataType != f.dataType for f in old.fields):  # a type widens: all months once more
                self._rewrite(name, entry, set(self._by_month(entry)), schema, date_col, order)
                entry = self._latest(name)
                commit = self._next(entry)[1]
        latest = merge_keep_latest(None, cast_to(incoming, schema, keep=(ARRIVAL,)), keys, ordinal).checkpoint(eager=True)
        month = month_key(_as_date(latest, date_col))
        months = months_of(month, latest)
        stored = None if entry is None else self._read_raw_months(name, entry, months)
        known = 0 if stored is None else same_keys(latest, stored.select(*keys), keys, "left_semi").count()
        total += self._write_months(f"{self.path(name)}/{COMMIT}={commit}", latest, month, order) - known
        by_month = self._by_month(entry)
        by_month |= {m: [*by_month.get(m, []), commit] for m in months}
        self._commit(name, entry, commit, total, schema, by_month, keys, came)
        self.compact(name, date_col, order, MOST_DELTAS)
        return total

    def compact(self, name: str, date_col: str, sort_by, most: int = 1) -> int:
        """Fold the deltas of a raw store's months that have more than ``most``
        directories into one; the number of such months. Rows stay the same."""
        entry = self._latest(name)
        months = {m for m, own in self._by_month(entry).items() if len(own) > most}
        if months:
            self._rewrite(name, entry, months, T.StructType.fromJson(json.loads(entry["schema"])), date_col, list(sort_by))
        return len(months)

    def _rewrite(self, name: str, entry, months: set, schema: T.StructType, date_col: str, order) -> None:
        """Some months of a raw store written once more, merged, in ``schema``'s types."""
        commit = self._next(entry)[1]
        rows = cast_to(self._read_raw_months(name, entry, months), schema)
        self._write_months(f"{self.path(name)}/{COMMIT}={commit}", rows, month_key(_as_date(rows, date_col)), order)
        self._commit(name, entry, commit, entry["rows"], schema, self._by_month(entry) | {m: [commit] for m in months}, entry["keys"])

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        """Append-only metadata rows (audit events)."""
        rows.select(*spec.columns).write.mode("append").parquet(self.path(spec.name))

    def read_appended(self, spec: TableSpec) -> DataFrame | None:
        df = self._read_parquet(self.path(spec.name), schema=spec.schema)
        return None if df is None else align_to_spec(df, spec)


def _as_date(df: DataFrame, col: str):
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return c.cast(T.DateType())
    return lenient_date(c, dtype)
