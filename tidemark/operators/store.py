"""Frame-level store operators: relaxed union (U1), keep-latest (N3/S7),
keyed upsert (S10) and align-on-read (S9).

All of them are lazy ``DataFrame -> DataFrame`` functions; writing is the
job layer's business (:mod:`tidemark.sources.tables`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import TableSpec

# Arrival order of landed rows, and the month that a landing zone lays them out by; raw stores keep neither.
ARRIVAL, LAND_MONTH = "_arrival", "land_month"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- U1 ----------

def relaxed_union(*frames: DataFrame) -> DataFrame:
    """Union by name; absent columns -> null; differing types -> supertype.

    Spark's own widening handles numeric/temporal mixes. A column that is text
    in one frame and something else in another becomes text everywhere (Spark
    alone would pick the non-text side and then fail on the text values).
    """
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("relaxed_union needs at least one frame")
    types: dict[str, set] = {}
    for f in frames:
        for field in f.schema.fields:
            types.setdefault(field.name, set()).add(type(field.dataType))
    as_text = {
        name for name, ts in types.items()
        if T.StringType in ts and len(ts - {T.StringType, T.NullType}) > 0
    }
    # A flag that is a number elsewhere becomes a whole number (true -> 1);
    # Spark then widens it with the other numeric types.
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
               T.DecimalType)
    flag_as_number = {
        name for name, ts in types.items()
        if name not in as_text and T.BooleanType in ts and any(issubclass(t, numeric) for t in ts)
    }

    def fix(f: DataFrame) -> DataFrame:
        kinds = {x.name: type(x.dataType) for x in f.schema.fields}
        if not as_text.intersection(f.columns) and not any(
                kinds[c] is T.BooleanType for c in flag_as_number.intersection(f.columns)):
            return f

        def one(c: str) -> Column:
            if c in as_text:
                return _q(c).cast(T.StringType())
            if c in flag_as_number and kinds[c] is T.BooleanType:
                return _q(c).cast(T.LongType())
            return _q(c)

        return f.select(*[one(c).alias(c) for c in f.columns])

    fixed = [fix(f) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fixed)


def relaxed_schema(spark: SparkSession, *schemas: T.StructType) -> T.StructType:
    """U1 over schemas alone."""
    return relaxed_union(*[spark.createDataFrame([], s) for s in schemas]).schema


def cast_to(df: DataFrame, schema: T.StructType, keep=()) -> DataFrame:
    """``df`` with the columns and types of a schema that is at least as wide;
    columns it lacks are null. Columns in ``keep`` stay beside them."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def one(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType)
        return _q(f.name) if have[f.name] == f.dataType else _q(f.name).cast(f.dataType)

    return df.select(*[one(f).alias(f.name) for f in schema.fields], *[_q(c) for c in keep if c in have])


# ---------------------------------------------------------------- N3 / S7 -----

def keep_latest(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the row with the greatest ``order`` wins whole.

    Null keys are one group (``groupBy`` semantics). Implemented as a
    ``max_by`` aggregate rather than a ``row_number`` window so that Spark
    combines map-side: a key holding a third of all rows is reduced inside
    each map task before the shuffle instead of landing in one reducer.
    ``order`` columns must make the winner unique (pass an ordinal).
    """
    keys = list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    order_cols = [_q(o) if isinstance(o, str) else o for o in order]
    row = F.struct(*[_q(c) for c in df.columns])
    return (
        df.groupBy(*[_q(k) for k in keys])
        .agg(F.max_by(row, F.struct(*order_cols)).alias("_row"))
        .select("_row.*")
    )


def merge_keep_latest(
    stored: DataFrame | None,
    incoming: DataFrame,
    keys,
    ordinal: str | None = None,
) -> DataFrame:
    """Merge incoming rows over a stored keep-latest store.

    Incoming rows beat stored rows for the same key (whole row, no column
    merge); among incoming rows the greatest ``ordinal`` wins. Spark has no
    row order, so the caller names the arrival order: a column, or ``_arrival``
    as landing scans give it (not kept). Without one the greatest row by all
    its columns wins, so the result doesn't hang on partitioning. Stored rows
    are unique per key already, so only the incoming side is deduplicated; the
    stored side is kept by a null-safe anti join (null keys equal each other,
    as in the keep-latest rule).
    """
    keys = list(keys)
    arrival = ARRIVAL in incoming.columns
    if ordinal is None:
        ordinal = [ARRIVAL] if arrival else incoming.columns
    latest = keep_latest(incoming, keys, ordinal).drop(ARRIVAL)
    if stored is None:
        return latest
    # ``latest`` has one row per key already (grouped on the keys): no distinct.
    return relaxed_union(same_keys(stored, latest, keys, "left_anti"), latest)


def same_keys(rows: DataFrame, others: DataFrame, keys, how: str) -> DataFrame:
    """``rows`` whose key is (``left_semi``) or isn't (``left_anti``) among those of ``others``; null keys equal each other."""
    named = others.select(*[_q(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    cond = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(named[f"_k{i}"]) for i, k in enumerate(keys)])
    return rows.join(named, cond, how)


# ---------------------------------------------------------------- S10 ---------

def check_upsert_columns(incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """S10 column contract: the table's columns in its order, no others; a
    batch without all of them is a ValueError that names the rest, sorted."""
    absent = sorted(c for c in spec.columns if c not in incoming.columns)
    if absent:
        raise ValueError(f"batch for {spec.name} lacks columns {absent}")
    return incoming.select(*map(_q, spec.columns))


def upsert(stored: DataFrame | None, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """Stored rows whose key is not in incoming, plus all incoming rows.

    A plain-equality ``left_anti`` (the delete's ``EXISTS`` turned around):
    stored null keys never match and stay.
    """
    incoming = check_upsert_columns(incoming, spec)
    if stored is None:
        return incoming
    stored = stored.select(*[_q(c) for c in spec.columns])
    keys = list(spec.primary_key)
    kept = stored.join(incoming.select(*keys), keys, "left_anti")
    return kept.unionByName(incoming)


def upsert_once(stored: DataFrame, incoming: DataFrame, spec: TableSpec, dealt_by=()) -> DataFrame:
    """:func:`upsert` for a batch that is still to be computed: an anti join
    needs it as keys and as rows, so Spark would compute it twice. Here both
    sides meet in one shuffle on the key. Stored rows with a null in their key
    stay, so these rows are dealt by all their columns.

    ``dealt_by``: functions of the key by which the batch's rows are dealt out
    already. Stored rows are dealt likewise, and the batch isn't shuffled."""
    new, replaced = "_is_incoming", "_is_replaced"
    cols, keys = [_q(c) for c in spec.columns], [_q(k) for k in spec.primary_key]
    incoming = check_upsert_columns(incoming, spec)
    nameless = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    if not dealt_by:
        both = stored.select(*cols).withColumn(new, F.lit(False)).unionByName(incoming.withColumn(new, F.lit(True)))
        same_key = Window.partitionBy(*keys, F.when(nameless, F.xxhash64(*cols)))
        return (both.withColumn(replaced, F.max(new).over(same_key))
                .where(F.col(new) | ~F.col(replaced) | nameless).select(*cols))
    # A union is known to be dealt as both of its sides are, if one way only
    # names it: so key and row are one column each beside what deals them.
    by = [f"_by{i}" for i in range(len(dealt_by))]
    dealt = [c.alias(name) for c, name in zip(dealt_by, by, strict=True)]
    row = [F.struct(*keys).alias("_key"), F.struct(*cols).alias("_row"), nameless.alias("_is_nameless")]
    both = (stored.repartition(*dealt_by).select(*dealt, *row, F.lit(False).alias(new))
            .unionByName(incoming.select(*dealt, *row, F.lit(True).alias(new))))
    return (both.withColumn(replaced, F.max(new).over(Window.partitionBy(*by, "_key")))
            .where(F.col(new) | ~F.col(replaced) | F.col("_is_nameless")).select("_row.*"))


# ---------------------------------------------------------------- S9 ----------

def align_to_spec(df: DataFrame, spec: TableSpec, keep_extra: bool = False) -> DataFrame:
    """Additive schema sync on read — registered columns absent from the
    stored files come back as typed nulls; nothing is dropped or retyped."""
    present = set(df.columns)
    exprs = [
        (_q(f.name) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in spec.schema.fields
    ]
    if keep_extra:
        exprs += [_q(c) for c in df.columns if c not in set(spec.columns)]
    return df.select(*exprs)
