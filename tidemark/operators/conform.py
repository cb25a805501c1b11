"""Schema conformance.

``conform`` is one ``select`` of per-column expressions built from the table's
``StructType``: present columns are cast leniently, absent ones become typed
nulls, extra vendor columns are dropped and the model order is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import lenient_date, lenient_timestamp
from tidemark.functions.numeric import to_double
from tidemark.schema import TableSpec


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def lenient_cast(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that yields null instead of failing (ANSI-safe ``try_cast``)."""
    if isinstance(target, T.DateType):
        return lenient_date(col, source)
    if isinstance(target, T.TimestampNTZType):
        return lenient_timestamp(col, source)
    if isinstance(source, T.NullType):
        return F.lit(None).cast(target)
    if source == target:
        return col
    if isinstance(target, T.DoubleType):
        return to_double(col, source)
    return col.try_cast(target)


def conform(df: DataFrame, spec: TableSpec, fill_missing: bool = False) -> DataFrame:
    """Conform a frame to a table model.

    Missing optional column -> typed null; missing required column ->
    ``ValueError`` (unless ``fill_missing``, the loader behaviour of C2, in
    which case the constraint check C5 rejects the nulls instead).
    """
    source_types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for field in spec.schema.fields:
        if field.name in source_types:
            expr = lenient_cast(_q(field.name), source_types[field.name], field.dataType)
        elif field.nullable or fill_missing:
            expr = F.lit(None).cast(field.dataType)
        else:
            raise ValueError(f"{spec.name} missing required column: {field.name}")
        exprs.append(expr.alias(field.name))
    return df.select(*exprs)


def guard_required(df: DataFrame, spec: TableSpec) -> DataFrame:
    """C5 (nulls): required columns must be non-null.

    Each required column is wrapped in ``raise_error`` so a null fails the
    write task itself; the job's commit never happens and nothing is written.
    """
    required = set(spec.required)
    exprs = []
    for name in df.columns:
        c = _q(name)
        if name in required:
            msg = f"{spec.name}: NOT NULL constraint failed on column {name}"
            c = F.when(c.isNull(), F.raise_error(F.lit(msg))).otherwise(c)
        exprs.append(c.alias(name))
    return df.select(*exprs)


def key_violations(df: DataFrame, keys) -> DataFrame:
    """C5 (key): keys that occur more than once, with their counts.

    A partial (map-side) aggregate, so a hot key is pre-counted per task.
    """
    keys = list(keys)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
