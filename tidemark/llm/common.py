"""What the operators share: reading, cutting lineage, hashing words."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: Java and Python regex for a run of the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object of this package's own classes, pickled by value:
    executors need no copy of the package to read it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Files of a query's shuffles are removed when it ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidied(spark: SparkSession, tidy: bool = True) -> Iterator[None]:
    """Within it, the files of a query's shuffles are removed as soon as it ends."""
    before = spark.conf.get(TIDY, None)
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        if tidy:
            spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def step_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/step-{uuid.uuid4().hex}"


def materialize(df: DataFrame, rows_a_file: int = 0, tidy: bool = False, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back. Cuts the lineage: a lost executor costs only the tasks it ran, and
    later steps neither recompute nor renumber the rows. The folder is the
    cluster's scratch space; the files stay until the cluster clears it, or
    :func:`remove` does, if ``folder`` names them. Large rows can be written a
    few to a file, so that no task reads many at once. ``tidy`` removes the
    files of the shuffles before as soon as all is written."""
    spark = df.sparkSession
    path = folder or step_folder(spark)
    with tidied(spark, tidy):
        df.write.option("maxRecordsPerFile", rows_a_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a step's files, once all that reads them is written itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores after it: one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of as many rows as have ``most`` bytes in ``column``, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(size, most + (size[at - 1] if at else 0), "right")))
        yield batch.slice(at, upto - at)
        at = upto


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def utf8(text: Column) -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (two multiply-xorshift steps)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """One 64-bit hash for each run of ``length`` consecutive word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(length):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n]
            out ^= out >> np.uint64(29)
        return mix(out)
