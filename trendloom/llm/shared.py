"""Helpers of the training-data operators: reading a table, batches of bounded size, stored steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.operators.settle import settle

#: ASCII upper case to lower case, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Rows of one Arrow batch at most; a batch then holds a few MB of ordinary documents.
BATCH_ROWS = 512
#: Tasks over which the rows of one key of a join are dealt.
SALTS = 16

_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches short, so that a run of long texts stays within a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame) -> DataFrame:
    """The same rows from the shared folder: no later step, and no lost executor, repeats the work."""
    return settle(df)[0]


def salted(
    rows: DataFrame, table: DataFrame, same: Callable[[DataFrame, DataFrame], Column], spread: Column, ways: int = SALTS
) -> DataFrame:
    """Inner join of ``rows`` with a narrow ``table`` of one row per key: each key is copied ``ways`` times,
    and the rows of a hot key go to ``ways`` tasks by ``spread``. Spark broadcasts the table if it is small.
    """
    dealt = rows.withColumn("_salt", F.pmod(spread, F.lit(ways)).cast("int"))
    copied = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return dealt.join(copied, same(dealt, copied) & (dealt["_salt"] == copied["_copy"])).drop("_salt", "_copy")


def words(text: str | None) -> list[bytes]:
    """Words between white space (space and the bytes 9 to 13), A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def by_bytes(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Group batches until they hold about ``most`` bytes; one long batch stands alone."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads 64-bit values evenly."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_int(x: int) -> int:
    """:func:`mix` of one Python integer."""
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)
