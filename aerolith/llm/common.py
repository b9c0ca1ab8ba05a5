"""Shared helpers: reading tables, folds, Arrow batches, written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.session import fresh_path

BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder_is(id_col: str, modulus: int, remainder: int) -> Column:
    """True where crc32(id as text) mod modulus is remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def learnable(id_col: str, modulus: int, held_remainder: int) -> Column:
    """True for ids outside the held-out fold; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus != held_remainder, F.lit(False))


def hash_sample(df: DataFrame, key: Column, wanted: int, total: int, seed: int = 17) -> DataFrame:
    """About `wanted` of `total` rows, the same ones in every run (a share of the key's hash range)."""
    share = 1.0 if total <= wanted else wanted / total
    steps = 1 << 40
    return df.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(steps)) < int(share * steps))


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about `limit` bytes together, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return batch.column(column).fill_null("").to_pylist()


def add_columns(
    df: DataFrame,
    text_col: str,
    fields: list[tuple[str, str]],
    make: Callable[[], Callable[[list[str]], list]],
) -> DataFrame:
    """df with columns computed from its texts, in Arrow batches, without a shuffle.

    make() is called once in each task and returns a function from a list of
    texts to one list (or Arrow array) per field. A column of df with the name
    of a field, in any case, is replaced.
    """
    names = [n for n, _ in fields]
    lower = {n.lower() for n in names}
    base = df.select(*[c for c in df.columns if c.lower() not in lower or c == text_col])
    kept = [f for f in base.schema.fields if f.name.lower() not in lower]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in kept])
    for f in T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in fields)).fields:
        schema = schema.add(f)
    kept_names = [f.name for f in kept]
    kinds = [arrow_type(schema[n].dataType) for n in names]

    def run(batches):
        compute = make()
        for batch in batches:
            for part in slices(batch, text_col):
                made = compute(texts_of(part, text_col))
                arrays = [m if isinstance(m, pa.Array) else pa.array(m, type=k) for m, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in kept_names] + arrays, names=kept_names + names
                )

    return base.mapInArrow(run, schema)


def unused_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that df does not use, whatever the case; each begins with an underscore and the wanted name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def kept_in_worker(key: tuple, make: Callable[[], object]) -> object:
    """make()'s result, made once in each Python worker process and kept for its later tasks.

    Functions travel with their code, so globals of a module do not outlive a task; an entry of sys.modules does.
    """
    import sys
    from types import ModuleType

    held = sys.modules.setdefault("_kept_in_worker", ModuleType("_kept_in_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder and read again.

    Cuts the lineage in a place that outlives executors; both readers of a
    written table see the same rows.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
