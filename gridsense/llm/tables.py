"""Reading the tables, and intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsense.llm.words import BUFFER
from gridsense.session import new_work_path


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts the
    lineage and outlives lost executors."""
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text, mod 3, is 1.
    A null id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def as_long(x: np.ndarray) -> np.ndarray:
    """The bits of unsigned 64-bit values as Spark longs."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def give_back() -> None:
    """Return memory that is free but still held to the machine: the workers of
    an executor share its limit, and they outlive a stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def arrow_slices(texts: pa.Array, size: int = 2 * BUFFER):
    """Slices of an array of texts of about ``size`` bytes (one text at least)."""
    ends = np.append(0, np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield slice(at, end)
        at = end


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
          "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
          "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}


def map_rows(df: DataFrame, values: list[Column | str], carry: list[str], make, new: dict[str, str],
             size: int = 2 * BUFFER) -> DataFrame:
    """Row-wise Python work: ``carry`` columns as they are, then ``new`` columns.

    A value ``column.field`` of a carried struct is taken from it, not sent twice.
    ``make()`` gives, once per task, a function from the lists of ``values``
    (the first is the text that sizes a call) to the new columns. ``carry``
    columns of any type pass through as Arrow arrays, nulls and all.
    """
    k = len(carry)
    inner = {i: v.split(".", 1) for i, v in enumerate(values) if isinstance(v, str)}
    sent = [i for i in range(len(values)) if i not in inner]
    places = [(carry.index(inner[i][0]), inner[i][1]) if i in inner else (k + sent.index(i), None)
              for i in range(len(values))]
    source = df.select(*carry, *[values[i].alias(f"__v{i}") for i in sent])
    names, types = [*carry, *new], [_ARROW[t] for t in new.values()]

    def run(batches):
        work = make()
        for b in batches:
            taken = [b.column(i) if field is None else b.column(i).field(field) for i, field in places]
            for part in arrow_slices(taken[0], size):
                cols = work(*[v[part].to_pylist() for v in taken])
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(part.start, part.stop - part.start) for i in range(k)]
                    + [c if isinstance(c, pa.Array) else pa.array(c, t, from_pandas=False)
                       for c, t in zip(cols, types)], names)
            del b, taken
            give_back()

    fields = [df.schema[c] for c in carry] + [T.StructField(c, T.DataType.fromDDL(t)) for c, t in new.items()]
    return source.mapInArrow(run, T.StructType(fields))


def whole_rows(df: DataFrame, *cols: str) -> DataFrame:
    """``__row``, a struct of all columns, besides ``cols``: to carry rows
    through an operator whatever their columns are called."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), *cols)
