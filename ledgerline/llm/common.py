"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline-{what}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, what: str, into: str | None = None) -> DataFrame:
    """Write once to the shared folder (or a ``scratch`` folder there) and read back: cuts lineage,
    survives lost executors."""
    spark = df.sparkSession
    path = f"{into}/{what}-{uuid.uuid4().hex[:12]}" if into else scratch(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a ``scratch`` folder once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of frames that are gone when the driver's JVM collects its
    garbage, which may be long after; this does it now."""
    gc.collect()
    spark._jvm.System.gc()


_held: list[tuple[str, Callable[[], None]]] = []


def held(function: Callable) -> Callable:
    """Keep a function's last result in a worker, until a task of another module runs there: Spark
    reuses workers, and they would otherwise hold the caches of all operators they have run."""
    kept = functools.lru_cache(maxsize=1)(function)
    _held.append((function.__module__, kept.cache_clear))
    return kept


def _let_go(module: str) -> None:
    for owner, clear in _held:
        if owner != module:
            clear()


def _give_back(lent=()) -> None:
    """Let go the values of broadcasts, which idle workers would otherwise keep beside those that
    run (``value`` reads the executor's file again), and return free memory to the system."""
    for broadcast in lent:
        if getattr(broadcast, "_path", None):
            vars(broadcast).pop("_value", None)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def per_batch(df: DataFrame, schema: str,
              make: Callable[[], Callable[[pa.RecordBatch], dict | Iterator[dict] | None]],
              finish: str | None = None, owner: str | None = None, lent: tuple = ()) -> DataFrame:
    """Map Arrow batches through ``make()``, called once a task; it returns a function
    from a batch to a dict of columns, or to several in turn.  ``finish`` names a method called at the end.  What other
    modules than ``owner`` (that of ``make``) have ``held`` in the worker goes first; ``lent``
    broadcasts are read for a task and go with it."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))
    owner = owner or make.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go(owner)
        _give_back()
        try:
            yield from mapped(make(), batches)
        finally:
            _give_back(lent)

    def mapped(work, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cols = work(batch)
                for part in (cols,) if isinstance(cols, dict) else cols or ():
                    yield _batch(part, out)
        if finish is not None:
            cols = getattr(work, finish)()
            if cols is not None:
                yield _batch(cols, out)

    return df.mapInArrow(run, schema)


def stream(df: DataFrame, schema: str, make: Callable[[], object]) -> DataFrame:
    """Map each partition's Arrow batches, in order, through one ``make()``: its ``batch(batch)``
    and, at the end, ``rest()`` yield dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for cols in work.batch(batch):
                yield _batch(cols, out)
        for cols in work.rest():
            yield _batch(cols, out)

    return df.mapInArrow(run, schema)


def _batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := cols[f.name], pa.Array) else pa.array(c, type=f.type, from_pandas=False)
         for f in schema], schema=schema)


def quoted(names) -> list[str]:
    return [f"`{n}`" for n in names]


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it if the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def beside(df: DataFrame, text_col: str, keep: tuple[str, ...], new: list[tuple[str, str]],
           make: Callable[[], Callable[[pa.Array], list[list]]], lent: tuple = ()) -> DataFrame:
    """``keep`` columns and new ones that a task's function makes from the text column.
    Inside, columns go by number, so no name can clash."""
    src = df.select(F.col(f"`{text_col}`").alias("t"),
                    *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[1:]]
                       + [f"n{i} {kind}" for i, (_, kind) in enumerate(new)])

    def start():
        work = make()

        def run(batch: pa.RecordBatch) -> dict:
            out = {f"k{i}": batch.column(1 + i) for i in range(len(keep))}
            return out | {f"n{i}": col for i, col in enumerate(work(batch.column(0)))}

        return run

    return per_batch(src, schema, start, owner=make.__module__, lent=lent).toDF(*keep, *[name for name, _ in new])


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; LEDGERLINE_TOKENIZERS overrides the folder."""
    folder = os.environ.get("LEDGERLINE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


class Memo(dict):
    """A cache of at most ``limit`` entries; it starts anew when full, so memory is bounded."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def put(self, key, value):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value
