"""What the operators share: reading, stored intermediates, batches of text as bytes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspan.sources.scratch import shared_folder

#: Bytes of text that a task turns into arrays at a time (a longer text is taken alone).
CHUNK_BYTES = 512 << 10


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package's code to the Python workers of all executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}-code.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in package.rglob("*.py"):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def map_arrow(df: DataFrame, run: Callable, ddl: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, ddl)


def extended(df: DataFrame, added: str, text: str, setup: Callable) -> DataFrame:
    """All rows and columns of ``df`` with the columns ``added`` (a schema text) behind them.

    ``setup()`` runs once per task and returns a function from a batch with at
    most ``CHUNK_BYTES`` of ``text`` (or one row) to the added columns' values.
    Columns of ``df`` that bear an added name are replaced.
    """
    fields = T.StructType.fromDDL(added)
    base = without(df, fields.names)
    new = arrow(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = setup()
        for batch in chunks(batches, text):
            more = [
                v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip(made(batch), new, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *more], schema=pa.schema([*batch.schema, *new], metadata=batch.schema.metadata)
            )

    return map_arrow(base, run, T.StructType([*base.schema, *fields]))


class Scratch:
    """Intermediate tables of one run, in the folder that all executors share.

    ``table`` computes a DataFrame once, stores it and reads it back, so later
    jobs neither repeat the work nor depend on one executor's disk. Leaving the
    ``with`` block deletes every table but those stored with ``keep=True``.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._tables: dict[str, bool] = {}
        self._made = 0

    def path(self, name: str, keep: bool = False) -> str:
        self._made += 1
        path = f"{self.root}/{self._made}-{name}"
        self._tables[path] = keep
        return path

    def table(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = self.path(name, keep)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def turn(self, df: DataFrame, name: str, before: str | None) -> tuple[DataFrame, str]:
        """Store a pass over a table that is too large to keep twice: the pass ``before`` is deleted once this one stands.

        The last pass stays, for the result that reads it.
        """
        path = self.path(name, keep=True)
        df.write.parquet(path)
        if before:
            self._delete(before)
            self._tables.pop(before)
        return self.spark.read.schema(df.schema).parquet(path), path

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path, keep in self._tables.items():
            if not keep:
                self._delete(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns of these names, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def aliased(df: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``df`` under column names that clash with none, the new name of each column, and the way back.

    The way back takes a frame that holds the new columns, and gives those of ``df`` alone.
    """
    names = {c: f"_column_{i}" for i, c in enumerate(df.columns)}
    return (
        df.toDF(*names.values()),
        names,
        lambda out: out.select(*[F.col(new).alias(old) for old, new in names.items()]),
    )


def restored(out: DataFrame, names: dict[str, str], results: list[str]) -> DataFrame:
    """The columns of a frame behind ``aliased`` under their own names, and the results, which replace columns of their name."""
    taken = {r.lower() for r in results}
    own = [F.col(new).alias(old) for old, new in names.items() if old.lower() not in taken]
    return out.select(*own, *[F.col(f"`{r}`") for r in results])


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = np.cumsum(_lengths(batch.column(text)))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column on end, and where each row starts (null: empty)."""
    import pyarrow.compute as pc

    filled = pc.fill_null(pc.cast(column, pa.large_string()), "")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    buffer = filled.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def batch_of(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def arrow(schema: str | object) -> pa.Schema:
    """The Arrow schema of a Spark schema text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)
