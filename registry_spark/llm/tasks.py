"""What the operators of this subpackage share: code on the executors, Arrow batches, row keys."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# A word is a run of characters other than these; Python's bytes.split() without
# arguments cuts at exactly the same six.
SPACE = r"[\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application; Spark sends the archive to them."""
    sc = spark.sparkContext
    if not getattr(sc, "_registry_spark_shipped", False):
        archive = os.path.join(tempfile.mkdtemp(prefix="registry-code-"), "registry_spark.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(PACKAGE):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
        sc.addPyFile(archive)
        sc._registry_spark_shipped = True
    return spark


def arrow(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run a generator of record batches over every batch of ``df``."""
    ship(df.sparkSession)

    module = function.__module__

    def run(batches):
        begin(module)
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes; NULL is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunked(batch: pa.RecordBatch, name: str = "text", size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes of text, one row at least, so that work space stays bounded."""
    column = batch.column(batch.schema.get_field_index(name))
    lengths = np.array([x or 0 for x in pc.binary_length(column).to_pylist()], np.int64)
    part = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the identifier's text modulo ``parts``; a NULL identifier counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def segments(lengths: np.ndarray) -> np.ndarray:
    """Start of each segment of the given lengths, and the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each segment; empty segments give 0."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, dtype=np.float64, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one after the other."""
    bounds = segments(lengths)
    return np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])


_LOADED: dict[str, tuple[str, object, str]] = {}


def begin(module: str) -> None:
    """At the start of a task: let go of what other modules keep in this worker, and give freed memory back.

    What a worker holds thus does not add up over the steps of a pipeline, also over steps that keep nothing.
    """
    others = [k for k, (_, _, owner) in _LOADED.items() if owner != module]
    for kind in others:
        del _LOADED[kind]
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def loaded(kind: str, key: str, make: Callable[[], object]):
    """The worker process's object of a kind, kept between tasks of the module that makes it; another key replaces it."""
    if kind in _LOADED and _LOADED[kind][0] != key:
        del _LOADED[kind]
    if kind not in _LOADED:
        _LOADED[kind] = (key, make(), make.__module__)
    return _LOADED[kind][1]


class Numbers(dict):
    """Numbers distinct keys in the order they are met; keys since the last look are in ``pending``."""

    def __init__(self):
        self.pending: list = []

    def __missing__(self, key):
        number = self[key] = len(self)
        self.pending.append(key)
        return number

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def new(self) -> list:
        found, self.pending = self.pending, []
        return found


def numbered_words(texts: list[bytes], numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words of all texts in one array, and where each text begins."""
    found = [numbers.of(t.split()) for t in texts]
    bounds = segments(np.fromiter(map(len, found), np.int64, len(found)))
    return np.concatenate(found) if found else np.zeros(0, np.int64), bounds
