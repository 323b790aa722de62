"""What the operators share: shipping this package, text batches, label folds, hashing."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what separates words, here and in every contract of this package.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = f"[^{SPACE_CLASS}]+"

#: Text handled at once inside a task, in characters; bounds the Python memory of a task.
SLICE_CHARS = 1 << 21

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on every executor, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "bulkflow.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                z.write(file, os.path.relpath(file, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str, *also: Column) -> DataFrame:
    """Only the id, the text and ``also``, under names of our own; a null text is an empty one.

    Extra columns are left behind before anything else happens, so their names cannot clash.
    """
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *also)


def unused(name: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_training_fold(id_column: Column) -> Column:
    """Whether labels of this row may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return held_out(id_column) == F.lit(False)


def held_out(id_column: Column) -> Column:
    """A null id counts as held out, so nothing is learnt from it."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(True))


def text_slices(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """The texts of an Arrow array as Python lists of about ``chars`` characters, in order."""
    lengths = np.diff(_offsets(texts)) if len(texts) else np.zeros(0, np.int64)
    start = 0
    while start < len(texts):
        end = start + max(1, int(np.searchsorted(np.cumsum(lengths[start:]), chars)))
        yield [t or "" for t in texts.slice(start, end - start).to_pylist()]
        start = end


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one run of UTF-8 bytes, and where each begins (one more entry for the end)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(texts)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))
