"""Helpers that several corpus operators share: columns, folds, word bytes, window hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def carried(df: DataFrame, carry: Sequence[str] | None, made: Sequence[str]) -> list[str]:
    """Columns that go through an operator; one that the operator makes itself is replaced."""
    names = df.columns if carry is None else list(carry)
    return [name for name in names if name not in set(made)]


def unused(df: DataFrame, name: str) -> str:
    """A name for a helper column that no column of df has."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def schema_of(df: DataFrame, names: Sequence[str], made: str) -> T.StructType:
    """The types of `names` in df, followed by the columns declared in `made`."""
    kinds = {field.name: field for field in df.schema.fields}
    return T.StructType([kinds[name] for name in names] + T._parse_datatype_string(made).fields)


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.large_binary()).to_pylist()


def beside(batch: pa.RecordBatch, names: Sequence[str], made: dict[str, pa.Array]) -> pa.RecordBatch:
    """The named columns of a batch, followed by new ones."""
    kept = [batch.column(batch.schema.get_field_index(name)) for name in names]
    return pa.RecordBatch.from_arrays([*kept, *made.values()], names=[*names, *made])


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prefix(df: DataFrame, names: Sequence[str], text: str, alias: str = "_text") -> DataFrame:
    """Only the carried columns and the text, under a name no table uses."""
    return df.select(*[quoted(n) for n in names], quoted(text).cast("string").alias(alias))


def carried_text(df: DataFrame, names: Sequence[str], text: str) -> tuple[DataFrame, str]:
    """The same, but a text that is carried anyway is sent once; and the name it has.

    Texts are long rows: where the caller has left Spark's usual 10,000 rows a batch, fewer
    are sent at a time, so that a worker's memory does not follow the length of texts.
    """
    if df.sparkSession.conf.get(BATCH_ROWS) == "10000":
        df.sparkSession.conf.set(BATCH_ROWS, "2000")
    if text in names and isinstance(df.schema[text].dataType, T.StringType):
        return prefix(df, names, text).drop("_text"), text
    return prefix(df, names, text), "_text"


class Numbered(dict):
    """Numbers for keys in the order they are met."""

    def __missing__(self, key) -> int:
        row = self[key] = len(self)
        return row

    def rows(self, keys: Sequence) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class WordHashes(dict):
    """64-bit hashes of words, remembered for the words of one task up to a fixed number."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every `size` consecutive words, in the order of their first words.

    A polynomial modulo 2**64 over the word hashes, from running sums; equal windows have
    equal hashes wherever they stand.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.add.accumulate(hashes * _powers(_INVERSE, len(hashes)))))
    return mixed((sums[size:] - sums[:n]) * _powers(_BASE, n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values, in a logarithmic number of steps."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def batches(rows: Iterator[pa.RecordBatch], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to about `most` bytes; a single longer row stays whole."""
    for batch in rows:
        parts = max(1, -(-batch.nbytes // most))
        step = max(1, -(-batch.num_rows // parts))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def runs(rows: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree on `keys`, from a sorted stream of batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in rows:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = last is None or any(c[0] != x for c, x in zip(columns, last, strict=True))
        cuts = np.flatnonzero(change)
        if held and (not len(cuts) or cuts[0] > 0):
            held.append(batch.slice(0, int(cuts[0]) if len(cuts) else batch.num_rows))
        for at, to in zip(cuts, np.append(cuts[1:], batch.num_rows)[: len(cuts)], strict=True):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(int(at), int(to - at))]
        last = [c[-1] for c in columns]
    if held:
        yield pa.Table.from_batches(held)
