"""Shared helpers of the training-data operators.

Conventions of every operator in this subpackage:

* Inputs are selected by column name into internal names, so extra columns,
  whatever they are called, never clash.
* A null text counts as the empty text.  A null id is kept as a row of its own.
* Lineage is cut by writing a Parquet table into the shared folder named by
  ``spark.checkpoint.dir`` (``keep``): each row is computed once, and a lost
  executor re-reads files instead of recomputing the plan above.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, else (unset, as
    in tests) a folder below the SQL warehouse, which executors share too."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    return given or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_llm")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


#: The folder of the tables that go when the step that keeps them ends.
_STEP: ContextVar[str | None] = ContextVar("step", default=None)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    if _STEP.get():
        path = f"{_STEP.get()}/{os.path.basename(path)}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_last(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``keep`` of what ``make`` gives.  The tables that it kept on the way are
    read by nothing else and go, so they take no room in later steps."""
    folder = fresh_path(spark, f"{name}-step")
    try:
        step = _STEP.set(folder)
        try:
            df = make()
        finally:
            _STEP.reset(step)
        return keep(df, name)
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


# --- spans found by regular expressions, JVM-side ---------------------------

def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, wherever and
    however often ``use`` refers to it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(values: Column, block: int = 256) -> Column:
    """Inclusive running sums of an array of ints.  Appending to an array
    copies it, so sums are built in blocks, and the blocks' starts apart: the
    work is linear in the array, up to a constant of about ``block``."""
    none = F.expr("cast(array() as array<int>)")

    def append(acc: Column, x: Column, y: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.array_append(acc["all"], y).alias("all"))

    def state(at: Column) -> Column:
        return F.struct(at.alias("at"), none.alias("all"))

    def inside(values: Column, start: Column) -> Column:
        return F.aggregate(values, state(start), lambda acc, x: append(acc, x, acc["at"] + x), lambda acc: acc["all"])

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x))
        starts = F.aggregate(totals, state(F.lit(0)), lambda acc, t: append(acc, t, acc["at"]), lambda acc: acc["all"])
        return F.flatten(F.zip_with(blocks, starts, inside))

    def cut(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int"))
        return F.when(F.size(v) == 0, none).otherwise(bound(F.transform(numbers, lambda i: F.slice(v, i * block + 1, F.lit(block))), joined))

    return bound(values, cut)


def spans_of(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` (never empty ones) as
    ``array<struct<start,end,hit>>`` in code points, end exclusive.

    ``split`` gives the gaps before, between and after the matches, so match i
    ends at the running sum of the lengths of gaps and matches up to i.
    """
    def placed(hits: Column, gaps: Column) -> Column:
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.length(gap) + F.length(hit))
        return F.zip_with(hits, running_sums(lengths), lambda hit, end: F.struct(
            (end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")
        ))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bound(found, lambda hits: bound(F.split(text, pattern, -1), lambda gaps: placed(hits, gaps)))


def spans_before(spans: Column, name: str, limit: Column, or_equal: bool = False) -> Column:
    """How many ``spans`` (ascending in the field ``name``) lie below
    ``limit`` (at it, too, with ``or_equal``): a binary search.  ``spans`` must
    be a column or a lambda variable, as each step looks at it."""
    def step(acc: Column, _i: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        value = F.get(spans, mid)[name]
        right = (acc["lo"] < acc["hi"]) & ((value <= limit) if or_equal else (value < limit))
        return F.struct(F.when(right, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(right | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    whole = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    return F.when(F.size(spans) == 0, F.lit(0)).otherwise(F.aggregate(steps, whole, step, lambda acc: acc["lo"]))


# --- range assignment by sampled splitters ----------------------------------

def range_of(key: Column, splitters: Column, count: int) -> Column:
    """Number of ``splitters`` (sorted array column of ``count`` values) that
    are <= ``key``: a binary search of ceil(log2) steps, evaluated per row."""
    if count == 0:
        return F.lit(0)
    lo_hi = F.struct(F.lit(0).alias("lo"), F.lit(count).alias("hi"))

    def step(acc: Column, _i: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = (acc["lo"] < acc["hi"]) & (F.get(splitters, mid) <= key)
        done = acc["lo"] >= acc["hi"]
        return F.struct(
            F.when(done, acc["lo"]).when(right, mid + 1).otherwise(acc["lo"]).alias("lo"),
            F.when(done, acc["hi"]).when(right, acc["hi"]).otherwise(mid).alias("hi"),
        )

    steps = F.sequence(F.lit(1), F.lit(int(count).bit_length() + 1))
    return F.aggregate(steps, lo_hi, step, lambda acc: acc["lo"])


# --- vectorised words over Arrow string buffers ------------------------------

#: Words of letters, digits and everything beyond ASCII, on lower-cased bytes.
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True
#: Words between ASCII white space.
GRAPH_WORD = np.ones(256, dtype=bool)
GRAPH_WORD[0x09:0x0E] = GRAPH_WORD[0x20] = False

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
AS_IS = np.arange(256, dtype=np.uint8)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SEGMENT = 1 << 17
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so sums of powers spread over all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for one segment."""
    if not _POWERS:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(_SEGMENT + 1, _BASE, np.uint64), np.full(_SEGMENT + 1, inverse, np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def words_of(raw: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (byte offsets) of the words of ``raw`` bytes."""
    flags = np.empty(len(raw) + 2, dtype=np.int8)
    flags[0] = flags[-1] = 0
    flags[1:-1] = is_word[raw]
    turn = np.flatnonzero(np.diff(flags))
    return turn[0::2], turn[1::2]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = _FOLD) -> np.ndarray:
    """64-bit hash of each word (lower-cased; as it is with ``AS_IS``): a
    polynomial in its bytes from prefix sums.  Bytes are taken in segments of
    fixed size, and the sum of a word that crosses a border is carried on, so
    neither long texts nor long words take more memory."""
    out = np.zeros(len(starts), np.uint64)
    if len(starts):
        up, down = _powers()
        sums = np.zeros(_SEGMENT + 1, np.uint64)
        for low in range(int(starts[0]), int(ends[-1]), _SEGMENT):
            high = min(low + _SEGMENT, int(ends[-1]))
            a, b = np.searchsorted(ends, low, side="right"), np.searchsorted(starts, high, side="left")
            if a == b:
                continue
            np.cumsum((fold[raw[low:high]].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1 : high - low + 1])
            s, e = np.maximum(starts[a:b], low) - low, np.minimum(ends[a:b], high) - low
            part = (sums[e] - sums[s]) * down[s]
            if starts[a] < low:
                part[:1] *= np.uint64(pow(int(_BASE), low - int(starts[a]), 1 << 64))
            out[a:b] += part
    return mix(out)


def text_slices(column, most_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (from row, to row, bytes, row offsets) of an Arrow string
    column, of about ``most_bytes`` each but one text at least."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        to = min(n, to)
        yield at, to, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    pa.default_memory_pool().release_unused()


def words_in_rows(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Words that never cross a row border: starts, ends, and for each row the
    position of its first word (one more entry closes the last row)."""
    starts, ends = words_of(raw, is_word)
    inner = offsets[1:-1]
    if len(inner) and len(starts):  # split the words that cross a border
        hit = np.searchsorted(starts, inner, side="left") - 1
        cut = inner[(hit >= 0) & (ends[np.maximum(hit, 0)] > inner)]
        if len(cut):
            cut = np.unique(cut)
            starts, ends = np.union1d(starts, cut), np.union1d(ends, cut)
    return starts, ends, np.searchsorted(starts, offsets, side="left")


# --- a Bloom filter of fixed size ---------------------------------------------

class Bloom:
    """Two bits a key in ``1 << bits`` bits.  Its size does not grow with the
    data: more keys only let more rows pass to the exact join behind it."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), np.uint64) if words is None else words

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        down = np.uint64(64 - self.bits)
        return keys >> down, mix(keys) >> down

    def add(self, keys: np.ndarray) -> None:
        for place in self._places(keys):
            np.bitwise_or.at(self.words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in self._places(keys):
            found &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
        return found


def bloom_of(keys: DataFrame, column: str, bits: int):
    """A broadcast ``Bloom`` of a BIGINT column.  Bits are OR-ed in Spark by
    64-bit word, so at most ``1 << (bits - 6)`` rows reach the driver."""
    spark = keys.sparkSession

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            own = Bloom(bits)
            key = np.unique(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            for p in own._places(key):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((p >> np.uint64(6)).astype(np.int64)),
                        pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64)),
                    ],
                    names=["word", "mask"],
                )

    rows = (
        keys.select(F.col(column).cast("bigint").alias("key"))
        .mapInArrow(place, "word bigint, mask bigint")
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()  # without an object for each row, as the driver's memory is small
    )
    filled = Bloom(bits)
    filled.words[rows["word"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(filled.words)
