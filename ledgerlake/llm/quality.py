"""Quality classifier: a factorisation machine (operator 5).

Features of a text are its hashed words and, as one-hot bins, statistics of
its structure (letter case, digits, symbols, repetition, lines) and of its
size.  The score is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

so all pairwise interactions cost time linear in the number of features.
Labels, language, source and identifier are never inputs.

Features are made by one vectorised pass in the tasks.  The model is fitted on
a bounded sample of labelled rows (``SAMPLE``); every document is scored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import ALNUM_WORD, GRAPH_WORD, load, mix, text_slices, word_hashes, words_in_rows

#: Labelled rows that the model is fitted on, about, at most.
SAMPLE = 4000
BUCKETS, BINS, FACTORS = 1 << 14, 24, 4
STATS = 14
DIMENSIONS = BUCKETS + STATS * BINS
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.08, 1e-4

_KINDS = np.full(256, 5, np.uint8)  # 0 lower 1 upper 2 digit 3 space 4 line end 5 sentence marks 6 other symbols 7 beyond ASCII
_KINDS[0x61:0x7B], _KINDS[0x41:0x5B], _KINDS[0x30:0x3A], _KINDS[0x80:] = 0, 1, 2, 7
_KINDS[[0x20, 0x09]], _KINDS[[0x0A, 0x0D]] = 3, 4
for _c in b"!#$%&*+/<=>@[\\]^_`{|}~":
    _KINDS[_c] = 6


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Distinct hashes of each row (on 40 bits)."""
    if not len(row):
        return np.zeros(rows)
    keys = np.unique((row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    return np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=rows)


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the rows of a slice: row borders, indices, values."""
    rows = len(offsets) - 1
    kinds = _KINDS[raw]
    counts = np.zeros((8, rows))
    full = np.flatnonzero(np.diff(offsets))
    for kind in range(8):
        if len(full):
            counts[kind, full] = np.add.reduceat((kinds == kind).astype(np.int64), offsets[full])
    size = np.diff(offsets).astype(np.float64)
    starts, ends, first = words_in_rows(raw, offsets, ALNUM_WORD)
    hashes = word_hashes(raw, starts, ends)
    words = np.diff(first).astype(np.float64)
    row = np.repeat(np.arange(rows), np.diff(first))
    runs = np.diff(words_in_rows(raw, offsets, GRAPH_WORD)[2])
    grams = mix(hashes[:-1] * np.uint64(0xD6E8FEB86659FD93) + hashes[1:]) if len(hashes) > 1 else hashes[:0]
    inside = row[:-1] == row[1:]
    keys, times = np.unique((row << 14) | (hashes >> np.uint64(50)).astype(np.int64), return_counts=True)
    word_row, bucket = keys >> 14, keys & (BUCKETS - 1)
    most = np.zeros(rows)
    np.maximum.at(most, word_row, times)
    length = np.zeros(rows)
    np.add.at(length, row, (ends - starts).astype(np.float64))

    def root(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.clip(x, 0, 1)) * (BINS - 1)

    letters = counts[0] + counts[1]
    stats = [
        root(_share(counts[1], letters)), root(_share(counts[2], size)), root(_share(counts[3], size)), root(_share(counts[5], size)),
        root(_share(counts[6], size)), root(_share(counts[7], size)), root(_share(counts[4], size)),
        _share(_distinct(row, hashes, rows), words) * (BINS - 1),
        _share(_distinct(row[:-1][inside], grams[inside], rows), words) * (BINS - 1),
        root(_share(most, words)), np.log2(size + 1), np.log2(words + 1) * 1.5, _share(length, words) * 1.5,
        root(1 - _share(words, np.maximum(runs, words))),
    ]
    bins = np.clip(np.stack(stats), 0, BINS - 1).astype(np.int64)
    stat_index = BUCKETS + np.arange(STATS)[:, None] * BINS + bins
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(word_row, value * value, minlength=rows))
    index = np.concatenate([bucket, stat_index.reshape(-1)])
    values = np.concatenate([value / norm[word_row], np.full(STATS * rows, 0.5)])
    at = np.concatenate([word_row, np.tile(np.arange(rows), STATS)])
    order = np.argsort(at, kind="stable")
    return np.searchsorted(at[order], np.arange(rows + 1)), index[order], values[order]


class Machine:
    """A factorisation machine for a yes/no label, with Adagrad steps."""

    def __init__(self, dimensions: int = DIMENSIONS, factors: int = FACTORS):
        self.bias = 0.0
        self.linear = np.zeros(dimensions)
        self.pairs = np.random.default_rng(5).normal(0, 0.05, (factors, dimensions))

    def raw(self, borders: np.ndarray, index: np.ndarray, value: np.ndarray):
        """Scores before the sigmoid; sums of each factor by row, for the gradient."""
        row = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
        n = len(borders) - 1
        out = self.bias + np.bincount(row, self.linear[index] * value, minlength=n)
        sums = []
        for v in self.pairs:
            one = v[index] * value
            total = np.bincount(row, one, minlength=n)
            out += 0.5 * (total * total - np.bincount(row, one * one, minlength=n))
            sums.append(total)
        return out, sums, row

    def score(self, borders: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(borders, index, value)[0], -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> "Machine":
        rng = np.random.default_rng(11)
        share = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
        self.bias = float(np.log(share / (1 - share)))
        if not 0 < labels.sum() < len(labels):
            return self  # one label only: its share is the score
        seen, seen_pairs, seen_bias = np.full(self.linear.shape, 1e-6), np.full(self.pairs.shape, 1e-6), 1e-6
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for low in range(0, len(order), BATCH):
                batch = order[low : low + BATCH]
                index = np.concatenate([rows[i][0] for i in batch])
                value = np.concatenate([rows[i][1] for i in batch])
                borders = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in batch])])
                raw, sums, row = self.raw(borders, index, value)
                error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) / len(batch)
                used, where = np.unique(index, return_inverse=True)
                back = error[row] * value

                def step(weights, past, gradient):
                    grad = np.bincount(where, gradient, minlength=len(used)) + DECAY * weights[used]
                    past[used] += grad * grad
                    weights[used] -= RATE * grad / np.sqrt(past[used])

                old = [v[index] for v in self.pairs]
                step(self.linear, seen, back)
                for f, total in enumerate(sums):
                    step(self.pairs[f], seen_pairs[f], back * (total[row] - old[f] * value))
                seen_bias += error.sum() ** 2
                self.bias -= RATE * error.sum() / np.sqrt(seen_bias)
        return self


def _feature_pass(batches):
    import pyarrow as pa

    for batch in batches:
        for low, high, raw, offsets in text_slices(batch.column(2)):
            borders, index, value = features(raw, offsets)
            cut = list(zip(borders[:-1].tolist(), borders[1:].tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low),
                 pa.array([index[a:b].astype("<i4").tobytes() for a, b in cut], pa.binary()),
                 pa.array([value[a:b].astype("<f4").tobytes() for a, b in cut], pa.binary())],
                names=["id", "label", "at", "value"],
            )


def held_out(id_col: str) -> Column:
    """Rows whose crc32(id as text) mod 4 is 2 teach nothing.  A null id is not held out (and has no label)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Machine:
    """Fit on about ``sample`` labelled rows at most, drawn by a hash of the
    id.  Several labels of an id are averaged; null labels do not count.  Of
    the rows that share an id one teaches, chosen by a hash of its text."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("double").alias("label"))
    total = known.count()
    if total > sample:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * sample / total))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    text = F.coalesce("text", F.lit(""))
    rows = rows.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64(text).alias("hash"), text.alias("text"))).alias("one"))
    rows = rows.select("id", "label", "one.text")
    kind = rows.schema["id"].dataType.simpleString()
    got = rows.mapInArrow(_feature_pass, f"id {kind}, label double, at binary, value binary").collect()
    got.sort(key=lambda r: (r["id"], r["at"]))
    made = [(np.frombuffer(r["at"], "<i4").astype(np.int64), np.frombuffer(r["value"], "<f4").astype(np.float64)) for r in got]
    return Machine().fit(made, np.array([r["label"] for r in got], np.float64))


def scored(docs: DataFrame, model: Machine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` (all columns) with a score from 0 to 1.  Null and empty texts
    are scored by their structure alone.  ``score_col`` replaces a column of
    that name.  An empty table gives no rows."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.bias, model.linear, model.pairs))
    names = [c for c in docs.columns if c != score_col]
    at = names.index(text_col)

    def run(batches):
        import pyarrow as pa

        own = Machine(1)
        own.bias, own.linear, own.pairs = sent.value
        for batch in batches:
            made = [own.score(*features(raw, offsets)) for _, _, raw, offsets in text_slices(batch.column(at))]
            score = pa.array(np.concatenate(made) if made else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*names, score_col])

    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField(score_col, T.DoubleType())])
    return docs.select(*names).mapInArrow(run, schema)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **columns) -> DataFrame:
    """``docs`` whose score reaches the threshold, with their own columns."""
    model, name = train(docs, labels, **columns), "_score"
    while name in docs.columns:
        name = "_" + name
    out = scored(docs, model, columns.get("text_col", "text"), name)
    return out.where(F.col(name) >= threshold).select(*docs.columns)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = train(docs, load(spark, sf_dir, "labels"))
    out = scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
