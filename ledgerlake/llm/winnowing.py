"""Benchmark decontamination by winnowing (operator 1).

The fingerprint of a run of w consecutive k-grams is its smallest k-gram hash.
A window of k + w - 1 words holds exactly w k-grams, so two equal windows have
equal fingerprints: a shared span of that many words is never missed.

1. Benchmark windows (k + w - 1 words; a shorter item is one window of its
   own length) give fingerprints; a Bloom filter of fixed size holds them.
2. One vectorised pass over the documents slides the minimum over the k-gram
   hashes and keeps only the places whose fingerprint the filter knows.
3. These are joined with the benchmark windows on fingerprint and words (the
   hit is extended to the whole window and compared in full), so a document
   window meets at most one distinct benchmark window, whatever is repeated.
4. Hit words are the union of the windows that matched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ALNUM_WORD, Bloom, bloom_of, keep, load, mix, text_slices, word_hashes, words_in_rows

WINDOW, GRAM = 10, 5
BLOOM_BITS = 24


def _grams(length: int, window: int, gram: int) -> tuple[int, int]:
    """k and w of a span of ``length`` words (k + w - 1 = length)."""
    k = gram if length == window else length
    return k, length - k + 1


def fingerprints(words: np.ndarray, length: int, window: int, gram: int) -> np.ndarray:
    """Smallest k-gram hash of each span of ``length`` consecutive words."""
    k, w = _grams(length, window, gram)
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    grams = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + words[i : i + len(grams)]
    grams = mix(grams ^ np.uint64(length if length != window else 0))
    least = grams[:n].copy()
    for i in range(1, w):
        np.minimum(least, grams[i : i + n], out=least)
    return least


SPAN = "array<struct<at:int,length:int,fp:bigint,words:string>>"


def _window_pass(lengths: list[int], window: int, gram: int, bloom=None, bits: int = 0):
    """Arrow pass (rid, text) -> (rid, n_words, spans).  Without a filter
    every window is given (benchmark items); with one, the known ones."""

    def run(batches):
        import pyarrow as pa

        known = Bloom(bits, bloom.value) if bloom is not None else None
        for batch in batches:
            for low, high, raw, offsets in text_slices(batch.column(1)):
                starts, ends, first = words_in_rows(raw, offsets, ALNUM_WORD)
                hashes = word_hashes(raw, starts, ends)
                count = np.diff(first)
                found = [np.zeros((4, 0), np.int64)]  # row, first word, length, fingerprint
                own = lengths if known is not None else [window, *range(1, window)]
                for length in own:
                    fp = fingerprints(hashes, length, window, gram)
                    if known is not None:
                        ok = known.has(fp)
                    elif length == window:
                        ok = np.ones(len(fp), bool)
                    else:  # a short item: one window, the whole item
                        ok = np.zeros(len(fp), bool)
                        ok[first[:-1][count == length]] = True
                    at = np.flatnonzero(ok)
                    row = np.searchsorted(first, at, side="right") - 1
                    inside = at + length <= first[row + 1]
                    found.append(np.stack([row[inside], at[inside], np.full(inside.sum(), length), fp[at[inside]].view(np.int64)]))
                row, at, length, fp = np.concatenate(found, axis=1)
                order = np.lexsort((length, at, row))
                row, at, length, fp = row[order], at[order], length[order], fp[order]
                text = raw.tobytes().lower()
                words = [
                    " ".join(text[s:e].decode() for s, e in zip(starts[a : a + n].tolist(), ends[a : a + n].tolist()))
                    for a, n in zip(at.tolist(), length.tolist())
                ]
                spans = pa.StructArray.from_arrays(
                    [pa.array((at - first[row]).astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(fp), pa.array(words, pa.string())],
                    names=["at", "length", "fp", "words"],
                )
                borders = np.searchsorted(row, np.arange(high - low + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(count.astype(np.int64)), pa.ListArray.from_arrays(pa.array(borders), spans)],
                    names=["rid", "n_words", "spans"],
                )

    return run


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """(item, length, fp, words): the distinct windows of each item."""
    rows = items.select(F.col(id_col).cast("string").alias("rid"), F.col(text_col).alias("text"))
    spans = rows.mapInArrow(_window_pass([], window, gram), f"rid string, n_words bigint, spans {SPAN}")
    return spans.select(F.col("rid").alias("item"), F.explode("spans").alias("s")).select(
        "item", "s.length", "s.fp", "s.words"
    ).distinct()


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """One row per input row: id, n_words, n_hit (words inside a matched
    window), n_items, items_sha256 (item ids as strings, sorted,
    comma-joined), contaminated.

    Null texts and texts without words have no hit; an item without words has
    no window; a null item id counts as an item but is not listed.  Rows that
    share an id are judged one by one.  Empty tables: no rows, or no hits.
    """
    bench = keep(benchmark_windows(items, item_id_col, item_text_col, window, gram), "bench-windows")
    lengths = sorted(r["length"] for r in bench.select("length").distinct().collect())
    bloom = bloom_of(bench, "fp", bloom_bits)
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"), F.col(text_col).alias("text"))
    ids = rows.schema["id"].dataType.simpleString()
    rows = rows.select(F.struct("id", "rid").alias("rid"), "text")
    seen = rows.mapInArrow(
        _window_pass(lengths, window, gram, bloom, bloom_bits), f"rid struct<id:{ids},rid:bigint>, n_words bigint, spans {SPAN}"
    )
    seen = keep(seen.select("rid.id", "rid.rid", "n_words", "spans"), "window-hits")
    windows = bench.groupBy("fp", "length", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    windows = windows.withColumn("cls", F.sha2(F.array_join("items", ","), 256))
    places = seen.select("rid", F.explode("spans").alias("s")).select("rid", "s.*")
    hits = keep(places.join(windows.select("fp", "length", "words", "cls"), ["fp", "length", "words"]).select("rid", "at", "length", "cls"), "window-matches")
    # Words in the union of the windows: each adds what reaches beyond all before it.
    before = Window.partitionBy("rid").orderBy("at", "length").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("at") + F.col("length") - F.greatest("at", F.coalesce(F.max(F.col("at") + F.col("length")).over(before), F.lit(0))))
    words = hits.select("rid", "at", "length").distinct().withColumn("fresh", fresh).groupBy("rid").agg(F.sum("fresh").alias("n_hit"))
    classes = windows.groupBy("cls").agg(F.first("items").alias("items")).select("cls", F.explode("items").alias("item"))
    named = hits.select("rid", "cls").distinct().join(classes, "cls").groupBy("rid").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = seen.drop("spans").join(words, "rid", "left").join(named, "rid", "left")
    listed = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the contaminated ones, with their own columns.  Rows
    that share an id (null included) stay or go together.  The ids that go are
    written first, so their size is known and texts are shuffled only where
    they are too many to broadcast."""
    found = contamination(docs, items, id_col=id_col, **options).where("contaminated").select(F.col(id_col).alias("_gone")).distinct()
    found = keep(found, "window-contaminated")
    return docs.join(found, docs[id_col].eqNullSafe(found["_gone"]), "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOW + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP1_SQL = f"""
WITH iw AS (
  SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), lens AS (SELECT DISTINCT n FROM win
), dwin AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)
), hit AS (
  SELECT d.doc_id, d.i, d.n, w.item_id FROM dwin d JOIN win w ON d.n = w.n AND d.k = w.k
), hw AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
