"""Ranked lexical search with pair-bound MaxScore (operator 11).

1. ``build_index``: one vectorised pass over the whole texts writes an inverted
   index, partitioned by document: each row is a block of documents with its
   sorted terms and their lists (document, occurrences).
2. Items (the queries) are taken in blocks of about ``ITEMS``.  For a block of
   items the distinct terms of each are paired, rare with rare.
3. ``_workload``: the lists of the block's terms become impacts, and each pair
   gets its intersection list with the joint impact of every document and the
   joint maximum.
4. ``_search``: in each block of documents, a pair can add at most the largest
   of its joint maximum (documents with both terms) and its two own maxima
   (documents with one).  That is never more than the sum of the two maxima,
   so combining the bounds of the pairs skips more than independent maxima:
   whole blocks below the threshold, and, MaxScore's rule, lists that together
   stay below it need not open candidates.  Thresholds start from the k-th
   largest joint impact of any list and rise with the documents found.
5. The best k of all blocks are ranked, in two steps.

Terms are compared by 64-bit hashes.  All scores are integers, so results do
not depend on the order of work.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ALNUM_WORD, fresh_path, keep, load, text_slices, word_hashes, words_in_rows

TOP = 20
#: Items searched at once, about; bytes of text of an index block, about.
ITEMS, BLOCK_BYTES = 512, 1 << 21


# --- index ----------------------------------------------------------------------

def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index of all texts, one row per block of documents.

    Documents without terms (null texts among them) are in no block.  Inside a
    block documents are in order of their ids, null ids last; rows that share
    an id are documents of their own.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = own.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for low, high, raw, offsets in text_slices(batch.column(1), block_bytes):
                starts, ends, first = words_in_rows(raw, offsets, ALNUM_WORD)
                size = np.diff(first)
                full = np.flatnonzero(size)
                if not len(full):
                    continue
                ids = batch.column(0).slice(low, high - low).take(pa.array(full))
                order = pc.sort_indices(ids).to_numpy()
                ordinal = np.empty(high - low, np.int64)
                ordinal[full[order]] = np.arange(len(full))
                doc = np.repeat(ordinal, size)
                terms = word_hashes(raw, starts, ends)
                at = np.lexsort((doc, terms))
                terms, doc = terms[at], doc[at]
                new = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (doc[1:] != doc[:-1])))
                times = np.diff(np.append(new, len(terms)))
                terms, doc = terms[new], doc[new]
                head = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
                binary = [terms[head].astype("<u8"), np.append(head, len(terms)).astype("<i4"), doc.astype("<i4"), times.astype("<i4"), size[full[order]].astype("<i8")]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(full)], pa.int32()), ids.take(pa.array(order))),
                     *[pa.array([b.tobytes()], pa.binary()) for b in binary],
                     pa.array([len(full)], pa.int64()), pa.array([int(size.sum())], pa.int64())],
                    names=["ids", "terms", "starts", "docs", "times", "sizes", "n_docs", "n_terms"],
                )

    schema = f"ids array<{kind}>, terms binary, starts binary, docs binary, times binary, sizes binary, n_docs bigint, n_terms bigint"
    return keep(own.mapInArrow(run, schema), "lexical-index")


def _rows(batches, *kinds: str):
    """The rows of Arrow batches, one at a time: the first column as it is,
    the others as arrays of the given kinds."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0).slice(i, 1), [np.frombuffer(batch.column(c + 1)[i].as_py(), kind) for c, kind in enumerate(kinds)]


def _places(all_terms: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``terms`` occur in ``all_terms`` (both sorted), and where."""
    at = np.minimum(np.searchsorted(all_terms, terms), len(all_terms) - 1)
    here = np.flatnonzero(all_terms[at] == terms)
    return here, at[here]


def _document_counts(terms: np.ndarray):
    def run(batches):
        import pyarrow as pa

        count = np.zeros(len(terms), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                own, starts = (np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in ((0, "<u8"), (1, "<i4")))
                here, at = _places(own, terms)
                count[here] += starts[at + 1] - starts[at]
        here = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(count[here])], names=["term", "df"])

    return run


# --- a block of items -------------------------------------------------------------

class Workload:
    """The terms of a block of items, and each item as units: pairs of terms,
    rare with rare, and at most one single term (b < 0)."""

    def __init__(self, items: list[tuple[list[int], list[int]]]):
        """``items``: distinct term hashes of an item and their repeats."""
        self.items = items
        self.terms = np.unique(np.array([t for terms, _ in items for t in terms], np.int64).view(np.uint64))

    def weigh(self, df: np.ndarray, n: int, total: int) -> None:
        self.n, self.total = n, total
        self.weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        a, b, qa, qb, pair, first = [], [], [], [], [], [0]
        pairs: dict[tuple[int, int, int, int], int] = {}
        for terms, times in self.items:
            places = np.searchsorted(self.terms, np.array(terms, np.int64).view(np.uint64))
            own = sorted(zip((-self.weights[places]).tolist(), places.tolist(), times))
            for i in range(0, len(own), 2):
                two = i + 1 < len(own)
                key = (own[i][1], own[i + 1][1] if two else -1, own[i][2], own[i + 1][2] if two else 0)
                for out, x in zip((a, b, qa, qb), key):
                    out.append(x)
                pair.append(pairs.setdefault(key, len(pairs)) if two else -1)
            first.append(len(a))
        self.a, self.b, self.qa, self.qb, self.pair, self.first = (np.array(x, np.int64) for x in (a, b, qa, qb, pair, first))
        self.pairs = np.array(list(pairs), np.int64).reshape(-1, 4)


def _impacts(work: Workload, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    m = 100 - 25 + (25 * sizes * work.n) // work.total
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


def _workload(sent, top: int):
    """Arrow pass over the index: lists of the items' terms as impacts, pair
    lists, maxima, and a lower bound of each item's k-th best score."""

    def run(batches):
        import pyarrow as pa

        work = sent.value
        for ids, (terms, starts, docs, times, sizes) in _rows(batches, "<u8", "<i4", "<i4", "<i4", "<i8"):
            here, at = _places(terms, work.terms)
            if not len(here):
                continue
            count = (starts[at + 1] - starts[at]).astype(np.int64)
            first = np.append(0, np.cumsum(count))
            take = np.repeat(starts[at] - first[:-1], count) + np.arange(first[-1])
            docs, times = docs[take], times[take].astype(np.int64)
            impact = np.repeat(work.weights[here], count) * _impacts(work, times, sizes[docs])
            most = np.maximum.reduceat(impact, first[:-1])
            slot = np.full(len(work.terms) + 1, -1)  # the last one stands for "no term"
            slot[here] = np.arange(len(here))
            p_docs, p_joint, p_count = [], [], np.zeros(len(work.pairs), np.int64)
            p_most = np.zeros(len(work.pairs), np.int64)
            known = slot[work.pairs[:, 0]], slot[work.pairs[:, 1]]
            kth = np.zeros(len(work.pairs), np.int64)
            for i in np.flatnonzero((known[0] >= 0) & (known[1] >= 0)).tolist():
                x, y = known[0][i], known[1][i]
                dx, dy = docs[first[x] : first[x + 1]], docs[first[y] : first[y + 1]]
                near = np.minimum(np.searchsorted(dy, dx), len(dy) - 1)
                both = np.flatnonzero(dy[near] == dx)
                if len(both):
                    joint = work.pairs[i, 2] * impact[first[x] + both] + work.pairs[i, 3] * impact[first[y] + near[both]]
                    p_docs.append(dx[both])
                    p_joint.append(joint)
                    p_count[i], p_most[i] = len(both), joint.max()
                    if len(both) >= top:
                        kth[i] = np.partition(joint, len(both) - top)[len(both) - top]
            seeds = np.where(work.pair >= 0, kth[work.pair] if len(kth) else 0, 0)
            filled = work.first[:-1] < work.first[1:]
            seed = np.zeros(len(filled), np.int64)
            if filled.any():
                seed[filled] = np.maximum.reduceat(seeds, work.first[:-1][filled])
            columns = [here.astype("<i4"), first.astype("<i4"), docs.astype("<i4"), impact.astype("<i8"), most.astype("<i8"),
                       p_count.astype("<i4"), np.concatenate(p_docs or [docs[:0]]).astype("<i4"), np.concatenate(p_joint or [impact[:0]]).astype("<i8"),
                       p_most.astype("<i8"), seed.astype("<i8")]
            yield pa.RecordBatch.from_arrays([ids, *[pa.array([c.tobytes()], pa.binary()) for c in columns]], names=["ids", *WORKLOAD])

    return run


WORKLOAD = ["terms", "starts", "docs", "impacts", "most", "pair_counts", "pair_docs", "pair_joint", "pair_most", "seeds"]


def _seeds(items: int):
    def run(batches):
        import pyarrow as pa

        best = np.zeros(items, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                np.maximum(best, np.frombuffer(raw.as_py(), "<i8"), out=best)
        at = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(best[at])], names=["item", "seed"])

    return run


class Block:
    """A block of documents, open for the items of a workload."""

    def __init__(self, work: Workload, terms, starts, docs, impacts, most, pair_counts, pair_docs, pair_joint, pair_most, n_docs: int):
        self.work, self.starts, self.docs, self.impacts = work, starts, docs, impacts
        self.slot = np.full(len(work.terms) + 1, -1)
        self.slot[terms] = np.arange(len(terms))
        largest = np.zeros(len(work.terms) + 1, np.int64)
        largest[terms] = most
        self.of_a, self.of_b = work.qa * largest[work.a], work.qb * largest[work.b]
        joint = np.where(work.pair >= 0, pair_most[work.pair] if len(pair_most) else 0, 0)
        #: What a unit adds at most: to a document with both terms, or with one.
        self.bound = np.maximum(joint, np.maximum(self.of_a, self.of_b))
        self.pair_first = np.append(0, np.cumsum(pair_counts))
        self.pair_docs, self.pair_joint = pair_docs, pair_joint
        self.n_docs = n_docs

    def totals(self, bound: np.ndarray) -> np.ndarray:
        """Sum of the bounds of each item's units."""
        total = np.append(0, np.cumsum(bound))
        return total[self.work.first[1:]] - total[self.work.first[:-1]]

    def _add(self, score: np.ndarray, unit: int) -> None:
        w = self.work
        for term, times in ((w.a[unit], w.qa[unit]), (w.b[unit], w.qb[unit])):
            at = self.slot[term]
            if at >= 0:
                low, high = self.starts[at], self.starts[at + 1]
                score[self.docs[low:high]] += times * self.impacts[low:high]

    def best(self, item: int, threshold: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block that can be among the ``top`` of an item and
        score ``threshold`` (1 at least) or more: ordinals and scores."""
        units = np.arange(self.work.first[item], self.work.first[item + 1])
        units = units[np.argsort(self.bound[units], kind="stable")]
        reach = np.cumsum(self.bound[units])
        opening = int(np.searchsorted(reach, threshold))  # the units before it stay below the threshold together
        score = np.zeros(self.n_docs, np.int64)
        for unit in units[opening:].tolist():
            self._add(score, unit)
        found = np.flatnonzero(score)
        for i in range(opening - 1, -1, -1):
            if len(found) >= top:
                threshold = max(threshold, int(np.partition(score[found], len(found) - top)[len(found) - top]))
            found = found[score[found] + reach[i] >= threshold]
            if not len(found):
                return found, found
            self._add(score, int(units[i]))
        found = found[score[found] >= threshold]
        order = np.lexsort((found, -score[found]))[:top]
        return found[order], score[found[order]]


def _search(sent, seeds: np.ndarray, top: int):
    """Arrow pass over the workload's blocks -> (item, id, score)."""

    def run(batches):
        import pyarrow as pa

        work = sent.value
        threshold = np.maximum(seeds, 1)
        held = [np.zeros(0, np.int64)] * len(threshold)
        for ids, columns in _rows(batches, "<i4", "<i4", "<i4", "<i8", "<i8", "<i4", "<i4", "<i8", "<i8"):
            ids = ids.flatten()
            block = Block(work, *columns, len(ids))
            items, docs, scores = [], [], []
            for item in np.flatnonzero(block.totals(block.bound) >= threshold).tolist():
                found, score = block.best(item, int(threshold[item]), top)
                if len(found):
                    items.append(np.full(len(found), item))
                    docs.append(found)
                    scores.append(score)
                    held[item] = np.sort(np.append(held[item], score))[-top:]
                    if len(held[item]) == top:
                        threshold[item] = max(threshold[item], held[item][0])
            if items:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(items).astype(np.int32)), ids.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))],
                    names=["item", "id", "score"],
                )

    return run


# --- items ------------------------------------------------------------------------

def _item_terms(batches):
    """Arrow pass (rid, text) -> (rid, terms, times): distinct term hashes."""
    import pyarrow as pa

    for batch in batches:
        for low, high, raw, offsets in text_slices(batch.column(1)):
            starts, ends, first = words_in_rows(raw, offsets, ALNUM_WORD)
            hashes = word_hashes(raw, starts, ends).view(np.int64)
            both = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), pa.array([t.tolist() for t, _ in both], pa.list_(pa.int64())),
                 pa.array([n.tolist() for _, n in both], pa.list_(pa.int64()))],
                names=["rid", "terms", "times"],
            )


def ranked(rows: DataFrame, top: int, keys: list[str]) -> DataFrame:
    """The ``top`` rows of each key by score, ties by id (nulls last), with
    their rank; first in 16 parts of each key, so that no task ranks all of one."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    part = rows.withColumn("part", F.pmod(F.xxhash64("id", "score"), F.lit(16)))
    first = part.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "part").orderBy(*order))).where(F.col("rank") <= top)
    return first.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)


def search(
    index: DataFrame, items: DataFrame, top: int = TOP, item_id_col: str = "item_id", text_col: str = "text", id_col: str = "doc_id",
    items_at_once: int = ITEMS,
) -> DataFrame:
    """(item id, rank, id, score): the ``top`` documents of each item with a
    score above 0, ties by ascending id.

    Each row of ``items`` is a query of its own, rows that share an id too.
    Items without terms (null texts among them) and an empty table or index
    give no rows.  Rows that share a document id are ranked one by one.
    """
    spark = index.sparkSession
    terms = items.select(F.monotonically_increasing_id().alias("rid"), F.col(item_id_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = terms.schema["item_id"].dataType.simpleString()
    terms = terms.select(F.struct("rid", "item_id").alias("rid"), "text").mapInArrow(
        _item_terms, f"rid struct<rid:bigint,item_id:{kind}>, terms array<bigint>, times array<bigint>"
    )
    terms = keep(terms.select("rid.rid", "rid.item_id", "terms", "times").where(F.size("terms") > 0), "lexical-items")
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    blocks = -(-terms.count() // items_at_once) if size["n"] else 0
    own_kind = index.schema["ids"].dataType.elementType.simpleString()
    out = fresh_path(spark, "lexical-found")
    empty = spark.createDataFrame([], f"rid bigint, item_id {kind}, id {own_kind}, score bigint")
    empty.write.parquet(out)
    for i in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == i)
        got = own.select("rid", "terms", "times").collect()
        if not got:
            continue
        work = Workload([(r["terms"], r["times"]) for r in got])
        df = np.zeros(len(work.terms), np.int64)
        for r in index.select("terms", "starts").mapInArrow(_document_counts(work.terms), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r["term"]] = r["df"]
        work.weigh(df, size["n"], size["total"])
        sent = spark.sparkContext.broadcast(work)
        schema = f"ids array<{own_kind}>, " + ", ".join(f"{c} binary" for c in WORKLOAD)
        lists = keep(index.select("ids", "terms", "starts", "docs", "times", "sizes").mapInArrow(_workload(sent, top), schema), "lexical-workload")
        seeds = np.zeros(len(got), np.int64)
        for r in lists.select("seeds").mapInArrow(_seeds(len(got)), "item bigint, seed bigint").groupBy("item").agg(F.max("seed").alias("seed")).collect():
            seeds[r["item"]] = r["seed"]
        found = lists.drop("seeds").mapInArrow(_search(sent, seeds, top), f"item int, id {own_kind}, score bigint")
        numbers = spark.createDataFrame([(n, r["rid"]) for n, r in enumerate(got)], "item int, rid bigint")
        best = ranked(found, top, ["item"]).drop("rank").join(F.broadcast(numbers), "item").drop("item")
        best.join(own.select("rid", "item_id"), "rid").select(empty.columns).write.mode("append").parquet(out)
        sent.unpersist()
    result = spark.read.schema(empty.schema).parquet(out)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    result = result.withColumn("rank", F.row_number().over(Window.partitionBy("rid").orderBy(*order)))
    return result.select(F.col("item_id").alias(item_id_col), "rank", F.col("id").alias(id_col), "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(load(spark, sf_dir, "documents")), load(spark, sf_dir, "benchmark"))


_TERMS = (
    "translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents
), items AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark
), tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, {_TERMS} AS t FROM docs) GROUP BY r, t
), size AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r
), whole AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM size
), weight AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), whole
), q AS (SELECT i, t, count(*) AS c FROM (SELECT i, {_TERMS} AS t FROM items) GROUP BY i, t
), scores AS (
  SELECT q.i, tf.r, CAST(sum(q.c * w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (100 - 25 + (25 * size.n * nd) // l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN weight USING (t) JOIN size USING (r), whole GROUP BY q.i, tf.r
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT i, r, score, doc_id, item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM scores JOIN docs USING (r) JOIN items USING (i) WHERE score > 0)
WHERE rank <= 20
"""
