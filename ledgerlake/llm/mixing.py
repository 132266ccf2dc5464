"""Mixing sources to target weights by hash-threshold histograms (operator 2),
DataFrame functions only.

Each source has a budget of words.  Whole repeats of the source come first;
the rest of the budget is met by the documents whose hash lies below a
threshold.  The threshold is found from histograms: words are summed by source
and hash bucket, the running sum finds the bucket in which the budget ends,
and only that bucket is histogrammed again, until a single document remains.
Nothing is sorted; the final step is a filter.

The document at the border may not fit.  It is then left out, and the gap is
offered to the documents behind it that do fit (a second threshold nested
behind the first, and so on), then to further copies of documents that fit, so
the mix ends within a few words of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import keep, load, text_or_empty

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BITS, HALF = 10, 6  # a key is two numbers of 6 digits of 10 bits each
LEVELS = 2 * HALF
#: A mix is over named sources; more than this is refused, since one row per
#: source is held by the driver and broadcast.
MOST_SOURCES = 100_000
WS = " \t\n\x0b\x0c\r"


def targets(totals: list[int], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """Share the sum of ``totals`` by weight, none above ``most`` times its
    own; the excess is shared again by weight among the others."""
    out, open_ = [0.0] * len(totals), [i for i, t in enumerate(totals) if t > 0]
    left = float(sum(totals))
    while open_:
        whole = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / whole >= most * totals[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / whole
            break
        for i in full:
            out[i] = float(most * totals[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space: one character is left of each."""
    left = F.regexp_replace(F.rtrim(text, F.lit(WS)), r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")
    return F.length(left).cast("bigint")


def draw_keys(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, size and the draw (k, k2).  k depends on id and text alone;
    k2 only tells rows apart that agree in both, which are interchangeable."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(text).alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit("draw"), id_col, text), 4).alias("k"),
        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 4).alias("k2"),
    )


def budgets(rows: DataFrame, weights: tuple, most: int) -> DataFrame:
    """One row per source: name, source_size, target, whole repeats, and for
    each pass the interval [(k, k2), (k, k2)) of the draw, and the largest
    size, of the documents that are taken once more."""
    spark = rows.sparkSession
    sums = rows.groupBy("source").agg(F.sum("size").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(sums) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: map them to fewer before mixing")
    sums.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    goals = targets([r["n"] for r in sums], [weights[i % len(weights)] for i in range(len(sums))], most)
    whole = [min(most, int(g // r["n"])) if r["n"] else 0 for r, g in zip(sums, goals)]
    gaps = [int(g) - w * r["n"] for r, g, w in zip(sums, goals, whole)]
    names, takes = [r["source"] for r in sums], [[] for _ in sums]
    low = [(0, 0)] * len(sums)
    laps = [most - w for w in whole]  # times that a document can be taken once more
    while True:  # each pass fills a gap, skips a document that is too large for it, or ends a lap
        open_ = [i for i, gap in enumerate(gaps) if gap > 0 and laps[i] > 0]
        if not open_:
            break
        for i, (used, high, behind) in _thresholds(rows, names, open_, gaps, low).items():
            takes[i].append((*low[i], *high, gaps[i]))
            gaps[i] -= used
            if behind is None:  # nothing more fits in this lap; if nothing did in a whole lap, nothing will
                laps[i] = laps[i] - 1 if used or low[i] != (0, 0) else 0
            low[i] = behind or (0, 0)
    table = [(n, r["n"], float(g), w, t) for n, r, g, w, t in zip(names, sums, goals, whole, takes)]
    interval = "array<struct<k:bigint,k2:bigint,to_k:bigint,to_k2:bigint,most:bigint>>"
    return spark.createDataFrame(table, f"name string, source_size bigint, target double, whole int, takes {interval}")


def _thresholds(rows: DataFrame, names: list, open_: list[int], gaps: list[int], low: list) -> dict:
    """For each open source: words used, end of the interval taken, and the
    start of what lies behind the document that did not fit (None: no rest)."""
    spark, done = rows.sparkSession, {}
    rest = {i: gaps[i] for i in open_}
    prefix = {i: (0, 0) for i in open_}
    for level in range(LEVELS):
        state = [(i, names[i], rest[i], gaps[i], *low[i], *prefix[i]) for i in rest]
        if not state:
            break
        schema = "sid int, name string, rest bigint, most bigint, low_k bigint, low_k2 bigint, at_k bigint, at_k2 bigint"
        here = rows.join(F.broadcast(spark.createDataFrame(state, schema)), F.col("source").eqNullSafe(F.col("name")))
        here = here.where((F.col("size") <= F.col("most")) & _at_least("low_k", "low_k2"))
        shift = BITS * (HALF - 1 - level % HALF)
        inside = F.shiftrightunsigned("k", shift + BITS) == F.shiftrightunsigned("at_k", shift + BITS)
        digit = F.shiftrightunsigned("k", shift).bitwiseAND((1 << BITS) - 1)
        if level >= HALF:
            inside = F.col("k") == F.col("at_k")
            inside &= F.shiftrightunsigned("k2", shift + BITS) == F.shiftrightunsigned("at_k2", shift + BITS)
            digit = F.shiftrightunsigned("k2", shift).bitwiseAND((1 << BITS) - 1)
        buckets = here.where(inside).groupBy("sid", "rest", digit.alias("digit")).agg(
            F.sum("size").alias("words"), F.count("*").alias("docs")
        )
        upto = Window.partitionBy("sid").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        buckets = buckets.withColumn("upto", F.sum("words").over(upto))
        ends = buckets.groupBy("sid").agg(
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("digit", "words", "upto", "docs"))).alias("end"),
            F.max("upto").alias("all"),
        )
        got = {r["sid"]: r for r in ends.collect()}
        for i in list(rest):
            end = got[i]["end"] if i in got else None
            if end is None:  # all that is there fits (possible at the first level only)
                done[i] = (got[i]["all"] if i in got else 0, (1 << 62, 0), None)
                del rest[i]
                continue
            rest[i] -= end["upto"] - end["words"]
            k, k2 = prefix[i]
            step = end["digit"] << shift
            prefix[i] = at = (k + step, 0) if level < HALF else (k, k2 + step)
            if end["docs"] == 1 or level == LEVELS - 1:
                behind = (at[0] + (1 << shift), 0) if level < HALF else (at[0], at[1] + (1 << shift))
                done[i] = (gaps[i] - rest[i], at, behind)
                del rest[i]
    return done


def _at_least(k: str, k2: str) -> Column:
    return (F.col("k") > F.col(k)) | ((F.col("k") == F.col(k)) & (F.col("k2") >= F.col(k2)))


def take(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Add target, source_size and copies to ``rows`` (with source, size, k, k2): a filter by threshold."""
    k, k2 = F.col("k"), F.col("k2")

    def inside(t: Column) -> Column:
        above = (k > t["k"]) | ((k == t["k"]) & (k2 >= t["k2"]))
        below = (k < t["to_k"]) | ((k == t["to_k"]) & (k2 < t["to_k2"]))
        return above & below & (F.col("size") <= t["most"])

    out = rows.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("name")), "left")
    out = out.withColumn("copies", F.col("whole") + F.size(F.filter("takes", inside)))
    return out.drop("name", "whole", "takes")


def mix(
    docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, copies
    and taken (= copies * size).

    ``weights`` repeat over the sources by code point, null (a source of its
    own) last.  A null text has size 0.  Reruns agree: the draw depends on id
    and text alone, and rows that share both are interchangeable.  A null id
    is an ordinary value.  An empty table gives no rows.
    """
    rows = keep(draw_keys(docs, id_col, text_col, source_col), "mix-sizes")
    mixed = take(rows, budgets(rows, weights, most))
    return mixed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken,
    with their own columns.  The thresholds apply to the documents directly,
    so no join by identifier is needed."""
    table = budgets(keep(draw_keys(docs, id_col, text_col, source_col), "mix-sizes"), weights, most)
    own = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    rows = docs.select(own).select("doc", *[f"doc.{c}" for c in dict.fromkeys((id_col, text_col, source_col))])
    text = text_or_empty(text_col)
    rows = rows.select(
        "doc", F.col(source_col).alias("source"), word_count(text).alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit("draw"), id_col, text), 4).alias("k"),
        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 4).alias("k2"),
    )
    taken = take(rows, table).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(load(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")
