"""Spelling variant grouping by a variable-length gram index (operator 13).

1. Words are counted over all texts (JVM-side, combined before the shuffle).
2. Gram dictionary: all grams of ``SHORTEST`` code points; a gram is extended
   by one code point, up to ``LONGEST``, while it is frequent among the words.
   Only the frequent grams that are extended are kept, so the dictionary is
   bounded by the alphabet, not by the data.
3. Each word is decomposed: at each place the longest dictionary gram.  The
   gram of a place depends on the code points that the walk down the
   dictionary looked at, so one edit can change only the grams whose walk saw
   its place.  The largest such number over all places is the word's bound.
4. List merging: one more gram than the bound, the rarest first, must hold a
   gram that survives the edit, in both words of a pair.  The edit lies to its
   right (then its place from the start agrees) or to its left (its place from
   the end agrees), so the lists are keyed by gram and place.
5. Lists of more than ``MOST_LISTED`` words are not paired.  Their words meet
   exactly instead: by the word without one code point.  Words that share such
   a key differ in one place, so those groups are bounded by the alphabet.
6. Candidate pairs are verified by their edit distance.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_lower, keep, load, text_or_empty

RUN = r"[A-Za-zÀ-ÿ]"
SHORTEST, LONGEST = 2, 4
#: A gram in more places of the words than this is extended.
FREQUENT = 64
MOST_LISTED = 24
COUNTERS = 1 << 16
_MOD, _BASE = (1 << 61) - 1, 1_000_003


# --- words ----------------------------------------------------------------------

def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, noise: int | None = None,
) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least
    ``least_length`` code points that occur ``least_count`` times or more in
    all texts.

    With ``noise``, a run whose crc32 of ``<id>:<run>`` is a multiple of it
    loses the code point at crc32 modulo its length (a null id counts as the
    empty text).  Null texts have no runs.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text_or_empty(text_col), F.lit(RUN + "{%d,}" % least_length), F.lit(0))).alias("run"),
    ).select("id", ascii_lower(F.col("run")).alias("run"))
    word = F.col("run")
    if noise:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        word = F.when(h % noise == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# --- gram dictionary --------------------------------------------------------------

def frequent_grams(words: DataFrame, frequent: int = FREQUENT) -> frozenset[str]:
    """Grams of SHORTEST to LONGEST - 1 code points in more than ``frequent``
    places of the words.  Over the letters of ``RUN`` (90 after lower-casing)
    there are at most 90**2 + 90**3 of them, whatever the input."""
    found: set[str] = set()
    for q in range(SHORTEST, LONGEST):
        places = words.where(F.length("word") >= q).select(
            F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - (q - 1)), lambda i: F.substring(F.col("word"), i, F.lit(q)))).alias("gram")
        )
        rows = places.groupBy("gram").count().where(F.col("count") > frequent).select("gram").collect()
        found.update(r["gram"] for r in rows)
    return frozenset(found)


def decompose(word: str, extended: frozenset[str]) -> tuple[list[str], list[int]]:
    """The gram of each place and how many places its walk looked at (the
    end of the word counts as one)."""
    grams, seen = [], []
    for p in range(len(word) - SHORTEST + 1):
        q = SHORTEST
        while q < LONGEST and word[p : p + q] in extended:
            if p + q == len(word):
                q += 1  # looked at the end of the word
                break
            q += 1
        grams.append(word[p : p + q])
        seen.append(q)
    return grams, seen


def affected_bound(seen: list[int]) -> int:
    """Largest number of grams that one edit can change: those whose walk saw
    the place.  An insertion before a place changes a subset of what a
    replacement of that place changes."""
    change = [0] * (len(seen) + LONGEST + 1)
    for p, q in enumerate(seen):
        change[p] += 1
        change[p + q] -= 1
    most = now = 0
    for c in change:
        now += c
        most = max(most, now)
    return most


def _counter(gram: str) -> int:
    x = 0
    for c in gram:
        x = (x * _BASE + ord(c)) % _MOD
    return (x ^ (x >> 17) ^ (x >> 37)) % COUNTERS


def _gram_counters(extended):
    """Arrow pass (word) -> (counter, n): sizes of the gram lists, hashed."""

    def run(batches):
        import pyarrow as pa

        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                for gram in decompose(word, extended.value)[0]:
                    counts[_counter(gram)] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["counter", "n"])

    return run


def _list_keys(extended, counters):
    """Arrow pass (word) -> (word, key): the lists that a word enters."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            words, keys = [], []
            for word in batch.column(0).to_pylist():
                grams, seen = decompose(word, extended.value)
                order = sorted(range(len(grams)), key=lambda p: (counters.value[_counter(grams[p])], grams[p], p))
                for p in order[: affected_bound(seen) + 1]:
                    words += [word, word]
                    keys += [f"{p}>{grams[p]}", f"{len(word) - p}<{grams[p]}"]
                if len(keys) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(keys, pa.string())], names=["word", "key"])
                    words, keys = [], []
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(keys, pa.string())], names=["word", "key"])

    return run


def _without_one(batches):
    """Arrow pass (word) -> (word, at, key): hashes of the word without the
    code point at each place (at >= 0) and of the whole word (at = -1)."""
    import pyarrow as pa

    for batch in batches:
        words, ats, keys = [], [], []
        for word in batch.column(0).to_pylist():
            left = [0]
            for c in word:
                left.append((left[-1] * _BASE + ord(c) + 1) % _MOD)
            words.append(word)
            ats.append(-1)
            keys.append(left[-1])
            tail, power = 0, 1
            for i in range(len(word) - 1, -1, -1):
                words.append(word)
                ats.append(i)
                keys.append((left[i] * power + tail) % _MOD)
                tail = (tail + (ord(word[i]) + 1) * power) % _MOD
                power = power * _BASE % _MOD
            if len(keys) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ats, pa.int32()), pa.array(keys, pa.int64())], names=["word", "at", "key"])
                words, ats, keys = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ats, pa.int32()), pa.array(keys, pa.int64())], names=["word", "at", "key"])


# --- pairs ------------------------------------------------------------------------

def near_words(words: DataFrame, frequent: int = FREQUENT, most_listed: int = MOST_LISTED) -> DataFrame:
    """(a, b), a < b: all pairs of distinct ``word`` values that differ by
    exactly one inserted, deleted or replaced code point.

    Words are distinct, of the letters of ``RUN`` and of at least SHORTEST +
    LONGEST code points (``word_counts`` gives such); then every word has more
    grams than one edit can change.  No words give no pairs.
    """
    spark = words.sparkSession
    words = words.select("word")
    extended = spark.sparkContext.broadcast(frequent_grams(words, frequent))
    counters = np.zeros(COUNTERS, np.int64)
    for r in words.mapInArrow(_gram_counters(extended), "counter bigint, n bigint").groupBy("counter").agg(F.sum("n").alias("n")).collect():
        counters[r["counter"]] = r["n"]
    sent = spark.sparkContext.broadcast(counters)
    lists = keep(words.mapInArrow(_list_keys(extended, sent), "word string, key string"), "spelling-lists")
    sizes = keep(lists.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1), "spelling-sizes")
    a = lists.join(sizes.where(F.col("size") <= most_listed), "key").select("key", F.col("word").alias("a"))
    merged = a.join(a.select("key", F.col("a").alias("b")), "key").where(F.col("a") < F.col("b")).select("a", "b")
    # Words of the long lists.
    rest = lists.join(sizes.where(F.col("size") > most_listed), "key", "left_semi").select("word").distinct()
    cut = keep(rest.mapInArrow(_without_one, "word string, at int, key bigint"), "spelling-rest")
    one = cut.where("at >= 0").select("key", F.col("word").alias("a"), "at")
    replaced = one.join(one.select("key", "at", F.col("a").alias("b")), ["key", "at"]).where(F.col("a") < F.col("b")).select("a", "b")
    longer = one.join(cut.where("at < 0").select("key", F.col("word").alias("b")), "key")
    longer = longer.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = merged.unionByName(replaced).unionByName(longer)
    apart = F.abs(F.length("a") - F.length("b"))
    return pairs.where((apart <= 1) & (F.levenshtein("a", "b", 1) == 1)).distinct()


# --- forms and groups ---------------------------------------------------------------

def spelling_groups(counts: DataFrame, times: int = 5, **options) -> DataFrame:
    """One row per word of ``counts`` (word, n): word, form, root, n, n_near,
    form_n.

    ``form`` is the near word of largest n (ties: smallest in code-point
    order) if its n is at least ``times`` the word's, else null.  ``root`` is
    the end of the chain of forms, the word itself without one.
    """
    if times < 2:
        raise ValueError("times must be 2 or more, so that chains of forms end")
    pairs = keep(near_words(counts, **options), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(counts.select(F.col("word").alias("b"), F.col("n").alias("bn")), "b")
    best = near.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("bn")).alias("m"), F.col("b").alias("w"))).alias("best"))
    rows = counts.select("word", "n").join(best, F.col("word") == F.col("a"), "left")
    has = -F.col("best.m") >= times * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has, F.col("best.w")).alias("form"), F.when(has, -F.col("best.m")).alias("form_n"),
    )
    rows = keep(rows, "spelling-forms")
    # Counts grow by ``times`` a step, so chains are short; each round doubles
    # the steps taken.
    ends = rows.select("word", F.coalesce("form", "word").alias("root"))
    steps = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = steps.join(onward, "root", "left")
        if longer.where("next is not null").isEmpty():
            break
        steps = keep(longer.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
        ends = rows.select("word").join(steps, "word", "left").select("word", F.coalesce("root", "word").alias("root"))
    return rows.join(ends, "word").select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None, **options) -> DataFrame:
    """Spelling groups of the words of all texts.  Rows that share an id, and
    null ids, are documents like others; an empty table gives no rows; extra
    columns play no part."""
    return spelling_groups(keep(word_counts(docs, id_col, text_col, noise=noise), "spelling-words"), **options)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(load(spark, sf_dir, "documents"), noise=199)


#: crc32 by its bits; words meet by the word without one code point.
OP13_SQL = """
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE k < 8
), tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{00C0}-\\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(b), 2), lambda i: CAST('0x' || substr(b, CAST(i AS INT), 2) AS BIGINT))),
           lambda h, x: xor(h // 256, t[xor(h, x) % 256 + 1])), 4294967295) AS h
  FROM (SELECT run, n, hex(encode(id || ':' || run)) AS b FROM counted), tab
), words AS (
  SELECT word, sum(n) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n
    FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS o, b.n FROM cut a JOIN cut b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.k = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.k = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(o ORDER BY n DESC, o) AS o, max(n) AS form_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN o END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT walk.word, f.word, f.form FROM walk JOIN forms f ON f.word = walk.next
)
SELECT f.word, f.form, w.root, CAST(f.n AS BIGINT) AS n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN walk w ON w.word = f.word AND w.next IS NULL
"""
