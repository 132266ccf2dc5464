"""Personal data by bootstrapped contextual extraction (operator 9).

Patterns for e-mail, IP address, card and phone numbers give the base spans,
which are the seed entities.  The one word and the two words before, and the
one word and the two words after a seed are lexical patterns.  Patterns and
instances (seeds and other strings that look like identifiers) form a graph
that Spark scores in turns:

* a pattern's score is the share of all its occurrences in the corpus that
  hold a trusted instance, weighted by the instances' scores;
* an instance's score is 1 for seeds, else 1 - prod(1 - score) over the
  patterns around it, so several weak contexts add up.  A one-word pattern and
  the two-word patterns that contain it are one piece of evidence: the
  stronger of both counts.

Only patterns with enough different trusted instances have a say.  Instances
that reach ``TRUST`` count like seeds in the next round, where they can make
further patterns, until no new instance appears; they become spans of the
kind ``context``.  How often a pattern occurs is counted over the whole
corpus, so common words never become a pattern.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import GRAPH_WORD, Bloom, bloom_of, keep, load, mix, text_slices, word_hashes, words_in_rows

KINDS = ("email", "ip", "card", "phone", "context")
#: Different trusted instances a pattern needs, score an instance needs, turns
#: of scoring in a round.
SUPPORT, TRUST, ROUNDS = 3, 0.6, 3
BLOOM_BITS = 24
#: Counts of patterns that a task holds (32 MB).
MOST_COUNTED = 1_000_000

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Strings of five characters or more with three digits or an @.
IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9@._%+/-]{3,}[A-Za-z0-9]")
_HINT = np.zeros(256, bool)
_HINT[0x30:0x3A] = _HINT[0x40] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, in linear time: the local part is
    what stands before an @, back to the match before."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done:
            before = text[done:at]
            start = done + len(before.rstrip(LOCAL))
            domain = DOMAIN.match(text, at + 1)
            if start < at and domain:
                out.append((start, domain.end()))
                done = domain.end()
            elif start == at or not domain:
                done = max(done, at + 1)
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), ordered."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def identifiers(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like strings that no base span touches."""
    taken = sorted((a, b) for a, _, b in base)
    out, at = [], 0
    reach = 0
    for m in IDENTIFIER.finditer(text):
        if sum(c.isdigit() for c in m[0]) < 3 and "@" not in m[0]:
            continue
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= m.start():
            out.append((m.start(), m.end()))
    return out


def _pairs(raw: np.ndarray, offsets: np.ndarray):
    """Words of a slice, the hash of each and of each pair of neighbours."""
    starts, ends, first = words_in_rows(raw, offsets, GRAPH_WORD)
    words = word_hashes(raw, starts, ends)
    pairs = mix(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:]) if len(words) > 1 else words[:0]
    return starts, ends, first, words, pairs


_SIDES = (np.uint64(0x632BE59BD9B4E019), np.uint64(0x9E3779B97F4A7C15))  # before, after

SPAN = "struct<start:int,kind:int,end:int>"
#: A pattern and the one-word pattern it contains (itself, if it is one).
AROUND = "struct<pattern:bigint,word:bigint>"
FOUND = f"base array<{SPAN}>, cands array<struct<start:int,end:int,value:string,seed:boolean,patterns:array<{AROUND}>>>"


def _extract(batches):
    """Base spans and instances with the patterns around them."""
    import pyarrow as pa

    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    pattern = pa.struct([("pattern", pa.int64()), ("word", pa.int64())])
    cand = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pattern))])
    for batch in batches:
        for low, high, raw, offsets in text_slices(batch.column(1)):
            rows = high - low
            hint = np.concatenate(([0], np.cumsum(_HINT[raw], dtype=np.int64)))
            hinted = np.flatnonzero(hint[offsets[1:]] > hint[offsets[:-1]])
            base, cands = [[] for _ in range(rows)], [[] for _ in range(rows)]
            if len(hinted):
                starts, _, first, words, pairs = _pairs(raw, offsets)
                words, pairs = [(words ^ x).view(np.int64) for x in _SIDES], [(pairs ^ x).view(np.int64) for x in _SIDES]
            for i in hinted.tolist():
                own = raw[offsets[i] : offsets[i + 1]]
                text = own.tobytes().decode("utf-8", "replace")
                # Byte offset of each code point, once per text.
                place = None if text.isascii() else np.flatnonzero((own & 0xC0) != 0x80)
                found = base_spans(text)
                base[i] = [{"start": a, "kind": k, "end": b} for a, k, b in found]
                seeds = [(a, b, True) for a, _, b in found]
                for a, b, seed in [*seeds, *((a, b, False) for a, b in identifiers(text, found))]:
                    at = offsets[i] + (a if place is None else place[a])
                    to = offsets[i] + (b - 1 if place is None else place[b - 1])
                    left = int(np.searchsorted(starts, at, side="right")) - 1
                    right = int(np.searchsorted(starts, to, side="right")) - 1
                    around = []
                    if left - 1 >= first[i]:
                        word = int(words[0][left - 1])
                        around.append({"pattern": word, "word": word})
                        if left - 2 >= first[i]:
                            around.append({"pattern": int(pairs[0][left - 2]), "word": word})
                    if right + 1 < first[i + 1]:
                        word = int(words[1][right + 1])
                        around.append({"pattern": word, "word": word})
                        if right + 2 < first[i + 1]:
                            around.append({"pattern": int(pairs[1][right + 1]), "word": word})
                    cands[i].append({"start": a, "end": b, "value": text[a:b].lower(), "seed": seed, "patterns": around})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, rows), pa.array(base, pa.list_(span)), pa.array(cands, pa.list_(cand))], names=["row", "base", "cands"]
            )


def _occurrences(bloom, bits: int, most: int = MOST_COUNTED):
    """How often the known patterns occur, as words or pairs of words
    anywhere.  Counts are added up over the task's slices of text, so a
    pattern has a row a task and not one a slice; more than ``most`` counts are
    handed on, so memory is bounded."""

    def run(batches):
        import pyarrow as pa

        known = Bloom(bits, bloom.value)
        keys, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def added() -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(np.concatenate([keys, *(k for k, _ in waiting)]), return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, at, np.concatenate([times, *(t for _, t in waiting)]))
            waiting.clear()
            return found, total

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], names=["pattern", "n"])

        for batch in batches:
            for _, _, raw, offsets in text_slices(batch.column(0)):
                _, _, first, words, pairs = _pairs(raw, offsets)
                inside = np.ones(len(pairs), bool)
                cut = first[1:-1] - 1
                inside[cut[(cut >= 0) & (cut < len(pairs))]] = False
                words, often = np.unique(words, return_counts=True)
                for side in _SIDES:
                    both = pairs[inside] ^ side
                    waiting.append(np.unique(both[known.has(both)], return_counts=True))
                    single = known.has(words ^ side)
                    waiting.append((words[single] ^ side, often[single]))
                if sum(len(k) for k, _ in waiting) >= max(len(keys), most // 8):
                    keys, times = added()
                    if len(keys) > most:
                        yield rows()
                        keys, times = keys[:0], times[:0]
        keys, times = added()
        yield rows()

    return run


def score_graph(edges: DataFrame, support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """(value, seed, score) of the instances that reach ``trust``.  ``edges``:
    (pattern, word, value, seed, n, all), one row per pattern and value; word
    is the one-word pattern inside, all counts the pattern in the corpus.

    In each round the patterns with ``support`` different seeds or instances
    trusted so far have a say.  Scores only grow from round to round, so the
    trusted set does too, and the rounds end when it does not grow."""
    trusted, known = None, -1
    while True:
        start = F.when(F.col("seed"), F.lit(1.0))
        if trusted is None:
            started = edges.withColumn("start", start.otherwise(0.0))
        else:
            before = trusted.select("value", F.col("score").alias("before"))
            started = edges.join(before, "value", "left").withColumn("start", start.otherwise(F.coalesce("before", F.lit(0.0)))).drop("before")
        able = started.where("start > 0").groupBy("pattern").agg(F.count("*").alias("held")).where(F.col("held") >= support)
        active = keep(started.join(able.select("pattern"), "pattern"), "pii-graph")
        instances = active.groupBy("value").agg(F.max("start").alias("score"))
        for _ in range(rounds):
            patterns = active.join(instances, "value").groupBy("pattern").agg(
                F.least(F.lit(1.0), F.sum(F.col("score") * F.col("n")) / F.max(F.greatest("all", F.lit(1)))).alias("weight")
            )
            doubt = F.log(F.greatest(F.lit(1e-9), 1 - F.col("weight")))
            single = F.col("pattern") == F.col("word")
            sides = active.join(patterns, "pattern").groupBy("value", "word").agg(
                F.max("seed").alias("seed"),
                F.least(F.coalesce(F.sum(F.when(~single, doubt)), F.lit(0.0)), F.coalesce(F.min(F.when(single, doubt)), F.lit(0.0))).alias("doubt"),
            )
            instances = sides.groupBy("value").agg(
                F.max("seed").alias("seed"), F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(F.sum("doubt"))).alias("score")
            )
        trusted = keep(instances.where(F.col("score") >= trust), "pii-trusted")
        count = trusted.where("not seed").count()
        if count == 0 or count == known:
            return trusted
        known = count


def counted(edges: DataFrame, able: DataFrame, found_again: DataFrame) -> DataFrame:
    """``edges`` of the patterns in ``able``, with ``all``: how often the
    pattern occurs.  ``found_again`` (pattern, n) has a row for each part of the
    corpus with the pattern, so it is added up before it meets another table; a
    semi-join with it would be moved below the sum, onto all those rows."""
    totals = found_again.groupBy("pattern").agg(F.sum("n").alias("all"))
    known = able.select("pattern", F.lit(True).alias("known")).join(totals, "pattern").drop("known")
    return edges.join(known, "pattern")


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS,
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, base_sha256,
    n_context and spans (kind:start:end, comma-joined, by start and kind; code
    points, end exclusive).

    Null and empty texts have no span.  Added spans never touch base ones.
    Repeated ids and rows stay apart.  An empty table gives no rows.
    """
    ids = docs.schema[id_col].dataType.simpleString()
    row = F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid")).alias("row")
    found = docs.select(row, F.col(text_col).alias("text")).mapInArrow(_extract, f"row struct<id:{ids},rid:bigint>, {FOUND}")
    found = keep(found.select("row.id", "row.rid", "base", "cands"), "pii-instances")
    uses = found.select("rid", F.explode("cands").alias("c")).select("rid", "c.*")
    edges = uses.select(F.explode("patterns").alias("p"), "value", "seed").select("p.pattern", "p.word", "value", "seed")
    edges = keep(edges.groupBy("pattern", "word", "value").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), "pii-edges")
    # Patterns around fewer instances, trusted or not, can have no say in any round.
    able = keep(edges.groupBy("pattern").agg(F.count("*").alias("c")).where(F.col("c") >= support), "pii-patterns")
    bloom = bloom_of(able, "pattern", bloom_bits)
    found_again = docs.select(text_col).mapInArrow(_occurrences(bloom, bloom_bits), "pattern bigint, n bigint")
    edges = keep(counted(edges, able, found_again), "pii-counted")
    trusted = score_graph(edges, support, trust, rounds).select("value")
    more = uses.where("not seed").join(trusted, "value").groupBy("rid").agg(
        F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end")).alias("more")
    )
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    out = found.drop("cands").join(more, "rid", "left").withColumn("more", F.coalesce("more", none))

    def listed(spans: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(
            F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(4)]
    return out.select(
        F.col("id").alias(id_col), *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        F.size("more").cast("bigint").alias("n_context"), listed(F.concat("base", "more")).alias("spans"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(load(spark, sf_dir, "documents"))
