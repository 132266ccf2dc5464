"""Secret scans: patterns and character Markov models (operator 8),
DataFrame functions only.

Three patterns give the base spans.  The method adds what they miss: in the
parts of long unbroken runs of key characters that no base span covers, the
stretches are sought whose log-likelihood ratio of two first-order Markov
models over character classes, one of random strings, one of ordinary
identifiers, is high per character.  A key is found wherever it stands in a
path or a slug, and several in one run.  Both models are trained from labelled
samples: values that follow a credential name or have a key's form (random),
and words and identifiers (ordinary).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import load, spans_before, spans_of, text_or_empty

ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"
#: Runs the models judge: at least this many key characters.
LEAST = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
KINDS = ("assign", "access", "hex", "markov")
THRESHOLD = 1.7
#: A stretch ends where its score falls this much below its highest.
DROP = 20.0
#: What a stretch must score above the threshold in sum: the best of many
#: stretches of an ordinary name passes the threshold by chance, rarely by much.
EVIDENCE = 20.0
SYMBOLS = "abcdefghijklmnopqrstuvwxyzA0+"

Spans = "array<struct<start:int,end:int,hit:string>>"


def _none() -> Column:
    return F.expr(f"cast(array() as {Spans})")


def _folded(run: Column) -> Column:
    """Characters as symbols of the models: lower letters as they are, upper
    letters as A, digits as 0, the rest as +."""
    upper, digits, other = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "/_=-+."
    return F.translate(run, upper + digits + other, "A" * 26 + "0" * 10 + "+" * len(other))


def base_spans(text: Column) -> list[Column]:
    """Base spans by kind.  Cheap tests that every match passes come first, so
    most texts meet no capturing pattern."""
    low = F.lower(text)
    named = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        named = named | F.contains(low, F.lit(word))
    assign = F.filter(
        F.when(named, spans_of(text, ASSIGN)).otherwise(_none()),
        lambda s: F.length(F.regexp_extract(s["hit"], "^" + ASSIGN + "$", 2)) >= 6,
    )
    access = F.filter(
        F.when(F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS)).otherwise(_none()), lambda s: F.length(s["hit"]) >= 20
    )
    # Runs are maximal, so matches of 24 characters or more are the long runs.
    long_hex = F.when(text.rlike("[0-9a-f]{24}"), spans_of(text, HEX)).otherwise(_none())
    return [assign, access, long_hex]


def labelled_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(sample, random, n): values with a key's form or behind a credential
    name are random strings; words of letters and underscores, identifiers among
    them, are ordinary.  n is the number of documents (rows) that hold the sample,
    over all documents; equal samples are summed before they are shuffled."""
    text = text_or_empty(text_col)
    _assign, access, long_hex = base_spans(text)
    value = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    secret = F.concat(F.transform(access, lambda s: s["hit"]), F.transform(long_hex, lambda s: s["hit"]))
    keyed = F.filter(value, lambda v: (F.length(v) >= LEAST) & v.rlike("[0-9]") & v.rlike("[A-Za-z]"))
    words = F.regexp_extract_all(text, F.lit(r"[A-Za-z_]{3,40}"), F.lit(0))
    made = F.array(F.struct(F.array_union(secret, keyed).alias("all"), F.lit(True).alias("random")),
                   F.struct(F.array_distinct(words).alias("all"), F.lit(False).alias("random")))
    pairs = docs.select(F.explode(made).alias("m"))
    return pairs.select(F.explode("m.all").alias("sample"), "m.random").groupBy("sample", "random").agg(F.count("*").alias("n"))


def train_models(samples: DataFrame) -> dict[str, float]:
    """Log-likelihood ratio (random over ordinary) of each pair of symbols,
    with add-one counts.  Pairs are counted in Spark; at most
    ``2 * len(SYMBOLS) ** 2`` counts reach the driver.  Without samples of
    random strings they count as uniform over keys of letters and digits."""
    folded = _folded(F.col("sample"))
    pairs = F.transform(F.sequence(F.lit(1), F.length("f") - 1), lambda i: F.substring(F.col("f"), i, F.lit(2)))
    rows = samples.select("random", folded.alias("f"), "n").where(F.length("f") >= 2).select("random", F.explode(pairs).alias("pair"), "n")
    counted = {(r["random"], r["pair"]): r["n"] for r in rows.groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()}
    wide = {"A": 26.0, "0": 10.0, "+": 2.0}  # characters behind a symbol

    def logs(random: bool) -> dict[str, float]:
        table = {}
        for a in SYMBOLS:
            row = {b: counted.get((random, a + b), 0) + (wide.get(b, 1.0) if random else 1.0) for b in SYMBOLS}
            whole = sum(row.values())
            table |= {a + b: math.log(row[b] / whole) for b in row}
        return table

    random, ordinary = logs(True), logs(False)
    return {p: random[p] - ordinary[p] for p in random}


def _free_pieces(run: Column, kinds: Sequence[str]) -> Column:
    """Parts of a run that no base span covers, as (start, hit).  The spans of
    a kind are disjoint and in order, so those that touch the run are found by
    two binary searches."""
    def touching(number: int, name: str) -> Column:
        spans = F.col(name)
        before = spans_before(spans, "end", run["start"], or_equal=True)
        near = F.slice(spans, before + 1, F.greatest(spans_before(spans, "start", run["end"]) - before, F.lit(0)))
        return F.transform(near, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))

    inside = F.array_sort(F.concat(*[touching(i, name) for i, name in enumerate(kinds)]))
    edges = F.concat(inside, F.array(F.struct(run["end"].alias("start"), F.lit(0).alias("kind"), run["end"].alias("end"))))
    empty = F.struct(run["start"].alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("all"))

    def step(acc: Column, b: Column) -> Column:
        piece = F.array(F.struct(acc["at"].alias("start"), b["start"].alias("end")))
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.when(b["start"] > acc["at"], F.concat(acc["all"], piece)).otherwise(acc["all"]).alias("all"))

    pieces = F.filter(F.aggregate(edges, empty, step, lambda acc: acc["all"]), lambda p: p["end"] - p["start"] >= LEAST)
    return F.transform(
        pieces, lambda p: F.struct(p["start"].alias("start"), F.substring(run["hit"], p["start"] - run["start"] + 1, p["end"] - p["start"]).alias("hit"))
    )


def _gains(hit: Column, ratios: dict[str, float], threshold: float) -> Column:
    """For each pair of characters its log-likelihood ratio less the threshold."""
    wide = len(SYMBOLS) + 1  # place 0: no symbol
    flat = [0.0] * (wide * wide)
    for pair, ratio in ratios.items():
        flat[(SYMBOLS.index(pair[0]) + 1) * wide + SYMBOLS.index(pair[1]) + 1] = round(ratio, 6)
    table = F.from_json(F.lit(json.dumps(flat)), "array<double>")
    places = F.transform(F.split(_folded(hit), ""), lambda c: F.instr(F.lit(SYMBOLS), c))
    # The last place has no partner and is cut off.
    pairs = F.zip_with(F.slice(places, 1, F.size(places) - 1), F.slice(places, 2, F.size(places) - 1), lambda a, b: F.get(table, a * wide + b))
    return F.transform(pairs, lambda r: r - F.lit(threshold))


def _stretches(gains: Column) -> Column:
    """Disjoint stretches (from, to; characters of the piece, end exclusive) of
    at least LEAST characters whose gains sum to EVIDENCE or more: one pass with
    the running sum and, LEAST - 1 pairs behind, its lowest value so far.  A
    stretch ends at its highest sum once the sum falls DROP below; the search
    goes on from there."""
    lag = LEAST - 1
    none = F.lit(None)
    state = F.struct(
        F.lit(0).alias("at"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("late"), F.lit(0).alias("base"),
        none.cast("double").alias("low"), F.lit(0).alias("low_at"), none.cast("double").alias("best"), F.lit(0.0).alias("top"),
        F.lit(0).alias("from"), F.lit(0).alias("to"), F.expr("cast(array() as array<struct<from:int,to:int>>)").alias("all"),
    )

    def closed(acc: Column) -> Column:
        more = F.concat(acc["all"], F.array(F.struct(acc["from"].alias("from"), acc["to"].alias("to"))))
        return F.when(acc["best"] >= EVIDENCE, more).otherwise(acc["all"])

    def step(acc: Column, x: Column) -> Column:
        # x: this gain, and the one that the late sum takes now
        at, start = acc["at"] + 1, acc["at"] + 1 - lag
        total = acc["sum"] + x["gain"]
        late = acc["late"] + x["late"]
        fresh = (start >= acc["base"]) & (acc["low"].isNull() | (late < acc["low"]))
        low = F.when(fresh, late).otherwise(acc["low"])
        better = (total >= low) & (acc["best"].isNull() | (total - low >= acc["best"]))
        ends = acc["best"].isNotNull() & (total < acc["top"] - DROP)
        better = F.coalesce(better, F.lit(False)) & ~ends
        return F.struct(
            at.alias("at"), total.alias("sum"), late.alias("late"), F.when(ends, at).otherwise(acc["base"]).alias("base"),
            F.when(~ends, low).alias("low"), F.when(fresh, start).otherwise(acc["low_at"]).alias("low_at"),
            F.when(better, total - low).when(~ends, acc["best"]).alias("best"), F.when(better, total).otherwise(acc["top"]).alias("top"),
            F.when(better & fresh, start).when(better, acc["low_at"]).otherwise(acc["from"]).alias("from"),
            F.when(better, at + 1).otherwise(acc["to"]).alias("to"), F.when(ends, closed(acc)).otherwise(acc["all"]).alias("all"),
        )

    behind = F.concat(F.array_repeat(F.lit(0.0), lag), gains)
    both = F.zip_with(gains, F.slice(behind, 1, F.size(gains)), lambda g, b: F.struct(g.alias("gain"), b.alias("late")))
    return F.aggregate(both, state, step, closed)


def _whole(hit: Column, stretches: Column) -> Column:
    """Stretches extended to the next separators, so that no end of a key is
    left out, and joined where they then overlap."""
    wider = F.transform(stretches, lambda s: F.struct(
        (s["from"] - F.length(F.regexp_extract(F.substring(hit, F.lit(1), s["from"]), "[A-Za-z0-9]*$", 0))).alias("from"),
        (s["to"] + F.length(F.regexp_extract(F.substring(hit, s["to"] + 1, F.length(hit)), "^[A-Za-z0-9]*", 0))).alias("to"),
    ))

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["from"].alias("from"), F.greatest(last["to"], s["to"]).alias("to"))))
        return F.when(last["to"] > s["from"], joined).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(wider, F.expr("cast(array() as array<struct<from:int,to:int>>)"), step)


def scan(docs: DataFrame, ratios: dict[str, float], threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256,
    n_markov and spans (kind:start:end, comma-joined, by start and kind).

    Null and empty texts have no span.  Added spans never overlap base ones.
    Rows are judged one by one; repeated ids and rows stay.  An empty table
    gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kinds = base_spans(F.col("text"))
    runs = F.when(F.col("text").rlike(RUN), spans_of(F.col("text"), RUN)).otherwise(_none())
    rows = rows.select("id", *[k.alias(n) for k, n in zip(kinds, KINDS)], runs.alias("runs"))

    def ordered(number: int, name: str) -> Column:
        return F.transform(name, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))

    rows = rows.withColumn("base", F.concat(*[ordered(i, n) for i, n in enumerate(KINDS[:3])]))

    rows = rows.withColumn("pieces", F.flatten(F.transform("runs", lambda r: _free_pieces(r, KINDS[:3]))))
    rows = rows.withColumn("pieces", F.transform(
        "pieces", lambda p: F.struct(p["start"].alias("start"), p["hit"].alias("hit"), _gains(p["hit"], ratios, threshold).alias("gains"))
    ))
    rows = rows.withColumn("pieces", F.transform("pieces", lambda p: F.struct(
        p["start"].alias("start"), p["hit"].alias("hit"), _whole(p["hit"], _stretches(p["gains"])).alias("keys"),
        (F.aggregate(p["gains"], F.lit(0.0), lambda acc, g: acc + g) >= 0).alias("high"),
    )))

    def keys(piece: Column) -> Column:
        # A piece that is high as a whole counts also where no stretch stands out.
        all_ = F.array(F.struct(F.lit(0).alias("from"), F.length(piece["hit"]).alias("to")))
        return F.when((F.size(piece["keys"]) == 0) & piece["high"] & piece["hit"].rlike("[0-9]"), all_).otherwise(piece["keys"])

    found = F.transform("pieces", lambda p: F.transform(
        keys(p), lambda s: F.struct((p["start"] + s["from"]).alias("start"), (p["start"] + s["to"]).alias("end"))
    ))
    rows = rows.withColumn("markov", F.flatten(found))

    def listed(spans: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(
            F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def size(name: str) -> Column:
        return F.size(name).cast("bigint").alias(f"n_{name}")

    return rows.select(
        F.col("id").alias(id_col), size("assign"), size("access"), size("hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), size("markov"),
        listed(F.concat("base", ordered(3, "markov"))).alias("spans"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return scan(docs, train_models(labelled_samples(docs)))
