"""Quality rules: a learned decision list over text statistics (operator 12).

1. One vectorised pass measures every whole text: sizes, symbols, repeated
   lines and repeated passages, letter case, marks and word shapes.
2. The list is learned by sequential covering from a bounded sample of
   labelled rows.  A rule is a conjunction of thresholds on statistics.  It is
   *grown* on two thirds of the rows that no earlier rule covers, one
   threshold at a time, by information gain for the poor texts; it is *pruned*
   on the other third, by dropping its last thresholds while that raises its
   value there.  A rule that does not hold up there ends the list.
3. The list is emitted as an ordered Spark conditional expression, so the
   verdict is plain SQL over the statistics and can be read and printed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import AS_IS, GRAPH_WORD, keep, load, mix, text_slices, word_hashes, words_in_rows

#: Labelled rows that the list is learned from, about, at most.
SAMPLE = 20_000
WINDOW = 8
MOST_RULES, MOST_TESTS, CUTS = 12, 4, 64
#: A rule must be right on this share of the pruning rows that it covers, and cover so many.
LEAST_PRECISION, LEAST_COVERED = 0.8, 3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Shares and means that the rules may test.  Labels, language, source and
#: identifier are never among them.
STATISTICS = [
    "n_words", "mean_word", "longest_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "mark_share", "other_share", "distinct_share", "top_word_share", "line_words", "capital_words", "no_letter_words", "exclaim_share",
]

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_EXCLAIM = np.zeros(256, bool)
_EXCLAIM[list(b"!?")] = True
_MARK = GRAPH_WORD & ~_LETTER & ~_DIGIT
_MARK[:0x21] = _MARK[0x7F] = False
_OTHER = np.arange(256) >= 0x80
_LINE = np.ones(256, bool)
_LINE[0x0A] = False
_START = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Set flags inside each span."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def _by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row, given the place of its first one."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _repeats(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries equal an earlier one of their row, and which equal any
    other one of it.  ``row`` is sorted; entries count as equal on 64-bit hashes."""
    order = np.lexsort((np.arange(len(row)), hashes, row))
    same = (row[order][1:] == row[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    later, shared = np.zeros(len(row), bool), np.zeros(len(row), bool)
    later[order[1:][same]] = True
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    return later, shared


def measure(raw: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Counts and statistics of the rows of a slice."""
    rows, low, high = len(offsets) - 1, offsets[:-1], offsets[1:]
    starts, ends, first = words_in_rows(raw, offsets, GRAPH_WORD)
    n = np.diff(first)
    row = np.repeat(np.arange(rows), n)
    hashes = word_hashes(raw, starts, ends, AS_IS)
    # Windows inside a row; the words of those found twice or more.
    repeated = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= window:
        grams = np.zeros(len(hashes) - window + 1, np.uint64)
        for i in range(window):
            grams = grams * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + len(grams)]
        at = np.flatnonzero(row[: len(grams)] == row[window - 1 :])
        _, shared = _repeats(row[at], mix(grams[at]))
        np.add.at(repeated, at[shared], 1)
        np.add.at(repeated, at[shared] + window, -1)
    covered = (np.cumsum(repeated)[:-1] > 0).astype(np.int64)
    # Lines with a word.
    l_starts, l_ends, l_first = words_in_rows(raw, offsets, _LINE)
    l_row = np.repeat(np.arange(rows), np.diff(l_first))
    full = _sums(GRAPH_WORD[raw], l_starts, l_ends) > 0
    l_starts, l_ends, l_row = l_starts[full], l_ends[full], l_row[full]
    again, _ = _repeats(l_row, word_hashes(raw, l_starts, l_ends, AS_IS))
    lines = np.bincount(l_row, minlength=rows)

    length = _sums(_START[raw], starts, ends)
    longest, top = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    np.maximum.at(longest, row, length)
    keys, times = np.unique((row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)), return_counts=True)
    key_row = (keys >> np.uint64(40)).astype(np.int64)
    np.maximum.at(top, key_row, times)
    size = high - low
    out = {
        "n_words": n, "word_chars": _by_row(length, first), "n_symbols": _sums(_SYMBOL[raw], low, high),
        "n_dup_lines": np.bincount(l_row[again], minlength=rows), "n_repeat_words": _by_row(covered, first),
    }
    capital = _UPPER[raw[starts]] if len(starts) else np.zeros(0, bool)
    bare = _sums(_LETTER[raw], starts, ends) == 0
    out |= {
        "mean_word": _share(out["word_chars"], n), "longest_word": longest, "symbol_share": _share(out["n_symbols"], size),
        "dup_line_share": _share(out["n_dup_lines"], lines), "repeat_share": _share(out["n_repeat_words"], n),
        "upper_share": _share(_sums(_UPPER[raw], low, high), _sums(_LETTER[raw], low, high)),
        "digit_share": _share(_sums(_DIGIT[raw], low, high), size), "mark_share": _share(_sums(_MARK[raw], low, high), size),
        "other_share": _share(_sums(_OTHER[raw], low, high), size),
        "distinct_share": _share(np.bincount(key_row, minlength=rows), n), "top_word_share": _share(top, n),
        "line_words": _share(n, lines), "capital_words": _share(_by_row(capital.astype(np.int64), first), n),
        "no_letter_words": _share(_by_row(bare.astype(np.int64), first), n),
        "exclaim_share": _share(_sums(_EXCLAIM[raw], low, high), size),
    }
    return out


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, all COUNTS and STATISTICS) of every whole text, one row per input
    row.  A null text is the empty one: its counts and shares are 0.  Equality
    of windows and lines rests on 64-bit hashes."""
    names = list(dict.fromkeys([*COUNTS, *STATISTICS]))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for low, high, raw, offsets in text_slices(batch.column(1)):
                got = measure(raw, offsets, window)
                columns = [pa.array(got[c].astype(np.int64 if c in COUNTS else np.float64)) for c in names]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *columns], names=[id_col, *names])

    own = docs.select(F.col(id_col), F.col(text_col))
    types = [T.StructField(c, T.LongType() if c in COUNTS else T.DoubleType()) for c in names]
    return own.mapInArrow(run, T.StructType([own.schema[id_col], *types]))


# --- learning -----------------------------------------------------------------------

@dataclass
class Rule:
    """A conjunction of (statistic, 'le' or 'gt', threshold)."""

    tests: list[tuple[str, str, float]] = field(default_factory=list)

    def covers(self, table: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(table.values()))), bool)
        for name, kind, cut in self.tests:
            out &= table[name] <= cut if kind == "le" else table[name] > cut
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, kind, cut in self.tests:
            out = out & (F.col(name) <= F.lit(cut) if kind == "le" else F.col(name) > F.lit(cut))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{name} {'<=' if kind == 'le' else '>'} {cut:.6g}" for name, kind, cut in self.tests) or "always"


def _gain(poor: np.ndarray, good: np.ndarray, p0: int, g0: int) -> np.ndarray:
    """Information gain for the poor texts that stay covered."""
    before = np.log2(p0 / (p0 + g0))
    after = np.log2(np.maximum(poor, 1) / np.maximum(poor + good, 1))
    return np.where(poor > 0, poor * (after - before), -np.inf)


def _grow(table: dict[str, np.ndarray], poor: np.ndarray, most_tests: int) -> Rule:
    rule, inside = Rule(), np.ones(len(poor), bool)
    while len(rule.tests) < most_tests:
        p0, g0 = int(poor[inside].sum()), int((~poor[inside]).sum())
        if not p0 or not g0:
            break
        best = (1e-9, None)
        for name in STATISTICS:
            x, y = table[name][inside], poor[inside]
            cuts = np.unique(np.quantile(x, np.linspace(0, 1, CUTS + 1)[1:-1], method="lower"))
            order = np.sort(x[y]), np.sort(x[~y])
            p_le, g_le = (np.searchsorted(o, cuts, side="right") for o in order)
            for kind, p, g in (("le", p_le, g_le), ("gt", p0 - p_le, g0 - g_le)):
                gain = _gain(p, g, p0, g0)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), (name, kind, float(cuts[i])))
        if best[1] is None:
            break
        # Halfway to the next value: a text between the two kinds is not judged by the last one seen.
        name, kind, cut = best[1]
        above = table[name][inside & (table[name] > cut)]
        rule.tests.append((name, kind, (cut + float(above.min())) / 2 if len(above) else cut))
        inside = rule.covers(table)
    return rule


def _prune(rule: Rule, table: dict[str, np.ndarray], poor: np.ndarray) -> tuple[Rule, float, int]:
    """The beginning of the rule that is worth most on the pruning rows, its
    precision there and how many poor texts it covers."""
    best = (Rule(), -np.inf, 0.0, 0)
    for length in range(1, len(rule.tests) + 1):
        short = Rule(rule.tests[:length])
        inside = short.covers(table)
        p, g = int(poor[inside].sum()), int((~poor[inside]).sum())
        worth = (p - g) / (p + g) if p + g else -1.0
        if worth > best[1]:
            best = (short, worth, p / (p + g) if p + g else 0.0, p)
    return best[0], best[2], best[3]


def learn(table: dict[str, np.ndarray], poor: np.ndarray, most_rules: int = MOST_RULES, most_tests: int = MOST_TESTS) -> list[Rule]:
    """Rules for poor texts, in order; a text that none covers is good."""
    rules: list[Rule] = []
    third = np.arange(len(poor)) % 3 == 2
    left = np.ones(len(poor), bool)
    while len(rules) < most_rules:
        for_grow, for_prune = left & ~third, left & third
        if not poor[for_grow].any():
            break
        rule = _grow({k: v[for_grow] for k, v in table.items()}, poor[for_grow], most_tests)
        if not rule.tests:
            break
        rule, precision, covered = _prune(rule, {k: v[for_prune] for k, v in table.items()}, poor[for_prune])
        if precision < LEAST_PRECISION or covered < LEAST_COVERED:
            break
        rules.append(rule)
        left &= ~rule.covers(table)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional expression: the number of the first
    rule that covers the row, null where none does."""
    out = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        out = F.when(rules[i].column(), F.lit(i + 1)).otherwise(out)
    return out


def held_out(id_col: str) -> Column:
    """Rows whose crc32(id as text) mod 4 is 2 teach nothing."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", label_col: str = "quality", bad: Column | None = None) -> list[Rule]:
    """Learn the list from about ``sample`` labelled rows at most, drawn by a
    hash of the id.  Several labels of an id are averaged; null labels and
    null ids do not count; of the rows that share an id one teaches.  Rows that
    ``bad`` already rejects teach nothing either.  Without labels of both
    kinds the list is empty."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(F.col(label_col).cast("double")) < 0.5).alias("_poor"))
    total = known.count()
    if total > sample:  # a 62-bit draw, so that no share of a large table rounds to nothing
        draw = F.shiftrightunsigned(F.xxhash64("_id", F.lit(12)), 2)
        known = known.where(draw < F.lit((1 << 62) * sample // total))
    rows = measured.join(known, F.col(id_col) == F.col("_id"))
    if bad is not None:
        rows = rows.where(~bad)
    one = F.min(F.struct(*STATISTICS)).alias("s")
    got = rows.groupBy("_id", "_poor").agg(one).select(F.xxhash64("_id").alias("o"), "_poor", "s.*").toPandas()
    got = got.sort_values(["o", *STATISTICS], kind="stable")
    poor = got["_poor"].to_numpy(bool)
    if not poor.any() or poor.all():
        return []
    return learn({c: got[c].to_numpy(np.float64) for c in STATISTICS}, poor)


def rule_quality(
    docs: DataFrame, labels: DataFrame, least_words: int = 20, most_repeat_percent: int = 30, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample: int = SAMPLE,
) -> tuple[DataFrame, list[Rule]]:
    """One row per input row: id, COUNTS, STATISTICS, base_failed, rule (the
    number of the learned rule that covers it, else null), kept; and the rules.

    A text fails the base rules when it has fewer than ``least_words`` words,
    or more than ``most_repeat_percent`` of them lie in repeated windows.
    Null, empty and wordless texts so fail.  Rows that share an id, and null
    ids, are judged one by one.  An empty table gives no rows.
    """
    measured = keep(statistics(docs, id_col, text_col), "rule-statistics")
    bad = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat_percent * F.col("n_words"))
    rules = train(measured, labels, sample, id_col, label_col, bad)
    out = measured.withColumn("base_failed", bad).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _rules = rule_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "rule")
