"""Transcript measures (SCL16), sentiment scoring (SCL17), both together (SCL18).

The word measures are plain Spark expressions over the whole text: a token is
a maximal run of Unicode word characters of the lower-cased, stripped text,
so counting tokens and list words is ``regexp_count`` -- no token arrays are
built and no Python runs per row.  Only the model score needs Python; it runs
as an iterator pandas UDF that loads the model once per worker and scores
Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import ColumnOrName, _c

# The characters Python's str.strip() removes: every code point whose
# str.isspace() is true (all of them lie below U+3001).
EDGE_SPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_WORD = r"(?U)\w+"


def clean_text(c: ColumnOrName) -> Column:
    """Lower-case, then strip white space at both ends (a character-set trim,
    no regular expression)."""
    return F.trim(F.lower(_c(c)), F.lit(EDGE_SPACE))


def _word_list_pattern(words: Sequence[str]) -> str:
    """A listed word as a whole token.  The leading look-ahead on the words'
    first letters rejects most positions before the costlier look-behind."""
    words = [w.lower() for w in words if w]
    firsts = "".join(sorted({"\\" + w[0] if w[0] in "\\[]^-&" else w[0] for w in words}))
    alternatives = "|".join(r"\Q" + w + r"\E" for w in words)
    return r"(?U)(?=[" + firsts + r"])(?<!\w)(?:" + alternatives + r")(?!\w)"


def text_measures(
    c: ColumnOrName,
    positive: Sequence[str] = fixed.POSITIVE_WORDS,
    negative: Sequence[str] = fixed.NEGATIVE_WORDS,
) -> dict[str, Column]:
    """TransLength, TotalTokens, PositiveWordCount, NegativeWordCount.
    Null, empty and blank texts give zeros."""
    clean = clean_text(c)
    blank = clean.isNull() | (F.length(clean) == 0)
    pos, neg = [w.lower() for w in positive], [w.lower() for w in negative]
    # One scan finds every occurrence of a listed word; the two counts are
    # taken from that (short) array.
    hits = F.regexp_extract_all(clean, F.lit(_word_list_pattern(dict.fromkeys(pos + neg))), 0)

    def guard(expr: Column) -> Column:
        return F.when(blank, F.lit(0)).otherwise(expr).cast("bigint")

    return {
        "TransLength": guard(F.length(clean)),
        "TotalTokens": guard(F.regexp_count(clean, F.lit(_WORD))),
        "PositiveWordCount": guard(F.size(F.filter(hits, lambda x: x.isin(pos)))),
        "NegativeWordCount": guard(F.size(F.filter(hits, lambda x: x.isin(neg)))),
    }


def softmax_margin(logits: ColumnOrName, pos: int = 0, neg: int = 1) -> Column:
    """p[pos] - p[neg] of softmax(logits), as a Spark expression (the largest
    logit is subtracted first, so large logits do not overflow)."""
    top = F.array_repeat(F.array_max(_c(logits)).cast("double"), F.size(_c(logits)))
    arr = F.zip_with(_c(logits), top, lambda x, m: F.exp(x.cast("double") - m))
    total = F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return (F.element_at(arr, pos + 1) - F.element_at(arr, neg + 1)) / total


Scorer = Callable[[list[str]], Sequence[Sequence[float]]]


def logits_udf(scorer_factory: Callable[[], Scorer]):
    """Iterator pandas UDF text -> array<double> of logits.

    ``scorer_factory`` is called once per Python worker, so a model is loaded
    once and reused for every Arrow batch (never once per row).
    """

    @F.pandas_udf("array<double>")
    def _logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = scorer_factory()
        for batch in batches:
            texts = batch.fillna("").astype(str).tolist()
            yield pd.Series([list(map(float, row)) for row in scorer(texts)])

    return _logits


def sentiment_score(c: ColumnOrName, scorer_factory: Callable[[], Scorer] | None) -> Column:
    """p(positive) - p(negative); 0.0 for blank text; null without a scorer."""
    raw = _c(c)
    blank = raw.isNull() | (F.length(clean_text(raw)) == 0)
    if scorer_factory is None:
        score = F.lit(None).cast("double")
    else:
        score = softmax_margin(logits_udf(scorer_factory)(raw))
    return F.when(blank, F.lit(0.0)).otherwise(score)


def add_text_measures(
    df: DataFrame,
    text_col: str,
    scorer_factory: Callable[[], Scorer] | None = None,
    positive: Sequence[str] = fixed.POSITIVE_WORDS,
    negative: Sequence[str] = fixed.NEGATIVE_WORDS,
) -> DataFrame:
    """SCL18: the five transcript measures as new columns."""
    cols = text_measures(text_col, positive, negative)
    cols["SentimentScore"] = sentiment_score(text_col, scorer_factory)
    return df.withColumns(cols)
