"""Column-level functions: scalars, price classes, text measures."""

from ledgerlake.functions.classify import change_class, percent_change
from ledgerlake.functions.scalars import (
    any_null,
    calendar_parts,
    date_key,
    days_between,
    default_range,
    epoch_to_date,
    fact_transcript_key,
    filing_url,
    first_key,
    first_value,
    fill_period,
    full_year_as_q4,
    join_list,
    minus_months,
    month_label,
    month_steps,
    null_count,
    pad_cik,
    parse_date,
    quarter_label,
    report_year,
    transcript_key,
)
from ledgerlake.functions.text import (
    add_text_measures,
    clean_text,
    logits_udf,
    sentiment_score,
    softmax_margin,
    text_measures,
)

__all__ = [name for name in dir() if not name.startswith("_")]
