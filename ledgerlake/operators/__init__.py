"""DataFrame -> DataFrame operators with column names as parameters."""

from ledgerlake.operators.joins import attach_transcripts, merge_filings, null_safe_join, request_grid, years_of
from ledgerlake.operators.periods import decumulate, month_window, next_values, period_means, start_presence
from ledgerlake.operators.prices import add_price_change_class, window_closes
from ledgerlake.operators.projections import (
    clean_column_names,
    clean_name,
    distinct_rows,
    drop_incomplete,
    flatten_lists,
    keep_members,
    rename,
    rows_with_nulls,
    union_all_by_name,
)
from ledgerlake.operators.quality import duplicate_keys, missing_data_flags, null_counts, raise_if_failed, validate
from ledgerlake.operators.reshape import drop_sparse, pivot_facts, pivot_wide
from ledgerlake.operators.versions import newest
from ledgerlake.operators.tags import (
    child_to_parent,
    clean_facts,
    keep_canonical,
    keep_rollup_canonical,
    map_tags,
    raw_tag_allow_list,
    roll_up_tag,
)

__all__ = [name for name in dir() if not name.startswith("_")]
