"""ledgerlake: a Spark-native engine for company-filings analytics.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function whose
column names are parameters, so the same code runs on filings, prices and
transcripts and on any other table that plays those roles.
"""

from ledgerlake.session import (
    SCALE_DEFAULTS,
    apply_scale_defaults,
    build_session,
    checkpoint_dir,
    materialize,
)

__all__ = [
    "SCALE_DEFAULTS",
    "apply_scale_defaults",
    "build_session",
    "checkpoint_dir",
    "materialize",
]
