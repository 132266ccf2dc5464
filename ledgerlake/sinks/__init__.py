"""Sinks (SNK1-SNK5)."""

from ledgerlake.sinks.publish import PublishError, Version, current, publish, read_published, remove_unpublished
from ledgerlake.sinks.tables import (
    export_csv,
    write_fact_table,
    write_jdbc,
    write_table,
    write_transcripts,
    write_validation_table,
)

__all__ = [name for name in dir() if not name.startswith("_")]
