"""Delivery completeness on Spark: what was announced, what arrived, what is complete.

Batch operators are in ``operators``, their streaming forms in ``streaming``, topics and
wire formats in ``sources``, column functions in ``functions``.
"""

from .operators.counting import (
    control_profile,
    control_totals,
    declared_counts,
    describe_counts,
    explode_statistics,
    merge_control,
    to_data_messages,
    type_counts,
    with_message_key,
)
from .operators.history import (
    first_completion,
    newly_completed,
    running_counts,
    state_changes,
    windowed_counts,
)
from .operators.reconcile import (
    completed,
    completion_delta,
    control_without_data,
    data_without_control,
    dedup_data,
    latest_control,
    notifications,
    reconcile,
    reconcile_counts,
    status_summary,
)
from .session import build_session, discard_tables
from .sources.codec import decode_messages, encode_messages, quarantine
from .sources.readers import read_control, read_data
from .sources.writers import write_console, write_messages
from .streaming.aggregate import completed_once, end_states, expiry
from .streaming.edges import stream_edges
from .streaming.late import read_judged, start_late_table
from .streaming.run import (
    latest_state,
    local_sessions,
    read_changes,
    start_notifier,
    start_table,
    state_store,
    stream_completed,
    stream_reconcile,
)
from .streaming.snapshot import delivery_history, delivery_snapshot, state_snapshot

__all__ = [
    "build_session",
    "completed",
    "completed_once",
    "completion_delta",
    "control_profile",
    "control_totals",
    "control_without_data",
    "data_without_control",
    "declared_counts",
    "decode_messages",
    "dedup_data",
    "delivery_history",
    "delivery_snapshot",
    "describe_counts",
    "discard_tables",
    "encode_messages",
    "end_states",
    "expiry",
    "explode_statistics",
    "first_completion",
    "latest_control",
    "latest_state",
    "local_sessions",
    "merge_control",
    "newly_completed",
    "notifications",
    "quarantine",
    "read_changes",
    "read_control",
    "read_data",
    "read_judged",
    "reconcile",
    "reconcile_counts",
    "running_counts",
    "start_late_table",
    "start_notifier",
    "start_table",
    "state_changes",
    "state_snapshot",
    "state_store",
    "status_summary",
    "stream_completed",
    "stream_edges",
    "stream_reconcile",
    "to_data_messages",
    "type_counts",
    "windowed_counts",
    "with_message_key",
    "write_console",
    "write_messages",
]
