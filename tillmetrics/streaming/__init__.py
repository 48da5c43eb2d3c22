"""The four questions as checkpointed Structured Streaming jobs."""

from tillmetrics.streaming.ingest import (
    announced_files,
    fresh_batches,
    land_stream,
    read_batch_files,
    stream_dataset,
    stream_landed,
    stream_messages,
)
from tillmetrics.streaming.running import (
    current_totals,
    finish,
    latest_totals,
    observed,
    read_epochs,
    start_append,
    start_totals,
    write_epoch,
)
from tillmetrics.streaming.session import (
    Answers,
    Session,
    announcements,
    batch_counts,
    close_clients,
    closed_clients,
    compact_landing,
    completed_clients,
    read_session,
    run_session,
)

__all__ = [
    "Answers",
    "Session",
    "announced_files",
    "announcements",
    "batch_counts",
    "close_clients",
    "closed_clients",
    "compact_landing",
    "completed_clients",
    "current_totals",
    "finish",
    "fresh_batches",
    "land_stream",
    "latest_totals",
    "observed",
    "read_batch_files",
    "read_epochs",
    "read_session",
    "run_session",
    "start_append",
    "start_totals",
    "stream_dataset",
    "stream_landed",
    "stream_messages",
    "write_epoch",
]
