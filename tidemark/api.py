"""What most users need, in one place."""

from .functions.types import DataLoss, SchemaChanged, is_kind
from .sources.capture import CaptureStore
from .sources.feed import register
from .sources.versioned import VersionedTable
from .streaming.finality import Tracker, advance, finalized_until, freshness, is_final
from .streaming.jobs import Tables, apply_changes, await_all, backfill, reconcile, run_stream, snapshot, start_many, stop_all, stream

__all__ = [
    "CaptureStore", "DataLoss", "SchemaChanged", "Tables", "Tracker", "VersionedTable", "advance", "apply_changes", "await_all", "backfill",
    "finalized_until", "freshness", "is_data_loss", "is_final", "is_schema_changed", "reconcile", "register", "run_stream", "snapshot", "start_many", "stop_all", "stream",
]


def is_data_loss(error: BaseException) -> bool:
    """Whether an error, perhaps inside Spark's wrapper, says that changes were purged before they were read."""
    return is_kind(error, DataLoss)


def is_schema_changed(error: BaseException) -> bool:
    return is_kind(error, SchemaChanged)
