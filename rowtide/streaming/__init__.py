from rowtide.streaming.changelog import (
    append_to_table,
    await_any,
    batches_by_date,
    start_changelog,
    start_changelogs,
    start_rejects,
)
from rowtide.streaming.history import History
from rowtide.streaming.joins import joined_logs, late_parents, orphaned, with_parents
from rowtide.streaming.maintained import MaintainedJoin, start_maintained_join
from rowtide.streaming.marks import arrivals, once, with_arrival
from rowtide.streaming.progress import Progress
from rowtide.streaming.state import (
    batch_folders,
    drop_redelivered_stream,
    fold_upserts,
    read_change_rate,
    read_current_state,
    read_upserts,
    start_change_alerts,
    start_change_rate,
    start_current_state,
    start_upserts,
    state_keys,
    write_batches,
)

__all__ = [
    "History",
    "MaintainedJoin",
    "Progress",
    "append_to_table",
    "arrivals",
    "await_any",
    "batch_folders",
    "batches_by_date",
    "drop_redelivered_stream",
    "fold_upserts",
    "joined_logs",
    "late_parents",
    "once",
    "orphaned",
    "read_change_rate",
    "read_current_state",
    "read_upserts",
    "start_change_alerts",
    "start_change_rate",
    "start_changelog",
    "start_changelogs",
    "start_current_state",
    "start_maintained_join",
    "start_rejects",
    "start_upserts",
    "state_keys",
    "with_arrival",
    "with_parents",
    "write_batches",
]
