from rowtide.operators.capture import (
    connect_schema,
    delete_events,
    diff_events,
    diff_repeats,
    in_commit_order,
    included,
    insert_events,
    key_only,
    snapshot_events,
    to_records,
    topic_name,
    update_events,
    with_offsets,
)
from rowtide.operators.changelog import decode
from rowtide.operators.constraints import (
    null_violations,
    pk_violations,
    precision_violations,
    unique_violations,
)
from rowtide.operators.cuts import common_position, consistent_states, progress_marks
from rowtide.operators.generate import ingest_summary, new_orders, new_users, serial_ids
from rowtide.operators.intervals import at_position, at_time, interval_join, live, versions
from rowtide.operators.profiles import figures, profile, united
from rowtide.operators.rates import change_rate, rate_alerts
from rowtide.operators.rejects import judged, log_of, rejects, rejects_of
from rowtide.operators.relations import (
    cascade_deleted,
    cascade_survivors,
    insert_if_absent,
    orphans,
    with_parent,
)
from rowtide.operators.state import (
    after_truncate,
    change_order,
    compacted,
    count_rows,
    current_state,
    drop_redelivered,
    fold,
    last_changes,
    state_as_of,
    state_for_sql,
)
from rowtide.operators.summaries import (
    absent_by_bitmap,
    diff_by_summary,
    differing_leaves,
    extended_bitmap,
    key_bitmap,
    orphans_by_bitmap,
    rolled_up,
    summary,
)

__all__ = [
    "absent_by_bitmap",
    "after_truncate",
    "at_position",
    "at_time",
    "cascade_deleted",
    "cascade_survivors",
    "change_order",
    "change_rate",
    "common_position",
    "compacted",
    "connect_schema",
    "consistent_states",
    "count_rows",
    "current_state",
    "decode",
    "delete_events",
    "diff_by_summary",
    "diff_events",
    "diff_repeats",
    "differing_leaves",
    "drop_redelivered",
    "extended_bitmap",
    "figures",
    "fold",
    "in_commit_order",
    "included",
    "ingest_summary",
    "insert_events",
    "insert_if_absent",
    "interval_join",
    "judged",
    "key_bitmap",
    "key_only",
    "last_changes",
    "live",
    "log_of",
    "new_orders",
    "new_users",
    "null_violations",
    "orphans",
    "orphans_by_bitmap",
    "pk_violations",
    "precision_violations",
    "profile",
    "progress_marks",
    "rate_alerts",
    "rejects",
    "rejects_of",
    "rolled_up",
    "serial_ids",
    "snapshot_events",
    "state_as_of",
    "state_for_sql",
    "summary",
    "to_records",
    "topic_name",
    "unique_violations",
    "united",
    "update_events",
    "versions",
    "with_offsets",
    "with_parent",
]
