"""Relational operators: change data capture, snapshots, dimension, gold, serving."""

from shedlake.operators.activity import aggregate_activity, business_view, join_activity
from shedlake.operators.dimension import maintain_dimension, members, new_members
from shedlake.operators.scd1 import fold_changes, fold_lifted, lift, publish, scd1_fold, scd1_merge
from shedlake.operators.serving import chart_series, serve_csv_extract, serve_table
from shedlake.operators.snapshots import change_feed, collapse_change_feed, snapshot_apply, snapshot_diff

__all__ = [
    "aggregate_activity",
    "business_view",
    "change_feed",
    "chart_series",
    "collapse_change_feed",
    "fold_changes",
    "fold_lifted",
    "join_activity",
    "lift",
    "maintain_dimension",
    "members",
    "new_members",
    "publish",
    "scd1_fold",
    "scd1_merge",
    "serve_csv_extract",
    "serve_table",
    "snapshot_apply",
    "snapshot_diff",
]
