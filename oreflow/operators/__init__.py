from oreflow.operators.cdc import (
    ChangeRules,
    apply_changes,
    apply_changes_from_snapshot,
    apply_changes_incremental,
    change_entries,
    change_feed,
    change_rows,
    latest_changes,
    live_rows,
    merge_changes,
    merge_with_changes,
    overlay_changes,
    snapshot_changes,
    split_changes,
)
from oreflow.operators.dedup import latest_by, order_columns
from oreflow.operators.filters import ingested_on, since, valid_change
from oreflow.operators.joins import append_flows, join_master, semi_join_allowlist
from oreflow.operators.project import add_metadata_columns, classify, rtrim_strings, select_where
from oreflow.operators.quality import QualityError, QualityResult, Rule, check, reprocess, rules_from
from oreflow.operators.validation import TableChecks, validate, validation_report

__all__ = [
    "ChangeRules", "QualityError", "QualityResult", "Rule", "TableChecks", "add_metadata_columns",
    "append_flows", "apply_changes", "apply_changes_from_snapshot", "apply_changes_incremental", "change_entries",
    "change_feed",     "change_rows", "check", "classify", "ingested_on", "join_master", "latest_by", "latest_changes",
    "live_rows", "merge_changes", "merge_with_changes", "order_columns", "overlay_changes", "reprocess", "rtrim_strings", "rules_from",
    "select_where", "semi_join_allowlist", "since", "snapshot_changes", "split_changes", "valid_change",
    "validate", "validation_report",
]
