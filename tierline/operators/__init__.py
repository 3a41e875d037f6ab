"""Operators: DataFrame in, DataFrame out, column names as arguments."""

from tierline.operators.asof import asof_join
from tierline.operators.decode import decode_envelope, envelope_parts, explode_positions, header_drift
from tierline.operators.edits import apply_cell_edit, capture_diff, upsert
from tierline.operators.gaps import consecutive_gaps, observed_span
from tierline.operators.latest import latest_per_key, oldest_and_newest
from tierline.operators.pairs import collapse_pair, pair_violations, side_counts
from tierline.operators.reconcile import child_sums, reconcile
from tierline.operators.reshape import compare_wide, unpivot
from tierline.operators.sampling import first_groups, groups_where, keep_groups
from tierline.operators.stints import stints

__all__ = [
    "apply_cell_edit", "asof_join", "capture_diff", "child_sums", "collapse_pair", "compare_wide", "consecutive_gaps",
    "decode_envelope", "envelope_parts", "explode_positions", "first_groups", "groups_where", "header_drift",
    "keep_groups", "latest_per_key", "observed_span", "oldest_and_newest", "pair_violations", "reconcile",
    "side_counts", "stints", "unpivot", "upsert",
]
