from feedwell.operators.cells import cell_text, decode_cells, header_texts, list_headers, shown
from feedwell.operators.headers import (
    first_position, flag_position, missing_columns, resolve_flag, resolve_headers, resolve_headers_all,
    resolve_targets,
)
from feedwell.operators.history import (
    RECORD, change_gate, history_record, keep_changes, latest_per, latest_record,
)
from feedwell.operators.rows import canonical_rows, drop_blank_keys
from feedwell.operators.stats import flag_counts, load_stats
from feedwell.operators.types import infer_types, merge_flags, type_flags, type_name, typed, with_inferred_types

__all__ = [
    "RECORD", "canonical_rows", "cell_text", "change_gate", "decode_cells", "drop_blank_keys", "first_position",
    "flag_counts", "flag_position", "header_texts", "history_record", "infer_types", "keep_changes", "latest_per",
    "latest_record", "list_headers", "load_stats", "merge_flags", "missing_columns", "resolve_flag", "resolve_headers",
    "resolve_headers_all", "resolve_targets", "shown", "type_flags", "type_name", "typed", "with_inferred_types",
]
