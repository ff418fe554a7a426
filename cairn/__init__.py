"""cairn — reusable, deterministic analytics operators on Spark DataFrames and streams."""

from cairn.functions.numeric import add_total, band, band_expr, difference, mean_from_totals, rounded
from cairn.operators.aggregate import category_counts, frequency_topk
from cairn.operators.cleaning import dedupe_first, fill_missing, replace_token
from cairn.operators.combine import append_rows, broadcast_if_small, lookup_enrich, null_safe_join, outer_merge
from cairn.operators.prefix import durable, grouped_prefix
from cairn.operators.ranking import rank_within, top_k
from cairn.operators.stats import (anova_columns, anova_oneway, check_assumptions, group_summary, pearson_matrix,
                                   pearson_test, welch_t)
from cairn.plans.recipes import category_table
from cairn.session import local_session, persisted, scratch_path, shared_dir
from cairn.sources.files import (read_header, read_stage, read_typed_csv, split_write, typed_columns,
                                 write_stage)
from cairn.streaming.replay import (mean_from_running, read_complete, read_latest, replay_files, run_to_end, running_totals)

__all__ = [
    "add_total", "band", "band_expr", "difference", "mean_from_totals", "rounded",
    "category_counts", "frequency_topk",
    "dedupe_first", "fill_missing", "replace_token",
    "append_rows", "broadcast_if_small", "lookup_enrich", "null_safe_join", "outer_merge",
    "durable", "grouped_prefix", "rank_within", "top_k",
    "anova_columns", "anova_oneway", "check_assumptions", "group_summary", "pearson_matrix", "pearson_test", "welch_t",
    "category_table",
    "local_session", "persisted", "scratch_path", "shared_dir",
    "read_header", "read_stage", "read_typed_csv", "split_write", "typed_columns", "write_stage",
    "mean_from_running", "read_complete", "read_latest", "replay_files", "run_to_end", "running_totals",
]
