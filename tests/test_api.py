"""Every operator named in the survey's inventory is importable under its planned name."""

from __future__ import annotations

import importlib

import pytest

SURFACE = {
    "dcflow.sources.pages": ["read_pages", "parse_pages", "explode_records", "page_status",
                             "compact_pages", "read_page_archive"],
    "dcflow.sources.requests": ["build_requests", "request_url"],
    "dcflow.sources.table": ["read_metadata", "write_metadata", "ensure_table", "write_batches",
                             "merge_into", "append_metadata", "compact_table"],
    "dcflow.operators.records": ["flatten_records", "has_identifier", "exclude_deleted",
                                 "validate_records"],
    "dcflow.functions.text": ["collapse_ws", "first_value", "last_value"],
    "dcflow.functions.jsonfmt": ["array_to_json", "json_to_array", "safe_serialize",
                                 "safe_serialize_array"],
    "dcflow.functions.dates": ["harvest_date", "parse_datestamp", "parse_iso_date", "day_range",
                               "recent_window", "backfill_bounds"],
    "dcflow.operators.query": ["in_set", "set_like", "date_between", "list_records",
                               "subject_contains", "select_where", "order_by", "limit", "query",
                               "Select"],
    "dcflow.operators.coverage": ["missing_dates", "set_date_spine", "records_in_sets",
                                  "missing_any_set", "existing_dates", "coverage_summary",
                                  "date_difference", "chunk_dates"],
    "dcflow.operators.merge": ["latest_per_key", "match_existing", "upsert"],
    "dcflow.operators.ledger": ["harvest_summary", "throughput", "batch_summary",
                                "resolve_attempts", "outcome_by_day", "assign_batches",
                                "pacing_audit", "page_ledger"],
    "dcflow.plans.jobs": ["union_runs", "both_plan", "backfill_plan", "recent_plan", "ingest_pages"],
    "dcflow.streaming.harvest": ["stream_harvest", "land_pages", "page_stream"],
}


@pytest.mark.parametrize("module", sorted(SURFACE))
def test_surface(module):
    mod = importlib.import_module(module)
    missing = [n for n in SURFACE[module] if not callable(getattr(mod, n, None))]
    assert not missing, missing
