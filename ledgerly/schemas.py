"""Schemas of the persisted tables."""

from __future__ import annotations

_MOVEMENT = "id_cliente string, movement_date date, product string, type string, fund string, amount {amount}, description string, commercial_name string"

TABLES = {
    "file_registry": "source_file string, source_file_hash string, source_path string, size_bytes long, row_count long, column_names array<string>, schema_fingerprint string, snapshot_date date, date_source string, status string, run_id string, first_seen_at timestamp, processed_at timestamp, reason string",
    "pipeline_runs": "run_id string, snapshot_date date, status string, input_file string, source_file_hash string, contract_version string, contract_hash string, started_at timestamp, finished_at timestamp, duration_seconds double, rows_read long, rows_valid long, rows_rejected long, rows_exact_dupes long, rows_new long, rows_updated long, rows_deleted long, rows_unchanged long, rows_reactivated long, rows_current_before long, rows_current_after long, amount_before {amount}, amount_current {amount}, rows_purged long, exit_code int, error_code string, error_message string",
    "run_alerts": "run_id string, code string, severity string, message string, observed double, threshold double, raised_at timestamp",
    "rejected_records": "run_id string, source_file string, source_file_hash string, snapshot_date date, source_row_number long, id_cliente string, error_code string, error_description string, error_severity string, raw_record string",
    "data_quality_flags": "run_id string, snapshot_date date, movement_key string, flag_code string, severity string, column_name string, detail string",
    "movements_current": "movement_key string, " + _MOVEMENT + ", date_original string, type_original string, amount_original double, occurrence_ordinal int, is_key_ambiguous boolean, row_hash string, version int, is_active boolean, first_seen_at timestamp, first_snapshot_date date, last_seen_at timestamp, last_snapshot_date date, updated_at timestamp, deleted_at timestamp, source_file string, source_file_hash string, run_id string",
    "movements_history": "movement_key string, version int, " + _MOVEMENT + ", row_hash string, change_type string, valid_from date, valid_to date, is_current boolean, is_deleted boolean, snapshot_date date, closed_by_run_id string, source_file string, source_file_hash string, run_id string, created_at timestamp",
    "movement_changes": "change_id long, run_id string, snapshot_date date, movement_key string, change_type string, from_version int, to_version int, changed_columns array<string>, amount_before {amount}, amount_after {amount}, amount_delta {amount}, detected_at timestamp",
    "movement_change_fields": "change_id long, run_id string, movement_key string, column_name string, old_value string, new_value string",
    "reconciliation_results": "run_id string, snapshot_date date, check_id string, check_group string, check_name string, left_label string, left_value decimal(38,4), right_label string, right_value decimal(38,4), difference decimal(38,4), tolerance decimal(38,4), passed boolean",
    "anomalies": "run_id string, snapshot_date date, anomaly_code string, category string, severity string, entity_type string, entity_id string, metric_name string, observed double, expected double, threshold double, description string",
}


#: Versions that are still open stand apart from closed ones, which are only ever added to.
TABLES["movements_open"] = TABLES["movements_history"]


def ddl(table: str, amount: str = "decimal(20,2)") -> str:
    return TABLES[table].format(amount=amount)


def names(table: str) -> list[str]:
    return [c.split()[0] for c in ddl(table, "amount").split(", ")]
