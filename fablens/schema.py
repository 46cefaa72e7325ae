"""Declared table schemas, as Spark DDL text."""

PRODUCTION = (
    "production_id bigint, run_timestamp timestamp_ntz, run_date date, run_hour int, "
    "shift_code string, day_name string, week_of_year int, month_name string"
)

QUALITY = (
    "production_id bigint, raw_label int, is_defect boolean, defect_classification string, "
    "estimated_scrap_cost double, reinspection_flag boolean"
)

SENSOR = (
    "sensor_id int, sensor_code string, sensor_alias string, category string, is_constant boolean, "
    "missing_rate_pct double, is_quarantined boolean, quarantine_reason string, "
    "mean_val double, std_val double, min_val double, max_val double"
)

STAGING = (
    "production_id bigint, event_timestamp timestamp_ntz, quality_label int, sensor_data string, "
    "ingested_at timestamp, data_source string"
)

AUDIT = (
    "log_id string, batch_run_id string, check_timestamp timestamp, dataset_name string, "
    "total_records bigint, total_features bigint, duplicate_rows bigint, overall_missing_pct double, "
    "high_missing_cols_count bigint, constant_cols_count bigint, pass_count bigint, fail_count bigint, "
    "quality_status string, notes string"
)

ALERTS = (
    "production_id bigint, lot_id string, failure_risk_pct double, risk_tier string, "
    "operational_action string, alert_urgency string, actual_quality string"
)
