"""Names, limits and texts that results have to agree on."""

# --- column roles, in order of preference -------------------------------------------------------
KEY_COLUMNS = ("lot_id", "event_key", "eqp_id")
TIME_COLUMNS = ("ts", "event_time", "create_dtts", "start_dtts")
EXCLUDED_COLUMNS = ("dt", "fab")

# --- pause between two batches, in seconds ------------------------------------------------------
MIN_PAUSE_S = 0
MAX_PAUSE_S = 60

# --- trace table ------------------------------------------------------------------------------
TRACE_COLUMNS = (
    "ts", "eqp_id", "module_name", "lot_cd", "lot_id", "slot_id", "product_id",
    "oper_id", "oper_desc", "recipe_id", "ppid", "step_id", "step_name",
    "param_name", "param_alias", "param_svid", "param_value",
    "batch_id", "batch_type", "zone", "start_dtts", "create_dtts",
    "org_wf_id", "alias_lot_id", "fdc_lot_cd",
    "target", "lsl", "lcl", "ucl", "usl", "spec_model_name",
    "dt", "fab",
)
TRACE_ARRAYS = (
    "param_name", "param_alias", "param_svid", "param_value",
    "target", "lsl", "lcl", "ucl", "usl", "spec_model_name",
)
PARAM_COLUMNS = ("param_name", "param_alias", "param_svid")

# --- numbers in text: plain decimals only, so that no text turns into infinity or no number ------
PLAIN_NUMBER = r"^[+-]?([0-9]{1,100}([.][0-9]*)?|[.][0-9]{1,100})([eE][+-]?[0-9]{1,2})?$"

# --- summary table ----------------------------------------------------------------------------
SUMMARY_GROUP = (
    "eqp_id", "module_name", "lot_id", "slot_id", "oper_id", "oper_desc", "recipe_id", "ppid",
    "step_id", "step_name", "batch_id", "batch_type", "org_wf_id", "alias_lot_id",
    "fdc_lot_cd", "dt", "fab", "lot_cd",
)
SUMMARY_ARRAYS = (
    "param_name", "param_alias", "param_svid",
    "max_val", "min_val", "mean_val", "stddev_val", "range_val", "median_val",
    "integral_val", "slope_val", "p05_val", "p10_val", "p90_val", "p95_val",
    "count_val", "sumsq_val", "start_time",
)
SUMMARY_PERCENTILES = (
    ("median_val", 0.5), ("p05_val", 0.05), ("p10_val", 0.10), ("p90_val", 0.90), ("p95_val", 0.95),
)
