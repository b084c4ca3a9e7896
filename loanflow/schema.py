"""Column catalogue of the loan record and of every layer built from it.

The lists below are data, not logic: they name the columns of the public
consumer-loan CSV layout and say which rule applies to which column.  Each
list keeps the order in which the columns appear in that layout.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# FIXED VALUES - must equal the reference layout for equal results.
# ---------------------------------------------------------------------------

# The 151 raw columns, in file order.
LOAN_COLUMNS = [
    "id", "member_id", "loan_amnt", "funded_amnt", "funded_amnt_inv",
    "term", "int_rate", "installment", "grade", "sub_grade",
    "emp_title", "emp_length", "home_ownership", "annual_inc",
    "verification_status", "issue_d", "loan_status", "pymnt_plan",
    "url", "desc", "purpose", "title", "zip_code", "addr_state",
    "dti", "delinq_2yrs", "earliest_cr_line", "fico_range_low",
    "fico_range_high", "inq_last_6mths", "mths_since_last_delinq",
    "mths_since_last_record", "open_acc", "pub_rec", "revol_bal",
    "revol_util", "total_acc", "initial_list_status", "out_prncp",
    "out_prncp_inv", "total_pymnt", "total_pymnt_inv", "total_rec_prncp",
    "total_rec_int", "total_rec_late_fee", "recoveries",
    "collection_recovery_fee", "last_pymnt_d", "last_pymnt_amnt",
    "next_pymnt_d", "last_credit_pull_d", "last_fico_range_high",
    "last_fico_range_low", "collections_12_mths_ex_med",
    "mths_since_last_major_derog", "policy_code", "application_type",
    "annual_inc_joint", "dti_joint", "verification_status_joint",
    "acc_now_delinq", "tot_coll_amt", "tot_cur_bal", "open_acc_6m",
    "open_act_il", "open_il_12m", "open_il_24m", "mths_since_rcnt_il",
    "total_bal_il", "il_util", "open_rv_12m", "open_rv_24m",
    "max_bal_bc", "all_util", "total_rev_hi_lim", "inq_fi",
    "total_cu_tl", "inq_last_12m", "acc_open_past_24mths",
    "avg_cur_bal", "bc_open_to_buy", "bc_util",
    "chargeoff_within_12_mths", "delinq_amnt", "mo_sin_old_il_acct",
    "mo_sin_old_rev_tl_op", "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl",
    "mort_acc", "mths_since_recent_bc", "mths_since_recent_bc_dlq",
    "mths_since_recent_inq", "mths_since_recent_revol_delinq",
    "num_accts_ever_120_pd", "num_actv_bc_tl", "num_actv_rev_tl",
    "num_bc_sats", "num_bc_tl", "num_il_tl", "num_op_rev_tl",
    "num_rev_accts", "num_rev_tl_bal_gt_0", "num_sats",
    "num_tl_120dpd_2m", "num_tl_30dpd", "num_tl_90g_dpd_24m",
    "num_tl_op_past_12m", "pct_tl_nvr_dlq", "percent_bc_gt_75",
    "pub_rec_bankruptcies", "tax_liens", "tot_hi_cred_lim",
    "total_bal_ex_mort", "total_bc_limit", "total_il_high_credit_limit",
    "revol_bal_joint", "sec_app_fico_range_low",
    "sec_app_fico_range_high", "sec_app_earliest_cr_line",
    "sec_app_inq_last_6mths", "sec_app_mort_acc", "sec_app_open_acc",
    "sec_app_revol_util", "sec_app_open_act_il", "sec_app_num_rev_accts",
    "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med",
    "sec_app_mths_since_last_major_derog", "hardship_flag",
    "hardship_type", "hardship_reason", "hardship_status",
    "deferral_term", "hardship_amount", "hardship_start_date",
    "hardship_end_date", "payment_plan_start_date", "hardship_length",
    "hardship_dpd", "hardship_loan_status",
    "orig_projected_additional_accrued_interest",
    "hardship_payoff_balance_amount", "hardship_last_payment_amount",
    "disbursement_method", "debt_settlement_flag",
    "debt_settlement_flag_date", "settlement_status", "settlement_date",
    "settlement_amount", "settlement_percentage", "settlement_term",
]

# Columns cast to double in Silver (109).
NUMERIC_COLUMNS = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "installment",
    "annual_inc", "dti", "delinq_2yrs", "fico_range_low",
    "fico_range_high", "inq_last_6mths", "mths_since_last_delinq",
    "mths_since_last_record", "open_acc", "pub_rec", "revol_bal",
    "total_acc", "out_prncp", "out_prncp_inv", "total_pymnt",
    "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
    "total_rec_late_fee", "recoveries", "collection_recovery_fee",
    "last_pymnt_amnt", "last_fico_range_high", "last_fico_range_low",
    "collections_12_mths_ex_med", "mths_since_last_major_derog",
    "policy_code", "annual_inc_joint", "dti_joint", "acc_now_delinq",
    "tot_coll_amt", "tot_cur_bal", "open_acc_6m", "open_act_il",
    "open_il_12m", "open_il_24m", "mths_since_rcnt_il", "total_bal_il",
    "il_util", "open_rv_12m", "open_rv_24m", "max_bal_bc", "all_util",
    "total_rev_hi_lim", "inq_fi", "total_cu_tl", "inq_last_12m",
    "acc_open_past_24mths", "avg_cur_bal", "bc_open_to_buy", "bc_util",
    "chargeoff_within_12_mths", "delinq_amnt", "mo_sin_old_il_acct",
    "mo_sin_old_rev_tl_op", "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl",
    "mort_acc", "mths_since_recent_bc", "mths_since_recent_bc_dlq",
    "mths_since_recent_inq", "mths_since_recent_revol_delinq",
    "num_accts_ever_120_pd", "num_actv_bc_tl", "num_actv_rev_tl",
    "num_bc_sats", "num_bc_tl", "num_il_tl", "num_op_rev_tl",
    "num_rev_accts", "num_rev_tl_bal_gt_0", "num_sats",
    "num_tl_120dpd_2m", "num_tl_30dpd", "num_tl_90g_dpd_24m",
    "num_tl_op_past_12m", "pct_tl_nvr_dlq", "percent_bc_gt_75",
    "pub_rec_bankruptcies", "tax_liens", "tot_hi_cred_lim",
    "total_bal_ex_mort", "total_bc_limit", "total_il_high_credit_limit",
    "revol_bal_joint", "sec_app_fico_range_low",
    "sec_app_fico_range_high", "sec_app_inq_last_6mths",
    "sec_app_mort_acc", "sec_app_open_acc", "sec_app_open_act_il",
    "sec_app_num_rev_accts", "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med",
    "sec_app_mths_since_last_major_derog", "deferral_term",
    "hardship_amount", "hardship_length", "hardship_dpd",
    "orig_projected_additional_accrued_interest",
    "hardship_payoff_balance_amount", "hardship_last_payment_amount",
    "settlement_amount", "settlement_percentage", "settlement_term",
]

# Month-grain date columns, text layout "Dec-2015" (11).
DATE_COLUMNS = [
    "issue_d", "earliest_cr_line", "last_pymnt_d", "next_pymnt_d",
    "last_credit_pull_d", "sec_app_earliest_cr_line",
    "hardship_start_date", "hardship_end_date",
    "payment_plan_start_date", "debt_settlement_flag_date",
    "settlement_date",
]
DATE_FORMAT = "MMM-yyyy"

# Percent columns, text layout "13.99%" (3).
PERCENT_COLUMNS = ["int_rate", "revol_util", "sec_app_revol_util"]

# Loan statuses that make label = 1.
DEFAULT_STATUSES = [
    "Charged Off",
    "Default",
    "Does not meet the credit policy. Status:Charged Off",
]
CHARGED_OFF_TEXT = "Charged Off"
HIGH_RISK_GRADES = ["D", "E", "F", "G"]

# Columns the Gold layer removes (47), in the order they are listed.
GOLD_DROP_COLUMNS = [
    "id", "member_id", "url", "desc",
    "mths_since_last_record", "mths_since_last_major_derog",
    "mths_since_recent_bc_dlq", "mths_since_recent_revol_delinq",
    "annual_inc_joint", "dti_joint", "verification_status_joint",
    "revol_bal_joint", "sec_app_fico_range_low", "sec_app_fico_range_high",
    "sec_app_earliest_cr_line", "sec_app_inq_last_6mths", "sec_app_mort_acc",
    "sec_app_open_acc", "sec_app_revol_util", "sec_app_open_act_il",
    "sec_app_num_rev_accts", "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med",
    "sec_app_mths_since_last_major_derog",
    "hardship_type", "hardship_reason", "hardship_status", "deferral_term",
    "hardship_amount", "hardship_start_date", "hardship_end_date",
    "payment_plan_start_date", "hardship_length", "hardship_dpd",
    "hardship_loan_status", "orig_projected_additional_accrued_interest",
    "hardship_payoff_balance_amount", "hardship_last_payment_amount",
    "debt_settlement_flag_date", "settlement_status", "settlement_date",
    "settlement_amount", "settlement_percentage", "settlement_term",
    "kafka_partition", "kafka_offset", "kafka_timestamp",
]
NUMERIC_FILL = 0
STRING_FILL = "Unknown"

# Columns known only after origination (17), dropped before modelling.
LEAKAGE_COLUMNS = [
    "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
    "total_rec_late_fee", "recoveries", "collection_recovery_fee",
    "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d",
    "last_credit_pull_d", "last_fico_range_high", "last_fico_range_low",
    "out_prncp", "out_prncp_inv",
    "loan_status",
    "collections_12_mths_ex_med",
]

# Model features, in vector order.
NUMERIC_FEATURES = [
    "loan_amnt", "int_rate", "installment", "annual_inc", "dti",
    "delinq_2yrs", "fico_range_low", "fico_range_high", "open_acc",
    "pub_rec", "revol_bal", "revol_util", "total_acc", "mort_acc",
    "pub_rec_bankruptcies",
]
CATEGORICAL_FEATURES = [
    "term", "grade", "sub_grade", "emp_length", "home_ownership",
    "verification_status", "purpose", "application_type",
    "initial_list_status",
]
LABEL = "label"
WEIGHT = "classWeight"

# Profile column sets.
DESCRIBE_COLUMNS = [
    "loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc",
    "dti", "fico_avg", "loan_to_income_ratio", "revol_bal", "total_pymnt",
    "recoveries",
]
PROFILE_CATEGORICALS = [
    "grade", "sub_grade", "home_ownership", "verification_status",
    "purpose", "application_type", "term",
]
TIME_CANDIDATES = ["issue_d", "issue_date", "earliest_cr_line", "date", "year", "issue_year"]
HISTOGRAM_CANDIDATES = ["loan_amnt", "int_rate", "annual_inc", "dti", "fico_score"]
PREVIEW_COLUMNS = ["loan_amnt", "int_rate", "annual_inc", "dti", "grade", "purpose", "loan_status", "label"]

# Null-share thresholds of the null profile, in percent.
NULL_HIGH_PCT = 5.0
# Class ratio above which (or below 1/x) the label is called imbalanced.
IMBALANCE_RATIO = 3.0

BACKFILL_TOPIC = "backfill_csv"

# ---------------------------------------------------------------------------
# Derived layouts (computed, not fixed).
# ---------------------------------------------------------------------------

STRING_COLUMNS = [
    c for c in LOAN_COLUMNS
    if c not in set(NUMERIC_COLUMNS) | set(DATE_COLUMNS) | set(PERCENT_COLUMNS)
]

LOAN_SCHEMA = StructType([StructField(c, StringType(), True) for c in LOAN_COLUMNS])

MESSAGE_META = [
    StructField("kafka_topic", StringType(), True),
    StructField("kafka_partition", IntegerType(), True),
    StructField("kafka_offset", LongType(), True),
    StructField("kafka_timestamp", TimestampType(), True),
]
INGESTION_TS = "ingestion_timestamp"
PROCESSING_TS = "processing_timestamp"
AUDIT_COLUMNS = [INGESTION_TS, PROCESSING_TS]

# Canonical Bronze order: data columns, message metadata, ingestion stamp.
BRONZE_COLUMNS = LOAN_COLUMNS + [f.name for f in MESSAGE_META] + [INGESTION_TS]
BRONZE_SCHEMA = StructType(list(LOAN_SCHEMA.fields) + MESSAGE_META + [StructField(INGESTION_TS, TimestampType(), True)])
DERIVED_COLUMNS = ["fico_avg", "loan_to_income_ratio", "is_high_risk", "is_charged_off"]
SILVER_COLUMNS = BRONZE_COLUMNS + DERIVED_COLUMNS + [PROCESSING_TS]

# Message source columns (Kafka layout).
MESSAGE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])


def existing(df_or_columns, wanted):
    """Names of ``wanted`` present in a frame (or a list of names), in ``wanted`` order."""
    have = set(df_or_columns.columns if hasattr(df_or_columns, "columns") else df_or_columns)
    return [c for c in wanted if c in have]
