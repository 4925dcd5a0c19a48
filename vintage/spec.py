"""Domain defaults, all passed to operators as ordinary arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Names, labels, bounds and thresholds that have to agree with the published
# loan data set and its scoring interface.

TARGET_COLUMN = "loan_status"
DATE_COLUMN = "issue_d"

LABELS = {
    "Fully Paid": 0,
    "Charged Off": 1,
    "Current": None,
    "Late (31-120 days)": None,
    "Late (16-30 days)": None,
    "In Grace Period": None,
    "Default": 1,
}

ONGOING = ("Current", "Late (31-120 days)", "Late (16-30 days)", "In Grace Period")

LEAKAGE_COLUMNS = tuple(
    """
    total_pymnt total_pymnt_inv total_rec_prncp total_rec_int total_rec_late_fee
    recoveries collection_recovery_fee last_pymnt_d last_pymnt_amnt
    last_credit_pull_d next_pymnt_d out_prncp out_prncp_inv
    """.split()
)

HIGH_RISK_KEYWORDS = tuple(
    """
    total_pymnt total_rec recoveries collection_recovery last_pymnt next_pymnt
    out_prncp hardship_ settlement_ payment_plan deferral debt_settlement
    """.split()
)

MEDIUM_RISK_KEYWORDS = ("last_credit_pull", "last_fico", "issue_d")

EXCLUDED_FEATURES = ("id", "url", "zip_code")

# Date texts seen in the raw file first, then ISO forms.
DATE_PATTERNS = ("MMM-yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MMM-yy", "MM/dd/yyyy")

LATENCY_BOUNDS = (0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0)
PROBABILITY_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)

# One line per field of an application record: name, type, default
# ("required", "null" or a value), lower bound, upper bound ("-" = none).
APPLICATION_FIELDS = """
loan_amnt double required 0 -
funded_amnt double required 0 -
funded_amnt_inv double required 0 -
int_rate double required 0 100
installment double required 0 -
annual_inc double required 0 -
dti double required 0 -
delinq_2yrs int required 0 -
fico_range_low int required 300 850
fico_range_high int required 300 850
inq_last_6mths int required 0 -
mths_since_last_delinq double null 0 -
mths_since_last_record double null 0 -
open_acc int required 0 -
pub_rec int required 0 -
revol_bal double required 0 -
revol_util double null 0 100
total_acc int required 0 -
last_fico_range_high int null 300 850
last_fico_range_low int null 300 850
collections_12_mths_ex_med int 0 0 -
mths_since_last_major_derog double null 0 -
policy_code int 1 - -
acc_now_delinq int 0 0 -
tot_coll_amt double null 0 -
tot_cur_bal double null 0 -
open_acc_6m int null 0 -
open_act_il int null 0 -
open_il_12m int null 0 -
open_il_24m int null 0 -
mths_since_rcnt_il double null 0 -
total_bal_il double null 0 -
il_util double null 0 100
open_rv_12m int null 0 -
open_rv_24m int null 0 -
max_bal_bc double null 0 -
all_util double null 0 100
total_rev_hi_lim double null 0 -
inq_fi int null 0 -
total_cu_tl int null 0 -
inq_last_12m int null 0 -
acc_open_past_24mths int null 0 -
avg_cur_bal double null 0 -
bc_open_to_buy double null 0 -
bc_util double null 0 100
chargeoff_within_12_mths int 0 0 -
delinq_amnt double null 0 -
mo_sin_old_il_acct double null 0 -
mo_sin_old_rev_tl_op double null 0 -
mo_sin_rcnt_rev_tl_op double null 0 -
mo_sin_rcnt_tl double null 0 -
mort_acc int null 0 -
mths_since_recent_bc double null 0 -
mths_since_recent_bc_dlq double null 0 -
mths_since_recent_inq double null 0 -
mths_since_recent_revol_delinq double null 0 -
num_accts_ever_120_pd int null 0 -
num_actv_bc_tl int null 0 -
num_actv_rev_tl int null 0 -
num_bc_sats int null 0 -
num_bc_tl int null 0 -
num_il_tl int null 0 -
num_op_rev_tl int null 0 -
num_rev_accts int null 0 -
num_rev_tl_bal_gt_0 int null 0 -
num_sats int null 0 -
num_tl_120dpd_2m int null 0 -
num_tl_30dpd int null 0 -
num_tl_90g_dpd_24m int null 0 -
num_tl_op_past_12m int null 0 -
pct_tl_nvr_dlq double null 0 100
percent_bc_gt_75 double null 0 100
pub_rec_bankruptcies int null 0 -
tax_liens int null 0 -
tot_hi_cred_lim double null 0 -
total_bal_ex_mort double null 0 -
total_bc_limit double null 0 -
total_il_high_credit_limit double null 0 -
funded_to_loan_ratio double null 0 -
installment_to_income_ratio double null 0 -
fico_midpoint double null 300 850
fico_range double null 0 -
credit_history_years double null 0 -
issue_year int null 2007 2018
issue_month int null 1 12
"""
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class FieldRule:
    """Presence, range and default of one input field."""

    name: str
    dtype: str = "double"
    required: bool = False
    default: float | None = None
    low: float | None = None
    high: float | None = None


def parse_rules(text: str) -> list[FieldRule]:
    """Read one rule per non-blank line: name type default low high."""
    rules = []
    for line in filter(None, map(str.strip, text.splitlines())):
        name, dtype, default, low, high = line.split()
        rules.append(
            FieldRule(
                name,
                dtype,
                required=default == "required",
                default=None if default in ("required", "null") else float(default),
                low=None if low == "-" else float(low),
                high=None if high == "-" else float(high),
            )
        )
    return rules


@dataclass(frozen=True)
class LoanSpec:
    """Everything the composed jobs need to know about the input table."""

    target: str = TARGET_COLUMN
    date: str = DATE_COLUMN
    labels: dict = field(default_factory=lambda: dict(LABELS))
    leakage: tuple = LEAKAGE_COLUMNS
    high_keywords: tuple = HIGH_RISK_KEYWORDS
    medium_keywords: tuple = MEDIUM_RISK_KEYWORDS
    excluded: tuple = EXCLUDED_FEATURES
    drop: tuple = ()
    date_patterns: tuple = DATE_PATTERNS
    row_key: tuple = ("id",)
    train_ratio: float = 0.8
    seed: int = 42
