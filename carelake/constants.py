"""Fixed values that must stay equal to the behaviour being reproduced.

Everything in this module is data, not logic: null tokens of the CSV format,
accepted status / payment-mode vocabularies, masking role lists, the
age-group bands and the fixed `as_of` date they are computed against.
"""

import datetime

# --- fixed values: CSV null tokens (S1) -----------------------------------
NULL_TOKENS = ("", "NULL", "null", "N/A", "n/a", "None")

# --- fixed values: accepted vocabularies (C2, C3) --------------------------
APPOINTMENT_STATUSES = ("SCHEDULED", "COMPLETED", "NO-SHOW", "CANCELLED")
PAYMENT_MODES = ("CASH", "CARD", "UPI", "INSURANCE")
INSURANCE_MODE = "INSURANCE"

# --- fixed values: patient rule thresholds (C1) ----------------------------
MIN_PHONE_LENGTH = 10
DOB_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")
ISO_DATE = "yyyy-MM-dd"

# --- fixed values: masking (K1-K3) -----------------------------------------
# Roles that see clear text, exactly as listed by the masking policies.
EXEMPT_ROLES_DEFAULT = (
    "HOSPITAL_ENGINEER_ROLE",
    "HOSPITAL_ANALYST_ROLE",
    "HOSPITAL_VIEWER_ROLE",
    "ACCOUNTADMIN",
)
ENGINEER_ROLE = EXEMPT_ROLES_DEFAULT[0]
# Documented intent: viewers see masked data.
EXEMPT_ROLES_STRICT = ("HOSPITAL_ENGINEER_ROLE", "HOSPITAL_ANALYST_ROLE", "ACCOUNTADMIN")
PHONE_MASK_PREFIX = "******"
EMAIL_MASK_PREFIX = "****"
NAME_MASK = "****"

# --- fixed values: age groups (P4) -----------------------------------------
# (label, lowest age in the band); the last band is open-ended.
AGE_BANDS = (("0-17", 0), ("18-35", 18), ("36-50", 36), ("51-65", 51), ("66+", 66))
AS_OF_DEFAULT = datetime.date(2026, 1, 1)

# --- fixed values: labels used by dashboard queries --------------------------
SELF_PAY_LABEL = "Self-Pay"

# --- fixed values: domains and their source-table names ---------------------
DOMAINS = ("patients", "appointments", "billing")
SOURCE_TABLE = {
    "patients": "RAW_PATIENTS",
    "appointments": "RAW_APPOINTMENTS",
    "billing": "RAW_BILLING",
}
# File-name routing of the landing directory (S7); compressed files included.
FILE_GLOB = {
    "patients": "*patients*.csv*",
    "appointments": "*appointments*.csv*",
    "billing": "*billing*.csv*",
}
