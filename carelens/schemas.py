"""Column names, retention lists and token sets.

Everything under "FIXED VALUES" must equal the source data's headers and the
pandas defaults the original pipeline relied on; they are data, not logic.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: provider-info columns kept at bronze, in this order (63).
# ---------------------------------------------------------------------------
PROVIDER_INFO_COLS: tuple[str, ...] = (
    "CMS Certification Number (CCN)",
    "Provider Name",
    "Provider Address",
    "City/Town",
    "State",
    "ZIP Code",
    "Telephone Number",
    "Provider SSA County Code",
    "County/Parish",
    "Ownership Type",
    "Number of Certified Beds",
    "Average Number of Residents per Day",
    "Provider Type",
    "Provider Resides in Hospital",
    "Legal Business Name",
    "Date First Approved to Provide Medicare and Medicaid Services",
    "Affiliated Entity Name",
    "Affiliated Entity ID",
    "Abuse Icon",
    "Overall Rating",
    "Health Inspection Rating",
    "QM Rating",
    "Long-Stay QM Rating",
    "Short-Stay QM Rating",
    "Staffing Rating",
    "Staffing Rating Footnote",
    "Reported Staffing Footnote",
    "Physical Therapist Staffing Footnote",
    "Reported Nurse Aide Staffing Hours per Resident per Day",
    "Reported LPN Staffing Hours per Resident per Day",
    "Reported RN Staffing Hours per Resident per Day",
    "Reported Licensed Staffing Hours per Resident per Day",
    "Reported Total Nurse Staffing Hours per Resident per Day",
    "Total number of nurse staff hours per resident per day on the weekend",
    "Registered Nurse hours per resident per day on the weekend",
    "Reported Physical Therapist Staffing Hours per Resident Per Day",
    "Total nursing staff turnover",
    "Total nursing staff turnover footnote",
    "Registered Nurse turnover",
    "Registered Nurse turnover footnote",
    "Number of administrators who have left the nursing home",
    "Administrator turnover footnote",
    "Nursing Case-Mix Index",
    "Nursing Case-Mix Index Ratio",
    "Case-Mix Nurse Aide Staffing Hours per Resident per Day",
    "Case-Mix LPN Staffing Hours per Resident per Day",
    "Case-Mix RN Staffing Hours per Resident per Day",
    "Case-Mix Total Nurse Staffing Hours per Resident per Day",
    "Case-Mix Weekend Total Nurse Staffing Hours per Resident per Day",
    "Adjusted Nurse Aide Staffing Hours per Resident per Day",
    "Adjusted LPN Staffing Hours per Resident per Day",
    "Adjusted RN Staffing Hours per Resident per Day",
    "Adjusted Total Nurse Staffing Hours per Resident per Day",
    "Adjusted Weekend Total Nurse Staffing Hours per Resident per Day",
    "Total Weighted Health Survey Score",
    "Number of Facility Reported Incidents",
    "Number of Substantiated Complaints",
    "Number of Citations from Infection Control Inspections",
    "Number of Fines",
    "Total Amount of Fines in Dollars",
    "Number of Payment Denials",
    "Total Number of Penalties",
    "Processing Date",
)

# ---------------------------------------------------------------------------
# FIXED VALUES: state / national averages columns kept at bronze (42).
# ---------------------------------------------------------------------------
STATE_AVG_COLS: tuple[str, ...] = (
    "State or Nation",
    "Average Number of Residents per Day",
    "Reported Nurse Aide Staffing Hours per Resident per Day",
    "Reported LPN Staffing Hours per Resident per Day",
    "Reported RN Staffing Hours per Resident per Day",
    "Reported Licensed Staffing Hours per Resident per Day",
    "Reported Total Nurse Staffing Hours per Resident per Day",
    "Total number of nurse staff hours per resident per day on the weekend",
    "Registered Nurse hours per resident per day on the weekend",
    "Reported Physical Therapist Staffing Hours per Resident Per Day",
    "Total nursing staff turnover",
    "Registered Nurse turnover",
    "Number of administrators who have left the nursing home",
    "Nursing Case-Mix Index",
    "Case-Mix RN Staffing Hours per Resident per Day",
    "Case-Mix Total Nurse Staffing Hours per Resident per Day",
    "Case-Mix Weekend Total Nurse Staffing Hours per Resident per Day",
    "Number of Fines",
    "Fine Amount in Dollars",
    "Percentage of long stay residents whose need for help with daily activities has increased",
    "Percentage of long stay residents who lose too much weight",
    "Percentage of low risk long stay residents who lose control of their bowels or bladder",
    "Percentage of long stay residents with a catheter inserted and left in their bladder",
    "Percentage of long stay residents with a urinary tract infection",
    "Percentage of long stay residents who have depressive symptoms",
    "Percentage of long stay residents who were physically restrained",
    "Percentage of long stay residents experiencing one or more falls with major injury",
    "Percentage of long stay residents assessed and appropriately given the pneumococcal vaccine",
    "Percentage of long stay residents who received an antipsychotic medication",
    "Percentage of short stay residents assessed and appropriately given the pneumococcal vaccine",
    "Percentage of short stay residents who newly received an antipsychotic medication",
    "Percentage of long stay residents whose ability to move independently worsened",
    "Percentage of long stay residents who received an antianxiety or hypnotic medication",
    "Percentage of high risk long stay residents with pressure ulcers",
    "Percentage of long stay residents assessed and appropriately given the seasonal influenza vaccine",
    "Percentage of short stay residents who made improvements in function",
    "Percentage of short stay residents who were assessed and appropriately given the seasonal influenza vaccine",
    "Percentage of short stay residents who were rehospitalized after a nursing home admission",
    "Percentage of short stay residents who had an outpatient emergency department visit",
    "Number of hospitalizations per 1000 long-stay resident days",
    "Number of outpatient emergency department visits per 1000 long-stay resident days",
    "Processing Date",
)

# ---------------------------------------------------------------------------
# FIXED VALUES: staffing fact columns named by the pipeline.
# ---------------------------------------------------------------------------
PROVNUM = "PROVNUM"
PROVNAME = "PROVNAME"
STATE = "STATE"
CENSUS = "MDScensus"
TOTAL_PARTS: tuple[str, ...] = ("Hrs_RN", "Hrs_LPN", "Hrs_CNA")
PERM_PARTS: tuple[str, ...] = (
    "Hrs_RNadmin_emp", "Hrs_RN_emp", "Hrs_LPNadmin_emp", "Hrs_LPN_emp",
    "Hrs_CNA_emp", "Hrs_NAtrn_emp", "Hrs_MedAide_emp",
)
TEMP_PARTS: tuple[str, ...] = (
    "Hrs_RNadmin_ctr", "Hrs_RN_ctr", "Hrs_LPNadmin_ctr", "Hrs_LPN_ctr",
    "Hrs_CNA_ctr", "Hrs_NAtrn_ctr", "Hrs_MedAide_ctr",
)

# FIXED VALUES: dimension columns the gold job reads.
CCN = "CMS Certification Number (CCN)"
PROV_STATE = "State"
CERTIFIED_BEDS = "Number of Certified Beds"
OVERALL_RATING = "Overall Rating"
STATE_KEY = "State or Nation"
ST_AVG_RESIDENTS = "Average Number of Residents per Day"
ST_AVG_NURSE_HRS = "Reported Total Nurse Staffing Hours per Resident per Day"

INGESTED_AT = "bronze_ingested_at"

# FIXED VALUES: gold metric names, in output order.
GOLD_METRICS: tuple[str, ...] = (
    "Tot_Nurse_hrs", "perm_staff", "temp_staff", "occup_limit",
    "Avg_residents_per_day", "Avg_tot_nurse_hrs_per_resident_per_day",
    "occup_rate", "overall_rating",
)

# FIXED VALUES: dashboard roll-up keys and measures (measure -> aggregate).
ROLLUP_KEYS: tuple[str, ...] = (PROVNUM, PROVNAME, STATE)
ROLLUP_MEASURES: tuple[tuple[str, str], ...] = (
    ("Tot_Nurse_hrs", "mean"),
    ("MDScensus", "mean"),
    ("occup_rate", "mean"),
    ("overall_rating", "max"),
    ("perm_staff", "mean"),
    ("temp_staff", "mean"),
)
# FIXED VALUES: the five dashboard views.
VIEW_HOURS_CENSUS = (PROVNUM, "Tot_Nurse_hrs", "MDScensus")
VIEW_OCCUPANCY = (PROVNUM, "occup_rate")
VIEW_RATING = (PROVNUM, "overall_rating")
VIEW_STAFF_MIX = (PROVNUM, "perm_staff", "temp_staff")
VIEW_TABLE = (STATE, PROVNUM, PROVNAME, "MDScensus", "Tot_Nurse_hrs", "occup_rate", "overall_rating")
GRADIENT_COLS = ("MDScensus", "occup_rate")
TOPK_DEFAULT, TOPK_MIN, TOPK_MAX = 20, 5, 100

# ---------------------------------------------------------------------------
# FIXED VALUES: text tokens the pandas CSV reader treats as missing by default.
# ---------------------------------------------------------------------------
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# FIXED VALUES: file-intake MIME types and naming.
MIME_FOLDER = "application/vnd.google-apps.folder"
MIME_SHEET = "application/vnd.google-apps.spreadsheet"
MIME_CSV = "text/csv"
CSV_SUFFIX = ".csv"
LANDING_PREFIX = "data/"
SHORTCUT_PREFIX = "downloaded_tables/"
