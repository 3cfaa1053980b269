"""Fixed values shared by the operators and the assembled tables.

Everything here must equal published values (labels, codes, factors, column
names); no logic lives in this module.
"""

# --- Fixed values: divergence grades -----------------------------------------
HIGH = "Highly Divergent from Expectation"
SLIGHT = "Slightly Divergent from Expectation"
CLOSE = "Close to Expectation"

# --- Fixed values: size classes, largest cut first (None = everything below) --
SIZE_CUTS = [(100_000, "Large"), (40_000, "Medium"), (None, "Small")]

# --- Fixed values: vacancy change cuts in percentage points -------------------
VACANCY_CUTS = (5.0, 2.5)

# --- Fixed values: months from the July reference date to the April count -----
MONTHS_TO_APRIL = 9

# --- Fixed values: share of "some other race alone" given to each group -------
REALLOCATION_FACTORS = {
    "white": 0.5984,
    "black": 0.2478,
    "aian": 0.0116,
    "asian": 0.1084,
    "nhpi": 0.0059,
    "multi": 0.0278,
}

# --- Fixed values: item numbers of the race-by-origin table per category ------
# A single race and the same race combined with "some other race" collapse into
# one category; every remaining combination of races is multi_race.
CATEGORY_ITEMS = {
    "total_all_all": [1],
    "all_hisp_all": [2],
    "white_alone": [5, 17],
    "black_alone": [6, 21],
    "aian_alone": [7, 24],
    "asian_alone": [8, 26],
    "nhpi_alone": [9, 27],
    "sor_alone": [10],
    "multi_race": [
        *range(13, 17), *range(18, 21), 22, 23, 25,
        *range(29, 49), *range(50, 65), *range(66, 72), 73,
    ],
}
LAST_ITEM = 73

# --- Fixed values: housing and group-quarters codes -> column names -----------
HOUSING_CODES = {
    "H1_001N": "hu_total",
    "H1_002N": "hu_occupied",
    "H1_003N": "hu_vacant",
    "P5_001N": "gq_total",
    "P5_002N": "gq_inst",
    "P5_003N": "gq_inst_corr_adult",
    "P5_004N": "gq_inst_juv",
    "P5_005N": "gq_inst_nursing",
    "P5_006N": "gq_inst_other",
    "P5_007N": "gq_noninst",
    "P5_008N": "gq_noninst_college",
    "P5_009N": "gq_noninst_military",
    "P5_010N": "gq_noninst_other",
}

# --- Fixed values: 2010 count codes -> column names ---------------------------
GQ_CODES_2010 = {"P042001": "GQ_TOT"}
HOUSING_CODES_2010 = {"H001001": "HU_TOT", "H001003": "HU_VAC"}
VACANCY_CODES_2010 = {"H003001": "HU_TOT", "H003003": "HU_VAC"}

# --- Fixed values: survey codes -> column names -------------------------------
BROADBAND_CODES = {"B28002_004": "broadband", "B28002_001": "total"}

# --- Fixed values: area-code changes between vintages -------------------------
MERGED_AREAS = {"51515": "51019", "46113": "46102", "02270": "02158"}
SPLIT_AREAS = {"02261": ["02063", "02066"]}
ROLLED_UP_AREAS = {"02261": ["02063", "02066"]}
PARENT_NAMES = {"02261": ("Alaska", "Valdez-Cordova Census Area")}
EXCLUDED_STATE = "72"

# --- Fixed values: name repairs and notes -------------------------------------
AREA_RENAMES = {"District of Columbia": "Washington"}
AREA_NOTES = {
    "02261": (
        "In 2019, this census area was split into Copper River and Chugach census "
        "areas. These two census areas were combined to create the measures for the "
        "Valdez-Cordova Census Area. The measures for the 2020 geographies are "
        "available in the raw data on GitHub."
    ),
}

# --- Fixed values: population groups and the metrics that are graded ----------
GROUPS = ["NH_WA", "NH_BA", "NH_AI", "NH_AA", "NH_NA", "NH_TOM", "H_TOT"]
GROUP_SOURCES = {
    "NH_WA": "NHWA",
    "NH_BA": "NHBA",
    "NH_AI": "NHIA",
    "NH_AA": "NHAA",
    "NH_NA": "NHNA",
    "NH_TOM": "NHTOM",
    "H_TOT": "H",
}
RELATIVE_METRICS = ["POP_TOT", "HU_TOT", "GQ_TOT"]
ABSOLUTE_METRICS = [f"{g}_PROP" for g in GROUPS] + ["PPH_RAT"]
MEASURE_NAMES = {
    "GQ_TOT": "GQ_MEASURE",
    "HU_TOT": "HU_MEASURE",
    "POP_TOT": "POP_MEASURE",
    "NH_WA_PROP": "NH_WA_MEASURE",
    "NH_BA_PROP": "NH_BA_MEASURE",
    "NH_AI_PROP": "NH_AI_MEASURE",
    "NH_AA_PROP": "NH_AA_MEASURE",
    "NH_NA_PROP": "NH_NA_MEASURE",
    "NH_TOM_PROP": "NH_TOM_MEASURE",
    "H_TOT_PROP": "H_MEASURE",
    "PPH_RAT": "PPH_MEASURE",
}

# --- Fixed values: output column order ----------------------------------------
CEN_COLUMNS = [
    "CEN_GQ_TOT", "CEN_HU_TOT", "CEN_HU_VACANT_TOT", "CEN_POP_TOT",
    "CEN_NH_WA_TOT", "CEN_NH_BA_TOT", "CEN_NH_AI_TOT", "CEN_NH_AA_TOT",
    "CEN_NH_NA_TOT", "CEN_NH_TOM_TOT", "CEN_H_TOT_TOT",
]
EST_COLUMNS = [
    "EST_POP_TOT", "EST_NH_WA_TOT", "EST_NH_BA_TOT", "EST_H_TOT_TOT",
    "EST_NH_AI_TOT", "EST_NH_AA_TOT", "EST_NH_NA_TOT", "EST_NH_TOM_TOT",
    "EST_HU_TOT", "EST_GQ_TOT",
]
# Difference name -> the count it compares, in output order.
DIFF_METRICS = {
    "POP": "POP_TOT",
    "GQ": "GQ_TOT",
    "HU": "HU_TOT",
    "NH_BA": "NH_BA_TOT",
    "NH_WA": "NH_WA_TOT",
    "NH_AI": "NH_AI_TOT",
    "NH_AA": "NH_AA_TOT",
    "NH_NA": "NH_NA_TOT",
    "NH_TOM": "NH_TOM_TOT",
    "H": "H_TOT_TOT",
    "PPH": "PPH_TOT",
}
# Groups whose share is also 0 when the actual count is 0.
ZERO_IF_ACTUAL_ZERO = ["NH_BA", "NH_WA", "NH_AI", "NH_AA", "NH_NA", "NH_TOM"]
COUNTY_MAIN_COLUMNS = [
    "GEOID", "STNAME", "CTYNAME", "GEOYEAR", "SIZE_CLASS",
    *CEN_COLUMNS, "CEN_HH_TOT", "CEN_PPH_TOT",
    *EST_COLUMNS, "EST_HH_TOT", "EST_PPH_TOT",
    *[f"SHARE_{d}_DIFF" for d in DIFF_METRICS],
    "PCT_HH_BROADBAND", "PCT_HH_BROADBAND_NATIONAL",
    "PCT_VACANT_HU_2020", "PCT_VACANT_HU_2010", "PCT_VACANT_CHANGE",
    *[f"{d}_DIFF" for d in DIFF_METRICS],
    "NOTES", *MEASURE_NAMES.values(), "VACANCY_MEASURE",
]
CUTPOINT_COLUMNS = [
    "variable", "SIZE_CLASS", "count", "mean", "sd",
    "range_1_high", "range_1_low", "range_2_high", "range_2_low",
]
FEMA_COLUMNS = [
    "STNAME", "State", "CTYNAME", "County", "GEOID",
    "declarationTitle", "FEMAWEB", "fema_id", "IB_date", "IE_date",
]
# County-count columns -> names used when compared with the estimates.
COUNT_ALIASES = {
    "fips": "GEOID",
    "gq_total": "CEN_GQ_TOT",
    "hu_total": "CEN_HU_TOT",
    "hu_vacant": "CEN_HU_VACANT_TOT",
    "total_all_all": "CEN_POP_TOT",
    "white_all_all": "CEN_NH_WA_TOT",
    "black_all_all": "CEN_NH_BA_TOT",
    "aian_all_all": "CEN_NH_AI_TOT",
    "asian_all_all": "CEN_NH_AA_TOT",
    "nhpi_all_all": "CEN_NH_NA_TOT",
    "twoplus_all_all": "CEN_NH_TOM_TOT",
    "all_hisp_all": "CEN_H_TOT_TOT",
}
