"""Fixed values.  These must equal the tracked program's values for its results
to be reproduced; everything else in cumulus is a parameter with these as
defaults."""

from __future__ import annotations

import datetime as _dt

# ---- fixed values -----------------------------------------------------------
# Jurisdiction codes left out of the formatted state table (federal entities
# and the national row).
EXCLUDED_CODES = ("BP2", "DD2", "IH2", "VA2", "LTC", "US")

# Jurisdiction names left out of the weekly projections.  The supply
# projection uses the first five only (the national row is dropped later by
# the dimension join).
EXCLUDED_NAMES = ("Bureau of Prisons", "Long Term Care", "Dept of Defense",
                  "Indian Health Svc", "Veterans Health", "United States")
EXCLUDED_NAMES_SUPPLY = EXCLUDED_NAMES[:5]

# Code of the national row inside a snapshot.
NATIONAL_CODE = "US"

# National population used for the national per-capita figures.
NATIONAL_POPULATION = 331996199

# Name canonicalisation applied to every snapshot.
CANONICAL_NAMES = {"New York State": "New York"}

# Label of the total row placed above detail rows.
TOTAL_LABEL = "U.S. Total"

# Age categories of the feed.  The tracked program spells the third with an
# underscore, so it never matches there and the 18-24 band is absent from the
# published shares.
AGE_CATEGORIES = ("Ages_12-15_yrs", "Ages_16-17_yrs", "Ages_18-24_yrs",
                  "Ages_25-39_yrs", "Ages_40-49_yrs", "Ages_50-64_yrs",
                  "Ages_65-74_yrs", "Ages_75+_yrs")

# Pattern that turns a category name into its column label ("12-15", "75+").
BAND_LABEL_PATTERN = r"\d{2}[-\+]\d*"

# Projection targets.
TARGET_SHARE = 0.7
PERIOD_DAYS = 7
SECOND_DOSE_LAG_DAYS = 28

# Supply-lateness labels.  Each arm is (months after the goal date where the
# arm starts, label); the goal date itself is 2021-05-31 in the tracked
# program, which makes the arm edges 2021-06-30, 07-31, 08-31, 09-30, 10-31,
# 11-30 and 2022-05-31.
GOAL_DATE = _dt.date(2021, 5, 31)
LATENESS_LABELS = (
    "Less than 1 month behind",
    "1-2 months behind",
    "2-3 months behind",
    "3-4 months behind",
    "4-5 months behind",
    "5-6 months behind",
    "6 months - 1 year behind",
    "1 year+",
    "Ahead of schedule",
)
LATENESS_EDGE_MONTHS = (1, 2, 3, 4, 5, 6, 12)

# Display names of the published tables.
STATE_TABLE_NAMES = {
    "LongName": "State",
    "Doses_Distributed": "Total Doses Delivered",
    "Doses_Administered": "Total Doses Administered",
    "Administered_Dose1_Per_100K": "People with 1 Dose per 100k",
    "Complete_Vaccinations_Per_100K": "People Completely Vaccinated per 100k",
}
MAP_NAMES = {
    "LongName": "ID",
    "pct_eligible_vaccinated": "% of Currently Eligible Vaccinated",
    "Census2019_12PlusPop": "Total Currently Eligible",
}
TARGET_NAMES = {
    "LongName": "State",
    "pct_fully": "% Population Fully Immunized",
    "doses_last_week": "Doses administered in the last week",
    "target_month": "Estimated to 70% Pop 2 Doses",
}
SUPPLY_NAMES = {
    "LongName": "State",
    "Complete_Vaccinations_Per_100K": "People Vaccinated per 100K",
    "Census2019_18PlusPop_2": "Population",
    "lateness": "How far behind",
    "availability_date": "100% Vaccine Availability Est. Date",
}
ROLLING_NAMES = {
    "first_avg": "First Dose Daily Avg",
    "second_avg": "Second Dose Daily Avg",
}
COUNTY_NAMES = {"FIPS": "FIPS-Code"}
# ---- end of fixed values ----------------------------------------------------
