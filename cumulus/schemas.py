"""Declared schemas for every source; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S = T.LongType(), T.DoubleType(), T.StringType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One row per jurisdiction per snapshot date (the columns the reports read).
SNAPSHOT = _st(
    ("Date", T.DateType()), ("Location", S), ("LongName", S),
    ("Census2019", L), ("Census2019_12PlusPop", L),
    ("Doses_Distributed", L), ("Doses_Administered", L),
    ("Administered_Dose1_Recip", L), ("Administered_Dose2_Recip", L),
    ("Administered_Janssen", L), ("Administered_Dose1_Pop_Pct", D),
    ("Distributed_Moderna", L), ("Distributed_Pfizer", L), ("Distributed_Janssen", L),
)

# Same record as it arrives in the JSON feed: the date is text.
SNAPSHOT_RECORD = T.StructType(
    [T.StructField("Date", S, True)] + list(SNAPSHOT.fields[1:]))

# Population dimension (file columns in file order).
POPULATION = _st(("Geographic_Area_Name", S), ("Census2019_2", L),
                 ("Census2019_18PlusPop_2", L), ("postal_code", S),
                 ("fips_code", T.IntegerType()))

FIPS = _st(("name", S), ("postal_code", S), ("fips_code", T.IntegerType()))

ELIGIBILITY = _st(
    ("State", S), ("Total_Population", L), ("Health_care_personnel", L),
    ("Long-term_care_facillity residents", L), ("Frontline_essential_workers", L),
    ("Persons_aged_75+", L), ("Persons_aged_65–74", L),
    ("Persons_aged_18-64_and_any_of_obesity_diabetes_COPD_heart_disease_CKD", L),
    ("Persons_aged_under_65_with_cancer", L), ("Persons_aged_15-49_and_pregnant", L),
    ("Persons_aged_16+_and_smoker", L),
    ("Essential_workers_not_recommended_in_Phase_1b", L), ("Total_of_boxes_above", L),
    ("People_who_fall_into_more_than_one_group", L), ("Total_people_to_vaccinate", L),
    ("postal_code", S), ("fips_code", T.IntegerType()),
)

# County feed record; any field may be absent from a record.
COUNTY_RECORD = _st(("Date", S), ("FIPS", S), ("StateName", S), ("StateAbbr", S),
                    ("County", S), ("Series_Complete_Pop_Pct", D),
                    ("Administered_Dose1_Pop_Pct", D))

# Age feed: ten typed columns, of which three are read.
AGE_FEED = _st(
    ("date", T.TimestampNTZType()), ("demographic_category", S),
    ("administered_dose1", L), ("administered_dose1_pct_known", D),
    ("administered_dose1_pct_us", D), ("series_complete_yes", L),
    ("series_complete_pop_pct_known", D), ("series_complete_pop_pct_us", D),
    ("administered_dose1_pct", D), ("series_complete_pop_pct", D),
)

# Published age-share history: date + one share column per band.
AGE_BANDS_AS_PUBLISHED = ("12-15", "16-17", "25-39", "40-49", "50-64", "65-74", "75+")


def share_history(bands=AGE_BANDS_AS_PUBLISHED, date_col: str = "Date") -> T.StructType:
    return T.StructType([T.StructField(date_col, T.DateType(), True)]
                        + [T.StructField(b, D, True) for b in bands])


# The driver's Parquet tables (file column order), declared so a scan plans
# without a schema-inference job (Spark otherwise reads a footer in its own
# job for every table it opens).  Timestamps carry no zone: timestamp_ntz.
I, TS = T.IntegerType(), T.TimestampNTZType()
DRIVER_TABLES = {
    "region": _st(("r_regionkey", I), ("r_name", S)),
    "nation": _st(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _st(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                    ("c_mktsegment", S)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                  ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                    ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                    ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                    ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _st(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                  ("value", D), ("props", S)),
    "documents": _st(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
}
