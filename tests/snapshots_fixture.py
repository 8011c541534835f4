"""A hand-made snapshot history in the feed's own shape."""

import datetime as dt

from cumulus.schemas import POPULATION, SNAPSHOT

AS_OF = dt.date(2021, 7, 21)
DATES = [AS_OF - dt.timedelta(days=k) for k in (7, 1, 0)]

# code, long name, population, 12+ population, base doses, weekly pace
JURIS = [("US", "United States", 1000000, 900000, 500000, 7000),
         ("BP2", "Bureau of Prisons", 5000, 5000, 3000, 70),
         ("MA", "Massachusetts", 70000, 60000, 50000, 700),
         ("VT", "Vermont", 6000, 5500, 5000, 0),
         ("GU", "Guam", 1600, 1400, 800, 14),
         ("NY", "New York State", 200000, 180000, 100000, 1400)]


def history(spark):
    rows = []
    for d in DATES:
        k = (d - DATES[0]).days
        for code, name, pop, pop12, base, pace in JURIS:
            d1 = base + pace * k
            d2 = int(d1 * 0.8)
            rows.append((d, code, name, pop, pop12, 2 * d1 + 1000, d1 + d2, d1, d2, 10,
                         round(d1 * 100 / pop, 1), d1, d1, 100 + pace * k))
    return spark.createDataFrame(rows, SNAPSHOT)


def dim(spark):
    return spark.createDataFrame(
        [("Massachusetts", 70000, 55000, "MA", 25), ("Vermont", 6000, 5000, "VT", 50),
         ("New York", 200000, 150000, "NY", 36)], POPULATION)
