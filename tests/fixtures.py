"""Small synthetic inputs of our own, generated in code."""

from __future__ import annotations

import datetime

import numpy as np

from weekpanel.schema import RAW_CASES

LABEL_NONE = "DENGUE SIN SIGNOS DE ALARMA"
LABEL_WARN = "DENGUE CON SIGNOS DE ALARMA"
BUSY, QUIET = "000311", "000742"


def busy_rows(year: int, week: int) -> int:
    """Rows of the busy unit in a week: 2 to 6, never none."""
    return 2 + (3 * week + year) % 5


def quiet_rows(year: int, week: int) -> int:
    """Rows of the quiet unit: one in every third week."""
    return int((week + year) % 3 == 0)


def raw_cases(spark, years=range(2014, 2020), weeks: int = 50):
    """A busy unit without empty weeks and a quiet one with many."""
    rows = []
    for year in years:
        for week in range(1, weeks + 1):
            rows += [("NORTH", "COAST", "HARBOUR", LABEL_NONE, str(year), str(week), BUSY, "31", "A", "M")] * busy_rows(year, week)
            rows += [("SOUTH", "HILLS", "MILL", LABEL_WARN, str(year), str(week), QUIET, "44", "A", "F")] * quiet_rows(year, week)
    return spark.createDataFrame([r + (None,) * 4 for r in rows], RAW_CASES)


def master_like(spark, units=(("000101", 14.0), ("000202", 5.0), ("000303", 2.0)), weeks=170, seed=11):
    """Panel rows with a yearly wave and Poisson noise."""
    rng = np.random.default_rng(seed)
    rows = []
    for unit, level in units:
        for i in range(weeks):
            year, week = 2016 + i // 52, i % 52 + 1
            cases = int(rng.poisson(level * (1.3 + np.cos(2 * np.pi * (week - 20) / 52))))
            rows.append((unit, "R" + unit[3], "D" + unit, year, week, datetime.date(year, 1, 1) + datetime.timedelta(weeks=week - 1), i, cases))
    return spark.createDataFrame(rows, "unit_id string, region string, district string, year int, week int, week_start date, week_id long, cases long")


def seasonal_master(spark, units=("010101", "020202"), years=range(2019, 2025)):
    """Units with a triangular season around week 20: 24 cases at its top, none from twelve weeks away on."""
    rows = []
    for i, (year, week) in enumerate((y, w) for y in years for w in range(1, 53)):
        for u in units:
            rows.append((u, "REGION " + u[1], "PROV", "DIST" + u, year, week, datetime.date(year, 1, 1) + datetime.timedelta(weeks=week - 1), i,
                         max(0, 24 - 2 * abs(week - 20)), 33.0, 0.2, 0.1, 0.4))
    return spark.createDataFrame(
        rows,
        "unit_id string, region string, province string, district string, year int, week int, week_start date, week_id long, "
        "cases long, age_mean double, warn_share double, severe_share double, female_share double",
    )
