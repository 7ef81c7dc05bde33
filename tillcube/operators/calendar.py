"""Festival calendar, festival tagging (J6) and the time dimension (T-DIM).

The reference tags a date with the first festival (in list order) whose
centre lies within +-5 days, else (False, NULL).  Instead of a band join
(which plans as a nested-loop join), each centre is expanded to its 11
days, reduced to one festival per day with ``min_by(name, ordinal)``, and
joined to the facts with an *equi* join.  The expanded table holds
11 x (number of listed centres) days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's calendar for right results).
# Festival centres in list order: (centre date, festival name).
REFERENCE_FESTIVALS = [
    ("2023-03-08", "Holi"),
    ("2023-04-22", "Eid"),
    ("2023-11-12", "Diwali"),
    ("2023-11-13", "Diwali"),
    ("2023-12-25", "Christmas"),
    ("2024-03-25", "Holi"),
    ("2024-04-11", "Eid"),
    ("2024-11-01", "Diwali"),
    ("2024-11-02", "Diwali"),
    ("2024-12-25", "Christmas"),
]
# Half-width of a festival window, in days.
FESTIVAL_HALF_WIDTH_DAYS = 5
# The mapping for tables of other years applies the reference's first-year
# month-days to each of their years (see FIXTURES.md, C).
DRIVER_FESTIVAL_MONTH_DAYS = [
    ("03-08", "Holi"),
    ("04-22", "Eid"),
    ("11-12", "Diwali"),
    ("11-13", "Diwali"),
    ("12-25", "Christmas"),
]
# ---------------------------------------------------------------------------


def yearly_festivals(span: DataFrame) -> DataFrame:
    """The five month-days of every year ``y0`` to ``y1`` of the one-row frame
    ``span``, in order, as ``festival_calendar`` gives them."""
    listed = F.array(*[F.struct(F.lit(md).alias("md"), F.lit(name).alias("festival_name")) for md, name in DRIVER_FESTIVAL_MONTH_DAYS])
    centres = span.select(F.explode(F.sequence("y0", "y1")).alias("y")).select("y", F.posexplode(listed).alias("k", "f"))
    return centres.select((F.col("y") * len(DRIVER_FESTIVAL_MONTH_DAYS) + F.col("k")).alias("ordinal"),
                          F.to_date(F.concat_ws("-", F.col("y").cast("string"), "f.md")).alias("centre"), "f.festival_name")


def festival_calendar(spark: SparkSession, festivals: list[tuple[str, str]]) -> DataFrame:
    """The centre list as a small DataFrame ``(ordinal, centre, festival_name)``.

    Ordinals are the position in the whole list; the first matching entry wins.  Built from a literal array (a
    local relation on the JVM side, no Python round trip).
    """
    rows = []
    for k, (centre, name) in enumerate(festivals):
        d = dt.date.fromisoformat(centre)
        rows.append(F.struct(F.lit(k).alias("ordinal"), F.lit(d).alias("centre"),
                             F.lit(name).alias("festival_name")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def festival_days(calendar: DataFrame, half_width: int = FESTIVAL_HALF_WIDTH_DAYS) -> DataFrame:
    """One row per festival day: ``(day, festival_name)``; first listed centre wins."""
    days = calendar.select(
        "ordinal", "festival_name",
        dates.day_spine(F.date_sub("centre", half_width), F.date_add("centre", half_width)).alias("day"))
    return days.groupBy("day").agg(F.min_by("festival_name", "ordinal").alias("festival_name"))


def tag_festival(df: DataFrame, date_col: str, fest_days: DataFrame,
                 flag_col: str = "is_festival_month", name_col: str = "festival_name") -> DataFrame:
    """Add ``flag_col`` (boolean) and ``name_col`` to ``df`` by the day in ``date_col``.

    Equi left join; Spark broadcasts the festival days while they are under
    its byte threshold.
    """
    f = fest_days.select(F.col("day").alias("__fday"), F.col("festival_name").alias("__fname"))
    out = df.join(f, F.col(date_col) == F.col("__fday"), "left")
    return (out.withColumn(flag_col, F.col("__fday").isNotNull())
               .withColumn(name_col, F.col("__fname"))
               .drop("__fday", "__fname"))


def dim_time_from_span(span: DataFrame, fest_days: DataFrame) -> DataFrame:
    """T-DIM: calendar rows for every day from 1 Jan of ``y0`` to 31 Dec of ``y1``.

    ``span`` is a one-row frame with integer columns ``y0`` and ``y1``
    (derived from the facts, so the dimension grows with the data's years).
    """
    spine = span.select(dates.day_spine(F.make_date("y0", F.lit(1), F.lit(1)),
                                        F.make_date("y1", F.lit(12), F.lit(31))).alias("full_date"))
    d = F.col("full_date")
    cols = spine.select(
        dates.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        dates.month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        dates.weekday_monday0(d).alias("day_of_week"),
        dates.day_name(d).alias("day_name"),
        dates.is_weekend(d).alias("is_weekend"),
    )
    return tag_festival(cols, "full_date", fest_days, flag_col="is_festival", name_col="festival_name")


def month_festival_flag(dim_time: DataFrame) -> DataFrame:
    """The festival flag of "a day" of each month.

    The reference reads ``LIMIT 1`` without order, which in insertion order
    is the first day of the month; ``min_by(is_festival, date_key)`` is that
    row made deterministic.  ``any_festival_day`` offers the flag of the
    whole month (``bool_or``) for callers who want it.
    """
    return dim_time.groupBy("month").agg(
        F.min_by("is_festival", "date_key").alias("is_festival"),
        F.bool_or("is_festival").alias("any_festival_day"))
