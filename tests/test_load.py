"""The load with a caller-given festival calendar, and without the layout tables."""

from pyspark.sql import functions as F

from tillcube.operators import calendar
from tillcube.sources import retail


def test_load_with_another_calendar(spark, sf_dir):
    # The reference's own 2023-2024 centres: none is near the 1995-2001 sales.
    wh = retail.load_warehouse(spark, sf_dir, festivals=calendar.REFERENCE_FESTIVALS, layout_tables=False)
    assert wh.star is None and wh.master_path is None
    assert wh.sales().filter(F.col("is_festival_month")).count() == 0
    # 10 centres x 11 days; each year's two Diwali centres, a day apart, share 10 days
    assert wh.festival_days().count() == 10 * 11 - 2 * 10
    # The calendar-driven load is not reused for the default calendar.
    default = retail.load_warehouse(spark, sf_dir)
    assert default.root != wh.root
    assert default.sales().filter(F.col("is_festival_month")).count() > 0
