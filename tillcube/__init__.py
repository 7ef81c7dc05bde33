"""Retail sales analytics on Spark DataFrames.

    from tillcube import get_session, load_warehouse, kpi
    spark = get_session("local[8]")
    wh = load_warehouse(spark, "/root/testdata/sf0.1")
    kpi.category_performance(wh.summary()).show()
"""

from .operators import calendar, kpi, layout, ml, olap, summary, temporal
from .session import get_session
from .sources.retail import Warehouse, load_warehouse
from .sources.views import register_views, sql

__all__ = ["calendar", "kpi", "layout", "ml", "olap", "summary", "temporal", "get_session",
           "Warehouse", "load_warehouse", "register_views", "sql"]
