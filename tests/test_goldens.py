"""Expected values of FIXTURES.md (E) at sf0.001, independent of the oracle SQL."""

import pytest

import __spark_entry__ as E


@pytest.fixture(scope="module")
def q(spark, sf_dir):
    return lambda name: E.queries()[name](spark, sf_dir).collect()


def test_totals(q):
    t = q("overview_totals")[0]
    assert t.total_orders == 6000
    assert t.total_revenue == pytest.approx(131_498_557.36, abs=0.005)
    assert t.total_profit == pytest.approx(32_765_275.74, abs=0.005)
    assert t.avg_order_value == pytest.approx(21_916.426226666666, rel=1e-15)
    assert t.total_items_sold == 152_257


def test_festival_rows_and_sales(q):
    fest = {r.festival_name: (r.total_orders, r.total_sales) for r in q("festival_sales")}
    expected = {"Christmas": (165, 3_514_586.82), "Diwali": (197, 4_589_116.48),
                "Eid": (199, 4_590_310.22), "Holi": (190, 4_158_614.09)}
    for name, (rows, sales) in expected.items():
        assert fest[name][0] == rows and fest[name][1] == pytest.approx(sales, abs=0.005)
    other = q("non_festival_sales")[0]
    assert other.total_orders == 5249 and other.total_sales == pytest.approx(114_645_929.75, abs=0.005)


def test_economy_category(q):
    eco = {r.category_name: r for r in q("category_performance")}["ECONOMY"]
    assert eco.total_orders == 1066
    assert eco.total_sales == pytest.approx(23_992_987.40, abs=0.005)
    assert eco.profit_margin_percent == 27.54


def test_year_1997(q):
    y = {r.year: r for r in q("olap_rollup")}[1997]
    assert y.yearly_sales == pytest.approx(19_058_710.80, abs=0.005)
    assert y.yearly_profit == pytest.approx(4_762_255.32, abs=0.005)


def test_best_product(q):
    best = q("top_products")[0]
    assert (best.product_name, best.category_name) == ("hot rod", "SMALL")
    assert 99 in (best.times_sold, best.total_quantity_sold)
    assert best.total_revenue == pytest.approx(2_126_169.06, abs=0.005)
