from collections import Counter

from clicktrail.operators import products
from clicktrail.schemas import AREA_LEVELS, CITY_INFO, PRODUCT_INFO
from clicktrail.sources.dimensions import city_dimension

CLICKS = "city_id BIGINT, click_product_id BIGINT"


def clicks_of(spark, rows):
    return spark.createDataFrame(rows, CLICKS)


def cities_of(spark, *rows):
    return spark.createDataFrame(rows, CITY_INFO)


def products_of(spark, ids):
    return spark.createDataFrame(
        [(i, f"p{i}", f'{{"product_status": {i % 2}}}') for i in ids], PRODUCT_INFO
    )


def top_of(spark, clicks, cities, ids, levels=AREA_LEVELS):
    per_area = products.area_product_clicks(products.city_product_clicks(clicks_of(spark, clicks)), cities)
    return products.area_top3_product(products.area_product_full(per_area, products_of(spark, ids)), levels, "t")


def test_basic_drops_unknown_cities(spark):
    found = products.click_product_basic(clicks_of(spark, [(1, 5), (77, 5)]), cities_of(spark, (1, "aa", "north")))
    assert [tuple(r) for r in found.collect()] == [(1, "aa", "north", 5)]


def test_city_list_is_distinct_whole_and_in_id_order(spark):
    cities = cities_of(spark, (11, "aa", "north"), (1, "aa", "north"), (2, "b", "south"))
    clicks = clicks_of(spark, [(11, 5), (1, 5), (1, 5), (2, 5)])
    found = products.area_product_clicks(products.city_product_clicks(clicks), cities)
    assert {tuple(r) for r in found.collect()} == {("north", 5, 3, "1:aa,11:aa"), ("south", 5, 1, "2:b")}


def test_counts_per_city_first_equal_counts_of_joined_clicks(spark):
    cities = city_dimension(spark)
    clicks = clicks_of(spark, [(0 if i % 3 == 0 else i % 12, i % 7) for i in range(500)])
    counted = products.area_product_clicks(products.city_product_clicks(clicks), cities)
    joined = products.click_product_basic(clicks, cities)
    expected = Counter((r.area, r.product_id) for r in joined.collect())
    assert {(r.area, r.product_id): r.click_count for r in counted.collect()} == expected


def test_status_and_missing_products(spark):
    cities = cities_of(spark, (1, "aa", "north"))
    found = top_of(spark, [(1, 4), (1, 5), (1, 6)], cities, [4, 5]).collect()
    assert {(r.productid, r.productName, r.productStatus) for r in found} == {
        (4, "p4", "Self"), (5, "p5", "Third Party"),
    }


def test_top_three_with_ties_and_levels(spark):
    clicks = [(0, p) for p in (1, 1, 2, 2, 3, 4, 4, 5, 5, 5)] + [(9, 8), (7, 8), (5, 8)]
    found = top_of(spark, clicks, city_dimension(spark), range(10)).collect()
    north = sorted((r for r in found if r.area == "华北"), key=lambda r: (-r.clickCount, r.productid))
    assert [(r.productid, r.clickCount) for r in north] == [(5, 3), (1, 2), (2, 2)]
    assert north[0].cityInfos == "0:北京"
    assert {r.area: r.areaLevel for r in found} == {
        "华北": "A Level", "东北": "D Level", "西北": "C Level", "华中": "B Level",
    }


def test_area_is_cut_before_the_shuffle(spark):
    plan = top_of(spark, [(0, 1)], city_dimension(spark), [1])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 3, Partial" in plan
