"""Queries that take all of their table."""

from sheafworks.plans import layout, registry

SF = "/root/testdata/sf0.001"


def test_box_distance_takes_all_pairs(spark):
    pairs = layout.words(spark, SF).select("page_id").join(layout.entities(spark, SF).select("page_id"), "page_id").count()
    got = registry.QUERIES["box_distance"](spark, SF)
    assert got.count() == pairs > got.where("word_id = entity_id").count()


def test_hsv_colors_take_all_hues(spark):
    got = registry.QUERIES["hsv_colors"](spark, SF).toPandas()
    assert got["h"].nunique() == 180 and got["s"].nunique() > 50 and got["v"].nunique() > 5
    assert (got["v2"] == got["v"]).all()
