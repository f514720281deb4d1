"""Properties over the whole sf0.001 tables: the split is disjoint and
total, the union is the sum of its parts, kept lines respect the bounds."""

from pyspark.sql import functions as F

from parcelle.functions.typing import ratio
from parcelle.operators.aggregate import building_sales, land_sales
from parcelle.operators.filters import (
    prepare_buildings,
    prepare_land,
    sale_lines,
    split_buildings,
    split_land,
)
from parcelle.plans.clean import clean_sales, typed_sales
from parcelle.sources.adapter import raw_sales


def test_split_disjoint_and_total(spark, sf_small):
    typed = typed_sales(raw_sales(spark, sf_small)).cache()
    b, l = split_buildings(typed), split_land(typed)
    assert b.count() + l.count() == typed.count()
    assert b.intersect(l).count() == 0


def test_union_is_sum_of_parts(spark, sf_small):
    typed = typed_sales(raw_sales(spark, sf_small)).cache()
    total = clean_sales(raw_sales(spark, sf_small)).count()
    parts = (building_sales(sale_lines(typed, land=False)).count()
             + land_sales(sale_lines(typed, buildings=False)).count())
    assert total == parts


def test_kept_lines_within_bounds(spark, sf_small):
    typed = typed_sales(raw_sales(spark, sf_small))
    b = prepare_buildings(typed)
    assert b.filter(~F.col("prix_m2").between(100, 20000)).count() == 0
    l = prepare_land(typed)
    assert l.filter(~ratio("valeur_fonciere", "surface_terrain").between(0.5, 1000)).count() == 0
