import pytest

from shelfrank.plans.catalogue import NEWNESS, build_catalogue, load_catalogue, save_catalogue
from shelfrank.sources import CATEGORIES, PRODUCT_SCHEMA, scan_csv, write_csv

FIELDS = [f.name for f in PRODUCT_SCHEMA]


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("catalogue")
    kinds = CATEGORIES[:3]
    for k, kind in enumerate(kinds):
        rows = [
            (100 * k + i, kind, "sub", f"n° {i}", 1.0 + i, None if i == 3 else 2.0 + i, "USD", i % 7, i * 3, i % 2 == 0, None)
            for i in range(20)
        ]
        rows[-1] = (*rows[-1][:4], 1e6, *rows[-1][5:])
        write_csv(spark.createDataFrame(rows, PRODUCT_SCHEMA), f"{folder}/{kind}")
    return [f"{folder}/{c}" for c in CATEGORIES]


def test_from_files_to_rankings(spark, files, tmp_path):
    products = load_catalogue(spark, files, PRODUCT_SCHEMA, FIELDS)
    assert products.count() == 60 and products.agg({"row_id": "max"}).first()[0] == 59
    catalogue = build_catalogue(products, NEWNESS)
    assert catalogue.numeric == ("current_price", "raw_price", "discount", "likes_count", "is_new")
    assert catalogue.removed().first()["removed_rows"] == 3
    assert catalogue.outliers().where("column_name = 'current_price'").first()["outliers"] == 3
    assert catalogue.scored.where("brand <> 'Unknown'").count() == 0
    assert catalogue.best_category().count() == 1
    save_catalogue(catalogue, str(tmp_path))
    top = scan_csv(spark, f"{tmp_path}/top_10_products")
    assert top.count() == 10 and "composite_score" in top.columns
    ranking = scan_csv(spark, f"{tmp_path}/category_ranking")
    assert ranking.columns[0] == "category" and ranking.count() == 3
    assert scan_csv(spark, f"{tmp_path}/preprocessed_data").count() == 57


def test_default_catalogue_is_strict(spark, files):
    products = load_catalogue(spark, files, PRODUCT_SCHEMA, FIELDS)
    assert "new_score" not in build_catalogue(products).scored.columns
    with pytest.raises(KeyError):
        build_catalogue(products.drop("currency"))
