import pytest

from shelfrank.operators.variants import LabelError, attach_equal, attach_labels, attach_left


def test_repeated_labels_are_refused(spark):
    base = spark.createDataFrame([(0, 1.0), (1, 2.0)], "row_id long, x double")
    labels = spark.createDataFrame([(0, 1), (0, 2)], "row_id long, cluster int")
    with pytest.raises(LabelError):
        attach_left(base, labels, "cluster")
    assert sorted(map(tuple, attach_left(base, labels.limit(1), "cluster").collect()))[1] == (1, 2.0, None)


def test_faults_of_all_label_tables_are_found_together(spark):
    base = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "row_id long, x double")

    def labels(column, *keys):
        return spark.createDataFrame([(k, 7) for k in keys], f"row_id long, {column} int")

    for keys, fault in (((0, 1), "2 labels for 3 rows"), ((0, 1, 1), "1 labels repeat a key"), ((0, 1, 9), "belong to no row"), ((0, 1, None), "belong to no row")):
        with pytest.raises(LabelError, match=fault):
            attach_equal(base, labels("cluster", *keys), "cluster")
    tables = {"kmeans": labels("kmeans_cluster", 2, 1, 0), "hierarchical": labels("other", 0, 1, 2), "dbscan": labels("cluster", 0, 1)}
    wide, attached = attach_labels(base, tables, require_equal=True)
    assert attached == ["kmeans"] and wide.columns == ["row_id", "x", "kmeans_cluster"] and wide.count() == 3
    tables["hierarchical"] = labels("hierarchical_cluster", 0, 0, 1)
    wide, attached = attach_labels(base, tables, require_equal=False)
    assert attached == ["kmeans", "dbscan"] and wide.where("cluster IS NULL").count() == 1
    assert attach_labels(base, {}, require_equal=True)[1] == []
