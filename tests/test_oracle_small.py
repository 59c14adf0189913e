"""A slice of the registered queries against their DuckDB oracle at sf0.001."""

import pytest

from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = ["rank_genes_groups", "qc_cells", "hvg_seurat", "abnormal_clusters_ratio", "cluster_composition",
         "compare_labels", "enrich", "knn", "group_connectivity", "make_unique"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, name, SF, con, verbose=True)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
