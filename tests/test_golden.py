"""Golden rows published by the reference (values copied as fixed data)."""

from pyspark.sql import functions as F

from cellspark.operators import aggregates as AG
from cellspark.operators import labels as LB
from cellspark.operators import reference as RF

# The reference's published auto-labelling rows (cell,
# predicted type, confidence) and the summary it derived from them.
AUTO_ROWS = [
    ("Cell_1", "Neutrophil", 0.17210192559747792), ("Cell_2", "T_cell", 0.17216970268019577),
    ("Cell_3", "Neutrophil", 0.1), ("Cell_4", "Monocyte", 0.1),
    ("Cell_5", "T_cell", 0.2213262799028181), ("Cell_6", "Neutrophil", 0.15480075953582464),
    ("Cell_7", "Neutrophil", 0.1), ("Cell_8", "Monocyte", 0.1),
    ("Cell_9", "Monocyte", 0.22866329055016313), ("Cell_10", "Neutrophil", 0.17658081019948285),
]
AUTO_SUMMARY = {"Monocyte": (3, 0.143, 0.074), "Neutrophil": (5, 0.141, 0.038), "T_cell": (2, 0.197, 0.035)}


def test_confidence_summary_golden(spark):
    df = spark.createDataFrame(AUTO_ROWS, "cell_id string, predicted_celltype string, confidence double")
    got = {r[0]: (r[1], r[2], r[3]) for r in AG.confidence_summary(df).collect()}
    assert got == AUTO_SUMMARY


# Published abnormal clusters (cluster, total, leukemia cells,
# dominant sample type), expected in score order with cluster as tiebreak.
ABNORMAL = [(0, 9088, 9088, "HHD"), (1, 7739, 7739, "ETV6-RUNX1"), (3, 7030, 7030, "ETV6-RUNX1"),
            (4, 7021, 7021, "HHD"), (7, 6178, 6178, "ETV6-RUNX1"), (5, 6589, 6588, "PRE-T"),
            (6, 6473, 6470, "ETV6-RUNX1"), (2, 7521, 7515, "PRE-T")]


def test_abnormal_clusters_percent_golden(spark):
    rows = []
    for cl, tot, leuk, st in ABNORMAL:
        rows.append((cl, "leukemia", st, leuk))
        if tot > leuk:
            rows.append((cl, "healthy", "PBMMC", tot - leuk))
    counts = spark.createDataFrame(rows, "leiden int, health_status string, sample_type string, n long")
    cells = counts.select("leiden", "health_status", "sample_type", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    out = RF.abnormal_clusters_percent(cells, "leiden").collect()
    assert [r["leiden"] for r in out] == [c[0] for c in ABNORMAL]
    for r, (cl, tot, leuk, st) in zip(out, ABNORMAL):
        assert (r["total_cells"], r["leukemia_cells"], r["dominant_sample_type"]) == (tot, leuk, st)
        assert abs(r["leukemia_percentage"] - leuk * 100.0 / tot) < 1e-12


def test_compare_labels_degenerate(spark):
    # constant vs varied -> 0 / 0; two constant labellings -> 1 / 1
    df = spark.createDataFrame([("A", "x", "k"), ("A", "y", "k"), ("A", "z", "k"), ("A", "x", "k")],
                               "a string, b string, c string")
    r = LB.compare_labels(df, "a", "b").first()
    assert r["ari"] == 0.0 and r["nmi"] == 0.0
    r = LB.compare_labels(df, "a", "c").first()
    assert r["ari"] == 1.0 and r["nmi"] == 1.0


def test_cell_types_by_condition_columns(spark):
    df = spark.createDataFrame([("T", "healthy"), ("T", "leukemia"), ("B", "leukemia")],
                               "t string, health_status string")
    out = AG.cell_types_by_condition(df, "t", conditions=["healthy", "leukemia"]).collect()
    assert out[0]["t"] == "T" and out[0]["total_cells"] == 2 and out[0]["healthy_pct"] == 50.0
    assert out[1]["leukemia_pct"] == 100.0


def test_abnormal_ratio_strict(spark):
    # leukemia 10, 50, 90, 95 of 100: strict > 0.8 flags the last two
    rows = []
    for cl, leuk in (("a", 10), ("b", 50), ("c", 90), ("d", 95)):
        rows += [(cl, "leukemia", "X")] * leuk + [(cl, "healthy", "PBMMC")] * (100 - leuk)
    df = spark.createDataFrame(rows, "leiden string, health_status string, sample_type string")
    out = {r["leiden"]: r["is_abnormal"] for r in RF.abnormal_clusters_ratio(df, "leiden", type_col=None).collect()}
    assert out == {"a": False, "b": False, "c": True, "d": True}
