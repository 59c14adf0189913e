"""Independent SQL (DuckDB dialect) for the registered queries.

Each string recomputes a query from the driver's raw tables with plain
SQL -- dense window ranks where the Spark side uses sparse, bucketed ones --
so that a match checks the Spark plan rather than re-running it.  Doubles
are rounded to ``DIGITS`` places on both sides.
"""

from __future__ import annotations

from ..functions.stats import erfc_sql
import math

DIGITS = 6

# the stand-in data model as CTEs
BASE = {
    "counts": """
        SELECT o.o_custkey AS cell_id, l.l_partkey AS gene_id, SUM(l.l_quantity) AS value
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        GROUP BY 1, 2 HAVING SUM(l.l_quantity) <> 0""",
    "cells": """
        SELECT c.c_custkey AS cell_id, CAST(c.c_nationkey AS VARCHAR) AS sample,
               c.c_mktsegment AS sample_type,
               CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'healthy' ELSE 'leukemia' END AS health_status,
               nr.r_name AS region
        FROM customer c LEFT JOIN (SELECT n.n_nationkey, r.r_name FROM nation n
                                   JOIN region r ON n.n_regionkey = r.r_regionkey) nr
             ON c.c_nationkey = nr.n_nationkey""",
    "genes": """
        SELECT p_partkey AS gene_id, p_name AS gene_symbol, 'Gene Expression' AS feature_type,
               p_brand = 'Brand#1' AS is_mt FROM part""",
    # P5/P6/N1/N2 with the stand-in thresholds
    "cell_nz": """
        SELECT x.cell_id, COUNT(*) AS n_genes, SUM(x.value) AS total,
               SUM(CASE WHEN g.is_mt THEN x.value ELSE 0.0 END) * 100.0 / SUM(x.value) AS pct_mt
        FROM counts x LEFT JOIN genes g USING (gene_id) WHERE x.value > 0 GROUP BY 1""",
    "kept_cells": """SELECT c.* FROM cells c JOIN cell_nz q USING (cell_id) WHERE q.n_genes >= 20 AND q.pct_mt <= 8.013""",
    "c1": "SELECT * FROM counts WHERE cell_id IN (SELECT cell_id FROM kept_cells)",
    "kept_genes": "SELECT gene_id, COUNT(*) AS n_cells FROM c1 WHERE value > 0 GROUP BY 1 HAVING COUNT(*) >= 3",
    "c2": "SELECT * FROM c1 WHERE gene_id IN (SELECT gene_id FROM kept_genes)",
    "ln": """SELECT cell_id, gene_id, ln(1 + value * 10000.0 / SUM(value) OVER (PARTITION BY cell_id)) AS value
             FROM c2""",
}


def with_(*names: str, **extra: str) -> str:
    """A WITH clause of the named BASE CTEs followed by ``extra`` ones, in
    order.  Dependencies among BASE entries are added automatically."""
    order = list(BASE)
    deps = {"kept_cells": ["cells", "cell_nz"], "cell_nz": ["counts", "genes"], "c1": ["counts", "kept_cells"],
            "kept_genes": ["c1"], "c2": ["c1", "kept_genes"], "ln": ["c2"]}
    deps.update(_DEPS_EXTRA)
    need: set[str] = set()

    def add(n):
        if n in need:
            return
        need.add(n)
        for d in deps.get(n, []):
            add(d)
    for n in names:
        add(n)
    parts = [f"{n} AS ({BASE[n]})" for n in order if n in need]
    parts += [f"{k} AS ({v})" for k, v in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def rnd(*cols: str) -> str:
    return ", ".join(f"round({c}, {DIGITS}) AS {c.split('.')[-1]}" for c in cols)


def wilcoxon_ctes(layer: str, labels: str, universe: str, strata: str | None = None) -> dict:
    """CTEs computing group-vs-rest Wilcoxon statistics with dense ranks.

    ``labels`` has cell_id, grp (and ``strata`` column ``st`` when given);
    result CTE ``de`` has [st,] grp, gene_id, score, logfc, pval, padj.
    """
    st = "st, " if strata else ""
    part = "PARTITION BY st, gene_id" if strata else "PARTITION BY gene_id"
    p_sql = erfc_sql(f"(abs(score)/{math.sqrt(2.0)!r})")
    return {
        "w_lab": f"SELECT cell_id, {st}grp FROM {labels} WHERE grp IS NOT NULL",
        "w_sizes": f"SELECT {st}grp, COUNT(*) AS n1 FROM w_lab GROUP BY ALL",
        "w_tot": f"SELECT {st}SUM(n1) AS n FROM w_sizes GROUP BY ALL" if strata else
                 "SELECT SUM(n1) AS n FROM w_sizes",
        "w_x": f"SELECT l.gene_id, l.value, {'b.st, ' if strata else ''}b.grp FROM {layer} l "
               f"JOIN w_lab b USING (cell_id) WHERE l.value <> 0",
        "w_rk": f"""SELECT {st}gene_id, grp, value,
                       RANK() OVER ({part} ORDER BY value) AS rk_min,
                       COUNT(*) OVER ({part}, value) AS ties,
                       COUNT(*) OVER ({part}) AS nnz_gene FROM w_x""",
        "w_gs": f"""SELECT a.{st}a.gene_id, a.grp, SUM(t.n - a.nnz_gene + a.rk_min + (a.ties - 1) / 2.0) AS r_nz,
                       COUNT(*) AS nnz, SUM(a.value) AS vsum
                    FROM w_rk a JOIN w_tot t ON TRUE {'AND a.st = t.st' if strata else ''}
                    GROUP BY ALL""" if strata else
                f"""SELECT a.gene_id, a.grp, SUM(t.n - a.nnz_gene + a.rk_min + (a.ties - 1) / 2.0) AS r_nz,
                       COUNT(*) AS nnz, SUM(a.value) AS vsum
                    FROM w_rk a CROSS JOIN w_tot t GROUP BY ALL""",
        # gene totals as sums of the group sums: when only one group has
        # nonzeros, total - group sum is then exactly 0
        "w_gt": f"SELECT {st}gene_id, SUM(nnz) AS nnz_gene, SUM(vsum) AS vsum_gene FROM w_gs GROUP BY ALL",
        "w_grid": (f"""SELECT u.gene_id, s.st, s.grp, s.n1, t.n - s.n1 AS n2 FROM {universe} u
                       CROSS JOIN w_sizes s JOIN w_tot t ON s.st = t.st WHERE t.n - s.n1 > 0""" if strata else
                   f"""SELECT u.gene_id, s.grp, s.n1, t.n - s.n1 AS n2 FROM {universe} u
                       CROSS JOIN w_sizes s CROSS JOIN w_tot t WHERE t.n - s.n1 > 0"""),
        "w_stats": f"""SELECT g.*, COALESCE(gt.nnz_gene, 0) AS nnz_gene, COALESCE(gt.vsum_gene, 0) AS vsum_gene,
                          COALESCE(gs.r_nz, 0) AS r_nz, COALESCE(gs.nnz, 0) AS nnz, COALESCE(gs.vsum, 0) AS vsum
                       FROM w_grid g
                       LEFT JOIN w_gt gt ON gt.gene_id = g.gene_id {'AND gt.st = g.st' if strata else ''}
                       LEFT JOIN w_gs gs ON gs.gene_id = g.gene_id AND gs.grp = g.grp {'AND gs.st = g.st' if strata else ''}""",
        "w_z": f"""SELECT {st}grp, gene_id,
                      (r_nz + (n1 - nnz) * (n1 + n2 - nnz_gene + 1) / 2.0 - n1 * (n1 + n2 + 1) / 2.0)
                        / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0) AS score,
                      log2((exp(vsum / n1) - 1 + 1e-9) / (exp((vsum_gene - vsum) / n2) - 1 + 1e-9)) AS logfc
                   FROM w_stats""",
        "w_p": f"SELECT *, {p_sql} AS pval FROM w_z",
        "w_bh": f"""SELECT *, pval * COUNT(*) OVER (PARTITION BY {st}grp)
                         / ROW_NUMBER() OVER (PARTITION BY {st}grp ORDER BY pval, gene_id) AS bh_raw,
                      ROW_NUMBER() OVER (PARTITION BY {st}grp ORDER BY pval, gene_id) AS bh_rank FROM w_p""",
        "de": f"""SELECT {st}grp, gene_id, score, logfc, pval,
                     LEAST(1.0, MIN(bh_raw) OVER (PARTITION BY {st}grp ORDER BY bh_rank DESC
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padj
                  FROM w_bh""",
    }


BASE.update({
    "cell_qc": """
        SELECT c.*, COALESCE(q.n_genes, 0) AS n_genes_by_counts, COALESCE(q.total, 0.0) AS total_counts,
               COALESCE(q.mt, 0.0) AS total_counts_mt,
               COALESCE(CASE WHEN q.total > 0 THEN q.mt * 100.0 / q.total END, 0.0) AS pct_counts_mt
        FROM cells c LEFT JOIN (
            SELECT x.cell_id, COUNT(*) AS n_genes, SUM(x.value) AS total,
                   SUM(CASE WHEN g.is_mt THEN x.value ELSE 0.0 END) AS mt
            FROM counts x JOIN genes g USING (gene_id) WHERE x.value > 0 GROUP BY 1) q USING (cell_id)""",
    "kept_qc": "SELECT * FROM cell_qc WHERE cell_id IN (SELECT cell_id FROM kept_cells)",
    "clf_lab": "SELECT cell_id, sample_type AS grp FROM kept_cells",
    "clf_gsz": "SELECT grp, COUNT(*) AS n FROM clf_lab GROUP BY 1",
    "clf_gm": """SELECT l.grp AS type, x.gene_id, SUM(x.value) / MAX(s.n) AS w
                 FROM ln x JOIN clf_lab l USING (cell_id) JOIN clf_gsz s USING (grp) GROUP BY 1, 2""",
    "clf_icpt": "SELECT type, -0.5 * SUM(w * w) AS b FROM clf_gm GROUP BY 1",
    "clf_dot": "SELECT x.cell_id, g.type, SUM(x.value * g.w) AS d FROM ln x JOIN clf_gm g USING (gene_id) GROUP BY 1, 2",
    "clf_dec": """SELECT c.cell_id, i.type, COALESCE(d.d, 0.0) + i.b AS decision
                  FROM kept_cells c CROSS JOIN clf_icpt i
                  LEFT JOIN clf_dot d ON d.cell_id = c.cell_id AND d.type = i.type""",
    "clf_dec2": """SELECT *, MAX(decision) OVER (PARTITION BY cell_id) AS mx,
                          ROW_NUMBER() OVER (PARTITION BY cell_id ORDER BY decision DESC, type) AS r FROM clf_dec""",
    "pred": """SELECT cell_id, type AS predicted_celltype, decision,
                      1.0 / z AS confidence FROM (
                 SELECT *, SUM(exp(decision - mx)) OVER (PARTITION BY cell_id) AS z FROM clf_dec2) WHERE r = 1""",
    "ann": """SELECT k.cell_id, k.sample, k.sample_type, k.health_status, k.region, k.sample AS leiden,
                     k.n_genes_by_counts, k.total_counts, k.pct_counts_mt,
                     CASE WHEN k.health_status = 'healthy' THEN
                            CASE WHEN k.sample IN ('0','1') THEN 'B cells'
                                 WHEN k.sample IN ('2','3') THEN 'T cells' ELSE 'Monocytes' END
                          ELSE CASE WHEN k.sample IN ('0','1') THEN 'Leukemic B cells'
                                    WHEN k.sample IN ('2','3') THEN 'Leukemic T cells'
                                    ELSE 'Leukemic blasts' END END AS rule_cell_type,
                     p.predicted_celltype AS classifier_cell_type, p.confidence AS classifier_confidence
              FROM kept_qc k JOIN pred p USING (cell_id)""",
})
_DEPS_EXTRA = {
    "cell_qc": ["cells", "counts", "genes"], "kept_qc": ["cell_qc", "kept_cells"],
    "clf_lab": ["kept_cells"], "clf_gsz": ["clf_lab"], "clf_gm": ["ln", "clf_lab", "clf_gsz"],
    "clf_icpt": ["clf_gm"], "clf_dot": ["ln", "clf_gm"], "clf_dec": ["kept_cells", "clf_icpt", "clf_dot"],
    "clf_dec2": ["clf_dec"], "pred": ["clf_dec2"], "ann": ["kept_qc", "pred"],
}
