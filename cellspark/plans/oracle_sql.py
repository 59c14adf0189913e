"""Oracle SQL strings keyed like :data:`cellspark.plans.registry.QUERIES`."""

from __future__ import annotations

from .oracle import BASE, rnd, wilcoxon_ctes, with_

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


_seg_de = wilcoxon_ctes("ln", "seg_lab", "kept_genes")
sql("markers_top10", with_(
    "ln", "kept_cells", "kept_genes",
    seg_lab="SELECT cell_id, sample_type AS grp FROM kept_cells",
    **_seg_de,
    top="""SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS rank
           FROM de WHERE padj < 0.999 AND logfc > 0.5""",
) + f"SELECT grp AS \"group\", gene_id, {rnd('score', 'logfc', 'pval', 'padj')}, rank FROM top WHERE rank <= 10")

sql("rank_genes_groups", with_(
    "ln", "kept_cells", "kept_genes",
    seg_lab="SELECT cell_id, sample_type AS grp FROM kept_cells",
    **_seg_de,
) + f"SELECT grp AS \"group\", gene_id, {rnd('score', 'logfc', 'pval', 'padj')} FROM de")

# ------------------------------------------------------- P: filters, cleaning
sql("filter_cells", with_("kept_qc") +
    f"SELECT cell_id, n_genes_by_counts, {rnd('total_counts', 'pct_counts_mt')} FROM kept_qc")
sql("filter_genes", with_("kept_genes") + "SELECT gene_id, n_cells FROM kept_genes")
sql("sample_type_rules", """
    SELECT cell_id, subtype, CASE WHEN subtype IN ('PBMMC') THEN 'healthy' ELSE 'leukemia' END AS status
    FROM (SELECT c_custkey AS cell_id,
                 CASE WHEN starts_with(c_mktsegment, 'AUTO') THEN 'ETV6-RUNX1'
                      WHEN starts_with(c_mktsegment, 'BUILD') THEN 'PBMMC'
                      WHEN starts_with(c_mktsegment, 'FURN') THEN 'HHD'
                      WHEN starts_with(c_mktsegment, 'HOUSE') THEN 'PRE-T' ELSE 'Unknown' END AS subtype
          FROM customer)""")
sql("fill_required", "SELECT c_custkey AS cell_id, c_mktsegment AS sample_type, 'unknown' AS sample FROM customer")
sql("make_unique", with_("genes", g1="""
        SELECT gene_id, gene_symbol,
               ROW_NUMBER() OVER (PARTITION BY gene_symbol ORDER BY gene_id) - 1 AS k FROM genes""",
    g2="""SELECT g1.*, CASE WHEN k = 0 THEN gene_symbol ELSE gene_symbol || '-' || CAST(k AS VARCHAR) END AS cand
          FROM g1""",
    g3="""SELECT g2.*, (k > 0 AND cand IN (SELECT gene_symbol FROM genes))::INT AS clash FROM g2""",
    g4="""SELECT g3.*, SUM(clash) OVER (PARTITION BY gene_symbol ORDER BY gene_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bump FROM g3""") +
    """SELECT gene_id, gene_symbol, CASE WHEN k = 0 THEN gene_symbol
              ELSE gene_symbol || '-' || CAST(k + bump AS VARCHAR) END AS unique_symbol FROM g4""")
sql("drop_null_labels", with_("pred", "cells") +
    "SELECT c.cell_id, p.predicted_celltype FROM cells c JOIN pred p USING (cell_id)")
sql("subset_cells", with_("counts", "cells") +
    f"""SELECT cell_id, gene_id, {rnd('value')} FROM counts
        WHERE cell_id IN (SELECT cell_id FROM cells WHERE health_status = 'healthy')""")
sql("map_symbols", with_("genes") + """
    SELECT gene_id, CASE WHEN regexp_full_match(CAST(gene_id AS VARCHAR), '[0-9]+')
                         THEN 'GENE_' || lpad(CAST(gene_id AS VARCHAR), 4, '0')
                         ELSE CAST(gene_id AS VARCHAR) END AS mapped_symbol FROM genes""")
sql("diagnostics", with_("ln", "kept_cells", "kept_genes", d="""
        SELECT COUNT_IF(isnan(value)) AS n_nan, COUNT_IF(isinf(value)) AS n_inf,
               COUNT_IF(value < 0) AS n_negative, MIN(value) AS mn, MAX(value) AS mx, SUM(value) AS s,
               COUNT(*) AS nnz FROM ln""",
    dims="""SELECT (SELECT COUNT(*) FROM kept_cells) AS nc, (SELECT COUNT(*) FROM kept_genes) AS ng,
                   (SELECT COUNT(*) FROM kept_cells WHERE cell_id NOT IN
                       (SELECT cell_id FROM ln WHERE value <> 0)) AS zc,
                   (SELECT COUNT(*) FROM kept_genes WHERE gene_id NOT IN
                       (SELECT gene_id FROM ln WHERE value <> 0)) AS zg""") + f"""
    SELECT n_nan, n_inf, n_negative, zc AS n_zero_cells, zg AS n_zero_genes,
           round(CASE WHEN nnz < nc * ng THEN LEAST(mn, 0.0) ELSE mn END, 6) AS min_value,
           round(CASE WHEN nnz < nc * ng THEN GREATEST(mx, 0.0) ELSE mx END, 6) AS max_value,
           round(s / (nc * ng), 6) AS mean_value FROM d, dims""")

# ----------------------------------------------------------------- J: joins
sql("concat_samples", with_("counts", "cells") +
    f"""SELECT c.sample || '_' || CAST(x.cell_id AS VARCHAR) AS cell_id, x.gene_id, {rnd('x.value')}
        FROM counts x JOIN cells c USING (cell_id) WHERE c.health_status IN ('healthy', 'leukemia')""")
sql("align_with_reference", with_("cells") +
    """SELECT cell_id, health_status, health_status = 'healthy' AS is_reference FROM cells
       WHERE health_status IN ('healthy', 'leukemia')""")
sql("attach_labels", with_("pred", "cells") +
    f"""SELECT c.cell_id, COALESCE(p.predicted_celltype, 'Unknown') AS predicted_celltype,
               round(COALESCE(p.confidence, 0.0), 6) AS confidence
        FROM cells c LEFT JOIN pred p USING (cell_id)""")
_DE_CTES = dict(seg_lab="SELECT cell_id, sample_type AS grp FROM kept_cells", **_seg_de)
sql("existing_markers", with_("ln", "kept_cells", "kept_genes", "genes", **_DE_CTES,
    t5="""SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS r FROM de""") +
    f"""SELECT gene_id, {rnd('best_score')} FROM (
          SELECT gene_id, MAX(score) AS best_score FROM t5 WHERE r <= 5
          AND gene_id IN (SELECT gene_id FROM genes) GROUP BY 1)
        ORDER BY best_score DESC, gene_id LIMIT 20""")

# ------------------------------------------------------------ A: aggregates
_PT = (50, 100, 200, 500)
sql("qc_cells", with_("cell_qc", rk="""
        SELECT cell_id, value, ROW_NUMBER() OVER (PARTITION BY cell_id ORDER BY value DESC) AS r
        FROM counts WHERE value > 0""",
    top="SELECT cell_id, " + ", ".join(f"SUM(CASE WHEN r <= {n} THEN value ELSE 0 END) AS t{n}" for n in _PT)
        + " FROM rk GROUP BY 1") +
    "SELECT q.cell_id, q.n_genes_by_counts, round(q.total_counts, 6) AS total_counts, "
    "round(ln(1 + q.n_genes_by_counts), 6) AS log1p_n_genes_by_counts, "
    "round(ln(1 + q.total_counts), 6) AS log1p_total_counts, "
    + ", ".join(f"round(COALESCE(t.t{n} * 100.0 / NULLIF(q.total_counts, 0), 0.0), 6) AS pct_counts_in_top_{n}_genes"
                for n in _PT)
    + ", round(q.total_counts_mt, 6) AS total_counts_mt, round(q.pct_counts_mt, 6) AS pct_counts_mt "
      "FROM cell_qc q LEFT JOIN top t USING (cell_id)")
sql("qc_genes", with_("counts", "genes", "cells", n="SELECT COUNT(*) AS n FROM cells",
    pg="SELECT gene_id, COUNT(*) AS nc, SUM(value) AS tot FROM counts WHERE value > 0 GROUP BY 1") +
    """SELECT g.gene_id, COALESCE(pg.nc, 0) AS n_cells_by_counts,
              round(COALESCE(pg.tot, 0.0), 6) AS total_counts,
              round(COALESCE(pg.tot, 0.0) / n.n, 6) AS mean_counts,
              round(ln(1 + COALESCE(pg.tot, 0.0) / n.n), 6) AS log1p_mean_counts,
              round((1.0 - COALESCE(pg.nc, 0) / n.n) * 100.0, 6) AS pct_dropout_by_counts,
              round(ln(1 + COALESCE(pg.tot, 0.0)), 6) AS log1p_total_counts
       FROM genes g LEFT JOIN pg USING (gene_id) CROSS JOIN n""")
sql("pct_mt", with_("cell_qc") + f"SELECT cell_id, {rnd('pct_counts_mt')} FROM cell_qc")


def _zero_filled(a: str, b: str) -> str:
    """Counts of every value of a with every value of b in ``ann``."""
    return (f"SELECT x.{a}, y.{b}, COUNT(t.cell_id) AS count FROM (SELECT DISTINCT {a} FROM ann) x "
            f"CROSS JOIN (SELECT DISTINCT {b} FROM ann) y LEFT JOIN ann t ON t.{a} = x.{a} AND t.{b} = y.{b} GROUP BY 1, 2")


sql("crosstab_counts", with_("ann") +
    _zero_filled("rule_cell_type", "health_status"))
sql("crosstab_index", with_("ann") +
    """SELECT leiden, rule_cell_type, count,
              round(count * 100.0 / SUM(count) OVER (PARTITION BY leiden), 6) AS pct
       FROM (""" + _zero_filled("leiden", "rule_cell_type") + ")")
sql("crosstab_columns", with_("ann") +
    """SELECT classifier_cell_type, sample_type, count,
              round(count * 100.0 / SUM(count) OVER (PARTITION BY sample_type), 6) AS pct
       FROM (""" + _zero_filled("classifier_cell_type", "sample_type") + ")")
sql("crosstab_wide", with_("ann") + "SELECT classifier_cell_type, " + ", ".join(
    f"COUNT_IF(region = '{r}') AS \"{r}\"" for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))
    + " FROM ann GROUP BY 1")
sql("cell_types_by_condition", with_("ann") +
    """SELECT rule_cell_type, healthy, leukemia, total_cells,
              round(healthy * 100.0 / total_cells, 6) AS healthy_pct,
              round(leukemia * 100.0 / total_cells, 6) AS leukemia_pct
       FROM (SELECT rule_cell_type, COUNT_IF(health_status = 'healthy') AS healthy,
                    COUNT_IF(health_status = 'leukemia') AS leukemia,
                    COUNT_IF(health_status IN ('healthy', 'leukemia')) AS total_cells
             FROM ann GROUP BY 1)""")
sql("value_counts", with_("ann") +
    """SELECT classifier_cell_type, COUNT(*) AS count,
              round(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM ann), 6) AS percent FROM ann GROUP BY 1""")
sql("describe_metrics", with_("ann") + " UNION ALL ".join(
    f"""SELECT '{c}' AS metric, COUNT({c}) AS count, round(AVG({c}), 6) AS mean,
               round(STDDEV_SAMP({c}), 6) AS std, round(MIN({c})::DOUBLE, 6) AS min,
               round(MAX({c})::DOUBLE, 6) AS max, round(MEDIAN({c})::DOUBLE, 6) AS median FROM ann"""
    for c in ("total_counts", "n_genes_by_counts")))
sql("confidence_summary", with_("ann") +
    """SELECT classifier_cell_type, COUNT(classifier_confidence) AS count,
              round(AVG(classifier_confidence), 3) AS mean, round(STDDEV_SAMP(classifier_confidence), 3) AS std
       FROM ann GROUP BY 1""")
sql("annotation_quality", with_("ann", lng="""
        SELECT 'rule' AS method, rule_cell_type AS cell_type, NULL::DOUBLE AS conf FROM ann
        UNION ALL SELECT 'classifier', classifier_cell_type, classifier_confidence FROM ann""",
    per="""SELECT method, COUNT(DISTINCT cell_type) AS n_cell_types, COUNT(*) AS n_cells,
                  AVG(conf) AS mean_confidence,
                  AVG(CASE WHEN conf IS NULL THEN NULL ELSE (conf > 0.7)::DOUBLE END) * 100.0 AS hc
           FROM lng GROUP BY 1""",
    dom="""SELECT method, cell_type, n FROM (
              SELECT method, cell_type, COUNT(*) AS n,
                     ROW_NUMBER() OVER (PARTITION BY method ORDER BY COUNT(*) DESC, cell_type) AS r
              FROM lng GROUP BY 1, 2) WHERE r = 1""") +
    """SELECT p.method, p.n_cell_types, p.n_cells, round(p.mean_confidence, 6) AS mean_confidence,
              round(p.hc, 6) AS high_confidence_pct, d.cell_type AS dominant_cell_type,
              round(d.n * 100.0 / p.n_cells, 6) AS dominant_pct
       FROM per p JOIN dom d USING (method)""")
sql("sparsity", with_("counts", "cells", "genes") +
    """SELECT (SELECT COUNT(*) FROM cells) AS n_cells, (SELECT COUNT(*) FROM genes) AS n_genes,
              (SELECT COUNT(*) FROM counts WHERE value <> 0) AS nnz,
              round(1.0 - (SELECT COUNT(*) FROM counts WHERE value <> 0)
                          / ((SELECT COUNT(*) FROM cells) * (SELECT COUNT(*) FROM genes)), 6) AS sparsity""")
sql("data_validation", with_("cell_qc", "genes") + """
    SELECT section, key, round(value, 6) AS value FROM (
      SELECT 'matrix' AS section, 'n_cells' AS key, (SELECT COUNT(*) FROM cells)::DOUBLE AS value
      UNION ALL SELECT 'matrix', 'n_genes', (SELECT COUNT(*) FROM genes)::DOUBLE
      UNION ALL SELECT 'matrix', 'total_counts', (SELECT SUM(value) FROM counts WHERE value <> 0)
      UNION ALL SELECT 'matrix', 'sparsity', 1.0 - (SELECT COUNT(*) FROM counts WHERE value <> 0)
                 / ((SELECT COUNT(*) FROM cells) * (SELECT COUNT(*) FROM genes))
      UNION ALL SELECT 'counts_per_cell', 'mean', AVG(total_counts) FROM cell_qc
      UNION ALL SELECT 'counts_per_cell', 'median', MEDIAN(total_counts) FROM cell_qc
      UNION ALL SELECT 'counts_per_cell', 'min', MIN(total_counts) FROM cell_qc
      UNION ALL SELECT 'counts_per_cell', 'max', MAX(total_counts) FROM cell_qc
      UNION ALL SELECT 'genes_per_cell', 'mean', AVG(n_genes_by_counts) FROM cell_qc
      UNION ALL SELECT 'genes_per_cell', 'median', MEDIAN(n_genes_by_counts)::DOUBLE FROM cell_qc
      UNION ALL SELECT 'genes_per_cell', 'min', MIN(n_genes_by_counts)::DOUBLE FROM cell_qc
      UNION ALL SELECT 'genes_per_cell', 'max', MAX(n_genes_by_counts)::DOUBLE FROM cell_qc
      UNION ALL SELECT 'sample', sample, COUNT(*)::DOUBLE FROM cell_qc GROUP BY sample
      UNION ALL SELECT 'sample_type', sample_type, COUNT(*)::DOUBLE FROM cell_qc GROUP BY sample_type
      UNION ALL SELECT 'health_status', health_status, COUNT(*)::DOUBLE FROM cell_qc GROUP BY health_status)""")
sql("before_after_report", with_("cells", "genes", "kept_cells", "kept_genes", ba="""
        SELECT 'cells' AS axis, (SELECT COUNT(*) FROM cells) AS before, (SELECT COUNT(*) FROM kept_cells) AS after
        UNION ALL SELECT 'genes', (SELECT COUNT(*) FROM genes), (SELECT COUNT(*) FROM kept_genes)""") +
    """SELECT axis, before, after, before - after AS removed,
              round(COALESCE((before - after) * 100.0 / NULLIF(before, 0), 0.0), 6) AS pct_removed FROM ba""")
sql("reference_summary", with_("ann") +
    """SELECT COUNT(*) AS total_healthy_cells, COUNT(DISTINCT sample) AS healthy_samples,
              COUNT(DISTINCT leiden) AS healthy_clusters,
              array_to_string(list_sort(list_distinct(list(rule_cell_type))), ', ') AS healthy_cell_types,
              round(AVG(total_counts), 6) AS mean_counts_per_healthy_cell,
              round(AVG(n_genes_by_counts), 6) AS mean_genes_per_healthy_cell
       FROM ann WHERE health_status = 'healthy'""")
sql("integration_summary", with_("ann") +
    """SELECT health_status, COUNT(*) AS n_cells, round(AVG(total_counts), 6) AS mean_total_counts,
              round(AVG(n_genes_by_counts), 6) AS mean_n_genes, round(AVG(pct_counts_mt), 6) AS mean_pct_mt,
              round(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM ann), 6) AS percent
       FROM ann GROUP BY 1""")
sql("group_mean_expression", with_("ln", "kept_cells", "kept_genes", lab="SELECT cell_id, sample_type AS grp FROM kept_cells",
    sz="SELECT grp, COUNT(*) AS n_cells FROM lab GROUP BY 1") +
    """SELECT sz.grp AS "group", g.gene_id, round(COALESCE(SUM(v.value), 0) / MAX(sz.n_cells), 6) AS mean_expression,
              round(COUNT(v.value) / MAX(sz.n_cells), 6) AS frac_expressing, MAX(sz.n_cells) AS n_cells
       FROM sz CROSS JOIN kept_genes g
       LEFT JOIN (SELECT l.grp, x.gene_id, x.value FROM ln x JOIN lab l USING (cell_id) WHERE x.value <> 0) v
            ON v.grp = sz.grp AND v.gene_id = g.gene_id GROUP BY 1, 2""")
sql("histogram", with_("ann", r="""SELECT CASE WHEN MIN(total_counts) = MAX(total_counts) THEN MIN(total_counts) - 0.5
                                           ELSE MIN(total_counts) END AS lo,
                                      CASE WHEN MIN(total_counts) = MAX(total_counts) THEN MAX(total_counts) + 0.5
                                           ELSE MAX(total_counts) END AS hi FROM ann""") +
    """SELECT bin, COUNT(*) AS count, round(MAX(lo + (hi - lo) * bin / 30), 6) AS lower,
              round(MAX(lo + (hi - lo) * (bin + 1) / 30), 6) AS upper
       FROM (SELECT LEAST(29, CAST(floor((total_counts - lo) * 30 / (hi - lo)) AS INTEGER)) AS bin, lo, hi
             FROM ann, r WHERE total_counts IS NOT NULL) GROUP BY 1""")
sql("box_stats", with_("ann") +
    """SELECT sample_type, COUNT(total_counts) AS n, round(MIN(total_counts), 6) AS min,
              round(quantile_cont(total_counts, 0.25), 6) AS q1, round(quantile_cont(total_counts, 0.5), 6) AS median,
              round(quantile_cont(total_counts, 0.75), 6) AS q3, round(MAX(total_counts), 6) AS max
       FROM ann GROUP BY 1""")

sql("markers_top10_flagged", with_("ln", "kept_cells", "kept_genes", **_DE_CTES,
    top="""SELECT *, COALESCE(padj < 0.999 AND logfc > 0.5, FALSE) AS significant,
                  ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS rank FROM de""") +
    f"SELECT grp AS \"group\", gene_id, {rnd('score', 'logfc', 'pval', 'padj')}, significant, rank "
    "FROM top WHERE rank <= 10")

# ----------------------------------------------- N: normalise, HVG, scaling
sql("normalize_log", with_("ln") + f"SELECT cell_id, gene_id, {rnd('value')} FROM ln")

_HVG = dict(
    hx="SELECT gene_id, exp(value) - 1 AS v FROM ln",
    hn="SELECT COUNT(*) AS n FROM kept_cells",
    hm="""SELECT g.gene_id, COUNT(x.v) AS nnz, AVG(x.v) AS mu_nz, COALESCE(VAR_SAMP(x.v), 0.0) AS var_nz,
                 COALESCE(SUM(x.v), 0.0) AS s
          FROM kept_genes g LEFT JOIN hx x USING (gene_id) GROUP BY 1""",
    hmv="""SELECT gene_id, s / n AS mean,
                  COALESCE((var_nz * (nnz - 1) + nnz * pow(mu_nz - s / n, 2) + (n - nnz) * pow(s / n, 2)) / (n - 1),
                           0.0) AS var
           FROM hm, hn""",
    hg="""SELECT gene_id, ln(1 + m1) AS means,
                 CASE WHEN var / m1 = 0 THEN NULL ELSE ln(var / m1) END AS dispersions
          FROM (SELECT *, CASE WHEN mean = 0 THEN 1e-12 ELSE mean END AS m1 FROM hmv)""",
    hr="SELECT MIN(means) AS lo, MAX(means) AS hi FROM hg",
    hb="""SELECT hg.*, CASE WHEN (hi - lo) / 20 <= 0 THEN 0
                         ELSE LEAST(19, GREATEST(0, CAST(ceil((means - lo) / ((hi - lo) / 20)) AS BIGINT) - 1))
                         END::INTEGER AS mean_bin FROM hg, hr""",
    hs="""SELECT hb.*, AVG(dispersions) OVER (PARTITION BY mean_bin) AS bm,
                 STDDEV_SAMP(dispersions) OVER (PARTITION BY mean_bin) AS bs FROM hb""",
    hz="""SELECT gene_id, means, dispersions, mean_bin,
                 (dispersions - CASE WHEN bs IS NULL THEN 0.0 ELSE bm END)
                   / CASE WHEN bs IS NULL THEN bm ELSE bs END AS dispersions_norm FROM hs""",
    hcut="""SELECT MIN(dispersions_norm) AS cut FROM (
              SELECT dispersions_norm FROM hz WHERE dispersions_norm IS NOT NULL
              ORDER BY dispersions_norm DESC LIMIT 200)""",
    hvg="SELECT hz.*, COALESCE(dispersions_norm >= cut, FALSE) AS highly_variable FROM hz, hcut",
)
sql("hvg_seurat", with_("ln", "kept_cells", "kept_genes", **_HVG) +
    f"SELECT gene_id, {rnd('means', 'dispersions')}, mean_bin, {rnd('dispersions_norm')}, highly_variable FROM hvg")


def _det3(a):
    (a11, a12, a13), (a21, a22, a23), (a31, a32, a33) = a
    return (f"({a11}*({a22}*{a33}-{a23}*{a32}) - {a12}*({a21}*{a33}-{a23}*{a31})"
            f" + {a13}*({a21}*{a32}-{a22}*{a31}))")


_M = [["s0", "s1", "s2"], ["s1", "s2", "s3"], ["s2", "s3", "s4"]]
_T = ["t0", "t1", "t2"]


def _cramer(i):
    m = [row[:] for row in _M]
    for r in range(3):
        m[r][i] = _T[r]
    return f"{_det3(m)} / {_det3(_M)}"


sql("hvg_seurat_v3", with_("c2", "kept_cells", "kept_genes",
    vn="SELECT COUNT(*) AS n FROM kept_cells",
    vm="""SELECT g.gene_id, COUNT(x.value) AS nnz, AVG(x.value) AS mu_nz, COALESCE(VAR_SAMP(x.value), 0.0) AS var_nz,
                 COALESCE(SUM(x.value), 0.0) AS s
          FROM kept_genes g LEFT JOIN c2 x USING (gene_id) GROUP BY 1""",
    vmv="""SELECT gene_id, s / n AS mean,
                  COALESCE((var_nz * (nnz - 1) + nnz * pow(mu_nz - s / n, 2) + (n - nnz) * pow(s / n, 2)) / (n - 1),
                           0.0) AS var
           FROM vm, vn""",
    lx="SELECT gene_id, log10(mean) AS x, log10(var) AS y, ROW_NUMBER() OVER (ORDER BY log10(mean), gene_id) - 1 AS p FROM vmv WHERE var > 0",
    lq="SELECT COUNT(*) AS n, GREATEST(3, CAST(floor(0.3 * COUNT(*) + 1e-5) AS BIGINT)) AS q FROM lx",
    lk="SELECT DISTINCT x AS x0 FROM lx WHERE p IN (SELECT CAST(floor(i * (n - 1) / 49.0 + 0.5) AS BIGINT) FROM lq, range(50) t(i))",
    ld="SELECT x0, x, y, abs(x - x0) AS d, ROW_NUMBER() OVER (PARTITION BY x0 ORDER BY abs(x - x0)) AS r FROM lk, lx",
    lh="SELECT x0, MAX(d) AS h FROM ld, lq WHERE r <= q GROUP BY 1",
    lw="SELECT x0, y, pow(1 - pow(d / h, 3), 3) AS w, (x - x0) / h AS u FROM ld JOIN lh USING (x0) WHERE d < h",
    vs="""SELECT x0, SUM(w) AS s0, SUM(w * u) AS s1, SUM(w * u * u) AS s2, SUM(w * u * u * u) AS s3, SUM(w * u * u * u * u) AS s4,
                 SUM(w * y) AS t0, SUM(w * u * y) AS t1, SUM(w * u * u * y) AS t2 FROM lw GROUP BY 1""",
    lf=f"SELECT x0, {_cramer(0)} AS f FROM vs",
    lp="SELECT x0 AS a, f AS fa, LEAD(x0) OVER (ORDER BY x0) AS b, LEAD(f) OVER (ORDER BY x0) AS fb FROM lf",
    lt="""SELECT gene_id, CASE WHEN b IS NULL THEN fa ELSE fa + (x - a) * (fb - fa) / (b - a) END AS trend
          FROM lx JOIN lp ON x >= a AND (b IS NULL OR x < b)""",
    vr="SELECT vmv.*, sqrt(pow(10.0, COALESCE(trend, 0.0))) AS reg_std FROM vmv LEFT JOIN lt USING (gene_id)",
    vcl="""SELECT x.gene_id, SUM(LEAST(x.value, r.reg_std * sqrt(vn.n) + r.mean)) AS s1,
                  SUM(pow(LEAST(x.value, r.reg_std * sqrt(vn.n) + r.mean), 2)) AS s2
           FROM c2 x JOIN vr r USING (gene_id), vn GROUP BY 1""",
    vnorm="""SELECT r.gene_id, r.mean AS means, r.var AS variances,
                    (1.0 / ((vn.n - 1) * pow(r.reg_std, 2)))
                      * (vn.n * pow(r.mean, 2) + COALESCE(c.s2, 0.0) - 2 * COALESCE(c.s1, 0.0) * r.mean) AS variances_norm
             FROM vr r LEFT JOIN vcl c USING (gene_id), vn""",
    vtop="""SELECT gene_id, (ROW_NUMBER() OVER (ORDER BY variances_norm DESC, gene_id) - 1)::DOUBLE AS highly_variable_rank
            FROM (SELECT * FROM vnorm ORDER BY variances_norm DESC, gene_id LIMIT 200)""") +
    f"""SELECT v.gene_id, {rnd('v.means', 'v.variances', 'v.variances_norm')}, t.highly_variable_rank,
               t.highly_variable_rank IS NOT NULL AS highly_variable
        FROM vnorm v LEFT JOIN vtop t USING (gene_id)""")

_SCALE = dict(
    sub="SELECT * FROM ln WHERE gene_id IN (SELECT gene_id FROM hvg WHERE highly_variable)",
    sm="""SELECT gene_id, COUNT(*) AS nnz, AVG(value) AS mu_nz, COALESCE(VAR_SAMP(value), 0.0) AS var_nz,
                 SUM(value) AS s FROM sub GROUP BY 1""",
    smv="""SELECT gene_id, s / n AS mean,
                  sqrt((var_nz * (nnz - 1) + nnz * pow(mu_nz - s / n, 2) + (n - nnz) * pow(s / n, 2)) / (n - 1)) AS sd
           FROM sm, hn""",
    sst="""SELECT gene_id, mean, CASE WHEN sd = 0 THEN 1.0 ELSE sd END AS std FROM smv""",
)
sql("subset_genes", with_("ln", "kept_cells", "kept_genes", **_HVG, **_SCALE) +
    f"SELECT cell_id, gene_id, {rnd('value')} FROM sub")
sql("scale", with_("ln", "kept_cells", "kept_genes", **_HVG, **_SCALE) +
    """SELECT x.cell_id, x.gene_id, round(LEAST(10.0, GREATEST(-10.0, (x.value - s.mean) / s.std)), 6) AS value
       FROM sub x JOIN sst s USING (gene_id)""")
sql("scale_gene_stats", with_("ln", "kept_cells", "kept_genes", **_HVG, **_SCALE) +
    f"""SELECT gene_id, {rnd('mean', 'std')}, round(LEAST(10.0, GREATEST(-10.0, -mean / std)), 6) AS zero_value
        FROM sst""")
sql("preprocess", with_("ln", "kept_cells", "kept_genes", **_HVG, **_SCALE) +
    """SELECT (SELECT COUNT(*) FROM kept_cells) AS n_cells, (SELECT COUNT(*) FROM kept_genes) AS n_genes,
              (SELECT COUNT(*) FROM sst) AS n_hvg, (SELECT COUNT(*) FROM sub) AS n_scaled_entries""")

# ------------------------------------------------------------- L: labels
sql("classify_cells", with_("pred") +
    f"SELECT cell_id, predicted_celltype, {rnd('confidence', 'decision')} FROM pred")
sql("majority_vote", with_("ann",
    t="SELECT leiden, classifier_cell_type AS lab, COUNT(*) AS n FROM ann GROUP BY 1, 2",
    m="""SELECT leiden, lab, n * 1.0 / SUM(n) OVER (PARTITION BY leiden) AS score,
                ROW_NUMBER() OVER (PARTITION BY leiden ORDER BY n DESC, lab) AS r FROM t""") +
    """SELECT a.cell_id, a.leiden, m.lab AS majority_label, round(m.score, 6) AS majority_label_score
       FROM ann a JOIN m ON a.leiden = m.leiden AND m.r = 1""")

_KNN = dict(
    e="SELECT vec_id AS cell_id, embedding::DOUBLE[] AS vec, CAST(label AS VARCHAR) AS label FROM embeddings",
    kd="""SELECT a.cell_id AS src, b.cell_id AS dst, list_distance(a.vec, b.vec) AS dist
          FROM e a JOIN e b ON a.cell_id <> b.cell_id""",
    kn="""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM kd)
          WHERE rank <= 15""",
)
sql("knn", with_(**_KNN) + "SELECT src, dst, round(dist, 6) AS dist, rank FROM kn")
sql("transfer_labels_knn", with_(**_KNN,
    v="SELECT k.src, e.label, COUNT(*) AS n, SUM(k.dist) AS sd FROM kn k JOIN e ON e.cell_id = k.dst GROUP BY 1, 2",
    vr="""SELECT *, SUM(n) OVER (PARTITION BY src) AS tot,
                 ROW_NUMBER() OVER (PARTITION BY src ORDER BY n DESC, sd, label) AS r FROM v""") +
    "SELECT src AS cell_id, label AS predicted_celltype, round(n * 1.0 / tot, 6) AS score FROM vr WHERE r = 1")
sql("transfer_labels_corr", with_("ln", "kept_cells", "kept_genes", "clf_gm",
    types="SELECT DISTINCT sample_type AS type FROM kept_cells",
    prof="""SELECT t.type, g.gene_id, COALESCE(gm.w, 0.0) AS m
            FROM types t CROSS JOIN kept_genes g LEFT JOIN clf_gm gm ON gm.type = t.type AND gm.gene_id = g.gene_id""",
    pr="""SELECT type, gene_id, RANK() OVER (PARTITION BY type ORDER BY m)
                 + (COUNT(*) OVER (PARTITION BY type, m) - 1) / 2.0 AS rt FROM prof""",
    dense="""SELECT c.cell_id, g.gene_id, COALESCE(x.value, 0.0) AS v
             FROM kept_cells c CROSS JOIN kept_genes g
             LEFT JOIN ln x ON x.cell_id = c.cell_id AND x.gene_id = g.gene_id""",
    rc="""SELECT cell_id, gene_id, RANK() OVER (PARTITION BY cell_id ORDER BY v)
                 + (COUNT(*) OVER (PARTITION BY cell_id, v) - 1) / 2.0 AS rc FROM dense""",
    cr="SELECT r.cell_id, p.type, corr(r.rc, p.rt) AS c FROM rc r JOIN pr p USING (gene_id) GROUP BY 1, 2",
    best="""SELECT *, ROW_NUMBER() OVER (PARTITION BY cell_id ORDER BY c DESC NULLS LAST, type) AS r FROM cr""") +
    "SELECT cell_id, type AS predicted_celltype, round(c, 6) AS score FROM best WHERE r = 1")

_RULE = """CASE WHEN health_status = 'healthy' THEN
                CASE WHEN sample IN ('0','1') THEN 'B cells' WHEN sample IN ('2','3') THEN 'T cells'
                     ELSE 'Monocytes' END
           ELSE CASE WHEN sample IN ('0','1') THEN 'Leukemic B cells'
                     WHEN sample IN ('2','3') THEN 'Leukemic T cells' ELSE 'Leukemic blasts' END END"""
sql("first_available", with_("cells", "pred") +
    f"""SELECT c.cell_id, COALESCE(p.predicted_celltype, {_RULE}) AS celltype,
               CASE WHEN p.predicted_celltype IS NOT NULL THEN 'classifier' ELSE 'rule' END AS method
        FROM cells c LEFT JOIN pred p USING (cell_id)""")
sql("rule_labels", with_("cells") + f"SELECT cell_id, {_RULE} AS rule_cell_type FROM cells")
sql("compare_labels", with_("ann",
    t="SELECT sample_type AS a, classifier_cell_type AS b, COUNT(*)::DOUBLE AS n FROM ann GROUP BY 1, 2",
    ra="SELECT a, SUM(n) AS na FROM t GROUP BY 1",
    cb="SELECT b, SUM(n) AS nb FROM t GROUP BY 1",
    s="SELECT SUM(n) AS nn, SUM(n * n) AS ss FROM t",
    sa="SELECT SUM(na * na) AS sa2, COUNT(*) AS ka, SUM(-na * ln(na)) AS ha FROM ra",
    sb="SELECT SUM(nb * nb) AS sb2, COUNT(*) AS kb, SUM(-nb * ln(nb)) AS hb FROM cb",
    mi="SELECT SUM(t.n * ln(t.n / (ra.na * cb.nb))) AS mi FROM t JOIN ra USING (a) JOIN cb USING (b)",
    pc="""SELECT *, ss - nn AS tp, sb2 - ss AS fp, sa2 - ss AS fn, nn * nn - (sb2 - ss) - (sa2 - ss) - ss AS tn,
                 ln(nn) + ha / nn AS h_a, ln(nn) + hb / nn AS h_b, mi / nn + ln(nn) AS mi_v
          FROM s, sa, sb, mi""") +
    """SELECT round(CASE WHEN fn = 0 AND fp = 0 THEN 1.0
                         ELSE 2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)) END, 6) AS ari,
              round(CASE WHEN ka = 1 AND kb = 1 THEN 1.0 WHEN abs(mi_v) < 1e-15 THEN 0.0
                         ELSE mi_v / ((h_a + h_b) / 2.0) END, 6) AS nmi,
              nn::BIGINT AS n_cells, ka AS n_labels_a, kb AS n_labels_b FROM pc""")
_METHODS = ["sample_type", "region", "rule_cell_type", "classifier_cell_type"]
sql("compare_all_labels", with_("ann",
    t=" UNION ALL ".join(f"SELECT '{x}' AS method1, '{y}' AS method2, {x} AS a, {y} AS b, COUNT(*)::DOUBLE AS n FROM ann GROUP BY ALL"
                         for i, x in enumerate(_METHODS) for y in _METHODS[i + 1:]),
    ra="SELECT method1, method2, a, SUM(n) AS na FROM t GROUP BY ALL",
    cb="SELECT method1, method2, b, SUM(n) AS nb FROM t GROUP BY ALL",
    # pairs of cells: together in both, in the first, in the second, all
    pr="""SELECT method1, method2, (SELECT SUM(n * (n - 1) / 2) FROM t WHERE t.method1 = m.method1 AND t.method2 = m.method2) AS joint,
                 (SELECT SUM(na * (na - 1) / 2) FROM ra WHERE ra.method1 = m.method1 AND ra.method2 = m.method2) AS pa,
                 (SELECT SUM(nb * (nb - 1) / 2) FROM cb WHERE cb.method1 = m.method1 AND cb.method2 = m.method2) AS pb,
                 (SELECT SUM(n) FROM t WHERE t.method1 = m.method1 AND t.method2 = m.method2) AS nn
          FROM (SELECT DISTINCT method1, method2 FROM t) m""",
    ent="""SELECT method1, method2, SUM(n / nn * ln(n * nn / (na * nb))) AS mi FROM t JOIN ra USING (method1, method2, a)
           JOIN cb USING (method1, method2, b) JOIN pr USING (method1, method2) GROUP BY ALL""",
    ha="SELECT method1, method2, -SUM(na / nn * ln(na / nn)) AS ha FROM ra JOIN pr USING (method1, method2) GROUP BY ALL",
    hb="SELECT method1, method2, -SUM(nb / nn * ln(nb / nn)) AS hb FROM cb JOIN pr USING (method1, method2) GROUP BY ALL") +
    """SELECT method1, method2, nn::BIGINT AS n_cells,
              round((joint - pa * pb / (nn * (nn - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (nn * (nn - 1) / 2)), 6) AS ari,
              round(mi / ((ha + hb) / 2), 6) AS nmi
       FROM pr JOIN ent USING (method1, method2) JOIN ha USING (method1, method2) JOIN hb USING (method1, method2)""")
sql("per_type_accuracy", with_("ann",
    labs="SELECT sample_type AS label FROM ann UNION SELECT classifier_cell_type FROM ann",
    per="""SELECT sample_type AS label, COUNT(*) AS n_manual,
                  COUNT_IF(sample_type = classifier_cell_type) AS n_agree FROM ann GROUP BY 1""") +
    """SELECT l.label, COALESCE(p.n_manual, 0) AS n_manual, COALESCE(p.n_agree, 0) AS n_agree,
              round(COALESCE(p.n_agree * 1.0 / NULLIF(p.n_manual, 0), 0.0), 6) AS accuracy
       FROM labs l LEFT JOIN per p USING (label)""")
sql("confidence_filter", with_("ann") +
    f"SELECT cell_id, classifier_cell_type, {rnd('classifier_confidence')} FROM ann WHERE classifier_confidence > 0.7")

# -------------------------------------------------- R: reference comparison
sql("abnormal_clusters_ratio", with_("ann") + """
    SELECT leiden, total_cells, healthy_cells, leukemia_cells, sample_types, cell_types,
           round(healthy_cells * 1.0 / total_cells, 6) AS healthy_ratio,
           round(leukemia_cells * 1.0 / total_cells, 6) AS leukemia_ratio,
           leukemia_cells * 1.0 / total_cells > 0.8 AS is_abnormal,
           round(leukemia_cells * 1.0 / total_cells, 6) AS abnormality_score
    FROM (SELECT leiden, COUNT(*) AS total_cells, COUNT_IF(health_status = 'healthy') AS healthy_cells,
                 COUNT_IF(health_status = 'leukemia') AS leukemia_cells,
                 array_to_string(list_sort(list_distinct(list(sample_type))), ', ') AS sample_types,
                 array_to_string(list_sort(list_distinct(list(rule_cell_type))), ', ') AS cell_types
          FROM ann GROUP BY 1)""")
_R2 = dict(
    r2b="""SELECT leiden, COUNT(*) AS total_cells, COUNT_IF(health_status = 'leukemia') AS leukemia_cells
           FROM ann GROUP BY 1""",
    r2d="""SELECT leiden, sample_type FROM (
             SELECT leiden, sample_type, ROW_NUMBER() OVER (PARTITION BY leiden ORDER BY COUNT(*) DESC, sample_type) AS r
             FROM ann GROUP BY 1, 2) WHERE r = 1""",
    r2="""SELECT b.leiden, b.total_cells, b.leukemia_cells, b.leukemia_cells * 100.0 / b.total_cells AS leukemia_percentage,
                 d.sample_type AS dominant_sample_type, b.leukemia_cells * 100.0 / b.total_cells / 100.0 AS abnormality_score
          FROM r2b b LEFT JOIN r2d d USING (leiden) WHERE b.leukemia_cells * 100.0 / b.total_cells > 50""",
)
sql("abnormal_clusters_percent", with_("ann", **_R2) +
    f"SELECT leiden, total_cells, leukemia_cells, {rnd('leukemia_percentage')}, dominant_sample_type, "
    f"{rnd('abnormality_score')} FROM r2")
sql("abnormal_clusters_with_types", with_("ann", **_R2,
    r3d="""SELECT leiden, lab, n FROM (
             SELECT leiden, classifier_cell_type AS lab, COUNT(*) AS n,
                    ROW_NUMBER() OVER (PARTITION BY leiden ORDER BY COUNT(*) DESC, classifier_cell_type) AS r
             FROM ann GROUP BY 1, 2) WHERE r = 1""") +
    f"""SELECT r2.leiden, total_cells, leukemia_cells, {rnd('leukemia_percentage')}, dominant_sample_type,
               {rnd('abnormality_score')}, d.lab AS dominant_cell_type,
               round(d.n * 100.0 / total_cells, 6) AS dominant_cell_type_pct
        FROM r2 LEFT JOIN r3d d USING (leiden)""")
sql("cluster_composition", with_("ann",
    t="SELECT leiden, classifier_cell_type AS lab, COUNT(*) AS n FROM ann GROUP BY 1, 2",
    r="SELECT *, ROW_NUMBER() OVER (PARTITION BY leiden ORDER BY n DESC, lab) AS rr FROM t",
    two="SELECT list_sort(list_distinct(list(classifier_cell_type)))[1:2] AS a FROM ann",
    per="""SELECT leiden, SUM(n)::BIGINT AS total_cells, COUNT(*) AS n_cell_types,
                  MAX(CASE WHEN rr = 1 THEN lab END) AS dom, MAX(CASE WHEN rr = 1 THEN n END) AS dom_n,
                  MAX(CASE WHEN rr = 2 THEN lab END) AS sec, MAX(CASE WHEN rr = 2 THEN n END) AS sec_n
           FROM r GROUP BY 1""") +
    """SELECT leiden, total_cells, n_cell_types, dom AS dominant_cell_type, dom_n AS dominant_count,
              COALESCE(sec, CASE WHEN len(a) < 2 THEN 'None' WHEN dom = a[1] THEN a[2] ELSE a[1] END) AS second_cell_type,
              COALESCE(sec_n, 0) AS second_count, round(dom_n * 100.0 / total_cells, 6) AS dominant_pct,
              round(COALESCE(sec_n, 0) * 100.0 / total_cells, 6) AS second_pct, 'classifier' AS method
       FROM per, two""")
sql("composition_by_sample", with_("ann") +
    """SELECT sample_type, rule_cell_type, count,
              round(count * 100.0 / SUM(count) OVER (PARTITION BY sample_type), 6) AS pct
       FROM (""" + _zero_filled("sample_type", "rule_cell_type") + ")")

# ------------------------------------------------ D: differential expression
_pair_de = wilcoxon_ctes("ln", "pair_lab", "kept_genes", strata="st")
sql("rank_genes_vs_reference", with_("ln", "ann", "kept_genes",
    abn="""SELECT leiden FROM ann GROUP BY 1
           HAVING COUNT_IF(health_status = 'leukemia') * 1.0 / COUNT(*) > 0.8""",
    pair_lab="""SELECT a.cell_id, a.leiden AS st, 'test' AS grp FROM ann a WHERE a.leiden IN (SELECT leiden FROM abn)
                UNION ALL
                SELECT a.cell_id, b.leiden AS st, 'ref' AS grp FROM ann a CROSS JOIN abn b
                WHERE a.health_status = 'healthy' AND a.leiden IS DISTINCT FROM b.leiden""",
    **_pair_de) +
    f"""SELECT st AS "group", gene_id, {rnd('score', 'logfc', 'pval', 'padj')},
               COALESCE(padj < 0.999 AND logfc > 0.5, FALSE) AS significant
        FROM de WHERE grp = 'test'""")
_within_de = wilcoxon_ctes("ln", "in_lab", "kept_genes", strata="st")
sql("rank_genes_within", with_("ln", "ann", "kept_genes", **_R2,
    ok="""SELECT leiden FROM ann WHERE leiden IN (SELECT leiden FROM r2) GROUP BY 1
          HAVING COUNT_IF(health_status = 'healthy') > 10""",
    in_lab="SELECT cell_id, leiden AS st, health_status AS grp FROM ann WHERE leiden IN (SELECT leiden FROM ok)",
    **_within_de) +
    f"""SELECT st AS leiden, grp AS "group", gene_id, {rnd('score', 'logfc', 'pval', 'padj')},
               COALESCE(padj < 0.999 AND abs(logfc) > 0.5, FALSE) AS significant
        FROM de WHERE grp = 'leukemia'""")
sql("subtype_markers", with_("ln", "kept_cells", "kept_genes", "genes", **_DE_CTES,
    sm="""SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS rank
          FROM de WHERE grp LIKE '%AUTO%' AND padj < 0.999 AND logfc > 0.5""") +
    """SELECT sm.grp AS Cluster, COALESCE(g.gene_symbol, CAST(sm.gene_id AS VARCHAR)) AS Gene,
              round(logfc, 6) AS Log2_FC, round(padj, 6) AS Adj_P_Value, round(score, 6) AS Score, rank
       FROM sm LEFT JOIN genes g USING (gene_id) WHERE rank <= 10""")
sql("volcano", with_("ln", "kept_cells", "kept_genes", **_DE_CTES) +
    """SELECT grp AS "group", gene_id, round(logfc, 6) AS logfc, round(padj, 6) AS padj,
              round(-log10(CASE WHEN padj = 0 THEN 1e-300 ELSE padj END), 6) AS neg_log10_padj,
              CASE WHEN padj < 0.999 AND logfc > 0.5 THEN 'up' WHEN padj < 0.999 AND logfc < -0.5 THEN 'down'
                   ELSE 'none' END AS regulation
       FROM de WHERE logfc IS NOT NULL AND padj IS NOT NULL AND NOT isinf(logfc) AND NOT isinf(padj)
                 AND NOT isnan(logfc) AND NOT isnan(padj)""")
sql("de_summary", with_("ln", "kept_cells", "kept_genes", **_DE_CTES,
    r5="SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS r FROM de") +
    """SELECT grp AS "group", COUNT(*) AS n_genes_tested, COUNT_IF(padj < 0.999 AND logfc > 0.5) AS n_significant,
              string_agg(CASE WHEN r <= 5 THEN CAST(gene_id AS VARCHAR) END, ',' ORDER BY r) AS top_genes
       FROM r5 GROUP BY 1""")

# ------------------------------------------------------ E: enrichment, drugs


def _lc(n, k):
    return f"(lgamma(({n}) + 1) - lgamma(({k}) + 1) - lgamma(({n}) - ({k}) + 1))"


def _ora_sql(query_cte: str, sets_sql: str, keys: list[str]) -> dict:
    kl = ", ".join(keys)
    kq = ", ".join(f"s.{k}" for k in keys)
    return dict(
        univ="SELECT DISTINCT gene_id FROM de",
        nu="SELECT COUNT(*) AS nn FROM univ",
        qq=f"SELECT grp, gene_id FROM {query_cte} WHERE gene_id IN (SELECT gene_id FROM univ)",
        ss=f"SELECT * FROM ({sets_sql}) WHERE gene_id IN (SELECT gene_id FROM univ)",
        tsz=f"SELECT {kl}, COUNT(*) AS term_size FROM ss GROUP BY ALL",
        qn="SELECT grp, COUNT(*) AS query_size FROM qq GROUP BY 1",
        ov=f"""SELECT q.grp, {kq}, COUNT(*) AS overlap,
                      string_agg(CAST(q.gene_id AS VARCHAR), ',' ORDER BY q.gene_id) AS overlap_genes
               FROM qq q JOIN ss s USING (gene_id) GROUP BY ALL""",
        tt=f"SELECT ov.*, term_size, query_size FROM ov JOIN tsz USING ({kl}) JOIN qn USING (grp)",
        tl=f"""SELECT grp, {kl}, SUM(exp({_lc('term_size', 'x')} + {_lc('nn - term_size', 'query_size - x')}
                                         - {_lc('nn', 'query_size')})) AS p
               FROM (SELECT tt.*, unnest(generate_series(overlap, LEAST(term_size, query_size))) AS x FROM tt), nu
               GROUP BY ALL""",
        oo=f"""SELECT tt.*, LEAST(1.0, tl.p) AS p_value,
                      overlap * (nn - term_size - query_size + overlap)
                        / NULLIF((term_size - overlap) * (query_size - overlap), 0)::DOUBLE AS odds_ratio
               FROM tt JOIN tl USING (grp, {kl}), nu""",
        ob=f"""SELECT *, p_value * COUNT(*) OVER (PARTITION BY grp)
                          / ROW_NUMBER() OVER (PARTITION BY grp ORDER BY p_value, {kl}) AS bh_raw,
                      ROW_NUMBER() OVER (PARTITION BY grp ORDER BY p_value, {kl}) AS bh_rank FROM oo""",
        ora=f"""SELECT *, LEAST(1.0, MIN(bh_raw) OVER (PARTITION BY grp ORDER BY bh_rank DESC
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS adj_p_value FROM ob""",
    )


_SETS = """SELECT 'TYPE' AS library, p_type AS term, p_partkey AS gene_id FROM part
           UNION ALL SELECT 'BRAND', p_brand, p_partkey FROM part"""
_DRUGS = "SELECT DISTINCT l_suppkey AS drug, l_partkey AS gene_id FROM lineitem"
sql("enrich", with_("ln", "kept_cells", "kept_genes", **_DE_CTES,
    top="""SELECT grp, gene_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS r
                                   FROM de WHERE grp <> 'Unknown') WHERE r <= 100""",
    **_ora_sql("top", _SETS, ["library", "term"])) +
    f"""SELECT grp AS "group", library, term, overlap, overlap_genes, term_size, query_size,
               {rnd('p_value', 'adj_p_value', 'odds_ratio')} FROM ora""")
_UP50 = """SELECT grp, gene_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS r
                                   FROM de WHERE grp <> 'Unknown' AND logfc > 0) WHERE r <= 50"""
sql("rank_drugs", with_("ln", "kept_cells", "kept_genes", **_DE_CTES, top=_UP50,
                        **_ora_sql("top", _DRUGS, ["drug"])) +
    f"""SELECT grp AS "group", drug, overlap, overlap_genes, term_size, query_size,
               {rnd('p_value', 'adj_p_value', 'odds_ratio')} FROM ora""")
sql("drug_associations", with_("ln", "kept_cells", "kept_genes", **_DE_CTES, top=_UP50,
                               **_ora_sql("top", _DRUGS, ["drug"]),
    g10="""SELECT grp, string_agg(CAST(gene_id AS VARCHAR), ',' ORDER BY r) AS top_genes FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS r
             FROM de WHERE grp <> 'Unknown') WHERE r <= 10 GROUP BY 1""",
    d3="""SELECT grp, string_agg(CAST(drug AS VARCHAR), ',' ORDER BY r) AS potential_drugs FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY p_value, drug) AS r FROM ora) WHERE r <= 3
          GROUP BY 1""") +
    """SELECT g.grp AS "group", g.top_genes, COALESCE(d.potential_drugs, '') AS potential_drugs
       FROM g10 g LEFT JOIN d3 d USING (grp)""")

# ------------------------------------------------------------------ G: graph
sql("modularity", with_(**_KNN,
    g="""SELECT src, dst, SUM(w) AS weight FROM (SELECT src, dst, 1.0 AS w FROM kn
                                             UNION ALL SELECT dst, src, 1.0 FROM kn) GROUP BY 1, 2""",
    per="""SELECT la.label AS c, SUM(CASE WHEN la.label = lb.label THEN weight ELSE 0.0 END) AS inw, SUM(weight) AS tot
           FROM g JOIN e la ON la.cell_id = g.src JOIN e lb ON lb.cell_id = g.dst GROUP BY 1""",
    m2="SELECT SUM(weight) AS m2 FROM g") +
    "SELECT round(SUM(inw / m2 - 1.0 * pow(tot / m2, 2)), 6) AS modularity FROM per, m2")
sql("group_connectivity", with_(**_KNN,
    ee="SELECT la.label AS ga, lb.label AS gb FROM kn JOIN e la ON la.cell_id = kn.src JOIN e lb ON lb.cell_id = kn.dst",
    es="SELECT ga AS g, COUNT(*) AS es FROM ee GROUP BY 1",
    ns="SELECT label AS g, COUNT(*) AS n FROM e GROUP BY 1",
    nt="SELECT COUNT(*) AS n FROM e",
    inter="""SELECT LEAST(ga, gb) AS group_a, GREATEST(ga, gb) AS group_b, COUNT(*) AS n_edges
             FROM ee WHERE ga <> gb GROUP BY 1, 2""",
    ga="SELECT g, COALESCE(es.es, 0) AS es, COALESCE(ns.n, 0) AS n FROM es FULL OUTER JOIN ns USING (g)",
    x="""SELECT i.group_a, i.group_b, i.n_edges, (a.es * b.n + b.es * a.n) * 1.0 / (nt.n - 1) AS expected
         FROM inter i JOIN ga a ON a.g = i.group_a JOIN ga b ON b.g = i.group_b, nt""") +
    """SELECT group_a, group_b, n_edges, round(expected, 6) AS expected,
              round(CASE WHEN expected = 0 THEN 1.0 ELSE LEAST(1.0, n_edges / expected) END, 6) AS connectivity
       FROM x""")

# the bisection as a fold over 64 steps; a step halves the bracket or, without an upper end, doubles
_STEP = "list_sum(list_transform(ds, lambda d: CASE WHEN d - rho > 0 THEN exp(-(d - rho) / st.mid) ELSE 1.0 END))"
_UMAP = dict(
    cn="SELECT src, dst, dist FROM kn WHERE rank <= 14",
    cp="""SELECT src, list(dist ORDER BY dist) AS ds, COALESCE(MIN(dist) FILTER (dist > 0), 0.0) AS rho,
                 log2(COUNT(*) + 1) AS target, SUM(dist) / (COUNT(*) + 1) AS mean_i FROM cn GROUP BY 1""",
    cf=f"""SELECT *, list_reduce(list_transform(range(65), lambda i: {{'lo': 0.0::DOUBLE, 'hi': 'inf'::DOUBLE, 'mid': 1.0::DOUBLE, 'done': FALSE}}),
             lambda st, x: CASE WHEN st.done THEN st
               WHEN abs({_STEP} - target) < 1e-5 THEN {{'lo': st.lo, 'hi': st.hi, 'mid': st.mid, 'done': TRUE}}
               WHEN {_STEP} > target THEN {{'lo': st.lo, 'hi': st.mid, 'mid': (st.lo + st.mid) / 2, 'done': FALSE}}
               WHEN st.hi = 'inf'::DOUBLE THEN {{'lo': st.mid, 'hi': st.hi, 'mid': st.mid * 2, 'done': FALSE}}
               ELSE {{'lo': st.mid, 'hi': st.hi, 'mid': (st.mid + st.hi) / 2, 'done': FALSE}} END).mid AS found FROM cp""",
    cs="""SELECT src, rho, GREATEST(found, 1e-3 * CASE WHEN rho > 0 THEN mean_i ELSE (SELECT AVG(dist) FROM cn) END) AS sigma FROM cf""",
    cw="SELECT src, dst, CASE WHEN dist <= rho OR sigma = 0 THEN 1.0 ELSE exp(-(dist - rho) / sigma) END AS w FROM cn JOIN cs USING (src)",
    cg="""SELECT COALESCE(a.src, b.dst) AS src, COALESCE(a.dst, b.src) AS dst,
                 COALESCE(a.w, 0) + COALESCE(b.w, 0) - COALESCE(a.w, 0) * COALESCE(b.w, 0) AS weight
          FROM cw a FULL JOIN cw b ON a.src = b.dst AND a.dst = b.src""",
)
sql("connectivities", with_(**_KNN, **_UMAP) + f"SELECT src, dst, {rnd('weight')} FROM cg")
