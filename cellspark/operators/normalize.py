"""Normalisation, variable-gene selection and scaling.

Layers stay sparse: only nonzero entries are stored, and every formula that
needs the zeros (means, variances, scaling) adds their contribution in
closed form instead of densifying the matrix.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .numbering import number_rows
from .qc import _n_rows


def normalize_total(counts: DataFrame, target_sum: float = 1e4) -> DataFrame:
    """value * target_sum / cell total.  The cell total is a window sum over
    one cell's rows (at most one row per gene), so no join is needed and the
    counts are read once.  Cells with a zero total have no rows."""
    w = Window.partitionBy("cell_id")
    return (counts.withColumn("_tot", F.sum("value").over(w))
            .withColumn("value", F.col("value") * F.lit(float(target_sum)) / F.col("_tot"))
            .drop("_tot"))


def log1p_layer(counts: DataFrame) -> DataFrame:
    """ln(1 + value); zeros stay zeros, so the sparse layout is kept."""
    return counts.withColumn("value", F.log1p("value"))


def lognorm(counts: DataFrame, target_sum: float = 1e4) -> DataFrame:
    """N1 then N2: the ``lognorm`` layer used by DE and HVG selection."""
    return log1p_layer(normalize_total(counts, target_sum))


def gene_moments(layer: DataFrame, n_cells, value=None) -> DataFrame:
    """Per gene: mean and sample variance (ddof 1) over ALL ``n_cells``
    cells, zeros included, from the nonzero entries only.

    var = (M2_nz + n_nz (mu_nz - mu)^2 + n_0 mu^2) / (N - 1) with
    M2_nz = var_samp_nz * (n_nz - 1); Spark's var_samp is the stable
    streaming estimate and partial-aggregates map-side.
    """
    v = value if value is not None else F.col("value")
    n = n_cells if not isinstance(n_cells, (int, float)) else F.lit(n_cells)
    g = layer.groupBy("gene_id").agg(
        F.count(F.lit(1)).alias("_nnz"), F.avg(v).alias("_mu_nz"),
        F.coalesce(F.var_samp(v), F.lit(0.0)).alias("_var_nz"), F.sum(v).alias("_sum"))
    mu = F.col("_sum") / n
    m2 = (F.col("_var_nz") * (F.col("_nnz") - 1)
          + F.col("_nnz") * F.pow(F.col("_mu_nz") - mu, 2)
          + (n - F.col("_nnz")) * F.pow(mu, 2))
    return g.select("gene_id", F.col("_nnz").alias("n_cells_nz"), mu.alias("mean"),
                    (m2 / (n - 1)).alias("var"))


def highly_variable_genes(layer: DataFrame, cells: DataFrame, genes: DataFrame | None = None,
                          n_top_genes: int = 2000, n_bins: int = 20) -> DataFrame:
    """flavor='seurat' on a log layer.

    x = expm1(value); mean and var (ddof 1) over all cells; dispersion =
    ln(var / mean) (null when var is 0); means = log1p(mean); 20 equal-width,
    right-closed bins of ``means``; dispersions_norm = (disp - bin mean) /
    bin std (ddof 1), a bin with one gene gives 1.  The top ``n_top_genes``
    by dispersions_norm are variable; ties at the cut-off are kept.

    Returns one row per gene: gene_id, means, dispersions, mean_bin,
    dispersions_norm, highly_variable.  Genes absent from ``layer`` but in
    ``genes`` get mean 0.
    """
    n = _n_rows(cells)
    mom = gene_moments(layer, n, F.expm1("value"))
    if genes is not None:
        mom = (genes.select("gene_id").join(mom, "gene_id", "left")
               .fillna({"mean": 0.0, "var": 0.0, "n_cells_nz": 0}))
    mean = F.when(F.col("mean") == 0, F.lit(1e-12)).otherwise(F.col("mean"))
    disp = F.col("var") / mean
    g = mom.select("gene_id",
                   F.log1p(mean).alias("means"),
                   F.when(disp == 0, F.lit(None).cast("double")).otherwise(F.log(disp)).alias("dispersions"))
    rng = g.agg(F.min("means").alias("lo"), F.max("means").alias("hi"))
    # the scalar subquery carries the global range to every gene without a join
    r = rng.select(F.struct("lo", "hi")).scalar()
    width = (r["hi"] - r["lo"]) / n_bins
    bin_ = F.when(width <= 0, F.lit(0)).otherwise(
        F.least(F.lit(n_bins - 1),
                F.greatest(F.lit(0), (F.ceil((F.col("means") - r["lo"]) / width) - 1).cast("int"))))
    g = g.withColumn("mean_bin", bin_)
    stats = g.groupBy("mean_bin").agg(F.avg("dispersions").alias("_bm"), F.stddev_samp("dispersions").alias("_bs"))  # n_bins rows
    g = g.join(F.broadcast(stats), "mean_bin")
    one = F.col("_bs").isNull()
    g = g.withColumn("dispersions_norm",
                     (F.col("dispersions") - F.when(one, F.lit(0.0)).otherwise(F.col("_bm")))
                     / F.when(one, F.col("_bm")).otherwise(F.col("_bs"))).select("gene_id", "means", "dispersions", "mean_bin", "dispersions_norm")
    return _flag_top(g, "dispersions_norm", n_top_genes, "highly_variable")


def _flag_top(g: DataFrame, score: str, n: int, flag: str) -> DataFrame:
    """Flag rows whose ``score`` is >= the n-th highest non-null score.

    The cut-off comes from a distributed top-n (each partition keeps n rows,
    the merge sees partitions * n); no window over all genes.
    """
    top = g.where(F.col(score).isNotNull()).select(score).orderBy(F.col(score).desc()).limit(n)
    cut = top.agg(F.min(score)).scalar()
    return g.withColumn(flag, F.coalesce(F.col(score) >= cut, F.lit(False)))


def loess(rows: DataFrame, span: float = 0.3, knots: int = 50) -> DataFrame:
    """``rows`` (gene_id, x, y) with ``trend``: local quadratic regression of y on x.

    At a knot x0 the regression is weighted by (1 - (d / h)^3)^3, d the distance to x0 and
    h that of the ``span`` n-th nearest row; between knots, which stand at equal
    steps of the sorted x, the trend is linear.  Where the neighbourhood does not
    determine a parabola it is the weighted mean."""
    numbered = number_rows(rows.select("gene_id", "x", "y"), [F.col("x"), F.col("gene_id")], "_p")
    n = numbered.count()
    if not n:
        return rows.withColumn("trend", F.lit(None).cast("double"))
    q = max(3, math.floor(span * n + 1e-5))
    places = sorted({math.floor(i * (n - 1) / (knots - 1) + 0.5) for i in range(knots)})
    at = numbered.where(F.col("_p").isin(places)).agg(F.array_sort(F.collect_set("x"))).scalar()  # a value per knot
    each = numbered.withColumn("_at", at).select("x", "y", F.explode("_at").alias("x0")).withColumn("d", F.abs(F.col("x") - F.col("x0")))
    nearest = Window.partitionBy("x0").orderBy("d")  # a knot's genes
    wide = each.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= q).groupBy("x0").agg(F.max("d").alias("h"))
    near = each.join(F.broadcast(wide), "x0").where("d < h OR d = 0")  # a row per knot
    w = F.when(F.col("h") > 0, F.pow(1 - F.pow(F.col("d") / F.col("h"), 3), 3)).otherwise(F.lit(1.0))
    u = F.when(F.col("h") > 0, (F.col("x") - F.col("x0")) / F.col("h")).otherwise(F.lit(0.0))
    near = near.select("x0", "y", w.alias("w"), u.alias("u"))
    sums = near.groupBy("x0").agg(*[F.sum(F.col("w") * F.pow("u", F.lit(i))).alias(f"s{i}") for i in range(5)],
                                  *[F.sum(F.col("w") * F.pow("u", F.lit(i)) * F.col("y")).alias(f"t{i}") for i in range(3)])
    s0, s1, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"))
    det = _det3(s0, s1, s2, s1, s2, s3, s2, s3, s4)
    fit = F.when(det > 1e-9 * F.pow(s0, 3), F.try_divide(_det3(t0, s1, s2, t1, s2, s3, t2, s3, s4), det)).otherwise(t0 / s0)
    curve = sums.agg(F.array_sort(F.collect_list(F.struct(F.col("x0").alias("x"), fit.alias("f"))))).scalar()
    placed = rows.withColumn("_curve", curve).withColumn("_below", F.filter("_curve", lambda k: k["x"] <= F.col("x")))
    lo, hi = F.element_at("_below", -1), F.get("_curve", F.size("_below"))
    line = lo["f"] + (F.col("x") - lo["x"]) * (hi["f"] - lo["f"]) / (hi["x"] - lo["x"])
    return placed.withColumn("trend", F.when(hi.isNull(), lo["f"]).otherwise(line)).drop("_curve", "_below")


def _det3(a11, a12, a13, a21, a22, a23, a31, a32, a33):
    return (a11 * (a22 * a33 - a23 * a32) - a12 * (a21 * a33 - a23 * a31)
            + a13 * (a21 * a32 - a22 * a31))


def highly_variable_genes_v3(counts: DataFrame, cells: DataFrame, genes: DataFrame | None = None,
                             n_top_genes: int = 2000, span: float = 0.3) -> DataFrame:
    """flavor='seurat_v3' on raw counts.

    mean / var (ddof 1) per gene; a trend of log10 var on log10 mean is fitted over the
    non-constant genes by local regression (:func:`loess`); each count is
    standardised by the trend's sd and clipped at sqrt(N) sds; the variance of the
    clipped standardised values ranks the genes.

    Returns gene_id, means, variances, variances_norm, highly_variable,
    highly_variable_rank (0-based among selected, null otherwise).
    """
    from ..plans.pipeline import materialize
    n = _n_rows(cells)
    mom = gene_moments(counts, n)
    if genes is not None:
        mom = (genes.select("gene_id").join(mom, "gene_id", "left")
               .fillna({"mean": 0.0, "var": 0.0, "n_cells_nz": 0}))
    mom = materialize(mom)
    trend = loess(mom.where("var > 0").select("gene_id", F.log10("mean").alias("x"), F.log10("var").alias("y")), span)
    mom = mom.join(trend.select("gene_id", "trend"), "gene_id", "left")
    est = F.coalesce("trend", F.lit(0.0))
    g = mom.withColumn("reg_std", F.sqrt(F.pow(F.lit(10.0), est)))
    g = g.withColumn("clip_val", F.col("reg_std") * F.sqrt(n.cast("double")) + F.col("mean"))
    clipped = (counts.join(g.select("gene_id", "clip_val"), "gene_id")
               .select("gene_id", F.least("value", "clip_val").alias("v"))
               .groupBy("gene_id").agg(F.sum("v").alias("_s1"), F.sum(F.col("v") * F.col("v")).alias("_s2")))
    g = g.join(clipped, "gene_id", "left").fillna({"_s1": 0.0, "_s2": 0.0})
    norm = ((F.lit(1.0) / ((n - 1) * F.pow(F.col("reg_std"), 2)))
            * (n * F.pow(F.col("mean"), 2) + F.col("_s2") - 2 * F.col("_s1") * F.col("mean")))
    g = g.select("gene_id", F.col("mean").alias("means"), F.col("var").alias("variances"),
                 norm.alias("variances_norm"))
    by = [F.col("variances_norm").desc(), F.col("gene_id")]
    top = number_rows(g.orderBy(*by).limit(n_top_genes), by, "highly_variable_rank").select("gene_id", F.col("highly_variable_rank").cast("double"))
    return (g.join(top, "gene_id", "left")
            .withColumn("highly_variable", F.col("highly_variable_rank").isNotNull()))


def subset_genes(layer: DataFrame, hvg: DataFrame, flag: str = "highly_variable") -> DataFrame:
    """Keep entries of flagged genes (semi join; the planner broadcasts the
    flagged set when its measured size is under the broadcast threshold)."""
    return layer.join(hvg.where(F.col(flag)).select("gene_id"), "gene_id", "left_semi")


def scale(layer: DataFrame, cells: DataFrame, max_value: float | None = 10.0):
    """Per gene (x - mean) / std (ddof 1, std 0 -> 1), clipped to
    [-max_value, max_value] (both sides; older scanpy clipped the top only).

    Returns ``(scaled, gene_stats)``.  ``scaled`` holds the scaled values of
    the stored (nonzero) entries; an absent entry of gene g has the value
    ``gene_stats.zero_value`` = clip(-mean/std).  Nothing is densified.
    """
    n = _n_rows(cells)
    mom = gene_moments(layer, n)
    std = F.sqrt("var")
    stats = mom.select("gene_id", "mean", F.when(std == 0, F.lit(1.0)).otherwise(std).alias("std"))

    def clip(c):
        if max_value is None:
            return c
        return F.least(F.lit(float(max_value)), F.greatest(F.lit(-float(max_value)), c))
    stats = stats.withColumn("zero_value", clip(-F.col("mean") / F.col("std")))
    scaled = (layer.join(stats.select("gene_id", "mean", "std"), "gene_id")
              .select("cell_id", "gene_id", clip((F.col("value") - F.col("mean")) / F.col("std")).alias("value")))
    return scaled, stats


def dense_vectors(scaled: DataFrame, gene_stats: DataFrame, cells: DataFrame | None = None,
                  max_genes: int = 5000) -> DataFrame:
    """(cell_id, vec ARRAY<DOUBLE>) over the genes of ``gene_stats`` in
    gene_id order, filling absent entries with each gene's ``zero_value``;
    with ``cells`` every listed cell gets a vector, even with no entry.

    Only for small gene panels (HVGs): the number of genes is checked
    against ``max_genes`` before a per-cell array of that length is built.
    A cell's entries are grouped per cell, at most one per gene.  The entries are
    written once, as they are stored: whoever reads the vectors several times fills
    them in row by row and repeats neither the grouping nor what came before it.
    """
    from ..plans.pipeline import materialize
    idx = materialize(gene_stats.select("gene_id", "zero_value").withColumn(
        "idx", (F.row_number().over(Window.orderBy("gene_id")) - 1).cast("int")))
    rows = idx.orderBy("idx").limit(max_genes + 1).collect()
    if len(rows) > max_genes:
        raise ValueError(f"more than max_genes={max_genes} genes for dense vectors")
    # the panel's zero values are model parameters of bounded length: a literal
    zeros = F.array(*[F.lit(float(r["zero_value"])) for r in rows])
    per_cell = (scaled.join(idx.select("gene_id", "idx"), "gene_id")
                .groupBy("cell_id").agg(F.map_from_entries(F.collect_list(F.struct("idx", "value"))).alias("_m")))
    vec = F.transform(zeros, lambda z, i: F.coalesce(F.element_at(F.col("_m"), i), z))
    if cells is not None:
        per_cell = cells.select("cell_id").join(per_cell, "cell_id", "left")
    return materialize(per_cell).select("cell_id", vec.alias("vec"))
