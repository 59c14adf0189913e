"""Differential expression: Wilcoxon rank-sum markers.

The rank-sum test is computed on the sparse layer without densifying:

* the n0 = N - nnz zeros of a gene share the average rank (n0 + 1) / 2;
* a nonzero value v has average rank n0 + #(nonzeros < v) + (#(== v) + 1) / 2;
* the rank sum of a group is the sum of its nonzero ranks plus
  zeros_in_group * (n0 + 1) / 2.

Scale design.  Entries are first collapsed to (gene, value, group) -> n with
map-side partial aggregation, so ties (integer counts) cost one row.  The
cumulative counts that give ranks are then computed per (gene, value-range
bucket) window plus a per-bucket offset, so a gene expressed in every cell
is split across many tasks instead of one sorted partition -- the result is
exact because equal values always fall in the same bucket.  Output rows are
(stratum, group, gene); groups are a table that is joined, never a list in the plan.

Comparisons with one reference side (D2) share one ledger: the reference cells'
counts run along each gene's values once, and what a group's own reference cells
add is subtracted from the same rows, so no reference cell is copied per group.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import bh_adjust, norm_sf_two_sided
from ..plans.pipeline import by_count, materialize
from .numbering import number_rows
from .qc import _n_rows

DE_COLUMNS = ["group", "gene_id", "score", "logfc", "pval", "padj"]


def _bucket(value_col, width: float):
    return F.floor(F.col(value_col) / F.lit(float(width))).cast("long")


def rank_sums(layer: DataFrame, labels: DataFrame, group_col: str = "group",
              strata: list[str] | None = None, bucket_width: float = 0.05) -> DataFrame:
    """Per (strata, gene, group): nonzero rank sum, nonzero count and value sum.

    ``labels`` has cell_id, ``group_col`` and the strata columns; ranks are
    taken over all cells of a stratum.  Returns strata + gene_id, group,
    r_nz, nnz, vsum, and per gene of the stratum nnz_gene.
    """
    strata = strata or []
    lab = labels.select("cell_id", *strata, F.col(group_col).alias("group"))
    x = layer.join(by_count(lab), "cell_id").where(F.col("value") != 0)
    key = [*strata, "gene_id"]
    agg = materialize(x.groupBy(*key, "value", "group").agg(F.count(F.lit(1)).alias("n"))
                      .withColumn("_b", _bucket("value", bucket_width)))  # offsets and ranks read it
    # offsets of the value-range buckets inside each gene: a few rows per gene
    bt = agg.groupBy(*key, "_b").agg(F.sum("n").alias("_bn"))
    wg = Window.partitionBy(*key)
    bt = (bt.withColumn("_off", F.coalesce(F.sum("_bn").over(
              wg.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("nnz_gene", F.sum("_bn").over(wg))
            .drop("_bn"))
    wb = Window.partitionBy(*key, "_b").orderBy("value").rangeBetween(Window.unboundedPreceding, 0)
    wv = Window.partitionBy(*key, "_b", "value")
    ranked = (agg.withColumn("_le", F.sum("n").over(wb))
                 .withColumn("_at", F.sum("n").over(wv))
                 .join(bt, [*key, "_b"]))
    return (ranked.withColumn("_r_in_nz", F.col("_off") + F.col("_le") - F.col("_at")
                              + (F.col("_at") + F.lit(1)) / F.lit(2.0))
            .groupBy(*key, "group")
            .agg(F.sum(F.col("_r_in_nz") * F.col("n")).alias("r_nz_local"),
                 F.sum("n").alias("nnz"), F.sum(F.col("value") * F.col("n")).alias("vsum"),
                 F.first("nnz_gene").alias("nnz_gene")))


def _grid(universe: DataFrame, pairs: DataFrame, names: list[str]) -> DataFrame:
    """Every gene with every row of ``pairs`` (the output's rows), by an equi-join on the
    numbers of the pairs.  No pairs: ValueError."""
    pairs = materialize(number_rows(pairs, [F.col(c) for c in names], "_no"))
    n = pairs.count()
    if not n:
        raise ValueError("no group with a non-empty comparison side")
    return universe.select("gene_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("_no")).join(pairs, "_no").drop("_no")


def rank_genes(layer: DataFrame, labels: DataFrame, group_col: str, genes: DataFrame | None = None,
               groups: list[str] | None = None, reference: str = "rest",
               strata: list[str] | None = None, bucket_width: float = 0.05) -> DataFrame:
    """Wilcoxon rank-sum per (group, gene) on a log-normalised layer.

    reference='rest': each group against all other cells (of its stratum).
    reference=<group>: see :func:`rank_genes_vs`.
    z = (R1 - n1 (N+1)/2) / sqrt(n1 n2 (N+1) / 12) (no tie correction),
    pval = 2 sf(|z|), padj = Benjamini-Hochberg per (stratum, group),
    logfc = log2((expm1(mean1) + 1e-9) / (expm1(mean2) + 1e-9)) with means
    over all cells of each side, zeros included.

    ``genes`` (gene_id) fixes the tested universe; default: genes present
    in ``layer``.  Cells in ``labels`` with a null group are dropped.
    Returns strata + group, gene_id, score, logfc, pval, padj.
    """
    if reference != "rest":
        if strata:
            raise ValueError("reference=<group> cannot be combined with strata")
        return rank_genes_vs(layer, labels, group_col, groups, reference, genes, bucket_width)
    strata = strata or []
    labels = labels.where(F.col(group_col).isNotNull())
    sizes = labels.groupBy(*strata, F.col(group_col).alias("group")).agg(F.count(F.lit(1)).alias("n1"))
    if strata:
        pairs = sizes.join(labels.groupBy(*strata).agg(F.count(F.lit(1)).alias("n2")), strata)
    else:
        pairs = sizes.withColumn("n2", _n_rows(labels))
    pairs = pairs.withColumn("n2", F.col("n2") - F.col("n1")).where("n2 > 0")
    if groups is not None:
        pairs = pairs.where(F.col("group").isin(*groups))
    sums = rank_sums(layer, labels, group_col, strata, bucket_width)
    key = [*strata, "gene_id"]
    # one row per (stratum, gene): its group statistics as a map (an entry per
    # group) and gene totals, so ``sums`` is consumed once
    per_gene = sums.groupBy(*key).agg(
        F.first("nnz_gene").alias("nnz_gene"), F.sum("vsum").alias("vsum_gene"),
        F.map_from_entries(F.collect_list(F.struct(
            "group", F.struct("r_nz_local", "nnz", "vsum")))).alias("_m"))
    universe = (genes.select("gene_id") if genes is not None
                else layer.join(labels.select("cell_id"), "cell_id", "left_semi").select("gene_id").distinct())
    grid = _grid(universe, pairs, [*strata, "group"])
    st = F.element_at(F.col("_m"), F.col("group"))
    df = (grid.join(per_gene, key, "left")
              .select(*key, "group", "n1", "n2",
                      F.coalesce("nnz_gene", F.lit(0)).alias("nnz_gene"),
                      F.coalesce("vsum_gene", F.lit(0.0)).alias("vsum_gene"),
                      F.coalesce(st["r_nz_local"], F.lit(0.0)).alias("r_nz_local"),
                      F.coalesce(st["nnz"], F.lit(0)).alias("nnz"),
                      F.coalesce(st["vsum"], F.lit(0.0)).alias("vsum")))
    n = F.col("n1") + F.col("n2")
    n0 = n - F.col("nnz_gene")
    # nonzero ranks were taken among the nonzeros: shift each by the n0 zeros
    r1 = (F.col("r_nz_local") + F.col("nnz") * n0
          + (F.col("n1") - F.col("nnz")) * (n0 + 1) / 2.0)
    mean1 = F.col("vsum") / F.col("n1")
    mean2 = (F.col("vsum_gene") - F.col("vsum")) / F.col("n2")
    # products of group sizes exceed 32 bits beyond ~10^4 cells: use doubles
    n1d, n2d = F.col("n1").cast("double"), F.col("n2").cast("double")
    z = (r1 - n1d * (n + 1) / 2.0) / F.sqrt(n1d * n2d * (n + 1) / 12.0)
    logfc = F.log2((F.expm1(mean1) + F.lit(1e-9)) / (F.expm1(mean2) + F.lit(1e-9)))
    out = df.select(*strata, "group", "gene_id", z.alias("score"), logfc.alias("logfc"))
    out = out.withColumn("pval", norm_sf_two_sided("score"))
    return bh_adjust(out, "pval", [*strata, "group"], "padj", order_cols=["gene_id"])


def rank_against(layer: DataFrame, sides: DataFrame, genes: DataFrame | None = None, bucket_width: float = 0.05) -> DataFrame:
    """Each tested group against the reference cells outside it, for all groups at once.

    ``sides`` (cell_id, group, is_test, is_ref): a cell of a tested group is on its group's
    side only, whether it is a reference cell or not; the other side are the reference
    cells that are not in the group.  With U the number of pairs (group cell, reference
    cell) in which the reference cell is lower, ties halved, the rank sum of a group
    is n1 (n1 + 1) / 2 + U.  U over all reference cells comes from running counts per
    gene, U over the group's own from running counts per gene and group, and their
    difference is taken row by row of one table (gene, value, group).
    Returns group and the DE columns."""
    sides = sides.where("is_test OR is_ref")
    x = layer.join(by_count(sides), "cell_id").where(F.col("value") != 0)
    entries = materialize(x.groupBy("gene_id", "value", "group").agg(F.count_if("is_test").alias("t"), F.count_if("is_ref").alias("h"))
                          .withColumn("_b", _bucket("value", bucket_width)))

    def offsets(key):
        """Reference counts in the lower value ranges of a key: a few rows per key."""
        w = Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        return (entries.groupBy(*key, "_b").agg(F.sum("h").alias("_h")).select(*key, "_b", F.coalesce(F.sum("_h").over(w), F.lit(0)).alias("_off")))

    every = Window.partitionBy("gene_id", "_b").orderBy("value").rangeBetween(Window.unboundedPreceding, 0)
    equal = Window.partitionBy("gene_id", "_b", "value")
    own = Window.partitionBy("gene_id", "_b", "group").orderBy("value").rangeBetween(Window.unboundedPreceding, 0)
    ledger = (entries.withColumn("_le", F.sum("h").over(every)).withColumn("_at", F.sum("h").over(equal)).withColumn("_own_le", F.sum("h").over(own))
              .where("t > 0")
              .join(offsets(["gene_id"]).withColumnRenamed("_off", "_all_off"), ["gene_id", "_b"])
              .join(offsets(["gene_id", "group"]), ["gene_id", "group", "_b"]))
    # reference cells outside the group that are lower, and half of those that are equal
    lower = (F.col("_all_off") + F.col("_le") - F.col("_at")) - (F.col("_off") + F.col("_own_le") - F.col("h"))
    u = ledger.groupBy("gene_id", "group").agg(F.sum(F.col("t") * (lower + (F.col("_at") - F.col("h")) / 2.0)).alias("u"))
    per_group = entries.groupBy("gene_id", "group").agg(F.sum("t").alias("nnz"), F.sum(F.col("value") * F.col("t")).alias("vsum"),
                                                       F.sum("h").alias("h_nnz"), F.sum(F.col("value") * F.col("h")).alias("h_vsum"))
    per_gene = per_group.groupBy("gene_id").agg(F.sum("h_nnz").alias("all_nnz"), F.sum("h_vsum").alias("all_vsum"))
    sizes = sides.where("is_test").groupBy("group").agg(F.count(F.lit(1)).alias("n1"), F.count_if("is_ref").alias("own"))
    pairs = sizes.withColumn("n2", _n_rows(sides.where("is_ref")) - F.col("own")).where("n2 > 0")
    universe = genes.select("gene_id") if genes is not None else layer.select("gene_id").distinct()
    df = (_grid(universe, pairs, ["group"]).join(per_gene, "gene_id", "left").join(per_group, ["gene_id", "group"], "left")
          .join(u, ["gene_id", "group"], "left").fillna(0, ["nnz", "vsum", "h_nnz", "h_vsum", "all_nnz", "all_vsum", "u"]))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    zeros = F.col("n2") - (F.col("all_nnz") - F.col("h_nnz"))  # of the other side: lower than every entry, equal to every zero
    total = F.col("u") + F.col("nnz") * zeros + (F.col("n1") - F.col("nnz")) * zeros / 2.0
    z = (total - n1 * n2 / 2.0) / F.sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0)
    mean1, mean2 = F.col("vsum") / n1, (F.col("all_vsum") - F.col("h_vsum")) / n2
    logfc = F.log2((F.expm1(mean1) + F.lit(1e-9)) / (F.expm1(mean2) + F.lit(1e-9)))
    out = df.select("group", "gene_id", z.alias("score"), logfc.alias("logfc")).withColumn("pval", norm_sf_two_sided("score"))
    return bh_adjust(out, "pval", ["group"], "padj", order_cols=["gene_id"])


def rank_genes_vs(layer: DataFrame, labels: DataFrame, group_col: str, groups: list[str] | None,
                  reference: str, genes: DataFrame | None = None, bucket_width: float = 0.05) -> DataFrame:
    """Each tested group against the ``reference`` group only (ranks
    over the two groups' cells).  ``groups`` None = every other group."""
    is_ref = F.col(group_col) == reference
    is_test = ~is_ref if groups is None else F.col(group_col).isin(*groups) & ~is_ref
    sides = labels.where(F.col(group_col).isNotNull()).select("cell_id", F.col(group_col).alias("group"), is_test.alias("is_test"), is_ref.alias("is_ref"))
    return rank_against(layer, sides, genes, bucket_width)


def rank_clusters_vs_healthy(layer: DataFrame, cells: DataFrame, cluster_col: str, clusters,
                             status_col: str = "health_status", healthy: str = "healthy",
                             genes: DataFrame | None = None, bucket_width: float = 0.05) -> DataFrame:
    """D2 as used for abnormal clusters: each cluster of ``clusters`` (a list, or a table
    with ``cluster_col``) against the healthy cells outside it.  A healthy cell of the
    cluster is on the cluster side only (disjoint sides; the reference duplicated it,
    defect D-3)."""
    cl = F.col(cluster_col).cast("string")
    sides = cells.select("cell_id", cl.alias("group"), F.coalesce(F.col(status_col) == healthy, F.lit(False)).alias("is_ref"))
    if isinstance(clusters, DataFrame):
        tested = clusters.select(cl.alias("group"), F.lit(True).alias("is_test")).distinct()
        sides = sides.join(tested, "group", "left").fillna(False, ["is_test"])
    else:
        names = [str(c) for c in clusters]
        sides = sides.withColumn("is_test", F.coalesce(F.col("group").isin(*names), F.lit(False)) if names else F.lit(False))
    return rank_against(layer, sides.select("cell_id", "group", "is_test", "is_ref"), genes, bucket_width)


def rank_genes_within(layer: DataFrame, labels: DataFrame, cluster_col: str, group_col: str,
                      target: str = "leukemia", other: str = "healthy", min_other: int = 10,
                      clusters: DataFrame | None = None, genes: DataFrame | None = None,
                      bucket_width: float = 0.05) -> DataFrame:
    """D3: inside each cluster, ``target`` vs the rest of the cluster, only
    for clusters with more than ``min_other`` cells of ``other``.  One job
    for all clusters: the cluster is a stratum of the rank windows."""
    lab = labels.where(F.col(cluster_col).isNotNull() & F.col(group_col).isNotNull())
    if clusters is not None:
        lab = lab.join(clusters.select(cluster_col), cluster_col, "left_semi")
    enough = (lab.groupBy(cluster_col).agg(F.count_if(F.col(group_col) == other).alias("_n_other"))
              .where(F.col("_n_other") > min_other).select(cluster_col))
    lab = lab.join(enough, cluster_col, "left_semi").select("cell_id", cluster_col, group_col)
    out = rank_genes(layer, lab, group_col, genes=genes, groups=[target], strata=[cluster_col],
                     bucket_width=bucket_width)
    return out


def significant(de: DataFrame, padj: float = 0.05, logfc: float = 0.5, two_sided: bool = False,
                flag: str | None = None) -> DataFrame:
    """Padj < padj and logfc > logfc (or |logfc| > logfc).  With ``flag``
    a boolean column is added instead of filtering."""
    lf = F.abs(F.col("logfc")) if two_sided else F.col("logfc")
    cond = (F.col("padj") < padj) & (lf > logfc)
    if flag:
        return de.withColumn(flag, F.coalesce(cond, F.lit(False)))
    return de.where(cond)


def top_markers(de: DataFrame, n: int = 10, by: list[str] | None = None, score: str = "score") -> DataFrame:
    """Top ``n`` per group by score desc (gene_id breaks ties), with a
    1-based ``rank`` column.  A window partition holds one group's genes."""
    by = by or ["group"]
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col("gene_id"))
    return de.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def subtype_markers(de: DataFrame, pattern: str, padj: float = 0.01, logfc: float = 1.0,
                    n: int = 10, genes: DataFrame | None = None) -> DataFrame:
    """Groups whose name contains ``pattern``; padj < 0.01, logfc > 1.0;
    first ``n`` by score.  Columns Cluster, Gene, Log2_FC, Adj_P_Value, Score
    (+ rank).  Group-vs-rest, as in the reference (defect D-4)."""
    d = de.where(F.col("group").contains(pattern))
    d = significant(d, padj, logfc)
    d = top_markers(d, n)
    gene = F.col("gene_id").cast("string")
    if genes is not None:
        d = d.join(genes.select("gene_id", "gene_symbol"), "gene_id", "left")
        gene = F.coalesce(F.col("gene_symbol"), F.col("gene_id").cast("string"))
    return d.select(F.col("group").alias("Cluster"), gene.alias("Gene"), F.col("logfc").alias("Log2_FC"),
                    F.col("padj").alias("Adj_P_Value"), F.col("score").alias("Score"), "rank")


def volcano(de: DataFrame, padj: float = 0.05, logfc: float = 0.5) -> DataFrame:
    """Drop null / infinite logfc or padj; neg_log10_padj with 0 -> 1e-300;
    regulation up / down / none at padj < 0.05 and |logfc| > 0.5."""
    inf = [float("inf"), float("-inf")]
    d = de.where(F.col("logfc").isNotNull() & F.col("padj").isNotNull()
                 & ~F.col("logfc").isin(*inf) & ~F.col("padj").isin(*inf)
                 & ~F.isnan("logfc") & ~F.isnan("padj"))
    p = F.when(F.col("padj") == 0, F.lit(1e-300)).otherwise(F.col("padj"))
    sig = F.col("padj") < padj
    reg = (F.when(sig & (F.col("logfc") > logfc), "up")
           .when(sig & (F.col("logfc") < -logfc), "down").otherwise("none"))
    return d.withColumn("neg_log10_padj", -F.log10(p)).withColumn("regulation", reg)


def de_summary(de: DataFrame, padj: float = 0.05, logfc: float = 0.5, n_top: int = 5,
               by: list[str] | None = None) -> DataFrame:
    """Per group genes tested, significant count and the top 5 genes by
    score (array, score order).  ``collect_list`` only over the top 5 rows."""
    by = by or ["group"]
    cond = (F.col("padj") < padj) & (F.col("logfc") > logfc)
    counts = de.groupBy(*by).agg(F.count(F.lit(1)).alias("n_genes_tested"),
                                 F.count_if(cond).alias("n_significant"))
    top = (top_markers(de, n_top, by).groupBy(*by)
           .agg(F.array_sort(F.collect_list(F.struct("rank", "gene_id"))).alias("_t")))
    return (counts.join(top, by, "left")
            .select(*by, "n_genes_tested", "n_significant",
                    F.transform("_t", lambda s: s["gene_id"]).alias("top_genes")))


def existing_markers(de: DataFrame, genes: DataFrame, n: int = 20, per_group: int = 5) -> DataFrame:
    """Distinct top genes (top ``per_group`` of each group) that exist in
    the gene table, best ``n`` by their best score (gene_id tiebreak)."""
    top = top_markers(de, per_group)
    best = (top.groupBy("gene_id").agg(F.max("score").alias("best_score"))
            .join(genes.select("gene_id"), "gene_id", "left_semi"))
    return best.orderBy(F.col("best_score").desc(), F.col("gene_id")).limit(n)


def group_means(layer: DataFrame, labels: DataFrame, group_col: str, genes: DataFrame | None = None) -> DataFrame:
    """Per (group, gene) mean over all cells of the group (zeros
    included) and fraction of cells expressing.  Group sizes come from the
    label table, never from avg(value).  With ``genes`` every group has every
    gene, unexpressed ones with 0; without, pairs that are 0 are left out (the
    sparse form that linear models use)."""
    lab = labels.where(F.col(group_col).isNotNull()).select("cell_id", F.col(group_col).alias("group"))
    sizes = lab.groupBy("group").agg(F.count(F.lit(1)).alias("n_cells"))
    s = (layer.where(F.col("value") != 0).join(lab, "cell_id")
         .groupBy("group", "gene_id").agg(F.sum("value").alias("_s"), F.count(F.lit(1)).alias("_nz")))
    if genes is not None:
        groups = sizes.agg(F.sort_array(F.collect_set("group"))).scalar()
        grid = genes.select("gene_id").distinct().withColumn("group", F.explode(groups))
        s = grid.join(s, ["group", "gene_id"], "left").fillna({"_s": 0.0, "_nz": 0})
    return (s.join(sizes, "group")
            .select("group", "gene_id", (F.col("_s") / F.col("n_cells")).alias("mean_expression"),
                    (F.col("_nz") / F.col("n_cells")).alias("frac_expressing"), "n_cells"))
