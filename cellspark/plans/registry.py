"""Registered queries: one per operator of the inventory, each reading the
driver's tables at ``sf_dir`` through the stand-in model.

Doubles are rounded to ``DIGITS`` places so that results compare with the
SQL oracle despite summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import de as DE
from ..operators import normalize as NZ
from ..operators import qc as QC
from . import pipeline as PL
from . import standin as SI
from .oracle import DIGITS

P = SI.STANDIN_PARAMS
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _bundle(spark: SparkSession, sf_dir: str) -> SI.Bundle:
    """The stand-in bundle with ``counts`` materialised (the loaded matrix)."""
    b = SI.standin_bundle(spark, sf_dir)
    return b.with_counts(PL.materialize(b.counts))


def _prep(spark: SparkSession, sf_dir: str, write: bool = True):
    """Stand-in bundle after P5 (min_genes 20, mitochondrial cut), P6 (min_cells
    3), N1, N2.  ``write`` materialises the layers, for queries that read them
    more than once; without it nothing is written or run."""
    b = _bundle(spark, sf_dir) if write else SI.standin_bundle(spark, sf_dir)
    f = PL.filter_and_normalize(b.counts, b.cells, b.genes, min_genes=P["min_genes"],
                                min_cells=P["min_cells"], max_pct_mt=P["max_pct_mt"], checkpoint=write)
    return b, f.cells, f.genes, f.counts, f.lognorm


@register("markers_top10")
def q_markers_top10(spark, sf_dir):
    """Flagship (script C): top 10 significant markers per market segment."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    de = DE.rank_genes(ln, kept_cells, "sample_type", genes=kept_genes.select("gene_id"))
    top = DE.top_markers(DE.significant(de, P["padj"], 0.5), 10)
    return rounded(top.select("group", "gene_id", "score", "logfc", "pval", "padj", "rank"))


@register("markers_top10_flagged")
def q_markers_top10_flagged(spark, sf_dir):
    """D1 + D4 + D6 + D5 (flag variant): top 10 genes per segment by score
    with ``significant`` = padj < 0.05 and logfc > 0.5."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    de = DE.rank_genes(ln, kept_cells, "sample_type", genes=kept_genes.select("gene_id"))
    top = DE.top_markers(DE.significant(de, P["padj"], 0.5, flag="significant"), 10)
    return rounded(top.select("group", "gene_id", "score", "logfc", "pval", "padj", "significant", "rank"))


@register("rank_genes_groups")
def q_rank_genes_groups(spark, sf_dir):
    """D1 + D4: Wilcoxon group-vs-rest for every (segment, gene), BH-adjusted."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    de = DE.rank_genes(ln, kept_cells, "sample_type", genes=kept_genes.select("gene_id"))
    return rounded(de.select("group", "gene_id", "score", "logfc", "pval", "padj"))


# ------------------------------------------------------------------ shared

from ..operators import aggregates as AG  # noqa: E402
from ..operators import cleaning as CL  # noqa: E402
from ..operators import enrich as EN  # noqa: E402
from ..operators import graph as GR  # noqa: E402
from ..operators import joins as JN  # noqa: E402
from ..operators import labels as LB  # noqa: E402
from ..operators import reference as RF  # noqa: E402

ANN_COLS = ["cell_id", "sample", "sample_type", "health_status", "region", "leiden",
            "n_genes_by_counts", "total_counts", "pct_counts_mt", "rule_cell_type",
            "classifier_cell_type", "classifier_confidence"]


def _classifier(ln, kept_cells):
    """L1 on the stand-in: nearest-centroid model of the segments."""
    coef, icpt = LB.centroid_model(ln, kept_cells, "sample_type")
    return LB.classify_cells(ln, kept_cells, coef, icpt, prob="softmax")


def _ann(spark, sf_dir):
    """Kept cells with a cluster column (leiden = nation), the rule labels
    (L6) and the classifier's label and confidence (L1)."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    pred = _classifier(ln, kept_cells)
    ann = (kept_cells.withColumn("leiden", F.col("sample"))
           .withColumn("rule_cell_type", LB.rule_labels("leiden", "health_status"))
           .join(pred.select("cell_id", F.col("predicted_celltype").alias("classifier_cell_type"),
                             F.col("confidence").alias("classifier_confidence")), "cell_id"))
    return PL.materialize(ann.select(*ANN_COLS)), (b, kept_cells, kept_genes, c2, ln)


def _de(spark, sf_dir):
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    de = DE.rank_genes(ln, kept_cells, "sample_type", genes=kept_genes.select("gene_id"))
    return PL.materialize(de), (b, kept_cells, kept_genes, c2, ln)


def _str_array(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# ------------------------------------------------------- P: filters, cleaning

@register("filter_cells")
def q_filter_cells(spark, sf_dir):
    """P5: cells with >= 20 genes (stand-in threshold), with their QC."""
    _, kept_cells, _, _, _ = _prep(spark, sf_dir, write=False)
    return rounded(kept_cells.select("cell_id", "n_genes_by_counts", "total_counts", "pct_counts_mt"))


@register("filter_genes")
def q_filter_genes(spark, sf_dir):
    """Genes in >= 3 of the kept cells."""
    _, _, kept_genes, _, _ = _prep(spark, sf_dir, write=False)
    return kept_genes.select("gene_id", "n_cells")


SEGMENT_RULES = (("AUTO", "ETV6-RUNX1"), ("BUILD", "PBMMC"), ("FURN", "HHD"), ("HOUSE", "PRE-T"))


@register("sample_type_rules")
def q_sample_type_rules(spark, sf_dir):
    """P1 + P2: subtype by name prefix (rule list as a parameter: segment
    prefixes stand for sample names) and the derived health status."""
    c = SI.read_table(spark, sf_dir, "customer")
    st = CL.sample_type_of("c_mktsegment", SEGMENT_RULES)
    return (c.select(F.col("c_custkey").alias("cell_id"), st.alias("subtype"))
            .withColumn("status", CL.health_status_of("subtype")))


@register("fill_required")
def q_fill_required(spark, sf_dir):
    """A cell table without ``sample`` gets it as 'unknown'."""
    c = SI.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("sample_type"))
    return CL.fill_required(c)


@register("make_unique")
def q_make_unique(spark, sf_dir):
    """Gene symbols (p_name, 64 distinct) made unique in gene order."""
    g = SI.standin_genes(spark, sf_dir)
    return CL.make_unique(g, "gene_symbol", "gene_id", "unique_symbol").select("gene_id", "gene_symbol", "unique_symbol")


@register("drop_null_labels")
def q_drop_null_labels(spark, sf_dir):
    """All cells with the classifier label (null for filtered cells),
    null labels dropped."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    pred = _classifier(ln, kept_cells)
    allc = b.cells.join(pred.select("cell_id", "predicted_celltype"), "cell_id", "left")
    return CL.drop_null_labels(allc, "predicted_celltype").select("cell_id", "predicted_celltype")


@register("subset_genes")
def q_subset_genes(spark, sf_dir):
    """The log layer restricted to the 200 HVGs."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    hvg = NZ.highly_variable_genes(ln, kept_cells, kept_genes.select("gene_id"), P["n_top_genes"])
    return rounded(NZ.subset_genes(ln, hvg))


@register("subset_cells")
def q_subset_cells(spark, sf_dir):
    """Counts of healthy cells."""
    b = SI.standin_bundle(spark, sf_dir)
    counts, _ = CL.subset_cells(b.counts, b.cells, F.col("health_status") == "healthy")
    return rounded(counts)


@register("map_symbols")
def q_map_symbols(spark, sf_dir):
    """Numeric ids -> GENE_%04d placeholders (no mapping table)."""
    g = SI.standin_genes(spark, sf_dir)
    return CL.map_symbols(g, None).select("gene_id", "mapped_symbol")


@register("diagnostics")
def q_diagnostics(spark, sf_dir):
    """Defect report of the log-normalised layer."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir, write=False)
    return rounded(QC.diagnostics(ln, kept_cells, kept_genes))


# ----------------------------------------------------------------- J: joins

@register("concat_samples")
def q_concat_samples(spark, sf_dir):
    """Healthy and leukemia halves concatenated with sample-keyed ids."""
    b = SI.standin_bundle(spark, sf_dir)
    parts = []
    for status in ("healthy", "leukemia"):
        cells = b.cells.where(F.col("health_status") == status)
        counts = b.counts.join(cells.select("cell_id"), "cell_id", "left_semi")
        parts.append((counts, cells, b.genes))
    counts, cells, genes = JN.concat_samples(parts, key_cells_by_sample=True)
    return rounded(counts)


@register("align_with_reference")
def q_align_with_reference(spark, sf_dir):
    """Leukemia cells as query, healthy as reference, flagged."""
    b = SI.standin_bundle(spark, sf_dir)
    side = lambda s: (b.counts.join(b.cells.where(F.col("health_status") == s).select("cell_id"), "cell_id",
                                    "left_semi"), b.cells.where(F.col("health_status") == s), b.genes)
    _, cells, _ = JN.align_with_reference(side("leukemia"), side("healthy"))
    return cells.select("cell_id", "health_status", "is_reference")


@register("attach_labels")
def q_attach_labels(spark, sf_dir):
    """Every cell gets the classifier label, 'Unknown'/0 when filtered."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    pred = _classifier(ln, kept_cells)
    out = JN.attach_labels(b.cells, pred, "predicted_celltype", "confidence")
    return rounded(out.select("cell_id", "predicted_celltype", "confidence"))


@register("existing_markers")
def q_existing_markers(spark, sf_dir):
    """Best 20 of the per-segment top-5 genes present in the genes table."""
    de, (b, *_r) = _de(spark, sf_dir)
    return rounded(DE.existing_markers(de, b.genes, 20, 5))


# ------------------------------------------------------------ A: aggregates

@register("qc_cells")
def q_qc_cells(spark, sf_dir):
    """A1: per-cell QC metrics for every cell (zeros for empty cells)."""
    b = SI.standin_bundle(spark, sf_dir)
    q = QC.qc_cells(b.counts, b.cells, b.genes)
    return rounded(q.select("cell_id", "n_genes_by_counts", "total_counts", "log1p_n_genes_by_counts",
                            "log1p_total_counts", *[f"pct_counts_in_top_{n}_genes" for n in QC.PERCENT_TOP],
                            "total_counts_mt", "pct_counts_mt"))


@register("qc_genes")
def q_qc_genes(spark, sf_dir):
    """A2: per-gene QC metrics for every gene."""
    b = SI.standin_bundle(spark, sf_dir)
    q = QC.qc_genes(b.counts, b.genes, b.cells)
    return rounded(q.select("gene_id", "n_cells_by_counts", "total_counts", "mean_counts", "log1p_mean_counts",
                            "pct_dropout_by_counts", "log1p_total_counts"))


@register("pct_mt")
def q_pct_mt(spark, sf_dir):
    """A3: percent of counts in the 'mito' genes (Brand#1 parts)."""
    b = SI.standin_bundle(spark, sf_dir)
    return rounded(QC.pct_mt(b.counts, b.genes, b.cells))


@register("crosstab_counts")
def q_crosstab_counts(spark, sf_dir):
    """A4: rule label x health status counts."""
    ann, _ = _ann(spark, sf_dir)
    return AG.crosstab(ann, "rule_cell_type", "health_status")


@register("crosstab_index")
def q_crosstab_index(spark, sf_dir):
    """A4 normalize='index': cluster x rule label, percent of the cluster."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.crosstab(ann, "leiden", "rule_cell_type", "index"))


@register("crosstab_columns")
def q_crosstab_columns(spark, sf_dir):
    """A4 normalize='columns': classifier label x segment, percent of segment."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.crosstab(ann, "classifier_cell_type", "sample_type", "columns"))


@register("crosstab_wide")
def q_crosstab_wide(spark, sf_dir):
    """A4 as a zero-filled matrix: classifier label x region."""
    ann, _ = _ann(spark, sf_dir)
    return AG.crosstab_wide(ann, "classifier_cell_type", "region")


@register("cell_types_by_condition")
def q_cell_types_by_condition(spark, sf_dir):
    """A5: rule labels by health status with totals and row percents."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.cell_types_by_condition(ann, "rule_cell_type", "health_status", ["healthy", "leukemia"]))


@register("value_counts")
def q_value_counts(spark, sf_dir):
    """Classifier label counts and percent."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.value_counts(ann, "classifier_cell_type"))


@register("describe_metrics")
def q_describe_metrics(spark, sf_dir):
    """Mean / std / min / max / median of counts and genes per cell."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.describe_metrics(ann, ["total_counts", "n_genes_by_counts"]))


@register("confidence_summary")
def q_confidence_summary(spark, sf_dir):
    """Per predicted type count / mean / std of confidence (3 places)."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.confidence_summary(ann, "classifier_cell_type", "classifier_confidence"))


@register("annotation_quality")
def q_annotation_quality(spark, sf_dir):
    """Quality of the rule and classifier labellings."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.annotation_quality(ann, ["rule", "classifier"]))


@register("sparsity")
def q_sparsity(spark, sf_dir):
    """A10: 1 - nnz / (cells x genes) of the raw matrix."""
    b = SI.standin_bundle(spark, sf_dir)
    return rounded(QC.sparsity(b.counts, b.cells, b.genes))


@register("data_validation")
def q_data_validation(spark, sf_dir):
    """The validation report of the raw matrix as (section, key, value)."""
    b = SI.standin_bundle(spark, sf_dir)
    q = QC.qc_cells(b.counts, b.cells, b.genes, percent_top=())
    return rounded(AG.data_validation(b.counts, q, b.genes))


@register("before_after_report")
def q_before_after_report(spark, sf_dir):
    """Cells and genes before and after filtering."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir, write=False)
    return rounded(QC.before_after_report(b.cells, b.genes, kept_cells, kept_genes))


@register("reference_summary")
def q_reference_summary(spark, sf_dir):
    """Summary of the healthy cells."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.reference_summary(ann, cluster_col="leiden", type_col="rule_cell_type"))


@register("integration_summary")
def q_integration_summary(spark, sf_dir):
    """Per health status counts, percent and mean QC metrics."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.integration_summary(ann))


@register("group_mean_expression")
def q_group_mean_expression(spark, sf_dir):
    """Per segment and gene mean log expression and fraction expressing."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    return rounded(DE.group_means(ln, kept_cells, "sample_type", kept_genes))


@register("histogram")
def q_histogram(spark, sf_dir):
    """30 equal-width bins of counts per cell."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.histogram(ann, "total_counts", 30))


@register("box_stats")
def q_box_stats(spark, sf_dir):
    """Quartiles of counts per cell by segment."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(AG.box_stats(ann, "total_counts", "sample_type"))


# ----------------------------------------------- N: normalise, HVG, scaling

@register("normalize_log")
def q_normalize_log(spark, sf_dir):
    """N1 + N2: counts scaled to 1e4 per cell, then log1p."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir, write=False)
    return rounded(ln)


def _hvg(spark, sf_dir):
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    hvg = PL.materialize(NZ.highly_variable_genes(ln, kept_cells, kept_genes.select("gene_id"), P["n_top_genes"]))
    return hvg, (b, kept_cells, kept_genes, c2, ln)


@register("hvg_seurat")
def q_hvg_seurat(spark, sf_dir):
    """Seurat-flavour dispersions, normalised per mean bin, top 200."""
    hvg, _ = _hvg(spark, sf_dir)
    return rounded(hvg)


@register("hvg_seurat_v3")
def q_hvg_seurat_v3(spark, sf_dir):
    """seurat_v3-flavour variance of standardised clipped counts."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    return rounded(NZ.highly_variable_genes_v3(c2, kept_cells, kept_genes.select("gene_id"), P["n_top_genes"]))


@register("scale")
def q_scale(spark, sf_dir):
    """Stored entries of the HVG layer scaled to unit variance, clipped."""
    hvg, (b, kept_cells, kept_genes, c2, ln) = _hvg(spark, sf_dir)
    scaled, stats = NZ.scale(NZ.subset_genes(ln, hvg), kept_cells, 10.0)
    return rounded(scaled)


@register("scale_gene_stats")
def q_scale_gene_stats(spark, sf_dir):
    """Per HVG mean, std and the scaled value of an absent entry."""
    hvg, (b, kept_cells, kept_genes, c2, ln) = _hvg(spark, sf_dir)
    scaled, stats = NZ.scale(NZ.subset_genes(ln, hvg), kept_cells, 10.0)
    return rounded(stats)


@register("preprocess")
def q_preprocess(spark, sf_dir):
    """The whole preprocessing chain; one summary row."""
    b = _bundle(spark, sf_dir)
    pp = PL.preprocess(b.counts, b.cells, b.genes, min_genes=P["min_genes"], min_cells=P["min_cells"],
                       n_top_genes=P["n_top_genes"], max_pct_mt=P["max_pct_mt"])
    f = pp.filtered
    return (pp.scaled.agg(F.count(F.lit(1)).alias("n_scaled_entries"))
            .select(QC._n_rows(f.cells).alias("n_cells"), QC._n_rows(f.genes).alias("n_genes"),
                    QC._n_rows(pp.gene_stats).alias("n_hvg"), "n_scaled_entries"))


# ------------------------------------------------------------- L: labels

@register("classify_cells")
def q_classify_cells(spark, sf_dir):
    """L1: nearest-centroid linear model of the segments, softmax confidence."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    return rounded(_classifier(ln, kept_cells))


@register("majority_vote")
def q_majority_vote(spark, sf_dir):
    """L2: each cell takes its cluster's modal classifier label."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(LB.majority_vote(ann, "classifier_cell_type", "leiden")
                   .select("cell_id", "leiden", "majority_label", "majority_label_score"))


def _emb_knn(spark, sf_dir, k):
    emb = SI.standin_embeddings(spark, sf_dir)
    return emb, PL.materialize(GR.knn(emb.select("cell_id", "vec"), k=k))


@register("transfer_labels_knn")
def q_transfer_labels_knn(spark, sf_dir):
    """L3: every embedded cell labelled by a vote of its 15 nearest others."""
    emb, edges = _emb_knn(spark, sf_dir, P["n_neighbors"])
    return rounded(LB.transfer_labels_knn(edges, emb.select("cell_id", "label"), "label"))


@register("transfer_labels_corr")
def q_transfer_labels_corr(spark, sf_dir):
    """L4: Spearman correlation with segment mean profiles, argmax."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    gm = DE.group_means(ln, kept_cells, "sample_type")
    types = F.array_sort(F.collect_set("sample_type"))
    grid = kept_genes.select("gene_id", F.explode(kept_cells.agg(types).scalar()).alias("type"))
    prof = (grid.join(gm.select(F.col("group").alias("type"), "gene_id", "mean_expression"), ["type", "gene_id"], "left")
            .fillna({"mean_expression": 0.0}))
    return rounded(LB.transfer_labels_corr(ln, kept_cells, prof, kept_genes.select("gene_id")))


@register("first_available")
def q_first_available(spark, sf_dir):
    """Classifier label where the cell was kept, else the rule label."""
    b, kept_cells, kept_genes, c2, ln = _prep(spark, sf_dir)
    pred = _classifier(ln, kept_cells)
    cells = (b.cells.withColumn("rule", LB.rule_labels("sample", "health_status"))
             .join(pred.select("cell_id", F.col("predicted_celltype").alias("classifier")), "cell_id", "left"))
    return LB.first_available(cells, ["classifier", "rule"]).select("cell_id", "celltype", "method")


@register("rule_labels")
def q_rule_labels(spark, sf_dir):
    """Cluster (nation) x health status -> six labels."""
    cells = SI.standin_cells(spark, sf_dir)
    return cells.select("cell_id", LB.rule_labels("sample", "health_status").alias("rule_cell_type"))


@register("compare_labels")
def q_compare_labels(spark, sf_dir):
    """ARI and NMI of classifier labels against the segments."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(LB.compare_labels(ann, "sample_type", "classifier_cell_type"))


@register("compare_all_labels")
def q_compare_all_labels(spark, sf_dir):
    """ARI and NMI of every pair of segment, region, rule and classifier labels."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(LB.compare_all_labels(ann, ["sample_type", "region", "rule_cell_type", "classifier_cell_type"]))


@register("per_type_accuracy")
def q_per_type_accuracy(spark, sf_dir):
    """Per label agreement of the classifier with the segments."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(LB.per_type_accuracy(ann, "sample_type", "classifier_cell_type"))


@register("confidence_filter")
def q_confidence_filter(spark, sf_dir):
    """Cells with classifier confidence > 0.7."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(LB.confidence_filter(ann, "classifier_confidence", 0.7)
                   .select("cell_id", "classifier_cell_type", "classifier_confidence"))


# -------------------------------------------------- R: reference comparison

@register("abnormal_clusters_ratio")
def q_abnormal_clusters_ratio(spark, sf_dir):
    """Every cluster's composition, abnormal when leukemia share > 0.8."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(RF.abnormal_clusters_ratio(ann, "leiden", type_col="rule_cell_type"))


@register("abnormal_clusters_percent")
def q_abnormal_clusters_percent(spark, sf_dir):
    """R2: clusters with > 50 % leukemia cells and their dominant segment."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(RF.abnormal_clusters_percent(ann, "leiden"))


@register("abnormal_clusters_with_types")
def q_abnormal_clusters_with_types(spark, sf_dir):
    """R2 plus the dominant classifier label and its percent."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(RF.abnormal_clusters_with_types(ann, "classifier_cell_type", "leiden"))


@register("cluster_composition")
def q_cluster_composition(spark, sf_dir):
    """Dominant and second classifier label per cluster."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(RF.cluster_composition(ann, "classifier_cell_type", "leiden", "classifier"))


@register("composition_by_sample")
def q_composition_by_sample(spark, sf_dir):
    """Rule-label composition of each segment (row %)."""
    ann, _ = _ann(spark, sf_dir)
    return rounded(RF.composition_by_sample(ann, "rule_cell_type", "sample_type"))


# ------------------------------------------------ D: differential expression

@register("rank_genes_vs_reference")
def q_rank_genes_vs_reference(spark, sf_dir):
    """D2 (+ D5 flag): each abnormal cluster of R1 against the healthy cells
    outside it; ranks over the two sides only."""
    ann, (b, kept_cells, kept_genes, c2, ln) = _ann(spark, sf_dir)
    r1 = RF.abnormal_clusters_ratio(ann, "leiden", type_col=None)
    de = DE.rank_clusters_vs_healthy(ln, ann, "leiden", r1.where("is_abnormal").select("leiden"), genes=kept_genes.select("gene_id"))
    return rounded(DE.significant(de, P["padj"], 0.5, flag="significant"))


@register("rank_genes_within")
def q_rank_genes_within(spark, sf_dir):
    """D3 (+ two-sided D5 as a flag): leukemia vs healthy inside each R2
    cluster with more than 10 healthy cells."""
    ann, (b, kept_cells, kept_genes, c2, ln) = _ann(spark, sf_dir)
    r2 = RF.abnormal_clusters_percent(ann, "leiden").select("leiden")
    de = DE.rank_genes_within(ln, ann, "leiden", "health_status", "leukemia", "healthy", 10,
                              clusters=r2, genes=kept_genes.select("gene_id"))
    return rounded(DE.significant(de, P["padj"], 0.5, two_sided=True, flag="significant"))


@register("subtype_markers")
def q_subtype_markers(spark, sf_dir):
    """Groups whose name contains 'AUTO', logfc > 0.5, the query's padj cut."""
    de, (b, *_r) = _de(spark, sf_dir)
    return rounded(DE.subtype_markers(de, "AUTO", P["padj"], 0.5, genes=b.genes))


@register("volcano")
def q_volcano(spark, sf_dir):
    """Volcano table of the segment markers."""
    de, _ = _de(spark, sf_dir)
    return rounded(DE.volcano(de, P["padj"]).select("group", "gene_id", "logfc", "padj", "neg_log10_padj", "regulation"))


@register("de_summary")
def q_de_summary(spark, sf_dir):
    """Per segment genes tested, significant, top 5 genes."""
    de, _ = _de(spark, sf_dir)
    s = DE.de_summary(de, P["padj"])
    return s.withColumn("top_genes", _str_array(F.col("top_genes")))


# ------------------------------------------------------ E: enrichment, drugs

@register("enrich")
def q_enrich(spark, sf_dir):
    """E1 (J5): top 100 markers per segment against part-type and brand sets."""
    de, (b, *_r) = _de(spark, sf_dir)
    e = EN.enrich(de, SI.standin_gene_sets(spark, sf_dir), P["enrich_top"])
    return rounded(e.withColumn("overlap_genes", _str_array(F.col("overlap_genes"))))


@register("rank_drugs")
def q_rank_drugs(spark, sf_dir):
    """E2 (J6): top 50 up-regulated markers against supplier signatures."""
    de, _ = _de(spark, sf_dir)
    d = EN.rank_drugs(de, SI.standin_signatures(spark, sf_dir), 50)
    return rounded(d.withColumn("overlap_genes", _str_array(F.col("overlap_genes"))))


@register("drug_associations")
def q_drug_associations(spark, sf_dir):
    """Per segment the first 10 markers and the 3 best drugs."""
    de, _ = _de(spark, sf_dir)
    d = EN.rank_drugs(de, SI.standin_signatures(spark, sf_dir), 50)
    a = EN.drug_associations(de, d)
    return a.select("group", _str_array(F.col("association.top_genes")).alias("top_genes"),
                    _str_array(F.col("association.potential_drugs")).alias("potential_drugs"))


# ------------------------------------------------------------------ G: graph

@register("knn")
def q_knn(spark, sf_dir):
    """Exact 15 nearest neighbours of every embedded cell."""
    emb, edges = _emb_knn(spark, sf_dir, P["n_neighbors"])
    return rounded(edges)


def _knn_graph(edges):
    """Symmetric unweighted graph of a kNN edge list (weight = number of
    directions in which the pair is a neighbour pair)."""
    e = edges.select("src", "dst", F.lit(1.0).alias("weight"))
    t = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1.0).alias("weight"))
    return e.unionByName(t).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


@register("modularity")
def q_modularity(spark, sf_dir):
    """Modularity of the manual labels on the symmetric kNN graph."""
    emb, edges = _emb_knn(spark, sf_dir, P["n_neighbors"])
    return rounded(GR.modularity_df(_knn_graph(edges), emb.select("cell_id", F.col("label").alias("community")),
                                    1.0))


@register("group_connectivity")
def q_group_connectivity(spark, sf_dir):
    """PAGA connectivity between manual labels on the kNN graph."""
    emb, edges = _emb_knn(spark, sf_dir, P["n_neighbors"])
    return rounded(GR.group_connectivity(edges, emb.select("cell_id", "label"), "label"))


@register("connectivities")
def q_connectivities(spark, sf_dir):
    """UMAP fuzzy-set weights of the kNN graph."""
    emb, edges = _emb_knn(spark, sf_dir, P["n_neighbors"] - 1)
    return rounded(GR.connectivities(edges))


@register("communities")
def q_communities(spark, sf_dir):
    """Louvain communities of the fuzzy kNN graph (rows-only check)."""
    emb, edges = _emb_knn(spark, sf_dir, P["n_neighbors"] - 1)
    g = PL.materialize(GR.connectivities(edges))
    return GR.communities(g, resolution=0.5)


@register("pca")
def q_pca(spark, sf_dir):
    """G1: 50 principal components of the scaled HVG matrix (rows-only)."""
    b = _bundle(spark, sf_dir)
    pp = PL.preprocess(b.counts, b.cells, b.genes, min_genes=P["min_genes"], min_cells=P["min_cells"],
                       n_top_genes=P["n_top_genes"], max_pct_mt=P["max_pct_mt"])
    from ..operators import embed as EM
    emb, _, _ = EM.pca(pp.scaled, pp.gene_stats, pp.filtered.cells, 50)
    return emb


@register("batch_embedding")
def q_batch_embedding(spark, sf_dir):
    """10-dim PCA centred per segment (batch) (rows-only)."""
    b = _bundle(spark, sf_dir)
    pp = PL.preprocess(b.counts, b.cells, b.genes, min_genes=P["min_genes"], min_cells=P["min_cells"],
                       n_top_genes=P["n_top_genes"], max_pct_mt=P["max_pct_mt"])
    from ..operators import embed as EM
    return EM.batch_embedding(pp.scaled, pp.gene_stats, pp.filtered.cells, 10, "sample_type")


def _dpt(spark, sf_dir):
    emb, edges = _emb_knn(spark, sf_dir, P["n_neighbors"] - 1)
    g = PL.materialize(GR.connectivities(edges))
    root = emb.agg(F.min("cell_id")).first()[0]
    return emb, GR.root_pseudotime(g, root, n_comps=10)


@register("diffusion_pseudotime")
def q_diffusion_pseudotime(spark, sf_dir):
    """G7 + G8: diffusion components and pseudotime from the smallest cell id."""
    emb, pt = _dpt(spark, sf_dir)
    return rounded(pt)


@register("pseudotime_by_group")
def q_pseudotime_by_group(spark, sf_dir):
    """Pseudotime quartiles per manual label."""
    emb, pt = _dpt(spark, sf_dir)
    return rounded(GR.pseudotime_by_group(pt, emb.select("cell_id", "label"), "label"))


@register("analyze")
def q_analyze(spark, sf_dir):
    """The chain from counts to drugs, the BUILDING cells as the healthy
    reference; one row per tested cluster with its composition, marker summary
    and drug association (rows-only: communities have no SQL)."""
    b = SI.standin_bundle(spark, sf_dir)
    counts = PL.materialize(b.counts)
    part = {h: b.cells.where(F.col("health_status") == h) for h in ("healthy", "leukemia")}
    side = {h: (counts.join(c.select("cell_id"), "cell_id", "left_semi"), c, b.genes) for h, c in part.items()}
    res = PL.analyze(*side["leukemia"], reference=side["healthy"], gene_sets=SI.standin_gene_sets(spark, sf_dir),
                     signatures=SI.standin_signatures(spark, sf_dir), min_genes=P["min_genes"], min_cells=P["min_cells"],
                     n_top_genes=P["n_top_genes"], max_pct_mt=P["max_pct_mt"], n_pcs=10, enrich_top=P["enrich_top"],
                     abnormal_ratio=0.75)
    s = res["summary"].withColumn("top_genes", _str_array(F.col("top_genes")))
    a = res["associations"].select("group", _str_array(F.col("association.potential_drugs")).alias("potential_drugs"))
    c = res["clusters"].select(F.col("community").alias("group"), "total_cells", "leukemia_cells", "is_abnormal")
    return s.join(c, "group").join(a, "group", "left")
