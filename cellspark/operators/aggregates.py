"""Tabulations and summaries over the cell table (A4-A9, A11, A13, A14,
A16, A17).

Totals over a whole table are scalar subqueries (``DataFrame.scalar()``),
computed once by the planner, instead of un-partitioned windows that would
pull every row into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .qc import _n_rows
from .quantiles import quantiles

MAX_PIVOT_VALUES = 1000


def _distinct_values(df: DataFrame, col: str, limit: int = MAX_PIVOT_VALUES) -> list:
    vals = [r[0] for r in df.select(col).distinct().orderBy(col).limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values")
    return vals


def crosstab(df: DataFrame, a: str, b: str, normalize: str | None = None) -> DataFrame:
    """A4 in long form: (a, b, count[, pct]) for every value of a with every value
    of b, absent pairs with count 0.

    normalize='index' -> pct of the row (a) total, 'columns' -> pct of the
    column (b) total, 'all' -> pct of all rows.  The window totals partition
    by one category value: at most that many pair rows.
    """
    seen = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))
    # a struct in the set keeps null, a category like any other
    values = df.select(b).distinct().agg(F.sort_array(F.collect_set(F.struct(b)))).scalar()
    grid = df.select(a).distinct().withColumn("_b", F.explode(values)).select(F.col(a).alias("_a"), F.col(f"_b.{b}").alias("_b"))
    t = (grid.join(seen, grid["_a"].eqNullSafe(seen[a]) & grid["_b"].eqNullSafe(seen[b]), "left")
         .select(F.col("_a").alias(a), F.col("_b").alias(b), F.coalesce("count", F.lit(0)).cast("long").alias("count")))
    if normalize == "index":
        t = t.withColumn("pct", F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy(a)))
    elif normalize == "columns":
        t = t.withColumn("pct", F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy(b)))
    elif normalize == "all":
        t = t.withColumn("pct", F.col("count") * 100.0 / _n_rows(df))
    return t


def crosstab_wide(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    """A4 as a matrix: one row per ``a``, one zero-filled count column per
    value of ``b`` (values collected under a cap, as pivot does)."""
    values = values if values is not None else _distinct_values(df, b)
    return df.groupBy(a).pivot(b, values).count().fillna(0)


def cell_types_by_condition(cells: DataFrame, type_col: str, cond_col: str = "health_status",
                            conditions: list | None = None) -> DataFrame:
    """A5: per type the count in each condition, total_cells, and each
    condition's percent of the type (row %); ordered by total desc, type."""
    conditions = conditions if conditions is not None else _distinct_values(cells, cond_col)
    wide = crosstab_wide(cells, type_col, cond_col, conditions)
    tot = reduce(lambda x, y: x + y, [F.col(f"`{c}`") for c in conditions])
    wide = wide.withColumn("total_cells", tot.cast("long"))
    for c in conditions:
        wide = wide.withColumn(f"{c}_pct", F.col(f"`{c}`") * 100.0 / F.col("total_cells"))
    return wide.orderBy(F.col("total_cells").desc(), F.col(type_col))


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """(col, count, percent) by count desc, value asc; optional top n."""
    t = (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
         .withColumn("percent", F.col("count") * 100.0 / _n_rows(df))
         .orderBy(F.col("count").desc(), F.col(col)))
    return t.limit(top) if top else t


def describe_metrics(df: DataFrame, cols: list[str], exact_median: bool = True,
                     by: list[str] | None = None) -> DataFrame:
    """A7 in long form: (metric, count, mean, std (ddof 1), min, max, median).

    ``exact_median`` selects the median exactly (:func:`quantiles.quantiles`, no group in
    one task); otherwise ``percentile_approx``."""
    by = by or []
    parts = []
    for c in cols:
        approx = [] if exact_median else [F.percentile_approx(c, 0.5, 10000).cast("double").alias("median")]
        found = df.groupBy(*by).agg(
            F.lit(c).alias("metric"), F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"), *approx)
        if exact_median:
            found = _with_quantiles(found, df, c, by, {"median": 0.5})
        parts.append(found)
    return reduce(lambda x, y: x.unionByName(y), parts)


def _with_quantiles(found: DataFrame, df: DataFrame, value: str, by: list[str], named: dict[str, float]) -> DataFrame:
    """``found`` (a row per group) with the named quantiles of ``value``."""
    q = quantiles(df, value, list(named.values()), by)
    q = q.select(*[F.col(c).alias(f"_q_{c}") for c in by], *[F.col("q")[i].alias(n) for i, n in enumerate(named)], F.lit(1).alias("_q_one"))
    cond = F.lit(1) == F.col("_q_one")  # a row per group on both sides, one row each without groups
    for c in by:
        cond &= F.col(c).eqNullSafe(F.col(f"_q_{c}"))
    return found.join(q, cond, "left").drop("_q_one", *[f"_q_{c}" for c in by])


def confidence_summary(df: DataFrame, type_col: str = "predicted_celltype",
                       conf_col: str = "confidence", digits: int = 3) -> DataFrame:
    """Per type count, mean and std (ddof 1) of confidence, rounded."""
    return (df.groupBy(type_col).agg(
        F.count(conf_col).alias("count"), F.round(F.avg(conf_col), digits).alias("mean"),
        F.round(F.stddev_samp(conf_col), digits).alias("std")))


def annotation_quality(cells: DataFrame, methods: list[str], threshold: float = 0.7,
                       type_fmt: str = "{}_cell_type", conf_fmt: str = "{}_confidence") -> DataFrame:
    """Per labelling method: n_cell_types, n_cells, mean_confidence,
    high_confidence_pct (confidence > threshold, strict), dominant type and
    its percent (count desc, label asc).  Methods are stacked into one long
    table so a single group-by serves all of them; methods whose columns are
    missing are skipped, a missing confidence gives nulls."""
    parts = []
    for m in methods:
        tc, cc = type_fmt.format(m), conf_fmt.format(m)
        if tc not in cells.columns:
            continue
        conf = F.col(cc).cast("double") if cc in cells.columns else F.lit(None).cast("double")
        parts.append(cells.select(F.lit(m).alias("method"), F.col(tc).alias("cell_type"), conf.alias("conf")))
    if not parts:
        raise ValueError("no annotation method found")
    long = reduce(lambda x, y: x.unionByName(y), parts)
    per = long.groupBy("method").agg(
        F.countDistinct("cell_type").alias("n_cell_types"), F.count(F.lit(1)).alias("n_cells"),
        F.avg("conf").alias("mean_confidence"),
        (F.avg(F.when(F.col("conf").isNull(), None).otherwise((F.col("conf") > threshold).cast("double")))
         * 100.0).alias("high_confidence_pct"))
    w = Window.partitionBy("method").orderBy(F.col("_n").desc(), F.col("cell_type"))
    dom = (long.groupBy("method", "cell_type").agg(F.count(F.lit(1)).alias("_n"))
           .withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
           .select("method", F.col("cell_type").alias("dominant_cell_type"), F.col("_n").alias("_dn")))
    return (per.join(dom, "method")
            .withColumn("dominant_pct", F.col("_dn") * 100.0 / F.col("n_cells")).drop("_dn"))


def data_validation(counts: DataFrame, cells_qc: DataFrame, genes: DataFrame,
                    category_cols=("sample", "sample_type", "health_status")) -> DataFrame:
    """A11 as a long report (section, key, value): matrix shape, total counts,
    sparsity, counts / genes per cell mean-median-min-max, category counts."""
    nnz = counts.where(F.col("value") != 0)
    shape = nnz.agg(F.count(F.lit(1)).cast("double").alias("nnz"), F.sum("value").alias("total")).select(
        F.lit("matrix").alias("section"),
        F.explode(F.array(
            F.struct(F.lit("n_cells").alias("key"), _n_rows(cells_qc).cast("double").alias("value")),
            F.struct(F.lit("n_genes").alias("key"), _n_rows(genes).cast("double").alias("value")),
            F.struct(F.lit("total_counts").alias("key"), F.col("total").alias("value")),
            F.struct(F.lit("sparsity").alias("key"),
                     (F.lit(1.0) - F.col("nnz") / (_n_rows(cells_qc) * _n_rows(genes))).alias("value")),
        )).alias("kv")).select("section", "kv.key", "kv.value")
    stats = []
    for c, name in (("total_counts", "counts_per_cell"), ("n_genes_by_counts", "genes_per_cell")):
        s = cells_qc.agg(F.avg(c).alias("mean"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))
        s = _with_quantiles(s, cells_qc, c, [], {"median": 0.5})
        stats.append(s.select(F.lit(name).alias("section"), F.explode(F.array(
            *[F.struct(F.lit(k).alias("key"), F.col(k).cast("double").alias("value"))
              for k in ("mean", "median", "min", "max")])).alias("kv")).select("section", "kv.key", "kv.value"))
    cats = [cells_qc.groupBy(F.col(c).cast("string").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
            .select(F.lit(c).alias("section"), "key", "value") for c in category_cols if c in cells_qc.columns]
    return reduce(lambda x, y: x.unionByName(y), [shape, *stats, *cats])


def reference_summary(cells: DataFrame, status_col: str = "health_status", healthy: str = "healthy",
                      cluster_col: str | None = "leiden", type_col: str | None = None) -> DataFrame:
    """One row over healthy cells: total, distinct samples, clusters,
    sorted cell-type list, mean counts and genes per cell."""
    h = cells.where(F.col(status_col) == healthy)
    aggs = [F.count(F.lit(1)).alias("total_healthy_cells")]
    if "sample" in cells.columns:
        aggs.append(F.countDistinct("sample").alias("healthy_samples"))
    if cluster_col and cluster_col in cells.columns:
        aggs.append(F.countDistinct(cluster_col).alias("healthy_clusters"))
    if type_col and type_col in cells.columns:
        aggs.append(F.array_join(F.array_sort(F.collect_set(type_col)), ", ").alias("healthy_cell_types"))
    if "total_counts" in cells.columns:
        aggs.append(F.avg("total_counts").alias("mean_counts_per_healthy_cell"))
    if "n_genes_by_counts" in cells.columns:
        aggs.append(F.avg("n_genes_by_counts").alias("mean_genes_per_healthy_cell"))
    return h.agg(*aggs)


def integration_summary(cells: DataFrame, status_col: str = "health_status") -> DataFrame:
    """Per health status: n_cells, percent, mean counts, genes and mt %
    (when present)."""
    aggs = [F.count(F.lit(1)).alias("n_cells")]
    for c, name in (("total_counts", "mean_total_counts"), ("n_genes_by_counts", "mean_n_genes"),
                    ("pct_counts_mt", "mean_pct_mt")):
        if c in cells.columns:
            aggs.append(F.avg(c).alias(name))
    return (cells.groupBy(status_col).agg(*aggs)
            .withColumn("percent", F.col("n_cells") * 100.0 / _n_rows(cells)))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed.  A
    constant column spans [v - 0.5, v + 0.5] (numpy's rule).  Returns
    (bin, lower, upper, count) for non-empty bins."""
    x = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    r = x.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    s = r.select(F.struct(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))).scalar()
    lo, hi = s["lo"], s["hi"]
    b = F.least(F.lit(bins - 1), F.floor((F.col(col) - lo) * F.lit(bins) / (hi - lo)).cast("int"))
    return (x.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("lower", lo + (hi - lo) * F.col("bin") / F.lit(bins))
            .withColumn("upper", lo + (hi - lo) * (F.col("bin") + 1) / F.lit(bins)))


def box_stats(df: DataFrame, value: str, group: str, exact: bool = True) -> DataFrame:
    """Per group n, min, q1, median, q3, max (linear interpolation); exact ones by
    distributed selection, otherwise ``percentile_approx``."""
    stats = [F.count(value).alias("n"), F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max")]
    if exact:
        found = _with_quantiles(df.groupBy(group).agg(*stats), df, value, [group], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    else:
        q = F.percentile_approx(value, [0.25, 0.5, 0.75], 10000)
        found = df.groupBy(group).agg(*stats, *[q[i].cast("double").alias(c) for i, c in enumerate(("q1", "median", "q3"))])
    return found.select(group, "n", "min", "q1", "median", "q3", "max")
