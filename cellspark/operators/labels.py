"""Cell labels: model scoring, votes, transfer, agreement.

A linear model is a coefficient table (type, gene_id, weight) plus an
intercept table (type, intercept).  For scoring, a gene's weights for all types
are the columns of a few rows; those of a cell's genes are added up by plain sums, and
the label is the place of the largest sum.  No row per (cell, type) is made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .qc import _n_rows


def _type_array(types: DataFrame):
    """All values of ``type`` as one sorted array: a scalar subquery, so any number
    of types stays in the plan and none passes through the driver."""
    return types.agg(F.sort_array(F.collect_set("type"))).scalar()


def _per_gene(df: DataFrame, types, value_col: str) -> DataFrame:
    """(gene_id, _w): the values of a gene in the order of ``types`` (an array column),
    0 where it has none."""
    held = df.groupBy("gene_id").agg(F.map_from_entries(F.collect_list(F.struct("type", F.col(value_col).cast("double")))).alias("_m"))
    return held.withColumn("_t", types).select("gene_id", F.transform("_t", lambda t: F.coalesce(F.element_at("_m", t), F.lit(0.0))).alias("_w"))


#: Values of a gene that one row of ``_summed`` carries.
PLACES = 8


def _summed(rows: DataFrame, weights: DataFrame, *factors) -> DataFrame:
    """(cell_id, _sums): for each of the factors (columns of ``rows``) the sums of factor x
    value over the cell's genes, in the order of the values of ``weights`` (:func:`_per_gene`).
    Values travel as plain columns, PLACES to a row, so that any number of them is added
    up by ordinary sums."""
    parts = F.sequence(F.lit(0), F.floor((F.greatest(F.size("_w"), F.lit(1)) - 1) / PLACES).cast("int"))
    cut = weights.select("gene_id", "_w", F.size("_w").alias("_n"), F.explode(parts).alias("_part")).select(
        "gene_id", "_part", "_n", *[F.get("_w", F.col("_part") * PLACES + i).alias(f"_w{i}") for i in range(PLACES)])
    sums = (rows.join(cut, "gene_id").groupBy("cell_id", "_part")
            .agg(F.max("_n").alias("_n"), *[F.sum(f * F.col(f"_w{i}")).alias(f"_s{j}_{i}") for j, f in enumerate(factors) for i in range(PLACES)]))
    held = F.struct("_part", *[F.array(*[f"_s{j}_{i}" for i in range(PLACES)]).alias(f"_s{j}") for j in range(len(factors))])
    whole = sums.groupBy("cell_id").agg(F.max("_n").alias("_n"), F.array_sort(F.collect_list(held)).alias("_p"))
    each = [F.slice(F.flatten(F.col("_p")[f"_s{j}"]), 1, F.col("_n")) for j in range(len(factors))]
    return whole.select("cell_id", F.concat(*each).alias("_sums"))


def classify_cells(layer: DataFrame, cells: DataFrame, coef: DataFrame, intercept: DataFrame | None = None,
                   prob: str = "softmax") -> DataFrame:
    """L1: decision_t(cell) = sum_g w_tg x_g + b_t for every type; label =
    argmax (type asc on ties); confidence = the winner's probability
    (``softmax`` over types, or one-vs-rest ``sigmoid`` as CellTypist).
    Cells of ``cells`` without any scored gene get the intercepts only.
    Returns cell_id, predicted_celltype, confidence, decision."""
    b = intercept if intercept is not None else coef.select("type").distinct().withColumn("intercept", F.lit(0.0))
    types = _type_array(b.select("type"))
    weights = _per_gene(coef.join(b.select("type"), "type", "left_semi"), types, "weight")
    dot = _summed(layer, weights, F.col("value"))
    base = b.agg(F.map_from_entries(F.collect_list(F.struct("type", F.coalesce(F.col("intercept").cast("double"), F.lit(0.0)))))).scalar()
    scored = (cells.select("cell_id").join(dot, "cell_id", "left").select("cell_id", types.alias("_types"), base.alias("_base"), "_sums")
              .withColumn("_d", F.transform("_types", lambda t, i: F.element_at("_base", t) + F.coalesce(F.get("_sums", i), F.lit(0.0))))
              .withColumn("decision", F.array_max("_d")))
    if prob == "softmax":
        conf = F.lit(1.0) / F.aggregate("_d", F.lit(0.0), lambda z, d: z + F.exp(d - F.col("decision")))
    else:
        conf = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("decision")))
    label = F.element_at("_types", F.array_position("_d", F.col("decision")).cast("int"))
    return scored.select("cell_id", label.alias("predicted_celltype"), conf.alias("confidence"), "decision")


def centroid_model(layer: DataFrame, labels: DataFrame, label_col: str):
    """Nearest-centroid linear model from labelled cells: weight = the
    type's mean expression of a gene (zeros included), intercept =
    -1/2 * sum of squared weights, so argmax decision = nearest centroid.  Both are
    written tables: scoring reads them several times, the layer's means are taken once."""
    from ..plans.pipeline import materialize
    from .de import group_means
    gm = group_means(layer, labels, label_col)
    coef = materialize(gm.select(F.col("group").alias("type"), "gene_id", F.col("mean_expression").alias("weight")))
    icpt = coef.groupBy("type").agg((F.sum(F.col("weight") * F.col("weight")) * -0.5).alias("intercept"))
    return coef, materialize(icpt)


def train_classifier(vectors: DataFrame, labels: DataFrame, label_col: str, gene_ids: list,
                     max_iter: int = 100, reg: float = 0.0):
    """L1 training: multinomial LogisticRegression (pyspark.ml) on per-cell
    dense vectors of a small gene panel (``vectors``: cell_id, vec in the
    order of ``gene_ids``).  Returns (coef, intercept) tables."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import array_to_vector
    df = (vectors.join(labels.select("cell_id", label_col), "cell_id")
          .where(F.col(label_col).isNotNull())
          .withColumn("features", array_to_vector("vec")))
    idx = StringIndexer(inputCol=label_col, outputCol="label", stringOrderType="alphabetAsc").fit(df)
    model = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg).fit(idx.transform(df))
    spark = vectors.sparkSession
    cm = model.coefficientMatrix.toArray()
    rows = [(str(t), gene_ids[j], float(cm[i, j])) for i, t in enumerate(idx.labels)
            for j in range(cm.shape[1]) if cm[i, j] != 0.0]
    id_type = "long" if gene_ids and isinstance(gene_ids[0], int) else "string"
    coef = spark.createDataFrame(rows, f"type string, gene_id {id_type}, weight double")
    icpt = spark.createDataFrame([(str(t), float(v)) for t, v in zip(idx.labels, model.interceptVector.toArray())],
                                 "type string, intercept double")
    return coef, icpt


def majority_vote(cells: DataFrame, label_col: str, cluster_col: str,
                  out_col: str = "majority_label") -> DataFrame:
    """L2: every cell takes its cluster's modal label (count desc, label
    asc); ``{out_col}_score`` = the modal share of the cluster."""
    t = cells.groupBy(cluster_col, label_col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(cluster_col).orderBy(F.col("_n").desc(), F.col(label_col))
    wt = Window.partitionBy(cluster_col)
    mode = (t.withColumn("_tot", F.sum("_n").over(wt)).withColumn("_r", F.row_number().over(w))
            .where(F.col("_r") == 1)
            .select(cluster_col, F.col(label_col).alias(out_col), (F.col("_n") / F.col("_tot")).alias(f"{out_col}_score")))
    return cells.join(mode, cluster_col, "left")


def transfer_labels_knn(edges: DataFrame, ref_labels: DataFrame, label_col: str = "label") -> DataFrame:
    """L3: each query cell takes the most frequent label among its
    reference neighbours (``edges`` src = query, dst = reference; count
    desc, then smaller summed distance, then label asc); score = vote
    share."""
    e = edges.join(ref_labels.select(F.col("cell_id").alias("dst"), F.col(label_col).alias("_lab")), "dst")
    t = e.groupBy("src", "_lab").agg(F.count(F.lit(1)).alias("_n"), F.sum("dist").alias("_d"))
    w = Window.partitionBy("src").orderBy(F.col("_n").desc(), F.col("_d"), F.col("_lab"))
    wt = Window.partitionBy("src")
    return (t.withColumn("_tot", F.sum("_n").over(wt)).withColumn("_r", F.row_number().over(w))
            .where(F.col("_r") == 1)
            .select(F.col("src").alias("cell_id"), F.col("_lab").alias("predicted_celltype"),
                    (F.col("_n") / F.col("_tot")).alias("score")))


def transfer_labels_corr(layer: DataFrame, cells: DataFrame, profiles: DataFrame,
                         genes: DataFrame) -> DataFrame:
    """L4: Spearman correlation of each cell with each reference profile
    over the gene panel ``genes``; label = argmax (type asc on ties).

    ``profiles`` (type, gene_id, mean_expression) covers the panel densely.
    Sparse ranks: a cell's z zero genes share rank (z+1)/2 and its nonzero
    genes rank above them, so every sum the Pearson formula needs comes
    from the nonzero entries plus per-type totals.
    """
    G = _n_rows(genes)
    mu = (G + 1) / 2.0
    pr = profiles.join(genes.select("gene_id"), "gene_id", "left_semi")
    # dense average ranks of each profile over the panel: one type per window
    wp = Window.partitionBy("type").orderBy("mean_expression")
    wpt = Window.partitionBy("type", "mean_expression")
    pr = (pr.withColumn("_rk", F.rank().over(wp) + (F.count(F.lit(1)).over(wpt) - 1) / 2.0)
            .select("type", "gene_id", F.col("_rk").alias("rt")))
    types = _type_array(profiles.select("type"))
    square = F.sum(F.col("rt") * F.col("rt"))
    totals = pr.groupBy("type").agg(F.struct(F.sum("rt").alias("s"), square.alias("s2")).alias("t"))
    totals = totals.agg(F.map_from_entries(F.collect_list(F.struct("type", "t")))).scalar()
    ranks = _per_gene(pr, types, "rt")
    x = layer.where(F.col("value") > 0).join(genes.select("gene_id"), "gene_id", "left_semi")
    wc = Window.partitionBy("cell_id")
    wcr = Window.partitionBy("cell_id").orderBy("value")
    wct = Window.partitionBy("cell_id", "value")
    x = (x.withColumn("_nz", F.count(F.lit(1)).over(wc))
          .withColumn("rc", (G - F.col("_nz")) + F.rank().over(wcr) + (F.count(F.lit(1)).over(wct) - 1) / 2.0))
    cstat = x.groupBy("cell_id").agg(F.first("_nz").alias("nz"), F.sum(F.col("rc") * F.col("rc")).alias("_src2"))
    cross = _summed(x, ranks, F.col("rc"), F.lit(1.0))
    d = (cells.select("cell_id").join(cstat, "cell_id", "left").join(cross, "cell_id", "left").fillna({"nz": 0, "_src2": 0.0})
         .withColumns({"_types": types, "_t": totals}))
    z = G - F.col("nz")
    r0 = (z + 1) / 2.0
    var_c = F.col("_src2") + z * r0 * r0 - G * mu * mu
    d = d.withColumns({"_r0": r0, "_var": var_c, "_mid": G * mu * mu})

    def corr(name, i):
        t = F.element_at("_t", name)
        both, part = (F.coalesce(F.get("_sums", j), F.lit(0.0)) for j in (i, i + F.size("_types")))
        cov = both + F.col("_r0") * (t["s"] - part) - F.col("_mid")
        return F.try_divide(cov, F.sqrt(F.col("_var") * (t["s2"] - F.col("_mid"))))

    d = d.withColumn("_d", F.transform("_types", corr)).withColumn("score", F.array_max("_d"))
    place = F.greatest(F.coalesce(F.array_position("_d", F.col("score")), F.lit(1)), F.lit(1)).cast("int")  # no correlation: the first type
    return d.select("cell_id", F.element_at("_types", place).alias("predicted_celltype"), "score")


def first_available(cells: DataFrame, columns: list[str], out_col: str = "celltype",
                    method_col: str = "method") -> DataFrame:
    """The first non-null label among ``columns`` (in order), and the
    name of the column it came from ('none' if all are null)."""
    lab = F.coalesce(*[F.col(c) for c in columns])
    meth = reduce(lambda acc, c: F.when(F.col(c).isNotNull(), F.lit(c)).otherwise(acc),
                  list(reversed(columns)), F.lit("none"))
    return cells.withColumn(out_col, lab).withColumn(method_col, meth)


# The reference's six rule labels (cluster group x status).
RULE_LABELS = {
    ("healthy", "a"): "B cells", ("healthy", "b"): "T cells", ("healthy", "c"): "Monocytes",
    ("leukemia", "a"): "Leukemic B cells", ("leukemia", "b"): "Leukemic T cells",
    ("leukemia", "c"): "Leukemic blasts",
}
RULE_CLUSTERS_A = ("0", "1")
RULE_CLUSTERS_B = ("2", "3")


def rule_labels(cluster_col: str = "leiden", status_col: str = "health_status"):
    """Clusters 0-1 / 2-3 / other x healthy / leukemia -> six labels."""
    cl = F.col(cluster_col).cast("string")
    grp = F.when(cl.isin(*RULE_CLUSTERS_A), "a").when(cl.isin(*RULE_CLUSTERS_B), "b").otherwise("c")
    healthy = F.col(status_col) == "healthy"
    out = None
    for (status, g), label in RULE_LABELS.items():
        cond = (healthy if status == "healthy" else ~healthy | F.col(status_col).isNull()) & (grp == g)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def compare_labels(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row with ari, nmi (arithmetic normalisation), n_cells,
    n_labels_a, n_labels_b -- sklearn's definitions from one contingency
    group-by; both labellings single-class -> 1, 1."""
    t = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("n"))
    ra = t.groupBy(a).agg(F.sum("n").alias("na"))
    cb = t.groupBy(b).agg(F.sum("n").alias("nb"))
    s = t.agg(F.sum("n").alias("N"), F.sum(F.col("n") * F.col("n")).alias("ss"))
    sa = ra.agg(F.sum(F.col("na") * F.col("na")).alias("sa2"), F.count(F.lit(1)).alias("ka"),
                F.sum(-F.col("na") * F.log(F.col("na"))).alias("_ha"))
    sb = cb.agg(F.sum(F.col("nb") * F.col("nb")).alias("sb2"), F.count(F.lit(1)).alias("kb"),
                F.sum(-F.col("nb") * F.log(F.col("nb"))).alias("_hb"))
    mi = (t.join(ra, a).join(cb, b)
          .agg(F.sum(F.col("n") * F.log(F.col("n") / (F.col("na") * F.col("nb")))).alias("_mi")))
    one = s.select(F.struct("N", "ss").alias("s"))
    st = s.select(F.struct("N", "ss")).scalar()
    A = sa.select(F.struct("sa2", "ka", "_ha")).scalar()
    B = sb.select(F.struct("sb2", "kb", "_hb")).scalar()
    M = mi.select(F.col("_mi")).scalar()
    n, ss = st["N"], st["ss"]
    tp = ss - n
    fp = B["sb2"] - ss
    fn = A["sa2"] - ss
    tn = n * n - fp - fn - ss
    ari = F.when((fn == 0) & (fp == 0), F.lit(1.0)).otherwise(
        2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)))
    # entropies and MI in nats: H = ln N - sum n ln n / N; MI = sum n/N ln(N n / (na nb))
    ha = F.log(n) + A["_ha"] / n
    hb = F.log(n) + B["_hb"] / n
    mi_v = M / n + F.log(n)
    nmi = (F.when((A["ka"] == 1) & (B["kb"] == 1), F.lit(1.0))
           .when(F.abs(mi_v) < 1e-15, F.lit(0.0))
           .otherwise(mi_v / ((ha + hb) / 2.0)))
    return one.select(ari.alias("ari"), nmi.alias("nmi"), n.cast("long").alias("n_cells"),
                      A["ka"].alias("n_labels_a"), B["kb"].alias("n_labels_b"))


def compare_all_labels(df: DataFrame, methods: list[str]) -> DataFrame:
    """L7 for every pair of label columns: method1, method2, n_cells, ari and nmi as
    :func:`compare_labels` defines them, over the cells that both methods label.  All
    pairs come from one scan and one contingency group-by."""
    pairs = [(a, b) for i, a in enumerate(methods) for b in methods[i + 1:]]
    if not pairs:
        raise ValueError("two methods at least")
    each = F.array(*[F.struct(F.lit(a).alias("method1"), F.lit(b).alias("method2"), F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
                     for a, b in pairs])
    key = ["method1", "method2"]
    t = (df.select(F.explode(each).alias("p")).select("p.*").where("a IS NOT NULL AND b IS NOT NULL")
         .groupBy(*key, "a", "b").agg(F.count("*").cast("double").alias("n")))

    def side(c):
        per = t.groupBy(*key, c).agg(F.sum("n").alias("_n"))
        return per, per.groupBy(*key).agg(F.sum(F.col("_n") * F.col("_n")).alias(f"s{c}"), F.count("*").alias(f"k{c}"), F.sum(-F.col("_n") * F.log("_n")).alias(f"h{c}"))

    (pa, sa), (pb, sb) = side("a"), side("b")
    joined = t.join(pa.withColumnRenamed("_n", "na"), [*key, "a"]).join(pb.withColumnRenamed("_n", "nb"), [*key, "b"])
    total = joined.groupBy(*key).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("ss"),
                                     F.sum(F.col("n") * F.log(F.col("n") / (F.col("na") * F.col("nb")))).alias("m"))
    n, ss = F.col("n"), F.col("ss")
    fp, fn = F.col("sb") - ss, F.col("sa") - ss
    tp, tn = ss - n, n * n - F.col("sa") - F.col("sb") + ss
    ari = F.when((fn == 0) & (fp == 0), 1.0).otherwise(F.try_divide(2.0 * (tp * tn - fn * fp), (tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)))
    mi = F.col("m") / n + F.log(n)
    nmi = (F.when((F.col("ka") == 1) & (F.col("kb") == 1), 1.0).when(F.abs(mi) < 1e-15, 0.0)
           .otherwise(F.try_divide(mi, F.log(n) + (F.col("ha") + F.col("hb")) / n / 2.0)))
    return total.join(sa, key).join(sb, key).select(*key, n.cast("long").alias("n_cells"), ari.alias("ari"), nmi.alias("nmi"))


def per_type_accuracy(df: DataFrame, manual: str, auto: str) -> DataFrame:
    """For every label of either column (the union, so an unseen label
    cannot fail), the share of cells with that manual label that the
    automatic labelling agrees with (0 when it has no manual cells)."""
    labels = df.select(F.col(manual).alias("label")).union(df.select(F.col(auto).alias("label"))).distinct()
    per = df.groupBy(F.col(manual).alias("label")).agg(
        F.count(F.lit(1)).alias("n_manual"), F.count_if(F.col(manual) == F.col(auto)).alias("n_agree"))
    return (labels.join(per, "label", "left").fillna({"n_manual": 0, "n_agree": 0})
            .withColumn("accuracy", F.coalesce(F.try_divide(F.col("n_agree").cast("double"), F.col("n_manual")),
                                               F.lit(0.0))))


def confidence_filter(cells: DataFrame, conf_col: str = "confidence", threshold: float = 0.7) -> DataFrame:
    """Cells whose confidence is strictly above the threshold."""
    return cells.where(F.col(conf_col) > threshold)
