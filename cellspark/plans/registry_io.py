"""Registered queries of sources and sinks: the driver's tables are written in a source's
format below the checkpoint folder, read back, and returned; and of the neighbour
index and label transfer between two sets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import embed as EM
from ..operators import enrich as EN
from ..operators import graph as GR
from ..operators import labels as LB
from ..operators import neighbors as NB
from ..operators import qc as QC
from ..session import checkpoint_dir
from ..sources import io as IO
from . import pipeline as PL
from . import standin as SI
from .oracle import rnd, with_
from .oracle_sql import _DE_CTES, _DRUGS, _HVG, _UP50, _ora_sql, sql
from .registry import P, _bundle, _de, _hvg, _prep, _str_array, register, rounded


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


def _mtx(spark, sf_dir):
    folder = _folder(spark)
    b = _bundle(spark, sf_dir)
    IO.write_mtx_samples(f"{folder}/raw", b.counts, b.cells.select("cell_id", "sample"), b.genes)
    return folder


@register("read_mtx_samples")
def q_read_mtx_samples(spark, sf_dir):
    """The counts, a sample per nation, from MatrixMarket folders."""
    counts, _, _ = IO.read_mtx_samples(spark, f"{_mtx(spark, sf_dir)}/raw")
    return rounded(counts)


sql("read_mtx_samples", with_("counts", "cells") +
    f"""SELECT c.sample || '_' || CAST(x.cell_id AS VARCHAR) AS cell_id, CAST(x.gene_id AS VARCHAR) AS gene_id, {rnd('value')}
        FROM counts x JOIN cells c USING (cell_id)""")


@register("read_mtx_tables")
def q_read_mtx_tables(spark, sf_dir):
    """Cells and genes of the MatrixMarket folders, with the layout found."""
    folder = _mtx(spark, sf_dir)
    _, cells, genes = IO.read_mtx_samples(spark, f"{folder}/raw")
    rows = cells.select(F.lit("cell").alias("kind"), F.col("cell_id").alias("id"), F.concat_ws("/", "sample", "sample_type").alias("what"))
    rows = rows.unionByName(genes.select(F.lit("gene").alias("kind"), F.col("gene_id").alias("id"), F.concat_ws("/", "gene_symbol", "feature_type").alias("what")))
    return rows.withColumn("layout", F.lit(IO.detect_layout(spark, folder)))


sql("read_mtx_tables", with_("cells", "genes") + """
    SELECT 'cell' AS kind, sample || '_' || CAST(cell_id AS VARCHAR) AS id, sample || '/Unknown' AS what, '10x' AS layout FROM cells
    UNION ALL SELECT 'gene', CAST(gene_id AS VARCHAR), gene_symbol || '/' || feature_type, '10x' FROM genes""")


@register("read_dense_matrix")
def q_read_dense_matrix(spark, sf_dir):
    """S3: counts summed by segment as a wide CSV, a row per gene, read as long counts."""
    b = _bundle(spark, sf_dir)
    folder = _folder(spark)
    segments = [r[0] for r in b.cells.select("sample_type").distinct().orderBy("sample_type").collect()]  # the wide file's columns
    (b.counts.join(b.cells.select("cell_id", "sample_type"), "cell_id").groupBy("gene_id").pivot("sample_type", segments)
     .agg(F.sum("value")).fillna(0.0).write.csv(f"{folder}/expression_matrix.csv", header=True))
    return rounded(IO.read_dense_matrix(spark, f"{folder}/expression_matrix.csv", rows_are="genes"))


sql("read_dense_matrix", with_("counts", "cells") +
    """SELECT c.sample_type AS cell_id, CAST(x.gene_id AS VARCHAR) AS gene_id, round(SUM(x.value), 6) AS value
       FROM counts x JOIN cells c USING (cell_id) GROUP BY 1, 2 HAVING SUM(x.value) <> 0""")


@register("read_annotations")
def q_read_annotations(spark, sf_dir):
    """Annotations of the healthy cells joined to all cells; ``sample`` is there already."""
    cells = SI.standin_cells(spark, sf_dir)
    folder = _folder(spark)
    (cells.where("health_status = 'healthy'").select("cell_id", "region", F.lit("other").alias("sample"), F.col("sample_type").alias("cell_type"))
     .write.option("sep", "\t").csv(f"{folder}/annotations.tsv", header=True))
    return IO.read_annotations(spark, folder, cells.select("cell_id", "sample"))


sql("read_annotations", with_("cells") + """
    SELECT cell_id, sample, CASE WHEN health_status = 'healthy' THEN region END AS region,
           CASE WHEN health_status = 'healthy' THEN sample_type END AS cell_type FROM cells""")


@register("bundle_roundtrip")
def q_bundle_roundtrip(spark, sf_dir):
    """Counts of the bundle written and read, with the sample they are partitioned by."""
    b = _bundle(spark, sf_dir)
    folder = _folder(spark)
    IO.write_bundle(folder, b.counts, b.cells, b.genes)
    counts, cells, genes = IO.read_bundle(spark, folder)
    return rounded(counts.join(genes.select("gene_id", "gene_symbol"), "gene_id").join(cells.select("cell_id", "health_status"), "cell_id")
                   .select("cell_id", "gene_id", "value", F.col("sample").cast("string").alias("sample"), "gene_symbol", "health_status"))


sql("bundle_roundtrip", with_("counts", "cells", "genes") +
    f"SELECT x.cell_id, x.gene_id, {rnd('value')}, c.sample, g.gene_symbol, c.health_status FROM counts x JOIN cells c USING (cell_id) JOIN genes g USING (gene_id)")


@register("read_prefixed")
def q_read_prefixed(spark, sf_dir):
    """A file per market segment, the healthy one and two of the others read by prefix."""
    c = SI.standin_cells(spark, sf_dir)
    folder = _folder(spark)
    c.select("cell_id", "region", F.concat_ws("_", "sample_type", F.lit("1.csv")).alias("file")).write.partitionBy("file").csv(f"{folder}/_all", header=True)
    IO._rename(spark, [(f"{folder}/_all/{d}", f"{folder}/files/{d.removeprefix('file=')}") for d in IO._folders(spark, f"{folder}/_all")])
    return IO.read_prefixed(spark, f"{folder}/files", "BUILDING", ["AUTO", "MACH"]).withColumn("cell_id", F.col("cell_id").cast("long"))


sql("read_prefixed", with_("cells") + """
    SELECT cell_id, region, sample_type || '_1' AS sample_id,
           CASE WHEN sample_type = 'BUILDING' THEN 'healthy' ELSE left(sample_type, 4) END AS sample_type, health_status
    FROM cells WHERE sample_type = 'BUILDING' OR sample_type LIKE 'AUTO%' OR sample_type LIKE 'MACH%'""")


@register("write_de")
def q_write_de(spark, sf_dir):
    """Rows of each file that the marker table is written to, by group."""
    de, _ = _de(spark, sf_dir)
    folder = _folder(spark)
    IO.write_de(de, folder, P["padj"], 0.5, 50)
    parts = [IO.read_de(spark, folder, p, de.columns).groupBy("group").agg(F.count("*").alias("n"), F.round(F.max(F.col("score").cast("double")), 6).alias("top_score"))
             .withColumn("file", F.lit(p)) for p in ("all", "significant", "top50", "combined")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("file", "group", "n", "top_score")


sql("write_de", with_("ln", "kept_cells", "kept_genes", **_DE_CTES,
    r="SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS r FROM de",
    f="""SELECT unnest(['all', 'significant', 'top50', 'combined']) AS file, * FROM r""") +
    """SELECT file, grp AS "group", COUNT(*) AS n, round(MAX(score), 6) AS top_score FROM f
       WHERE file IN ('all', 'combined') OR file = 'top50' AND r <= 50 OR file = 'significant' AND padj < 0.999 AND logfc > 0.5 GROUP BY 1, 2""")


@register("write_json_results")
def q_write_json_results(spark, sf_dir):
    """The drug ranking as JSON, read back."""
    de, _ = _de(spark, sf_dir)
    folder = _folder(spark)
    IO.write_json_results(EN.rank_drugs(de, SI.standin_signatures(spark, sf_dir), 50), folder)
    d = spark.read.json(folder)
    return rounded(d.select("group", "drug", "overlap", _str_array(F.col("overlap_genes")).alias("overlap_genes"), "p_value"))


sql("write_json_results", with_("ln", "kept_cells", "kept_genes", **_DE_CTES, top=_UP50, **_ora_sql("top", _DRUGS, ["drug"])) +
    f"""SELECT grp AS "group", drug, overlap, overlap_genes, {rnd('p_value')} FROM ora""")


@register("export_ml")
def q_export_ml(spark, sf_dir):
    """Metadata and the five genes with the most counts, from the files for models."""
    b = _bundle(spark, sf_dir)
    folder = _folder(spark)
    top = [r[0] for r in b.counts.groupBy("gene_id").agg(F.sum("value").alias("s")).orderBy(F.col("s").desc(), "gene_id").limit(5).collect()]
    IO.export_ml(folder, b.cells, b.counts, top)
    wide = spark.read.csv(f"{folder}/expression_wide", header=True)
    long = wide.unpivot(["cell_id"], [c for c in wide.columns if c != "cell_id"], "gene_id", "value")
    meta = spark.read.csv(f"{folder}/cell_metadata", header=True).select("cell_id", "sample_type")
    n = spark.read.parquet(f"{folder}/expression_long").groupBy(F.col("cell_id").cast("string").alias("cell_id")).agg(F.count("*").alias("n_entries"))
    return rounded(long.join(meta, "cell_id").join(n, "cell_id").select(
        F.col("cell_id").cast("long"), F.col("gene_id").cast("long"), F.col("value").cast("double").alias("value"), "sample_type", "n_entries"))


sql("export_ml", with_("counts", "cells",
    top="SELECT gene_id FROM counts GROUP BY 1 ORDER BY SUM(value) DESC, gene_id LIMIT 5",
    has="SELECT DISTINCT cell_id FROM counts WHERE gene_id IN (SELECT gene_id FROM top)",
    n="SELECT cell_id, COUNT(*) AS n_entries FROM counts GROUP BY 1") +
    """SELECT h.cell_id, t.gene_id, round(COALESCE(x.value, 0.0), 6) AS value, c.sample_type, n.n_entries
       FROM has h CROSS JOIN top t LEFT JOIN counts x ON x.cell_id = h.cell_id AND x.gene_id = t.gene_id
       JOIN cells c ON c.cell_id = h.cell_id JOIN n ON n.cell_id = h.cell_id""")


@register("write_qc_metrics")
def q_write_qc_metrics(spark, sf_dir):
    """The before and after report as JSON, read back."""
    b, kept_cells, kept_genes, _, _ = _prep(spark, sf_dir, write=False)
    folder = _folder(spark)
    IO.write_qc_metrics(QC.before_after_report(b.cells, b.genes, kept_cells, kept_genes), folder)
    return rounded(spark.read.json(folder).select("axis", "before", "after", "removed", "pct_removed"))


sql("write_qc_metrics", with_("cells", "genes", "kept_cells", "kept_genes", ba="""
        SELECT 'cells' AS axis, (SELECT COUNT(*) FROM cells) AS before, (SELECT COUNT(*) FROM kept_cells) AS after
        UNION ALL SELECT 'genes', (SELECT COUNT(*) FROM genes), (SELECT COUNT(*) FROM kept_genes)""") +
    """SELECT axis, before, after, before - after AS removed,
              round(COALESCE((before - after) * 100.0 / NULLIF(before, 0), 0.0), 6) AS pct_removed FROM ba""")


@register("write_selected_genes")
def q_write_selected_genes(spark, sf_dir):
    """The selected genes, one per line, read back."""
    hvg, _ = _hvg(spark, sf_dir)
    folder = _folder(spark)
    IO.write_selected_genes(hvg, folder)
    return spark.read.text(folder).select(F.col("value").alias("gene_id"))


sql("write_selected_genes", with_("ln", "kept_cells", "kept_genes", **_HVG) + "SELECT CAST(gene_id AS VARCHAR) AS gene_id FROM hvg WHERE highly_variable")


@register("validate")
def q_validate(spark, sf_dir):
    """P10: the shape of the matrix, an error if it is empty."""
    b = SI.standin_bundle(spark, sf_dir)
    shape = QC.validate(b.counts, b.cells, b.genes)
    return spark.createDataFrame([(shape["nnz"], shape["n_cells"], shape["n_genes"])], "nnz long, n_cells long, n_genes long")


sql("validate", with_("counts", "cells", "genes") +
    "SELECT (SELECT COUNT(*) FROM counts) AS nnz, (SELECT COUNT(*) FROM cells) AS n_cells, (SELECT COUNT(*) FROM genes) AS n_genes")


# ------------------------------------------- neighbours: index, two sets, batches

@register("knn_index")
def q_knn_index(spark, sf_dir):
    """G3 by the index: 15 near neighbours of every embedded cell (rows-only check)."""
    return rounded(GR.knn(SI.standin_embeddings(spark, sf_dir).select("cell_id", "vec"), k=P["n_neighbors"], method="index"))


@register("knn_index_recall")
def q_knn_index_recall(spark, sf_dir):
    """Recall of the index against the exact search, over the whole table."""
    emb = SI.standin_embeddings(spark, sf_dir).select("cell_id", "vec")
    found = GR.knn(emb, k=P["n_neighbors"], method="index")
    return NB.recall(found, PL.materialize(GR.knn(emb, k=P["n_neighbors"]))).select("n_points", "n_links", (F.col("recall") >= 0.9).alias("recall_090"))


sql("knn_index_recall", "SELECT COUNT(*) AS n_points, CAST(SUM(LEAST(15, n - 1)) AS BIGINT) AS n_links, TRUE AS recall_090 "
                        "FROM (SELECT COUNT(*) OVER () AS n FROM embeddings)")


@register("transfer_labels_two_sets")
def q_transfer_labels_two_sets(spark, sf_dir):
    """L3: cells of the types 5 to 9 labelled by their 15 nearest among the cells of types
    0 to 4, a reference that does not hold their own type."""
    emb = SI.standin_embeddings(spark, sf_dir)
    reference, queries = emb.where("label < '5'"), emb.where("label >= '5'")
    edges = GR.knn_to_reference(queries.select("cell_id", "vec"), reference.select("cell_id", "vec"), k=P["n_neighbors"])
    return rounded(LB.transfer_labels_knn(edges, reference.select("cell_id", "label"), "label"))


_TWO = dict(
    e="SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS vec, CAST(label AS VARCHAR) AS label FROM embeddings",
    d="""SELECT q.cell_id AS src, r.cell_id AS dst, r.label, list_distance(q.vec, r.vec) AS dist
         FROM e q JOIN e r ON q.label >= '5' AND r.label < '5'""",
    kn="SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM d) WHERE rank <= 15",
    v="SELECT src, label, COUNT(*) AS n, SUM(dist) AS sd FROM kn GROUP BY 1, 2",
    vr="SELECT *, SUM(n) OVER (PARTITION BY src) AS tot, ROW_NUMBER() OVER (PARTITION BY src ORDER BY n DESC, sd, label) AS r FROM v")
sql("transfer_labels_two_sets", with_(**_TWO) + "SELECT src AS cell_id, label AS predicted_celltype, round(n * 1.0 / tot, 6) AS score FROM vr WHERE r = 1")


@register("batch_center")
def q_batch_center(spark, sf_dir):
    """The centring of batches, on the embedded cells with their label as batch."""
    emb = SI.standin_embeddings(spark, sf_dir)
    out = EM.batch_center(emb.select("cell_id", "vec"), emb.select("cell_id", "label"), "label")
    return rounded(out.select("cell_id", F.posexplode("vec").alias("dim", "value")))


sql("batch_center", """WITH e AS (SELECT vec_id AS cell_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
    SELECT cell_id, CAST(dim AS INTEGER) AS dim, round(x - AVG(x) OVER (PARTITION BY label, dim), 6) AS value FROM e""")
