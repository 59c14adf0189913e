"""Sources and sinks.

Everything is read and written by Spark's own readers and writers; the
driver only lists directories (S2) and names files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import running

BUNDLE_TABLES = ("counts", "cells", "genes")


# --------------------------------------------------------------- S1 / S2

def list_files(spark: SparkSession, data_dir: str, pattern: str = "*") -> list[str]:
    """Paths of all files below a folder whose names match a glob pattern, listed by
    Spark, so in any store that Spark reads.  No file content is read."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .load(data_dir).select("path"))
    return sorted(r["path"] for r in found.collect())


#: The files of a sample, and a path's sample; a file may be a folder of part files.
_MTX = ("matrix.mtx", "barcodes.tsv", "genes.tsv", "features.tsv")
_SAMPLE = r"(?<![^/])([^/]++)/[^/]+\.(?:tsv|mtx)(?:\.gz)?(?:/[^/]+)?$"


def _units(paths: list[str], is_unit) -> list[str]:
    """The paths, those inside a folder that is itself a file's name by that folder."""
    return sorted({p.rsplit("/", 1)[0] if is_unit(p.split("/")[-2]) else p for p in paths})


def _by_folder(paths: list[str], names: list[str]) -> dict[str, str]:
    """folder -> its file of the first of ``names`` that it has."""
    out: dict[str, str] = {}
    for n in reversed(names):
        out |= {p[:-len(n) - 1]: p for p in paths if p.endswith("/" + n)}
    return out


def _sample():
    return F.regexp_extract(F.url_decode(F.input_file_name()), _SAMPLE, 1)


def _place():
    """A line's place: part file, split of the file, row of the split."""
    return F.input_file_name().alias("_f"), F.input_file_block_start().alias("_b"), F.monotonically_increasing_id().alias("_i")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(sample, line number from 1, value) of the lines of one file per sample, its
    folder's name.  Lines are numbered by their place in sorted ranges, so the splits of
    a large file, and its lines, are spread over tasks."""
    df = spark.read.text(paths).select("value", _sample().alias("sample"), *_place())
    return running(df, ["sample"], [F.col("_f"), F.col("_b"), F.col("_i")], out_col="idx").select("sample", "idx", "value")


def read_mtx_samples(spark: SparkSession, data_dir: str, samples: list[str] | None = None):
    """10x MatrixMarket samples -> (counts, cells, genes).

    Each sample folder holds matrix.mtx[.gz] (genes x cells, 1-based,
    '%' comment lines and one dimension line), barcodes.tsv[.gz] and
    genes.tsv[.gz] or features.tsv[.gz].  Missing folders or files are
    skipped with a warning; none valid -> ValueError.  All samples are read by one
    scan per kind of file; a file larger than a split is several tasks, and each
    may be a folder of part files, as :func:`write_mtx_samples` writes it.  Cell ids are sample_barcode; gene ids are the
    feature ids; sample_type follows from the sample's name (P1)."""
    from ..operators.cleaning import sample_type_of
    paths = _units(list_files(spark, data_dir), lambda name: name in _MTX)
    mtx = _by_folder(paths, ["matrix.mtx", "matrix.mtx.gz"])
    bc = _by_folder(paths, ["barcodes.tsv", "barcodes.tsv.gz"])
    ft = _by_folder(paths, ["genes.tsv", "genes.tsv.gz", "features.tsv", "features.tsv.gz"])
    name = {d: d.rsplit("/", 1)[-1] for d in {*mtx, *bc, *ft}}
    whole = sorted(d for d in name if d in mtx and d in bc and d in ft and (samples is None or name[d] in samples))
    for s in sorted(set(samples if samples is not None else name.values()) - {name[d] for d in whole}):
        print(f"warning: skipping sample {s}: missing files")
    if not whole:
        raise ValueError(f"{data_dir} holds no complete sample")
    # the first line that is no comment, by its place in the file, has the dimensions
    raw = (spark.read.text([mtx[d] for d in whole]).select("value", _sample().alias("sample"), F.struct(*_place()).alias("_at"))
           .where(~F.col("value").startswith("%") & (F.length(F.trim("value")) > 0)))
    head = raw.groupBy("sample").agg(F.min("_at").alias("_first"))  # one row per sample
    t = F.split(F.trim("value"), r"\s+")
    trip = raw.join(head, "sample").where(F.col("_at") != F.col("_first")).select(
        "sample", t[0].cast("long").alias("row"), t[1].cast("long").alias("col"), t[2].cast("double").alias("value"))
    bcs = _lines(spark, [bc[d] for d in whole]).select(
        "sample", F.col("idx").alias("col"), F.concat_ws("_", "sample", F.split("value", "\t")[0]).alias("cell_id"))
    part = F.split("value", "\t")
    fts = _lines(spark, [ft[d] for d in whole]).select(
        "sample", F.col("idx").alias("row"), part[0].alias("gene_id"), F.coalesce(F.get(part, F.lit(1)), part[0]).alias("gene_symbol"),
        F.coalesce(F.get(part, F.lit(2)), F.lit("Gene Expression")).alias("feature_type"))
    counts = (trip.where(F.col("value") != 0).join(bcs, ["sample", "col"]).join(fts.select("sample", "row", "gene_id"), ["sample", "row"])
              .select("cell_id", "gene_id", "value"))
    cells = bcs.select("cell_id", "sample", sample_type_of(F.col("sample")).alias("sample_type"))
    genes = fts.groupBy("gene_id").agg(F.min(F.struct("gene_symbol", "feature_type")).alias("g")).select("gene_id", "g.*")
    return counts, cells, genes


def _rename(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Give folders or files another name in the store they are in."""
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    for old, new in moves:
        fs = path(old).getFileSystem(conf)
        fs.mkdirs(path(new).getParent())
        if not fs.rename(path(old), path(new)):
            raise OSError(f"cannot rename {old} to {new}")


def _folders(spark: SparkSession, path: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at) if f.isDirectory()]


def _with_samples(genes: DataFrame, samples: DataFrame) -> DataFrame:
    """Every gene for every sample.  The samples, one row each, are sent to the genes, so
    neither the genes nor the pairs pass through the driver."""
    return genes.crossJoin(F.broadcast(samples))


def write_mtx_samples(path: str, counts: DataFrame, cells: DataFrame, genes: DataFrame) -> None:
    """The layout that S1 reads: per sample matrix.mtx, barcodes.tsv and features.tsv,
    each a folder of part files in order, so no sample is one task.  ``cells`` has cell_id and
    sample, ``genes`` gene_id, gene_symbol and feature_type."""
    spark = counts.sparkSession
    bc = running(cells.select("sample", F.col("cell_id")), ["sample"], [F.col("cell_id")], out_col="col")
    ft = running(genes.select("gene_id", "gene_symbol", "feature_type"), [], [F.col("gene_id")], out_col="row")
    entries = counts.where("value <> 0").join(bc, "cell_id").join(ft.select("gene_id", "row"), "gene_id")
    size = bc.groupBy("sample").agg(F.count("*").alias("nc")).join(entries.groupBy("sample").agg(F.count("*").alias("nnz")), "sample", "left")
    head = size.select("sample", F.explode(F.array(
        F.struct(F.lit(0).alias("o"), F.lit("%%MatrixMarket matrix coordinate real general").alias("value")),
        F.struct(F.lit(1).alias("o"), F.concat_ws(" ", ft.agg(F.count("*")).scalar().cast("string"), "nc", F.coalesce("nnz", F.lit(0))).alias("value")))).alias("x"))
    zero = F.lit(0).cast("long")
    matrix = head.select("sample", "x.o", zero.alias("col"), zero.alias("row"), "x.value").unionByName(
        entries.select("sample", F.lit(2).alias("o"), "col", "row", F.concat_ws(" ", "row", "col", F.col("value").cast("string")).alias("value")))
    barcodes = bc.select("sample", F.lit(0).alias("o"), "col", zero.alias("row"), F.col("cell_id").cast("string").alias("value"))
    features = (_with_samples(ft, size.select("sample"))
                .select("sample", F.lit(0).alias("o"), zero.alias("col"), "row", F.concat_ws("\t", "gene_id", "gene_symbol", "feature_type").alias("value")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for kind, lines in (("matrix.mtx", matrix), ("barcodes.tsv", barcodes), ("features.tsv", features)):
        place = ["sample", "o", "col", "row"]
        (lines.repartitionByRange(n, *place).sortWithinPartitions(*place).select("sample", "value")
         .write.partitionBy("sample").text(f"{path}/_{kind}"))
        _rename(spark, [(f"{path}/_{kind}/{d}", f"{path}/{d.removeprefix('sample=')}/{kind}") for d in _folders(spark, f"{path}/_{kind}")])  # one per sample


def detect_layout(spark: SparkSession, data_dir: str) -> str:
    """S2: '10x' when raw/*/matrix.mtx[.gz] exists; 'processed' for
    data.h5ad, data.h5 or expression_matrix.csv/.tsv; else ValueError."""
    paths = _units(list_files(spark, data_dir), lambda name: name in _MTX)
    if any(p.split("/")[-3:-2] == ["raw"] and p.rsplit("/", 1)[-1] in ("matrix.mtx", "matrix.mtx.gz") for p in paths):
        return "10x"
    top = {p.rsplit("/", 1)[-1] for p in paths}
    if top & {"data.h5ad", "data.h5", "expression_matrix.csv", "expression_matrix.tsv"}:
        return "processed"
    raise ValueError(f"unrecognised data layout in {data_dir}")


# ------------------------------------------------------------ S3 / S4 / S6

def read_dense_matrix(spark: SparkSession, path: str, sep: str = ",", rows_are: str = "cells") -> DataFrame:
    """S3: a wide CSV/TSV matrix (first column = row names) as a long
    counts table without zeros.  rows_are='genes' transposes (the labeller's
    layout)."""
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=True)
    key = df.columns[0]
    value_cols = df.columns[1:]
    long = df.unpivot([key], value_cols, "_col", "value").where(F.col("value") != 0)
    if rows_are == "cells":
        return long.select(F.col(key).cast("string").alias("cell_id"), F.col("_col").alias("gene_id"),
                           F.col("value").cast("double"))
    return long.select(F.col("_col").alias("cell_id"), F.col(key).cast("string").alias("gene_id"),
                       F.col("value").cast("double"))


def read_annotations(spark: SparkSession, data_dir: str, cells: DataFrame) -> DataFrame:
    """The first of cell_annotations.csv, metadata.csv, annotations.tsv
    (separator from the extension), first column = cell id; only columns
    the cell table lacks are added, by left join."""
    names = ("cell_annotations.csv", "metadata.csv", "annotations.tsv")
    paths = _units(list_files(spark, data_dir), lambda name: name in names)
    named = [p for n in names for p in paths if p.endswith("/" + n)]
    if not named:
        return cells
    p = named[0]
    ann = spark.read.csv(p, sep="\t" if p.endswith(".tsv") else ",", header=True)
    key = ann.columns[0]
    new = [c for c in ann.columns[1:] if c not in cells.columns]
    return cells.join(ann.select(F.col(key).alias("cell_id"), *new), "cell_id", "left")


def read_prefixed(spark: SparkSession, data_dir: str, healthy_prefix: str, case_prefixes: list[str],
                  fmt: str = "csv") -> DataFrame:
    """The files of a folder whose names begin with one of the prefixes; sample_id =
    stem of the file, or of a folder of part files; a healthy file has sample_type and health_status 'healthy', another
    the prefix as its type and 'leukemia'.  Files of other names are not read; no
    file of any prefix -> ValueError.  Returns the rows with these columns added."""
    prefixes = [healthy_prefix, *case_prefixes]
    paths = _units(list_files(spark, data_dir), lambda name: name.startswith(tuple(prefixes)))
    paths = [p for p in paths if p.rsplit("/", 1)[-1].startswith(tuple(prefixes))]
    if not paths:
        raise ValueError(f"{data_dir} holds no file that begins with {', '.join(prefixes)}")
    df = spark.read.format(fmt).option("header", True).load(paths)
    begins = "|".join(re.escape(p) for p in prefixes)
    stem = F.regexp_extract(F.url_decode(F.input_file_name()), rf"/((?:{begins})[^/]*?)(?:\.[^./]+)*(?:/[^/]+)?$", 1)
    kind = F.when(stem.startswith(healthy_prefix), F.lit("healthy"))
    for c in case_prefixes:
        kind = kind.when(stem.startswith(c), F.lit(c))
    return (df.withColumn("sample_id", stem).withColumn("sample_type", kind)
            .withColumn("health_status", F.when(F.col("sample_type") == "healthy", "healthy").otherwise("leukemia")))


# ---------------------------------------------------------------- S5 bundle

def write_bundle(path: str, counts: DataFrame, cells: DataFrame, genes: DataFrame, mode: str = "overwrite") -> None:
    """One Parquet table per part; counts carry ``sample`` and are
    partitioned by it so a read of some samples prunes the others."""
    cells.write.mode(mode).parquet(f"{path}/cells")
    genes.write.mode(mode).parquet(f"{path}/genes")
    c = counts.join(cells.select("cell_id", "sample"), "cell_id") if "sample" not in counts.columns else counts
    c.write.mode(mode).partitionBy("sample").parquet(f"{path}/counts")


def read_bundle(spark: SparkSession, path: str):
    """(counts, cells, genes) from :func:`write_bundle`."""
    return (spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/cells"),
            spark.read.parquet(f"{path}/genes"))


# ------------------------------------------------------------- S7-S10 sinks

def write_de(de: DataFrame, path: str, padj: float = 0.05, logfc: float = 0.5, top: int = 50) -> None:
    """Per group all genes, the significant ones and the top 50 (CSV,
    partitioned by group), plus everything in one table keyed by group."""
    de.write.mode("overwrite").partitionBy("group").csv(f"{path}/all", header=True)
    de.where((F.col("padj") < padj) & (F.col("logfc") > logfc)) \
        .write.mode("overwrite").partitionBy("group").csv(f"{path}/significant", header=True)
    w = Window.partitionBy("group").orderBy(F.col("score").desc(), F.col("gene_id"))
    de.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top) \
        .write.mode("overwrite").partitionBy("group").csv(f"{path}/top{top}", header=True)
    de.write.mode("overwrite").csv(f"{path}/combined", header=True)


def read_de(spark: SparkSession, path: str, part: str, columns: list[str]) -> DataFrame:
    """One file of :func:`write_de` as strings; ``columns`` are those of the written
    table, so a file to which no row came is an empty table."""
    names = [*columns, "rank"] if part.startswith("top") else list(columns)
    return spark.read.schema(", ".join(f"`{c}` string" for c in names)).csv(f"{path}/{part}", header=True)


def write_json_results(df: DataFrame, path: str) -> None:
    """Enrichment / drug tables as JSON lines (arrays kept as arrays)."""
    df.write.mode("overwrite").json(path)


def export_ml(path: str, cells: DataFrame, counts: DataFrame, genes_of_interest: list | None = None,
              max_pivot: int = 1000) -> None:
    """Cell metadata CSV; expression as long Parquet, and a wide CSV only
    for an explicitly requested gene list (at most ``max_pivot`` genes)."""
    cells.write.mode("overwrite").csv(f"{path}/cell_metadata", header=True)
    counts.write.mode("overwrite").parquet(f"{path}/expression_long")
    if genes_of_interest:
        if len(genes_of_interest) > max_pivot:
            raise ValueError("too many genes for a wide export")
        (counts.where(F.col("gene_id").isin(*genes_of_interest)).groupBy("cell_id")
         .pivot("gene_id", list(genes_of_interest)).agg(F.first("value")).fillna(0.0)
         .write.mode("overwrite").csv(f"{path}/expression_wide", header=True))


def write_qc_metrics(report: DataFrame, path: str) -> None:
    """The before/after report as JSON."""
    report.write.mode("overwrite").json(path)


def write_selected_genes(hvg: DataFrame, path: str, flag: str = "highly_variable") -> None:
    """The selected gene ids, one per line."""
    hvg.where(F.col(flag)).select(F.col("gene_id").cast("string")).write.mode("overwrite").text(path)
