"""Build the single-cell data model from the driver's tables.

The test data has no count matrix, so the bundle is derived (see SURVEY
section 5.1):

* ``counts``  = lineitem joined to orders, summed per (o_custkey, l_partkey)
* ``cells``   = customer: sample = nation, sample_type = market segment,
  health_status = healthy for the BUILDING segment, region = second labelling
* ``genes``   = part: gene_symbol = p_name (not unique), "mito" = Brand#1
* gene sets   = (p_type, p_partkey) and (p_brand, p_partkey)
* signatures  = distinct (l_suppkey, l_partkey) as (drug, gene)
* embeddings  = the embeddings table (manual label = its ``label``)

All of it is lazy: nothing is read until an action runs, and every
derived table grows with the inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Thresholds shrunk to the size of the stand-in data.
STANDIN_PARAMS = {
    "min_genes": 20,
    "min_cells": 3,
    "max_pct_mt": 8.013,   # removes about a tenth of the cells
    "padj": 0.999,         # the groups are random: a cut that splits the genes
    "n_top_genes": 200,
    "n_neighbors": 15,
    "enrich_top": 100,
    "healthy_segment": "BUILDING",
    "mito_brand": "Brand#1",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Bundle:
    """The annotated matrix as long tables."""

    counts: DataFrame   # cell_id, gene_id, value (zeros absent)
    cells: DataFrame    # cell_id, sample, sample_type, health_status, ...
    genes: DataFrame    # gene_id, gene_symbol, feature_type, is_mt

    def with_counts(self, counts: DataFrame) -> "Bundle":
        return Bundle(counts, self.cells, self.genes)


def standin_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"))
            .agg(F.sum("l_quantity").alias("value"))
            .where(F.col("value") != 0))


def standin_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation and region are fixed 25- and 5-row dimension tables
    reg = F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))
    return (c.join(reg, c.c_nationkey == reg.n_nationkey, "left")
            .select(F.col("c_custkey").alias("cell_id"),
                    F.col("c_nationkey").cast("string").alias("sample"),
                    F.col("c_mktsegment").alias("sample_type"),
                    F.when(F.col("c_mktsegment") == STANDIN_PARAMS["healthy_segment"], "healthy")
                     .otherwise("leukemia").alias("health_status"),
                    F.col("r_name").alias("region")))


def standin_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("gene_id"),
                    F.col("p_name").alias("gene_symbol"),
                    F.lit("Gene Expression").alias("feature_type"),
                    (F.col("p_brand") == STANDIN_PARAMS["mito_brand"]).alias("is_mt"))


def standin_bundle(spark: SparkSession, sf_dir: str) -> Bundle:
    return Bundle(standin_counts(spark, sf_dir), standin_cells(spark, sf_dir),
                  standin_genes(spark, sf_dir))


def standin_gene_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(library, term, gene): part types and brands as two libraries."""
    p = read_table(spark, sf_dir, "part")
    by_type = p.select(F.lit("TYPE").alias("library"), F.col("p_type").alias("term"),
                       F.col("p_partkey").alias("gene"))
    by_brand = p.select(F.lit("BRAND").alias("library"), F.col("p_brand").alias("term"),
                        F.col("p_partkey").alias("gene"))
    return by_type.unionByName(by_brand)


def standin_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(drug, gene): suppliers as perturbations of the parts they supply."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("drug"), F.col("l_partkey").alias("gene")).distinct()


def standin_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell_id, vec ARRAY<DOUBLE>, label STRING)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("cell_id"),
                    F.col("embedding").cast("array<double>").alias("vec"),
                    F.col("label").cast("string").alias("label"))
