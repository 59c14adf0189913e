"""Projections, predicates and cleaning."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .numbering import running

# Sample-name prefixes and the subtype each denotes, in the
# reference's order; the first matching prefix wins.
SAMPLE_TYPE_RULES = (
    ("ETV6-RUNX1", "ETV6-RUNX1"),
    ("HHD", "HHD"),
    ("PRE-T", "PRE-T"),
    ("PBMMC", "PBMMC"),
)
# The file-name variant matches by substring, has no PBMMC
# rule and a lower-case default.
FILE_TYPE_RULES = (
    ("ETV6-RUNX1", "ETV6-RUNX1"),
    ("HHD", "HHD"),
    ("PRE-T", "PRE-T"),
)
HEALTHY_TYPE = "PBMMC"


def sample_type_of(name, rules=SAMPLE_TYPE_RULES, default: str = "Unknown",
                   match: str = "startswith"):
    """Subtype from a sample name; ``match`` is 'startswith' or 'contains'."""
    c = F.col(name) if isinstance(name, str) else name
    out = F.lit(default)
    for pat, label in reversed(rules):
        cond = c.startswith(pat) if match == "startswith" else c.contains(pat)
        out = F.when(cond, F.lit(label)).otherwise(out)
    return out


def health_status_of(sample_type, healthy_types=(HEALTHY_TYPE,)):
    """Healthy for the healthy types, leukemia otherwise."""
    c = F.col(sample_type) if isinstance(sample_type, str) else sample_type
    return F.when(c.isin(*healthy_types), F.lit("healthy")).otherwise(F.lit("leukemia"))


def fill_required(cells: DataFrame, columns=("sample", "sample_type"), value: str = "unknown") -> DataFrame:
    """Add absent required columns as a constant."""
    for c in columns:
        if c not in cells.columns:
            cells = cells.withColumn(c, F.lit(value))
    return cells


def make_unique(df: DataFrame, name_col: str, order_col: str, out_col: str | None = None,
                sep: str = "-") -> DataFrame:
    """The first row of a name (in ``order_col`` order) keeps it; its k-th
    repeat becomes name-n with the k-th positive number n for which name-n is
    not itself an original name, so the result holds no duplicates.  Null names
    stay null.

    The numbers taken for a name are those of the originals that end in -number;
    if t_1 < t_2 < ... are taken, the k-th free one is k + #{i: t_i - i < k}.  Copies are
    numbered, and taken numbers counted against them, in sorted ranges
    (:func:`numbering.running`): no name's copies or numbers meet in one row or task."""
    out_col = out_col or name_col
    tail = f"^(.*){re.escape(sep)}([1-9][0-9]{{0,17}})$"
    name = F.col(name_col).cast("string")
    row = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    named = df.select(*[F.col(f"`{c}`").alias(r) for c, r in row.items()], name.alias("_name"))
    placed = running(named, ["_name"], [F.col(row[order_col])], out_col="_k").withColumn("_k", F.when(F.col("_name").isNull(), 0).otherwise(F.col("_k") - 1))
    base, number = F.regexp_extract("_name", tail, 1), F.regexp_extract("_name", tail, 2)
    taken = named.where(F.col("_name").rlike(tail)).select(base.alias("_base"), number.cast("long").alias("_t")).distinct()
    gaps = running(taken, ["_base"], [F.col("_t")], out_col="_i").select(F.col("_base").alias("_name"), (F.col("_t") - F.col("_i")).alias("_at"))
    # the k-th copy skips the taken numbers with fewer than k free ones below them
    copies = placed.where("_k > 0").select("_name", F.col("_k").alias("_at"), F.lit(0).cast("long").alias("_one"))
    both = copies.unionByName(gaps.withColumn("_one", F.lit(1).cast("long")))
    skipped = (running(both, ["_name"], [F.col("_at"), F.col("_one")], sums={"_skip": "_one"}, out_col="_place")
               .where("_one = 0").select("_name", F.col("_at").alias("_k"), "_skip"))
    joined = placed.join(skipped, ["_name", "_k"], "left")
    out = F.when(F.col("_k") == 0, F.col("_name")).otherwise(F.concat_ws(sep, "_name", (F.col("_k") + F.coalesce("_skip", F.lit(0))).cast("string")))
    kept = [F.col(r).alias(c) for c, r in row.items() if c != out_col]
    if out_col not in df.columns:
        return joined.select(*kept, out.alias(out_col))
    return joined.select(*[out.alias(c) if c == out_col else F.col(r).alias(c) for c, r in row.items()])


def drop_null_labels(cells: DataFrame, label_col: str) -> DataFrame:
    """Remove cells whose label is null."""
    return cells.dropna(subset=[label_col])


def subset_cells(counts: DataFrame, cells: DataFrame, predicate) -> tuple[DataFrame, DataFrame]:
    """Keep cells matching ``predicate`` in both tables (semi join)."""
    kept = cells.where(predicate)
    return counts.join(kept.select("cell_id"), "cell_id", "left_semi"), kept


def has_symbols(genes: DataFrame, id_col: str = "gene_symbol", n: int = 10) -> bool:
    """True when any of the first ``n`` ids (in id order) contains a
    letter, i.e. the ids already are symbols."""
    first = genes.select(id_col).orderBy(id_col).limit(n)
    return first.where(F.col(id_col).cast("string").rlike("[A-Za-z]")).limit(1).count() > 0


def map_symbols(genes: DataFrame, mapping: DataFrame | None = None, id_col: str = "gene_id",
                width: int = 4, prefix: str = "GENE_") -> DataFrame:
    """Symbol for each id from ``mapping`` (gene_id, symbol); ids with
    no mapping keep a placeholder: a numeric id becomes GENE_%04d, any
    other id is kept as it is."""
    idc = F.col(id_col).cast("string")
    placeholder = F.when(idc.rlike("^[0-9]+$"),
                         F.concat(F.lit(prefix), F.lpad(idc, width, "0"))).otherwise(idc)
    out = genes
    if mapping is not None:
        out = out.join(mapping.select(F.col("gene_id").alias(id_col), F.col("symbol").alias("_sym")),
                       id_col, "left")
        return out.withColumn("mapped_symbol", F.coalesce(F.col("_sym"), placeholder)).drop("_sym")
    return out.withColumn("mapped_symbol", placeholder)
