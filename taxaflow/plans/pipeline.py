"""The five parts as functions from DataFrames to DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from taxaflow.operators import barcodes, cluster, derep, hits, mapping, reads, report, table, taxonomy
from taxaflow.plans.config import Params


def preprocess(raw: DataFrame, sample_map: DataFrame, mismatches: int = 0) -> DataFrame:
    """Reads with barcodes rewritten to the map's where one of them alone is nearest."""
    if not mismatches:
        return raw
    counts = reads.barcode_counts(raw)
    found = barcodes.collisions(counts, sample_map, mismatches)
    return barcodes.apply_rescue(raw, barcodes.rescue_pairs(found, counts, list(range(1, mismatches + 1)), keep_larger=True))


def demux(raw: DataFrame, sample_map: DataFrame, lengths: list[int] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Reads by sample, and error statistics at the lengths."""
    own = reads.demultiplex(raw, sample_map)
    return own, reads.error_statistics(own, lengths) if lengths else None


@dataclass
class Units:
    table: DataFrame
    seqs: DataFrame
    mapped: DataFrame | None = None


def make_units(uniques: DataFrame, p: Params, by: tuple[str, ...] = ()) -> DataFrame:
    found = cluster.cluster(uniques, p.identity, p.smallest, by=by) if p.algorithm == "UPARSE" else cluster.denoise(uniques, p.alpha, p.smallest, by=by)
    return cluster.centroids(found, by)


def unit_table(pool: DataFrame, p: Params, *, spike: DataFrame | None = None, sample_map: DataFrame | None = None, known: DataFrame | None = None) -> Units:
    """Units from quality-filtered reads, counts from all reads of full length."""
    pool = reads.truncate(pool, p.length) if p.length else pool
    pool = reads.drop_matching(pool, spike) if spike is not None else pool
    pool = reads.drop_runs(pool)
    fine = reads.filter_errors(pool, p.max_ee)
    fine = reads.filter_unknown(fine, p.max_n) if p.max_n is not None else fine
    if p.strategy == 3:
        ft, seqs = mapping.known_then_new(pool, fine, known, lambda u: make_units(u, p), p.identity, p.known_identity)
        return Units(ft, seqs)
    if p.strategy == 2:
        seeds = None
        for column in p.group_columns:
            one = mapping.seeds_by_group(fine, sample_map, column, lambda u: make_units(u, p, ("group",)))
            seeds = one if seeds is None else seeds.unionByName(one)
        seqs = derep.merge_identical(seeds)
    else:
        seqs = make_units(derep.uniques(fine), p)
    mapped = mapping.map_reads(pool, seqs, p.identity)
    ft = table.count_table(mapped)
    if p.strategy == 2:
        named = derep.add_counts(seqs, table.totals_by_unit(ft), relabel="m", typ="Otu" if p.algorithm == "UPARSE" else "Asv")
        ft = ft.join(named.selectExpr("id as tu_id", "label"), "tu_id").selectExpr("label as tu_id", "sample_id", "n")
        seqs = named.selectExpr("label as id", "seq", "rank as ord")
    return Units(ft, seqs, mapped)


def assign_taxonomy(found: DataFrame, queries: DataFrame, lineages: DataFrame, env: DataFrame | None = None, mode: str = "reference") -> DataFrame:
    """Lowest common ancestors of the best hits, without environmental ones."""
    found = hits.drop_taxids(found, env) if env is not None else found
    return taxonomy.clean_ids(taxonomy.assign_lca(hits.top_hits(found, queries), lineages, mode), "qseqid")


def publish(ft: DataFrame, tax: DataFrame, *, keep: DataFrame | None = None, exclude: list[str] | None = None, levels: tuple[int, ...] = (2, 6, 7), domains: bool = False, seqs: DataFrame | None = None) -> dict[str, DataFrame]:
    """The published tables by name: counts and shares as they are and collapsed to the levels."""
    tax = tax.withColumnRenamed("qseqid", "tu_id")
    ft = table.exclude_taxa(ft, tax, exclude) if exclude else ft
    ft = table.keep_units(ft, keep) if keep is not None else ft
    lineages = tax.selectExpr("tu_id", "split(taxonomy, ';') as lineage")
    rel = table.normalize(ft).select("tu_id", "sample_id", "rel")
    out = {"raw": table.add_metadata(ft, tax), "norm": table.add_metadata(rel, tax)}
    for level in levels:
        out[f"raw_L{level}"] = table.collapse(ft, lineages, level)
        out[f"norm_L{level}"] = table.collapse(rel, lineages, level, "rel")
    if domains:
        out |= {f"norm_{k}": t for k, t in table.split_domains(rel, tax).items()}
    if seqs is not None:
        out["detailed"] = report.taxonomy_summary(rel, seqs, tax.withColumnRenamed("tu_id", "qseqid"))
    return out
