"""Candidate documents: hits of several phrase queries as one table, and what is still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.ids import blank, padded
from .relational import keep_first, ordered, split_by, tagged_union, text_set, without_done


def document_key() -> Column:
    """A hit's document within its filing; hits without a name stand for one of their own."""
    return F.coalesce("primary_doc", F.concat("adsh", F.lit(":<none>")))


def candidate_union(variants: dict[str, DataFrame]) -> DataFrame:
    """One row for each (adsh, document) over all variants of a phrase: the fields of the hit of the
    earliest variant, and the names of all variants that hit it, sorted and joined by bars."""
    hits = tagged_union(variants, "variant", missing=True).withColumn("_document", document_key())
    order = ["variant_order", "file_date", "form", "file_type", "snippet"]
    fields = [c for c in hits.columns if c not in ("adsh", "variant", "variant_order", "_document")]
    first = F.min_by(F.struct(*fields), ordered(*order)).alias("_first")
    return hits.groupBy("adsh", "_document").agg(first, text_set("variant").alias("phrase_variants_matched")).select("adsh", "_first.*", "phrase_variants_matched")


def of_type(candidates: DataFrame, pattern: str = R.EXHIBIT_TYPE) -> tuple[DataFrame, DataFrame]:
    """Candidates of a file type, and counts of the types that go."""
    kept, gone = split_by(candidates, R.exhibit_type("file_type", pattern))
    return kept, gone.groupBy("file_type").agg(F.count("*").alias("n"))


def query_union(queries: dict[str, DataFrame], key: str = "adsh") -> DataFrame:
    """One row a key over all queries, that of the earliest one, with source."""
    rows = tagged_union(queries, "source", missing=True)
    ties = [c for c in ("cik", "primary_doc", "form") if c in rows.columns]
    return keep_first(rows, [key], ["source_order", "file_date", *ties]).drop("source_order")


def net_new(query: DataFrame, others: list[DataFrame], keys: list[str] = ("adsh", "primary_doc")) -> DataFrame:
    """Distinct keys that only this query finds."""
    keys = list(keys)
    own = query.select(*keys).distinct()
    for other in others:
        seen = other.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        condition = [own[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
        own = own.join(seen, condition, "left_anti")
    return own


def completeness(expected: DataFrame, done: DataFrame, forms: list[str], keys: list[str]) -> DataFrame:
    """By form: rows that are expected, done and missing."""
    own = expected.where(F.col("form").isin(forms))
    known = done.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    joined = own.join(known, [own[k] == F.col(f"_{k}") for k in keys], "left")
    there = F.col(f"_{keys[0]}").isNotNull()
    return joined.groupBy("form").agg(F.count("*").alias("n_expected"), F.count_if(there).alias("n_done"), F.count_if(~there).alias("n_missing"))


def appended(old: DataFrame, new: DataFrame, keys: list[str] = ("adsh", "primary_doc")) -> DataFrame:
    """Old rows and those of new whose keys old lacks; columns that one side lacks are null."""
    return keep_first(tagged_union({"old": old, "new": new}, "_from", missing=True), list(keys), ["_from_order", "file_date"]).drop("_from", "_from_order")


def manifest(candidates: DataFrame) -> DataFrame:
    """What is to be fetched: blank, never null."""
    names = {"cik": padded(F.get("ciks", F.lit(0))), "accession": F.col("adsh"), "filename": F.col("primary_doc"), "file_type": F.col("file_type"), "filing_date": F.col("file_date"), "form": F.col("form"), "phrase_variants_matched": F.col("phrase_variants_matched")}
    return candidates.select(*[blank(c).alias(n) for n, c in names.items()])


def to_fetch(expected: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return without_done(expected, done, keys)


def per_entity(queries: dict[str, DataFrame], forms: list[str], new: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(union of an entity's queries, one row an accession; documents that only the query named new
    finds; accessions by cik, source and form). queries: rows with cik and the fields of a hit."""
    union = query_union({q: df.where(F.col("form").isin(forms)) for q, df in queries.items()}, "adsh")
    fresh = net_new(queries[new], [df for q, df in queries.items() if q != new])
    return union, fresh, union.groupBy("cik", "source", "form").agg(F.count_distinct("adsh").alias("n"))
