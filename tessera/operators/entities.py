"""Entity master lists: hits of filings by entity, thresholds, classes and diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.dates import bucket_start
from ..functions.ids import padded
from .relational import any_true, flagged, having_distinct, keep_first, last_by, pivot_counts, seeded_order, split_by, stratified_sample, text_set, top, union_all


def entity_rows(hits: DataFrame, query: str) -> DataFrame:
    """cik, adsh, form, file_date, display_names, query: a row for each entity of a hit; ids other
    than those of ten digits are dropped."""
    rows = hits.select(F.explode_outer("ciks").alias("cik"), "adsh", "form", "file_date", F.array_join("display_names", "; ").alias("display_names"), F.lit(query).alias("query"))
    return rows.withColumn("cik", padded("cik")).where(F.length("cik") == 10)


def rollup(rows: DataFrame) -> DataFrame:
    """Per entity: first and last date, distinct accessions, forms, the latest name and the queries it is in."""
    return rows.groupBy("cik").agg(
        last_by("display_names", "file_date", "adsh", "query", "display_names").alias("display_name"),
        F.min("file_date").alias("first_file_date"),
        F.max("file_date").alias("last_file_date"),
        F.count_distinct("adsh").alias("total_hits"),
        text_set("form", ";").alias("forms_touched"),
        any_true(F.col("query") == "phrase").alias("in_phrase_query"),
        any_true(F.col("query") == "token").alias("in_token_query"),
    )


def master_list(phrase: DataFrame, token: DataFrame, prior: DataFrame, least: int = 3, phrase_forms: Column | None = None) -> DataFrame:
    """Entities of the phrase query, and those of the token query with enough accessions of typical forms.

    phrase_forms: a condition that phrase rows must meet to make an entity eligible.
    """
    own = phrase if phrase_forms is None else phrase.where(phrase_forms)
    often = having_distinct(token.where(R.typical_form("form")), "cik", "adsh", least)
    master = own.select("cik").union(often).distinct()
    rows = union_all([phrase, token]).join(master, "cik", "left_semi")
    return flagged(rollup(rows), prior, "cik", "in_deferred_csv")


def reaggregated(phrase: DataFrame, token: DataFrame, prior: DataFrame, least: int = 3, n: int = 15) -> dict[str, DataFrame]:
    """The master list with the form list on both queries, beside the one without: entities before
    and after, lost, gained and in both, and the lost with most hits."""
    before = master_list(phrase, token, prior, least)
    after = master_list(phrase, token, prior, least, R.typical_form("form"))
    lost = before.select("cik").subtract(after.select("cik"))
    return {
        "before": before,
        "after": after,
        "lost": lost,
        "gained": after.select("cik").subtract(before.select("cik")),
        "kept": before.select("cik").intersect(after.select("cik")),
        "largest_lost": top(before.join(lost, "cik", "left_semi"), n, F.desc("total_hits"), "cik"),
    }


def qualifying(hits: DataFrame, body_forms=R.BODY_FORMS, exhibit_forms=R.EXHIBIT_FORMS) -> DataFrame:
    """Hits with doc_class: a body of a body form, or an exhibit of an exhibit form."""
    exhibit = R.exhibit_name("primary_doc", R.EXHIBIT_NAME_BOUND)
    kind = F.when(exhibit & F.col("form").isin(exhibit_forms), "exhibit").when(~exhibit & F.col("form").isin(body_forms), "body")
    return hits.withColumn("doc_class", kind).where(F.col("doc_class").isNotNull())


def signal_class(rows: DataFrame) -> DataFrame:
    """cik, signal_class of entity rows with doc_class."""
    has = rows.groupBy("cik").agg(any_true(F.col("doc_class") == "body").alias("body"), any_true(F.col("doc_class") == "exhibit").alias("exhibit"))
    return has.select("cik", F.when(F.col("body") & F.col("exhibit"), "both").when(F.col("body"), "body-only").otherwise("exhibit-only").alias("signal_class"))


def refined_master(hits: DataFrame, prior: DataFrame) -> DataFrame:
    """The master list of qualifying hits, with signal_class."""
    own = qualifying(hits)
    rows = own.select(F.explode("ciks").alias("cik"), "adsh", "form", "file_date", "doc_class", F.array_join("display_names", "; ").alias("display_names"), F.lit("phrase").alias("query"))
    rows = rows.withColumn("cik", padded("cik")).where(F.length("cik") == 10)
    return flagged(rollup(rows), prior, "cik", "in_deferred_csv").join(signal_class(rows), "cik", "left")


def form_class_counts(rows: DataFrame) -> DataFrame:
    """Distinct entities by form and class, 0 where there is none."""
    return pivot_counts(rows, "form", "doc_class", ["body", "exhibit"], "cik")


def form_distribution(hits: DataFrame, allowed: list[str]) -> DataFrame:
    """Distinct accessions and entities by form; is the form on the list?"""
    forms = hits.where(F.col("form").isNotNull())
    filings = forms.groupBy("form").agg(F.count_distinct("adsh").alias("n_accessions"))
    entities = forms.select("form", F.explode_outer("ciks").alias("cik")).where(F.length(padded("cik")) == 10).groupBy("form").agg(F.count_distinct(padded("cik")).alias("n_ciks"))
    return filings.join(entities, "form", "left").select("form", "n_accessions", F.coalesce("n_ciks", F.lit(0)).alias("n_ciks"), F.when(F.col("form").isin(allowed), "Y").otherwise("N").alias("in_allow_list"))


def hit_totals(hits: DataFrame, allowed: list[str]) -> DataFrame:
    """One row: hits as they came and after one is kept an accession, before and after the form list."""
    first = keep_first(hits, ["adsh"], ["file_date", "form"])
    raw = hits.agg(F.count("*").alias("raw_hits"), F.count_if(F.col("form").isin(allowed)).alias("raw_allowed"))
    unique = first.agg(F.count("*").alias("unique_hits"), F.count_if(F.col("form").isin(allowed)).alias("unique_allowed"))
    return raw.crossJoin(unique)  # one row each


def body_against_exhibit(hits: DataFrame) -> DataFrame:
    """Per form: accessions with a body, with an exhibit and with both, and entities."""
    own = hits.withColumn("exhibit", R.exhibit_name("primary_doc"))
    filings = own.groupBy("form", "adsh").agg(any_true("exhibit").alias("exhibit"), any_true(~F.col("exhibit")).alias("body"))
    n = filings.groupBy("form").agg(
        F.count_if("body").alias("n_body"), F.count_if("exhibit").alias("n_exhibit"), F.count_if(F.col("body") & F.col("exhibit")).alias("n_both"), F.count("*").alias("n_accessions")
    )
    ciks = own.select("form", F.explode("ciks").alias("cik")).groupBy("form").agg(F.count_distinct("cik").alias("n_ciks"))
    return n.join(ciks, n["form"].eqNullSafe(ciks["form"]), "left").select(n["form"], "n_body", "n_exhibit", "n_both", "n_accessions", F.coalesce("n_ciks", F.lit(0)).alias("n_ciks"))


def year_buckets(df: DataFrame, date: str, first: int = 2001, width: int = 5) -> DataFrame:
    """Rows by bucket of years; rows without a year have a null bucket."""
    year = F.expr(f"try_cast(left({date}, 4) AS int)")
    return df.groupBy(bucket_start(year, first, width).alias("bucket")).agg(F.count("*").alias("n"))


def typical_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_by(rows, R.typical_form("form"))


def form_report(queries: dict[str, DataFrame], allowed: list[str], order: list) -> DataFrame:
    """part, query, form, n_accessions, n_ciks, in_allow_list: one row an accession of a query, counted by
    form before (pre) and after (post) the list of forms, null forms too; and totals of each query and of all."""
    ok = F.coalesce(F.col("form").isin(allowed), F.lit(False))
    one = union_all([keep_first(df.withColumn("query", F.lit(q)), ["adsh"], order).withColumn("_rank", F.lit(i)) for i, (q, df) in enumerate(queries.items())])
    all_ = keep_first(one, ["adsh"], ["_rank", *order]).withColumn("query", F.lit("all"))

    def counted(df: DataFrame, part: str, *keys: str) -> DataFrame:
        own = df.select("query", "form", "adsh", ok.alias("ok"), F.explode_outer("ciks").alias("cik"))
        n = own.groupBy(*keys).agg(F.count_distinct("adsh").alias("n_accessions"), F.count_distinct("cik").alias("n_ciks"), any_true("ok").alias("ok"))
        by_form = "form" in keys
        listed = F.when(F.col("ok"), "Y").otherwise("N") if by_form else F.lit(None).cast("string")
        return n.select(F.lit(part).alias("part"), "query", F.col("form") if by_form else F.lit(None).cast("string").alias("form"), "n_accessions", "n_ciks", listed.alias("in_allow_list"))

    return union_all([counted(one, "pre", "query", "form"), counted(one.where(ok), "post", "query", "form"), counted(one, "total", "query"), counted(all_, "total", "query")])


def body_exhibit_report(hits: DataFrame, seed: int, names: int = 10) -> DataFrame:
    """Per form: accessions (n_) and entities (c_) with a body, an exhibit and both, and with one alone;
    a seeded sample of the names of exhibits."""
    own = hits.withColumn("exhibit", R.exhibit_name("primary_doc"))
    filings = own.groupBy("form", "adsh").agg(any_true("exhibit").alias("e"), any_true(~F.col("exhibit")).alias("b"))
    n = filings.groupBy("form").agg(
        F.count("*").alias("n_total"), F.count_if("b").alias("n_body"), F.count_if("e").alias("n_exhibit"), F.count_if(F.col("b") & F.col("e")).alias("n_both"),
        F.count_if(F.col("b") & ~F.col("e")).alias("n_body_only"), F.count_if(F.col("e") & ~F.col("b")).alias("n_exhibit_only"),
    )
    rows = own.select("form", "adsh", F.explode("ciks").alias("cik")).distinct().join(filings, ["form", "adsh"])
    some = lambda c: F.count_distinct(F.when(c, F.col("cik")))
    c = rows.groupBy("form").agg(F.count_distinct("cik").alias("c_total"), some(F.col("b")).alias("c_body"), some(F.col("e")).alias("c_exhibit"), some(F.col("b") & F.col("e")).alias("c_both"))
    sampled = stratified_sample(own.where("exhibit").select("form", "primary_doc").distinct(), ["form"], names, ["primary_doc"], str(seed))
    order = F.sort_array(F.collect_list(F.struct(seeded_order("primary_doc", seed=str(seed)).alias("o"), "primary_doc")))  # at most names of a form
    listed = sampled.groupBy("form").agg(F.array_join(F.transform(order, lambda x: x["primary_doc"]), "|").alias("exhibit_names"))
    return n.join(c, "form").join(listed, "form", "left")
