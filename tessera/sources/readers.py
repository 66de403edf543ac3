"""Readers with declared schemas: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ..functions.ids import padded

#: Hits of a full-text search, as they come.
HIT = "struct<_id:string,_source:struct<adsh:string,ciks:array<string>,form:string,file_type:string,display_names:array<string>,file_date:string,snippet:string,period_of_report:string,file_description:string>,highlight:struct<text:string>>"
RECENT = {"accessionNumber": "string", "filingDate": "string", "reportDate": "string", "form": "string", "primaryDocument": "string", "items": "string", "size": "string"}
FACT = "struct<end:string,val:double,accn:string,fy:bigint,fp:string,form:string,filed:string,frame:string>"
TEXT_FILES = (".htm", ".html", ".txt", ".md", ".json", ".xml", ".qmd")


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file with a header, all columns text: leading zeros stay."""
    schema = S.StructType([S.StructField(c, S.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def latest_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows of equal key the last one in order."""
    row = F.struct(*df.columns)
    return df.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text of each file of a glob; line ends as \\n."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.regexp_replace("_metadata.file_path", "^file:", "").alias("path"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))


def binary_files(spark: SparkSession, path: str, pattern: str = "*.{htm,html,txt,pdf}") -> DataFrame:
    """path, size_bytes, extension, content of files below a folder. Columns that are not used are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size_bytes"), F.lower(F.concat(F.lit("."), F.regexp_extract("path", r"\.([^./]+)$", 1))).alias("extension"), "content")


def decoded(content: str | Column) -> Column:
    """Bytes as UTF-8 text; what is not valid becomes the replacement character."""
    return F.make_valid_utf8(F.col(content).cast("string") if isinstance(content, str) else content.cast("string"))


def window(content: str | Column, n: int) -> Column:
    """The first n characters."""
    return F.left(decoded(content), F.lit(n))


def text_documents(files: DataFrame) -> DataFrame:
    """files with text, null for those that are not text by their extension."""
    return files.withColumn("text", F.when(F.col("extension").isin(*TEXT_FILES), decoded("content")))


def folders_with(files: DataFrame, pattern: str) -> DataFrame:
    """Distinct two-level folders that hold a file of the pattern."""
    parts = F.split("path", "/")
    return files.where(F.col("path").rlike(pattern)).select(F.element_at(parts, -3).alias("firm"), F.element_at(parts, -2).alias("folder")).distinct()


def document_path(root: str, entity: str, accession: str, name: str) -> Column:
    """Path of a document below root; null if its name is more than a file name."""
    leaf = ~F.col(name).rlike(r"[/\\]") & ~F.col(name).isin("", ".", "..")
    return F.when(leaf, F.concat_ws("/", F.lit(root), F.regexp_replace(entity, "^0+", ""), F.replace(F.col(accession), F.lit("-"), F.lit("")), F.col(name)))


def hits(raw: DataFrame, column: str = "value") -> DataFrame:
    """Search hits from JSON objects: accession and document from the id, snippet or else the highlight."""
    h = raw.select(F.from_json(column, HIT).alias("h")).select("h.*")
    key = F.coalesce(F.nullif("_id", F.lit("")), "_source.adsh", F.lit(""))
    two = F.split(key, ":", 2)
    own = ["ciks", "form", "file_type", "display_names", "file_date"]
    return h.select(
        F.get(two, F.lit(0)).alias("adsh"), F.get(two, F.lit(1)).alias("primary_doc"), *[F.col(f"_source.{c}").alias(c) for c in own],
        F.coalesce(F.nullif("_source.snippet", F.lit("")), "highlight.text").alias("snippet"), F.col("_source.period_of_report").alias("period_of_report"), F.col("_source.file_description").alias("file_description"),
    )


def search(documents: DataFrame, phrases: list[str], forms: list[str] | None = None, first: str | None = None, last: str | None = None, ciks: list[str] | None = None, text: str = "text", cap: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(hits, one row of total, fetched, hit_cap) of phrases in a table of documents with form, file_date, ciks."""
    said = F.lit(False)
    for phrase in phrases:
        said = said | F.coalesce(F.lower(F.col(text)).contains(phrase.lower()), F.lit(False))
    found = documents.where(said)
    if forms is not None:
        found = found.where(F.col("form").isin(forms))
    if first is not None or last is not None:
        found = found.where(F.col("file_date").between(first or "0000", last or "9999"))
    if ciks is not None:
        found = found.where(F.arrays_overlap("ciks", F.array(*[F.lit(c) for c in ciks])))
    total = found.agg(F.count("*").alias("total"))
    meta = total.select("total", F.least("total", F.lit(cap)).alias("fetched"), (F.col("total") > cap).alias("hit_cap"))
    return found.orderBy("file_date", "adsh", "primary_doc").limit(cap), meta


def parallel_arrays(raw: DataFrame, root: str = "filings.recent", columns: dict[str, str] = RECENT, keep: list[str] = ()) -> DataFrame:
    """Rows of arrays of equal length; arrays that differ in length are an error."""
    arrays = [F.col(f"{root}.{c}" if root else c) for c in columns]
    sizes = [F.coalesce(F.size(a), F.lit(0)) for a in arrays]
    same = F.assert_true(F.greatest(*sizes) == F.least(*sizes), F.lit("arrays disagree in length"))
    zipped = F.when(same.isNull(), F.arrays_zip(*[a.alias(c) for a, c in zip(arrays, columns, strict=True)]))
    return raw.select(*keep, F.explode(zipped).alias("r")).select(*keep, *[F.col("r")[c].cast(t).alias(c) for c, t in columns.items()])


def submissions(spark: SparkSession, path: str, continuations: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(filings, entities) of submission files; continuations hold bare arrays of the same kind."""
    fields = ", ".join(f"{c}:array<string>" for c in RECENT)
    schema = f"cik string, name string, sic string, sicDescription string, tickers array<string>, exchanges array<string>, category string, fiscalYearEnd string, filings struct<recent:struct<{fields}>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("cik", padded("cik"))
    filings = parallel_arrays(raw, keep=["cik"])
    if continuations is not None:
        bare = spark.read.schema(fields.replace(":", " ")).option("multiLine", True).json(continuations)
        filings = filings.unionByName(parallel_arrays(bare, root=""), allowMissingColumns=True)
    return filings, raw.drop("filings")


def filing_index(raw: DataFrame, column: str = "value") -> DataFrame:
    """name, type, size, last_modified of the items of filing indexes."""
    item = F.from_json(column, "struct<directory:struct<item:array<struct<name:string,type:string,size:string,`last-modified`:string>>>>")
    listed = F.assert_true(item["directory"]["item"].isNotNull(), F.lit("no list of items"))
    return raw.select(F.explode(F.when(listed.isNull(), item["directory"]["item"])).alias("i")).select("i.name", "i.type", "i.size", F.col("i.last-modified").alias("last_modified"))


def concept_facts(raw: DataFrame, column: str = "value") -> DataFrame:
    """cik, concept, unit and fact, a row a fact; nothing for an entity without the concept."""
    own = F.from_json(column, f"struct<cik:string,tag:string,units:map<string,array<{FACT}>>>")
    units = raw.select(own.alias("c")).select(padded("c.cik").alias("cik"), F.col("c.tag").alias("concept"), F.explode("c.units").alias("unit", "facts"))
    return units.select("cik", "concept", "unit", F.explode("facts").alias("f")).select("cik", "concept", "unit", "f.*")


def form_index(lines: DataFrame, form: str, column: str = "value") -> DataFrame:
    """form, company, cik, date, accession of the lines of a fixed-width index with that form."""
    rest = F.substring(F.col(column), 13, 100_000)
    pattern = r"^(.+?)\s{2,}(\d+)\s+(\d{4}-\d{2}-\d{2})\s+(\S+)\s*$"
    part = lambda i: F.regexp_extract(rest, pattern, i)
    accession = F.regexp_extract(part(4), r"(\d{10}-\d{2}-\d{6})", 1)
    own = lines.where((F.trim(F.left(F.col(column), F.lit(12))) == form) & rest.rlike(pattern))
    return own.select(F.lit(form).alias("form"), F.trim(part(1)).alias("company"), part(2).alias("cik"), part(3).alias("date"), accession.alias("accession")).where("accession <> ''")


def sgml_documents(envelopes: DataFrame, text: str = "text", keep: list[str] = ()) -> DataFrame:
    """sgml_type, sequence, filename, sgml_description of each document that an envelope lists."""
    pattern = r"<TYPE>([^\n<]+)\s*<SEQUENCE>([^\n<]+)\s*<FILENAME>([^\n<]+)\s*(?:<DESCRIPTION>([^\n<]+))?"
    group = lambda i: F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(i))
    names = ["sgml_type", "sequence", "filename", "sgml_description"]
    rows = envelopes.select(*keep, F.explode(F.arrays_zip(*[group(i + 1).alias(n) for i, n in enumerate(names)])).alias("d")).select(*keep, *[F.trim(F.col(f"d.{n}")).alias(n) for n in names])
    return rows.withColumn("sgml_description", F.nullif("sgml_description", F.lit("")))


def exhibits_of(documents: DataFrame) -> DataFrame:
    """Exhibits 10 that are no pictures."""
    return documents.where(F.col("sgml_type").rlike(r"(?i)^EX-10($|[^0-9])") & ~F.lower("filename").rlike(r"\.(jpg|png|gif)$") & (F.col("filename") != ""))


def manifest_entities(lines: DataFrame, column: str = "value") -> DataFrame:
    """Entities that a manifest has a section for."""
    return lines.select(F.regexp_extract(column, r"^## CIK (\d{10,})", 1).alias("cik")).where("cik <> ''").distinct()
