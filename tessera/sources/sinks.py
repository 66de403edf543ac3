"""Writers. Tables are written where they are; only small results are rendered by the driver."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import blank

#: Most rows that a page or a packet may hold.
RENDERED_ROWS = 200_000


def parquet(df: DataFrame, path: str, partitions: int | None = None, by: list[str] = ()) -> None:
    writer = (df.coalesce(partitions) if partitions else df).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def csv(df: DataFrame, path: str, separator: str = ",", partitions: int | None = 1) -> None:
    """With a header; lists are joined by bars. A single file if partitions is 1."""
    flat = df.select(*[F.array_join(c, "|").alias(c) if kind.startswith("array") else F.col(c) for c, kind in df.dtypes])
    (flat.coalesce(partitions) if partitions else flat).write.mode("overwrite").option("header", True).option("sep", separator).option("escape", "\"").option("quoteAll", False).option("emptyValue", "").csv(path)


def tsv(df: DataFrame, path: str) -> None:
    csv(df, path, "\t")


def manifest(expected: DataFrame, outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """expected with the outcome of each row, pending where there is none; blank, not null."""
    own = outcomes.select(*[F.col(k).alias(f"_{k}") for k in keys], "outcome")
    joined = expected.join(own, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    return joined.select(*[blank(F.col(c)).alias(c) for c in expected.columns], F.coalesce("outcome", F.lit("pending")).alias("outcome"))


def bounded(df: DataFrame, limit: int = RENDERED_ROWS) -> list:
    """All rows, for rendering; an error if there are more than limit."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows to render")
    return rows


def json_array(df: DataFrame, limit: int = RENDERED_ROWS) -> str:
    """The rows as a compact JSON array that may stand inside a script element."""
    own = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j"))
    return "[" + ",".join(r["j"] for r in bounded(own, limit)).replace("</", "<\\/") + "]"


def filled(template: str, tables: dict[str, DataFrame]) -> str:
    """An HTML template with its placeholders filled with tables."""
    for name, df in tables.items():
        template = template.replace(name, json_array(df))
    return template


def page(template: str, out: str, tables: dict[str, DataFrame]) -> int:
    """Fills the template in a file and writes the page; its length."""
    text = filled(Path(template).read_text(encoding="utf-8"), tables)
    Path(out).write_text(text, encoding="utf-8")
    return len(text)


def dashboard(directory: str, agreements: DataFrame, events: DataFrame, stock: DataFrame) -> int:
    """Writes dashboard.html from the template beside it; an error if there is none."""
    template = Path(directory, "dashboard.template.html")
    if not template.exists():
        raise FileNotFoundError(f"missing template: {template}")
    return page(str(template), str(template.with_name("dashboard.html")), {"__TRAS_JSON__": agreements, "__EVENTS_JSON__": events, "__STOCK_JSON__": stock})


def excerpt_blocks(mentions: DataFrame, keys: list[str]) -> DataFrame:
    """keys, block: each mention with a line of what is known of it before its text."""
    quoted = F.coalesce(F.replace("heading", F.lit("'"), F.lit("’")), F.lit("None"))
    known = F.when(F.col("in_table"), "True").otherwise("False")
    head = F.concat(F.lit("[offset="), F.col("offset").cast("string"), F.lit(" in_table="), known, F.lit(" heading_hint='"), quoted, F.lit("']"))
    return mentions.select(*keys, "offset", F.concat(head, F.lit("\n"), F.col("text"), F.lit("\n")).alias("block"))


def markdown_table(df: DataFrame, limit: int = RENDERED_ROWS) -> str:
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(cell, r)) + " |" for r in bounded(df, limit))]) + "\n"


def packet(title: str, sections: dict[str, DataFrame | str], warning: str | None = None) -> str:
    """A Markdown document of sections, each a text or a table; an empty table says so."""
    out = [f"# {title}\n"]
    if warning:
        out.append(f"> **Warning:** {warning}\n")
    for name, body in sections.items():
        text = body if isinstance(body, str) else "None.\n" if body.isEmpty() else markdown_table(body)
        out.append(f"## {name}\n\n{text}")
    return "\n".join(out)


# The sections of an evidence packet, the mark of one of them, and the lines of a manifest's end.
PACKET_SECTIONS = ["Headline summary", "Existing pipeline signals", "TRA event timeline", "TRA exhibits", "XBRL TRA-liability series (from Company Concept API)", "Filing timeline", "Per-filing notes", "Open questions for the reviewer"]
FALLBACK_MARK = " (FALLBACK TAG: standard us-gaap fallback used; verify against the actual filing)"
FAILURES, ANOMALIES, RETRIES, ERRORS, NO_ERRORS = "## Failures", "## Anomalies", "- 5xx retries fired: ", "- 4xx errors:", "- 4xx errors: none"


def evidence_packet(name: str, cik: str, headline: str, signals: dict[str, str | None], exhibits: DataFrame, series: DataFrame, filings: DataFrame) -> str:
    """A firm's packet of eight sections from small tables; blanks are left for a reviewer.

    exhibits: filing_date, accession, sgml_type, phrase_count, byte_size, saved; series: end, val, unit,
    form, filed, requires_verification; filings: filing_date, form, accession, tra_mention, items,
    primary_doc, doc_url. A series that needs verification has a warning in its heading.
    """
    blank_row = filings.sparkSession.createDataFrame([("_to fill in_",) * 4], "date string, event string, filing string, summary string")
    link = F.when(F.col("doc_url") != "", F.concat(F.lit("["), F.coalesce("primary_doc", F.lit("doc")), F.lit("]("), F.col("doc_url"), F.lit(")"))).otherwise("")
    listed = filings.orderBy("filing_date", "accession").select("filing_date", "form", "accession", F.when(F.col("tra_mention"), "yes").otherwise("").alias("tra_mention"), F.coalesce("items", F.lit("")).alias("items"), link.alias("doc"))
    kept = exhibits.orderBy("filing_date", "accession").withColumn("byte_size", F.format_number("byte_size", 0))
    values = series.orderBy("end").withColumn("val", F.coalesce(F.format_number(F.col("val").cast("decimal(38,0)"), 0), F.lit(""))).withColumn("requires_verification", F.when(F.col("requires_verification"), "true").otherwise("false"))
    noted = bounded(filings.where("tra_mention").orderBy("filing_date", "accession").select("filing_date", "form", "accession"))
    notes = "\n".join(f"### {r[0]} {r[1]} ({r[2]})\n\n- Sections: _to fill in_\n- Summary: _to fill in_\n- Hints: _to fill in_\n" for r in noted) or "None.\n"
    bodies = [headline.strip() + "\n", "".join(f"- {k}: {v}\n" for k, v in signals.items()), blank_row, kept, values, listed, notes, "_To fill in._\n"]
    names = list(PACKET_SECTIONS)
    if not series.where("requires_verification").isEmpty():
        names[4] += FALLBACK_MARK
    return packet(f"{name} (CIK {cik})", dict(zip(names, bodies, strict=True)))


def closing_sections(failures: DataFrame, retries: int, errors: DataFrame) -> str:
    """The end of a manifest: entities that failed (cik, stage, error), if any, and anomalies: retries and errors of the client (error)."""
    lines = [f"- CIK {r[0]} stage={r[1]} {r[2]}" for r in bounded(failures.select("cik", "stage", "error").orderBy("cik", "stage"))]
    failed = [FAILURES, *lines] if lines else []
    client = [f"  - {r[0]}" for r in bounded(errors.select("error").orderBy("error"))]
    return "\n".join([*failed, ANOMALIES, f"{RETRIES}{retries}", *([ERRORS, *client] if client else [NO_ERRORS])]) + "\n"


def grouped_log(df: DataFrame, group: str, order: list[str], line: list[str]) -> DataFrame:
    """group, text: a Markdown section for each group, its lines in order."""
    item = F.concat(F.lit("- "), F.concat_ws(": ", *[F.col(c).cast("string") for c in line]))
    rows = df.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(*order, item.alias("item")))).alias("items"))
    return rows.select(group, F.concat(F.lit("## "), F.col(group).cast("string"), F.lit("\n\n"), F.array_join(F.transform("items", lambda x: x["item"]), "\n"), F.lit("\n")).alias("text"))


def entity_sections(stats: DataFrame, failures: DataFrame, key: str = "cik") -> DataFrame:
    """key, text: counts of an entity and the stages at which it failed, as a section of a manifest."""
    numbers = [c for c in stats.columns if c != key]
    counted = F.concat_ws("\n", *[F.concat(F.lit(f"- {c}: "), F.col(c).cast("string")) for c in numbers])
    failed = failures.groupBy(F.col(key).alias("_key")).agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws(": ", "stage", "error"))), "\n- failed at ").alias("_failed"))
    joined = stats.join(failed, stats[key] == F.col("_key"), "left")
    return joined.select(key, F.concat(F.lit("## CIK "), F.col(key), F.lit("\n\n"), counted, F.coalesce(F.concat(F.lit("\n- failed at "), "_failed"), F.lit("")), F.lit("\n")).alias("text"))


def contents(df: DataFrame, root: str, path: str = "path", content: str = "content") -> None:
    """Writes each row's content to a file below root, a folder that all executors see, unless it is
    there already: an anti join with what is there, then a write to a temporary name and a rename."""
    Path(root).mkdir(parents=True, exist_ok=True)
    there = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    done = there.select(F.regexp_replace("path", "^file:/*", "/").alias("_there"))  # names only: contents are not read
    own = F.concat(F.lit(root.rstrip("/") + "/"), F.col(path))

    def write(rows) -> None:
        for r in rows:
            target = Path(root, r[path])
            target.parent.mkdir(parents=True, exist_ok=True)
            body = r[content]
            part = target.with_name(f"{target.name}.{uuid.uuid4().hex}.part")
            part.write_bytes(body.encode() if isinstance(body, str) else bytes(body))
            part.replace(target)

    df.select(path, content).join(done, own == F.col("_there"), "left_anti").foreachPartition(write)
