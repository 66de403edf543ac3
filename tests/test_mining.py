import html
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import documents as M
from tessera.sources import readers as S
from tessera.sources import sinks as K
from tessera.streaming import ingest

NAME = "Tax Receivable Agreement"


def frame(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")


def test_lines_of_html_equal_python(spark):
    pages = ["<p>a &amp; b</p><style>x</style><table><tr><td>c</td></tr></table>", "<script>q</script>", " <b>x</b>\n\n\n\ny ", None, "&lt;p&gt; <br>z"]

    def one(page):
        t = re.sub(r"(?is)<(script|style)[^>]*>.*?</\1>", " ", page)
        t = re.sub(r"(?s)<[^>]+>", " ", re.sub(r"(?i)</?(?:p|div|tr|h[1-6]|li|br|table)[^>]*>", "\n", t))
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", html.unescape(t))).strip()

    got = [r[1] for r in frame(spark, *pages).select("id", X.lines_of_html("text")).orderBy("id").collect()]
    assert got == [None if p is None else one(p) for p in pages]


def test_mentions(spark):
    far = "x" * 801
    got = M.mentions(frame(spark, f"<h2>RISK FACTORS</h2><p>the tax&nbsp;receivable\nagreement is</p>", f"Adjusted EBITDA {far[:700]} {NAME}", f"Adjusted EBITDA {far} {NAME} and tax receivables agreements", None, ""), "text", ["id"]).orderBy("id", "offset").collect()
    assert [(r["id"], r["in_table"], r["heading"]) for r in got] == [(0, False, "RISK FACTORS"), (1, True, None), (2, False, None), (2, False, None)]
    assert got[0]["text"].endswith("tax receivable agreement is") and M.counted_mentions(frame(spark).select(F.lit(True).alias("in_table"))).count() == 0


@pytest.mark.parametrize(("gap", "kept"), [(499, 1), (500, 2)])
def test_headings_close_to_each_other(gap, kept):
    first = "<h1>Title One</h1>"
    page = first + " " * (gap - len(first)) + '<h2 id="a">TITLE ONE</h2>'
    got = M.headings_in(page)
    assert len(got) == kept and got[-1]["anchor"] == "a"


def test_table_of_contents(spark):
    page = '<a name="s1">x</a><p>Section Heading</p><h1>Top</h1><b>ALL CAPS HEAD</b><b>not a heading of any kind.</b><h2>ab</h2><a name="f">file.htm x</a>'
    got = M.table_of_contents(frame(spark, page, None), "text", ["id"]).orderBy("position").collect()
    assert [r["source"] for r in got] == ["named_anchor", "h_tag", "typographic"] and got[1]["heading"] == "Top"


def test_title_block(spark):
    centred = lambda t: f'<p style="text-align: center">{t}</p>'
    page = centred("Exhibit 10.1") + centred(NAME.upper()) + centred("by and among") + '<div align="CENTER">ACME</div>' + "<p>" + "long " * 20 + "</p>" + centred("AFTER")
    got = [r[0] for r in frame(spark, page, centred("A") + centred("ARTICLE I") + centred("B"), '<p class="c">X</p>', None).orderBy("id").select(M.title_block("text")).collect()]
    assert got == [f"{NAME.upper()} | ACME", "A", "", ""]


def test_classified_files(spark):
    files = spark.createDataFrame([("a.htm", f"<p align=center>{NAME}</p>", 10), ("b.PDF", None, 10), ("c.txt", "nothing", 10), ("d.txt", "tax receivables agreement", 10)], "path string, text string, size_bytes long")
    got = {r["path"]: r["decision"] for r in M.classified(files).collect()}
    assert got == {"a.htm": "keep", "b.PDF": "keep", "c.txt": "drop", "d.txt": "keep"}
    assert M.classification_report(M.classified(files)).count() == 4


def test_classified_pages_equal_python(spark, tmp_path):
    from tessera.functions import rules as R
    from tessera.plans import catalog

    far = "<p>" + "word " * 1000 + "</p>"
    pages = ["", far, far + f"<p align=center>{NAME}</p>", far + "<p align=center>LEASE AGREEMENT</p>", far + "under the tax receivable agreement", "x" * 399_900 + " tax receivable agreement ", "x" * 400_000 + " tax receivable agreement ", f"{far}<p>no</p>" * 240, far * 20 + f"<p align=center>{NAME}</p>"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = catalog.QUERIES["classified_pages"](spark, str(tmp_path))

    plain = lambda p: re.sub(r"^\(\?\w+\)", "(?i)", p)  # noqa: E731  Java's flags

    def rules(page):
        title, text, size = M.title_in(page[:80_000]), page[:400_000], len(page.encode())
        said, n = bool(re.search(plain(R.TITLE_PHRASE), text)), sum(bool(re.search(plain(t), text)) for t in R.TERMS)
        if re.search(plain(R.TITLE_PHRASE), title):
            return "keep", "centered title contains 'tax receivable agreement'"
        if any(re.search(rf"(?i)\b(?:{o})\b", title) for o in R.OTHER_INSTRUMENTS) and not said:
            return "drop", "title names a non-TRA instrument; no TRA phrase"
        if said:
            return "keep", "'tax receivable agreement' phrase present in body"
        if n >= 3:
            return "keep", f"{n} TRA-specific defined terms present"
        if size < 4000:
            return "drop", f"file too small ({size} B < 4000), no phrase"
        return "drop", f"large filing ({size} B) with no TRA phrase or terms" if size > 1_200_000 else "no TRA title, phrase, or defining terminology"

    got = {r["path"]: (r["decision"], r["reason"]) for r in found.collect()}
    assert got == {f"{i}.html": rules(page) for i, page in enumerate(pages)}
    assert len(set(got.values())) >= 6


def test_distinct_contents_and_exhibits(spark):
    body = f"{NAME} WHEREAS {NAME} {NAME}"
    docs = spark.createDataFrame([("2", "2002", "b", "EX-10.2", body), ("1", "2001", "a", "EX-10", body), ("3", "2003", "c", "EX-101", body + "x"), ("4", "2004", "d", "ex-10.(A)", body + "y"), ("5", "2005", "e", "EX-10", None)], "accession string, filing_date string, filename string, sgml_type string, body string")
    got = M.contract_exhibits(docs).collect()
    assert sorted((r["accession"], r["phrase_count"]) for r in got) == [("1", 3), ("4", 3)]
    prior = spark.createDataFrame([(got[0]["content_hash"],)], "content_hash string")
    assert M.contract_exhibits(docs, prior).count() == 1


SUMMARY = """---
title: One
company-names: [A, "", B]
CIKs: ["0001234567"]
status: Ongoing
creation-date: 2010-02-03
termination-date:
tax-asset-type: [Basis Step-Up, NOL]
notes: >
  folded
  text
---
# One
- 2000-01-01: before
## TRA Timeline
- 2010-02-03: no group
#### Formation
- 2010-02-04: signed
  - 2010-02-05: indented
- 2010-03: month only
- 2010-02-06: ended
## After
- 2020-01-01: too late
"""


def write_corpus(root: Path):
    for name, text in (("acme_0001234567/acme_summary.qmd", SUMMARY), ("acme_0001234567/acme_TRA-2011-01-01_summary.qmd", SUMMARY.replace("\n", "\r\n")), ("beta/beta_summary.qmd", "no front matter"), ("gamma/gamma_summary.qmd", "---\ntitle: G\n---\nbody\n")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(text.encode())


def test_agreements_and_events(spark, tmp_path):
    write_corpus(tmp_path)
    table, events, rejects = M.agreements_and_events(S.whole_texts(spark, f"{tmp_path}/*/*_summary.qmd"))
    got = {r["tra_id"]: r for r in table.collect()}
    assert set(got) == {"TRA-2010-02-03", "TRA-2011-01-01", "TRA-gamma"} and len(table.columns) == 18
    one = got["TRA-2010-02-03"]
    assert (one["company_names"], one["ciks"], one["cik"], one["tax_asset_types"], one["last_event_date"], one["notes"], one["termination_date"]) == ("A|B", "0001234567", "0001234567", "Basis Step-Up|NOL", "2010-02-06", "folded text", "")
    assert got["TRA-gamma"]["last_event_date"] == "" and all(v is not None for r in got.values() for v in r)
    assert sorted((r["event_group"], r["date"], r["description"]) for r in events.where("tra_id = 'TRA-2011-01-01'").collect()) == [("", "2010-02-03", "no group"), ("Formation", "2010-02-04", "signed"), ("Formation", "2010-02-06", "ended")]
    assert [r["error"] for r in rejects.collect()] == ["no front matter"]


def test_stream_of_agreements(spark, tmp_path):
    write_corpus(tmp_path / "in")
    for _ in range(2):
        ingest.agreement_stream(spark, f"{tmp_path}/in/*/*_summary.qmd", f"{tmp_path}/out", f"{tmp_path}/state")
        assert spark.read.parquet(f"{tmp_path}/out/agreements").count() == 3 and spark.read.parquet(f"{tmp_path}/out/events").count() == 6


def test_phrases_and_markdown(spark):
    sentence = "This plain sentence has quite a few ordinary words in it so that a phrase can be taken from the middle of it."
    assert M.phrase_in(f"Short one. {sentence} The end.") in sentence
    assert M.phrase_in("Nothing here.") is None and M.phrase_in(sentence.replace("plain", "SHOUTED")) is None
    text = "meta\n**Exhibit**\n" + "-" * 72 + "\n12\n12345\n##### [Table of Contents](#toc)\n\xa0 \na<u>b</u> \\(c\\)<span id=\"x\"></span>\n\n\n\nend"
    got = frame(spark, text, None).orderBy("id").select(M.clean_markdown("text").alias("c")).select("c.*").first()
    assert got["text"] == "**Exhibit**\n12345\nab (c)\n\nend\n" and (got["header_lines"], got["rules"], got["page_numbers"], got["toc_links"], got["spans"], got["underlines"], got["escapes"], got["filler"]) == (1, 1, 1, 1, 1, 2, 2, 1)


def test_firm_summary(spark):
    log = "# Acme Inc (ACME)\n\nTRA-2010-02-03 from the IPO of 2010\n\nFirm role\nAcme is the public company.\n\nBeneficiaries:\nBeneficiaries\n- Zed LLC\n- Alpha LP\n- agent X\n\n85% of savings under Section 754. `in_force`\n"
    logs = spark.createDataFrame([("acme_12", log), ("none_0000000013", None), ("beta_14", "no agreement"), ("bad", "x")], "directory string, text string")
    got = {r["slug"]: r for r in M.firm_summary(logs).collect()}
    assert set(got) == {"acme", "none", "beta"}
    a = got["acme"]
    assert (a["cik"], a["company_name"], a["role"], a["date_executed"], a["counterparties"], a["payment_pct"], a["tax_asset_type"], a["status_flag"]) == ("0000000012", "Acme Inc", "pubco", "2010-02-03", "Alpha LP; Zed LLC", "85%", "section_754_step_up", "in_force")
    assert a["notes"].endswith("In force.") and len(a["notes"]) <= 180
    assert got["none"]["role"] == "mention_only" and got["beta"]["role"] == "never_executed" and got["beta"]["status_flag"] == "never_executed"


def test_filings_documents_and_facts(spark):
    filings = spark.createDataFrame([("1", "a", "S-1", "2001"), ("1", "b", "S-1/A", "2000"), ("1", "c", "10-K", "2002"), ("1", "d", "4", "2002"), ("2", "e", "8-K/A", None)], "cik string, accession string, form string, filing_date string")
    assert sorted((r["accession"], r["bucket"]) for r in M.filing_list(filings).collect()) == [("b", "S-1"), ("c", "10-K"), ("e", "8-K")]
    index = spark.createDataFrame([("x", "x.txt", "900"), ("x", "main.htm", "50"), ("x", "ex-10.htm", "99"), ("x", "x-index.htm", "999"), ("x", "p.jpg", "9999"), ("y", "y.txt", ""), ("z", "ex1.htm", "5"), ("z", "ex2.txt", "7")], "accession string, name string, size string")
    got = {r["accession"]: (r["primary_doc"], r["exhibits"]) for r in M.primary_document(index).collect()}
    assert got == {"x": ("main.htm", ["ex-10.htm"]), "y": ("y.txt", []), "z": ("ex2.txt", ["ex1.htm", "ex2.txt"])}
    facts = spark.createDataFrame([("1", "B", 1.0), ("1", "C", 2.0), ("2", "A", 3.0), ("3", "Z", 4.0)], "cik string, concept string, val double")
    assert sorted((r["cik"], r["val"], r["requires_verification"]) for r in M.preferred_facts(facts, ["A", "B", "C"]).collect()) == [("1", 1.0, True), ("2", 3.0, False)]


def test_index_coverage(spark):
    samples = spark.createDataFrame([("1", "a", "2010-01-01", "some phrase", None, 0, None), ("1", "b", "2010-01-01", None, None, 0, None), ("2", "c", "2010-01-01", "z", "p", 2, None), ("3", "d", "2010-01-01", "p", None, 0, "500"), ("2", "c", "2012-01-01", None, "q", 1, None)], "cik string, accession string, file_date string, phrase string, exhibit_phrase string, n_exhibits int, error string")
    hits = spark.createDataFrame([("1", "a", "2010-06-30", "with some phrase in it"), ("2", "c", "2010-01-02", "p alone"), ("2", "c", "2011-01-02", "q")], "cik string, adsh string, file_date string, snippet string")
    assert sorted((r["accession"], r["overall_status"]) for r in M.index_coverage(samples, hits).collect()) == [("a", "INDEXED_BODY"), ("b", "NO_PHRASE"), ("c", "INDEXED_EXHIBIT"), ("c", "NOT_FOUND"), ("d", "ERROR")]


# sources


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n0012,"x ""y"""\n007,\n')
    assert sorted(map(str, map(tuple, S.text_csv(spark, str(tmp_path / "a.csv"), ["id", "name"]).collect()))) == ["('0012', 'x \"y\"')", "('007', None)"]
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/e/x.HTM").write_text("no")
    (tmp_path / "d/e/x.htm").write_bytes(b"ok \xff")
    (tmp_path / "d/y.pdf").write_bytes(b"%PDF")
    files = S.text_documents(S.binary_files(spark, str(tmp_path / "d")))
    assert {r["extension"]: r["text"] for r in files.collect()} == {".htm": "ok �", ".pdf": None}
    assert S.folders_with(files, r"\.htm$").count() == 1
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "k string, n int, v string")
    assert S.latest_rows(rows, "k", "n").first()["v"] == "b"


def test_document_paths(spark):
    df = spark.createDataFrame([("0012", "1-2", "doc.htm"), ("0012", "1-2", "../x"), ("0012", "1-2", "")], "e string, a string, n string")
    assert [r[0] for r in df.select(S.document_path("/r", "e", "a", "n")).collect()] == ["/r/12/12/doc.htm", None, None]


def test_json_sources(spark):
    hit = {"_id": "0001-1:doc:x.htm", "_source": {"ciks": ["1"], "form": "8-K", "file_date": "2001"}, "highlight": {"text": "h"}}
    bare = {"_source": {"adsh": "0002", "snippet": "s"}}
    got = S.hits(spark.createDataFrame([(json.dumps(hit),), (json.dumps(bare),)], "value string")).collect()
    assert [(r["adsh"], r["primary_doc"], r["snippet"]) for r in got] == [("0001-1", "doc:x.htm", "h"), ("0002", None, "s")]
    index = json.dumps({"directory": {"item": [{"name": "a", "type": "t", "size": "1", "last-modified": "d"}]}})
    assert tuple(S.filing_index(spark.createDataFrame([(index,)], "value string")).first()) == ("a", "t", "1", "d")
    with pytest.raises(Exception, match="no list of items"):
        S.filing_index(spark.createDataFrame([('{"directory": {}}',)], "value string")).collect()
    facts = json.dumps({"cik": "12", "tag": "T", "units": {"USD": [{"end": "e", "val": 1, "fy": 2010}, {"val": None}], "EUR": []}})
    got = S.concept_facts(spark.createDataFrame([(facts,), ("{}",)], "value string")).collect()
    assert [(r["cik"], r["unit"], r["val"], r["fy"]) for r in got] == [("0000000012", "USD", 1.0, 2010), ("0000000012", "USD", None, None)]


def test_submissions(spark, tmp_path):
    columns = {c: ["a", "b"] for c in S.RECENT}
    (tmp_path / "s.json").write_text(json.dumps({"cik": "7", "name": "N", "filings": {"recent": columns}}))
    (tmp_path / "c.json").write_text(json.dumps({c: ["z"] for c in S.RECENT}))
    filings, entities = S.submissions(spark, str(tmp_path / "s.json"), str(tmp_path / "c.json"))
    assert filings.count() == 3 and entities.first()["cik"] == "0000000007"
    (tmp_path / "s.json").write_text(json.dumps({"cik": "7", "filings": {"recent": columns | {"form": ["x"]}}}))
    with pytest.raises(Exception, match="disagree in length"):
        S.submissions(spark, str(tmp_path / "s.json"))[0].collect()


def test_line_sources(spark):
    lines = ["Form Type   Company", "---", "10-K        ACME CORP   INC      1234  2001-02-03  edgar/data/1234/0001234567-01-000001.txt", "10-K/A      B   12  2001-02-03  x", "10-K        bad line"]
    got = S.form_index(spark.createDataFrame([(x,) for x in lines], "value string"), "10-K").collect()
    assert [tuple(r) for r in got] == [("10-K", "ACME CORP   INC", "1234", "2001-02-03", "0001234567-01-000001")]
    envelope = "<DOCUMENT>\n<TYPE>EX-10.1\n<SEQUENCE>2\n<FILENAME>a.htm\n<DESCRIPTION>D\n<TEXT>..<TYPE>EX-10.2\n<SEQUENCE>3\n<FILENAME>b.JPG\n<TYPE>8-K\n<SEQUENCE>1\n<FILENAME>m.htm\n"
    docs = S.sgml_documents(frame(spark, envelope))
    assert docs.count() == 3 and [tuple(r) for r in S.exhibits_of(docs).collect()] == [("EX-10.1", "2", "a.htm", "D")]
    assert S.manifest_entities(spark.createDataFrame([("## CIK 0001234567",), ("## CIK 12",), ("x",)], "value string")).count() == 1


def test_search(spark):
    docs = spark.createDataFrame([("1", "d", "8-K", "2001-01-01", ["5"], "a Tax Receivable Agreement"), ("2", "d", "10-K", "2002-01-01", ["6"], "tax receivable agreement"), ("3", "d", "8-K", "2003-01-01", ["5"], None)], "adsh string, primary_doc string, form string, file_date string, ciks array<string>, text string")
    found, meta = S.search(docs, [NAME], ["8-K"], "2000-01-01", "2001-12-31", ["5"])
    assert [r["adsh"] for r in found.collect()] == ["1"] and tuple(meta.first()) == (1, 1, False)
    assert tuple(S.search(docs, [NAME], cap=1)[1].first()) == (2, 1, True)


# sinks


def test_tables_and_manifests(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], None), (2, [], "x\ty")], "k int, l array<string>, s string")
    K.tsv(df, str(tmp_path / "t"))
    K.parquet(df, str(tmp_path / "p"), 1)
    K.csv(df, str(tmp_path / "c"))
    (part,) = (tmp_path / "c").glob("part-*")
    assert part.read_text().splitlines()[:2] == ["k,l,s", "1,a|b,"] and spark.read.parquet(str(tmp_path / "p")).count() == 2
    outcomes = spark.createDataFrame([(1, "saved")], "k int, outcome string")
    assert sorted(map(tuple, K.manifest(df.select("k", "s"), outcomes, ["k"]).collect())) == [("1", "", "saved"), ("2", "x\ty", "pending")]


def test_rendering(spark, tmp_path):
    df = spark.createDataFrame([(1, "</script>"), (2, None)], "k int, s string").orderBy("k")
    assert K.json_array(df) == '[{"k":1,"s":"<\\/script>"},{"k":2,"s":null}]'
    with pytest.raises(ValueError, match="more than 1"):
        K.json_array(df, 1)
    with pytest.raises(FileNotFoundError):
        K.dashboard(str(tmp_path), df, df, df)
    (tmp_path / "dashboard.template.html").write_text("<script>a=__TRAS_JSON__;b=__EVENTS_JSON__;c=__STOCK_JSON__</script>")
    assert K.dashboard(str(tmp_path), df, df, df.where("false")) == len((tmp_path / "dashboard.html").read_text()) and "c=[]" in (tmp_path / "dashboard.html").read_text()
    text = K.packet("P", {"A": df, "B": df.where("false"), "C": "free\n"}, "careful")
    assert "> **Warning:** careful" in text and "| 1 | </script> |" in text and "## B\n\nNone." in text
    log = K.grouped_log(spark.createDataFrame([("g", 2, "b"), ("g", 1, "a")], "g string, o int, t string"), "g", ["o"], ["t"])
    assert log.first()["text"] == "## g\n\n- a\n- b\n"
    failures = spark.createDataFrame([("1", "pull", "500")], "cik string, stage string, error string")
    sections = K.entity_sections(spark.createDataFrame([("1", 3), ("2", 0)], "cik string, n int"), failures).orderBy("cik").collect()
    assert sections[0]["text"] == "## CIK 1\n\n- n: 3\n- failed at pull: 500\n" and sections[1]["text"] == "## CIK 2\n\n- n: 0\n"
    block = K.excerpt_blocks(spark.createDataFrame([(1, 5, "t", True, "it's")], "id int, offset int, text string, in_table boolean, heading string"), ["id"]).first()["block"]
    assert block == "[offset=5 in_table=True heading_hint='it’s']\nt\n"


def test_contents_are_written_once(spark, tmp_path):
    K.contents(spark.createDataFrame([("a/b.txt", "one")], "path string, content string"), str(tmp_path))
    K.contents(spark.createDataFrame([("a/b.txt", "two")], "path string, content string"), str(tmp_path))
    assert (tmp_path / "a/b.txt").read_text() == "one"


def test_grouping_and_percentages(spark):
    docs = spark.createDataFrame([("a", "2.htm", "original"), ("a", "1.htm", "amendment_1"), ("b", "3.htm", "original")], "accession string, filename string, kind string")
    got = {r["accession"]: r for r in M.grouped_by_filing(docs).collect()}
    assert [d["filename"] for d in got["a"]["documents"]] == ["1.htm", "2.htm"] and got["a"]["n_original"] == 1
    row = spark.range(1).select(X.percent(F.lit(1), F.lit(8)), X.percent(F.lit(1), F.lit(0)), X.grouped(F.lit(1234567))).first()
    assert tuple(row) == ("12.5%", "", "1,234,567")


def test_fields_of_a_firm_are_evaluated_once(spark):
    """Written out in all that is made of them, the patterns of a firm's fields made a plan too large to be compiled."""
    plan = M.firm_summary(frame(spark, "x").select(F.lit("a_1").alias("directory"), "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("in_force|") <= 4 and plan.count("338h10") <= 4  # 204 and 74 copies


def test_plain_front_matter_is_what_the_loader_makes_of_it():
    import yaml

    values = ["", " ", " Order 12", " yes", " No", " null", " 2001-02-03", " 2001-02-30", " [N, O]", " [no, O]", " [a b, c-d]", " a: b", " a #c", " - x", " 12", " 1e3", " .5", " [a,b]", " [a, ]", " []", " 'q'", " a.b/c-d ", "  two", "x", " ~", " é", " true x", "\ty", " a -", " On"]
    n = 0
    for key in ("title", "yes", "tax-asset-type", "a b"):
        for v in values:
            block = f"k: first\n{key}:{v}\nk: Last one"
            own = M._plain_yaml(block)
            if own is not None:
                n += 1
                want = yaml.safe_load(block)
                assert {k: x if isinstance(x, list) or x is None else str(x) for k, x in want.items()} == own, block
    assert n >= 16


def test_front_matter_is_parsed_once_a_file(spark):
    files = frame(spark, "---\ntitle: A\n---\n## TRA Timeline\n- 2001-01-02: a\n- 2003-01-02: b\n- 2002-01-02: c\n", "---\ntitle: B\n---\nx").select(F.concat(F.lit("f_1/"), F.col("id").cast("string"), F.lit("_summary.qmd")).alias("path"), "text")
    table = M.agreements_and_events(files)[0]
    assert sorted((r["title"], r["last_event_date"]) for r in table.collect()) == [("A", "2003-01-02"), ("B", "")]
    assert table._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_mentions_take_one_pass_of_python(spark):
    pages = [f"<p>&nbsp;\x1f a  \t b</p><p></p><br><br>\n &amp;{NAME}&#8232;", f"　\x85 {NAME} ", "x\r\n \x1c", "", None]
    df = frame(spark, *pages)
    found = M.mentions(df, "text", ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython") == 1
    want = df.select("id", F.explode(M.mention_windows(X.lines_of_html("text"))).alias("m")).select("id", "m.*")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and want.count() == 2
    lines = [r[0] for r in df.select("id", X.without_tags("text").alias("rest"), X.lines_of_html("text").alias("t")).orderBy("id").select(F.struct("rest", "t")).collect()]
    assert [x["t"] for x in lines] == [None if x["rest"] is None else X.lines_of_rest(x["rest"]) for x in lines]
