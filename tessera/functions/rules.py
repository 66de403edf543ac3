"""Tables of patterns and the rules made of them.

Every rule takes text columns and gives a column, so a caller may hand it other pattern
tables; the defaults are those of tax receivable agreements.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X
from .ids import basename, col

# Patterns of the agreement's name, its defined terms, and instruments of another kind.
MENTION = r"(?iU)tax\s+receivables?\s+agreements?"
TITLE_PHRASE = r"(?iU)tax\s+receivables?\s+agreement"
INCOME_PHRASE = r"(?iU)income\s+tax\s+receivables?\s+agreement"
TERMS = [
    r"(?iU)realized\s+tax\s+benefit",
    r"(?iU)hypothetical\s+tax\s+liability",
    r"(?iU)actual\s+tax\s+liability",
    r"(?iU)exchange\s+basis\s+schedule",
    r"(?iU)tax\s+benefit\s+schedule",
    r"(?iU)net\s+tax\s+benefit\s+payment",
    r"(?iU)early\s+termination\s+payment",
    r"(?iU)basis\s+adjustment",
    r"(?iU)section\s+754\s+election",
    r"(?iU)pre-?ipo\s+(?:holders|tax\s+assets)",
]
OTHER_INSTRUMENTS = [
    r"credit\s+agreement",
    r"employment\s+agreement",
    r"separation",
    r"indemnification\s+agreement",
    r"clearing\s+services\s+agreement",
    r"support\s+agreement",
    r"exchange\s+agreement",
    r"registration\s+rights\s+agreement",
    r"stockholders?\s+agreement",
    r"voting\s+agreement",
    r"unit\s+(?:award\s+)?(?:plan|agreement)",
    r"restricted\s+stock\s+unit",
    r"incentive\s+plan",
    r"limited\s+(?:liability\s+company|partnership)\s+agreement",
    r"agreement\s+of\s+limited\s+partnership",
    r"operating\s+agreement",
    r"merger\s+agreement",
    r"purchase\s+agreement",
    r"lease",
    r"promissory\s+note",
    r"warrant",
]
CONTRACT_SHAPE = r"(?isU)\b(?:WHEREAS|NOW,?\s+THEREFORE|IN\s+WITNESS\s+WHEREOF|ARTICLE\s+[IVX]+|Section\s+1\.0?1)\b"
CONTRACT_TITLE = r"(?isU)\b(?:(?:income\s+)?tax\s+receivables?\s+agreements?\b|tra\s+waiver(?:\s+and\s+assignment)?|tra\s+amendment|waiver\s+and\s+assignment\s+agreement.{0,80}tax\s+receivable)"
EXCLUDED_TITLE = r"(?isU)\b(?:credit\s+agreement|loan\s+agreement|indenture|guarantee\s+(?:agreement|and\s+collateral)|security\s+agreement|registration\s+rights\s+agreement|stockholders?\s+agreement|amended\s+and\s+restated\s+credit)|amendment\s+to\s+(?:the\s+)?credit\s+agreement"
MAIN_FORMS = r"FORM\s+10-K\b|FORM\s+10-Q\b|FORM\s+8-K\b|FORM\s+DEF\s*14A\b"
PROSPECTUS = r"FORM\s+S-1\b|REGISTRATION STATEMENT|PROSPECTUS"
EXHIBIT_MARK = r"EXHIBIT|EX-\d|EX\d"
EXHIBIT_TYPE = r"(?i)^EX-10($|[^0-9])"
EXHIBIT_SUBTYPE = r"(?i)^EX-10[.\-]"
EXHIBIT_NAME_LOOSE = r"(?i)^ex[-_.]?\d|exhibit\d|_exhibit_|dex\d|ex99"
EXHIBIT_NAME_BOUND = r"(?i)(?:^|[-_./])(ex[-_.]?\d|exhibit\d|dex\d|ex99)"
EXHIBIT_NAME_SHORT = r"(?i)ex-?\d"
INDEX_NAME = r"(?i)-index[-.]|^(?:index\.json|index\.htm|index\.html|filing-summary\.xml)$"
STATUS = r"`(in_force|terminated_\w+|transferred_offledger|economically_extinguished_in_force|never_executed)`"
TERMINATION_DATES = [
    r"terminated_\w+\s+(?:effective|on)\s+(\d{4}-\d{2}-\d{2})",
    r"(?i)\(?status\s+(?:flag\s+)?transition\s+(?:on|:?\s+)(\d{4}-\d{2}-\d{2})",
    r"(?is)`terminated_\w+`.*?effective\s+(\d{4}-\d{2}-\d{2})",
    r"(?i)(?:tra\s+)?(?:was\s+)?terminated\s+(?:on|effective)\s+(\d{4}-\d{2}-\d{2})",
]
PERCENT_REPLACED = [
    r"(?i)replaces\s+['\"]?(?:\w+\s+)?percent\s*\((\d{1,2})%?\)['\"]?\s+with\s+['\"]?(?:\w+\s+)?percent\s*\((\d{1,2})%?\)",
    r"(?is)(?:replaces|replaced)\s+['\"]?[^'\"]*?(\d{1,2})%[)'\"]*?\s+(?:with|to)\s+['\"]?[^'\"]*?(\d{1,2})%",
]
PERCENT_PLAIN = r"(?i)(\d{1,2})%\s+(?:of|to|payment|payout|sharing|share)"
ASSETS = {
    "section_754_step_up": r"(?i)section\s+754|basis\s+step-up|step-up",
    "pre_ipo_nol": r"(?i)pre-ipo\s+nol|net\s+operating\s+loss\s+carryforward",
    "338h10_basis_step_up": r"(?i)338\(h\)\(10\)|338h10",
    "option_deductions": r"(?i)option\s+deduction|compensatory\s+stock\s+option",
    "blocker_attributes": r"(?i)blocker\s+(?:nol|attributes|transferred)",
    "amt_credit": r"(?i)amt\s+credit",
}
PREAMBLE_DATE = r"(?i)THIS TAX RECEIVABLE AGREEMENT[,\s]+DATED\s+AS OF\s+([A-Z][A-Za-z]+\s+\d{1,2},\s+\d{4}|[A-Z][A-Za-z]+\s+\d{1,2}\s+\d{4}|\d{1,2}\s+[A-Z][A-Za-z]+\s+\d{4})"
EXECUTED = r"(?i)IN WITNESS WHEREOF|SIGNATURE PAGE|SIGNED|EXECUTED"
SMALL, LARGE, ENOUGH_TERMS, ENOUGH_MENTIONS, SHORTEST = 4_000, 1_200_000, 3, 3, 1_000
TYPICAL_FORMS = ["10-K", "10-Q", "8-K", "S-1", "S-4", "DEF 14A", "DEFA14A", "DEFM14A"]
BODY_FORMS = ["10-K", "10-K/A", "10-Q", "10-Q/A", "8-K", "8-K/A", "20-F", "40-F", "6-K", "DEF 14A", "DEFA14A", "DEFM14A", "PRE 14A"]
EXHIBIT_FORMS = ["8-K", "8-K/A", "S-1", "S-1/A", "S-4", "S-4/A", "DRS", "DRS/A", "10-K", "10-Q"]


def any_word(patterns, flags: str = "iU") -> str:
    """One pattern for whole words of any of the patterns."""
    return rf"(?{flags})\b(?:" + "|".join(patterns) + r")\b"


def typical_form(form, forms=TYPICAL_FORMS, prefix: str = "424B") -> Column:
    return F.coalesce(col(form).isin(forms) | col(form).startswith(prefix), F.lit(False))


def exhibit_name(path, pattern: str = EXHIBIT_NAME_LOOSE) -> Column:
    """Does the last part of a path look like an exhibit? False for null."""
    return X.matches(basename(path), pattern)


def exhibit_type(kind, pattern: str = EXHIBIT_TYPE) -> Column:
    return X.matches(kind, pattern)


def keep_or_drop(text, title, size, extension, phrase: str = TITLE_PHRASE, terms=TERMS, others=OTHER_INSTRUMENTS) -> Column:
    """Seven rules, the first that holds decides. Struct of decision, reason and the signals.

    others: patterns of words, or one pattern for all of them as it is.
    """
    n = X.n_patterns(text, terms)
    said, titled = X.matches(text, phrase), X.matches(title, phrase)
    other = X.matches(title, others if isinstance(others, str) else any_word(others)) & ~titled
    unread = F.lower(col(extension)) == ".pdf"
    size = col(size)
    number = size.cast("string")
    rules = [
        (unread, "keep", F.lit("PDF exhibit; not keyword-scannable, needs manual review")),
        (titled, "keep", F.lit("centered title contains 'tax receivable agreement'")),
        (other & ~said, "drop", F.lit("title names a non-TRA instrument; no TRA phrase")),
        (said, "keep", F.lit("'tax receivable agreement' phrase present in body")),
        (n >= ENOUGH_TERMS, "keep", F.concat(n.cast("string"), F.lit(" TRA-specific defined terms present"))),
        (size < SMALL, "drop", F.concat(F.lit("file too small ("), number, F.lit(f" B < {SMALL}), no phrase"))),
        (size > LARGE, "drop", F.concat(F.lit("large filing ("), number, F.lit(" B) with no TRA phrase or terms"))),
    ]
    decision, reason = F.lit("drop"), F.lit("no TRA title, phrase, or defining terminology")
    for holds, what, why in reversed(rules):
        decision, reason = F.when(holds, what).otherwise(decision), F.when(holds, why).otherwise(reason)
    shown = lambda c, none: F.when(unread, F.lit(none)).otherwise(c)  # noqa: E731  an unread file has no signals
    return F.struct(
        decision.alias("decision"), reason.alias("reason"), F.left(shown(F.coalesce(col(title), F.lit("")), ""), F.lit(300)).alias("title_block"), shown(titled, False).alias("title_has_phrase"),
        shown(other, False).alias("title_is_other"), shown(said, False).alias("phrase_present"), shown(X.matches(text, INCOME_PHRASE), False).alias("income_phrase"), shown(n, 0).cast("long").alias("n_terms"),
    )


def contract_by_title(body) -> Column:
    """Struct of is_contract and n_mentions; the latter is 0 where the title already rules the text out."""
    title = X.flat_html(body, 600)
    wrong = X.matches(title, EXCLUDED_TITLE) | ~X.matches(title, CONTRACT_TITLE)
    n = X.n_matches(body, MENTION)
    return F.struct((~wrong & (n >= ENOUGH_MENTIONS) & X.matches(body, CONTRACT_SHAPE)).alias("is_contract"), F.when(wrong, F.lit(0)).otherwise(n).cast("long").alias("n_mentions"))


def contract_by_preamble(text) -> Column:
    """Not a main form; a prospectus only as an exhibit; preamble, articles and some length."""
    upper = F.upper(col(text))
    unmarked = X.matches(upper, PROSPECTUS) & ~X.matches(F.left(upper, F.lit(1000)), EXHIBIT_MARK)
    shape = X.matches(upper, r"(?U)THIS\s+TAX\s+RECEIVABLES?\s+AGREEMENT") & X.matches(upper, r"(?U)ARTICLE\s+[IVX]+")
    return ~X.matches(upper, MAIN_FORMS) & ~unmarked & shape & F.coalesce(F.length(col(text)) >= SHORTEST, F.lit(False))


def document_kind(text) -> Column:
    """Termination, restatement, amendment or original; the first that fits."""
    upper = F.upper(col(text))
    number = X.first_group(upper, r"AMENDMENT\s+NO\.\s+(\d+)\s+TO")
    return (
        F.when(X.matches(upper, r"TERMINATION.*TAX RECEIVABLE AGREEMENT|NOTICE OF TERMINATION"), "termination")
        .when(X.matches(upper, r"AMENDED\s+AND\s+RESTATED\s+TAX\s+RECEIVABLE\s+AGREEMENT"), "amended_and_restated")
        .when(X.matches(upper, r"(?:FIRST|SECOND|THIRD|FOURTH|FIFTH)\s+AMENDMENT\s+TO\s+(?:.*?\s+)?TAX RECEIVABLE AGREEMENT"), "amendment_numbered")
        .when(number.isNotNull(), F.concat(F.lit("amendment_"), number))
        .when(X.matches(upper, r"AMENDMENT\s+TO\s+(?:.*?\s+)?TAX RECEIVABLE AGREEMENT"), "amendment_unnumbered")
        .otherwise("original")
    )


def preamble_date(text) -> Column:
    return X.first_group(text, PREAMBLE_DATE)


def executed(text) -> Column:
    return X.matches(text, EXECUTED)


def status_flag(text) -> Column:
    return X.first_group(text, STATUS)


def termination_date(text) -> Column:
    return F.coalesce(*[X.first_group(text, p) for p in TERMINATION_DATES])


def payment_percent(text) -> Column:
    """The percentage that replaces another, else the most frequent one."""
    found = F.coalesce(*[X.first_group(text, p, 2) for p in PERCENT_REPLACED], X.mode_text(F.regexp_extract_all(col(text), F.lit(PERCENT_PLAIN), F.lit(1))))
    return F.concat(found, F.lit("%"))


def asset_types(text) -> Column:
    """Names of the tax assets that a text speaks of, in order, joined by commas."""
    return F.array_join(F.array_compact(F.array(*[F.when(X.matches(text, ASSETS[name]), F.lit(name)) for name in sorted(ASSETS)])), ", ")


def firm_role(text) -> Column:
    """Role by the section on it: what its first line says, else which word the section holds more of."""
    section = F.lower(F.coalesce(X.first_group(text, r"(?is)(?:Role determination|Firm role)\s*\n+(.*?)(?:\n\n|\n##|\z)"), F.lit("")))
    line = F.trim(F.element_at(F.split(section, "\n"), 1))
    n = lambda word: F.regexp_count(section, F.lit(word))
    is_the, is_a = line.contains(" is the "), line.contains(" is a ")
    return (
        F.when(section == "", "mention_only")
        .when(section.contains("none of the five roles") | line.contains("classified role: none"), "mention_only")
        .when(line.rlike(r"^\*?\*?role\s*:\s*beneficiary"), "beneficiary")
        .when(line.rlike(r"^(?:\*?\*?role\s*:\s*pubco|pubco\s*[/-])"), "pubco")
        .when(is_the & (line.contains("public company") | F.left(line, F.lit(50)).contains("obligor")), "pubco")
        .when((is_the | is_a) & line.contains("beneficiary"), "beneficiary")
        .when(is_the, "mention_only")
        .when(is_a & (line.contains("public") | line.contains("obligor")), "pubco")
        .when(is_a, "mention_only")
        .when(n("beneficiary") > n("obligor"), "beneficiary")
        .when(section.contains("pubco") | section.contains("obligor"), "pubco")
        .otherwise("mention_only")
    )


def filing_bucket(form) -> Column:
    form = col(form)
    return (
        F.when(form.isin("S-1", "S-1/A"), "S-1")
        .when(form.isin("10-K", "10-K/A"), "10-K")
        .when(form.isin("10-Q", "10-Q/A"), "10-Q")
        .when(form.isin("8-K", "8-K/A"), "8-K")
        .when(form == "DEF 14A", "DEF 14A")
        .otherwise(F.coalesce(form, F.lit("")))
    )
