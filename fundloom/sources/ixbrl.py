"""Tagged facts in prospectus documents, found by regular expression over the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fundloom.functions.text import (
    FALLBACK_EXPENSE, FALLBACK_TURNOVER, expense_ratios, find_first, is_html, is_xbrl,
    percent_from_text, prospectus_records, share_classes, turnover_rates,
)
from fundloom.operators.joins import context_join_facts
from fundloom.session import materialize

# What the name of a tag (its local part) or its name attribute contains, per kind of fact.
SERIES_TAG = r"SeriesId|SeriesClassId"
CLASS_TAG = r"ClassContractId|ClassId|ClassContract"
EXPENSE_TAG = r"ExpenseRatio"
TURNOVER_TAG = r"Turnover"
LABEL_EXPENSE = r"netexpenseratio|netexp|expenseratio"
LABEL_TURNOVER = r"portfolioturnover|turnover"
WANTED = r"(?i)series|class|netexp|expenseratio|turnover"

# An element with attributes and direct text: name, attributes, text up to the next tag.
ELEMENT = r"(?s)<([A-Za-z][\w:.-]*)((?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))+)\s*>([^<]*)"


def _attribute(attributes: Column, name: str) -> Column:
    return find_first(attributes, rf"\b(?i:{name})\s*=\s*[\"']([^\"']*)[\"']", "")


def _elements(body: Column) -> Column:
    """Attributed elements of one document that name a series, class, expense ratio or turnover."""
    found = F.transform(
        F.regexp_extract_all(body, F.lit(ELEMENT), 0),
        lambda e: F.struct(
            F.regexp_extract(e, ELEMENT, 1).alias("tag"),
            _attribute(F.regexp_extract(e, ELEMENT, 2), "contextref").alias("context_ref"),
            _attribute(F.regexp_extract(e, ELEMENT, 2), "name").alias("name"),
            F.trim(F.regexp_extract(e, ELEMENT, 3)).alias("text_value"),
        ),
    )
    return F.filter(
        found,
        lambda e: (e["text_value"] != "")
        & (
            e["tag"].rlike(WANTED)
            | F.coalesce(e["name"].rlike(WANTED), F.lit(False))
            | F.coalesce(e["context_ref"].rlike(WANTED), F.lit(False))
        ),
    )


def scan_documents(documents: DataFrame) -> DataFrame:
    """The one pass over the texts: per document its prospectus records, or its relevant elements and the
    values of its sentences. What is left is a small fraction of the text.

    Whoever explodes the arrays uses the outer form and filters afterwards: a plain explode makes the optimizer
    test the array for emptiness below the extraction, which would run every pattern again.
    """
    plain = F.col("is_plain")

    def sentence(pattern: str) -> Column:
        return F.when(~plain, find_first(F.col("body"), pattern, "(?Ui)").try_cast("double") / 100.0)

    marked = documents.select(
        "doc_id", "body", (is_html("body") & ~is_xbrl("body")).alias("is_plain")
    )
    found = marked.select(
        "doc_id",
        "is_plain",
        F.when(plain, share_classes("body")).alias("classes"),
        F.when(plain, expense_ratios("body")).alias("ratios"),
        F.when(plain, turnover_rates("body")).alias("turns"),
        F.when(~plain, _elements(F.col("body"))).alias("elements"),
        sentence(FALLBACK_EXPENSE).alias("s_expense"),
        sentence(FALLBACK_TURNOVER).alias("s_turnover"),
    )
    records = prospectus_records(F.col("classes"), F.col("ratios"), F.col("turns"))
    return found.withColumn("records", records).drop("classes", "ratios", "turns")


def _element_rows(scanned: DataFrame) -> DataFrame:
    rows = scanned.select("doc_id", F.posexplode_outer("elements").alias("position", "e"))
    return rows.where(F.col("position").isNotNull()).select("doc_id", "position", "e.*", percent_from_text(F.col("e.text_value")).alias("value"))


def ixbrl_facts(scanned: DataFrame) -> DataFrame:
    """Elements with what they say: a series, a class, an expense ratio or a turnover."""
    local, name = F.substring_index("tag", ":", -1), F.coalesce("name", F.lit(""))

    def kind(label: str, hit: Column) -> Column:
        return F.when(hit, F.lit(label))

    stated = F.array_compact(
        F.array(
            kind("series", local.rlike(SERIES_TAG)),
            kind("class", local.rlike(CLASS_TAG)),
            kind("expense", local.rlike(EXPENSE_TAG) | name.rlike(EXPENSE_TAG)),
            kind("turnover", local.rlike(TURNOVER_TAG) | name.rlike(TURNOVER_TAG)),
        )
    )
    return _element_rows(scanned).withColumn("kind", F.explode(stated))


def _first_value(kind: str) -> Column:
    known = (F.col("label_kind") == kind) & F.col("value").isNotNull()
    return F.min_by(F.when(known, F.col("value")), F.when(known, F.col("position")))


def fund_level_records(scanned: DataFrame) -> DataFrame:
    """One record per document from the first labelled non-fraction or non-numeric element of each kind,
    else from a sentence in the text."""
    label = F.lower(F.coalesce("name", "context_ref"))
    labelled = _element_rows(scanned).where(F.col("tag").contains("non") & label.isNotNull())
    either = labelled.withColumn(
        "label_kind",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(label.rlike(LABEL_EXPENSE), F.lit("expense")),
                    F.when(label.rlike(LABEL_TURNOVER), F.lit("turnover")),
                )
            )
        ),
    )
    tagged = either.groupBy("doc_id").agg(
        _first_value("expense").alias("tag_expense"), _first_value("turnover").alias("tag_turnover")
    )
    joined = scanned.join(tagged, "doc_id", "left").select(
        "doc_id",
        F.lit(None).cast("string").alias("series_id"),
        F.lit(None).cast("string").alias("class_id"),
        F.lit("fund_level").alias("context_ref"),
        F.coalesce("tag_expense", "s_expense").alias("net_expense_ratio"),
        F.coalesce("tag_turnover", "s_turnover").alias("turnover_pct"),
    )
    return joined.where(F.col("net_expense_ratio").isNotNull() | F.col("turnover_pct").isNotNull())


RECORD = ["doc_id", "series_id", "class_id", "context_ref", "net_expense_ratio", "turnover_pct"]


def ixbrl_records(scanned: DataFrame) -> DataFrame:
    """Records per context; documents without any fall back to one fund-level record."""
    by_context = context_join_facts(ixbrl_facts(scanned)).select(*RECORD)
    rest = scanned.join(by_context.select("doc_id").distinct(), "doc_id", "left_anti")
    return by_context.unionByName(fund_level_records(rest))


def html_records(scanned: DataFrame) -> DataFrame:
    rows = scanned.select("doc_id", F.explode_outer("records").alias("r"))
    return rows.where(F.col("r").isNotNull()).select("doc_id", F.lit(None).cast("string").alias("series_id"), "r.*").select(*RECORD)


def extract_records(documents: DataFrame) -> DataFrame:
    """Prospectus parsing for plain HTML documents, tagged facts for the others.

    The texts are read once; joins and fallbacks work on the materialized findings.
    """
    scanned = materialize(scan_documents(documents))
    return html_records(scanned.where("is_plain")).unionByName(ixbrl_records(scanned.where("not is_plain")))


def kinds(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        is_html("body").alias("is_html"),
        is_xbrl("body").alias("is_xbrl"),
        F.length("body").cast("bigint").alias("length"),
    )
