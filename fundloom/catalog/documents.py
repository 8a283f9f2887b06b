"""Extraction jobs over whole document texts.

The given texts are invented prose, so each gets a sentence built from its own columns in front; the
patterns then run over the sentence and the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fundloom.catalog.registry import d, i, over, query, r, view
from fundloom.catalog.sources import index_documents
from fundloom.functions import scalars, text as T
from fundloom.operators import joins
from fundloom.plans import views
from fundloom.sources import filings, ixbrl, managers

TENURE_SENTENCES = [
    "The adviser has run the fund since {y}.",
    "Jane Doe joined the firm in May {y}.",
    "John Roe was appointed co-manager in 1965.",
    "Portfolio Manager of the fund since January {y}",
    "She has managed the fund since 2030.",
    "No manager is named here.",
    "SINCE 1971. Appointed to the board in {y}.",
    "He has been the portfolio manager since June {y}.",
]
INCEPTION_SENTENCES = [
    "The fund commenced operations on January {n}, {y}.",
    "Inception date: Mar {n} {y}",
    "It was established on Smarch {n}, {y} while the fund began operations on May {n}, {y}.",
    "It was established September {n} {y}.",
    "It has no stated start.",
    "commenced operations in AUGUST {n}, {y}. Inception date: Mar 1 1950",
]
AMOUNTS = ["{n} bps", "{n}.5 % of assets", "about {n}", "0.{n}", "no number", "{n} of 7 BPS or 3 %"]


def _filled(sentences: list[str]) -> Column:
    """The sentence a document's id picks, with a year and a day from the id."""
    year = (1990 + F.col("doc_id") % 11).cast("string")
    day = (1 + F.col("doc_id") % 28).cast("string")
    chosen = F.get(F.array(*[F.lit(s) for s in sentences]), (F.col("doc_id") % len(sentences)).cast("int"))
    return F.replace(F.replace(chosen, F.lit("{y}"), year), F.lit("{n}"), day)


def _texts(spark, sf, sentences: list[str]) -> DataFrame:
    docs = views.table(spark, sf, "documents")
    filed = F.date_add(F.lit("1992-01-15").cast("date"), (F.col("n_chars") % 5000).cast("int"))
    return docs.select(
        "doc_id",
        filed.alias("filing_date"),
        F.concat(_filled(sentences), F.lit(" \n"), F.col("text")).alias("body"),
    )


def _texts_sql(sentences: list[str]) -> str:
    listed = ", ".join(f"'{s}'" for s in sentences)
    return f"""SELECT doc_id, DATE '1992-01-15' + CAST(n_chars % 5000 AS INTEGER) AS filing_date,
      replace(replace([{listed}][doc_id % {len(sentences)} + 1], '{{y}}', CAST(1990 + doc_id % 11 AS VARCHAR)),
        '{{n}}', CAST(1 + doc_id % 28 AS VARCHAR)) || ' ' || chr(10) || text AS body FROM documents"""


view("tenure_texts", _texts_sql(TENURE_SENTENCES))
view("inception_texts", _texts_sql(INCEPTION_SENTENCES))
view("amount_texts", _texts_sql(AMOUNTS))
view(
    "prospectus_texts",
    """SELECT lpad(CAST(doc_id % 37 AS VARCHAR), 10, '0') AS cik, t.doc_id, t.filing_date, t.body || chr(10) || i.body AS body
      FROM tenure_texts t JOIN inception_texts i USING (doc_id)""",
    ["tenure_texts", "inception_texts"],
)


def _number(pattern: str, flags: str = "") -> str:
    return f"TRY_CAST(nullif(regexp_extract(trim(body), '{pattern}', 1{flags}), '') AS DOUBLE)"


_N = r"(\d+(?:\.\d+)?)"
_PERCENT = f"""coalesce({_number(_N + r"\s*bps", ", 'i'")} / 10000, {_number(_N + r"\s*%")} / 100,
  CASE WHEN {_number(_N)} < 1 THEN {_number(_N)} ELSE {_number(_N)} / 100 END)"""


@query(
    "percent_from_text",
    over(["amount_texts"], f"SELECT doc_id, {r(_PERCENT, 'fraction', 8)} FROM amount_texts"),
    digits=8,
)
def percent_from_text(spark, sf):
    return _texts(spark, sf, AMOUNTS).select("doc_id", T.percent_from_text("body").alias("fraction"))


def _all(patterns: list[str], flags: str) -> str:
    found = [f"regexp_extract_all(body, '{p}', 1{flags})" for p in patterns]
    return "flatten([" + ", ".join(found) + "])"


@query(
    "manager_tenure",
    over(["tenure_texts"], f"""SELECT doc_id, CAST(year(filing_date) - list_max(list_filter(list_transform(
        {_all(T.TENURE_PATTERNS, ", 'i'")}, lambda x: TRY_CAST(x AS INTEGER)),
        lambda x: x BETWEEN 1970 AND year(filing_date))) AS DOUBLE) AS manager_tenure FROM tenure_texts"""),
)
def manager_tenure(spark, sf):
    return _texts(spark, sf, TENURE_SENTENCES).select(
        "doc_id", T.manager_tenure("body", "filing_date").alias("manager_tenure")
    )


_TENURE = f"""CAST(year(filing_date) - list_max(list_filter(list_transform({_all(T.TENURE_PATTERNS, ", 'i'")},
  lambda x: TRY_CAST(x AS INTEGER)), lambda x: x BETWEEN 1970 AND year(filing_date))) AS DOUBLE)"""
_INCEPTION = f"""list_filter(list_transform({_all(T.INCEPTION_PATTERNS, ", 'i'")}, lambda x: CAST(coalesce(
  try_strptime(regexp_replace(replace(x, ',', ''), '\\s+', ' ', 'g'), '%B %d %Y'),
  try_strptime(regexp_replace(replace(x, ',', ''), '\\s+', ' ', 'g'), '%b %d %Y')) AS DATE)),
  lambda x: x IS NOT NULL)[1]"""


@query(
    "inception_date",
    over(["inception_texts"], f"SELECT doc_id, {d('inception', 'inception_date')} FROM (SELECT doc_id, {_INCEPTION} AS inception FROM inception_texts)"),
)
def inception_date(spark, sf):
    return _texts(spark, sf, INCEPTION_SENTENCES).select(
        "doc_id", T.inception_date("body").alias("inception_date")
    )


@query(
    "manager_records",
    over(["prospectus_texts"], f"""SELECT cik, series_id, class_id, {r('manager_tenure')}, {r('(filing_date - inception) / 365.25', 'fund_age')},
      {d('inception', 'inception_date')}, {d('filing_date', 'asof')} FROM (
        SELECT cik, filing_date, {_TENURE} AS manager_tenure, {_INCEPTION} AS inception FROM prospectus_texts
        QUALIFY row_number() OVER (PARTITION BY cik ORDER BY filing_date DESC, doc_id DESC) = 1)
      JOIN (SELECT lpad(CAST(s_nationkey AS VARCHAR), 10, '0') AS cik, 'S' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS series_id,
        'C' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS class_id FROM supplier) USING (cik)"""),
)
def manager_records(spark, sf):
    """What the latest prospectus of each registrant tells of its managers, for every class."""
    filed = F.date_add(F.lit("1992-01-15").cast("date"), (F.col("n_chars") % 5000).cast("int"))
    docs = views.table(spark, sf, "documents").select(
        (F.col("doc_id") % 37).cast("string").alias("cik"), filed.alias("filing_date"), F.col("doc_id").alias("accession"),
        F.concat(_filled(TENURE_SENTENCES), F.lit(" \n"), F.col("text"), F.lit("\n"),
                 _filled(INCEPTION_SENTENCES), F.lit(" \n"), F.col("text")).alias("body"),
    )
    classes = views.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("cik")).agg(
        F.array(F.concat(F.lit("S"), F.lpad(F.first(F.col("s_nationkey").cast("string")), 4, "0"))).alias("series_ids"),
        F.collect_list(F.concat(F.lit("C"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))).alias("class_ids"),
    )
    return managers.manager_records(classes, docs).drop("record")


@query(
    "fund_age_years",
    over(["inception_texts"], f"SELECT doc_id, {r('(filing_date - inception) / 365.25', 'fund_age')} FROM (SELECT doc_id, filing_date, {_INCEPTION} AS inception FROM inception_texts)"),
)
def fund_age_years(spark, sf):
    dated = _texts(spark, sf, INCEPTION_SENTENCES).select(
        "doc_id", "filing_date", T.inception_date("body").alias("inception")
    )
    return dated.select(
        "doc_id", T.fund_age_years(F.col("filing_date"), F.col("inception")).alias("fund_age")
    )


PROSPECTUS = [
    "Class INV and Class ADM. Net expense ratio: 0.45% and more. \nTotal annual fund operating expenses 1.25%. \nPortfolio turnover rate 35%",
    "Growth Fund (VHCOX) Fund RET Shares expense ratio 0.385% while the turnover rate was 12%",
    "Class A and Class B pay an expense ratio of 1.1%",
    "Class INV, Class RET, Class ADM, ADV Shares, XYZ Shares, QRS Shares, TUV Shares: the annual fund operating expenses are 0.75%",
    "Nothing is said about costs.",
    "Class ONE. <b>Portfolio turnover rate</b> of 80% <i xbrl>",
]


def _prospectuses(spark, sf) -> DataFrame:
    pages = views.table(spark, sf, "pages").withColumnRenamed("page_id", "doc_id")
    sentence = _filled(PROSPECTUS)
    return pages.select(
        "doc_id", F.concat(F.lit("<HTML>"), sentence, F.lit(" \n"), F.col("html")).alias("body")
    )


view(
    "prospectuses",
    f"""SELECT page_id AS doc_id, '<HTML>' || [{", ".join("'" + s.replace(chr(10), "' || chr(10) || '") + "'" for s in PROSPECTUS)}]
      [page_id % {len(PROSPECTUS)} + 1] || ' ' || chr(10) || html AS body FROM pages""",
)


def _prospectus_ctes(source: str) -> dict[str, str]:
    """Classes, ratios and turnovers of the plain prospectuses among the documents of `source`, a row for each class
    in `numbered`."""
    return {
        "found": f"""SELECT doc_id, {_HTML} AND NOT ({_XBRL}) AS is_plain,
          list_filter({_all(T.CLASS_PATTERNS, "")}, lambda x: length(x) BETWEEN 2 AND 6) AS named,
          list_transform({_all(T.EXPENSE_PATTERNS, "")}, lambda x: CAST(x AS DOUBLE) / 100) AS ratios,
          list_transform({_all(T.TURNOVER_PATTERNS, "")}, lambda x: CAST(x AS DOUBLE) / 100) AS turns FROM {source}""",
        "classed": """SELECT *, list_filter(named, lambda x, k: list_position(named, x) = k) AS classes FROM found
          WHERE is_plain""",
        "numbered": """SELECT *, unnest(range(1, len(classes) + 1)) AS k FROM classed
          WHERE len(ratios) > 0 OR len(turns) > 0""",
    }


_HTML = "(lower(body) LIKE '%<html>%' OR contains(body, '<TYPE>'))"
_XBRL = "lower(body) LIKE '%xbrl%' OR contains(body, 'contextRef')"
_CLASS_RECORD = """doc_id, classes[k] AS class_id,
  CASE WHEN len(classes) = len(ratios) THEN 'html_class_' || (k - 1) ELSE 'html_fund_level' END AS context_ref,
  ratios[CASE WHEN len(classes) = len(ratios) THEN k ELSE 1 END] AS er,
  turns[CASE WHEN len(classes) = len(ratios) THEN k ELSE 1 END] AS tu"""


@query(
    "prospectus_html_extract",
    over(["prospectuses"], f"""SELECT doc_id, class_id, context_ref, {r('er', 'net_expense_ratio', 8)}, {r('tu', 'turnover_pct', 8)}
      FROM (SELECT {_CLASS_RECORD} FROM numbered)""", _prospectus_ctes("prospectuses")),
    digits=8,
)
def prospectus_html_extract(spark, sf):
    scanned = ixbrl.scan_documents(_prospectuses(spark, sf))
    return ixbrl.html_records(scanned).drop("series_id")


def _tagged(spark, sf) -> DataFrame:
    """Inline-tagged documents by id: values per context, a labelled element only, a sentence only, nothing;
    and plain prospectuses."""
    key = F.col("doc_id")
    k = key.cast("string")
    percent = F.format_string("%.2f", (key % 150) / 100.0)
    turn = (key % 90 + 1).cast("string")
    contexts = F.concat(
        F.lit('<xbrl xmlns:dei="d"><dei:SeriesId contextRef="c1">S'), k, F.lit("</dei:SeriesId>"),
        F.lit('<dei:ClassContractId contextRef="c1"> C'), k, F.lit("a </dei:ClassContractId>"),
        F.lit('<dei:ClassContractId contextRef=\'c2\'>C'), k, F.lit("b</dei:ClassContractId>"),
        F.lit('<rr:NetExpenseRatio contextRef="c1" decimals="4">'), percent, F.lit("%</rr:NetExpenseRatio>"),
        F.lit('<ix:nonFraction name="rr:PortfolioTurnoverRate" contextRef="c2">'), turn, F.lit(" %</ix:nonFraction>"),
        F.lit('<rr:ExpenseRatio contextRef="c3">none</rr:ExpenseRatio></xbrl>'),
    )
    labelled = F.concat(
        F.lit('<xbrl><ix:nonFraction name="NetExpRatio">'), percent, F.lit("%</ix:nonFraction>"),
        F.lit('<ix:nonFraction name="rr:turnover">n/a</ix:nonFraction><p>Portfolio turnover was '), turn,
        F.lit("% of the average</p></xbrl>"),
    )
    sentence = F.concat(F.lit("<xbrl/>The NET expense  ratio is "), percent, F.lit(" %."))
    plain = F.concat(F.lit("<html>Class INV: expense ratio "), percent, F.lit("%</html>"))
    chosen = (
        F.when(key % 5 == 0, contexts).when(key % 5 == 1, labelled).when(key % 5 == 2, sentence)
        .when(key % 5 == 3, F.lit("<xbrl>no data</xbrl>")).otherwise(plain)
    )
    docs = views.table(spark, sf, "documents")
    return docs.select("doc_id", F.concat(chosen, F.lit("\n"), F.col("text")).alias("body"))


view(
    "tagged_documents",
    """SELECT doc_id, CASE doc_id % 5
      WHEN 0 THEN '<xbrl xmlns:dei="d"><dei:SeriesId contextRef="c1">S' || k || '</dei:SeriesId><dei:ClassContractId contextRef="c1"> C' || k
        || 'a </dei:ClassContractId><dei:ClassContractId contextRef=''c2''>C' || k
        || 'b</dei:ClassContractId><rr:NetExpenseRatio contextRef="c1" decimals="4">' || percent
        || '%</rr:NetExpenseRatio><ix:nonFraction name="rr:PortfolioTurnoverRate" contextRef="c2">' || turn
        || ' %</ix:nonFraction><rr:ExpenseRatio contextRef="c3">none</rr:ExpenseRatio></xbrl>'
      WHEN 1 THEN '<xbrl><ix:nonFraction name="NetExpRatio">' || percent
        || '%</ix:nonFraction><ix:nonFraction name="rr:turnover">n/a</ix:nonFraction><p>Portfolio turnover was ' || turn
        || '% of the average</p></xbrl>'
      WHEN 2 THEN '<xbrl/>The NET expense  ratio is ' || percent || ' %.'
      WHEN 3 THEN '<xbrl>no data</xbrl>'
      ELSE '<html>Class INV: expense ratio ' || percent || '%</html>' END || chr(10) || text AS body
    FROM (SELECT doc_id, text, CAST(doc_id AS VARCHAR) AS k, printf('%.2f', (doc_id % 150) / 100.0::DOUBLE) AS percent,
      CAST(doc_id % 90 + 1 AS VARCHAR) AS turn FROM documents)""",
)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _attribute_sql(name: str) -> str:
    pattern = rf"\b(?i:{name})\s*=\s*[\"']([^\"']*)[\"']"
    return f"nullif(regexp_extract(regexp_extract(e, {_quoted(ixbrl.ELEMENT)}, 2), {_quoted(pattern)}, 1), '')"


def _sentence_sql(pattern: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(body, {_quoted(pattern)}, 1, 'i'), '') AS DOUBLE) / 100"


def _hits(column: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({column}, {_quoted(pattern)}), false)"


_LOCAL = "string_split(tag, ':')[-1]"
_KNOWN_ROWS = "er IS NOT NULL OR tu IS NOT NULL"
_CONTEXT_CTES = {
    "tagged": f"""SELECT doc_id, {_sentence_sql(T.FALLBACK_EXPENSE)} AS s_expense, {_sentence_sql(T.FALLBACK_TURNOVER)} AS s_turnover,
      list_filter(list_transform(regexp_extract_all(body, {_quoted(ixbrl.ELEMENT)}, 0), lambda e: struct_pack(
        tag := regexp_extract(e, {_quoted(ixbrl.ELEMENT)}, 1), context_ref := {_attribute_sql("contextref")},
        name := {_attribute_sql("name")}, body := trim(regexp_extract(e, {_quoted(ixbrl.ELEMENT)}, 3)))),
        lambda e: e.body <> '' AND ({_hits("e.tag", ixbrl.WANTED)} OR {_hits("e.name", ixbrl.WANTED)}
          OR {_hits("e.context_ref", ixbrl.WANTED)})) AS elements
      FROM tagged_documents WHERE NOT {_HTML} OR {_XBRL}""",
    "listed": "SELECT doc_id, k, e.* FROM (SELECT doc_id, k, elements[k] AS e FROM (SELECT doc_id, elements, unnest(range(1, len(elements) + 1)) AS k FROM tagged))",
    "elements": f"""SELECT *, {_PERCENT} AS value, {_hits(_LOCAL, ixbrl.SERIES_TAG)} AS is_series, {_hits(_LOCAL, ixbrl.CLASS_TAG)} AS is_class,
      {_hits(_LOCAL, ixbrl.EXPENSE_TAG)} OR {_hits("name", ixbrl.EXPENSE_TAG)} AS is_expense,
      {_hits(_LOCAL, ixbrl.TURNOVER_TAG)} OR {_hits("name", ixbrl.TURNOVER_TAG)} AS is_turnover FROM listed""",
    "contexts": f"""SELECT * FROM (SELECT doc_id, arg_max(body, k) FILTER (WHERE is_series) AS series_id,
      arg_max(body, k) FILTER (WHERE is_class) AS class_id, context_ref,
      arg_max(value, k) FILTER (WHERE is_expense AND value IS NOT NULL) AS er,
      arg_max(value, k) FILTER (WHERE is_turnover AND value IS NOT NULL) AS tu
      FROM elements WHERE context_ref IS NOT NULL GROUP BY doc_id, context_ref) WHERE {_KNOWN_ROWS}""",
}
_RECORD_CTES = {
    **_CONTEXT_CTES,
    **_prospectus_ctes("tagged_documents"),
    "labelled": f"""SELECT doc_id, arg_min(value, k) FILTER (WHERE {_hits("label", ixbrl.LABEL_EXPENSE)} AND value IS NOT NULL) AS t_expense,
      arg_min(value, k) FILTER (WHERE {_hits("label", ixbrl.LABEL_TURNOVER)} AND value IS NOT NULL) AS t_turnover
      FROM (SELECT *, lower(coalesce(name, context_ref)) AS label FROM elements) WHERE contains(tag, 'non') GROUP BY doc_id""",
    "records": f"""SELECT doc_id, series_id, class_id, context_ref, er, tu FROM contexts
      UNION ALL SELECT doc_id, NULL, class_id, context_ref, er, tu FROM (SELECT {_CLASS_RECORD} FROM numbered)
      UNION ALL SELECT * FROM (SELECT doc_id, NULL, NULL, 'fund_level', coalesce(t_expense, s_expense) AS er,
        coalesce(t_turnover, s_turnover) AS tu FROM tagged LEFT JOIN labelled USING (doc_id)
        WHERE doc_id NOT IN (SELECT doc_id FROM contexts)) WHERE {_KNOWN_ROWS}""",
}
_RECORD = f"doc_id, series_id, class_id, context_ref, {r('er', 'net_expense_ratio', 8)}, {r('tu', 'turnover_pct', 8)}"


@query("context_join_facts", over(["tagged_documents"], f"SELECT {_RECORD} FROM contexts", _CONTEXT_CTES), digits=8)
def context_join_facts(spark, sf):
    return joins.context_join_facts(ixbrl.ixbrl_facts(ixbrl.scan_documents(_tagged(spark, sf))))


@query("ixbrl_fact_extract", over(["tagged_documents"], f"SELECT {_RECORD} FROM records", _RECORD_CTES), digits=8)
def ixbrl_fact_extract(spark, sf):
    return ixbrl.extract_records(_tagged(spark, sf))


@query(
    "fund_level_fallback",
    over(["tagged_documents"], f"""SELECT doc_id, class_id, {r('er', 'net_expense_ratio', 8)}, {r('tu', 'turnover_pct', 8)}
      FROM (SELECT * FROM own UNION ALL SELECT doc_id, class_id, er, tu FROM requested
        JOIN (SELECT doc_id, min(er) AS er, min(tu) AS tu FROM records WHERE context_ref = 'fund_level' GROUP BY doc_id) USING (doc_id)
        WHERE doc_id NOT IN (SELECT doc_id FROM own))""", {
        **_RECORD_CTES,
        "requested": """SELECT doc_id, unnest(CASE WHEN doc_id % 5 = 4 THEN ['C' || doc_id || 'b', 'C' || doc_id || 'z', 'INV']
          ELSE ['C' || doc_id || 'b', 'C' || doc_id || 'z'] END) AS class_id FROM documents""",
        "own": "SELECT doc_id, class_id, er, tu FROM requested JOIN records USING (doc_id, class_id)",
    }),
    digits=8,
)
def fund_level_fallback(spark, sf):
    docs = _tagged(spark, sf)
    key = F.col("doc_id").cast("string")
    wanted = F.array(
        F.concat(F.lit("C"), key, F.lit("b")), F.concat(F.lit("C"), key, F.lit("z")), F.lit("INV")
    )
    asked = F.when(F.col("doc_id") % 5 == 4, wanted).otherwise(F.slice(wanted, 1, 2))
    requested = docs.select("doc_id", F.explode(asked).alias("class_id"))
    return joins.fund_level_fallback(requested, ixbrl.extract_records(docs))


@query(
    "document_kind",
    """SELECT page_id AS doc_id, lower(html) LIKE '%<html>%' OR contains(html, '<TYPE>') AS is_html,
      lower(html) LIKE '%xbrl%' OR contains(html, 'contextRef') AS is_xbrl, length(html) AS length FROM pages
    UNION ALL SELECT doc_id, lower(text) LIKE '%<html>%' OR contains(text, '<TYPE>'),
      lower(text) LIKE '%xbrl%' OR contains(text, 'contextRef'), length(text) FROM documents""",
)
def document_kind(spark, sf):
    pages = views.table(spark, sf, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("html").alias("body")
    )
    docs = views.table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    return ixbrl.kinds(pages.unionByName(docs))


@query(
    "document_url_key",
    over(["index_rows"], f"""SELECT CAST(CAST(cik AS BIGINT) AS VARCHAR) || '/' || replace(accession, '-', '') || '/'
      || replace(primary_doc, 'xslFormNPORT-P_X01/', '') AS url_key, {i('length(accession)', 'n')} FROM index_rows"""),
)
def document_url_key(spark, sf):
    rows = filings.scan_filing_index(index_documents(spark, sf), since="", prefix="")
    key = scalars.document_url_key(F.col("cik"), F.col("accession"), F.col("primary_doc"))
    return rows.select(key.alias("url_key"), F.length("accession").alias("n"))
