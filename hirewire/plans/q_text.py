"""Registered queries for the text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirewire.functions import text as T
from hirewire.plans import sqlgen as S
from hirewire.plans.common import table

_TITLE_RE = r"(?s)<title>(.*?)</title>"


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "html")


def t1_html_unescape(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", T.html_unescape("html").alias("text"))


T1_SQL = f"SELECT page_id, {S.unescape4('html')} AS text FROM pages"


def t2_strip_tags(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", T.strip_tags_nl("html").alias("text"))


T2_SQL = f"SELECT page_id, {S.strip_tags_nl('html')} AS text FROM pages"


def t3_truncate_ellipsis(spark, sf_dir):
    p = _pages(spark, sf_dir).select("page_id", T.html_to_text("html").alias("t"))
    return p.select("page_id", F.col("t").alias("text"), T.truncate_ellipsis("t", 3000).alias("teaser"))


T3_SQL = (f"SELECT page_id, t AS text, {S.truncate_ellipsis('t', 3000)} AS teaser FROM "
          f"(SELECT page_id, {S.strip_tags_nl(S.unescape4('html'))} AS t FROM pages)")


def t4_truncate_plain(spark, sf_dir):
    p = _pages(spark, sf_dir).select("page_id", T.html_to_text("html").alias("t"))
    return p.select("page_id", F.col("t").alias("text"), T.truncate_plain("t", 5000).alias("teaser"))


T4_SQL = f"SELECT page_id, t AS text, substr(t, 1, 5000) AS teaser FROM (SELECT page_id, {S.strip_tags_nl(S.unescape4('html'))} AS t FROM pages)"


def t5_clean_cell(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", T.clean_cell("html").alias("cell"))


T5_SQL = f"SELECT page_id, {S.clean_cell('html')} AS cell FROM pages"


def t6_collapse_ws(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", T.collapse_ws("text").alias("text"))


T6_SQL = f"SELECT doc_id, {S.collapse_ws('text')} AS text FROM documents"


def t7_unicode_strip(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    padded = F.concat(F.lit(" \t "), F.col("text"), F.lit(" \n "))
    return c.select("conv_id", "turn", T.py_strip(padded).alias("text"))


T7_SQL = (f"SELECT conv_id, turn, {S.strip_re(S.sql_str(chr(0xa0) + chr(9) + ' ') + ' || text || ' + S.sql_str(' ' + chr(10) + chr(0x2003)))} "
          f"AS text FROM conversations")


def t8_description_concat(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    middle = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("source"))
    return d.select("doc_id", T.join_nonempty(["text", middle, F.col("lang")], "\n").alias("description"))


T8_SQL = (f"SELECT doc_id, array_to_string(list_filter([text, "
          f"CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, lang], lambda x: x IS NOT NULL AND x <> ''), {S.NL}) "
          f"AS description FROM documents")

# --- salary text derived from prices (integer cents, identical in both engines) ---


def _money(cents: Column) -> Column:
    d = F.floor(cents / 100).cast("long")
    whole = F.when(d >= 1000, F.concat(F.floor(d / 1000).cast("long").cast("string"), F.lit(","),
                                       F.lpad((d % 1000).cast("string"), 3, "0"))).otherwise(d.cast("string"))
    return F.concat(F.lit("$"), whole, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def _money_sql(c: str) -> str:
    d = f"({c} // 100)"
    return (f"('$' || CASE WHEN {d} >= 1000 THEN CAST({d} // 1000 AS VARCHAR) || ',' || "
            f"lpad(CAST({d} % 1000 AS VARCHAR), 3, '0') ELSE CAST({d} AS VARCHAR) END || '.' || "
            f"lpad(CAST({c} % 100 AS VARCHAR), 2, '0'))")


def _board_text(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.round(F.col("p_retailprice") * 100).cast("long").alias("c"))
    c, k = F.col("c"), F.col("p_partkey") % 5
    m1, m2 = _money(c), _money(c * 3)
    k1, k2 = F.floor(c / 1000).cast("long").cast("string"), F.floor(c * 3 / 1000).cast("long").cast("string")
    txt = (F.when(k == 0, F.concat(F.lit("Compensation: "), m1, F.lit(" - "), m2, F.lit(" / year. Apply now.")))
           .when(k == 1, F.concat(F.lit("Rate "), m1, F.lit("/hr or "), m1, F.lit(" – "), m2, F.lit(" yearly")))
           .when(k == 2, F.concat(F.lit("Band $"), k1, F.lit("K–$"), k2, F.lit("K")))
           .when(k == 3, F.concat(F.lit("SALARY "), m1, F.lit(" to "), m2))
           .otherwise(F.concat(F.lit("No range; see "), m1)))
    return p.select("p_partkey", "c", txt.alias("content"))


def _board_text_sql() -> str:
    m1, m2 = _money_sql("c"), _money_sql("c * 3")
    return f"""board AS (
  SELECT p_partkey, c, CASE p_partkey % 5
    WHEN 0 THEN 'Compensation: ' || {m1} || ' - ' || {m2} || ' / year. Apply now.'
    WHEN 1 THEN 'Rate ' || {m1} || '/hr or ' || {m1} || ' – ' || {m2} || ' yearly'
    WHEN 2 THEN 'Band $' || CAST(c // 1000 AS VARCHAR) || 'K–$' || CAST(c * 3 // 1000 AS VARCHAR) || 'K'
    WHEN 3 THEN 'SALARY ' || {m1} || ' to ' || {m2}
    ELSE 'No range; see ' || {m1} END AS content
  FROM (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS c FROM part))"""


def t9_salary_from_metadata(spark, sf_dir):
    b = _board_text(spark, sf_dir)
    k = F.col("p_partkey") % 5
    name2 = (F.when(k == 0, F.lit("Salary Range")).when(k == 1, F.lit("Compensation"))
             .when(k == 2, F.lit("Pay Band")).when(k == 3, F.lit("Team")))
    val2 = F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(_money(F.col("c")))
    meta = F.to_json(F.array(F.struct(F.lit("Department").alias("name"), F.lit("R&D").alias("value")),
                             F.struct(name2.alias("name"), val2.alias("value"))),
                     {"ignoreNullFields": "false"})
    parsed = b.select("p_partkey", F.try_variant_get(F.try_parse_json(meta), "$", "array<variant>").alias("m"))
    sal = parsed.select("p_partkey", T.salary_from_metadata("m").alias("s"))
    return sal.where(~F.col("s.broken")).select("p_partkey", F.col("s.salary").alias("salary_range"))


T9_SQL = f"""WITH {_board_text_sql()}
SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 1, 2) AND p_partkey % 3 <> 0 THEN {_money_sql('c')} ELSE '' END
       AS salary_range
FROM board WHERE p_partkey % 5 <> 4"""


def t10_salary_regex_board(spark, sf_dir):
    b = _board_text(spark, sf_dir)
    return b.select("p_partkey", T.salary_from_text_board("content").alias("salary_range"))


T10_SQL = (f"WITH {_board_text_sql()} SELECT p_partkey, "
           f"{S.salary_by_patterns('content', __import__('hirewire.functions.dims', fromlist=['x']).SALARY_PATTERNS_BOARD)}"
           f" AS salary_range FROM board")


def _postings_text(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("long").alias("c"))
    c, k = F.col("c"), (F.col("l_orderkey") + F.col("l_linenumber")) % 3
    hi = c + F.floor(c / 10).cast("long")
    desc = (F.when(k == 0, F.concat(F.lit("Base "), _money(c), F.lit(" - "), _money(hi)))
            .when(k == 1, F.concat(F.lit("Pay is "), _money(c)))
            .otherwise(F.lit("Great team")))
    extra = F.when(k == 1, F.lit("/ hour, paid weekly")).otherwise(F.lit(""))
    return li.select("l_orderkey", "l_linenumber", F.concat(desc, F.lit(" "), extra).alias("combined"))


def t11_salary_regex_postings(spark, sf_dir):
    t = _postings_text(spark, sf_dir)
    return t.select("l_orderkey", "l_linenumber", T.salary_from_text_postings("combined").alias("salary_range"))


def _t11_sql() -> str:
    from hirewire.functions import dims
    m, mh = _money_sql("c"), _money_sql("(c + c // 10)")
    return f"""WITH li AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS c,
                              (l_orderkey + l_linenumber) % 3 AS k FROM lineitem),
t AS (SELECT l_orderkey, l_linenumber,
             CASE k WHEN 0 THEN 'Base ' || {m} || ' - ' || {mh} WHEN 1 THEN 'Pay is ' || {m} ELSE 'Great team' END
             || ' ' || CASE WHEN k = 1 THEN '/ hour, paid weekly' ELSE '' END AS combined FROM li)
SELECT l_orderkey, l_linenumber, {S.salary_by_patterns('combined', dims.SALARY_PATTERNS_POSTINGS)} AS salary_range
FROM t"""


def t12_entity_decode_3(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", T.entity_decode_3(F.regexp_extract("html", _TITLE_RE, 1)).alias("company"),
                    T.entity_decode_3("html").alias("text"))


def _decode_sql(c: str) -> str:
    return f"replace(replace(replace({c}, '&amp;', '&'), '&#39;', chr(39)), '&quot;', chr(34))"


T12_SQL = (f"SELECT page_id, {_decode_sql(f'regexp_extract(html, {S.sql_str(_TITLE_RE)}, 1)')} AS company, "
           f"{_decode_sql('html')} AS text FROM pages")

QUERIES = {
    "T1_html_unescape": (t1_html_unescape, T1_SQL),
    "T2_strip_tags": (t2_strip_tags, T2_SQL),
    "T3_truncate_ellipsis": (t3_truncate_ellipsis, T3_SQL),
    "T4_truncate_plain": (t4_truncate_plain, T4_SQL),
    "T5_clean_cell": (t5_clean_cell, T5_SQL),
    "T6_collapse_ws": (t6_collapse_ws, T6_SQL),
    "T7_unicode_strip": (t7_unicode_strip, T7_SQL),
    "T8_description_concat": (t8_description_concat, T8_SQL),
    "T9_salary_from_metadata": (t9_salary_from_metadata, T9_SQL),
    "T10_salary_regex_board": (t10_salary_regex_board, T10_SQL),
    "T11_salary_regex_postings": (t11_salary_regex_postings, _t11_sql()),
    "T12_entity_decode_3": (t12_entity_decode_3, T12_SQL),
}
