"""Classification and predicates (C1-C6) as Column expressions.

Each set of words is merged into one alternation (compiled once per task), and
the ordered cascades are CASE WHEN chains, so the first hit wins exactly as in
an ordered scan, while staying inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.functions.staging import materialize
from hirewire.functions.sqlexpr import _array_sql, bound, sq
from hirewire.functions.text import col_, literal_alternation, py_strip

_SENIOR_RE = r"(?iU)\b(?:" + "|".join(dims.SENIOR_WORDS) + r")\b"
_INTERN_RE = r"(?iU)\b(?:" + "|".join(dims.INTERN_WORDS) + r")\b"
_CITY_RE = lambda cities: r"(?U)\b(?:" + "|".join(re.escape(c) for c in cities) + r")\b"
_CA_CITY_RE = _CITY_RE(dims.CA_CITIES)
_US_CITY_RE = _CITY_RE(dims.US_CITIES)
_CITY_REGION_RE = r"(?U)[A-Za-z\s]+,\s*([A-Z]{2})\b"
_ABBREV_TOKEN_RE = r"(?U)\b([A-Z]{2})\b"
_REMOTE_RE = r"(?U)\bremote\b"
_HYBRID_RE = r"(?U)\bhybrid\b"
_ONSITE_RE = r"(?U)\b(?:" + "|".join(dims.ONSITE_WORDS) + r")\b"


def is_entry_level(title) -> Column:
    """A non-empty title without any senior word (whole word, any case)."""
    t = col_(title)
    return F.coalesce(t.isNotNull() & (t != "") & ~t.rlike(_SENIOR_RE), F.lit(False))


def experience_level(title) -> Column:
    """C2: 'internship' when an intern word is present, otherwise 'new_grad'."""
    return F.when(col_(title).rlike(_INTERN_RE), F.lit("internship")).otherwise(F.lit("new_grad"))


def work_type(location) -> Column:
    """Remote, else hybrid, else onsite (whole words, lower-cased text)."""
    low = F.lower(col_(location))
    return (F.when(low.rlike(_REMOTE_RE), F.lit("remote"))
            .when(low.rlike(_HYBRID_RE), F.lit("hybrid"))
            .otherwise(F.lit("onsite")))


# One literal alternation per group: 16 small regexes instead of 233 substring probes,
# so the cascade stays inside whole-stage codegen's method-size limit.
_arr_sql = lambda values: _array_sql(tuple(values))
_GROUP_RES = [(name, literal_alternation(words)) for name, words in dims.CATEGORY_KEYWORDS]


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cascade_sql(padded: str, otherwise: str) -> str:
    whens = " ".join(f"WHEN {padded} RLIKE {sq(pat)} THEN {sq(name)}" for name, pat in _GROUP_RES)
    return f"CASE {whens} ELSE {otherwise} END"


def role_category_sql(t_pad: str, d_pad: str) -> str:
    """C6 as one Spark SQL expression over already padded, lower-cased title/department columns: the first keyword
    group hit in the title, else in the department (if not blank), else Other."""
    by_dept = f"CASE WHEN {d_pad} IS NOT NULL THEN {_cascade_sql(d_pad, sq(dims.DEFAULT_CATEGORY))} " \
              f"ELSE {sq(dims.DEFAULT_CATEGORY)} END"
    return _cascade_sql(t_pad, by_dept)


def country_sql(loc: str, low: str) -> str:
    """C4 as one Spark SQL expression (``low`` is the lower-cased location column): the ordered US/CA cascade; NULL
    when nothing matches. Quirks kept on purpose: the bare substring 'can' means Canada, 'usa' inside a word
    means US, a two-letter code after a comma is read as a region code."""
    codes = _arr_sql(dims.US_STATE_ABBREVS + dims.CA_PROVINCE_ABBREVS)
    us, ca = _arr_sql(dims.US_STATE_ABBREVS), _arr_sql(dims.CA_PROVINCE_ABBREVS)
    ca_only = _arr_sql([a for a in dims.CA_PROVINCE_ABBREVS if a not in dims.US_STATE_ABBREVS])
    region = f"regexp_extract({loc}, {sq(_CITY_REGION_RE)}, 1)"
    first = f"get(filter(regexp_extract_all({loc}, {sq(_ABBREV_TOKEN_RE)}, 1), x -> array_contains({codes}, x)), 0)"
    lit_re = lambda words: sq(literal_alternation(words))
    return f"""CASE
      WHEN contains({loc}, {sq(dims.US_FLAG)}) THEN 'US'
      WHEN contains({loc}, {sq(dims.CA_FLAG)}) THEN 'CA'
      WHEN {low} RLIKE {lit_re(dims.CA_INDICATORS)} THEN 'CA'
      WHEN {low} RLIKE {lit_re(dims.US_INDICATORS)} THEN 'US'
      WHEN array_contains({ca_only}, {region}) THEN 'CA'
      WHEN array_contains({us}, {region}) THEN 'US'
      WHEN {low} RLIKE {lit_re(dims.CA_PROVINCE_NAMES)} THEN 'CA'
      WHEN {low} RLIKE {lit_re(dims.US_STATE_NAMES)} THEN 'US'
      WHEN array_contains({us}, {first}) THEN 'US'
      WHEN array_contains({ca}, {first}) THEN 'CA'
      WHEN {low} RLIKE {sq(_CA_CITY_RE)} THEN 'CA'
      WHEN {low} RLIKE {sq(_US_CITY_RE)} THEN 'US'
      WHEN {low} RLIKE {sq(_REMOTE_RE)} THEN 'US'
      WHEN {low} RLIKE {sq(_ONSITE_RE)} THEN 'US'
    END"""


def with_role_category(df: DataFrame, title: str, department: str, out: str = "role_category", only: Column | None = None) -> DataFrame:
    """C6 staged: the padded title and the stripped, padded department are projected once
    (inside the CASE they would be re-derived at every branch). With ``only``, other rows aren't classified (NULL).

    The department's projection has a lambda, which ends the whole-stage method there: with what comes before it the cascade
    would exceed the 8000 bytes of a method that the JVM compiles."""
    p = "_rc_"
    of = lambda c: c if only is None else F.when(only, c)
    padded = lambda c: F.concat(F.lit(" "), F.lower(c), F.lit(" "))
    dept = bound(py_strip(F.coalesce(F.col(department), F.lit(""))), lambda d: F.when(d != "", padded(d)))
    df = df.withColumns({p + "t": of(padded(F.coalesce(F.col(title), F.lit("")))), p + "dp": of(dept)})
    df = df.withColumn(p + "out", of(F.expr(role_category_sql(p + "t", p + "dp"))))
    return df.drop(p + "t", p + "dp").withColumn(out, F.col(p + "out")).drop(p + "out")


def located() -> Column:
    """A non-empty location with a country."""
    return F.coalesce(F.col("location").isNotNull() & (F.col("location") != "") & F.col("country").isNotNull(), F.lit(False))


def with_country(df: DataFrame, location: str, out: str = "country") -> DataFrame:
    """C4 staged on the lower-cased location."""
    df = df.withColumn("_ct_low", F.lower(F.col(location)))
    return materialize(df, {out: F.expr(country_sql(_ident(location), "_ct_low"))}).drop("_ct_low")


def with_country_of(df: DataFrame, location: str, only: str, out: str = "country") -> DataFrame:
    """C4 for the rows where the column ``only`` holds (NULL for the others), as a projection: its code is compiled, where
    ``with_country``'s barrier interprets it. For frames that aren't filtered by the country afterwards."""
    df = df.withColumn("_ct_low", F.lower(F.col(location)))
    return df.withColumn(out, F.when(F.col(only), F.expr(country_sql(_ident(location), "_ct_low")))).drop("_ct_low")
