"""Text operators (T1-T12) as Column expressions.

Python string semantics are reproduced on the JVM: ``str.strip`` strips Unicode
whitespace (``trim`` only strips spaces), ``\\s``/``\\d``/``\\b`` are Unicode
(``(?U)``), and ``html.unescape`` is the only step that needs Python at all.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from hirewire.functions import dims

# Python's whitespace set is Java's (?U)\s plus the four information separators.
PY_WS = r"\s\x1c-\x1f"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()`` -- Unicode whitespace at both ends (``trim`` strips spaces only)."""
    return F.regexp_replace(col_(c), rf"(?U)^[{PY_WS}]+|[{PY_WS}]+\z", "")


def is_blank(c) -> Column:
    """True when the value is NULL or ``not value.strip()``."""
    c = col_(c)
    return c.isNull() | (py_strip(c) == "")


@pandas_udf(StringType())
def _html_unescape_batch(s: pd.Series) -> pd.Series:
    import html

    return s.map(lambda x: None if x is None else html.unescape(x))


def html_unescape(c) -> Column:
    """One-pass HTML5 entity decoding (the full entity table, numeric references included).

    Only rows that contain '&' cross into Python: the argument is masked, so the Arrow
    batch carries NULL for every other row, and the original value is kept for them.
    """
    c = col_(c)
    return F.coalesce(_html_unescape_batch(F.when(c.contains("&"), c)), c)


def strip_tags_nl(c) -> Column:
    """Tags become newlines, 3+ newlines collapse to two, then ``strip``."""
    out = F.regexp_replace(col_(c), r"<[^>]+>", "\n")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return py_strip(out)


def html_to_text(c) -> Column:
    """T1 then T2: the description cleaner most boards share."""
    return strip_tags_nl(html_unescape(c))


def truncate_ellipsis(c, n: int) -> Column:
    """More than ``n`` code points -> first ``n`` plus '...'."""
    c = col_(c)
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def truncate_plain(c, n: int) -> Column:
    """T4: ``s[:n]``."""
    return F.substring(col_(c), 1, n)


def clean_cell(c) -> Column:
    """T5: unescape, tags to spaces, collapse 2+ whitespace, strip, strip commas, strip."""
    out = F.regexp_replace(html_unescape(F.coalesce(col_(c), F.lit(""))), r"<[^>]+>", " ")
    out = F.regexp_replace(out, rf"(?U)[{PY_WS}]{{2,}}", " ")
    out = F.regexp_replace(py_strip(out), r"^,+|,+\z", "")
    return py_strip(out)


def collapse_ws(c) -> Column:
    """Every whitespace run becomes one space, then strip (no tag removal)."""
    return py_strip(F.regexp_replace(col_(c), rf"(?U)[{PY_WS}]+", " "))


def join_nonempty(parts, sep: str) -> Column:
    """``sep.join(p for p in parts if p)`` (T8 and the location joins)."""
    arr = F.array(*[col_(p) for p in parts])
    return F.array_join(F.filter(arr, lambda x: x.isNotNull() & (x != "")), sep)


def salary_by_patterns(c, patterns) -> Column:
    """The first pattern (in priority order) with any match wins; '' when none."""
    c = col_(c)
    hits = [F.when(c.rlike("(?iU)" + p), F.regexp_extract(c, "(?iU)" + p, 0)) for p in patterns]
    return F.coalesce(*hits, F.lit(""))


def salary_from_text_board(c) -> Column:
    return salary_by_patterns(c, dims.SALARY_PATTERNS_BOARD)


def salary_from_text_postings(c) -> Column:
    return salary_by_patterns(c, dims.SALARY_PATTERNS_POSTINGS)


def entity_decode_3(c) -> Column:
    """Literal ``&amp;`` then ``&#39;`` then ``&quot;`` (order kept; not a full decoder)."""
    out = F.replace(col_(c), F.lit("&amp;"), F.lit("&"))
    out = F.replace(out, F.lit("&#39;"), F.lit("'"))
    return F.replace(out, F.lit("&quot;"), F.lit('"'))


def literal_alternation(words) -> str:
    """A regex matching any of ``words`` literally (each quoted)."""
    return "|".join(r"\Q" + w + r"\E" for w in words)


def contains_any(c, needles) -> Column:
    """Substring membership. Long lists become one quoted-literal regex: an OR-chain of
    ``contains`` generates a method too large for the JIT, which then runs interpreted."""
    c = col_(c)
    if len(needles) <= 4:
        return reduce(lambda a, b: a | b, [c.contains(n) for n in needles])
    return c.rlike(literal_alternation(needles))


def salary_from_metadata(items) -> Column:
    """T9 over ``array<variant>``: struct(salary, broken).

    ``salary`` is the value of the first object item whose lower-cased ``name`` contains
    salary/compensation/pay and whose value is truthy ('' when none). ``broken`` is true
    when an object item with a NULL or non-string name is reached first -- reading that
    name fails, so the whole record is dropped.
    """
    arr = col_(items)
    name_t = lambda it: F.schema_of_variant(F.try_variant_get(it, "$.name", "variant"))
    is_obj = lambda it: F.schema_of_variant(it).startswith("OBJECT")
    name = lambda it: F.lower(F.coalesce(F.try_variant_get(it, "$.name", "string"), F.lit("")))
    val = lambda it: F.try_variant_get(it, "$.value", "variant")
    truthy_val = lambda it: variant_truthy(val(it))
    bad = lambda it: is_obj(it) & F.try_variant_get(it, "$.name", "variant").isNotNull() \
        & (name_t(it) != "STRING")
    hit = lambda it: is_obj(it) & (name_t(it) == "STRING") & contains_any(name(it), dims.SALARY_METADATA_WORDS) \
        & F.coalesce(truthy_val(it), F.lit(False))
    idx = F.transform(arr, lambda it, i: F.struct(
        F.when(bad(it), i).alias("bad_at"), F.when(hit(it), i).alias("hit_at")))
    first_bad = F.array_min(F.transform(idx, lambda s: s["bad_at"]))
    first_hit = F.array_min(F.transform(idx, lambda s: s["hit_at"]))
    value = F.try_variant_get(F.get(arr, first_hit), "$.value", "string")
    broken = first_bad.isNotNull() & (first_hit.isNull() | (first_bad < first_hit))
    return F.struct(F.when(first_hit.isNotNull(), value).otherwise(F.lit("")).alias("salary"),
                    broken.alias("broken"))


def variant_truthy(v) -> Column:
    """Python truthiness of a JSON value held in a VARIANT (NULL when the path is absent), told from its JSON text."""
    v = col_(v)
    js = F.to_json(v)
    return (F.when(v.isNull(), F.lit(None).cast("boolean"))
            .when(js.isin("null", "false", '""', "[]", "{}"), F.lit(False))
            .when(F.substring(js, 1, 1).isin("t", '"', "[", "{"), F.lit(True))
            .otherwise(F.coalesce(v.try_cast("double") != 0, F.lit(True))))
