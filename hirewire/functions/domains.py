"""Company domain and logo resolution (L1-L8) as Column expressions.

The known-name table is a literal map (92 fixed entries): the lookup is a constant
expression inside the projection, so no join or broadcast is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.functions.sqlexpr import bound, in_list, map_lit
from hirewire.functions.text import PY_WS, col_, contains_any, py_strip
from hirewire.functions.urls import with_url_parts

_NOISE_RE = r"(?i)\b(?:" + "|".join(dims.NAME_NOISE_WORDS) + r")\b"


def _known_map() -> Column:
    return map_lit(dims.KNOWN_DOMAINS)


def hostname(netloc) -> Column:
    """``urlparse(...).hostname`` lower-cased: after the last '@', before the port."""
    info = F.substring_index(col_(netloc), "@", -1)
    host = F.when(info.contains("["), F.regexp_extract(info, r"\[([^\]]*)", 1)) \
            .otherwise(F.substring_index(info, ":", 1))
    return F.lower(host)


def registrable(host) -> Column:
    """L2: last two labels, or last three when the last two form a multi-part TLD."""
    h = col_(host)
    labels = F.split(h, r"\.", -1)
    n = F.size(labels)
    last2 = F.array_join(F.slice(labels, -2, 2), ".")
    last3 = F.array_join(F.slice(labels, -3, 3), ".")
    return F.when(n <= 2, h).when(in_list(last2, dims.MULTI_PART_TLDS), last3).otherwise(last2)


def _between(s: Column, marker: str) -> Column:
    seg = F.substring_index(F.substring_index(s, marker, 2), marker, -1)
    return F.when(F.substring_index(seg, "?", 1) != "", F.substring_index(seg, "?", 1))


def domain_from_logo_url(logo) -> Column:
    """L3: ``domain=`` query value, else the path after a clearbit / icon.horse prefix."""
    s = col_(logo)
    param = F.regexp_extract(s, r"[?&]domain=([^&]+)", 1)
    fallback = (F.when(s.contains("logo.clearbit.com/"), _between(s, "logo.clearbit.com/"))
                .when(s.contains("icon.horse/icon/"), _between(s, "icon.horse/icon/")))
    return F.when(s.isNotNull() & (s != ""), F.coalesce(F.when(param != "", param), fallback))


def normalize_name(name) -> Column:
    """L4: lower, non [a-z0-9] and non-space to space, collapse, strip."""
    return _normalized(F.lower(F.coalesce(col_(name), F.lit(""))))


def _normalized(s: Column) -> Column:
    s = F.regexp_replace(s, rf"(?U)[^a-z0-9{PY_WS}]", " ")
    s = F.regexp_replace(s, rf"(?U)[{PY_WS}]+", " ")
    return F.trim(s)


def favicon(domain) -> Column:
    d = col_(domain)
    pre, post = dims.FAVICON_TEMPLATE.split("{domain}")
    return F.when(d.isNotNull() & (d != ""), F.concat(F.lit(pre), d, F.lit(post))).otherwise(F.lit(""))


def search_logo(company) -> Column:
    """Favicon guess from the lower-cased company without spaces; '' for an empty company."""
    c = col_(company)
    guess = F.concat(F.replace(F.lower(c), F.lit(" "), F.lit("")), F.lit(".com"))
    return F.when(c.isNotNull() & (c != ""), favicon(guess)).otherwise(F.lit(""))


# ---------------------------------------------------------------------------
# Staged forms (see urls.with_url_parts): each intermediate is projected once.
# ---------------------------------------------------------------------------

def with_domain_from_url(df: DataFrame, url: str, out: str) -> DataFrame:
    """L1 staged."""
    p = "_du_"
    df = df.withColumn(p + "raw", py_strip(F.col(url)))
    raw = F.col(p + "raw")
    df = df.withColumn(p + "in", F.when(raw.contains("://"), raw).otherwise(F.concat(F.lit("http://"), raw)))
    df = with_url_parts(df, p + "in", p, prestrip=False)
    net = F.col(p + "netloc")
    host0 = hostname(net)
    df = df.withColumn(p + "host", F.when(host0.startswith("www."), F.substring(host0, 5, 1 << 30)).otherwise(host0))
    host = F.col(p + "host")
    df = df.withColumn(p + "reg", registrable(host))
    reg = F.col(p + "reg")
    ok = (F.col(url).isNotNull() & (raw != "") & F.col(p + "scheme").isin("http", "https")
          & (net.contains("[") == net.contains("]")) & (host != "") & host.contains(".")
          & ~in_list(reg, dims.NON_COMPANY_HOSTS) & ~in_list(host, dims.NON_COMPANY_HOSTS))
    df = df.withColumn(out, F.when(ok, reg))
    return df.drop(*[p + x for x in ("raw", "in", "scheme", "netloc", "path", "query", "fragment", "host", "reg")])


def with_domain_from_name(df: DataFrame, company: str, out: str) -> DataFrame:
    """L5 staged. The normalised name's projection has a lambda, which ends the whole-stage method there: together with that
    of L1 it would exceed the 8000 bytes of a method that the JVM compiles."""
    p = "_dn_"
    df = df.withColumn(p + "norm", bound(F.lower(F.coalesce(F.col(company), F.lit(""))), _normalized))
    norm = F.col(p + "norm")
    df = df.withColumns({p + "known": F.try_element_at(_known_map(), norm),
                         p + "t1": F.regexp_replace(F.regexp_replace(norm, _NOISE_RE, " "), r"[^a-z0-9]", "")})
    t1 = F.col(p + "t1")
    df = df.withColumn(p + "tok", F.when(F.length(t1) >= 2, t1).otherwise(F.regexp_replace(norm, r"[^a-z0-9]", "")))
    c, tok, known = F.col(company), F.col(p + "tok"), F.col(p + "known")
    df = df.withColumn(out, F.when(c.isNull() | (c == "") | (norm == ""), F.lit(None).cast("string"))
                       .when(known.isNotNull(), known)
                       .when(F.length(tok) >= 2, F.concat(tok, F.lit(".com"))))
    return df.drop(p + "norm", p + "known", p + "t1", p + "tok")


def with_resolved_logo(df: DataFrame, company: str, company_url: str | None, logo_url: str | None,
                       out_logo: str = "company_logo", out_domain: str = "company_domain") -> DataFrame:
    """L6 + L7 staged: ``out_domain`` ('' when nothing resolves) and ``out_logo``."""
    p = "_rl_"
    parts = []
    if company_url is not None:
        df = with_domain_from_url(df, company_url, p + "d1")
        parts.append(F.col(p + "d1"))
    if logo_url is not None:
        df = df.withColumn(p + "d2", domain_from_logo_url(F.col(logo_url)))
        parts.append(F.col(p + "d2"))
    df = with_domain_from_name(df, company, p + "d3")
    parts.append(F.col(p + "d3"))
    df = df.withColumn(p + "dom", F.coalesce(*parts))
    dom = F.col(p + "dom")
    if logo_url is None:
        logo = favicon(dom)
    else:
        lg = F.col(logo_url)
        real = lg.isNotNull() & (lg != "") & lg.startswith("http") & ~contains_any(lg, dims.GENERATED_LOGO_MARKERS)
        logo = F.when(real, lg).otherwise(favicon(dom))
    df = df.withColumns({p + "logo": logo, p + "domain": F.coalesce(dom, F.lit(""))})
    df = df.drop(*[p + x for x in ("d1", "d2", "d3", "dom")])
    return df.withColumns({out_logo: F.col(p + "logo"), out_domain: F.col(p + "domain")}) \
             .drop(p + "logo", p + "domain")
