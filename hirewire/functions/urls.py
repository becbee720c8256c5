"""URL operators (U1-U6): a column-expression ``urlparse`` and the dedup normaliser.

``parse_url`` is not used: it returns NULL for URLs with spaces or ``_`` in the
host, raises under ANSI mode and keeps ``;params`` in the path. The split below
follows RFC 3986 the way Python's ``urlsplit``/``urlparse`` do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.functions.staging import materialize
from hirewire.functions.sqlexpr import in_list
from hirewire.functions.text import col_, py_strip

# FIXED VALUES: schemes whose last path segment may carry ``;params``.

_SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def url_split(url, prestrip: bool = True) -> Column:
    """struct(scheme, netloc, path, query, fragment), params cut from the last segment.

    Leading C0 controls/spaces are dropped and tab/CR/LF removed anywhere, as
    ``urlsplit`` does; the scheme is lower-cased, everything else keeps its case.
    """
    s = py_strip(url) if prestrip else col_(url)
    s = F.regexp_replace(F.regexp_replace(s, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    scheme_raw = F.regexp_extract(s, _SCHEME_RE, 1)
    scheme = F.lower(scheme_raw)
    rest = F.regexp_replace(s, _SCHEME_RE, "")
    has_net = rest.startswith("//")
    netloc = F.when(has_net, F.regexp_extract(rest, r"^//([^/?#]*)", 1)).otherwise(F.lit(""))
    rest = F.when(has_net, F.regexp_replace(rest, r"^//[^/?#]*", "")).otherwise(rest)
    fragment = F.regexp_extract(rest, r"(?s)^[^#]*#(.*)\z", 1)
    rest = F.regexp_extract(rest, r"(?s)^([^#]*)", 1)
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)\z", 1)
    path = F.regexp_extract(rest, r"(?s)^([^?]*)", 1)
    path = F.when(in_list(scheme, dims.USES_PARAMS) & path.contains(";"),
                  F.regexp_replace(path, r";[^/]*\z", "")).otherwise(path)
    return F.struct(scheme.alias("scheme"), netloc.alias("netloc"), path.alias("path"),
                    query.alias("query"), fragment.alias("fragment"))


def trim_path(path) -> Column:
    """Strip trailing '/', except that '/' itself stays."""
    p = col_(path)
    return F.when(p == "/", p).otherwise(F.regexp_replace(p, r"/+\z", ""))


def _unquote_plus(c: Column) -> Column:
    """``urllib.parse.unquote_plus``: '+' is a space, bad escapes stay literal, bad UTF-8 is U+FFFD."""
    safe = F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), c)


def _quote_plus(c: Column) -> Column:
    """``urllib.parse.quote_plus``: like ``url_encode`` except that '~' is safe and '*' is not."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_pairs(query) -> Column:
    """U4 input: ``parse_qsl(keep_blank_values=True)`` as array<struct<k, i, v>> (decoded, in order)."""
    segs = F.split(col_(query), "&", -1)
    pairs = F.transform(segs, lambda seg, i: F.struct(
        _unquote_plus(F.substring_index(seg, "=", 1)).alias("k"),
        i.alias("i"),
        _unquote_plus(F.when(seg.contains("="), F.regexp_extract(seg, r"(?s)^[^=]*=(.*)\z", 1))
                      .otherwise(F.lit(""))).alias("v"),
        (seg != "").alias("keep")))
    return F.filter(pairs, lambda p: p["keep"])


def drop_tracking(pairs) -> Column:
    """Drop the tracking parameters, names compared lower-cased."""
    return F.filter(col_(pairs), lambda p: ~in_list(F.lower(p["k"]), dims.TRACKING_PARAMS))


def sort_params(pairs) -> Column:
    """U4: order by decoded name, keeping the original order within a name (never by value)."""
    return F.sort_array(col_(pairs))


def encode_params(pairs) -> Column:
    """``urlencode(doseq=True)`` of the sorted pairs."""
    return F.array_join(F.transform(col_(pairs), lambda p: F.concat(_quote_plus(p["k"]), F.lit("="),
                                                                    _quote_plus(p["v"]))), "&")


def normalize_query(query) -> Column:
    return encode_params(sort_params(drop_tracking(query_pairs(query))))


def normalize_url(url) -> Column:
    """``scheme://netloc path[?query]`` -- trailing '/' trimmed, params sorted, tracking dropped,
    ``;params`` and fragment removed. '' and NULL pass through; a blank string becomes '://'."""
    u = col_(url)
    parts = url_split(u)
    q = normalize_query(parts["query"])
    out = F.concat(parts["scheme"], F.lit("://"), parts["netloc"], trim_path(parts["path"]),
                   F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return F.when(u.isNull() | (u == ""), u).otherwise(out)


# ---------------------------------------------------------------------------
# Staged forms. A Column is an expression tree, so reusing an intermediate (the
# stripped URL, the remainder after the scheme...) copies it. These DataFrame
# transformations project each intermediate once; Catalyst keeps the projections
# apart because collapsing them would repeat non-trivial expressions.
# ---------------------------------------------------------------------------

# Scheme, netloc, path, query and fragment by one match, and the marks between them; what is split has no line feed.
_SPLIT_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
_SPLIT_PARTS = "$1\n$2\n$3\n$4\n$5"


def with_url_parts(df: DataFrame, url: str, prefix: str = "_u_", prestrip: bool = True) -> DataFrame:
    """U1 staged: adds ``{prefix}scheme/netloc/path/query/fragment`` for column ``url``."""
    p = prefix
    s = py_strip(F.col(url)) if prestrip else F.col(url)
    s = F.regexp_replace(F.regexp_replace(s, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    df = df.withColumn(p + "s", F.split(F.regexp_replace(s, _SPLIT_RE, _SPLIT_PARTS), "\n", -1))
    part = lambda i: F.get(F.col(p + "s"), i)
    df = df.withColumns({p + "scheme": F.lower(part(0)), p + "netloc": F.coalesce(part(1), F.lit("")), p + "fragment": part(4), p + "query": part(3), p + "p0": part(2)})
    p0 = F.col(p + "p0")
    df = df.withColumn(p + "path", F.when(in_list(F.col(p + "scheme"), dims.USES_PARAMS) & p0.contains(";"),
                                          F.regexp_replace(p0, r";[^/]*\z", "")).otherwise(p0))
    return df.drop(p + "s", p + "p0")


def with_normalized_url(df: DataFrame, src: str = "url", out: str = "url") -> DataFrame:
    """U6 staged: ``out`` = normalised ``src`` (``out`` may equal ``src``)."""
    p = "_nu_"
    df = with_url_parts(df, src, p)
    q = F.col(p + "query")
    df = df.withColumn(p + "q", F.when(q == "", F.lit("")).otherwise(normalize_query(q)))
    nq = F.col(p + "q")
    u = F.col(src)
    norm = F.concat(F.col(p + "scheme"), F.lit("://"), F.col(p + "netloc"), trim_path(F.col(p + "path")),
                    F.when(nq != "", F.concat(F.lit("?"), nq)).otherwise(F.lit("")))
    df = materialize(df, {p + "out": F.when(u.isNull() | (u == ""), u).otherwise(norm)})
    df = df.drop(*[p + x for x in ("scheme", "netloc", "path", "query", "fragment", "q")])
    return df.withColumn(out, F.col(p + "out")).drop(p + "out")
