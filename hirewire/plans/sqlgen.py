"""SQL (DuckDB dialect) twins of the column functions, used by the correctness oracle.

Written from the same fixed dictionaries as the Spark expressions. RE2 has no
lookahead and ASCII ``\\b``/``\\s``; the fixtures avoid inputs where that matters.
"""

from __future__ import annotations

import re

from hirewire.functions import dims
from hirewire.sources.fixtures import sql_str

WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"


def sql_in(values) -> str:
    return "(" + ", ".join(sql_str(v) for v in values) + ")"


def contains_any(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, {sql_str(w)})" for w in words) + ")"


def py_strip(expr: str) -> str:
    return f"trim({expr}, {sql_str(WS_CHARS)})"


def is_entry_level(t: str) -> str:
    pat = r"(?i)\b(" + "|".join(dims.SENIOR_WORDS) + r")\b"
    return f"coalesce({t} IS NOT NULL AND {t} <> '' AND NOT regexp_matches({t}, {sql_str(pat)}), false)"


def experience_level(t: str) -> str:
    pat = r"(?i)\b(" + "|".join(dims.INTERN_WORDS) + r")\b"
    return f"CASE WHEN regexp_matches({t}, {sql_str(pat)}) THEN 'internship' ELSE 'new_grad' END"


def work_type(loc: str) -> str:
    low = f"lower({loc})"
    return (f"CASE WHEN regexp_matches({low}, '\\bremote\\b') THEN 'remote' "
            f"WHEN regexp_matches({low}, '\\bhybrid\\b') THEN 'hybrid' ELSE 'onsite' END")


def _words_re(words) -> str:
    return r"\b(" + "|".join(re.escape(w).replace("\\ ", " ") for w in words) + r")\b"


def country(loc: str) -> str:
    low = f"lower({loc})"
    region = f"regexp_extract({loc}, '[A-Za-z\\s]+,\\s*([A-Z]{{2}})\\b', 1)"
    codes = dims.US_STATE_ABBREVS + dims.CA_PROVINCE_ABBREVS
    first = f"list_filter(regexp_extract_all({loc}, '\\b([A-Z]{{2}})\\b', 1), lambda x: x IN {sql_in(codes)})[1]"
    onsite = r"\b(hybrid|in-?office|on-?site|onsite)\b"
    return f"""CASE
  WHEN contains({loc}, {sql_str(dims.US_FLAG)}) THEN 'US'
  WHEN contains({loc}, {sql_str(dims.CA_FLAG)}) THEN 'CA'
  WHEN {contains_any(low, dims.CA_INDICATORS)} THEN 'CA'
  WHEN {contains_any(low, dims.US_INDICATORS)} THEN 'US'
  WHEN {region} IN {sql_in(dims.CA_PROVINCE_ABBREVS)} THEN 'CA'
  WHEN {region} IN {sql_in(dims.US_STATE_ABBREVS)} THEN 'US'
  WHEN {contains_any(low, dims.CA_PROVINCE_NAMES)} THEN 'CA'
  WHEN {contains_any(low, dims.US_STATE_NAMES)} THEN 'US'
  WHEN {first} IN {sql_in(dims.US_STATE_ABBREVS)} THEN 'US'
  WHEN {first} IN {sql_in(dims.CA_PROVINCE_ABBREVS)} THEN 'CA'
  WHEN regexp_matches({low}, {sql_str(_words_re(dims.CA_CITIES))}) THEN 'CA'
  WHEN regexp_matches({low}, {sql_str(_words_re(dims.US_CITIES))}) THEN 'US'
  WHEN regexp_matches({low}, '\\bremote\\b') THEN 'US'
  WHEN regexp_matches({low}, {sql_str(onsite)}) THEN 'US'
END"""


def _category_cascade(padded: str, otherwise: str) -> str:
    whens = "\n".join(f"    WHEN {contains_any(padded, words)} THEN {sql_str(name)}"
                      for name, words in dims.CATEGORY_KEYWORDS)
    return f"CASE\n{whens}\n    ELSE {otherwise} END"


def role_category(t: str, d: str) -> str:
    t_pad = f"(' ' || lower(coalesce({t}, '')) || ' ')"
    dept = py_strip(f"coalesce({d}, '')")
    d_pad = f"(' ' || lower({dept}) || ' ')"
    by_dept = f"CASE WHEN {dept} <> '' THEN {_category_cascade(d_pad, repr(dims.DEFAULT_CATEGORY))} ELSE 'Other' END"
    return _category_cascade(t_pad, by_dept)


def staleness_keep(posted: str, run_ts: str) -> str:
    return f"({posted} IS NULL OR {posted} >= TIMESTAMP '{run_ts}' - INTERVAL {dims.STALENESS_DAYS} DAY)"


# ---------------------------------------------------------------------------
# URLs: staged as CTEs (each stage reads the previous one's columns)
# ---------------------------------------------------------------------------


def _unquote_plus(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _quote_plus(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def url_split_ctes(src: str, url: str, prefix: str = "u", prestrip: bool = True) -> tuple[list[str], str]:
    """CTEs adding _scheme, _netloc, _path, _query, _fragment to ``src`` (urlsplit + params cut)."""
    s0 = py_strip(url) if prestrip else url
    c1 = (f"{prefix}1 AS (SELECT *, regexp_replace(regexp_replace({s0}, '^[\\x00-\\x20]+', ''), "
          f"'[\\t\\r\\n]', '', 'g') AS _s FROM {src})")
    c2 = (f"{prefix}2 AS (SELECT *, lower(regexp_extract(_s, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) AS _scheme, "
          f"regexp_replace(_s, '^[A-Za-z][A-Za-z0-9+.\\-]*:', '') AS _r1 FROM {prefix}1)")
    c3 = (f"{prefix}3 AS (SELECT *, CASE WHEN starts_with(_r1, '//') THEN regexp_extract(_r1, '^//([^/?#]*)', 1) "
          f"ELSE '' END AS _netloc, CASE WHEN starts_with(_r1, '//') THEN regexp_replace(_r1, '^//[^/?#]*', '') "
          f"ELSE _r1 END AS _r2 FROM {prefix}2)")
    c4 = (f"{prefix}4 AS (SELECT *, regexp_extract(_r2, '(?s)^[^#]*#(.*)$', 1) AS _fragment, "
          f"regexp_extract(_r2, '(?s)^([^#]*)', 1) AS _r3 FROM {prefix}3)")
    c5 = (f"{prefix}5 AS (SELECT *, regexp_extract(_r3, '(?s)^[^?]*\\?(.*)$', 1) AS _query, "
          f"regexp_extract(_r3, '(?s)^([^?]*)', 1) AS _p0 FROM {prefix}4)")
    c6 = (f"{prefix}6 AS (SELECT *, CASE WHEN _scheme IN {sql_in(dims.USES_PARAMS)} AND contains(_p0, ';') "
          f"THEN regexp_replace(_p0, ';[^/]*$', '') ELSE _p0 END AS _path FROM {prefix}5)")
    return [c1, c2, c3, c4, c5, c6], f"{prefix}6"


def trim_path(p: str) -> str:
    return f"CASE WHEN {p} = '/' THEN '/' ELSE regexp_replace({p}, '/+$', '') END"


def query_pairs(q: str) -> str:
    pair = ("{'k': " + _unquote_plus("split_part(seg, '=', 1)") + ", 'i': i, 'v': CASE WHEN contains(seg, '=') THEN "
            + _unquote_plus("substr(seg, strpos(seg, '=') + 1)") + " ELSE '' END, 'keep': seg <> ''}")
    return f"list_filter(list_transform(string_split({q}, '&'), lambda seg, i: {pair}), lambda p: p.keep)"


def drop_tracking(pairs: str) -> str:
    return f"list_filter({pairs}, lambda p: lower(p.k) NOT IN {sql_in(dims.TRACKING_PARAMS)})"


def encode_params(sorted_pairs: str) -> str:
    enc = f"{_quote_plus('p.k')} || '=' || {_quote_plus('p.v')}"
    return f"array_to_string(list_transform({sorted_pairs}, lambda p: {enc}), '&')"


def normalize_query(q: str) -> str:
    return encode_params(f"list_sort({drop_tracking(query_pairs(q))})")


def normalize_url_ctes(src: str, url: str, out: str, prefix: str = "n") -> tuple[list[str], str]:
    ctes, last = url_split_ctes(src, url, prefix)
    c7 = f"{prefix}7 AS (SELECT *, {normalize_query('_query')} AS _nq FROM {last})"
    c8 = (f"{prefix}8 AS (SELECT *, CASE WHEN {url} IS NULL OR {url} = '' THEN {url} ELSE "
          f"_scheme || '://' || _netloc || {trim_path('_path')} || CASE WHEN _nq <> '' THEN '?' || _nq ELSE '' END "
          f"END AS {out} FROM {prefix}7)")
    return ctes + [c7, c8], f"{prefix}8"


# ---------------------------------------------------------------------------
# Domains and logos
# ---------------------------------------------------------------------------
def hostname(netloc: str) -> str:
    info = f"regexp_extract({netloc}, '([^@]*)$', 1)"
    return (f"lower(CASE WHEN contains({info}, '[') THEN regexp_extract({info}, '\\[([^\\]]*)', 1) "
            f"ELSE split_part({info}, ':', 1) END)")


def registrable(h: str) -> str:
    parts = f"string_split({h}, '.')"
    last2 = f"array_to_string({parts}[-2:], '.')"
    last3 = f"array_to_string({parts}[-3:], '.')"
    return (f"CASE WHEN len({parts}) <= 2 THEN {h} WHEN {last2} IN {sql_in(dims.MULTI_PART_TLDS)} "
            f"THEN {last3} ELSE {last2} END")


def domain_from_url_ctes(src: str, url: str, out: str, prefix: str = "d") -> tuple[list[str], str]:
    raw = py_strip(url)
    c0 = (f"{prefix}0 AS (SELECT *, {raw} AS _raw, CASE WHEN contains({raw}, '://') THEN {raw} "
          f"ELSE 'http://' || {raw} END AS _din FROM {src})")
    ctes, last = url_split_ctes(f"{prefix}0", "_din", prefix + "s", prestrip=False)
    host0 = hostname("_netloc")
    c7 = (f"{prefix}7 AS (SELECT *, CASE WHEN starts_with({host0}, 'www.') THEN substr({host0}, 5) ELSE {host0} END "
          f"AS _host FROM {last})")
    c8 = f"{prefix}8 AS (SELECT *, {registrable('_host')} AS _reg FROM {prefix}7)"
    ok = (f"{url} IS NOT NULL AND _raw <> '' AND _scheme IN ('http', 'https') "
          f"AND contains(_netloc, '[') = contains(_netloc, ']') AND _host <> '' AND contains(_host, '.') "
          f"AND _reg NOT IN {sql_in(dims.NON_COMPANY_HOSTS)} AND _host NOT IN {sql_in(dims.NON_COMPANY_HOSTS)}")
    drop = "_raw, _din, _s, _scheme, _r1, _netloc, _r2, _fragment, _r3, _query, _p0, _path, _host, _reg"
    c9 = f"{prefix}9 AS (SELECT * EXCLUDE ({drop}), CASE WHEN {ok} THEN _reg END AS {out} FROM {prefix}8)"
    return [c0] + ctes + [c7, c8, c9], f"{prefix}9"


def domain_from_logo_url(lg: str) -> str:
    param = f"regexp_extract({lg}, '[?&]domain=([^&]+)', 1)"

    def between(marker: str) -> str:
        seg = f"split_part(split_part({lg}, '{marker}', 2), '?', 1)"
        return f"CASE WHEN {seg} <> '' THEN {seg} END"
    fallback = (f"CASE WHEN contains({lg}, 'logo.clearbit.com/') THEN {between('logo.clearbit.com/')} "
                f"WHEN contains({lg}, 'icon.horse/icon/') THEN {between('icon.horse/icon/')} END")
    return (f"CASE WHEN {lg} IS NOT NULL AND {lg} <> '' THEN coalesce(CASE WHEN {param} <> '' THEN {param} END, "
            f"{fallback}) END")


def normalize_name(x: str) -> str:
    s = f"regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9\\s]', ' ', 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def domain_from_name(x: str) -> str:
    norm = normalize_name(x)
    known = "CASE " + " ".join(f"WHEN {norm} = {sql_str(k)} THEN {sql_str(v)}"
                               for k, v in dims.KNOWN_DOMAINS.items()) + " END"
    noise = r"\b(" + "|".join(dims.NAME_NOISE_WORDS) + r")\b"
    t1 = f"regexp_replace(regexp_replace({norm}, {sql_str(noise)}, ' ', 'g'), '[^a-z0-9]', '', 'g')"
    t0 = f"regexp_replace({norm}, '[^a-z0-9]', '', 'g')"
    tok = f"CASE WHEN length({t1}) >= 2 THEN {t1} ELSE {t0} END"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' OR {norm} = '' THEN NULL WHEN ({known}) IS NOT NULL THEN ({known}) "
            f"WHEN length({tok}) >= 2 THEN {tok} || '.com' END")


def favicon(d: str) -> str:
    pre, post = dims.FAVICON_TEMPLATE.split("{domain}")
    return f"CASE WHEN {d} IS NOT NULL AND {d} <> '' THEN {sql_str(pre)} || {d} || {sql_str(post)} ELSE '' END"


def real_logo(lg: str) -> str:
    return (f"({lg} IS NOT NULL AND {lg} <> '' AND starts_with({lg}, 'http') AND NOT "
            f"{contains_any(lg, dims.GENERATED_LOGO_MARKERS)})")


def search_logo(c: str) -> str:
    guess = f"(replace(lower({c}), ' ', '') || '.com')"
    return f"CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN {favicon(guess)} ELSE '' END"


# ---------------------------------------------------------------------------
# Text
# ---------------------------------------------------------------------------
PY_WS_RE2 = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NL = "chr(10)"


def strip_re(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_WS_RE2}+|{PY_WS_RE2}+$', '', 'g')"


def unescape4(x: str) -> str:
    """One-pass decode for the four entities the generated pages contain (&amp; last)."""
    out = x
    for ent, ch in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, {sql_str(ent)}, {sql_str(ch)})"
    return out


def strip_tags_nl(x: str) -> str:
    s = f"regexp_replace({x}, '<[^>]+>', {NL}, 'g')"
    s = f"regexp_replace({s}, '\\n{{3,}}', {NL} || {NL}, 'g')"
    return strip_re(s)


def truncate_ellipsis(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n}) || '...' ELSE {x} END"


def collapse_ws(x: str) -> str:
    return strip_re(f"regexp_replace({x}, '{PY_WS_RE2}+', ' ', 'g')")


def clean_cell(x: str) -> str:
    s = f"regexp_replace({unescape4(f'coalesce({x}, {chr(39)}{chr(39)})')}, '<[^>]+>', ' ', 'g')"
    s = strip_re(f"regexp_replace({s}, '{PY_WS_RE2}{{2,}}', ' ', 'g')")
    return strip_re(f"regexp_replace({s}, '^,+|,+$', '', 'g')")


def salary_by_patterns(x: str, patterns) -> str:
    hits = [f"CASE WHEN regexp_matches({x}, {sql_str('(?i)' + p)}) THEN regexp_extract({x}, {sql_str('(?i)' + p)}, 0) END"
            for p in patterns]
    return f"coalesce({', '.join(hits)}, '')"
