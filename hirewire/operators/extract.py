"""Payload -> ``raw_job`` extractors (P1-P16) and location composers.

Each extractor takes usable pages joined to their company (platform, company_seq,
search_id, page_no, run_ts, body, company_name, board_slug, raw) and returns the
``raw_job`` columns plus provenance (item_pos, item_key). JSON bodies are parsed once
into VARIANT; list items are exploded with their position; Python's ``a or b`` is
``coalesce(nullif(a, ''), b)``; a record that would fail to parse is dropped by an
explicit predicate. HTML lists are read with ``regexp_extract_all`` (all groups of a
pattern come from the same matches, so they stay aligned).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.functions import dates as D
from hirewire.functions import dims
from hirewire.functions import text as T
from hirewire.functions.domains import search_logo
from hirewire.functions.sqlexpr import bound
from hirewire.functions.staging import materialize
from hirewire.sources import landing as LD
from hirewire.sources.registry import opt

RAW_JOB_COLS = ["title", "company", "location", "url", "posted_date", "department", "salary_range",
                "company_logo", "company_domain", "company_url", "employment_type", "description"]
PROV = ["run_ts", "platform", "company_seq", "search_id", "page_no"]
COMPANY = ["company_name", "board_slug", "raw"]


# --- VARIANT helpers ---------------------------------------------------------

def vv(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def vs(v: Column, key: str) -> Column:
    """The value at ``key`` as text (NULL when absent, JSON null, or a container)."""
    return F.try_variant_get(v, f"$.{key}", "string")


def vget(v: Column, key: str, default: str = "") -> Column:
    """``d.get(key, default)`` for a text field: absent -> default, null -> NULL."""
    return F.coalesce(vs(v, key), F.when(vv(v, key).isNull(), F.lit(default)))


def vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_obj(v: Column) -> Column:
    return F.coalesce(vtype(v).startswith("OBJECT"), F.lit(False))


def is_arr(v: Column) -> Column:
    return F.coalesce(vtype(v).startswith("ARRAY"), F.lit(False))


def nz(c: Column) -> Column:
    """Python truthiness of a text value, as NULL-for-falsy."""
    return F.when(c != "", c)


def or_(*cols) -> Column:
    """Python ``a or b or c``: the first truthy text, else the last operand as it is."""
    return F.coalesce(*[nz(c) for c in cols[:-1]], cols[-1])


def truthy(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def py_str(v: Column) -> Column:
    """``str(x)`` of a JSON scalar (None -> 'None')."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("None"))


def _doc(df: DataFrame, **config: Column) -> DataFrame:
    """Pages with their parsed body and what their items take from the company's entry (``config`` as ``_name``), which is
    read once for each page here and not for each item."""
    entry = {"_logo": opt(F.col("raw"), "company_logo_url"), "_site": opt(F.col("raw"), "company_url")}
    return df.withColumns({"doc": F.try_parse_json("body"), **entry, **{f"_{k}": c for k, c in config.items()}})


def _explode(df: DataFrame, arr: Column) -> DataFrame:
    keep = [c for c in df.columns if c not in ("body", "doc")]
    return df.select(*keep, F.posexplode(arr).alias("item_pos", "it"))


def _fields(items: DataFrame, **fields: Column) -> DataFrame:
    """Items with what is read of them, as ``_name``: a projection of its own, so that a field that is used several times is
    looked up in the VARIANT once."""
    return items.withColumns({f"_{k}": c for k, c in fields.items()})


def _finish(df: DataFrame, keep: Column, **cols) -> DataFrame:
    base = {
        "company": F.col("company_name"),
        "company_logo": F.col("_logo") if "_logo" in df.columns else opt(F.col("raw"), "company_logo_url"),
        "company_domain": F.lit(""),
        "company_url": F.col("_site") if "_site" in df.columns else opt(F.col("raw"), "company_url"),
        "department": F.lit(None).cast("string"),
        "salary_range": F.lit(""),
        "employment_type": F.lit(None).cast("string"),
        "description": F.lit(""),
        "posted_date": F.lit(None).cast("timestamp_ntz"),
    }
    mode = cols.pop("description_mode", F.lit(DESC_NONE))
    base.update(cols)
    out = df.where(F.coalesce(keep, F.lit(False)))
    return out.select(*PROV, "item_pos", F.col("item_key").cast("string").alias("item_key"),
                      *[base[c].cast("timestamp_ntz").alias(c) if c == "posted_date" else base[c].cast("string").alias(c)
                        for c in RAW_JOB_COLS], mode.cast("int").alias("description_mode"))


# --- descriptions: cleaned late --------------------------------------------------
# Parsers keep the raw description text plus a recipe code; the cleanup (the one Arrow
# UDF, tag stripping) runs only on rows that will be stored. Texts are kept whole.
DESC_NONE, DESC_HTML, DESC_TEXT, DESC_SPACES = range(4)


def finish_descriptions(df: DataFrame) -> DataFrame:
    """Apply each row's description recipe (no-op when the frame carries finished text)."""
    if "description_mode" not in df.columns:
        return df
    m, src = F.col("description_mode"), F.col("description")
    df = df.withColumn("_dun", T.html_unescape(F.when(m.isin(DESC_HTML, DESC_TEXT), src)))
    out = (F.when(m == DESC_HTML, T.strip_tags_nl(F.col("_dun"))).when(m == DESC_TEXT, T.py_strip(F.col("_dun")))
           .when(m == DESC_SPACES, T.collapse_ws(src)).otherwise(F.lit("")))
    return df.withColumn("description", out).drop("_dun", "description_mode")


def _desc(src: Column, mode: int, when: Column | None = None) -> tuple[Column, Column]:
    ok = when if when is not None else nz(src).isNotNull()
    return (F.when(ok, src).otherwise(F.lit("")), F.when(ok, F.lit(mode)).otherwise(F.lit(DESC_NONE)))


# --- P1 greenhouse --------------------------------------------------------------

def greenhouse(pages: DataFrame) -> DataFrame:
    it = _explode(_doc(pages), F.try_variant_get("doc", "$.jobs", "array<variant>"))
    i = F.col("it")
    it = _fields(it, title=vget(i, "title"), loc=vv(i, "location"), id=py_str(vv(i, "id")), date=or_(vs(i, "updated_at"), vs(i, "first_published_at")),
                 deps=F.try_variant_get(i, "$.departments", "array<variant>"))
    deps, loc = F.col("_deps"), F.col("_loc")
    dep0 = F.get(deps, 0)
    meta = F.try_variant_get(i, "$.metadata", "array<variant>")
    st = materialize(it, {"_sal": T.salary_from_metadata(F.coalesce(meta, F.array().cast("array<variant>"))),
                          "_content": vget(i, "content")})
    keep = truthy(F.col("_title")) & ~F.col("_sal.broken") & \
        ((F.coalesce(F.size(deps), F.lit(0)) == 0) | is_obj(dep0))
    content = F.col("_content")
    salary = F.when(F.col("_sal.salary") != "", F.col("_sal.salary")).otherwise(
        F.when(nz(content).isNotNull(), T.salary_from_text_board(content)).otherwise(F.lit("")))
    return _finish(
        st.withColumn("item_key", F.col("_id")), keep,
        title=F.col("_title"),
        location=F.when(is_obj(loc), vget(loc, "name")).otherwise(F.lit("")),
        url=F.concat(F.lit("https://boards.greenhouse.io/"), F.col("board_slug"), F.lit("/jobs/"), F.col("_id")),
        posted_date=D.iso_naive("_date"),
        department=F.when(F.coalesce(F.size(deps), F.lit(0)) > 0, vget(dep0, "name")).otherwise(F.lit("")),
        salary_range=salary,
        company_url=F.lit(""),
        description=_desc(content, DESC_HTML)[0], description_mode=_desc(content, DESC_HTML)[1],
    )


# --- P2 lever ----------------------------------------------------------------------

def lever(pages: DataFrame) -> DataFrame:
    d = _doc(pages)
    it = _explode(d, F.try_variant_get("doc", "$", "array<variant>"))
    i = F.col("it")
    combined = F.concat(F.col("_plain"), F.lit(" "), F.coalesce(or_(vget(i, "additional"), vget(i, "additionalPlain")), F.lit("")))
    it = _fields(it, cat=vv(i, "categories"), created=vv(i, "createdAt"), title=vget(i, "text"), href=vget(i, "hostedUrl"),
                 plain=F.coalesce(nz(vget(i, "descriptionPlain")), F.lit("")))
    it = _fields(it, combined=combined, type=vtype(F.col("_created")), ms=F.col("_created").try_cast("double"))
    cat, plain, combined, ms = F.col("_cat"), F.col("_plain"), F.col("_combined"), F.col("_ms")
    cat_ok = F.coalesce(is_obj(cat), F.lit(False)) | cat.isNull()
    num = F.col("_type").isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | F.col("_type").startswith("DECIMAL")
    keep = truthy(F.col("_title")) & truthy(F.col("_href")) & cat_ok
    return _finish(
        it.withColumn("item_key", F.col("_href")), keep,
        title=F.col("_title"),
        location=F.when(is_obj(cat), vget(cat, "location")).otherwise(F.lit("")),
        url=F.col("_href"),
        posted_date=F.when(num & (ms != 0), D.epoch_millis_local(ms)),
        department=F.coalesce(or_(vget(cat, "team"), vget(cat, "department")),
                              F.when(is_obj(cat), vget(cat, "department"))),
        employment_type=vget(cat, "commitment"),
        salary_range=F.when(T.py_strip(combined) != "", T.salary_from_text_postings(combined)).otherwise(F.lit("")),
        company_url=F.lit(""),
        description=_desc(plain, DESC_TEXT)[0], description_mode=_desc(plain, DESC_TEXT)[1],
    )


# --- P3 ashby ----------------------------------------------------------------------

def ashby(pages: DataFrame) -> DataFrame:
    d = _doc(pages)
    it = _explode(d, F.try_variant_get("doc", "$.jobs", "array<variant>"))
    i = F.col("it")
    it = _fields(it, loc=vv(i, "location"), dep=vv(i, "department"), html=or_(vget(i, "descriptionHtml"), vget(i, "description")),
                 plain=vget(i, "descriptionPlain"), url=or_(vget(i, "applyUrl"), vget(i, "jobUrl")), title=vget(i, "title"),
                 date=or_(vs(i, "publishedAt"), vs(i, "createdAt")))
    loc, dep, html, plain, url = [F.col(c) for c in ("_loc", "_dep", "_html", "_plain", "_url")]
    desc = F.when(truthy(html), html).when(truthy(plain), plain).otherwise(F.lit(""))
    desc_mode = (F.when(truthy(html), F.lit(DESC_HTML))
                 .when(truthy(plain), F.lit(DESC_TEXT)).otherwise(F.lit(DESC_NONE)))
    keep = truthy(F.col("_title")) & truthy(url)
    return _finish(
        it.withColumn("item_key", url), keep,
        title=F.col("_title"),
        location=F.when(is_obj(loc), vget(loc, "name")).otherwise(vget(i, "location")),
        url=url,
        posted_date=D.iso_naive("_date"),
        department=F.when(is_obj(dep), vget(dep, "name")).otherwise(vget(i, "department")),
        employment_type=vget(i, "employmentType"),
        company_url=F.lit(""),
        description=desc, description_mode=desc_mode,
    )


# --- P4 workday + X1 ----------------------------------------------------------------

def workday_location(text: Column, external_path: Column) -> Column:
    """An empty or 'N Locations' text takes the city from ``/job/{city}/``."""
    city = F.trim(F.replace(F.regexp_extract(external_path, r"^/job/([^/]+)/", 1), F.lit("-"), F.lit(" ")))
    has_city = external_path.rlike(r"^/job/[^/]+/")
    generic = (F.coalesce(text, F.lit("")) == "") | F.lower(text).rlike(r"(?U)\d+\s+locations")
    return F.when(generic & has_city, F.when(F.coalesce(text, F.lit("")) != "",
                                             F.concat(city, F.lit(" ("), text, F.lit(")"))).otherwise(city)) \
            .otherwise(text)


def workday(pages: DataFrame) -> DataFrame:
    base = F.regexp_replace(F.trim(opt(F.col("raw"), "workday_url_template")), "/+$", "")
    part = lambda n: F.regexp_extract(base, r"^(https://[^/]+)/wday/cxs/[^/]+/([^/]+)", n)
    it = _explode(_doc(pages, root=part(1), board=part(2)), F.try_variant_get("doc", "$.jobPostings", "array<variant>"))
    i = F.col("it")
    it = _fields(it, title=vget(i, "title"), ext=vget(i, "externalPath"), text=vget(i, "locationsText"), posted=vget(i, "postedOn"))
    root, ext = F.col("_root"), F.col("_ext")
    keep = truthy(F.col("_title")) & truthy(ext) & (root != "")
    return _finish(
        it.withColumn("item_key", ext), keep,
        title=F.col("_title"),
        location=workday_location(F.col("_text"), ext),
        url=F.concat(root, F.lit("/"), F.col("_board"), ext),
        posted_date=D.relative_posted("_posted", F.col("run_ts")),
    )


# --- P5 oracle + X2 + S13 ----------------------------------------------------------

def oracle_location(primary: Column, secondary: Column) -> Column:
    """Primary + ' (+n more)' for n named secondaries; no primary -> the first secondary."""
    names = F.filter(F.transform(F.filter(secondary, lambda s: is_obj(s)), lambda s: vs(s, "Name")),
                     lambda n: n.isNotNull() & (n != ""))
    p = F.coalesce(nz(primary), F.lit(""))
    n = F.size(names)
    return F.when(n > 0, F.when(p != "", F.concat(p, F.lit(" (+"), n.cast("string"), F.lit(" more)")))
                  .otherwise(F.get(names, 0))).otherwise(p)


def oracle_na(primary_country: Column, secondary: Column) -> Column:
    """Primary country or any secondary country code (upper-cased) in US/CA."""
    codes = F.transform(F.filter(secondary, lambda s: is_obj(s)),
                        lambda s: F.upper(F.coalesce(vs(s, "CountryCode"), F.lit(""))))
    return F.upper(F.coalesce(primary_country, F.lit(""))).isin(dims.ORACLE_NA_COUNTRIES) | \
        F.coalesce(F.arrays_overlap(codes, F.array(*[F.lit(c) for c in dims.ORACLE_NA_COUNTRIES])), F.lit(False))


def _oracle_text() -> Column:
    item = F.get(F.try_variant_get(F.try_parse_json("body"), "$.items", "array<variant>"), 0)
    parts = ("ExternalDescriptionStr", "ExternalResponsibilitiesStr", "ExternalQualificationsStr")
    return T.join_nonempty([F.coalesce(nz(vs(item, k)), F.lit("")) for k in parts], "\n")


def _field_text(path: str) -> Column:
    return F.coalesce(nz(F.try_variant_get(F.try_parse_json("body"), path, "string")), F.lit(""))


def detail_texts(details: DataFrame) -> DataFrame:
    """(run_ts, platform, company_seq, item_key, detail) of usable detail pages; '' where a body has no text."""
    p = F.col("platform")
    text = (F.when(p == "oracle", _oracle_text()).when(p == "eightfold", _field_text("$.data.jobDescription"))
            .when(p == "bamboohr", _field_text("$.result.jobOpening.description")))
    return details.select("run_ts", "platform", "company_seq", "item_key", text.alias("detail"))


def describe_late(rows: DataFrame, details: DataFrame) -> DataFrame:
    """S11 for raw jobs that were parsed without details: their description becomes the detail's text, to be cleaned as
    HTML; rows without one stay as they are."""
    out = LD.attach_details(rows, detail_texts(details))
    found = F.col("detail") != ""
    return out.withColumns({"description": F.when(found, F.col("detail")).otherwise(F.col("description")),
                            "description_mode": F.when(found, F.lit(DESC_HTML)).otherwise(F.col("description_mode"))}).drop("detail").select(*rows.columns)


def oracle(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    raw = F.col("raw")
    d = _doc(pages, board=F.trim(or_(opt(raw, "oracle_site"), F.lit("CX_1"))), host=F.trim(opt(raw, "oracle_host")),
             careers=F.trim(opt(raw, "oracle_careers_host")))
    it = _explode(d, F.try_variant_get(F.get(F.try_variant_get("doc", "$.items", "array<variant>"), 0),
                                          "$.requisitionList", "array<variant>"))
    i = F.col("it")
    it = _fields(it, sec=F.coalesce(F.try_variant_get(i, "$.secondaryLocations", "array<variant>"), F.array().cast("array<variant>")),
                 jid=vv(i, "Id"), title=vget(i, "Title"), primary=vs(i, "PrimaryLocation"), date=nz(vs(i, "PostedDate")))
    sec, jid = F.col("_sec"), py_str(F.col("_jid"))
    na = it.where(oracle_na(vs(i, "PrimaryLocationCountry"), sec)).withColumn("item_key", jid)
    if details is not None:
        na = LD.attach_details(na, detail_texts(details))
    else:
        na = na.withColumn("detail", F.lit(""))
    site, host, careers = F.col("_board"), F.col("_host"), F.col("_careers")
    url = F.when(careers != "", F.concat(F.lit("https://"), careers, F.lit("/en/sites/"), site, F.lit("/job/"), jid)) \
           .otherwise(F.concat(F.lit("https://"), host, F.lit("/hcmUI/CandidateExperience/en/sites/"), site,
                               F.lit("/job/"), jid))
    keep = truthy(F.col("_title")) & F.coalesce(variant_truthy_id(F.col("_jid")), F.lit(False))
    return _finish(
        na, keep,
        title=F.col("_title"), url=url,
        location=oracle_location(F.col("_primary"), sec),
        posted_date=D.iso_or_prefix("_date"),
        department=or_(vget(i, "JobFamily"), vget(i, "JobFunction")),
        description=_desc(F.col("detail"), DESC_HTML)[0],
        description_mode=_desc(F.col("detail"), DESC_HTML)[1],
    )


def variant_truthy_id(v: Column) -> Column:
    return T.variant_truthy(v)


# --- P6 eightfold + X3 + S14 ---------------------------------------------------------

def eightfold_location(pos: Column) -> Column:
    """X3: '; '-join of the non-empty ``locations``, else ``location``."""
    locs = F.try_variant_get(pos, "$.locations", "array<variant>")
    joined = F.array_join(F.filter(F.transform(locs, lambda x: F.try_variant_get(x, "$", "string")),
                                   lambda x: x.isNotNull() & (x != "")), "; ")
    return F.when(F.coalesce(F.size(locs), F.lit(0)) > 0, joined) \
            .otherwise(F.coalesce(nz(vs(pos, "location")), F.lit("")))


def eightfold(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    d = _doc(pages, host=F.regexp_replace(F.trim(opt(F.col("raw"), "eightfold_host")), "/+$", ""))
    it = _explode(d, F.try_variant_get("doc", "$.data.positions", "array<variant>"))
    i = F.col("it")
    loc = eightfold_location(i)
    na = it.withColumn("_loc", loc).where(T.contains_any(F.lower("_loc"), dims.EIGHTFOLD_NA_MARKERS)) \
           .withColumn("item_key", py_str(vv(i, "id")))
    if details is not None:
        na = LD.attach_details(na, detail_texts(details))
    else:
        na = na.withColumn("detail", F.lit(""))
    na = _fields(na, title=or_(vget(i, "name"), vget(i, "title"), F.lit("")), dep=vv(i, "department"), id=vv(i, "id"))
    host = F.col("_host")
    pid = py_str(F.col("_id"))
    default = F.concat(F.lit("https://"), host, F.lit("/careers/job/"), pid)
    na = _fields(na, u=or_(vget(i, "publicUrl"), vget(i, "positionUrl"), default))
    u = F.col("_u")
    url = F.when(u.startswith("/"), F.concat(F.lit("https://"), host, u)).when(~u.startswith("http"), default) \
           .otherwise(u)
    dep = F.col("_dep")
    dep_s = F.when(is_arr(dep) & (F.coalesce(F.size(F.try_variant_get(dep, "$", "array<variant>")), F.lit(0)) > 0),
                   F.try_variant_get(dep, "$[0]", "string")) \
             .when(is_arr(dep), F.lit("")).otherwise(or_(vs(i, "department"), F.lit("")))
    ts = F.coalesce(F.when(F.coalesce(T.variant_truthy(vv(i, "postedTs")), F.lit(False)), vv(i, "postedTs")),
                    F.when(F.coalesce(T.variant_truthy(vv(i, "creationTs")), F.lit(False)), vv(i, "creationTs")))
    keep = truthy(F.col("_title")) & F.coalesce(T.variant_truthy(F.col("_id")), F.lit(False))
    na = _fields(na, ts=ts.try_cast("string"))
    return _finish(
        na, keep,
        title=F.col("_title"), url=url, location=F.col("_loc"),
        posted_date=D.epoch_auto("_ts"),
        department=dep_s, description=_desc(F.col("detail"), DESC_HTML)[0],
        description_mode=_desc(F.col("detail"), DESC_HTML)[1],
    )


# --- P7 taleo + X4 ---------------------------------------------------------------------

def taleo_location(column: Column, loc_cols: Column) -> Column:
    """The cell named by ``locationsColumns[0]`` (else column 1, else 0); a JSON list is
    '; '-joined, a JSON scalar is its text, anything else loses ``[]"``."""
    n = F.size(column)
    idx0 = F.try_variant_get(F.get(loc_cols, 0), "$", "int")
    idx = F.when(idx0.isNull() | (idx0 >= n), F.when(n > 1, F.lit(1)).otherwise(F.lit(0))).otherwise(idx0)
    cell = F.coalesce(F.try_variant_get(F.get(column, idx), "$", "string"), F.lit(""))
    as_list = lambda v: F.array_join(F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"),
                                                          lambda x: F.when(T.variant_truthy(x), F.try_variant_get(x, "$", "string"))),
                                              lambda x: x.isNotNull()), "; ")
    of = lambda text, v: (F.when(v.isNull(), T.py_strip(F.regexp_replace(text, r'[\[\]"]', "")))
                          .when(is_arr(v), as_list(v))
                          .otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("None"))))
    return bound(cell, lambda text: bound(F.try_parse_json(text), lambda v: of(text, v)))


def taleo(pages: DataFrame) -> DataFrame:
    raw = F.col("raw")
    d = _doc(pages, host=F.regexp_replace(F.trim(opt(raw, "taleo_host")), "/+$", ""),
             section=F.coalesce(nz(F.trim(opt(raw, "taleo_section"))), F.lit("2")))
    it = _explode(d, F.try_variant_get("doc", "$.requisitionList", "array<variant>"))
    i = F.col("it")
    it = _fields(it, column=F.try_variant_get(i, "$.column", "array<variant>"), id=vv(i, "jobId"),
                 places=F.try_variant_get(i, "$.locationsColumns", "array<variant>"))
    column = F.col("_column")
    it = _fields(it, title=T.py_strip(py_str(F.get(column, 0))), jid=py_str(F.col("_id")),
                 last=F.try_variant_get(F.element_at(column, -1), "$", "string"))
    title, jid = F.col("_title"), F.col("_jid")
    keep = F.coalesce(T.variant_truthy(F.col("_id")), F.lit(False)) & (F.coalesce(F.size(column), F.lit(0)) > 0) \
        & (title != "")
    return _finish(
        it.withColumn("item_key", jid), keep,
        title=title,
        location=taleo_location(column, F.col("_places")),
        url=F.concat(F.lit("https://"), F.col("_host"), F.lit("/careersection/"), F.col("_section"), F.lit("/jobdetail.ftl?job="), jid,
                     F.lit("&lang=en")),
        posted_date=D.multi_format("_last"),
    )


# --- P8/P9 successfactors + X5/X6 + S12 ---------------------------------------------

def sf_clean_location(v: Column) -> Column:
    """A list is tag-stripped per item and '; '-joined; a scalar is tag-stripped."""
    strip = lambda x: T.py_strip(F.regexp_replace(x, r"<[^>]+>", ""))
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"),
                        lambda x: F.when(T.variant_truthy(x), strip(F.try_variant_get(x, "$", "string"))))
    return F.when(is_arr(v), F.array_join(F.filter(items, lambda x: x.isNotNull() & (x != "")), "; ")) \
            .otherwise(strip(F.coalesce(F.when(T.variant_truthy(v), F.try_variant_get(v, "$", "string")), F.lit(""))))


def successfactors_csb(pages: DataFrame) -> DataFrame:
    d = _doc(pages, host=F.regexp_replace(F.trim(opt(F.col("raw"), "sf_host")), "/+$", ""))
    it = _explode(d, F.try_variant_get("doc", "$.jobSearchResult", "array<variant>"))
    it = _fields(it, response=vv(F.col("it"), "response"))
    it = materialize(it, {"r": F.coalesce(F.when(T.variant_truthy(F.col("_response")), F.col("_response")), F.parse_json(F.lit("{}")))})
    r = F.col("r")
    it = _fields(it, title=or_(vget(r, "unifiedStandardTitle"), vget(r, "jobTitle"), vget(r, "title"), F.lit("")), id=vv(r, "id"),
                 loc=vv(r, "jobLocationShort"))
    jid = py_str(F.col("_id"))
    keep = F.coalesce(T.variant_truthy(F.col("_id")), F.lit(False)) & truthy(F.col("_title"))
    return _finish(
        it.withColumn("item_key", jid), keep,
        title=T.py_strip("_title"), location=sf_clean_location(F.col("_loc")),
        url=F.concat(F.lit("https://"), F.col("_host"), F.lit("/job/"), jid),
    )


# The page patterns of this board and, below, of jobvite and the search site.
_RMK_ROW = r'(?s)<tr[^>]*class="data-row"[^>]*>(.*?)</tr>'


def rmk_location(slug: Column, title: Column) -> Column:
    """Percent-decoded slug, '-' to space, the title removed, then 2+ spaces collapsed."""
    safe = F.regexp_replace(slug, r"%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.coalesce(F.try_url_decode(F.replace(safe, F.lit("+"), F.lit("%2B"))), slug)
    spaced = F.replace(decoded, F.lit("-"), F.lit(" "))
    removed = T.py_strip(F.replace(spaced, title, F.lit(" ")))
    return F.regexp_replace(removed, r"(?U)\s{2,}", " ")


def rmk_row_count(body: Column) -> Column:
    return F.size(F.regexp_extract_all(body, F.lit(_RMK_ROW), 1))


def successfactors_rmk(pages: DataFrame) -> DataFrame:
    it = pages.select(*[c for c in pages.columns if c != "body"],
                      F.posexplode(F.regexp_extract_all("body", F.lit(_RMK_ROW), 1)).alias("item_pos", "row"))
    row = F.col("row")
    href_re = r'href="(/job/([^"]+?)/(\d+)/?)"'
    href, slug = F.regexp_extract(row, href_re, 1), F.regexp_extract(row, href_re, 2)
    title = T.py_strip(F.regexp_extract(row, r"jobTitle-link[^>]*>([^<]+)<", 1))
    host = F.regexp_replace(F.trim(opt(F.col("raw"), "sf_host")), "/+$", "")
    keep = row.rlike(href_re) & row.rlike(r"jobTitle-link[^>]*>([^<]+)<") & (title != "")
    return _finish(
        it.withColumn("item_key", href), keep,
        title=title, location=rmk_location(slug, title), url=F.concat(F.lit("https://"), host, href),
    )


def successfactors(pages: DataFrame) -> DataFrame:
    """By ``sf_mode``, 'csb' takes the CSB rows, 'auto' (or none) those too but the RMK rows where a company has none in
    that run, and any other mode the RMK rows.

    Only where a company under 'auto' landed RMK pages do its CSB rows decide something: whether it has any. Only those
    companies' CSB pages are parsed for that, besides the one parse of every page that counts."""
    mode = F.lower(T.py_strip(or_(opt(F.col("raw"), "sf_mode"), F.lit("auto"))))
    moded = pages.withColumn("_mode", mode)
    lists = moded.where((F.col("kind") == "list") & F.col("_mode").isin("auto", "csb")).drop("_mode")
    html = moded.where((F.col("kind") == "html_list") & (F.col("_mode") != "csb"))
    auto, only = html.where("_mode = 'auto'").drop("_mode"), html.where("_mode <> 'auto'").drop("_mode")
    unsure = auto.select(*LD.COMPANY_RUN).distinct()
    decisive = successfactors_csb(lists.join(unsure, list(LD.COMPANY_RUN), "left_semi"))
    rmk = successfactors_rmk(only.unionByName(LD.lacking(auto, decisive)))
    return successfactors_csb(lists).unionByName(rmk)


# --- P10 phenom --------------------------------------------------------------------

def phenom(pages: DataFrame) -> DataFrame:
    d = _doc(pages, host=F.regexp_replace(F.trim(opt(F.col("raw"), "phenom_host")), "/+$", ""))
    it = _explode(d, F.try_variant_get("doc", "$.refineSearch.data.jobs", "array<variant>"))
    i = F.col("it")
    it = _fields(it, n=vv(i, "jobSeqNo"), id=vv(i, "jobId"), title=vget(i, "title"), teaser=nz(vget(i, "descriptionTeaser")),
                 date=nz(F.try_variant_get(vv(i, "postedDate"), "$", "string")))
    it = _fields(it, seq=F.coalesce(F.when(T.variant_truthy(F.col("_n")), F.col("_n")), F.when(T.variant_truthy(F.col("_id")), F.col("_id"))))
    seq, teaser = F.col("_seq"), F.col("_teaser")
    keep = truthy(F.col("_title")) & seq.isNotNull()
    return _finish(
        it.withColumn("item_key", py_str(seq)), keep,
        title=T.py_strip("_title"),
        location=or_(vs(i, "location"), vs(i, "cityState"), vs(i, "cityStateCountry"), F.lit("")),
        url=or_(vs(i, "applyUrl"), F.concat(F.lit("https://"), F.col("_host"), F.lit("/job/"), py_str(seq))),
        posted_date=D.iso_or_prefix("_date"),
        department=vget(i, "category"),
        description=_desc(teaser, DESC_SPACES)[0], description_mode=_desc(teaser, DESC_SPACES)[1],
    )


# --- P11 bamboohr + X7 -------------------------------------------------------------

def bamboohr_location(jp: Column) -> Column:
    """X7: 'city, state, country' (non-empty parts), else 'Remote' when isRemote, else locationName."""
    loc = vv(jp, "location")
    joined = T.join_nonempty([vs(loc, "city"), vs(loc, "state"), vs(loc, "country")], ", ")
    return (F.when(is_obj(loc) & (joined != ""), joined)
            .when(F.coalesce(T.variant_truthy(vv(jp, "isRemote")), F.lit(False)), F.lit("Remote"))
            .otherwise(F.coalesce(nz(vs(jp, "locationName")), F.lit(""))))


def bamboohr(pages: DataFrame, details: DataFrame | None = None) -> DataFrame:
    d = _doc(pages, sub=T.py_strip(or_(opt(F.col("raw"), "bamboohr_subdomain"), F.col("board_slug"), F.lit(""))))
    it = _explode(d, F.try_variant_get("doc", "$.result", "array<variant>"))
    i = F.col("it")
    it = _fields(it, id=vv(i, "id"), title=or_(vget(i, "jobOpeningName"), vget(i, "title"), F.lit("")))
    it = it.withColumn("item_key", py_str(F.col("_id")))
    if details is not None:
        it = LD.attach_details(it, detail_texts(details))
    else:
        it = it.withColumn("detail", F.lit(""))
    sub, title = F.col("_sub"), F.col("_title")
    keep = F.coalesce(T.variant_truthy(F.col("_id")), F.lit(False)) & truthy(title)
    return _finish(
        it, keep,
        title=T.py_strip(title), location=bamboohr_location(i),
        url=F.concat(F.lit("https://"), sub, F.lit(".bamboohr.com/careers/"), py_str(F.col("_id"))),
        department=vget(i, "departmentLabel"), description=_desc(F.col("detail"), DESC_HTML)[0],
        description_mode=_desc(F.col("detail"), DESC_HTML)[1],
    )


# --- P12 breezy + X8 ---------------------------------------------------------------

def breezy_location(loc: Column) -> Column:
    """``location.name``, else 'city, country' (each a string or ``{name}``); non-object -> text."""
    part = lambda k: F.when(is_obj(vv(loc, k)), vs(vv(loc, k), "name")).otherwise(vs(loc, k))
    joined = T.join_nonempty([part("city"), part("country")], ", ")
    return F.when(loc.isNull(), F.lit("")).when(is_obj(loc), F.coalesce(nz(vs(loc, "name")), joined)) \
            .otherwise(F.coalesce(F.when(T.variant_truthy(loc), F.try_variant_get(loc, "$", "string")), F.lit("")))


def breezy(pages: DataFrame) -> DataFrame:
    d = _doc(pages, sub=T.py_strip(or_(opt(F.col("raw"), "breezy_subdomain"), F.col("board_slug"), F.lit(""))))
    it = _explode(d, F.try_variant_get("doc", "$", "array<variant>"))
    i = F.col("it")
    it = _fields(it, title=vget(i, "name"), html=nz(vget(i, "description")), loc=vv(i, "location"),
                 date=nz(or_(F.try_variant_get(vv(i, "published_date"), "$", "string"), F.try_variant_get(vv(i, "creation_date"), "$", "string"))))
    html = F.col("_html")
    url = or_(vs(i, "url"), F.concat(F.lit("https://"), F.col("_sub"), F.lit(".breezy.hr/p/"), py_str(vv(i, "_id"))))
    return _finish(
        it.withColumn("item_key", url), truthy(F.col("_title")),
        title=T.py_strip("_title"), location=breezy_location(F.col("_loc")), url=url,
        posted_date=D.iso_naive("_date"),
        department=or_(vs(i, "department"), F.lit("")),
        description=_desc(html, DESC_HTML)[0], description_mode=_desc(html, DESC_HTML)[1],
    )


# --- P13 recruitee ------------------------------------------------------------------

def recruitee(pages: DataFrame) -> DataFrame:
    d = _doc(pages, sub=T.py_strip(or_(opt(F.col("raw"), "recruitee_subdomain"), F.col("board_slug"), F.lit(""))))
    it = _explode(d, F.try_variant_get("doc", "$.offers", "array<variant>"))
    i, sub = F.col("it"), F.col("_sub")
    loc = or_(vs(i, "location"), T.join_nonempty([vs(i, "city"), vs(i, "state_name"), vs(i, "country")], ", "))
    raw_desc = F.concat(F.coalesce(nz(vs(i, "description")), F.lit("")), F.lit("\n"),
                        F.coalesce(nz(vs(i, "requirements")), F.lit("")))
    it = _fields(it, title=vget(i, "title"), desc=raw_desc, date=nz(F.try_variant_get(vv(i, "published_at"), "$", "string")))
    raw_desc = F.col("_desc")
    url = or_(vs(i, "careers_url"), vs(i, "careers_apply_url"),
              F.concat(F.lit("https://"), sub, F.lit(".recruitee.com/o/"), vget(i, "slug")))
    return _finish(
        it.withColumn("item_key", url), truthy(F.col("_title")),
        title=T.py_strip("_title"), location=loc, url=url,
        posted_date=D.iso_or_prefix("_date"),
        department=vget(i, "department"),
        description=_desc(raw_desc, DESC_HTML, T.py_strip(raw_desc) != "")[0],
        description_mode=_desc(raw_desc, DESC_HTML, T.py_strip(raw_desc) != "")[1],
    )


# --- P14 jobvite ----------------------------------------------------------------------

_JV_ROW = (r'(?s)<td[^>]*class="jv-job-list-name"[^>]*>\s*<a[^>]*href="([^"]+)"[^>]*>(.*?)</a>.*?'
           r'<td[^>]*class="jv-job-list-location"[^>]*>(.*?)</td>')


def jobvite(pages: DataFrame) -> DataFrame:
    keep_cols = [c for c in pages.columns if c != "body"]
    z = pages.select(*keep_cols, F.arrays_zip(F.regexp_extract_all("body", F.lit(_JV_ROW), 1).alias("h"),
                                              F.regexp_extract_all("body", F.lit(_JV_ROW), 2).alias("t"),
                                              F.regexp_extract_all("body", F.lit(_JV_ROW), 3).alias("l")).alias("z"))
    it = z.select(*keep_cols, F.posexplode("z").alias("item_pos", "r"))
    href = F.col("r.h")
    title = T.clean_cell(F.col("r.t"))
    url = F.when(href.startswith("http"), href).otherwise(F.concat(F.lit("https://jobs.jobvite.com"), href))
    return _finish(it.withColumn("item_key", href), title != "", title=title,
                   location=T.clean_cell(F.col("r.l")), url=url)


# --- P15 talentplatform ---------------------------------------------------------------

def talentplatform(pages: DataFrame) -> DataFrame:
    d = _doc(pages, host=F.regexp_replace(F.trim(opt(F.col("raw"), "tp_host")), "/+$", ""))
    it = _explode(d, F.try_variant_get("doc", "$.jobs", "array<variant>"))
    it = _fields(it, data=vv(F.col("it"), "data"))
    it = materialize(it, {"dd": F.coalesce(F.when(T.variant_truthy(F.col("_data")), F.col("_data")), F.parse_json(F.lit("{}")))})
    dd, slug, host = F.col("dd"), F.col("_slug"), F.col("_host")
    loc = or_(vs(dd, "full_location"), vs(dd, "short_location"), vs(dd, "location_name"),
              T.join_nonempty([vs(dd, "city"), vs(dd, "state"), vs(dd, "country")], ", "))
    extras = [F.when(nz(vs(dd, k)).isNotNull(), F.concat(F.lit("\n"), vs(dd, k))).otherwise(F.lit(""))
              for k in ("responsibilities", "qualifications")]
    raw_desc = F.concat(F.coalesce(nz(vs(dd, "description")), F.lit("")), *extras)
    it = _fields(it, s=vv(dd, "slug"), id=vv(dd, "req_id"), title=vget(dd, "title"), desc=raw_desc,
                 date=nz(F.try_variant_get(vv(dd, "posted_date"), "$", "string")))
    it = _fields(it, slug=F.coalesce(F.when(T.variant_truthy(F.col("_s")), F.col("_s")), F.when(T.variant_truthy(F.col("_id")), F.col("_id"))))
    raw_desc = F.col("_desc")
    url = or_(vs(dd, "apply_url"), F.concat(F.lit("https://"), host, F.lit("/jobs/"), py_str(slug)))
    return _finish(
        it.withColumn("item_key", py_str(slug)), truthy(F.col("_title")) & slug.isNotNull(),
        title=T.py_strip("_title"), location=loc, url=url,
        posted_date=D.iso_or_prefix("_date"),
        department=vget(dd, "department"),
        description=_desc(raw_desc, DESC_HTML, T.py_strip(raw_desc) != "")[0],
        description_mode=_desc(raw_desc, DESC_HTML, T.py_strip(raw_desc) != "")[1],
    )


# --- P16 search site ----------------------------------------------------------------

_LI = {
    "ids": r'data-entity-urn="urn:li:jobPosting:(\d+)"',
    "titles": r'base-search-card__title[^"]*"[^>]*>\s*([^<]+)',
    "companies": r'base-search-card__subtitle[^>]*>(?:\s*<a[^>]*>)?\s*([^<\n]+?)\s*(?:</a>|</h4>|<)',
    "locations": r'job-search-card__location[^"]*"[^>]*>\s*([^<]+)',
    "dates": r'<time[^>]*datetime="([^"]+)"',
}


def search_card_count(body: Column) -> Column:
    return F.size(F.regexp_extract_all(body, F.lit(_LI["ids"]), 1))


def search_results(pages: DataFrame, search_location: Column) -> DataFrame:
    """Five independent lists zipped by index up to min(#ids, #titles); misalignment kept."""
    keep_cols = [c for c in pages.columns if c != "body"]
    lists = {k: F.regexp_extract_all("body", F.lit(p), 1).alias(k) for k, p in _LI.items()}
    z = pages.select(*keep_cols, search_location.alias("_search_loc"), *lists.values())
    n = F.least(F.size("ids"), F.size("titles"))
    # Cards are cut from the zipped lists before they are exploded, so that a card carries its own texts only
    it = z.select(*keep_cols, "_search_loc", F.posexplode(F.slice(F.arrays_zip(*_LI), F.lit(1), n)).alias("item_pos", "card"))
    g = lambda k: F.col(f"card.{k}")
    title = T.py_strip(g("titles"))
    company = T.py_strip(T.py_strip(F.coalesce(T.entity_decode_3(T.py_strip(g("companies"))), F.lit(""))))
    loc = F.when(g("locations").isNotNull(), T.py_strip(g("locations"))).otherwise(F.col("_search_loc"))
    jid = F.coalesce(g("ids"), F.lit(""))
    st = _fields(it.withColumn("company_name", company), date=T.py_strip(F.coalesce(g("dates"), F.lit(""))))
    return _finish(
        st.withColumn("item_key", jid), (title != "") & (jid != ""),
        title=title, location=loc,
        url=F.concat(F.lit("https://www.linkedin.com/jobs/view/"), jid),
        posted_date=F.when(F.col("_date") != "", D.iso_naive("_date")),
        company_logo=search_logo(F.col("company_name")), company_url=F.lit(""),
    )


EXTRACTORS = {
    "greenhouse": greenhouse, "lever": lever, "ashby": ashby, "workday": workday, "oracle": oracle,
    "eightfold": eightfold, "taleo": taleo, "successfactors": successfactors, "phenom": phenom,
    "bamboohr": bamboohr, "breezy": breezy, "recruitee": recruitee, "jobvite": jobvite,
    "talentplatform": talentplatform,
}
WITH_DETAILS = {"oracle", "eightfold", "bamboohr"}
