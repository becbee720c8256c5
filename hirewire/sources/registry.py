"""Company registry (S1-S6): JSON documents ``{"companies": [...]}`` -> ``companies`` DataFrame.

Entries stay VARIANT (``raw``), so optional and per-platform keys are read where they
are used, and Python truthiness / key-presence rules can be applied exactly.
``company_seq`` orders entries across documents (document rank, then position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.functions.sqlexpr import array_lit, in_list
from hirewire.functions.text import variant_truthy

def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per registry file; ``doc_id`` ranks the files by path. Only the paths meet in the ranking window; the
    texts join their ranks afterwards."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    ranks = raw.select("path").distinct().select("path", F.row_number().over(Window.orderBy("path")).cast("long").alias("doc_id"))
    return raw.join(ranks, "path").select("doc_id", "text")


def scan(docs: DataFrame) -> DataFrame:
    """Every entry of every document, in order; a document without ``companies`` yields none."""
    arr = F.try_variant_get(F.try_parse_json("text"), "$.companies", "array<variant>")
    e = docs.select("doc_id", F.posexplode(arr).alias("pos", "raw"))
    m = F.try_variant_get("raw", "$", "map<string,variant>")
    s = lambda k: F.try_variant_get("raw", f"$.{k}", "string")
    return e.select(
        # document rank in the upper half, position in the lower: a position is an int and can't run over
        (F.shiftleft(F.col("doc_id"), 32) + F.col("pos")).alias("company_seq"),
        s("company_name").alias("company_name"),
        s("ats_platform").alias("ats_platform"),
        s("board_slug").alias("board_slug"),
        F.coalesce(F.map_keys(m), F.array().cast("array<string>")).alias("keys"),
        "raw",
    )


def missing_keys(keys: Column) -> Column:
    """Required keys that are absent (a key holding null counts as present)."""
    return F.array_sort(F.array_except(array_lit(dims.REQUIRED_REGISTRY_KEYS), keys))


def enabled(raw: Column) -> Column:
    """``entry.get('enabled', True)`` by Python truthiness (the string "false" is truthy)."""
    v = F.try_variant_get(raw, "$.enabled", "variant")
    return F.coalesce(variant_truthy(v), F.lit(True))


def validate(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(companies, rejects). Rejects carry ``reason`` and the missing keys."""
    staged = entries.select("*", missing_keys(F.col("keys")).alias("missing"))
    reason = (F.when(F.size("missing") > 0, F.lit("missing_keys"))
              .when(~F.coalesce(in_list(F.col("ats_platform"), dims.PLATFORMS), F.lit(False)), F.lit("bad_platform"))
              .when(~enabled(F.col("raw")), F.lit("disabled")))
    staged = staged.withColumn("reason", reason)
    good = staged.where(F.col("reason").isNull()).drop("reason", "missing", "keys")
    bad = staged.where(F.col("reason").isNotNull()).select("company_seq", "company_name", "ats_platform",
                                                          "reason", "missing")
    return good, bad


def load_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S1-S4 from files: ``load_registry(spark, path) -> (companies, rejects)``."""
    return validate(scan(read_documents(spark, path)))


def scope(companies: DataFrame, platform: str | None = None, company: str | None = None) -> DataFrame:
    """Platform equality (case-sensitive) and company-name equality ignoring case."""
    out = companies
    if platform:
        out = out.where(F.col("ats_platform") == F.lit(platform))
    if company:
        out = out.where(F.lower("company_name") == F.lower(F.lit(company)))
    return out


def group_by_platform(companies: DataFrame) -> DataFrame:
    """Companies per platform, platforms ranked by first appearance (a 14-row aggregate)."""
    g = companies.groupBy("ats_platform").agg(F.count(F.lit(1)).alias("n_companies"),
                                               F.min("company_seq").alias("first_seq"))
    return g.select("ats_platform", "n_companies",
                    F.rank().over(Window.orderBy("first_seq")).cast("int").alias("platform_rank"))


def opt(raw: Column, key: str) -> Column:
    """``entry.get(key, '')`` as a string ('' when absent or null)."""
    return F.coalesce(F.try_variant_get(raw, f"$.{key}", "string"), F.lit(""))
