"""Registered queries for the date operators (D1-D8). Text is formatted from ``events.ts`` /
``orders.o_orderdate`` and parsed back; the oracle states the expected timestamp directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirewire.functions import dates as D
from hirewire.functions.sqlexpr import pick
from hirewire.functions.text import variant_truthy
from hirewire.plans.common import table
from hirewire.sources import fixtures as X

ISO_SUFFIXES = ["Z", "-05:00", "+02:30", "", ".123456Z", " junk", ".5+0100"]
# FIXED VALUES: English month names as strptime's %b / %B read them.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


_ISO_FMT_SPARK = "yyyy-MM-dd'T'HH:mm:ss"
_ISO_FMT_DUCK = "'%Y-%m-%dT%H:%M:%S'"


def d1_iso_naive(spark, sf_dir):
    e = _events(spark, sf_dir)
    txt = F.concat(F.date_format("ts", _ISO_FMT_SPARK), pick(ISO_SUFFIXES, F.col("event_id")))
    return e.select("event_id", D.iso_naive(txt).alias("posted_date"))


D1_SQL = f"""SELECT event_id, CASE event_id % 7
    WHEN 5 THEN NULL
    WHEN 4 THEN date_trunc('second', ts) + INTERVAL 123456 MICROSECOND
    WHEN 6 THEN date_trunc('second', ts) + INTERVAL 500 MILLISECOND
    ELSE date_trunc('second', ts) END AS posted_date
FROM events"""


def d2_epoch_millis_local(spark, sf_dir):
    e = _events(spark, sf_dir)
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    return e.select("event_id", D.epoch_millis_local(ms).alias("posted_date"))


D2_SQL = "SELECT event_id, date_trunc('millisecond', ts) AS posted_date FROM events"


def d3_relative_posted(spark, sf_dir):
    e = _events(spark, sf_dir)
    k, i = F.col("event_id") % 6, F.col("event_id")
    txt = (F.when(k == 0, F.lit("Posted Today")).when(k == 1, F.lit("Posted Yesterday"))
           .when(k == 2, F.concat(F.lit("Posted "), (i % 45).cast("string"), F.lit(" Days Ago")))
           .when(k == 3, F.lit("Posted 30+ Days Ago"))
           .when(k == 4, F.concat(F.lit("Posted "), (i % 4 + 1).cast("string"), F.lit(" Months Ago")))
           .otherwise(F.lit("")))
    return e.select("event_id", D.relative_posted(txt, X.run_ts()).alias("posted_date"))


D3_SQL = f"""SELECT event_id, CASE event_id % 6
    WHEN 0 THEN TIMESTAMP '{X.RUN_TS}'
    WHEN 1 THEN TIMESTAMP '{X.RUN_TS}' - INTERVAL 1 DAY
    WHEN 2 THEN TIMESTAMP '{X.RUN_TS}' - to_days(CAST(event_id % 45 AS INTEGER))
    WHEN 3 THEN TIMESTAMP '{X.RUN_TS}' - INTERVAL 30 DAY
    WHEN 4 THEN TIMESTAMP '{X.RUN_TS}' - to_days(CAST(30 * (event_id % 4 + 1) AS INTEGER))
  END AS posted_date
FROM events"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("d"))


def d4_iso_or_prefix(spark, sf_dir):
    o = _orders(spark, sf_dir)
    k = F.col("o_orderkey") % 4
    txt = (F.when(k == 0, F.date_format("d", "yyyy-MM-dd"))
           .when(k == 1, F.concat(F.date_format("d", _ISO_FMT_SPARK), F.lit("Z")))
           .when(k == 2, F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(" (updated)")))
           .otherwise(F.lit("TBD")))
    return o.select("o_orderkey", D.iso_or_prefix(txt).alias("posted_date"))


D4_SQL = ("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE date_trunc('second', o_orderdate) END "
          "AS posted_date FROM orders")


def d5_epoch_auto(spark, sf_dir):
    e = _events(spark, sf_dir)
    k = F.col("event_id") % 5
    secs = F.unix_seconds(F.col("ts").cast("timestamp"))
    millis = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    posted = (F.when(k == 0, F.to_json(F.struct(secs.alias("x"))))
              .when(k == 1, F.to_json(F.struct(millis.alias("x"))))
              .when(k == 2, F.to_json(F.struct(secs.cast("string").alias("x"))))
              .when(k == 3, F.lit('{"x":0}'))
              .otherwise(F.lit('{"x":""}')))
    body = F.concat(F.lit('{"postedTs":'), F.get_json_object(posted, "$.x").alias("p"), F.lit(',"creationTs":'),
                    (secs + 60).cast("string"), F.lit("}"))
    body = F.when(k == 2, F.concat(F.lit('{"postedTs":"'), secs.cast("string"), F.lit('","creationTs":'),
                                   (secs + 60).cast("string"), F.lit("}"))) \
            .when(k == 4, F.concat(F.lit('{"postedTs":"","creationTs":'), (secs + 60).cast("string"), F.lit("}"))) \
            .otherwise(body)
    v = e.select("event_id", F.try_parse_json(body).alias("pos"))
    p = F.try_variant_get("pos", "$.postedTs", "variant")
    c = F.try_variant_get("pos", "$.creationTs", "variant")
    chosen = F.when(F.coalesce(variant_truthy(p), F.lit(False)), p) \
              .when(F.coalesce(variant_truthy(c), F.lit(False)), c)
    return v.select("event_id", D.epoch_auto(chosen.try_cast("string")).alias("posted_date"))


D5_SQL = """SELECT event_id, CASE event_id % 5
    WHEN 1 THEN date_trunc('millisecond', ts)
    WHEN 3 THEN date_trunc('second', ts) + INTERVAL 60 SECOND
    WHEN 4 THEN date_trunc('second', ts) + INTERVAL 60 SECOND
    ELSE date_trunc('second', ts) END AS posted_date
FROM events"""


def d6_multi_format(spark, sf_dir):
    o = _orders(spark, sf_dir)
    k = F.col("o_orderkey") % 6
    y, m, d = F.year("d").cast("string"), F.month("d"), F.dayofmonth("d")
    full = F.element_at(F.array(*[F.lit(x) for x in MONTHS]), m)
    txt = (F.when(k == 0, F.concat(F.substring(full, 1, 3), F.lit(" "), d.cast("string"), F.lit(", "), y))
           .when(k == 1, F.concat(full, F.lit(" "), F.lpad(d.cast("string"), 2, "0"), F.lit(", "), y))
           .when(k == 2, F.concat(m.cast("string"), F.lit("/"), d.cast("string"), F.lit("/"), y))
           .when(k == 3, F.date_format("d", "yyyy-MM-dd"))
           .when(k == 4, F.concat(d.cast("string"), F.lit("/"), m.cast("string"), F.lit("/"), y))
           .otherwise(F.lit(" garbage ")))
    return o.select("o_orderkey", D.multi_format(txt).alias("posted_date"))


D6_SQL = """SELECT o_orderkey, CASE
    WHEN o_orderkey % 6 = 5 THEN NULL
    WHEN o_orderkey % 6 = 4 AND day(o_orderdate) <= 12
      THEN CAST(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) AS TIMESTAMP)
    ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS posted_date
FROM orders"""


def d7_iso_or_prefix_naive(spark, sf_dir):
    e = _events(spark, sf_dir)
    k = F.col("event_id") % 4
    txt = (F.when(k == 0, F.concat(F.date_format("ts", _ISO_FMT_SPARK), F.lit("+05:00")))
           .when(k == 1, F.concat(F.date_format("ts", _ISO_FMT_SPARK), F.lit(".000Z")))
           .when(k == 2, F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" 10:00 AM")))
           .otherwise(F.lit("n/a")))
    return e.select("event_id", D.iso_or_prefix(txt).alias("posted_date"))


D7_SQL = """SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN date_trunc('day', ts)
    ELSE date_trunc('second', ts) END AS posted_date FROM events"""


def d8_iso_only_naive(spark, sf_dir):
    e = _events(spark, sf_dir)
    k = F.col("event_id") % 3
    txt = (F.when(k == 0, F.concat(F.date_format("ts", _ISO_FMT_SPARK), F.lit("Z")))
           .when(k == 1, F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" 10:00 AM")))
           .otherwise(F.date_format("ts", "yyyy-MM-dd")))
    return e.select("event_id", D.iso_naive(txt).alias("posted_date"))


D8_SQL = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN NULL
    ELSE date_trunc('day', ts) END AS posted_date FROM events"""

QUERIES = {
    "D1_iso_naive": (d1_iso_naive, D1_SQL),
    "D2_epoch_millis_local": (d2_epoch_millis_local, D2_SQL),
    "D3_relative_posted": (d3_relative_posted, D3_SQL),
    "D4_iso_or_prefix": (d4_iso_or_prefix, D4_SQL),
    "D5_epoch_auto": (d5_epoch_auto, D5_SQL),
    "D6_multi_format": (d6_multi_format, D6_SQL),
    "D7_iso_or_prefix_naive": (d7_iso_or_prefix_naive, D7_SQL),
    "D8_iso_only_naive": (d8_iso_only_naive, D8_SQL),
}
