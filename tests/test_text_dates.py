"""T and D edge tables."""

import datetime as dt

from pyspark.sql import functions as F

from hirewire.functions import dates as D
from hirewire.functions import text as T


def col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_text_ops(spark):
    assert col(spark, ["a &amp; b &quot;x&quot; &amp;quot; &eacute; &#39;", "plain"], T.html_unescape) == \
        ["a & b \"x\" &quot; é '", "plain"]
    assert col(spark, ["<p>Hi</p>\n\n\n\n<b>there</b>  "], T.html_to_text) == ["Hi\n\nthere"]
    assert col(spark, ["  x  \x1c"], T.py_strip) == ["x"]
    assert col(spark, ["<a>Role</a>,  ", None], T.clean_cell) == ["Role", ""]
    assert col(spark, ["abcdef"], lambda c: T.truncate_ellipsis(c, 3)) == ["abc..."]
    assert col(spark, ["Pay $10/hr or $5 - $6"], T.salary_from_text_board) == ["$5 - $6"]
    assert col(spark, ["&amp;quot;", "O&#39;Neil"], T.entity_decode_3) == ['"', "O'Neil"]


def test_dates(spark):
    got = col(spark, ["2026-06-27T10:00:00-05:00", "2026-06-27T10:00:00Z", "2026-06-27", "2026", "garbage",
                      "2026-06-27T10"], D.iso_naive)
    assert got == [dt.datetime(2026, 6, 27, 10), dt.datetime(2026, 6, 27, 10), dt.datetime(2026, 6, 27), None, None,
                   dt.datetime(2026, 6, 27, 10)]
    run = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    rel = col(spark, ["Posted Today", "Posted Yesterday", "Posted 3 Days Ago", "Posted 30+ Days Ago",
                      "Posted 2 Months Ago", ""], lambda c: D.relative_posted(c, run))
    assert rel == [dt.datetime(2024, 2, 15), dt.datetime(2024, 2, 14), dt.datetime(2024, 2, 12),
                   dt.datetime(2024, 1, 16), dt.datetime(2023, 12, 17), None]
    keep = col(spark, [dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 15, 23, 59), None],
               lambda c: D.staleness_keep(c, run), "timestamp_ntz")
    assert keep == [True, False, True]
    assert col(spark, ["Jan 5, 2024", "5/1/2024", "13/5/2024", "x"], D.multi_format) == [
        dt.datetime(2024, 1, 5), dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 13), None]


def test_iso_basic_and_week_forms(spark):
    cases = {"20260627": dt.datetime(2026, 6, 27), "20260627T100000": dt.datetime(2026, 6, 27, 10),
             "2026-06-27T100000": dt.datetime(2026, 6, 27, 10), "20260627T10:00:00": dt.datetime(2026, 6, 27, 10),
             "2026-W26-6": dt.datetime(2026, 6, 27), "2026W266": dt.datetime(2026, 6, 27),
             "2026-W26": dt.datetime(2026, 6, 22), "2026-W26-6T10:00": dt.datetime(2026, 6, 27, 10),
             "20260627T100000Z": dt.datetime(2026, 6, 27, 10), "2026-06-2": None, "2026-06-27T1": None,
             "2026-W53-1": dt.datetime(2026, 12, 28), "2025-W53-1": None, "2026-02-30": None}
    assert dict(zip(cases, col(spark, list(cases), D.iso_naive))) == cases


def test_html_unescape_full_table(spark):
    """Numeric, nested, unterminated and unknown entities decode as in HTML5, in one pass."""
    import html

    cases = ["&#39;&#x27;&#X41;", "&amp;lt;b&amp;gt;", "&ampx &notit; &copy 2024", "&nosuch; &;", "&#0; &#x110000; &#128;", "a & b", "&Aacute;&hearts;&NotEqualTilde;"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(T.html_unescape("s")).collect()]
    assert got == [html.unescape(c) for c in cases]
    assert got[0] == "\'\'A" and got[1] == "&lt;b&gt;" and got[2] == "&x ¬it; © 2024"


def test_word_edges_next_to_letters_outside_ascii(spark):
    """An accented letter is a letter: 'intern' inside 'internés' is no word, nor is 'vp' in 'évp'."""
    from hirewire.functions import classify as C

    df = spark.createDataFrame([(0, "Internés"), (1, "Intern – été"), (2, "ÉVP Sales"), (3, "VP Sales")], "i int, s string")
    out = df.orderBy("i").select(C.experience_level("s").alias("e"), C.is_entry_level("s").alias("k")).collect()
    assert [r["e"] for r in out[:2]] == ["new_grad", "internship"] and [r["k"] for r in out[2:]] == [True, False]


def test_entity_decoding_of_company_and_whole_page(spark, tmp_path):
    """The query gives the company in the page's title and the whole page, both decoded."""
    from hirewire.plans.q_text import t12_entity_decode_3

    html = ["<title>A &amp;amp; B&#39;s\n</title><p>&quot;x&quot; &lt;</p>", "&amp;quot;", None]
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = [tuple(r) for r in t12_entity_decode_3(spark, str(tmp_path)).orderBy("page_id").select("company", "text").collect()]
    assert got == [("A &amp; B's\n", "<title>A &amp; B's\n</title><p>\"x\" &lt;</p>"), ("", '"'), (None, None)]


def test_arguments_are_evaluated_once(spark):
    """A date's text and an item's fields are looked up once for a row, whatever uses them; details after a date stay out."""
    from hirewire.operators import extract as P

    df = spark.createDataFrame([("2026-06-27T10", ":00:01.5Z\n"), ("2026-06-27", "|x")], "a string, b string")
    out = df.select(D.iso_naive(F.concat("a", "b")).alias("d"))
    assert out._jdf.queryExecution().analyzed().toString().count("concat(a#") == 1
    assert [r[0] for r in out.collect()] == [dt.datetime(2026, 6, 27, 10, 0, 1, 500000), None]
    pages = spark.createDataFrame([('{"jobs":[{"title":"A","location":{"name":"Ottawa"},"updated_at":"2026-06-27T10:00Z"}]}',)], "body string").selectExpr(
        "body", "timestamp_ntz'2024-02-15 00:00:00' AS run_ts", "'greenhouse' AS platform", "1L AS company_seq", "0 AS search_id", "0 AS page_no",
        "'C' AS company_name", "'b' AS board_slug", "parse_json('{}') AS raw")
    jobs = P.greenhouse(pages)
    assert jobs._jdf.queryExecution().optimizedPlan().toString().count("$.updated_at") <= 2  # its value, and whether it is empty
    assert [tuple(r) for r in jobs.select("title", "location", "posted_date").collect()] == [("A", "Ottawa", dt.datetime(2026, 6, 27, 10))]
    truth = ["null", "true", "false", '""', '"x"', "[]", "[0]", "{}", '{"a":0}', "0", "0.0", "-1", "1e3"]
    vs = spark.createDataFrame([(i, x) for i, x in enumerate(truth)], "i int, s string").orderBy("i").select(T.variant_truthy(F.parse_json("s")))
    assert [r[0] for r in vs.collect()] == [False, True, False, False, True, False, True, False, True, False, False, True, True]
