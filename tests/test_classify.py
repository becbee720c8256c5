"""C1-C6 edge tables (expected values derived by hand from the rule definitions)."""

from pyspark.sql import functions as F

from hirewire.functions import classify as C

from .conftest import rows


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_entry_level_and_experience(spark):
    titles = ["", "Senior Intern", "Lead Generation Intern", "Coop Student", "Co-op", "Engineer I", "Engineer",
              "Leader", "Internal Auditor", None, "   ", "Head  of Data", "VP, Sales"]
    entry = one_col(spark, titles, C.is_entry_level)
    assert entry == [False, False, False, True, True, True, True, True, True, False, True, False, False]
    level = one_col(spark, titles, C.experience_level)
    assert level[3:9] == ["internship", "internship", "new_grad", "new_grad", "new_grad", "new_grad"]


def test_work_type(spark):
    assert one_col(spark, ["Remote - US", "Hybrid, Remote", "NYC", "hybrid office", "remoteness"], C.work_type) == \
        ["remote", "remote", "onsite", "hybrid", "onsite"]


def test_country_cascade_quirks(spark):
    cases = {
        "Toronto, ON": "CA", "Toronto, CA": "US", "London, UK": "CA", "American Fork, UT": "CA",
        "Tbilisi, Georgia": "US", "Paris, FR; Austin, TX": "US", "San José, CA": "US", "Lausanne": "US",
        "Ottawa": "CA", "Remote": "US", "In-Office": "US", "Berlin": None, "Vatican City": "CA",
        "\U0001f1fa\U0001f1f8 Canada": "US", "Mumbai, MH": None, "TX": "US", "ON": "CA", "On-site": "US",
    }
    assert dict(zip(cases, countries(spark, list(cases)))) == cases


def countries(spark, locations):
    df = spark.createDataFrame(list(enumerate(locations)), "i int, location string")
    return rows(C.with_country(df, "location").orderBy("i"), "country")


def test_location_filter(spark):
    df = spark.createDataFrame([(0, ""), (1, None), (2, "Berlin"), (3, "Remote")], "i int, location string")
    out = C.with_country(df, "location").select("i", C.located().alias("ok")).orderBy("i")
    assert rows(out, "ok") == [False, False, False, True]


def test_role_category(spark):
    df = spark.createDataFrame([
        (0, "ML Intern", None), (1, "Data Engineer", None), (2, "Software Sales", None), (3, "Assembly Lead", None),
        (4, "Zzz", "Legal"), (5, "Zzz", None), (6, "Zzz", "   "), (7, "Zzz", "  Sales  "), (8, None, None)],
        "i int, t string, d string")
    got = rows(C.with_role_category(df, "t", "d", "cat").orderBy("i"), "cat")
    assert got == ["Machine Learning and AI", "Data Analysis", "Software Engineering", "Marketing",
                   "Legal and Compliance", "Other", "Other", "Sales", "Other"]
