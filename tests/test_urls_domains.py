"""U1-U6 and L1-L8 edge tables."""

from pyspark.sql import functions as F

from hirewire.functions import domains as L
from hirewire.functions import urls as U

from .conftest import rows

NORMALIZE = {
    "https://H.com/a/?b=2&a=1&utm_source=x#f": "https://H.com/a?a=1&b=2",
    "https://x/": "https://x/",
    "https://x": "https://x",
    "https://x/a;s=1": "https://x/a",
    "https://x/p?k=%zz": "https://x/p?k=%25zz",
    "": "",
    "   ": "://",
    "https://x/?UTM_Source=1&z=a+b&y=%7E*": "https://x/?y=~%2A&z=a+b",
    "HTTPS://X.com//": "https://X.com",
    "https://x?a&b=&&c=1&a=2": "https://x?a=&a=2&b=&c=1",
    "https://x/?b=%C3%A9&B=1": "https://x/?B=1&b=%C3%A9",
}


def test_normalize_url_cases(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(NORMALIZE)], "i int, url string")
    staged = rows(U.with_normalized_url(df, "url", "n").orderBy("i"), "n")
    assert dict(zip(NORMALIZE, staged)) == NORMALIZE
    col_form = [r[0] for r in df.orderBy("i").select(U.normalize_url("url")).collect()]
    assert col_form == staged


def test_normalize_is_idempotent_on_absolute_urls(spark):
    urls = ["https://a.example.com/x/y/?q=1&p=2&ref=z", "http://b.example.org/?k=v+w&k=a", "https://c.io/p;x?z#f"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    once = U.with_normalized_url(df, "url", "n1")
    twice = U.with_normalized_url(once, "n1", "n2")
    assert all(a == b for a, b in rows(twice, "n1", "n2"))


def test_domain_from_url(spark):
    cases = {"jobs.foo.co.uk": "foo.co.uk", "https://www.foo.com:80/x": "foo.com", "boards.greenhouse.io": None,
             "ftp://a.com": None, "localhost": None, "https://user@Www.Bar.io/": "bar.io", "   ": None}
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, u string")
    got = rows(L.with_domain_from_url(df, "u", "d").orderBy("i"), "d")
    assert dict(zip(cases, got)) == cases


def test_domain_from_name_and_logo(spark):
    names = {"TD Bank": "td.com", "Acme Technologies Inc.": "acme.com", "The Group": "thegroup.com", "X": None,
             "": None}
    df = spark.createDataFrame([(i, k) for i, k in enumerate(names)], "i int, c string")
    got = rows(L.with_domain_from_name(df, "c", "d").orderBy("i"), "d")
    assert dict(zip(names, got)) == names
    logos = {"https://www.google.com/s2/favicons?domain=acme.com&sz=128": "acme.com",
             "https://logo.clearbit.com/globex.com?size=1": "globex.com", "https://icon.horse/icon/": None,
             "https://cdn.x.com/a.png": None}
    ldf = spark.createDataFrame([(i, k) for i, k in enumerate(logos)], "i int, l string")
    got = [r[0] for r in ldf.orderBy("i").select(L.domain_from_logo_url("l")).collect()]
    assert dict(zip(logos, got)) == logos


def test_resolve_logo_keeps_real_logo(spark):
    df = spark.createDataFrame([
        (0, "Acme", "https://www.acme.com", "https://cdn.acme.com/logo.png"),
        (1, "Acme", "", "https://logo.clearbit.com/acme.io"),
        (2, "", "", "")], "i int, c string, u string, l string")
    out = L.with_resolved_logo(df, "c", "u", "l", "logo", "domain").orderBy("i")
    assert rows(out, "logo", "domain") == [
        ("https://cdn.acme.com/logo.png", "acme.com"),
        ("https://www.google.com/s2/favicons?domain=acme.io&sz=128", "acme.io"),
        ("", "")]


def test_search_logo(spark):
    df = spark.createDataFrame([("Q & A Co",), ("",)], "c string")
    assert [r[0] for r in df.select(L.search_logo("c")).collect()] == [
        "https://www.google.com/s2/favicons?domain=q&aco.com&sz=128", ""]
