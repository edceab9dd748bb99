import pytest
from pyspark.sql import functions as F

from irspark.functions import text as T
from irspark.functions import urls as U

RESOLVED = {
    "http://x.y/z": "http://x.y/z", "//o.p/q": "http://o.p/q", "/abs/../k": "http://h.x/k",
    "?q=1": "http://h.x/a/?q=1", "#f": "http://h.x/a/b?c#f", "": "http://h.x/a/b?c",
    "rel": "http://h.x/a/rel", "../up": "http://h.x/up", "../../../up": "http://h.x/../../up",
    "./a/./b": "http://h.x/a/a/b", "x/..": "http://h.x/a/", "mailto:a@b": "mailto:a@b",
    "javascript:void(0)": None, "http:foo": "http://h.x/a/foo", "a?b#c": "http://h.x/a/a?b#c",
    " /trim \n": "http://h.x/trim", "a?x=/../y": "http://h.x/a/a?x=/../y",
}


def test_resolve(spark):
    df = spark.createDataFrame([(k,) for k in RESOLVED], "l string")
    got = df.select("l", U.resolve_url(F.lit("http://h.x/a/b?c#d"), F.col("l")).alias("u")).collect()
    assert {r.l: r.u for r in got} == RESOLVED


def test_resolve_on_page_without_path(spark):
    df = spark.createDataFrame([("rel",)], "l string")
    assert df.select(U.resolve_url(F.lit("http://h.x"), F.col("l"))).first()[0] == "http://h.x/rel"


def test_normalize_and_host(spark):
    df = spark.createDataFrame(
        [("https://a.b/c//", "http://a.b/c"), (" https://a.b", "https://a.b"), ("http://a.b/\n", "http://a.b")],
        "u string, want string",
    )
    assert all(r[0] == r[1] for r in df.select(U.normalize_url(F.col("u")), "want").collect())
    hosts = {"http://u:p@a.b:80/x": True, "http://A.b/": False, "ftp://a.b": True, "zzz://a.b/": False, "a.b/": False}
    df = spark.createDataFrame([(k,) for k in hosts], "u string")
    assert {r[0]: r[1] for r in df.select("u", U.same_host(F.col("u"), "a.b")).collect()} == hosts


# Pairs follow from the published rules of the Snowball stemmer.
STEMS = {
    "важная": "важн", "важнейшие": "важн", "бегавшая": "бега", "книги": "книг", "красивейший": "красив",
    "возможность": "возможн", "день": "ден", "ёлка": "елк", "обнимаясь": "обним", "прочитавши": "прочита",
    "длинный": "длин", "длиннее": "длин", "вл": "вл", "The": "The", "домами": "дом", "Москва": "москв",
    "играет": "игра", "училась": "уч",
}


def test_stems(spark):
    df = spark.createDataFrame([(k,) for k in STEMS], "w string")
    assert {r[0]: r[1] for r in df.select("w", T.stem_russian(F.col("w"))).collect()} == STEMS


def test_tokens(spark):
    df = spark.createDataFrame([("Don't @you #tag :) 3.14 a-b ... http://x.y/z?q me@x.org!",)], "t string")
    assert df.select(T.tokenize(F.col("t"), "social")).first()[0] == [
        "Don't", "@you", "#tag", ":)", "3.14", "a-b", "...", "http://x.y/z?q", "me@x.org", "!",
    ]
    assert df.select(T.fold_tokens(F.col("t"))).first()[0][:3] == ["don", "t", "you"]
    with pytest.raises(ValueError):
        T.tokenize(F.col("t"), "other")


def test_stop_words(spark):
    words = T.stop_words(spark)
    assert len(words) > 100 and "и" in words
    df = spark.createDataFrame([(["а", "и", "дом", "дом"],)], "t array<string>")
    assert df.select(T.remove_stop_words(F.col("t"), ["и", "а"])).first()[0] == ["дом", "дом"]
