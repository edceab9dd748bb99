import base64
import zlib

import pytest
from pyspark.sql import functions as F

from irspark.operators import html
from irspark.operators.ltr import LambdaRankModel
from irspark.sources import relevance as S
from irspark.sources import store


def test_tables(spark, tmp_path):
    (tmp_path / "q").write_text('1\tкупить "дом\n2\tlast\n')
    assert {(r.query_id, r.query) for r in S.read_queries(spark, str(tmp_path / "q")).collect()} == {("1", 'купить "дом'), ("2", "last")}
    (tmp_path / "u").write_text("7\thttp://a.b/\tdir/7.html\n")
    row = S.read_urls(spark, str(tmp_path / "u")).first()
    assert (row.doc_id, row.url, row.path) == (7, "http://a.b/", "dir/7.html")
    (tmp_path / "c").write_text('{"1": [5, 3], "2": []}')
    assert {(r.query_id, r.pos, r.doc_id) for r in S.read_candidates(spark, str(tmp_path / "c")).collect()} == {("1", 0, 5), ("1", 1, 3)}


def test_raw_pages_in_two_charsets(spark, tmp_path):
    folder = tmp_path / "sub"
    folder.mkdir()
    (folder / "doc1.html").write_bytes("<p>дом".encode("utf-8"))
    (folder / "doc2.html").write_bytes("<p>дом".encode("cp1251"))
    (folder / "doc3.html").write_bytes(b"\x98\xff")
    got = {r.page_id: r.html for r in S.read_raw_pages(spark, str(tmp_path)).collect()}
    assert got == {1: "<p>дом", 2: "<p>дом"}


def test_packed_pages(spark):
    good = base64.b64encode(zlib.compress("<p>é".encode())).decode()
    cut = base64.b64encode(zlib.compress(b"x" * 5000)[:-3]).decode()
    junk = base64.b64encode(b"junk").decode()
    lines = spark.createDataFrame([(f"1\t{good}",), (f"2\t{junk}",), ("3\t%%%",), ("4",), (f"5\t{cut}",)], "value string")
    got = {r.id: r.html for r in S.read_packed_pages(lines).collect()}
    assert got[1] == "<p>é" and got[2] is None and got[3] is None and got[4] is None
    assert set(got[5]) == {"x"}


def test_first_line(spark, tmp_path):
    for name, text in (("a", "1\n2\n3\n"), ("b", "only"), ("c", "")):
        sub = tmp_path / "in" / name
        sub.mkdir(parents=True)
        (sub / "f.txt").write_text(text)
    S.write_without_first_line(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = {r.folder: r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["a"] == "2\n3\n" and got["b"] == ""
    one = S.read_without_first_line(spark, str(tmp_path / "in" / "a")).first()
    assert (one.file, one.text) == ("f.txt", "2\n3\n")


def test_parsed_pages_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(4, "u", "<title>t</title><p title=x>a</p>")], "page_id long, url string, html string")
    doc = html.page_document(pages)
    for fmt in ("json", "parquet"):
        path = str(tmp_path / fmt)
        S.write_pages(doc, path, fmt)
        assert S.read_pages(spark, path, fmt).first() == doc.first()


def test_number_in_name_and_failures(spark):
    df = spark.createDataFrame([("page12.v3.json",), ("none",)], "f string")
    assert [r[0] for r in df.select(S.number_in_name(F.col("f"))).collect()] == [12, None]
    urls = spark.createDataFrame([(1,), (2,)], "doc_id long")
    assert [r.doc_id for r in S.failed_pages(urls, spark.createDataFrame([(1,)], "doc_id long")).collect()] == [2]


def test_ranking_file(spark, tmp_path):
    ranking = spark.createDataFrame([("10", 5, 1), ("2", 7, 2), ("2", 8, 1)], "query_id string, doc_id long, rank long")
    S.write_ranking(ranking, str(tmp_path / "r"))
    lines = []
    for f in sorted((tmp_path / "r").glob("part-*")):
        lines += f.read_text().splitlines()[1:]
    assert lines == ["2,8", "2,7", "10,5"]
    S.write_ranking(ranking, str(tmp_path / "s"), ("DocumentId", "QueryId"))
    head = sorted((tmp_path / "s").glob("part-*"))[0].read_text().splitlines()[0]
    assert head == "DocumentId,QueryId"


def test_candidates_keep_sample_order(spark):
    sample = spark.createDataFrame([("1", 9, 0), ("2", 4, 1), ("1", 3, 2)], "query_id string, doc_id long, n int")
    got = {(r.query_id, r.pos, r.doc_id) for r in S.candidates(sample, [F.col("n").asc()]).collect()}
    assert got == {("1", 0, 9), ("2", 0, 4), ("1", 1, 3)}


def test_one_large_object_is_read_in_parts(spark, tmp_path):
    """Brackets, quotes, commas and backslashes in queries, over many splits, against the json module."""
    import json
    import random

    rng = random.Random(5)
    odd = ["a]b", "]", "]]x]", 'say "no] yes', "back\\", "back\\]", '\\"]', "{}", "}, ", "", "дом]", "[1, 2]", "\n]\t", "\U0001F600]"]
    wanted = {f"{rng.choice(odd)} {i} {rng.choice(odd)}": [rng.randrange(10**6) for _ in range(rng.randrange(6))] for i in range(3000)}
    wanted.update({q: [1, 2] for q in odd})
    wanted["none"] = None
    wanted["last"] = []
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "1.json").write_text(json.dumps(wanted, ensure_ascii=False, indent=1), encoding="utf-8")
    (tmp_path / "c" / "2.json").write_text(json.dumps({"second]": [7, 7]}) + "\n" + json.dumps({"third": [8]}) + "\n")
    (tmp_path / "c" / "3.json").write_text("{}")
    (tmp_path / "c" / "4.json").write_text("")
    expected = sorted((q, i, x) for q, docs in wanted.items() for i, x in enumerate(docs or []))
    expected = sorted(expected + [("second]", 0, 7), ("second]", 1, 7), ("third", 0, 8)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        out = S.read_candidates(spark, str(tmp_path / "c")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.query_id, r.pos, r.doc_id) for r in out) == expected


def test_written_candidates_come_back(spark, tmp_path):
    rows = [("q]1", 0, 5), ("q]1", 1, 3), ("2", 0, 5), ("2", 1, 5)]
    given = spark.createDataFrame(rows, "query_id string, pos int, doc_id bigint")
    S.write_candidates(given, str(tmp_path / "out"))
    assert sorted((r.query_id, r.pos, r.doc_id) for r in S.read_candidates(spark, str(tmp_path / "out")).collect()) == sorted(rows)


def test_store_takes_the_newest_complete_version(spark, tmp_path):
    folder = str(tmp_path / "models")
    assert store.versions(spark, folder) == []
    with pytest.raises(FileNotFoundError):
        store.load(spark, folder)
    model = LambdaRankModel(0.5, [{"value": 2.0}, {"feature": 0, "threshold": 1.5, "left": {"value": 1.0}, "right": {"value": -3.0}}])
    nothing = spark.createDataFrame([], "term string, idf double")
    first = store.save(spark, folder, {"trees": model.table(spark), "vocabulary": nothing}, {"note": "é"})
    known = spark.createDataFrame([("a", 1.0), (None, None)], "term string, idf double")
    second = store.save(spark, folder, {"vocabulary": known})
    # A third version was cut off before its manifest.
    known.write.parquet(f"{folder}/v00000003-{'0' * 32}/vocabulary")
    (tmp_path / "models" / "other").mkdir()

    newest = store.load(spark, folder)
    assert newest.path == second and newest.about == {"rows": {"vocabulary": 2}}
    assert sorted(newest.tables["vocabulary"].collect(), key=str) == sorted(known.collect(), key=str)
    older = store.load(spark, folder, first.rsplit("/", 1)[1])
    assert older.about["note"] == "é" and older.tables["vocabulary"].count() == 0
    read = LambdaRankModel.from_table(older.tables["trees"])
    assert read == model
    rows = spark.createDataFrame([([1.0],), ([2.0],)], "features array<double>")
    assert [r.s for r in rows.select(read.predict(rows.features).alias("s")).collect()] == [1.5, -0.5]

    fourth = store.save(spark, folder, {"vocabulary": known})
    assert "/v00000004-" in fourth
    assert store.prune(spark, folder, 1) == [first.rsplit("/", 1)[1], second.rsplit("/", 1)[1]]
    assert store.load(spark, folder).path == fourth and len(store.versions(spark, folder, complete=False)) == 2
    with pytest.raises(ValueError):
        store.save(spark, folder, {"../x": known})
