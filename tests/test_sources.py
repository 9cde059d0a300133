import json

from lexistat.sources.publications import (
    SIGNAL_INPUTS,
    inline_table,
    read_publications,
    read_signals,
    write_publications,
)
from lexistat.streaming.snapshot import land_publications

RECORDS = [
    {"id": 1, "title": "A", "authors": [{"name": "Ann", "link": "/a"}], "year": "2024", "concepts": ["X\n9%"]},
    {"title": "B", "author": "Ann and Bob", "month": "jan"},
]


def test_json_array_round_trip(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps(RECORDS, indent=4))
    read = read_publications(spark, str(tmp_path / "in.json"))
    rows = {r["title"]: r for r in read.collect()}
    assert rows["A"]["authors"][0]["name"] == "Ann" and rows["B"]["day"] is None
    write_publications(read, str(tmp_path / "out"), "json")
    again = read_publications(spark, str(tmp_path / "out"), multi_line=False)
    assert again.schema == read.schema
    assert sorted(map(repr, again.collect())) == sorted(map(repr, read.collect()))
    write_publications(read, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_signals_file_is_read_by_position(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,b,c,d,e\n1,2,3,4,5\n1,,3,4,5\n6,7,8,9,10\n")
    table = read_signals(spark, str(tmp_path / "s.csv"))
    assert table.columns == [*SIGNAL_INPUTS, "y"]
    assert sorted(tuple(r) for r in table.collect()) == [(1, 2, 3, 4, 5), (6, 7, 8, 9, 10)]


def test_inline_table(spark):
    assert inline_table(spark, [("t", "c")], "text string, label string").count() == 1


def test_new_page_files_are_appended_once(spark, tmp_path):
    pages, target, progress = (str(tmp_path / n) for n in ("pages", "target", "progress"))

    def land(i):
        html = f'<pre class="rendering_researchoutput_bibtex">year = "{2000 + i}",</pre>'
        rows = [(i, "u", html), (i + 100, "u", "<p>nothing</p>")]
        spark.createDataFrame(rows, "page_id bigint, url string, html string").write.mode("append").parquet(pages)
        land_publications(spark, pages, target, progress).awaitTermination()

    land(1)
    land(2)
    found = spark.read.parquet(target)
    assert sorted((r["id"], r["year"]) for r in found.collect()) == [(1, "2001"), (2, "2002")]


def test_inline_table_keeps_nulls_and_types(spark):
    table = inline_table(spark, [(1, "a", None), (2, None, 0.5)], "id bigint, name string, share double")
    assert [tuple(r) for r in table.orderBy("id").collect()] == [(1, "a", None), (2, None, 0.5)]
    assert table.schema.simpleString() == "struct<id:bigint,name:string,share:double>"
