"""Landings that are repeated or ended halfway, and URLs over several landings."""

import pytest
from pyspark.errors import StreamingQueryException

from lexistat.sources.publications import PUBLICATION
from lexistat.streaming import seen, snapshot

PUBLICATION_PAGE = '<p class="relations persons">Ann</p><pre class="rendering_researchoutput_bibtex">@a{k, title = "T%d"}</pre>'


@pytest.fixture
def landing(spark, tmp_path):
    folders = {name: str(tmp_path / name) for name in ("pages", "accepted", "rejected", "progress")}

    def put(*numbers):
        rows = [(i, f"u{i}", PUBLICATION_PAGE % i if i % 2 else "<p>nothing</p>") for i in numbers]
        spark.createDataFrame(rows, snapshot.PAGES).coalesce(1).write.mode("append").parquet(folders["pages"])

    def run():
        snapshot.land(spark, *folders.values()).awaitTermination()

    def found(name):
        return sorted(r["id"] for r in spark.read.schema(PUBLICATION).parquet(folders[name]).select("id").collect())

    return put, run, found


def test_two_tables_from_one_stream(landing):
    put, run, found = landing
    put(1, 2, 3)
    run()
    assert (found("accepted"), found("rejected")) == ([1, 3], [2])
    run()
    put(4, 5)
    run()
    assert (found("accepted"), found("rejected")) == ([1, 3, 5], [2, 4])


def test_a_batch_ended_between_its_writes_is_repeated(landing, monkeypatch):
    put, run, found = landing
    put(1, 2, 3)
    whole, written = snapshot.write_batch, []

    def failing(rows, target, number):
        if written:
            raise RuntimeError("the driver is lost")
        whole(rows, target, number)
        written.append(target)

    monkeypatch.setattr(snapshot, "write_batch", failing)
    with pytest.raises(StreamingQueryException):
        run()
    assert found("accepted") == [1, 3]
    monkeypatch.setattr(snapshot, "write_batch", whole)
    run()
    assert (found("accepted"), found("rejected")) == ([1, 3], [2])


def test_urls_keep_the_oldest_place_of_the_first_landing(spark, tmp_path):
    landed, folder, progress = (str(tmp_path / name) for name in ("landed", "seen", "progress"))
    landings = [
        [(5, 1, "a"), (5, 0, "a"), (7, 0, "b"), (7, 1, None)],
        [(1, 0, "a"), (9, 3, "c"), (9, 2, "c")],
        [(2, 2, "b"), (3, 0, "d"), (1, 1, "c")],
    ]
    for rows in landings:
        spark.createDataFrame(rows, seen.LANDED).coalesce(1).write.mode("append").parquet(landed)
        seen.land_urls(spark, landed, folder, progress).awaitTermination()
    found = {r["url"]: (r["page_id"], r["place"], r["batch"]) for r in seen.seen(spark, folder).collect()}
    assert found == {"a": (5, 0, 0), "b": (7, 0, 0), "c": (9, 2, 1), "d": (3, 0, 2)}


def test_a_repeated_batch_does_not_hide_its_own_urls(spark, tmp_path):
    """What an ended try has left of a batch is not older than the batch."""
    landed, folder, progress = (str(tmp_path / name) for name in ("landed", "seen", "progress"))
    rows = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], seen.LANDED)
    rows.write.parquet(landed)
    half = rows.where("url = 'a'").withColumn("bucket", seen.bucket(rows.url))
    half.write.partitionBy("bucket").parquet(f"{folder}/batch=0")
    seen.land_urls(spark, landed, folder, progress).awaitTermination()
    assert sorted(r["url"] for r in seen.seen(spark, folder).collect()) == ["a", "b"]
