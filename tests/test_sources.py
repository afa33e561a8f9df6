import json

import pytest
from pyspark.sql import types as T

from lexiloom.sources import readers, sinks
from lexiloom.streaming import events as S


def write_pages(folder):
    (folder / "vol_01").mkdir(parents=True)
    for page, content in {1: {"volume": 1, "page_number": 1, "raw_text": "tlie abbey"}, 2: {"volume": 1, "page_number": 9, "raw_text": "x"}, 3: {"volume": 1, "page_number": 3}, 4: {"volume": 1, "page_number": 4, "raw_text": ""}}.items():
        (folder / "vol_01" / f"vol01-page{page:04d}.json").write_text(json.dumps(content))
    (folder / "vol_01" / "vol01-page0005.json").write_text("{broken")
    (folder / "vol_01" / "stray.json").write_text("{}")


def test_every_page_failure_is_told(spark, tmp_path):
    write_pages(tmp_path)
    good, bad = readers.load_pages(spark, str(tmp_path), strict=False)
    assert sorted(r["page_number"] for r in good.collect()) == [1, 4]
    assert {(r["member"], r["reason"]) for r in bad.collect()} == {
        ("vol01-page0002.json", "name and content disagree"), ("vol01-page0003.json", "missing field"), ("vol01-page0005.json", "unreadable"), ("stray.json", "bad file name"),
    }
    with pytest.raises(readers.PartialLoad) as raised:
        readers.load_pages(spark, str(tmp_path))
    assert len(raised.value.failures) == 4
    fixes = spark.createDataFrame([(1, 0, "tlie", "the")], "volume int, place int, wrong string, right string")
    good, bad = readers.load_pages(spark, str(tmp_path), 1, [1, 7], strict=False, corrections=fixes)
    assert [r["raw_text"] for r in good.collect()] == ["the abbey"] and [(r["member"], r["reason"]) for r in bad.collect()] == [("vol01-page0007.json", "absent")]


def test_corpus_without_sidecars(spark, tmp_path):
    for name, text in {"a.json": '{"id": 1, "body": "x"}', "b.json": '{"id": 2}', "c.json": "nonsense", "index.json": "[]"}.items():
        (tmp_path / name).write_text(text)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("body", T.StringType())])
    good, bad = readers.load_corpus(spark, str(tmp_path), schema, strict=False)
    assert [r["id"] for r in good.collect()] == [1] and sorted(r["reason"] for r in bad.collect()) == ["missing body", "unreadable"]
    with pytest.raises(readers.PartialLoad):
        readers.load_corpus(spark, str(tmp_path), schema)


def test_plain_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ===PAGE=== b\n")], "id int, t string")
    assert [(r["page_number"], r["raw_text"]) for r in readers.split_pages(df, "t").collect()] == [(1, "a"), (2, "b")]
    (tmp_path / "ocr.json").write_text(json.dumps({"7": "A\nB"}))
    assert [(r["page"], r["line_no"], r["line"]) for r in readers.recognised_pages(spark, str(tmp_path / "ocr.json")).collect()] == [(7, 1, "A"), (7, 2, "B")]
    (tmp_path / "pages.json").write_text(json.dumps({"pages": [{"leafNum": 1, "pageNumber": "12", "confidence": 99.0}, {"leafNum": 2, "pageNumber": "13"}, {"leafNum": 3, "pageNumber": "x", "confidence": 1.0}]}))
    assert [tuple(r) for r in readers.confident_pages(spark, str(tmp_path / "pages.json")).collect()] == [(1, 12)]
    (tmp_path / "titles.tsv").write_text("0\tThe_Abbey\n4\tTalk\n100\tX\n")
    assert sorted(r["title"] for r in readers.titles_dump(spark, str(tmp_path / "titles.tsv")).collect()) == ["The Abbey", "X"]
    assert readers.titles_dump(spark, str(tmp_path / "none.tsv")).count() == 0


def test_upsert(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, readers.upsert(old, new, ["k"], False).collect())) == [(1, "a"), (2, "b"), (3, "C")]
    assert sorted(map(tuple, readers.upsert(old, new, ["k"], True).collect())) == [(1, "a"), (2, "B"), (3, "C")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "volume int, v string")
    path = str(tmp_path / "out")
    sinks.write_partitions(df, path)
    sinks.write_partitions(spark.createDataFrame([(2, "B")], "volume int, v string"), path)
    assert sorted((r["volume"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "B")]
    listed = {r["name"]: r["n_rows"] for r in sinks.write_bundle({"x": df, "empty": df.limit(0)}, str(tmp_path / "bundle")).collect()}
    assert listed == {"x": 2, "empty": 0}
    assert sinks.manifest({"x": df}).collect() == sinks.manifest({"x": df.repartition(3)}).collect()
    with pytest.raises(RuntimeError):
        sinks.guard_once(2000, 0)
    assert [r["name"] for r in sinks.referenced_files(df.withColumnRenamed("v", "name"), "name", spark.createDataFrame([("a",)], "name string")).collect()] == ["b"]


def test_streams(spark, tmp_path):
    rows = spark.sql("SELECT id % 40 AS event_id, timestamp'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts, 'k' AS event_type, 1.0D AS value FROM range(100)")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    stream = S.read_table(spark, str(tmp_path), "events")
    assert S.drain(S.distinct_events(stream, "event_id", "ts", "3650 days")).count() == 40
    days = S.drain(S.windowed_counts(S.read_table(spark, str(tmp_path), "events"), "ts", "event_type", "value")).collect()
    assert all(r["n"] == 24 for r in days) and len(days) == 4
    S.ingest(S.read_table(spark, str(tmp_path), "events").select("event_id"), str(tmp_path / "target"), ["event_id"])
    assert spark.read.parquet(str(tmp_path / "target")).count() == 40
