"""Every query of the subpackage on the smallest tables: against its SQL, or what must hold of its rows."""

import sys
from pathlib import Path

import duckdb
import pytest

from lexiloom.llm import queries
from lexiloom.tables import table

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    cache = {}

    def run(name):
        if name not in cache:
            cache[name] = queries.QUERIES[name](spark, SMALL).collect()
        return cache[name]

    return run


@pytest.mark.parametrize("name", list(queries.SQL))
def test_agrees_with_its_sql(spark, name):
    from oracle import compare

    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    assert compare(spark, connection, SMALL, queries.QUERIES[name], queries.SQL[name]).startswith("ok")


def test_pieces_fit(rows):
    found = {r["article_id"] for r in rows("p1_found")}
    assert {r["article_id"] for r in rows("p1_pieces")} == found
    assert all(r["piece_end"] - r["piece_start"] <= queries.LIMIT for r in rows("p1_pieces"))


def test_people(spark, rows):
    entity = {r["rid"]: r["entity"] for r in rows("p3_entities")}
    ids = table(spark, SMALL, "contributors").select("id").union(table(spark, SMALL, "vol29_entries").select("id")).distinct().count()
    assert len(entity) == len(rows("p3_entities")) == ids
    pairs = {(r["id_a"], r["id_b"]) for r in rows("p3_found")}
    assert pairs == {(a, b) for a in entity for b in entity if a < b and entity[a] == entity[b]} and pairs


def test_headings(spark, rows):
    known = {r["heading_id"] for r in table(spark, SMALL, "headings").collect()} | {0}
    found = rows("p4_found")
    assert {r["heading_id"] for r in found} <= known and len({r["xref_id"] for r in found}) == len(found)
    assert len(rows("p4_headings")) == len(known) - 1
    offered = {(r["written"], r["heading_id"]): r["distance"] for r in rows("p4_candidates")}
    assert len(offered) == len(rows("p4_candidates")) and {h for _, h in offered} <= known and set(offered.values()) <= {0, 1, 2}
    unmatched = sum(r["n_xrefs"] for r in rows("p4_unmatched"))
    assert unmatched + sum(r["n_xrefs"] for r in rows("p4_headings")) == table(spark, SMALL, "xrefs").select("id", "surface_text", "normalized_target").distinct().count()


def test_scans(spark, rows):
    found = rows("p5_found")
    assert {r["kind"] for r in found} == {"furniture", "hyphen", "misread"} and len(set(found)) == len(found)
    texts = {(r["id"], f): r[f].split("\n") for r in table(spark, SMALL, "source_pages").collect() for f in ("raw_text", "wikitext") if r[f]}
    assert all(texts[r["page_id"], r["field_name"]][r["line_no"] - 1].strip() for r in found)
    assert all(r["text"].strip() and "\n" not in r["text"] for r in rows("p5_paragraphs"))
    assert all(r["word"] != r["right"] for r in rows("p5_misreadings"))


def test_containers(rows):
    fills = {}
    for r in rows("p6_containers"):
        fills[r["container_id"]] = fills.get(r["container_id"], 0) + max(1, r["piece_bytes"])
    assert fills == {r["container_id"]: r["container_fill"] for r in rows("p6_containers")} and max(fills.values()) <= queries.CAPACITY
    report = rows("p6_report")[0]
    assert report["n_containers"] == len(fills) and report["n_items"] == len(rows("p6_containers")) and report["least_containers"] <= len(fills)


def test_token_ids(spark, rows):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    ids = {r["doc_id"]: r["ids"] for r in rows("p7_ids")}
    assert set(ids) == set(docs) and all(bool(ids[d]) == bool(t) for d, t in docs.items())
    assert rows("p7_roundtrip") == []
    assert sum(r["n_50k"] for r in rows("p7_multi")) == sum(map(len, ids.values()))


def test_mixture(rows):
    shares = {r["source"]: r for r in rows("p8_shares")}
    assert abs(sum(r["actual_share"] for r in shares.values()) - 1) < 1e-9
    tokens, keys = {}, [r["shuffle_key"] for r in rows("p8_mixture")]
    for r in rows("p8_mixture"):
        tokens[r["source"]] = tokens.get(r["source"], 0) + r["n_tokens"]
        assert 1 <= r["copy_no"] <= shares[r["source"]]["max_repeats"] and r["text"]
    assert keys == sorted(keys) and tokens == {s: r["mixed_tokens"] for s, r in shares.items() if r["mixed_tokens"]}


def test_languages(spark, rows):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    at = {}
    for r in sorted(rows("p9_passages"), key=lambda r: (r["doc_id"], r["passage_no"])):
        assert 0 <= r["passage_confidence"] <= 1
        if r["passage_start"] is not None:
            assert at.get(r["doc_id"], 0) <= r["passage_start"] < r["passage_end"] <= len(docs[r["doc_id"]])
            at[r["doc_id"]] = r["passage_end"]
    assert {r["doc_id"] for r in rows("p9_documents")} == set(docs)
    langs = {(r["doc_id"], r["passage_lang"]) for r in rows("p9_passages") if r["passage_lang"]}
    assert {(r["doc_id"], r["lang"]) for r in rows("p9_found")} <= langs


def test_every_query_is_named_in_a_test():
    text = Path(__file__).read_text()
    assert all(name in queries.SQL or f'"{name}"' in text for name in queries.QUERIES if name != "p1_found")
