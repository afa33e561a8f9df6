"""Queries that once did less than the whole job, on fixtures that show it."""

import itertools
import random
import sys
from difflib import SequenceMatcher
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402


def run(spark, folder, name, **tables):
    """The rows of a query over tables given as ``(rows, schema)``."""
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    return sorted(tuple(r) for r in entry.queries()[name](spark, str(folder)).collect())


def contributors(rows):
    return [(i, name, credentials, "2020-01-01", None) for i, name, credentials in rows], "id long, full_name string, credentials string, loaded_at string, deleted_at string"


def test_all_alike_names_of_a_surname(spark, tmp_path):
    draw = random.Random(5)
    names = ["Aohn Smitherton", "John Smitherton"] + ["James Smitherton"] * 7 + [None, "Smitherton", "J Smitherton", "W Smitherton", "John Smitherton ", "Ann Lee", "Abn Lee"]
    names += ["".join(draw.choice("abeinrz. ") for _ in range(draw.randint(1, 12))).strip() + " " + draw.choice(["Smitherton", "Bridgethorpe-Quill", "Lee"]) for _ in range(150)]
    near = [list(n) for n in draw.sample([n for n in names if n], 60)]
    for n in near:
        n[draw.randrange(len(n) - 4)] = draw.choice("aeixz")
    names += ["".join(n) for n in near]
    order = list(range(len(names)))
    draw.shuffle(order)
    rows = [(i, names[k], None) for i, k in enumerate(order)]
    expected = []
    for (i, x, _), (j, y, _) in itertools.combinations([r for r in rows if r[1]], 2):
        if x.strip(" ").split(" ")[-1].lower() == y.strip(" ").split(" ")[-1].lower():
            ratio = SequenceMatcher(None, x.lower(), y.lower()).ratio()
            if ratio >= 0.85:
                expected.append((i, j, round(ratio, 6)))
    assert run(spark, tmp_path, "jn19_ratio_pairs", contributors=contributors(rows)) == sorted(expected)


def expanded(pairs, members):
    """The pairs of all members of two classes that their representatives are paired for, and the pairs within a class."""
    classes = {}
    for i, c in members:
        classes.setdefault(c, []).append(i)
    across = [(min(x, y), max(x, y), *rest) for a, b, *rest in pairs for x in classes[a] for y in classes[b]]
    within = [p for ids in classes.values() for p in itertools.combinations(sorted(ids), 2)]
    return sorted(across), sorted(within)


def test_pairs_that_differ_in_credentials_without_the_first_record(spark, tmp_path):
    rows = [(1, "John Lee", "M.A."), (2, "James Lee", "M.A."), (3, "Jane Lée", None), (4, "Jo Lee", ""), (5, "Jack Lee", None), (6, "Ann Lee", "B.A."), (7, None, "x")]
    pairs = run(spark, tmp_path, "rs21_dedup_gate", contributors=contributors(rows))
    assert pairs == [(1, 3), (1, 4), (3, 4)]
    assert expanded(pairs, run(spark, tmp_path, "rs21_class_members"))[0] == [(1, 3), (1, 4), (1, 5), (2, 3), (2, 4), (2, 5), (3, 4), (4, 5)]


def test_forename_scores_without_the_first_record(spark, tmp_path):
    rows = [(1, "Ann Lee", None), (2, "John Lee", None), (3, "John Lee", None), (4, "James Lee", None), (5, "Lee", None), (6, None, None), (7, "ann Quill", None)]
    pairs = run(spark, tmp_path, "st33_first_name_score", contributors=contributors(rows))
    across, within = expanded(pairs, run(spark, tmp_path, "st33_classes"))
    assert sorted(across + [(*p, 2) for p in within]) == [
        (1, 2, 0), (1, 3, 0), (1, 4, 0), (1, 5, 0), (2, 3, 2), (2, 4, 1), (2, 5, 0), (3, 4, 1), (3, 5, 0), (4, 5, 0)
    ]


def test_excerpts_of_bodies_with_line_breaks(spark, tmp_path):
    rows = [(1, "One.\n\nIt stood\r\nuntil\n1462.\n"), (2, "x" * 70 + " until then"), (3, "never"), (4, None), (1, "One.\n\nIt stood\r\nuntil\n1462.\n")]
    got = run(spark, tmp_path, "st8_excerpt", articles=(rows, "id long, body string"))
    assert got == [(1, "One.  It stood until 1462. "), (2, "x" * 59 + " until then")]


def pages(rows):
    return rows, "id long, volume int, page_number int, raw_text string, wikitext string"


def test_pages_of_all_volumes_are_written_read_and_scanned(spark, tmp_path):
    rows = [(i, i % 12 + 1, 10 + i // 12, f"text\n{i}" if i else "", None) for i in range(30)]
    rows.append(rows[5])
    assert run(spark, tmp_path, "sc1_page_files", source_pages=pages(rows)) == sorted({(v, p, t) for _, v, p, t, _ in rows if t})
    assert run(spark, tmp_path, "sc14_table_scan") == [(v, 3 if v < 7 else 2, 10) for v in range(1, 13)]


def test_articles_of_all_volumes_are_written(spark, tmp_path):
    rows = [(i, i % 5 + 1, f"2020-01-0{k}", None) for i in range(20) for k in (1, 2)]
    got = run(spark, tmp_path, "sk1_replace_volumes", articles=(rows, "id long, volume int, loaded_at string, deleted_at string"))
    assert got == [(i, i % 5 + 1, "second" if i % 5 == 1 else "first") for i in range(20)]


def test_entities_of_pages_that_have_some(spark, tmp_path):
    rows = [(1, 1, 1, None, "Caf&eacute; &amp; &lt;b&gt; &#60; &vert; &mdash;"), (2, 1, 2, None, "plain"), (3, 1, 3, None, None)]
    assert run(spark, tmp_path, "st37_entities", source_pages=pages(rows)) == [(1, "Café & &lt;b&gt; &#60; &vert; —"), (2, "plain")]
