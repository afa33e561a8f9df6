"""A corpus from pages to its export, by the shell's commands."""

from lexiloom.__main__ import main


def test_a_corpus_from_pages_to_export(spark, tmp_path, capsys):
    corpus, out = str(tmp_path / "corpus"), str(tmp_path / "out")
    for volume, names in ((1, ("LANTERN", "LARCH")), (2, ("MADDER",))):
        text = "===PAGE===".join(f"'''{n},''' see [[Abbey|the abbey]].\n\nMore of {n.lower()}." for n in names) + "===PAGE===and so on."
        (tmp_path / f"v{volume}.txt").write_text(text)
    assert main(["init", corpus]) == 0
    for volume in (1, 2):
        assert main(["import-pages", corpus, str(tmp_path / f"v{volume}.txt"), str(volume)]) == 0
    assert main(["list-pages", corpus, "1"]) == 0 and "|     3|" not in capsys.readouterr().out
    assert main(["detect-boundaries", corpus]) == 0
    rows = {r["title"]: r for r in spark.read.parquet(f"{corpus}/articles").collect()}
    assert set(rows) == {"LANTERN", "LARCH", "MADDER"} and rows["LARCH"]["page_end"] == 3 and "and so on." in rows["LARCH"]["body"]
    assert main(["export-articles", corpus, out, "1"]) == 0 and spark.read.json(f"{out}/articles").count() == 2
    assert main(["corpus-export", corpus, out]) == 0 and spark.read.json(f"{out}/links").count() == 3
    assert main(["reset-volume", corpus, "1"]) == 0 and spark.read.parquet(f"{corpus}/articles").count() == 1
    assert main(["detect-boundaries", corpus, "1"]) == 0 and spark.read.parquet(f"{corpus}/articles").count() == 3
    assert main(["show"]) == 2 and main(["reset-volume", corpus]) == 2
