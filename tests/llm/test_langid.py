import numpy as np
from pyspark.sql import functions as F

from lexiloom.llm import langid


def seeds_only():
    return langid.fit([])


def test_labels():
    for label, code in {"en": "en", "en-GB": "en", "ENGLISH": "en", "deu": "de", "français": "fr", "es_MX": "es", "Latin ": "la", "dut": "nl", "und": None, "": None, "?": None, "pt": None, None: None}.items():
        assert langid.fold_label(label) == code


def test_label_column(spark):
    labels = ["en-GB", "LAT", "français", "", None, "xx", "deutsch (alt)"]
    df = spark.createDataFrame([(x,) for x in labels], "lang string")
    got = [r[0] for r in df.select(langid.label_column(F.col("lang"))).collect()]
    assert got == [langid.fold_label(x) for x in labels]


def test_probabilities_sum_to_one():
    models = langid.train([["abab abba baba"], ["cdcd dccd cddc"]], order=3)
    before = langid.plain_text("ab").rstrip()
    letters = sorted(set("abcd "))
    total = sum(np.exp(-(models.entropies([before + c])[0][0, 0] * (len(before) + 1) - models.entropies([before])[0][0, 0] * len(before))) for c in letters)
    assert 0.9 < total < 1.05


def test_sentences_and_initials():
    text = "Er kam nach G. Flim, 43 m. von hier (vol. ii.). „Dann ging er“. Il a dit non.\nNext line"
    assert [text[s:e] for s, e in langid.sentences(text)] == ["Er kam nach G. Flim, 43 m. von hier (vol. ii.).", "„Dann ging er“.", "Il a dit non.", "Next line"]


def test_held_out_accuracy_of_the_seeds():
    found = seeds_only()
    held = {
        "en": "They would not have come to the house if the king had been there.", "de": "Sie wären nicht in das Haus gekommen, wenn der König dort gewesen wäre.",
        "fr": "Ils ne seraient pas venus à la maison si le roi avait été là.", "it": "Non sarebbero venuti alla casa se il re fosse stato là.",
        "es": "No habrían venido a la casa si el rey hubiera estado allí.", "nl": "Zij zouden niet naar het huis zijn gekomen als de koning daar was geweest.",
        "la": "Non venissent ad domum si rex ibi fuisset, quod omnes sciebant.",
    }
    assert [j[0] for j in found.judge(list(held.values()))] == list(held)
    assert [j[0] for j in found.judge(["1845 | 33 | 9", "ΑΒΓΔ Κ", "a"])] == [None, None, None]


def test_passages(spark):
    mixed = "They would not have come to the house if the king had been there. Sie wären nicht in das Haus gekommen, wenn der König dort gewesen wäre."
    rows = [(1, mixed, "k"), (2, None, "k"), (3, "", "k"), (4, " \n ", "k"), (5, (mixed + " ") * 200, "k"), (1, mixed, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, passage_lang string")
    out = langid.passages(df, "text", seeds_only()).collect()
    assert [r["passage_lang"] for r in out if r["doc_id"] == 1] == ["en", "de"] * 2
    assert all(r["passage_lang"] is None and r["passage_confidence"] == 0 for r in out if r["doc_id"] in (2, 3, 4))
    assert sum(r["doc_id"] == 5 for r in out) == 400
    assert langid.passages(df.limit(0), "text", seeds_only()).count() == 0


def test_wrong_labels_do_not_spoil_the_models():
    english = [langid.SEEDS["en"][s:e] for s, e in langid.sentences(langid.SEEDS["en"])]
    found = langid.fit([("it", " ".join(english))] * 20 + [("en", " ".join(english))] * 20)
    assert found.judge(["There are several churches with high towers and a market."])[0][0] == "en"


def test_confidence_is_how_often_held_out_text_is_right():
    import random

    import numpy as np

    draw = random.Random(3)
    texts = {lang: [langid.plain_text(seed[s:e]) for s, e in langid.sentences(seed)] for lang, seed in langid.SEEDS.items()}
    found = langid.fit([(lang, " ".join(ts)) for lang, ts in texts.items()] * 5)
    assert found.slope > 0
    rows = [(lang, t[k : k + n]) for lang, ts in texts.items() for t in ts for n in (4, 6, 9) for k in [draw.randrange(max(1, len(t) - n))]]
    judged = found.judge([t for _, t in rows])
    said = np.array([c for _, c, _ in judged])
    assert ((0 <= said) & (said <= 1)).all()
    order = np.argsort(said)
    entropy, _ = found.models.entropies([langid.plain_text(t) or " " for _, t in rows])
    right = np.array([found.languages[i] == lang for i, (lang, _) in zip(entropy.argmin(axis=1), rows)])
    assert right[order[len(order) // 2 :]].mean() >= right[order[: len(order) // 2]].mean()


def test_logistic_recovers_a_known_curve():
    import numpy as np

    draw = np.random.default_rng(1)
    x = draw.uniform(0, 10, 20_000)
    right = (draw.uniform(size=len(x)) < 1 / (1 + np.exp(-(0.8 * x - 2)))).astype(float)
    a, b = langid.logistic(x, right)
    assert abs(a - 0.8) < 0.05 and abs(b + 2) < 0.15
