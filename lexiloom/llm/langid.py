"""Problem 9: the language of documents and passages.

For each language an interpolated Kneser-Ney model of characters is trained.  All models share one
sorted array of n-gram hashes for each order; beside every n-gram stand its final interpolated
log-probabilities in all languages, and beside every context the weights of backing off.  A sentence
goes to the language of the lowest cross-entropy for each character.  It is rejected where that
entropy is higher than what the model saw of held-out text of its own language, or where the second
language is too near.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANGUAGES = ("en", "de", "fr", "it", "es", "nl", "la")
#: Codes and names that labels use for the languages, compared without case, region and accents.
NAMES = {
    "en": "en eng english anglais englisch ingles inglese engels anglica",
    "de": "de deu ger german deutsch allemand aleman tedesco duits germanica",
    "fr": "fr fra fre french francais franzosisch frances francese frans gallica",
    "it": "it ita italian italiano italien italienisch italiaans italica",
    "es": "es spa spanish espanol castellano espagnol spanisch spagnolo spaans hispanica",
    "nl": "nl nld dut dutch nederlands neerlandais niederlandisch holandes olandese batava",
    "la": "la lat latin latina lateinisch latino latijn",
}
_BY_NAME = {name: code for code, names in NAMES.items() for name in names.split()}
#: Text in every language that the models see besides the sample, so that a rare language is known too.
SEEDS = {
    "en": "The house was built by the people of the town in the last century and it is still used. They were not able to find any of the old papers, which had been lost when the river rose. It is said that he wrote many letters to his brother, but only a few have been kept. There are several churches with high towers and a market that is held every week. Most of the land is used for growing corn, and the rest is covered with woods. After the war the king gave the castle to his son, who lived there until his death. What they found was of little value, although some have thought otherwise. The road from the north is good and leads through a wide valley.",
    "de": "Das Haus wurde im letzten Jahrhundert von den Leuten der Stadt gebaut und wird noch immer benutzt. Sie konnten keine der alten Papiere finden, die verloren gingen, als der Fluss stieg. Man sagt, dass er seinem Bruder viele Briefe schrieb, aber nur wenige sind erhalten. Es gibt mehrere Kirchen mit hohen Türmen und einen Markt, der jede Woche gehalten wird. Das meiste Land dient dem Anbau von Getreide, der Rest ist mit Wäldern bedeckt. Nach dem Krieg gab der König das Schloss seinem Sohn, der dort bis zu seinem Tode lebte. Was sie fanden, war von geringem Wert, obgleich einige anders gedacht haben. Die Straße aus dem Norden ist gut und führt durch ein weites Tal.",
    "fr": "La maison fut bâtie par les gens de la ville au siècle dernier et elle sert encore. Ils n'ont pu trouver aucun des vieux papiers, qui s'étaient perdus lorsque la rivière monta. On dit qu'il écrivit beaucoup de lettres à son frère, mais quelques-unes seulement ont été gardées. Il y a plusieurs églises avec de hautes tours et un marché qui se tient chaque semaine. La plus grande partie des terres sert à la culture du blé, et le reste est couvert de bois. Après la guerre le roi donna le château à son fils, qui y vécut jusqu'à sa mort. Ce qu'ils trouvèrent était de peu de valeur, quoique certains aient pensé autrement. La route du nord est bonne et traverse une large vallée.",
    "it": "La casa fu costruita dalla gente della città nel secolo scorso ed è ancora usata. Non poterono trovare nessuna delle vecchie carte, che erano andate perdute quando il fiume crebbe. Si dice che scrisse molte lettere a suo fratello, ma soltanto poche sono state conservate. Vi sono parecchie chiese con alte torri e un mercato che si tiene ogni settimana. La maggior parte della terra serve alla coltura del grano, e il resto è coperto di boschi. Dopo la guerra il re diede il castello a suo figlio, che vi abitò fino alla morte. Quello che trovarono era di poco valore, benché alcuni abbiano pensato altrimenti. La via dal nord è buona e passa per una larga valle.",
    "es": "La casa fue construida por la gente de la ciudad en el siglo pasado y todavía se usa. No pudieron encontrar ninguno de los viejos papeles, que se habían perdido cuando creció el río. Se dice que escribió muchas cartas a su hermano, pero sólo unas pocas se han guardado. Hay varias iglesias con altas torres y un mercado que se celebra cada semana. La mayor parte de la tierra sirve para el cultivo del trigo, y lo demás está cubierto de bosques. Después de la guerra el rey dio el castillo a su hijo, que vivió allí hasta su muerte. Lo que hallaron era de poco valor, aunque algunos han pensado de otro modo. El camino del norte es bueno y pasa por un ancho valle.",
    "nl": "Het huis werd in de vorige eeuw door de mensen van de stad gebouwd en wordt nog altijd gebruikt. Zij konden geen van de oude papieren vinden, die verloren waren gegaan toen de rivier steeg. Men zegt dat hij zijn broer veel brieven schreef, maar slechts enkele zijn bewaard. Er zijn verscheidene kerken met hoge torens en een markt die elke week gehouden wordt. Het meeste land dient voor het verbouwen van koren, en de rest is met bossen bedekt. Na de oorlog gaf de koning het kasteel aan zijn zoon, die daar tot zijn dood leefde. Wat zij vonden was van weinig waarde, hoewel sommigen anders gedacht hebben. De weg uit het noorden is goed en loopt door een breed dal.",
    "la": "Domus saeculo superiore ab hominibus oppidi aedificata est et adhuc in usu est. Veteres chartas, quae flumine crescente perierant, invenire non potuerunt. Dicitur multas epistulas ad fratrem scripsisse, sed paucae tantum servatae sunt. Sunt ibi plures ecclesiae cum altis turribus et forum quod singulis hebdomadibus habetur. Maxima pars agri frumento colitur, reliqua silvis tecta est. Post bellum rex castellum filio suo dedit, qui ibi usque ad mortem vixit. Quae invenerunt parvi pretii erant, quamquam alii aliter senserunt. Via a septentrionibus bona est et per vallem latam ducit.",
}
ORDER = 5
#: A sentence is decided if its language is right with this chance.
LEAST_CONFIDENCE = 0.96
_LETTERS = re.compile(r"[^a-zà-öø-ÿāăąćčďēęěğīłńňōőœřśšťūůűźžßſ']+")


def fold_label(label: str | None) -> str | None:
    """The two-letter code that a label names, whatever its notation; None if it names none of the languages."""
    if not label:
        return None
    plain = "".join(c for c in unicodedata.normalize("NFKD", label.strip().lower()) if not unicodedata.combining(c))
    return _BY_NAME.get(plain) or _BY_NAME.get(re.split(r"[-_\s(]", plain)[0])


def label_column(label: Column) -> Column:
    """``fold_label`` as a column expression."""
    plain = F.translate(F.lower(F.trim(label)), "áàâäãçéèêëíìîïñóòôöõúùûü", "aaaaaceeeeiiiinooooouuuu")
    known = F.create_map(*[F.lit(x) for pair in _BY_NAME.items() for x in pair])
    return F.coalesce(F.try_element_at(known, plain), F.try_element_at(known, F.regexp_extract(plain, r"^[^-_\s(]*", 0)))


def plain_text(text: str) -> str:
    """Letters in lower case with single spaces; everything else is a space."""
    return " " + _LETTERS.sub(" ", text.lower()).strip() + " "


# A sentence ends at a stop and white space before what may begin one, unless a short word or initial
# is abbreviated there; a line end after a stop, or a blank line, ends it too.
_NEXT = r"\s+(?=[\"“„«(\[†*\dA-ZÀ-ÖØ-Þ])"
_CLOSE = r"[\"”“»)\]’]"
# one look at the sign before spares four at most places
_ENDS = re.compile(rf"(?<=[.!?\"”“»)\]’])(?:(?<=[^\W\d_]{{3}}[.!?]){_CLOSE}*{_NEXT}|(?<={_CLOSE}[.!?]){_CLOSE}*{_NEXT}|(?<=[.!?]{_CLOSE}){_NEXT}|(?<=\d[.!?])\s+(?=[A-ZÀ-ÖØ-Þ«„“\"]))|\s*\n\s*")


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences, without white space around them; lines of their own count as sentences."""
    out, start = [], 0
    for m in [*_ENDS.finditer(text), None]:
        end = m.start() if m else len(text)
        piece = text[start:end]
        left = len(piece) - len(piece.lstrip())
        if piece.strip():
            out.append((start + left, start + left + len(piece.strip())))
        start = m.end() if m else end
    return out


def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order the hashes of the n-grams that end at each position (shorter ones come out with zeros before them)."""
    out, current = [], np.zeros(len(codes), dtype=np.uint64)
    with np.errstate(over="ignore"):
        weight = np.uint64(1)
        for n in range(order):
            shifted = np.concatenate((np.zeros(n, dtype=np.uint64), codes[: len(codes) - n])) if n else codes
            current = current + (shifted + np.uint64(1)) * weight
            weight = weight * np.uint64(0x9E3779B97F4A7C15)
            out.append(current ^ (current >> np.uint64(31)))
    return out


@dataclass
class Models:
    """The shared sorted hash arrays and what stands beside them."""

    grams: list[np.ndarray]  # for each order, sorted
    logs: list[np.ndarray]  # n-gram x language: log-probability of the last character after the others
    contexts: list[np.ndarray]  # for each order above the first, sorted hashes of the n-1 characters before
    backs: list[np.ndarray]  # context x language: log of the weight of backing off
    floor: float
    highest: np.ndarray  # language: the entropy above which text is not its own

    @property
    def order(self) -> int:
        return len(self.grams)

    def entropy(self, text: str) -> tuple[np.ndarray, int]:
        """Cross-entropy of the plain text in nats for each character in every language, and its length."""
        totals, sizes = self.entropies([text])
        return totals[0], int(sizes[0])

    def entropies(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The entropies of many texts at once; none of them may be empty."""
        gap = "\x00" * (self.order - 1)
        sizes = np.array([len(t) for t in texts])
        joined = "".join(gap + t for t in texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        hashes = _hashes(codes, self.order)
        real = np.nonzero(codes)[0]
        score = np.zeros((len(real), self.logs[0].shape[1]), dtype=np.float32)
        open_ = np.arange(len(real))
        for n in range(self.order - 1, -1, -1):
            wanted = hashes[n][real[open_]]
            at = np.minimum(np.searchsorted(self.grams[n], wanted), len(self.grams[n]) - 1)
            hit = self.grams[n][at] == wanted
            score[open_[hit]] += self.logs[n][at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
            if n:
                before = hashes[n - 1][real[open_] - 1]
                at = np.minimum(np.searchsorted(self.contexts[n], before), len(self.contexts[n]) - 1)
                known = self.contexts[n][at] == before
                score[open_[known]] += self.backs[n][at[known]]
        score[open_] += self.floor
        totals = np.add.reduceat(score, np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0, dtype=np.float64)
        return -totals / np.maximum(sizes, 1)[:, None], sizes


def train(corpora: Sequence[Sequence[str]], order: int = ORDER, discount: float = 0.75) -> Models:
    """Interpolated Kneser-Ney models, one for each list of plain texts."""
    langs = len(corpora)
    gap = "\x00" * (order - 1)
    grams, counts, ctx_hash, ctx_of, followers = [], [], [], [], []
    per_lang = []
    for texts in corpora:
        joined = "".join(gap + t for t in texts) or gap + " "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        hashes, real = _hashes(codes, order), np.nonzero(codes)[0]
        per_lang.append((hashes, real))
    for n in range(order):
        union, inverse = np.unique(np.concatenate([h[n][r] for h, r in per_lang]), return_inverse=True)
        table = np.zeros((len(union), langs), dtype=np.float64)
        context = np.zeros(len(union), dtype=np.uint64)  # hash of the n characters before
        shorter = np.zeros(len(union), dtype=np.uint64)  # hash of the n-gram without its first character
        at = 0
        for lang, (h, r) in enumerate(per_lang):
            index = inverse[at : at + len(r)]
            at += len(r)
            table[:, lang] = np.bincount(index, minlength=len(union))
            if n:
                context[index] = h[n - 1][r - 1]
                shorter[index] = h[n - 1][r]
        grams.append(union)
        counts.append(table)
        ctx_hash.append(context)
        ctx_of.append(shorter)
    # below the highest order an n-gram counts as often as different characters precede it
    use = [None] * order
    use[order - 1] = counts[order - 1]
    for n in range(order - 1):
        cont = np.zeros_like(counts[n])
        index = np.searchsorted(grams[n], ctx_of[n + 1])
        for lang in range(langs):
            cont[:, lang] = np.bincount(index[counts[n + 1][:, lang] > 0], minlength=len(cont))
        use[n] = cont
    probs, contexts, backs = [], [np.zeros(0, dtype=np.uint64)], [np.zeros((0, langs), dtype=np.float32)]
    kinds = max(60, len(grams[0]))
    total = use[0].sum(axis=0)
    seen = (use[0] > 0).sum(axis=0)
    base = (np.maximum(use[0] - discount, 0) + discount * seen / kinds) / np.maximum(total, 1)
    probs.append(np.maximum(base, 1e-9))
    for n in range(1, order):
        context, where = np.unique(ctx_hash[n], return_inverse=True)
        total = np.zeros((len(context), langs))
        kind = np.zeros((len(context), langs))
        for lang in range(langs):
            total[:, lang] = np.bincount(where, weights=use[n][:, lang], minlength=len(context))
            kind[:, lang] = np.bincount(where[use[n][:, lang] > 0], minlength=len(context))
        back = np.where(total > 0, discount * kind / np.maximum(total, 1), 1.0)
        lower = probs[n - 1][np.searchsorted(grams[n - 1], ctx_of[n])]
        own = np.where(total[where] > 0, np.maximum(use[n] - discount, 0) / np.maximum(total[where], 1), 0)
        probs.append(own + back[where] * lower)
        contexts.append(context)
        backs.append(np.log(back).astype(np.float32))
    logs = [np.log(p).astype(np.float32) for p in probs]
    return Models(grams, logs, contexts, backs, float(np.log(discount / kinds / 100)), np.full(langs, 9.0))


def logistic(x: np.ndarray, right: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic function that tells ``right`` from ``x`` best, a little drawn to the first guess where there is little to learn from."""
    a, b = 0.6, -0.4
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        w = p * (1 - p)
        gradient = np.array([((right - p) * x).sum() - (a - 0.6), (right - p).sum() - (b + 0.4)])
        curve = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        step = np.linalg.solve(curve, gradient)
        a, b = a + float(np.clip(step[0], -0.2, 0.2)), b + float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 0.01), b


@dataclass
class Identifier:
    """Trained models with the confidence below which a sentence is not decided."""

    models: Models
    languages: tuple[str, ...]
    least_letters: int = 12
    slope: float = 0.6  # confidence is the logistic function of ``slope * margin + offset``, fitted on held-out text
    offset: float = -0.4
    least_confidence: float = LEAST_CONFIDENCE

    def judge(self, texts: Sequence[str]) -> list[tuple[str | None, float, float]]:
        """For each raw sentence its language (None if rejected), a confidence and the margin in nats."""
        plain = [plain_text(t) for t in texts]
        if not plain:
            return []
        entropy, sizes = self.models.entropies(plain)
        order = np.argsort(entropy, axis=1)
        rows = np.arange(len(plain))
        best, second = order[:, 0], order[:, 1]
        margin = (entropy[rows, second] - entropy[rows, best]) * sizes
        fits = entropy[rows, best] <= self.models.highest[best]
        letters = sizes - np.array([t.count(" ") for t in plain])
        confidence = np.where(fits & (letters > 0), 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50))), 0.0)
        sure = fits & (letters >= self.least_letters) & (confidence >= self.least_confidence)
        return [(self.languages[b] if s else None, c, m) for b, s, c, m in zip(best.tolist(), sure.tolist(), confidence.tolist(), margin.tolist())]

    def passages(self, text: str | None) -> list[tuple[int, int, str | None, float, int]]:
        """Spans ``(start, end, language, confidence, sentences)``; neighbours of one language are one passage.

        A sentence that cannot be decided joins the passage before it, or the first one after it; if
        none is decided the text is one passage of no language.
        """
        return self.passages_of([text])[0]

    def passages_of(self, texts: Sequence[str | None]) -> list[list[tuple[int, int, str | None, float, int]]]:
        """``passages`` of many texts, judged together."""
        spans = [sentences(t) if t else [] for t in texts]
        judged = iter(self.judge([t[s:e] for t, ss in zip(texts, spans) for s, e in ss]))
        out = []
        for ss in spans:
            rows: list[list] = []
            for start, end in ss:
                lang, confidence, _ = next(judged)
                if rows and (lang is None or rows[-1][2] in (None, lang)):
                    last = rows[-1]
                    if last[2] is None and lang is not None:
                        last[2], last[3], last[4] = lang, 0.0, 0
                    last[1] = end
                    if lang is not None:
                        last[3] += confidence
                        last[4] += 1
                else:
                    rows.append([start, end, lang, confidence if lang else 0.0, int(lang is not None)])
            out.append([(s, e, lang, c / n if n else 0.0, n) for s, e, lang, c, n in rows])
        return out


def fit(labelled: Sequence[tuple[str, str]], languages: Sequence[str] = LANGUAGES, order: int = ORDER, rounds: int = 2) -> Identifier:
    """Train on pairs of label and text, some of whose labels may be wrong and some texts mixed.

    The models of one round choose the sentences of the next: a sentence stays only if it is judged
    to be of its label.  The first round knows the seeds alone, as models that had seen a wrongly
    labelled sentence would take it for one of theirs.  A fifth of the sentences is held out at the end; the entropy that 99.9 % of
    them do not exceed, and a half more, is where text is rejected.
    """
    pieces = [[t[s:e] for label, t in labelled if label == lang for s, e in sentences(t)] for lang in languages]
    pieces = [[p for p in ps if len(plain_text(p)) > 20] for ps in pieces]
    seeds = [[SEEDS[lang][s:e] for s, e in sentences(SEEDS[lang])] for lang in languages]
    kept: list[list[str]] = [[] for _ in languages]
    for _ in range(rounds):
        found = Identifier(train([[plain_text(p) for p in [*a, *b]] for a, b in zip(kept, seeds)], order), tuple(languages))
        kept = [[p for p, j in zip(ps, found.judge(ps)) if j[0] == lang] for ps, lang in zip(pieces, languages)]
    held = [ps[::5] for ps in kept]
    used = [[p for i, p in enumerate(ps) if i % 5] for ps in kept]
    trial = train([[plain_text(p) for p in [*a, *b]] for a, b in zip(used, seeds)], order)
    final = train([[plain_text(p) for p in [*a, *b]] for a, b in zip(kept, seeds)], order)
    for at, ps in enumerate(held):
        if len(ps) >= 5:
            own = trial.entropies([plain_text(p) for p in ps])[0][:, at]
            final.highest[at] = float(np.quantile(own, 0.999)) * 1.5
        else:
            final.highest[at] = 3.2
    slope, offset = calibrated(trial, held)
    return Identifier(final, tuple(languages), slope=slope, offset=offset)


def calibrated(trial: Models, held: Sequence[Sequence[str]]) -> tuple[float, float]:
    """Slope and offset of the confidence: how often the nearest language of held-out text is right, by the margin to the second.

    Whole sentences are nearly always right, so beginnings of 4 to 32 letters are judged too.
    """
    margins, right = [], []
    for at, ps in enumerate(held):
        parts = [t[:n] for p in ps for t in [plain_text(p)] for n in (4, 8, 16, 32, len(t)) if t[:n].strip()]
        if parts:
            entropy, sizes = trial.entropies(parts)
            best = np.sort(entropy, axis=1)
            margins.append((best[:, 1] - best[:, 0]) * sizes)
            right.append(entropy.argmin(axis=1) == at)
    if not margins:
        return 0.6, -0.4
    return logistic(np.concatenate(margins), np.concatenate(right).astype(float))


def training_sample(documents: DataFrame, per_language: int = 300, most_chars: int = 8_000) -> list[tuple[str, str]]:
    """A bounded sample of labelled documents for the driver: at most ``per_language`` texts of at most ``most_chars``.

    The texts with the least hashes are taken; longer ones are not cut but left to others.
    """
    known = documents.select(label_column(F.col("lang")).alias("label"), "text", F.xxhash64("doc_id").alias("at")).where(F.col("label").isNotNull() & F.length("text").between(40, most_chars))
    first = Window.partitionBy("label").orderBy("at", "text")
    rows = known.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_language)
    return [(r["label"], r["text"]) for r in rows.select("label", "text", "at").orderBy("label", "at", "text").collect()]


def passages(df: DataFrame, text: str, identifier: Identifier) -> DataFrame:
    """A row for each passage of a text, after the other columns of ``df``.

    Adds ``passage_no``, ``passage_start``, ``passage_end`` (code points), ``passage_lang``,
    ``passage_confidence`` and ``passage_sentences``, replacing columns of these names.  A null, empty
    or blank text gives one row with a null language, confidence 0 and no span.  The models have a
    fixed bound (the sample's size), so they can be broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(identifier)
    kind = "array<struct<passage_no:int,passage_start:int,passage_end:int,passage_lang:string,passage_confidence:double,passage_sentences:int>>"
    names = ["passage_no", "passage_start", "passage_end", "passage_lang", "passage_confidence", "passage_sentences"]

    @F.pandas_udf(kind)
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            out, values = [], list(series)
            for at in range(0, len(values), 200):
                for rows in shared.value.passages_of(values[at : at + 200]):
                    rows = rows or [(None, None, None, 0.0, 0)]
                    out.append([dict(zip(names, (n, *row))) for n, row in enumerate(rows, 1)])
            yield pd.Series(out, dtype=object)

    kept = [c for c in df.columns if c != text and c not in names]
    return df.select(*kept, F.explode(judge(F.col(text))).alias("__p")).select(*kept, "__p.*")
