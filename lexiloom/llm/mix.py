"""Problem 8: mixing sources to target weights by Poisson replication.

Each document draws its number of repetitions from a Poisson distribution by inverting it at a
hash-seeded uniform number: it is repeated as often as the chance of at least so many events is not
below that number, at most ``max_repeats`` times.  The number rises with the rate, so the rate of a
source is found that brings its tokens to the source's goal: every round sums the tokens at a row of
rates between the two that the round before left.  Nothing is written for the copies until the rate
is known; then each document is exploded by its own number, and all are shuffled once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.bpe import Automaton, encode_column
from lexiloom.session import cut_lineage

#: Rows of the target table; it is read to the driver, so it is checked.
MOST_SOURCES = 100_000


def goals(sizes: dict[str, int], shares: dict[str, float], repeats: dict[str, int]) -> dict[str, float]:
    """Tokens that each source should give so that all together are as large as the sources are.

    A source that cannot reach its share gives all that its repeats allow; what is missing goes to
    the others in proportion to their shares, as far as they can.
    """
    total = float(sum(sizes.values()))
    most = {s: float(n * repeats.get(s, 0)) for s, n in sizes.items()}
    given = {s: 0.0 for s in sizes}
    open_, left = {s for s in sizes if shares.get(s, 0) > 0 and most[s] > 0}, total
    while open_ and left > 1e-9:
        weight = sum(shares[s] for s in open_)
        short = {s for s in open_ if most[s] <= left * shares[s] / weight}
        if not short:
            given |= {s: left * shares[s] / weight for s in open_}
            break
        for s in short:
            given[s] = most[s]
        left -= sum(most[s] for s in short)
        open_ -= short
    return given


def chances(rate: float, most: int) -> np.ndarray:
    """P(at least ``k`` events) for ``k`` from 1 to ``most``; falling, and sums of logarithms, so no rate is too great."""
    k = np.arange(most)
    if rate <= 0 or not most:
        return np.zeros(most)
    logs = k * math.log(rate) - rate - np.concatenate(([0.0], np.cumsum(np.log(np.maximum(k[1:], 1)))))
    return np.minimum.accumulate(np.maximum(1.0 - np.cumsum(np.exp(logs)), 0.0))


def repetitions(rate: float, most: int, chance: np.ndarray) -> np.ndarray:
    """How often documents with these uniform numbers are repeated at the rate."""
    return np.searchsorted(-chances(rate, most), -chance, side="right")


def uniform(seed: int, *columns: str) -> Column:
    """A number in (0, 1) that depends on the seed and the columns only."""
    return (F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def count_tokens(documents: DataFrame, targets: DataFrame, automaton: Automaton, with_text: bool = False) -> tuple[DataFrame, dict[str, tuple[float, int]]]:
    """Columns ``doc_id, source, n_tokens`` (and ``text``) of the documents of listed sources, and the target table.

    Copies of a target row count once.  A null share is 0, a null ``max_repeats`` is 1; a null source
    is not listed, and so are the documents without one.
    """
    rows = targets.select("source", "target_share", "max_repeats").where(F.col("source").isNotNull()).distinct().limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError("the target table is too long")
    listed = {r["source"]: (float(r["target_share"] or 0), 1 if r["max_repeats"] is None else int(r["max_repeats"])) for r in rows}
    wanted = F.broadcast(targets.select("source").where(F.col("source").isNotNull()).distinct())
    rows = documents.select("doc_id", "source", "text").join(wanted, "source", "left_semi")
    if with_text:
        rows = rows.withColumn("__encoded", F.col("text"))
    return cut_lineage(encode_column(rows, "__encoded" if with_text else "text", automaton, "n_tokens", counts_only=True)), listed


def _rates(drawn: DataFrame, goal: dict[str, float], caps: dict[str, int], rounds: int = 7, points: int = 20) -> dict[str, float]:
    """For each source the rate at which the tokens of its copies come nearest to the goal.

    Every round sums the tokens at ``points`` rates between the two that the round before left; the
    driver sees ``points`` numbers for each source.  What is left in the end is narrower than a double
    can divide much further, and of its two ends the nearer one is taken.
    """
    # at this rate every document has all its repetitions
    ends = {s: (0.0, caps[s] + 40.0 + 10 * math.sqrt(caps[s])) for s in goal}
    tokens = {s: (0.0, math.inf) for s in goal}
    for _ in range(rounds):
        grid = {s: np.linspace(low, high, points + 1)[1:] for s, (low, high) in ends.items()}

        def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = {s: np.zeros(points) for s in grid}  # noqa: B023 (run before the next round)
            for f in frames:
                for source, rows in f.groupby("source"):
                    n, chance = rows["n_tokens"].to_numpy(), rows["chance"].to_numpy()
                    total[source] += [float(n @ repetitions(r, caps[source], chance)) for r in grid[source]]  # noqa: B023
            yield pd.DataFrame([(s, i, x) for s, xs in total.items() for i, x in enumerate(xs)], columns=["source", "at", "n"])

        # whole numbers below 2 ** 53 add up exactly in any order
        counted = drawn.select("source", "n_tokens", "chance").mapInPandas(sums, "source string, at int, n double").groupBy("source", "at").agg(F.sum("n").alias("n")).collect()
        found = {s: np.zeros(points) for s in goal}
        for r in counted:
            found[r["source"]][r["at"]] = r["n"]
        for s, (low, _) in ends.items():
            reached = int(np.searchsorted(found[s], goal[s]))
            at = min(reached, points - 1)
            below = (low, tokens[s][0]) if at == 0 else (float(grid[s][at - 1]), float(found[s][at - 1]))
            ends[s], tokens[s] = (below[0], float(grid[s][at])), (below[1], float(found[s][at]))
    return {s: ends[s][1] if abs(tokens[s][1] - goal[s]) <= abs(tokens[s][0] - goal[s]) else ends[s][0] for s in goal}


def mixture(documents: DataFrame, targets: DataFrame, automaton: Automaton, seed: int = 42, with_text: bool = False) -> tuple[DataFrame, list[tuple]]:
    """The documents of the mixture, ``doc_id, source, n_tokens, copies`` (and ``text``), and the shares.

    Shares are tuples ``(source, target_share, max_repeats, source_tokens, goal_tokens)`` for every
    listed source; one without documents has 0 tokens.  Documents of no tokens never repeat.
    """
    counted, listed = count_tokens(documents, targets, automaton, with_text)
    sizes = {s: 0 for s in listed} | {r["source"]: int(r["n"]) for r in counted.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    goal = goals(sizes, {s: x[0] for s, x in listed.items()}, {s: x[1] for s, x in listed.items()})
    shares = [(s, listed[s][0], listed[s][1], sizes[s], goal[s]) for s in sorted(listed)]
    wanted = {s: g for s, g in goal.items() if g > 0}
    caps = {s: listed[s][1] for s in wanted}
    drawn = counted.where((F.col("n_tokens") > 0) & F.col("source").isin(list(wanted) or [""])).withColumn("chance", uniform(seed, "doc_id"))
    rates = _rates(drawn, wanted, caps) if wanted else {}

    @F.pandas_udf("int")
    def copies(source: pd.Series, chance: pd.Series) -> pd.Series:
        out = np.zeros(len(source), dtype="int64")
        for s, rows in chance.groupby(source):
            out[rows.index] = repetitions(rates[s], caps[s], rows.to_numpy())
        return pd.Series(out)

    return drawn.withColumn("copies", copies("source", "chance")).drop("chance").where("copies > 0"), shares


def shuffled(chosen: DataFrame, seed: int = 42) -> DataFrame:
    """Each copy as a row with ``copy_no``, in a global order that a hash of document and copy decides."""
    rows = chosen.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no")).drop("copies")
    return rows.withColumn("shuffle_key", F.xxhash64(F.lit(seed + 1), "doc_id", "copy_no")).orderBy("shuffle_key", "doc_id", "copy_no")
