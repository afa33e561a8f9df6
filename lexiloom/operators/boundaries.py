"""Articles out of the pages of volumes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.types import rows
from lexiloom.kernel import boundaries
from lexiloom.operators.ordered import running_sum


@F.pandas_udf(rows("piece:int, title:string, text:string"))
def _pieces(texts: pd.Series) -> pd.Series:
    out = []
    for text in texts:
        text = boundaries.bold_marked(text or "")
        cuts = boundaries.title_blocks(text)
        ends = [at for at, _ in cuts] + [len(text)]
        pieces = [{"piece": 0, "title": None, "text": text[: ends[0]]}]
        pieces += [{"piece": i + 1, "title": boundaries.headword(t), "text": text[at : ends[i + 1]]} for i, (at, t) in enumerate(cuts)]
        out.append(pieces)
    return pd.Series(out, dtype=object)


def walk_volumes(pages: DataFrame) -> DataFrame:
    """``volume, article_no, title, page_start, page_end, body, segments`` from ``pages(page_id, volume, page_number, text)``.

    Every page is cut at its title blocks where it is read.  What stands before the first one of a
    page goes on with the article of the pages before; before the first of a volume it is no
    article's.  Articles are numbered by a running sum over blocks of pages, of which only the
    counts are moved, and a text is shuffled to its article once.  Pages of equal number follow each
    other by id; null and empty texts have no piece.  ``segments`` are ``(page_id, page_number,
    body_offset)``, offsets counted in code points.
    """
    cut = pages.where("volume IS NOT NULL AND page_number IS NOT NULL AND page_id IS NOT NULL").withColumn("pieces", _pieces("text"))
    counted = cut.select("page_id", "volume", "page_number", (F.size("pieces") - 1).cast("bigint").alias("n"))
    before = running_sum(counted, ["volume"], ["page_number", "page_id"], "n", "before").select("page_id", "before")
    pieces = cut.join(before, "page_id").select("page_id", "volume", "page_number", "before", F.explode("pieces").alias("p"))
    pieces = pieces.select("volume", (F.col("before") + F.col("p.piece")).alias("article_no"), F.struct("page_number", "page_id", F.col("p.piece").alias("piece"), F.col("p.title").alias("title"), F.trim("p.text", F.lit(" \t\r\n")).alias("text")).alias("s"))
    pieces = pieces.where("article_no > 0 AND (s.text <> '' OR s.title IS NOT NULL)")
    whole = pieces.groupBy("volume", "article_no").agg(F.array_sort(F.collect_list("s")).alias("s"))
    offsets = F.transform("s", lambda x, i: F.struct(x["page_id"], x["page_number"], F.aggregate(F.slice("s", 1, i), F.lit(0), lambda at, y: at + F.length(y["text"]) + 1).alias("body_offset")))
    return whole.select(
        "volume", "article_no", F.col("s")[0]["title"].alias("title"), F.array_min("s.page_number").alias("page_start"), F.array_max("s.page_number").alias("page_end"), F.array_join("s.text", "\n").alias("body"), offsets.alias("segments")
    )
