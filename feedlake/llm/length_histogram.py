"""Token counts: an exact histogram of encoded lengths that answers totals for every context limit.

Documents are encoded by the ranks of a tokenizer file. Each task counts lengths before anything is
shuffled, so that the shuffle carries one row per task and distinct length. Suffix sums over the histogram are
made in two levels, ranges of lengths and lengths within a range, so that no task orders all lengths.

Null and empty texts have length 0. Repeated rows count as often as they occur. An empty table gives an empty
histogram. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm import arrow
from feedlake.llm.byte_bpe import PATTERN, read_ranks
from feedlake.llm.tables import written

#: Lengths per range of the two-level sums.
RANGE = 256


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


def histogram(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """(length, n_docs): the number of documents of each encoded length; a written table, as limits are read off it twice."""

    ddl = "length long, n_docs long"
    schema = arrow.arrow_schema(ddl)

    def count(batches):
        encode = _encoding(ranks_path).encode_ordinary
        counts: Counter[int] = Counter()
        for part in arrow.slices(batches, text):
            counts.update(len(encode(value.decode())) for value in arrow.texts(part, text))
        yield pa.RecordBatch.from_pydict({"length": list(counts), "n_docs": list(counts.values())}, schema=schema)

    counted = arrow.mapped(docs.select(text), count, ddl)
    return written(counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs")), "lengths")


def limits(hist: DataFrame) -> DataFrame:
    """For every length as a context limit, exact totals over all documents.

    length: the limit; n_docs: documents of just that length; docs_fitting, tokens_fitting: those not longer;
    docs_longer, tokens_longer: those longer; truncated_tokens: tokens left when all are cut to the limit;
    rank_from, rank_to: the documents' ranks from 0, the end excluded, in the order of length, for quantiles.
    """
    counted = hist.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.floor(F.col("length") / RANGE))
    blocks = counted.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("n_tokens").alias("block_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        *[F.coalesce(F.sum(f"block_{x}").over(later), F.lit(0)).alias(f"later_{x}") for x in ("docs", "tokens")],
        *[F.coalesce(F.sum(f"block_{x}").over(earlier), F.lit(0)).alias(f"earlier_{x}") for x in ("docs", "tokens")],
    )
    longer = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)

    def over(window, own: str, base: str) -> Column:
        return F.col(base) + F.coalesce(F.sum(own).over(window), F.lit(0))

    summed = counted.join(blocks, "block").select(
        "length",
        "n_docs",
        over(upto, "n_docs", "earlier_docs").alias("docs_fitting"),
        over(upto, "n_tokens", "earlier_tokens").alias("tokens_fitting"),
        over(longer, "n_docs", "later_docs").alias("docs_longer"),
        over(longer, "n_tokens", "later_tokens").alias("tokens_longer"),
    )
    return summed.select(
        "*",
        (F.col("tokens_fitting") + F.col("length") * F.col("docs_longer")).alias("truncated_tokens"),
        (F.col("docs_fitting") - F.col("n_docs")).alias("rank_from"),
        F.col("docs_fitting").alias("rank_to"),
    )


def quantile(limited: DataFrame, share: float) -> DataFrame:
    """(length): the smallest length that at least `share` of the documents do not exceed; no row without documents."""
    total = F.col("docs_fitting") + F.col("docs_longer")
    return limited.where(F.col("docs_fitting") >= F.ceil(F.lit(share) * total)).agg(F.min("length").alias("length")).where("length is not null")
