"""Sections of a document in one language."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.markup import paragraph_blocks


def language_sections(df: DataFrame, id_col: str, text_col: str, identify: Callable[[DataFrame], DataFrame], target: str = "kin_Latn", size: int = 2000, min_confidence: float = 0.80, min_chars: int = 200) -> DataFrame:
    """``<id_col>, text``: each document's blocks in ``target``, joined; null where they have fewer than ``min_chars`` characters together.

    ``identify`` is the language identifier: given rows with a column ``block`` it adds ``lang`` and ``score`` and keeps all other columns.  A document's
    blocks come together again in one row, as its text was before; null ids are left out.
    """
    blocks = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.posexplode_outer(paragraph_blocks(F.col(text_col), size)).alias("pos", "block"))
    said = identify(blocks)
    kept = F.when((F.col("lang") == target) & (F.col("score") >= min_confidence) & F.col("block").isNotNull(), F.struct("pos", "block"))
    joined = said.groupBy("id").agg(F.array_sort(F.collect_list(kept)).alias("b"))
    chars = F.aggregate("b", F.lit(0), lambda a, x: a + F.length(x["block"]))
    return joined.select(F.col("id").alias(id_col), F.when(chars >= min_chars, F.array_join(F.transform("b", lambda x: x["block"]), "\n\n")).alias("text"))
