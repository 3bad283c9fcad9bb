"""Stable hashes and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_hash(text: Column) -> Column:
    """SHA-256 of the UTF-8 text in hex."""
    return F.sha2(text, 256)


def joined_hash(*parts: Column) -> Column:
    """SHA-256 of the parts with ``||`` between them; null parts count as empty."""
    return F.sha2(F.concat_ws("||", *(F.coalesce(p, F.lit("")) for p in parts)), 256)


def example_id(source: Column, prompt: Column, response: Column) -> Column:
    return F.substring(joined_hash(source, prompt, response), 1, 16)


def seeded_order(seed: str, key: Column) -> Column:
    """What a deterministic shuffle sorts by."""
    return F.sha2(F.concat(F.lit(seed + ":"), key), 256)


def split_bucket(seed: str, key: Column) -> Column:
    """0..9999 from the first eight hex digits of the seeded hash."""
    return F.conv(F.substring(seeded_order(seed, key), 1, 8), 16, 10).cast("long") % 10000


def split_name(seed: str, key: Column, ratios: tuple[float, float, float] = (0.98, 0.01, 0.01)) -> Column:
    b, first = split_bucket(seed, key), int(ratios[0] * 10000)
    return F.when(b < first, "train").when(b < first + int(ratios[1] * 10000), "val").otherwise("test")
