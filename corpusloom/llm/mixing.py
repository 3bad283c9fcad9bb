"""Mixing sources to target shares of tokens (problem 8).

Iterative proportional fitting rakes the token weight of every (source, language, topic) cell to the target of its source and to the
corpus' own language and topic shares, the source targets last so that they hold exactly.  A cell's weight over its tokens is the
expected number of times its documents are used.  The whole part is used outright; the fraction is drawn by sequential Poisson
sampling: documents of a source go in the order of u / p (u a permanent random number from a hash of the id, p the fraction) until
the source's tokens are reached.  That order is cut by a histogram per source first, so only the documents of one narrow bin are
ever ranked, whatever the size of a source.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokens import LANG_CODES, Tokenizer, lang_label, source_label, token_counts

#: Bins of the draw per source; one bin holds about this part of a source.
BINS = 4096


def rake(cells: pd.DataFrame, shares: dict[str, float], repeats: dict[str, int], total: float | None = None, rounds: int = 200, tol: float = 1e-9) -> tuple[pd.DataFrame, float]:
    """Fit cell weights; ``cells`` has ``source, lang, topic, tokens`` (a few hundred rows).

    Returns the cells with ``uses`` (expected uses of a document, at most ``repeats``) and the total size.  Targets of sources without
    tokens are dealt to the others in proportion.  Without ``total`` the mix is as large as the shares and repeats allow.
    """
    c = cells[(cells["tokens"] > 0) & cells["source"].isin([s for s, v in shares.items() if v > 0 and repeats.get(s, 1) > 0])].copy()
    if c.empty:
        return c.assign(uses=pd.Series(dtype=float)), 0.0
    have = c.groupby("source")["tokens"].sum()
    share = pd.Series({s: shares[s] for s in have.index})
    share = share / share.sum()
    cap = pd.Series({s: float(max(0, repeats.get(s, 1))) for s in have.index})
    most = float((have * cap / share).min())
    size = most if total is None else min(float(total), most)
    target = share * size
    w = c["tokens"].to_numpy(float) * c["source"].map(target / have).to_numpy()
    upper = c["tokens"].to_numpy(float) * c["source"].map(cap).to_numpy()
    marg = {k: c.groupby(k)["tokens"].sum() / c["tokens"].sum() * size for k in ("lang", "topic")}
    codes = {k: pd.factorize(c[k]) for k in ("source", "lang", "topic")}
    goal = {"source": target.reindex(codes["source"][1]).to_numpy(), **{k: marg[k].reindex(codes[k][1]).to_numpy() for k in ("lang", "topic")}}
    for _ in range(rounds):
        before = w.copy()
        for k in ("lang", "topic", "source"):
            code, names = codes[k]
            for _ in range(50 if k == "source" else 1):  # cells at their cap keep it, the others of the margin take the rest
                free = w < upper * (1 - 1e-12)
                now = np.bincount(code, w, len(names))
                movable = np.bincount(code, w * free, len(names))
                factor = np.where(movable > 0, (goal[k] - (now - movable)) / np.maximum(movable, 1e-300), 1.0)
                shrink = goal[k] < now
                factor = np.where(shrink, goal[k] / np.maximum(now, 1e-300), np.maximum(factor, 0))[code]
                w = np.minimum(np.where(free | shrink[code], w * factor, w), upper)
                if k != "source" or np.allclose(np.bincount(code, w, len(names)), goal[k], rtol=1e-12):
                    break
        if np.max(np.abs(w - before)) <= tol * size:
            break
    return c.assign(uses=w / c["tokens"].to_numpy(float)), size


def sized_documents(docs: DataFrame, topics: DataFrame | None, tokenizer: Tokenizer | None = None) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens``: what the mix needs of a document; ``topics`` has ``doc_id, topic``, one row each.

    Labels of languages that the corpus doesn't name are one (``other``), so the cells of the mix are few whatever labels say.
    """
    n = token_counts(docs.where(F.col("doc_id").isNotNull()), ["doc_id", "source", "lang"], tokenizer=tokenizer)
    n = n.withColumn("topic", F.lit("none")) if topics is None else n.join(topics, "doc_id", "left")
    lang = lang_label(F.col("lang"))
    lang = F.when(lang.isNull(), "none").when(lang.isin(*LANG_CODES.values(), "zxx_Latn"), lang).otherwise("other")
    return n.select("doc_id", source_label(F.col("source")).alias("source"), lang.alias("lang"), F.coalesce("topic", F.lit("none")).alias("topic"), "n_tokens")


def mix(sized: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 0) -> DataFrame:
    """Draw the mix: ``doc_id, source, lang, topic, n_tokens, uses`` for every document that is used at least once.

    ``sized`` (from :func:`sized_documents`, staged or cheap to read: it is read three times) has one row per document; ``targets`` is a
    dimension table ``source, target_share, max_repeats``.  No document is used more than ``max_repeats`` times.  Sources
    without a target and documents without tokens are left out; null repeats count as 1; an empty input gives no rows.  The draw
    depends on the ids and ``seed`` only.
    """
    spark = sized.sparkSession
    goal = targets.where(F.col("source").isNotNull() & (F.col("target_share") > 0)).select(source_label(F.col("source")).alias("source"), "target_share", F.coalesce("max_repeats", F.lit(1)).alias("max_repeats")).collect()
    shares = {r.source: r.target_share for r in goal}
    repeats = {r.source: int(r.max_repeats) for r in goal}
    usable = sized.select("doc_id", "source", "lang", "topic", "n_tokens").where((F.col("n_tokens") > 0) & F.col("source").isin(list(shares)))
    cells = usable.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")).toPandas()
    fitted, _ = rake(cells, shares, repeats, total)
    schema = "source string, lang string, topic string, whole bigint, part double"
    rows = [(r.source, r.lang, r.topic, int(np.floor(r.uses + 1e-9)), float(max(0.0, r.uses - np.floor(r.uses + 1e-9)))) for r in fitted.itertuples()]
    # cells are sources with a target, the known languages and the reference's subjects at most
    cell_uses = F.broadcast(spark.createDataFrame(rows, schema))
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    drawn = usable.join(cell_uses, ["source", "lang", "topic"]).withColumn("rank", u / F.greatest("part", F.lit(1e-12)))
    # u / p > 1 beyond a document's own probability; the scale to bins is monotone and keeps every document
    drawn = drawn.withColumn("bin", F.when(F.col("part") <= 0, F.lit(2 * BINS)).otherwise(F.floor(2 * BINS * F.col("rank") / (1 + F.col("rank")))).cast("int"))
    owed = fitted.assign(extra=(fitted["uses"] - np.floor(fitted["uses"] + 1e-9)).clip(lower=0) * fitted["tokens"]).groupby("source")["extra"].sum().to_dict() if len(fitted) else {}
    hist = drawn.where(F.col("part") > 0).groupBy("source", "bin").agg(F.sum("n_tokens").alias("tokens")).toPandas()
    cut = []
    for source, h in hist.groupby("source"):
        h = h.sort_values("bin")
        cum = h["tokens"].cumsum().to_numpy()
        at = int(np.searchsorted(cum, owed.get(source, 0.0)))
        last = at == len(cum)
        cut.append((source, int(h["bin"].iloc[-1]) + 1 if last else int(h["bin"].iloc[at]), 0.0 if last else float(owed[source] - (cum[at - 1] if at else 0))))
    edges = F.broadcast(spark.createDataFrame(cut, "source string, edge int, room double"))
    drawn = drawn.join(edges, "source", "left")
    inside = drawn.where(F.col("bin") == F.col("edge"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id")
    inside = inside.withColumn("before", F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_tokens"))
    inside = inside.withColumn("extra", (F.col("before") + F.col("n_tokens") / 2 <= F.col("room")).cast("int")).drop("before")
    outside = drawn.where(F.col("edge").isNull() | (F.col("bin") != F.col("edge"))).withColumn("extra", F.coalesce(F.col("bin") < F.col("edge"), F.lit(False)).cast("int"))
    both = outside.unionByName(inside)
    return both.select("doc_id", "source", "lang", "topic", "n_tokens", (F.col("whole") + F.when(F.col("part") > 0, F.col("extra")).otherwise(0)).alias("uses")).where(F.col("uses") > 0)


def shares_reached(mixed: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: the share aimed at, what it has, and what the mix really holds."""
    have = sized.groupBy("source").agg(F.count("*").alias("docs_available"), F.sum("n_tokens").alias("tokens_available"))
    got = mixed.groupBy("source").agg(F.count("*").alias("docs_used"), F.sum("uses").alias("uses"), F.max("uses").alias("most_uses"), F.sum(F.col("uses") * F.col("n_tokens")).alias("tokens"))
    every = got.agg(F.sum("tokens").alias("all_tokens"))
    t = targets.where(F.col("source").isNotNull()).select(source_label(F.col("source")).alias("source"), "target_share", "max_repeats")
    zero = F.lit(0).cast("long")
    return (
        t.join(have, "source", "left").join(got, "source", "left").join(F.broadcast(every))
        .select(
            "source", "target_share", "max_repeats",
            *(F.coalesce(c, zero).alias(c) for c in ("docs_available", "tokens_available", "docs_used", "uses", "most_uses", "tokens")),
            (F.coalesce("tokens", zero) / F.greatest(F.coalesce("all_tokens", zero), F.lit(1))).alias("actual_share"),
        )
    )
