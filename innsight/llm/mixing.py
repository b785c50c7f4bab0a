"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are words. Each source's target (words that the mix takes of it) comes from its weight; no target is above
``max_passes`` times the source. A source's documents are dealt to blocks by a hash of their id, and blocks have a
random order. Whole passes take every block; the remainder takes blocks in that order until the target is met. Of the
last one documents are taken whole, in the order of a hash, and only the one at which the target is met is cut.

Output shards draw the blocks without replacement. A binary tree over the shards splits the counts of blocks per
source: a node holds exact counts, its left half gets a multivariate-hypergeometric draw of its share of them, the
right half the rest. A leaf's counts, and where they begin in each source's order, follow from the draws on its
path alone, so shards are computed independently and hold disjoint blocks. Within a shard, documents are shuffled.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, ship, stored, word_count


def default_weights(names: Sequence[str | None], cycle: Sequence[float] = (3, 1, 2)) -> dict[str | None, float]:
    """Weights by rank: names in code-point order, null last, take the cycle's values in turn."""
    ordered = sorted((n for n in names if n is not None)) + [None] * (None in names)
    return {n: float(cycle[i % len(cycle)]) for i, n in enumerate(ordered)}


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], share: float = 1.5,
            max_passes: float = 2.0) -> dict[str | None, float]:
    """Words to take per source: ``share`` of all words, by weight; what is above ``max_passes`` times a source is
    shared again by weight among the others until none is above."""
    left, open_, out = share * sum(sizes.values()), dict(weights), {}
    while open_:
        total = sum(open_.values())
        full = [n for n, w in open_.items() if left * w / total > max_passes * sizes[n]]
        if not full:
            out |= {n: left * w / total for n, w in open_.items()}
            break
        for n in full:
            out[n] = max_passes * sizes[n]
            del open_[n]
        left -= sum(out[n] for n in full)
    return out


def leaf_draws(counts: Sequence[int], n_shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, number) per source: the draws of one shard out of ``counts`` blocks per source."""
    counts = np.asarray(counts, dtype=np.int64)
    first = np.zeros_like(counts)
    low, high = 0, n_shards
    while high - low > 1:
        mid = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(counts, int(counts.sum()) * (mid - low) // (high - low),
                                               method="marginals")
        if shard < mid:
            counts, high = left, mid
        else:
            first, counts, low = first + left, counts - left, mid
    return first, counts


def leaf_table(spark: SparkSession, counts: Sequence[int], n_shards: int, seed: int) -> DataFrame:
    """(shard, source_no, first, number): the leaves' draws. They follow from the counts per source, which the driver
    has, and are at most as many as shards times sources; no Python worker is started for them."""
    rows = [(shard, i, a, n) for shard in range(n_shards)
            for i, (a, n) in enumerate(zip(*(x.tolist() for x in leaf_draws(counts, n_shards, shard, seed)))) if n]
    return spark.createDataFrame(rows, "shard long, source_no int, first long, number long")


def _source_totals(sized: DataFrame) -> list[tuple[str | None, int]]:
    """Words per source, one row per source. The mix is configured by source, so the list of sources fits the
    driver as its configuration does."""
    return [(r["source"], r["size"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()]


def _block_no(n_blocks: Column, seed: int) -> Column:
    """The document's block within its source, by a hash of its id as text."""
    return F.pmod(F.xxhash64(F.lit(f"block {seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))),
                  n_blocks)


def _sized_columns(id_col: str, source_col: str, text_col: str, seed: int) -> list[Column]:
    """doc_id, source, size (words) and luck: the place of a document in a block that is taken in part."""
    return [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.lit(f"cut {seed}"), F.col(id_col).cast("string"), F.col(text_col)).alias("luck")]


def plan_mix(docs: DataFrame, share: float = 1.5, max_passes: float = 2.0, cycle: Sequence[float] = (3, 1, 2),
             block_words: int = 1000, blocks_per_source: int = 256, n_shards: int = 64, seed: int = 11,
             id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, n_blocks, block, source_size, target, takes, cut): one row for each block that holds a document.

    ``takes`` lists the block's draws as (shard, whole). A draw that isn't whole takes the block's documents by
    (luck, size) up to ``cut``: (luck, size, alike, copies, words), the document at which the target is met. Of
    ``alike`` documents of that luck and size ``copies`` stay whole and the next keeps ``words`` words. A source has up to ``blocks_per_source`` blocks, fewer where they would hold under ``block_words``
    words, so the plan's size follows the number of sources, not that of documents. A block is a hash bucket;
    its documents are never gathered, and only those of a source's last block are put in order, by their sizes."""
    spark = docs.sparkSession
    sized = stored(docs.select(*_sized_columns(id_col, source_col, text_col, seed)), "sizes")
    totals = dict(_source_totals(sized))
    goals = targets(totals, default_weights(list(totals), cycle), share, max_passes)
    names = sorted((n for n in totals if n is not None)) + [None] * (None in totals)
    config = spark.createDataFrame(
        [(i, n, totals[n], float(goals[n]), max(1, min(blocks_per_source, totals[n] // block_words))) for i, n in enumerate(names)],
        "source_no int, source string, source_size long, target double, n_blocks long")
    # the list of sources, as collected above, is small: one row per source
    dealt = sized.join(F.broadcast(config.withColumnRenamed("source", "name")),
                       F.col("source").eqNullSafe(F.col("name")))
    blocks = (dealt.withColumn("block", _block_no(F.col("n_blocks"), seed))
              .groupBy("source_no", "source", "source_size", "target", "n_blocks", "block")
              .agg(F.sum("size").alias("size")))
    # blocks without words come last and aren't drawn
    order = Window.partitionBy("source_no").orderBy(
        F.col("size") == 0, F.xxhash64(F.lit(f"order {seed}"), "source_no", "block"), "block")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    before = F.col("upto") - F.col("size")
    # words that the last pass takes of the block
    left = F.least(F.col("size").cast("double"), F.greatest(F.lit(0.0), rest - before))
    ranked = stored(
        blocks.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("present", F.count_if(F.col("size") > 0).over(Window.partitionBy("source_no")))
        .withColumn("passes", passes.cast("long")).withColumn("left", left), "blocks")
    # a draw is a pass over a block; a source's draws are numbered pass by pass, in the order of its blocks
    draws = ranked.where("size > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), "passes")).alias("pass")).select(
        "source_no", "block", ((F.col("pass") < F.col("passes")) | (F.col("left") >= F.col("size"))).alias("whole"),
        (F.col("pass") * F.col("present") + F.col("place")).alias("draw"), "left").where("whole or left > 0")
    counts = [0] * len(names)
    for r in draws.groupBy("source_no").agg(F.count("*").alias("n")).collect():  # one row per source
        counts[r["source_no"]] = r["n"]
    leaves = (leaf_table(spark, counts, n_shards, seed)
              .select("shard", "source_no", F.explode(F.expr("sequence(first, first + number - 1)")).alias("draw")))
    drawn = (draws.join(leaves, ["source_no", "draw"]).groupBy("source_no", "block")
             .agg(F.sort_array(F.collect_list(F.struct("shard", "whole"))).alias("takes")))  # at most 3 each
    # a source has one block at most that is taken in part
    parts = ranked.where("left > 0 and left < size").select("source_no", "block", "left")
    upto = F.sum(F.col("size") * F.col("alike")).over(
        Window.partitionBy("source_no").orderBy("luck", "size").rowsBetween(Window.unboundedPreceding, 0))
    over = F.col("left") - (F.col("upto") - F.col("size") * F.col("alike"))
    copies = F.least(F.floor(over / F.col("size")), F.col("alike") - 1)
    cuts = (dealt.withColumn("block", _block_no(F.col("n_blocks"), seed)).where("size > 0")
            .join(F.broadcast(parts), ["source_no", "block"])
            .groupBy("source_no", "block", "left", "luck", "size").agg(F.count("*").alias("alike"))
            .withColumn("upto", upto).withColumn("over", over).where("over > 0 and upto >= left")
            .select("source_no", "block", F.struct(
                "luck", "size", "alike", copies.alias("copies"),
                F.round(F.col("over") - copies * F.col("size")).cast("long").alias("words")).alias("cut")))
    return (ranked.join(drawn, ["source_no", "block"], "left").join(cuts, ["source_no", "block"], "left")
            .select("source", "n_blocks", "block", "source_size", "target",
                    F.coalesce("takes", F.array().cast("array<struct<shard: bigint, whole: boolean>>"))
                    .alias("takes"), "cut"))


def _with_takes(docs: DataFrame, plan: DataFrame, seed: int, id_col: str, source_col: str) -> DataFrame:
    """``docs`` (doc_id, source, size, luck and others) with their block's plan, and ``part``: the words that a
    draw takes which isn't whole."""
    sources = plan.select(F.col("source").alias("name"), "n_blocks").distinct()
    keyed = (docs.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("name")))  # one row per source
             .withColumn("block", _block_no(F.col("n_blocks"), seed)).drop("name", "n_blocks"))
    p = plan.select(F.col("source").alias("plan_source"), F.col("block").alias("plan_block"), "source_size",
                    "target", "takes", "cut")
    dealt = keyed.join(p, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("block") == F.col("plan_block")))
    here, last = F.struct("luck", "size"), F.struct("cut.luck", "cut.size")
    part = F.when(here < last, F.col("size")).when(here == last, F.col("cut.words")).otherwise(0)
    if plan.where("cut.alike > 1").isEmpty():
        return dealt.withColumn("part", part)
    # documents that can't be told apart, where the target is met among them: they are counted off
    tied = F.coalesce((here == last) & (F.col("cut.alike") > 1), F.lit(False))
    nth = F.row_number().over(Window.partitionBy("source").orderBy("luck")) - 1
    counted = (dealt.where(tied).withColumn("nth", nth)
               .withColumn("part", F.when(F.col("nth") < F.col("cut.copies"), F.col("size"))
                           .when(F.col("nth") == F.col("cut.copies"), F.col("cut.words")).otherwise(0))
               .drop("nth"))
    return dealt.where(~tied).withColumn("part", part).unionByName(counted)


def _words(take: Column) -> Column:
    return F.when(take["whole"], F.col("size")).otherwise(F.col("part"))


def mix_report(docs: DataFrame, seed: int = 11, id_col: str = "doc_id", source_col: str = "source",
               text_col: str = "text", **settings) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken, shards.

    Null text has size 0 and is never taken; null is a source like any other; documents with the same id share a
    block. An empty table gives an empty result; columns other than id, source and text are not read."""
    plan = stored(plan_mix(docs, seed=seed, id_col=id_col, source_col=source_col, text_col=text_col, **settings),
                  "mix")
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda n, x: n + _words(x))
    return _with_takes(docs.select(*_sized_columns(id_col, source_col, text_col, seed)), plan, seed, id_col, source_col).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"),
        F.col("takes.shard").alias("shards"))


def cut_text(text: str, n: int) -> str:
    """The text up to the end of its n-th word."""
    end = 0
    for m in itertools.islice(re.finditer(WORD, text), n):
        end = m.end()
    return text[:end]


def mix(docs: DataFrame, seed: int = 11, n_shards: int = 64, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", length_col: str | None = None, **settings) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: a row for each time a document is taken, dealt to output
    partitions by shard and shuffled within. A document taken in part has its text cut after that many words and,
    if ``length_col`` is named, its length there. Documents that the mix doesn't take, and those without words, go."""
    ship(docs.sparkSession)
    plan = stored(plan_mix(docs, seed=seed, n_shards=n_shards, id_col=id_col, source_col=source_col,
                           text_col=text_col, **settings), "mix")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", *_sized_columns(f"row.{id_col}", f"row.{source_col}", f"row.{text_col}", seed))
    taken = (_with_takes(rows, plan, seed, id_col, source_col)
             .select("row", "doc_id", "size", "part", F.posexplode("takes").alias("copy", "take"))
             .withColumn("words", _words(F.col("take"))).where("words > 0"))

    @F.pandas_udf("string")
    def first_words(texts: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([cut_text(t, k) if t is not None else t for t, k in zip(texts, n)], dtype=object)

    # texts that stay whole aren't sent to Python
    partial = F.when(F.col("words") < F.col("size"), F.col(f"row.{text_col}"))
    text = F.when(F.col("words") < F.col("size"), first_words(partial, F.col("words"))) \
        .otherwise(F.col(f"row.{text_col}"))
    dealt = (taken.withColumn("text", text).withColumn("shard", F.col("take.shard"))
             .withColumn("luck", F.xxhash64(F.lit(f"shuffle {seed}"), "shard", F.col("doc_id").cast("string"), "copy"))
             .repartition(n_shards, "shard").sortWithinPartitions("shard", "luck", "copy"))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("text").alias(c))
        elif c == length_col:
            columns.append(F.when(F.col("words") < F.col("size"), F.char_length("text").cast(docs.schema[c].dataType))
                           .otherwise(F.col(f"row.{c}")).alias(c))
        else:
            columns.append(F.col(f"row.`{c}`").alias(c))
    return dealt.select(*columns)
