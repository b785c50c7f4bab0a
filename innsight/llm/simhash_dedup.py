"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments: two fingerprints within ``max_bits`` bits have a
segment that differs in at most one bit. Each segment is indexed under its own value and, for every bit, under the
value with that bit deleted (a wildcard). Fingerprints whose segment differs in exactly bit i meet under the
wildcard variant i, one from the side where the bit is 0 and one from the side where it is 1; those with an equal
segment meet under its value. Pairs that meet are verified on all 64 bits. Copies share a fingerprint and are
joined as one, so no pairs are made inside a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .components import components

BITS = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash over word shingles of the text with A-Z lower-cased; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:len(words) - k] + 1)).tolist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1:].tolist())),
                         dtype=">u8", count=len(starts))
    votes = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        votes += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per document."""
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col)).alias("fp"))


def _segment_entries(low: int, high: int, variant: int) -> Column:
    """Index entries of bits ``low`` to ``high``: the segment itself as ``variant``, then one entry per bit."""
    mask = (1 << (high - low)) - 1
    part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1).cast("long"))

    def without_bit(i: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), i)
        return F.struct((i + (variant + 1)).alias("variant"), part.bitwiseAND(F.bitwise_not(bit)).alias("rest"),
                        F.when(part.bitwiseAND(bit) == 0, 0).otherwise(1).alias("side"))

    itself = F.struct(F.lit(variant).alias("variant"), part.alias("rest"), F.lit(None).cast("int").alias("side"))
    return F.concat(F.array(itself), F.transform(F.sequence(F.lit(0), F.lit(high - low - 1)), without_bit))


def signatures(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(fp, variant, rest, side): the index entries of each fingerprint. ``rest`` is the segment without the
    deleted bit that ``variant`` names; ``side`` is that bit, or null where no bit is deleted."""
    segments = max_bits // 2 + 1
    width = -(-BITS // segments)
    entries = [_segment_entries(s * width, min(BITS, (s + 1) * width), s * (BITS + 1)) for s in range(segments)]
    return distinct.select("fp", F.explode(F.concat(*entries)).alias("e")).select("fp", "e.*")


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints within ``max_bits`` bits, each once.

    Both sides are shuffled, whatever Spark takes their size for: it counts an explode's rows as its input's, so it would
    broadcast an index of up to 66 entries for each fingerprint by the size of the fingerprints alone."""
    index = signatures(distinct, max_bits)
    left, right = (index.select(F.col("fp").alias(n), "variant", "rest", F.col("side").alias(f"side_{n}"))
                   for n in "ab")
    met = left.where("side_a IS NULL OR side_a = 0").join(
        right.where("side_b IS NULL OR side_b = 1").hint("merge"), ["variant", "rest"])
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return (met.where(((F.col("side_a") == 0) & (F.col("side_b") == 1))
                      | (F.col("side_a").isNull() & F.col("side_b").isNull() & (F.col("a") < F.col("b"))))
            .where((differing > 0) & (differing <= max_bits))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (smallest doc_id reachable over links,
    itself included) and component_fp (smallest fingerprint reachable, as a signed long; never null).

    Documents without words (null, empty, white space) have fingerprint 0 and link like any other. Null ids never
    become a component_id unless the component has no other; repeated rows stay rows; an empty table gives an
    empty result; columns other than id and text are not read."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    reps = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "representatives")
    parts = components(links(reps.select("fp"), max_bits))
    labelled = (reps.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
                .select("fp", "least_id", F.coalesce("component", "fp").alias("component_fp")))
    ids = labelled.groupBy("component_fp").agg(F.min("least_id").alias("component_id"))
    classes = stored(labelled.join(ids, "component_fp").select("fp", "component_id", "component_fp"), "classes")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id", "component_fp")


def near_duplicates_removed(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id stays (among
    rows of that id, one with the smallest text digest), with all its columns. Null ids come last."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # whole, whatever the names
    rows = rows.select("row", F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"))
    rows = rows.withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    # null ids come last by the flag before the id
    key = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    classes = simhash_components(rows.select(key.alias("doc_id"), "text"), shingle, max_bits)
    first = classes.select(F.col("component_id.id").alias("first_id"),
                           F.col("component_id.digest").alias("first_digest")).distinct()
    kept = rows.drop("text").join(first, F.col("id").eqNullSafe(F.col("first_id"))
                                  & (F.col("digest") == F.col("first_digest")), "left_semi")
    return kept.dropDuplicates(["id", "digest"]).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
