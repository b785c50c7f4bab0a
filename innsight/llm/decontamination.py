"""Benchmark decontamination: document words inside windows of benchmark items.

Benchmark items and documents are sequences of words (ASCII letters and digits, any other script's characters; A-Z
lower-cased). Every run of n consecutive words of an item is a window; an item of fewer words is one window itself.
Window hashes and words are a table that is broadcast while it is under a bound, measured before; documents aren't
shuffled then. Above it, windows are joined by equality of hash without that hint. A hit's words are compared, not
only its hash. Hits give spans, and spans or documents are removed. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of words and hashes that the table of windows may have to be broadcast.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    """The text's words, in order."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def _gram(words: str, at: Column, n: int) -> list[Column]:
    return [F.get(words, at + j) for j in range(n)]


def item_windows(benchmark: DataFrame, n: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(hash, gram, item): the windows of each item, once each. ``item`` is the id as text, null where the id is; the
    hash is over the words as columns, as ``hits`` computes it (columns past the end are null and don't change it);
    items without words have none."""
    words = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
    size = F.least(F.lit(n), F.size("words"))
    grams = (words.where(F.size("words") > 0)
             .select("item", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("p"))
             .select("item", F.slice("words", F.col("p") + 1, F.col("size")).alias("gram")))
    return grams.withColumn("hash", F.xxhash64(*_gram("gram", F.lit(0), n))).select("hash", "gram", "item").distinct()


def window_table(windows: DataFrame) -> tuple[DataFrame, list[int], int]:
    """The windows' distinct words (gram_id, hash, gram, size), their sizes, and the bytes that a broadcast takes."""
    grams = stored(windows.select("hash", "gram").distinct().withColumn("size", F.size("gram"))
                   .withColumn("gram_id", F.monotonically_increasing_id()), "grams")
    bytes_ = F.sum(F.lit(80) + F.aggregate("gram", F.lit(0), lambda a, w: a + F.octet_length(w) + 16)).alias("bytes")
    measured = grams.groupBy("size").agg(bytes_).collect()  # at most n rows
    return grams, sorted(r["size"] for r in measured), sum(r["bytes"] for r in measured)


def hits(docs: DataFrame, grams: DataFrame, sizes: list[int], broadcast: bool) -> DataFrame:
    """(doc_id, digest, p, size, gram_id): places of ``docs`` (doc_id, digest, words) where a window's words stand.

    A text's places are exploded once for all window sizes. While the table is broadcast, the words that a hit is
    compared with are taken from the text's own array after the join; rows that are shuffled carry their window only."""
    if not sizes:
        sizes = [1]
    places = F.sequence(F.lit(0), F.size("words") * len(sizes) - 1)
    rolled = (docs.where(F.size("words") > 0).select("doc_id", "digest", "words", F.explode(places).alias("i"))
              .withColumn("p", F.floor(F.col("i") / len(sizes)).cast("int")))
    n, hash_ = F.lit(sizes[0]), F.xxhash64(*_gram("words", F.col("p"), sizes[0]))
    for j, size in enumerate(sizes[1:], 1):
        chosen = F.col("i") % len(sizes) == j
        n = F.when(chosen, size).otherwise(n)
        hash_ = F.when(chosen, F.xxhash64(*_gram("words", F.col("p"), size))).otherwise(hash_)
    placed = rolled.where(F.col("p") + n <= F.size("words")).withColumn("hash", hash_)

    def window(size: Column) -> Column:
        return F.slice("words", F.col("p") + 1, size)

    if broadcast:
        met = placed.join(F.broadcast(grams), "hash").where(window(F.col("size")) == F.col("gram"))
    else:
        met = (placed.select("doc_id", "digest", "p", "hash", window(n).alias("own"))
               .join(grams, "hash").where(F.col("own") == F.col("gram")))
    return met.select("doc_id", "digest", "p", "size", "gram_id")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest and text: rows of equal id and text are found alike."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
                       text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                       broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(spans, items): (doc_id, digest, first, last) of maximal runs of hit words, and (doc_id, digest, item) of
    the items with a window there, once each."""
    windows = stored(item_windows(benchmark, n, item_id_col, item_text_col), "windows")
    grams, sizes, size = window_table(windows)
    small = size <= broadcast_bytes
    own = _keyed(docs, id_col, text_col).select("doc_id", "digest", words_of(F.col("text")).alias("words"))
    found = stored(hits(own, grams, sizes, small).distinct(), "hits")
    line = Window.partitionBy("doc_id", "digest").orderBy("p")
    end = F.col("p") + F.col("size") - 1
    before = F.max(end).over(line.rowsBetween(Window.unboundedPreceding, -1))
    runs = (found.groupBy("doc_id", "digest", "p").agg(F.max("size").alias("size"))
            .withColumn("new", F.coalesce(F.col("p") > before + 1, F.lit(True)))
            .withColumn("run", F.sum(F.col("new").cast("int")).over(line)))
    spans = (runs.groupBy("doc_id", "digest", "run").agg(F.min("p").alias("first"), F.max(end).alias("last"))
             .select("doc_id", "digest", "first", "last"))
    of = windows.join(grams, ["hash", "gram"]).where("item IS NOT NULL").select("gram_id", "item")
    met = found.join(F.broadcast(of) if small else of, "gram_id")
    return spans, met.select("doc_id", "digest", "item").distinct()


def _joined(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with what was found of their id and digest."""
    named = found.withColumnsRenamed({"doc_id": "found_id", "digest": "found_digest"})
    return rows.join(named, F.col("doc_id").eqNullSafe(F.col("found_id"))
                     & (F.col("digest") == F.col("found_digest")), "left").drop("found_id", "found_digest")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  **settings) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the words inside any occurrence of a window, ``n_items`` the ids of items with an occurring
    window, whose digest is that of the ids sorted as text and joined by commas (of the empty text without any). Null
    and empty texts have no words; rows of equal id and text are found alike, null ids are kept; items without words
    have no windows, those without an id are found but not listed; an empty table of documents gives an empty result, an
    empty benchmark no hits; other columns are not read."""
    spans, items = contaminated_spans(docs, benchmark, n, id_col, text_col, **settings)
    hit = spans.groupBy("doc_id", "digest").agg(F.sum(F.col("last") - F.col("first") + 1).cast("long").alias("n_hit"))
    listed = items.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("item")).alias("items"))
    rows = _keyed(docs, id_col, text_col).select(
        "doc_id", "digest", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return _joined(_joined(rows, hit), listed).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Whole rows beside their doc_id, digest and text, so that no column's name can clash."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col(f"row.`{text_col}`")
    return rows.select("row", F.col(f"row.`{id_col}`").alias("doc_id"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("digest"), text.alias("text"))


def without_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  **settings) -> DataFrame:
    """``docs`` with hit words, and what stands before each of them since the word before, taken out of their
    texts; texts without hits, nulls too, and all other columns stay as they are."""
    spans, _ = contaminated_spans(docs, benchmark, n, id_col, text_col, **settings)
    spans = stored(spans, "spans")
    rows = _rows(docs, id_col, text_col)
    key = ["doc_id", "digest"]
    hit = spans.withColumnsRenamed({"doc_id": "hit_id", "digest": "hit_digest"})
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("hit_digest"))
    dirty = rows.join(hit, same, "left_semi").select(*key, "text").dropDuplicates(key)
    # each word with the gap before it, and the gap at the end; a text's words that stay are put together again
    pieces = F.zip_with(F.split("text", WORD), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
                        lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))))
    places = hit.select("hit_id", "hit_digest", F.explode(F.sequence("first", "last")).alias("hit_p"))
    kept = (dirty.select(*key, F.posexplode(pieces).alias("p", "piece"))
            .join(places, same & (F.col("p") == F.col("hit_p")), "left_anti"))
    cut = kept.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("p", "piece"))).alias("pieces")).select(
        *key, F.concat_ws("", F.col("pieces.piece")).alias("cut"))
    return _joined(rows, cut).select(*[
        (F.coalesce("cut", "text") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def without_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
                      text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose texts have no hit, with all their columns."""
    spans, _ = contaminated_spans(docs, benchmark, n, id_col, text_col, **settings)
    hit = spans.select(F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest")).distinct()
    clean = _rows(docs, id_col, text_col).join(
        hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("hit_digest")), "left_anti")
    return clean.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
