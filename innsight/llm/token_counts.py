"""Token counts with a digest cache.

A count depends on two digests: that of the text (null counts as the empty text) and that of the tokenizer (its
file's bytes and the library's version). Stored counts are joined on both; only texts whose digest has no stored
count are encoded, each distinct text once, and their counts are appended to the cache.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship

CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"

#: A single space between two characters that aren't white space. A byte-level BPE's pre-tokens never reach
#: across the place before it, so the text's ids are those of its pieces there, one after the other.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Pieces kept by a worker before it starts anew (about 150 bytes each).
_MEMO_PIECES = 1_000_000


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}


def tokenizer_digest(path: str) -> str:
    """SHA-256 over the tokenizer's file and the library's version: another of either gives other cache rows."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"\0tokenizers " + tokenizers.__version__.encode()).hexdigest()


def _is_byte_level(tok) -> bool:
    """Whether pieces cut by ``_CUT`` can be encoded apart: byte-level pre-tokens, nothing normalised or added."""
    return tok.normalizer is None and type(tok.pre_tokenizer).__name__ == "ByteLevel" \
        and "add_prefix_space=False" in repr(tok.pre_tokenizer)


def count_tokens(texts: list[str], path: str) -> list[int]:
    """Token counts of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    For byte-level BPE files each distinct piece between words is encoded once per worker."""
    tok, memo = _tokenizer(path)
    if not _is_byte_level(tok):
        return [len(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    if len(memo) > _MEMO_PIECES:
        memo.clear()
    pieces = []
    for t in texts:
        first, *rest = _CUT.split(t)
        pieces.append([first, *[" " + x for x in rest]])
    missing = list(set().union(*pieces).difference(memo))
    memo.update(zip(missing, (len(e.ids) for e in tok.encode_batch_fast(missing, add_special_tokens=False))))
    return [sum(map(memo.__getitem__, p)) for p in pieces]


def _encode(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts: list[int] = []
            texts = b["text"].tolist()
            for i in range(0, len(texts), 256):  # a few pieces lists at a time
                counts += count_tokens(texts[i:i + 256], path)
            yield pd.DataFrame({"content": b["content"], "n_tokens": counts})
    return run


def _cache(spark: SparkSession, cache_path: str, tokenizer: str) -> DataFrame | None:
    """The tokenizer's stored counts, one row per content; None if nothing is stored."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # Two runs may have stored the same content. Grouping by both digests leaves the join by content an exchange of
    # its own, whose partitions Spark splits where one text has very many copies.
    return (stored.where(F.col("tokenizer") == tokenizer).groupBy("content", "tokenizer")
            .agg(F.max("n_tokens").alias("n_tokens")).drop("tokenizer"))


def content_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def update_cache(docs: DataFrame, tokenizer_path: str, cache_path: str, text_col: str = "text") -> None:
    """Encode the distinct texts of ``docs`` that have no stored count and append their counts.

    Texts are made distinct map-side first, so a text with many copies is shuffled once per task. The append
    is one committed Parquet write: a run that fails leaves the cache as it was."""
    spark = docs.sparkSession
    ship(spark)
    digest = tokenizer_digest(tokenizer_path)
    texts = (docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .select(content_digest(F.col("text")).alias("content"), "text").dropDuplicates(["content"]))
    known = _cache(spark, cache_path, digest)
    missing = texts if known is None else texts.join(known, "content", "left_anti")
    (missing.mapInPandas(_encode(tokenizer_path), "content string, n_tokens long")
     .select("content", F.lit(digest).alias("tokenizer"), "n_tokens")
     .write.mode("append").parquet(cache_path))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit, content digest.

    Null text counts as the empty text (0 bytes, 0 tokens). Null and repeated ids stay rows of their own, an empty
    table gives an empty result, and other columns of ``docs`` are not read. ``cache_path`` is a folder that all
    executors share."""
    spark = docs.sparkSession
    update_cache(docs, tokenizer_path, cache_path, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.sha2(text, 256).alias("content"))
    counts = _cache(spark, cache_path, tokenizer_digest(tokenizer_path))
    return (keys.join(counts, "content", "left")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "content"))
