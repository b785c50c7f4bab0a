"""Spelling variant groups by blocked Gram matrices.

Words within one edit (a code point inserted, deleted or replaced) have letter counts at a squared distance of 1 or
2. Letter counts are rows of a matrix; the product of a block of words with a block of words of the same length or
one more gives all squared distances of the two blocks at once, pairs at most two apart are kept, and their edit is
verified.

Length blocks are split so that the products stay small. An edit lies in the first or in the second half of the
shorter word, so the other half is the same at that end of both words: words meet in blocks of equal length (or one
more) and an equal half. A block is (length, before, after, m): its words begin with ``before`` and end with ``after``
and differ in the ``m`` code points between (one more in the longer words). Blocks above a limit are split in
the same way by the halves of their middles, so a hot block shrinks until the middle is a single code point; a block of
that kind is bounded by the alphabet. Every pair is counted in exactly one block. No pair leaves a block: of each word
only its number of near words and the most frequent of them.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_FIRST, _LAST = 0xC0, 0xFF
LETTERS = 26 + _LAST - _FIRST + 1
#: Words of a task's counter before it is handed on, rows of a product, and code points of a block at most.
_FLUSH, _ROWS, _CHARS = 200_000, 1024, 4_000_000
#: Lengths up to which single precision holds squared distances exactly.
_SINGLE = 2_000


def _thinned(word: str, prefix: int, thin: int | None) -> str:
    """The word, or without the code point that its checksum names if ``thin`` divides that."""
    if thin is not None:
        h = zlib.crc32(word.encode("utf-8"), prefix)
        if h % thin == 0:
            k = h % len(word)
            return word[:k] + word[k + 1:]
    return word


def _run_counts(min_length: int, thin: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def rows() -> pd.DataFrame:
            out = pd.DataFrame({"word": pd.Series(list(total.keys()), dtype=object),
                                "n": np.fromiter(total.values(), np.int64, len(total))})
            total.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                if not text:
                    continue
                prefix = zlib.crc32(f"{doc_id}:".encode("utf-8"))
                own = Counter(map(operator.itemgetter(0), RUN.finditer(text.translate(_LOWER))))
                for word, n in own.items():
                    word = _thinned(word, prefix, thin)
                    if len(word) >= min_length:
                        total[word] += n
                if len(total) > _FLUSH:
                    yield rows()
        yield rows()
    return run


def word_counts(docs: DataFrame, min_length: int = 5, min_count: int = 3, thin: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of Latin letters with A-Z lower-cased, of at least ``min_length`` code points, that occur at
    least ``min_count`` times. With ``thin``, a run whose crc32 after ``<id>:`` is a multiple of it loses one code
    point. Tasks count their own words before anything is shuffled; null text has none, a null id is empty text."""
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"),
                        F.col(text_col).alias("text"))
    return (texts.mapInPandas(_run_counts(min_length, thin), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


KEY = ["length", "m", "before", "after"]


def whole_blocks(words: DataFrame, min_length: int) -> DataFrame:
    """Words (word, n) as members of their whole length block, and of the block one shorter, where ``longer``."""
    size = F.char_length("word")
    own = words.select("word", "n", size.alias("length"), F.lit(False).alias("longer"))
    longer = words.where(size > min_length).select("word", "n", (size - 1).alias("length"), F.lit(True).alias("longer"))
    return own.unionByName(longer).select("*", F.col("length").alias("m"), F.lit("").alias("before"),
                                          F.lit("").alias("after"))


def split_blocks(members: DataFrame) -> DataFrame:
    """Members of blocks dealt to the two blocks that share the first or the second half of the middle as well."""
    size = F.col("m") + F.col("longer").cast("int")
    at = F.char_length("before") + 1
    h = F.floor(F.col("m") / 2).cast("int")
    first = F.substring("word", at, h)
    last = F.substring("word", at + size - (F.col("m") - h), F.col("m") - h)
    halves = F.array(
        F.struct((F.col("m") - h).alias("m"), F.concat("before", first).alias("before"), F.col("after").alias("after")),
        F.struct(h.alias("m"), F.col("before").alias("before"), F.concat(last, "after").alias("after")))
    return (members.withColumn("half", F.explode(halves))
            .select("word", "n", "length", "longer", "half.m", "half.before", "half.after"))


def _counts(words: list[str], dtype) -> np.ndarray:
    """Letter counts of each word, a row each."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    letter = np.where(codes < _FIRST, codes - ord("a"), codes - _FIRST + 26)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(row * LETTERS + letter, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(dtype)


def _padded(words: list[str], width: int) -> np.ndarray:
    return np.array(words, dtype=f"<U{width}").view("<u4").reshape(len(words), width)


def one_edit(a: np.ndarray, b: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(near, place) of padded words row by row: whether b is a with one code point replaced or, where ``longer``,
    inserted, and where they first differ."""
    differ = a != b
    place = differ.argmax(1)
    shifted = a[:, :-1] != b[:, 1:]
    tail = (shifted & (np.arange(a.shape[1] - 1) >= place[:, None])).any(1)
    return np.where(longer, ~tail, differ.sum(1) == 1), place


def near_in_block(block: pd.DataFrame) -> pd.DataFrame:
    """(word, n_near, form, form_n) of the members of some whole blocks: what each has there."""
    words, n, longer = block["word"].tolist(), block["n"].to_numpy(), block["longer"].to_numpy()
    group, begin, m = (block[c].to_numpy() for c in ("group", "begin", "m"))
    longest = max(map(len, words))
    counts = _counts(words, np.float32 if longest <= _SINGLE else np.float64)
    square = (counts * counts).sum(1)
    own = np.flatnonzero(~longer)
    distance = square[own][:, None] + square[None, :] - 2 * (counts[own] @ counts.T)
    i, j = np.nonzero(distance <= 2)
    i = own[i]
    same = (group[i] == group[j]) & (i != j)
    i, j = i[same], j[same]
    keep = []
    padded = _padded(words, longest + 1)
    step = max(1, _CHARS // (longest + 1))
    for a in range(0, len(i), step):
        x, y = i[a:a + step], j[a:a + step]
        near, place = one_edit(padded[x], padded[y], longer[y])
        # an inserted code point can stand at several places: the last one decides which block counts the pair
        here = (place > begin[x]) & (place <= begin[x] + m[x]) | (place == 0) & (begin[x] == 0)
        keep.append(near & (~longer[y] | here))
    kept = np.concatenate(keep) if keep else np.empty(0, dtype=bool)
    i, j = i[kept], j[kept]
    # a pair of equal length is found from both sides, one with a longer word from the shorter
    up = longer[j]
    target, other = np.r_[i, j[up]], np.r_[j, i[up]]
    rank = np.empty(len(words), dtype=np.int64)
    order = sorted(range(len(words)), key=lambda r: (-n[r], words[r]))
    rank[order] = np.arange(len(words))
    best = np.full(len(words), len(words), dtype=np.int64)
    np.minimum.at(best, target, rank[other])
    n_near = np.bincount(target, minlength=len(words))
    found = np.flatnonzero(n_near)
    form = [order[r] for r in best[found].tolist()]
    return pd.DataFrame({"word": pd.Series([words[r] for r in found], dtype=object), "n_near": n_near[found],
                         "form": pd.Series([words[r] for r in form], dtype=object), "form_n": n[form]})


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole blocks in a row, as many as fit into one product; ``batches`` come sorted by block."""
    def products(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = rows.reset_index(drop=True)
        first = ~rows.duplicated(KEY).to_numpy()
        rows["group"] = np.cumsum(first)
        rows["begin"] = rows["before"].str.len()
        size = rows["word"].str.len().to_numpy()
        starts = np.append(np.flatnonzero(first), len(rows)).tolist()
        a = 0
        for s, e in zip(starts, starts[1:]):
            if s > a and (e - a > _ROWS or (e - a) * int(size[s:e].max()) > _CHARS):
                yield near_in_block(rows.iloc[a:s])
                a = s
        if a < len(rows):
            yield near_in_block(rows.iloc[a:])

    held = None
    for b in batches:
        held = b if held is None or held.empty else pd.concat([held, b], ignore_index=True)
        if len(held) < 4 * _ROWS:
            continue
        other = (held[KEY] != held[KEY].iloc[-1]).any(axis=1).to_numpy()  # rows of blocks that have ended
        if other.any():
            cut = int(np.flatnonzero(other)[-1]) + 1
            yield from products(held.iloc[:cut])
            held = held.iloc[cut:]
    if held is not None and not held.empty:
        yield from products(held)


def near_words(words: DataFrame, min_length: int = 5, limit: int = 2048) -> DataFrame:
    """(word, n_near, form, form_n) of the words (word, n) that have near words: how many, and the most frequent
    of them (ties: the smallest). Blocks of over ``limit`` members are split until their middle is one code point."""
    blocks = stored(split_blocks(whole_blocks(words, min_length)), "blocks")
    ready = []
    while True:
        hot = stored(blocks.where("m > 1").groupBy(*KEY).agg(F.count("*").alias("members"))
                     .where(F.col("members") > limit).select(*KEY), "hot-blocks")
        if hot.isEmpty():
            ready.append(blocks)
            break
        ready.append(blocks.join(hot, KEY, "left_anti"))
        blocks = stored(split_blocks(blocks.join(hot, KEY, "left_semi")), "blocks")
    members = ready[0]
    for more in ready[1:]:
        members = members.unionByName(more)
    tasks = max(1, words.count() // 10_000)
    found = (members.repartition(tasks, *KEY).sortWithinPartitions(*KEY)
             .mapInPandas(_near, "word string, n_near long, form string, form_n long"))
    best = F.min(F.struct((-F.col("form_n")).alias("order"), F.col("form").alias("form")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", "best.form", (-F.col("best.order")).alias("form_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where the forms lead. Each round doubles the steps; a form is at least twice as
    frequent as its word, so chains are short and have no circle."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = stored(now.join(further, "root", "left")
                     .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                     "roots")
        if nxt.where("moved").isEmpty():
            return nxt.select("word", "root")
        now = nxt.select("word", "root")


def spelling_variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2,
                      thin: int | None = None, limit: int = 2048, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the word's most frequent near word (ties: the smallest in code-point order) if that is at least
    ``ratio`` times as frequent, else null, and ``form_n`` how often it occurs; ``root`` is where forms lead from the
    word, itself if nowhere; ``n_near`` counts its near words. ``ratio`` is above 1. Repeated rows count each; null
    and empty texts have no words, and without words the result is empty; other columns are not read."""
    if ratio <= 1:
        raise ValueError("ratio must be above 1, or forms could lead in circles")
    words = stored(word_counts(docs, min_length, min_count, thin, id_col, text_col), "words")
    near = near_words(words, min_length, limit)
    formed = stored(
        words.join(near, "word", "left").withColumn("take", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
        .select("word", F.when(F.col("take"), F.col("form")).alias("form"), "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(F.col("take"), F.col("form_n")).alias("form_n")), "forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                    "n_near", "form_n")
