"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document's token ids, with an end id, are cut into pieces: full windows first, then pieces of at most ``grain``
ids. Full windows stand alone. The other pieces are dealt at random into groups of a bounded number of tokens, and
each group is partitioned into the fewest windows that could hold it: every piece starts as a partial partition
(itself and empty windows), and the two partial partitions with the largest imbalance are merged again and again,
the fullest window of one with the emptiest of the other. The windows come out nearly equal; while one exceeds the
capacity, the group is partitioned anew with one window more.
"""

from __future__ import annotations

import functools
import heapq
import operator
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, ship, stored

WINDOW = 4096
#: Pieces and bytes that a task remembers, and texts and characters encoded at once.
_MEMO_PIECES, _MEMO_BYTES, _TEXTS, _CHARS = 500_000, 24 << 20, 512, 2_000_000
_SUM = operator.itemgetter(0)
PIECE_SCHEMA = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"


#: Letters of one word, then marks that neither join a word nor begin a contraction.
_LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKS = r"[!-&(-/:-@\[-`{-~]*$"
_PLAIN = _LETTERS + _MARKS
_BREAK = re.compile("[ \n]")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    """(tokenizer, whether a text's ids are those of its pieces between spaces, how a lower-cased word of Latin letters
    is spelt for the tokenizer's model, or None if its ids aren't the model's)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    tok = Tokenizer.from_file(path)
    ids = [tok.encode(x, add_special_tokens=False).ids for x in ("A b", "a", "b", "the,x", "the", ",", "x")]
    by_piece = ids[0] == ids[1] + ids[2] and ids[3] == ids[4] + ids[5] + ids[6]
    # how the tokenizer writes letters for its model: a character for each byte of theirs
    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    spelt = str.maketrans({chr(c): spell.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)})
    by_model = by_piece and all(
        [t.id for t in tok.model.tokenize(x.translate(spelt))] == tok.encode(x, add_special_tokens=False).ids
        for x in ("a", "the", "restaurant", "être", "größe", "años", "ÿþ".lower()))
    return tok, by_piece, spelt if by_model else None


@dataclass
class Memo:
    """Pieces and their ids as columns: ``ids[first[i]:first[i] + size[i]]`` are those of ``pieces[i]``."""

    pieces: pa.LargeStringArray
    size: np.ndarray
    first: np.ndarray
    ids: np.ndarray

    @classmethod
    def empty(cls) -> Memo:
        return cls(pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4"))

    def with_more(self, pieces: pa.LargeStringArray, size: np.ndarray, ids: np.ndarray) -> Memo:
        first = len(self.ids) + np.cumsum(size) - size
        return Memo(pa.concat_arrays([self.pieces, pieces]), np.concatenate((self.size, size)),
                    np.concatenate((self.first, first)), np.concatenate((self.ids, ids)))

    def only(self, at: np.ndarray) -> Memo:
        size = self.size[at]
        return Memo(self.pieces.take(pa.array(at)), size, np.cumsum(size) - size, self.ids[_places(self.first[at], size)])

    def full(self) -> bool:
        return len(self.pieces) > _MEMO_PIECES or self.pieces.nbytes + self.ids.nbytes + 16 * len(self.size) > _MEMO_BYTES


def _places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first[i]`` to ``first[i] + size[i] - 1`` of every i, one after the other."""
    stop = np.cumsum(size)
    out = np.repeat(first - (stop - size), size)
    out += np.arange(len(out))
    return out


class Encoder:
    """Ids of whole texts by a tokenizer of lower-cased words with word ends, kept per piece between spaces.

    The library splits at white space and between letters and marks whatever stands around them, so a text's ids
    are those of its pieces, one after the other. Texts, pieces and what is remembered of them are Arrow and NumPy
    columns; only pieces not met before go through the library. An encoder belongs to a task and its memory goes with
    it; when the memo is full, the pieces of the last texts stay."""

    def __init__(self, path: str):
        self.tok, self.by_piece, self.spelt = _tokenizer(path)
        self.memo = Memo.empty()

    def _one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(size, ids) of pieces, encoded apart."""
        ids = [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([len(x) for x in ids], dtype=np.int64), np.array([y for x in ids for y in x], dtype="<u4")

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(size, ids) of lower-cased words of Latin letters: the model's, as nothing in them is parted or joined."""
        if self.spelt is None:
            return self._one_by_one(words)
        tokenize, spelt = self.tok.model.tokenize, self.spelt
        found = [[t.id for t in tokenize(w if w.isascii() else w.translate(spelt))] for w in words]
        return np.array([len(x) for x in found], dtype=np.int64), np.array([y for x in found for y in x], dtype="<u4")

    def _learn(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Remember pieces not met before, and return their places in the memo: words with marks after them are learnt
        by distinct words and distinct marks, others one by one."""
        is_plain = pc.match_substring_regex(pieces, _PLAIN)
        plain, others = pieces.filter(is_plain), pieces.filter(pc.invert(is_plain))
        marks = pc.replace_substring_regex(plain, _LETTERS, "").dictionary_encode()
        words = pc.utf8_lower(pc.replace_substring_regex(plain, _MARKS, "")).dictionary_encode()
        w_size, w_ids = self._words(words.dictionary.to_pylist())
        m_size, m_ids = self._one_by_one(marks.dictionary.to_pylist())
        w, m = words.indices.to_numpy(), marks.indices.to_numpy()
        w_first, m_first = np.cumsum(w_size) - w_size, len(w_ids) + np.cumsum(m_size) - m_size
        first = np.stack((w_first[w], m_first[m]), axis=1).ravel()
        size = np.stack((w_size[w], m_size[m]), axis=1)
        ids = np.concatenate((w_ids, m_ids))[_places(first, size.ravel())]
        held, plain_at = len(self.memo.pieces), is_plain.to_numpy(zero_copy_only=False)
        self.memo = self.memo.with_more(plain, size.sum(1), ids).with_more(others, *self._one_by_one(others.to_pylist()))
        places = np.empty(len(pieces), dtype=np.int64)
        places[plain_at] = held + np.arange(len(plain))
        places[~plain_at] = held + len(plain) + np.arange(len(others))
        return places

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        column = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")  # a line break only separates
        pieces = pc.split_pattern(column, " ")
        coded = pieces.flatten().dictionary_encode()
        distinct = coded.dictionary
        at = pc.fill_null(pc.index_in(distinct, self.memo.pieces), -1).to_numpy().astype(np.int64)
        missing = at < 0
        if missing.any():
            at[missing] = self._learn(distinct.filter(pa.array(missing)))
        codes = at[coded.indices.to_numpy()]
        size = self.memo.size[codes]
        every = self.memo.ids[_places(self.memo.first[codes], size)]
        bounds = np.concatenate(([0], np.cumsum(size)))[pieces.offsets.to_numpy()].tolist()
        if self.memo.full():
            self.memo = self.memo.only(at)
        return [every[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Each whole text's ids (little-endian unsigned 32-bit), without special tokens added."""
        if not self.by_piece:
            return [np.array(e.ids, dtype="<u4")
                    for e in self.tok.encode_batch_fast(list(texts), add_special_tokens=False)]
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, owners, chars = [], [], 0

        def take() -> None:
            for i, ids in zip(owners, self._encode(held) if held else []):
                out[i].append(ids)
            held.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for part in _parts(text):
                held.append(part)
                owners.append(i)
                chars += len(part)
                if chars > _CHARS:
                    take()
                    chars = 0
        take()
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def _parts(text: str) -> Iterator[str]:
    """The text, or its parts of about ``_CHARS`` characters between breaks."""
    a = 0
    while len(text) - a > _CHARS and (m := _BREAK.search(text, a + _CHARS)):
        yield text[a:m.start()]
        a = m.end()
    yield text[a:]


def token_bytes(texts: Sequence[str], path: str) -> list[bytes]:
    """Each whole text's ids by the tokenizer in ``path``, as ``Encoder.encode`` gives them."""
    return [x.tobytes() for x in Encoder(path).encode(texts)]


def cut(n: int, window: int = WINDOW, grain: int = 512) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then pieces of at most ``grain``."""
    full = n - n % window
    return [(a, window) for a in range(0, full, window)] + [(a, min(grain, n - a)) for a in range(full, n, grain)]


def _pieces(path: str, end_id: int, window: int, grain: int):
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for b in batches:
            for i in range(0, b.num_rows, _TEXTS):
                part = b.slice(i, _TEXTS)
                rows: list[list] = [[], [], [], [], []]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text").to_pylist())):
                    ids = np.concatenate((ids, end))
                    for a, k in cut(len(ids), window, grain):
                        for column, x in zip(rows, (doc_id, a, k, zlib.crc32(ids[a:a + k]), len(ids))):
                            column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), *[pa.array(x, pa.int64()) for x in rows[1:]]],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        del encoder
        released()
    return run


def difference(sizes: Sequence[int], n: int) -> list[list[int]]:
    """Karmarkar-Karp: indices of ``sizes`` in ``n`` windows with nearly equal sums.

    A partial partition lists its windows that aren't empty as (sum, pieces), fullest first."""
    heap = [(-k, order, [(k, (i,))]) for order, (k, i) in
            enumerate(sorted(((k, i) for i, k in enumerate(sizes)), key=lambda x: (-x[0], x[1])))]
    order = len(heap)
    while len(heap) > 1:
        _, _, p = heapq.heappop(heap)
        _, _, q = heapq.heappop(heap)
        free_p, free_q = n - len(p), n - len(q)  # empty windows of either take the other's fullest as they are
        met = [(a[0] + b[0], (a[1], b[1])) for a, b in zip(p[free_q:], reversed(q[free_p:]))]
        merged = sorted(p[:free_q] + met + q[:free_p], key=_SUM, reverse=True)
        least = merged[-1][0] if len(merged) == n else 0
        heapq.heappush(heap, (least - merged[0][0], order, merged))
        order += 1
    windows = [_indices(tree) for _, tree in heap[0][2]] if heap else []
    return windows + [[] for _ in range(n - len(windows))]


def _indices(tree: tuple) -> list[int]:
    """Indices in a window's tree of pairs, in order of merging."""
    out, todo = [], [tree]
    while todo:
        x = todo.pop()
        if len(x) == 1:
            out.append(x[0])
        else:
            todo += [x[1], x[0]]
    return out


def windows_of(sizes: Sequence[int], capacity: int = WINDOW) -> list[list[int]]:
    """Indices of ``sizes`` in nearly equal windows, none over ``capacity``, as few as differencing finds."""
    n = max(1, -(-sum(sizes) // capacity)) if len(sizes) else 0
    while n:
        found = difference(sizes, n)
        if max(sum(sizes[i] for i in w) for w in found) <= capacity:
            return found
        n += 1
    return []


def _pack(window: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece").reset_index(drop=True)
        alone = np.flatnonzero(group["length"] == window)
        rest = np.flatnonzero(group["length"] < window)
        found = [[i] for i in alone] + [[rest[i] for i in w] for w in
                                        windows_of(group["length"].to_numpy()[rest].tolist(), window)]
        sequence, offset = np.zeros(len(group), dtype=np.int64), np.zeros(len(group), dtype=np.int64)
        length = group["length"].to_numpy()
        for k, w in enumerate(found):
            sequence[w] = (key[0] << 32) + k
            offset[w] = np.cumsum(length[w]) - length[w]
        return group.assign(sequence_id=sequence, offset=offset).drop(columns=["piece", "bucket"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW, grain: int = 512,
         group_windows: int = 48, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A group gets about ``group_windows`` windows' worth of tokens, whatever the input's size; pieces are dealt to
    groups by a hash of their number, so neither long documents nor repeated ids gather in one. Null and empty
    texts are the end id alone. Null ids are kept, repeated rows are packed each; an empty table gives an empty
    result; columns other than id and text are not read."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = stored(texts.mapInArrow(_pieces(tokenizer_path, end_id, window, grain), PIECE_SCHEMA)
                    .withColumn("piece", F.monotonically_increasing_id()), "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (group_windows * window)))
    return (pieces.withColumn("bucket", F.pmod(F.xxhash64("piece"), F.lit(groups)))
            .groupBy("bucket").applyInPandas(_pack(window), f"{PIECE_SCHEMA}, sequence_id long, offset long")
            .withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)))
