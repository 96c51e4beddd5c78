"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.byte_level import (
    BLANK,
    LATER_LETTERS,
    LATER_NUMBERS,
    LATIN_BLANK,
    LATIN_LETTER,
    LATIN_NUMBER,
    LETTERS,
    is_latin,
    read_vocabulary,
)
from comanda.llm.common import text_batches

# Words whose ids a Python worker remembers; a cache, emptied when full.
CACHE = 150_000
# Symbols that one round of words holds, padding included: it bounds memory.
_ROUND = 1 << 20


def _words(letter: str, number: str, other: str) -> str:
    """Contractions, words, single digits, signs."""
    return rf"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|{other}+"


_WORDS = regex.compile(
    _words(
        rf"[\p{{L}}--[{LATER_LETTERS}]]",
        rf"[\p{{N}}--[{LATER_NUMBERS}]]",
        rf"[[^{BLANK}\p{{L}}\p{{N}}]||[{LATER_LETTERS}{LATER_NUMBERS}]]",
    ),
    regex.V1,
)
_LATIN_WORDS = re.compile(
    _words(f"[{LATIN_LETTER}]", f"[{LATIN_NUMBER}]", f"[^{LATIN_BLANK}{LATIN_LETTER}{LATIN_NUMBER}]")
)
# Capitals that the library makes small and Python's tables don't have yet.
_LATER_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
    0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
_HAS_LATER_CAPITAL = re.compile("[" + "".join(map(chr, _LATER_CAPITALS)) + "]")
_END = "</w>"


class WordBPE:
    """Encodes and decodes with a vocabulary whose words end in </w>."""

    def __init__(self, spec: str):
        vocabulary = read_vocabulary(spec)
        self.vocabulary, ids = vocabulary, vocabulary.ids
        self.strings = [""] * (max([*ids.values(), *vocabulary.special.values()]) + 1)
        for string, i in [*ids.items(), *vocabulary.special.items()]:
            self.strings[i] = string
        self.inner = np.array([ids[LETTERS[b]] for b in range(256)], np.int64)
        self.final = np.array([ids[LETTERS[b] + _END] for b in range(256)], np.int64)
        pairs = np.array([(left, right) for left, right, _ in vocabulary.merges], np.int64)
        self.base = len(self.strings)
        keys = pairs[:, 0] * self.base + pairs[:, 1]
        # Where a pair is listed twice, the later rank counts, as the library has it.
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order
        self.made = np.array([made for _, _, made in vocabulary.merges], np.int64)
        self.words: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; the number of merges where there is none (id -1: no symbol)."""
        keys = left * self.base + right
        at = np.searchsorted(self.pair_keys, keys, side="right") - 1
        found = (at >= 0) & (left >= 0) & (right >= 0)
        found &= self.pair_keys[np.maximum(at, 0)] == keys
        return np.where(found, self.pair_ranks[np.maximum(at, 0)], len(self.made))

    def _merge(self, symbols: np.ndarray) -> np.ndarray:
        """Merge all rows of (words, width) at once; -1 pads and is left where symbols went.

        Each word has a segment tree over its adjacent pairs. A node holds the
        least of rank * width + place below it, so the root holds the leftmost
        pair of the lowest rank. A merge changes three leaves, and what is above
        them anew; rows whose root has no rank left drop out.
        """
        words, width = symbols.shape
        none = len(self.made)
        places = np.arange(width)
        after = np.where(places + 1 < (symbols >= 0).sum(1)[:, None], places + 1, -1)
        before = np.broadcast_to(places - 1, symbols.shape).copy()
        tree = np.empty((words, 2 * width), np.int64)
        right = np.concatenate([symbols[:, 1:], np.full((words, 1), -1)], axis=1)
        tree[:, width:] = self._ranks(symbols, right) * width + places
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        root = 1 if width > 1 else 0
        live = np.flatnonzero(tree[:, root] < none * width) if width > 1 else np.empty(0, np.int64)
        while len(live):
            at = tree[live, 1] % width
            gone = after[live, at]
            follow = after[live, gone]
            symbols[live, at] = self.made[tree[live, 1] // width]
            symbols[live, gone] = -1
            after[live, at] = follow
            has = follow >= 0
            before[live[has], follow[has]] = at[has]
            front = before[live, at]
            own = symbols[live, at]
            next_id = np.where(has, symbols[live, follow], -1)
            front_id = np.where(front >= 0, symbols[live, front], -1)
            tree[live, width + at] = self._ranks(own, next_id) * width + at
            tree[live, width + gone] = none * width + gone
            # Without a symbol in front, the merged place itself stands in.
            lead = np.where(front >= 0, front, at)
            value = np.where(front >= 0, self._ranks(front_id, own) * width + lead, tree[live, width + at])
            tree[live, width + lead] = value
            nodes = [width + at, width + gone, width + lead]
            for _ in range(width.bit_length() - 1):
                nodes = [n >> 1 for n in nodes]
                for n in nodes:
                    tree[live, n] = np.minimum(tree[live, 2 * n], tree[live, 2 * n + 1])
            live = live[tree[live, 1] < none * width]
        return symbols

    def learn(self, words: Sequence[str]) -> None:
        """Encode words and remember their ids, little-endian, four bytes each."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            data = word.encode()
            by_width.setdefault(max(2, 1 << (len(data) - 1).bit_length()), []).append((word, data))
        for width, group in by_width.items():
            step = max(1, _ROUND // width)
            for at in range(0, len(group), step):
                part = group[at : at + step]
                symbols = np.full((len(part), width), -1, np.int64)
                lengths = np.array([len(data) for _, data in part])
                inside = np.arange(width) < lengths[:, None]
                data = np.frombuffer(b"".join(data for _, data in part), np.uint8)
                symbols[inside] = self.inner[data]
                symbols[np.arange(len(part)), lengths - 1] = self.final[data[np.cumsum(lengths) - 1]]
                merged = self._merge(symbols)
                left = merged >= 0
                ids = merged[left].astype("<i4").tobytes()
                ends = 4 * np.cumsum(left.sum(1))
                start = 0
                for (word, _), end in zip(part, ends.tolist()):
                    self.words[word] = ids[start:end]
                    start = end

    def _pieces(self, text: str) -> list[list[str]]:
        """Words of the text's parts; parts at odd places are one special string each."""
        parts = self.vocabulary.split_special(text)
        for i in range(0, len(parts), 2):
            part = parts[i]
            if is_latin(part):
                parts[i] = _LATIN_WORDS.findall(part.lower())
                continue
            # Sigma has one small letter here, wherever it stands in a word.
            part = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3")
            if _HAS_LATER_CAPITAL.search(part):
                part = part.translate(_LATER_CAPITALS)
            parts[i] = _WORDS.findall(part.lower())
        return parts

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, little-endian, four bytes each."""
        pieces = [self._pieces(t) for t in texts]
        if len(self.words) > CACHE:
            self.words.clear()
        fresh = {w for parts in pieces for words in parts[::2] for w in words if w not in self.words}
        self.learn(list(fresh))
        special = self.vocabulary.special
        get = self.words.__getitem__
        out = []
        for parts in pieces:
            ids = [b"".join(map(get, parts[0]))]
            for name, words in zip(parts[1::2], parts[2::2]):
                ids += [special[name].to_bytes(4, "little"), *map(get, words)]
            out.append(b"".join(ids))
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """Token strings with a space between, as a file without a decoder has it."""
        return " ".join(map(self.strings.__getitem__, ids))


@lru_cache(maxsize=1)
def word_bpe(spec: str) -> WordBPE:
    """One encoder, with its memory of words, per Python worker."""
    return WordBPE(spec)


def _encode_rows(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_bpe(spec.value)
        for batch in batches:
            encoded = own.encode([t or "" for t in batch.column("text").to_pylist()])
            ends = np.cumsum([0, *map(len, encoded)]) // 4
            ids = pa.array(np.frombuffer(b"".join(encoded), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], [*kept, "ids"])

    return run


def _decode_rows(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_bpe(spec.value)
        for batch in batches:
            column = batch.column("ids")
            values, ends = column.values.to_numpy(), column.offsets.to_numpy()
            texts = [own.decode(values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return run


def _broadcast(df: DataFrame, spec_path: str):
    text_batches(df.sparkSession)
    with open(spec_path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(documents: DataFrame, spec_path: str) -> DataFrame:
    """Token ids of whole texts: the columns of ``documents``, with ids for text.

    The file at ``spec_path`` is a BPE of the tokenizers library with </w> at
    word ends, white space dropped and letters made small. Its special strings
    in a text are one id each; nothing is added at the ends, cut or padded.
    Words are merged by a segment tree, all new words of a batch side by side; a
    worker remembers what it has encoded. No shuffle; a text and a word may be
    of any length. Null or empty text: no ids. No rows: no rows. A column named
    ids must not be there yet.
    """
    if "ids" in documents.columns:
        raise ValueError("a column named ids is there already")
    kept = [c for c in documents.columns if c != "text"]
    schema = ", ".join([*[f"`{c}` {t}" for c, t in documents.dtypes if c != "text"], "ids array<int>"])
    return documents.select(*kept, "text").mapInArrow(_encode_rows(_broadcast(documents, spec_path)), schema)


def decode(encoded: DataFrame, spec_path: str) -> DataFrame:
    """Add decoded, the text that the library's decode gives for ids; null ids: empty."""
    schema = ", ".join([*[f"`{c}` {t}" for c, t in encoded.dtypes], "decoded string"])
    return encoded.mapInArrow(_decode_rows(_broadcast(encoded, spec_path)), schema)


def encode_decode(documents: DataFrame, spec_path: str) -> DataFrame:
    """doc_id, ids and the decoded text of every document."""
    return decode(encode(documents.select("doc_id", "text"), spec_path), spec_path)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, spaced) and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
