"""Exact token counts of every prefix of a text, by dynamic programming."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.byte_level import (
    BLANK,
    LATIN_BLANK,
    LATIN_LETTER,
    LATIN_NUMBER,
    is_latin,
    read_vocabulary,
    to_bytes,
)
from comanda.llm.common import n_bytes, text_batches

LIMIT = 512
# Pieces whose counts a Python worker remembers; a cache, whose older half goes when full. The
# counts of a piece of up to 255 bytes are a byte each, longer ones aren't kept. An
# entry takes about 200 bytes.
CACHE = 600_000
KEPT_BYTES = 255
# Characters of the texts whose new pieces are counted together.
TOGETHER = 1 << 20


def _pieces(blank: str, letter: str, number: str) -> str:
    """Contractions, words, numbers and signs with the blank before them, blanks."""
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{blank}{letter}{number}]+"
        rf"|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


_PIECE = regex.compile(_pieces(BLANK, r"\p{L}", r"\p{N}"))
_LATIN_PIECE = re.compile(_pieces(LATIN_BLANK, LATIN_LETTER, LATIN_NUMBER))
_LAST = itemgetter(-1)
_BLANKS = regex.compile(rf"[{BLANK}]+")


class _PieceCounts(dict):
    """Tokens of the first 0, 1, ... bytes per piece, computed when first asked for.

    When half of what may be kept has come together it becomes the older half,
    from which pieces that are asked for again are taken over.
    """

    def __init__(self, counts):
        self.counts = counts
        self.older = {}

    def __missing__(self, piece: str) -> bytes | list[int]:
        found = self.older.get(piece)
        return self.keep(piece, next(self.counts([piece.encode()])) if found is None else found)

    def keep(self, piece: str, found: bytes | list[int]) -> bytes | list[int]:
        if len(found) > KEPT_BYTES:
            return found
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = found = bytes(found)
        return found

    def learn(self, pieces: set[str]) -> None:
        """Count those not known yet in order, so that one goes on from the bytes it shares with the one before."""
        new = sorted(p.encode() for p in pieces if p not in self and p not in self.older)
        for piece, found in zip(new, self.counts(new)):
            self.keep(piece.decode(), found)


class PrefixCounter:
    """Counts the tokens of all prefixes of a text in one pass over it.

    A text is cut into pieces, and pairs are merged within pieces only. Within a
    piece, the tokens of a prefix that ends at byte i are those of the shorter
    prefix that ends where the last token starts, and that last token. It is the
    one vocabulary entry that ends at i and stays apart from the last token of
    the shorter prefix. So each prefix needs its last token and its count only.
    """

    def __init__(self, spec: str):
        vocabulary = read_vocabulary(spec)
        self.vocabulary = vocabulary
        special = set(vocabulary.special.values())
        self.tokens = {to_bytes(t): i for t, i in vocabulary.ids.items() if i not in special}
        # Bytes from a token's end towards its start lead from state to state; some are
        # a whole token. No longer token ends in bytes that lead to no state.
        self.back, self.whole = {}, [None]
        for token, i in self.tokens.items():
            state = 0
            for byte in reversed(token):
                state = self.back.setdefault(state << 8 | byte, len(self.whole))
                if state == len(self.whole):
                    self.whole.append(None)
            self.whole[state] = i
        self.rank = {}
        self.made = {}
        for r, (left, right, token) in enumerate(vocabulary.merges):
            self.rank[left << 20 | right] = r
            self.made.setdefault(token, (r, left, right))
        self.apart: dict[int, bool] = {}
        self.pieces = _PieceCounts(self.piece_counts)

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are what merging leaves of their bytes.

        Undo the merges of both, the latest first, and see at each step whether
        the tokens that then met would have merged before the undone merge. Of
        equal merges the one further left comes first.
        """
        until = len(self.rank)
        while True:
            met = self.rank.get(left << 20 | right)
            if met is not None and met < until:
                return False
            a, b = self.made.get(left), self.made.get(right)
            if a is not None and (b is None or a[0] > b[0]):
                until, left = a[0], a[2]
            elif b is not None:
                until, right = b[0] + 1, b[1]
            else:
                return True

    def _apart(self, left: int, right: int) -> bool:
        pair = left << 20 | right
        found = self.apart.get(pair)
        if found is None:
            if len(self.apart) >= CACHE:
                self.apart.clear()
            found = self.apart[pair] = self._stay_apart(left, right)
        return found

    def piece_counts(self, pieces: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of the first 0, 1, ... bytes of each piece, best in sorted order."""
        back, whole, known = self.back.get, self.whole, self.apart.get
        previous, last, counts = b"", [0], [0]
        for piece in pieces:
            shared = 0
            for a, b in zip(previous, piece):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], counts[shared + 1 :]
            for end in range(shared + 1, len(piece) + 1):
                state, start, ending = 0, end, []
                while start:
                    state = back(state << 8 | piece[start - 1])
                    if state is None:
                        break
                    start -= 1
                    token = whole[state]
                    if token is not None:
                        ending.append((start, token))
                for start, token in reversed(ending):
                    if not start:
                        break
                    apart = known(last[start] << 20 | token)
                    if apart or (apart is None and self._apart(last[start], token)):
                        break
                last.append(token)
                counts.append(counts[start] + 1)
            previous = piece
            yield counts[:]

    def _cut(self, text: str) -> list[str]:
        return (_LATIN_PIECE if is_latin(text) else _PIECE).findall(text)

    def total(self, text: str) -> int:
        """Tokens of the whole text: the last of each piece's counts."""
        return self.total_and_within(text, None)[0]

    def within(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens, read off the counts."""
        return self.total_and_within(text, limit)[1]

    def total_and_within(self, text: str, limit: int | None) -> tuple[int, int]:
        """Both of one text; without a limit all its characters are within."""
        return next(self.totals_and_within([text], limit))

    def totals_and_within(self, texts: Iterable[str], limit: int | None) -> Iterator[tuple[int, int]]:
        """Both per text. New pieces of some texts are counted together, from one cut of each."""
        held, size = [], 0
        for text in texts:
            parts = self.vocabulary.split_special(text)
            held.append((text, [self._cut(part) for part in parts[::2]]))
            size += len(text)
            if size >= TOGETHER:
                yield from self._counted(held, limit)
                held, size = [], 0
        yield from self._counted(held, limit)

    def _counted(self, held: list[tuple[str, list[list[str]]]], limit: int | None) -> Iterator[tuple[int, int]]:
        self.pieces.learn({piece for _, cuts in held for pieces in cuts for piece in pieces})
        for text, cuts in held:
            totals = [list(map(_LAST, map(self.pieces.__getitem__, pieces))) for pieces in cuts]
            total = len(cuts) - 1 + sum(map(sum, totals))
            if limit is None or total <= limit:
                yield total, len(text)
            elif len(cuts) > 1:
                yield total, int(np.flatnonzero(self.prefix_counts(text) <= limit)[-1])
            else:
                yield total, self._within(text, cuts[0], totals[0], limit)

    def _within(self, text: str, pieces: list[str], totals: list[int], limit: int) -> int:
        """Characters of the longest prefix within a limit that the whole text passes.

        The prefixes to look at end in the piece that passes the limit, or in the
        run of blanks that it ends in or follows; all longer ones pass it too.
        """
        place = next(i for i, n in enumerate(accumulate(totals)) if n > limit)
        first = sum(map(len, pieces[:place]))
        at = first + len(pieces[place])
        while first and _BLANKS.match(text, first - 1):
            place -= 1
            first -= len(pieces[place])
        before = sum(totals[:place])
        run = _BLANKS.match(text, at) if _BLANKS.match(text, at - 1) else None
        counts = self._segment_counts(text[first : run.end() if run else at])
        return first + int(np.flatnonzero(before + np.array(counts) <= limit)[-1])

    def _segment_counts(self, text: str) -> list[int]:
        """Tokens of the first 0, 1, ... characters of a text without special strings.

        A prefix is cut into the same pieces as the text, but for its end:
        blanks at the end are one piece, and of 're, 've and 'll the first two
        characters alone are two pieces.
        """
        counts, total, starts = [0], 0, {}
        for match in _PIECE.finditer(text):
            piece = match.group()
            starts[match.start()] = total
            inner, at = self.pieces[piece], 0
            for i, c in enumerate(piece):
                at += len(c.encode())
                two = i == 1 and piece in ("'re", "'ve", "'ll")
                counts.append(total + (2 if two else inner[at]))
            total += inner[-1]
        for run in _BLANKS.finditer(text):
            inner, at = self.pieces[run.group()], 0
            for i, c in enumerate(run.group(), run.start() + 1):
                at += len(c.encode())
                counts[i] = starts[run.start()] + inner[at]
        return counts

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of the first 0, 1, ... characters of any text, each as if alone."""
        parts = self.vocabulary.split_special(text)
        counts = self._segment_counts(parts[0])
        total = counts[-1]
        for before, special, after in zip(parts[::2], parts[1::2], parts[2::2]):
            # Until it is whole, a special string is ordinary text after its segment.
            base = total - self.total(before)
            unfinished = self._segment_counts(before + special[:-1])
            counts += [base + c for c in unfinished[len(before) + 1 :]]
            total += 1
            following = self._segment_counts(after)
            counts += [total + c for c in following]
            total += following[-1]
        return np.array(counts, np.int32)


@lru_cache(maxsize=1)
def counter(spec: str) -> PrefixCounter:
    """One counter, with its memory of pieces, per Python worker."""
    return PrefixCounter(spec)


def _rows(spec, limit: int, prefixes: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = counter(spec.value)
        for rows in batches:
            texts = [t if isinstance(t, str) else "" for t in rows.pop("text")]
            found = np.array(list(own.totals_and_within(texts, limit)), np.int64).reshape(-1, 2)
            rows["n_tokens"], rows["within_limit"] = found[:, 0], found[:, 1]
            if prefixes:
                rows["prefix_counts"] = [own.prefix_counts(t) for t in texts]
            yield rows

    return run


def count_tokens(documents: DataFrame, spec_path: str, limit: int = LIMIT, prefixes: bool = False) -> DataFrame:
    """Token counts of whole texts: doc_id, n_bytes, n_tokens, over_limit, within_limit.

    ``documents`` needs doc_id and text; other columns are left out. The file
    at ``spec_path`` is a byte-level BPE of the tokenizers library; its special
    strings in a text are one token each, as is that library's default, and
    nothing is added at the ends. within_limit is the characters of the longest
    prefix of at most ``limit`` tokens. With ``prefixes`` there is also
    prefix_counts, the tokens of the first 0, 1, ... characters. Truncations and
    budgets are read off the counts of a piece's prefixes, without encoding again.

    One pass without a shuffle. A text may be of any length. Null or empty text:
    0 tokens. Null or repeated doc_ids: a row for each row. No rows: no rows.
    """
    spark = documents.sparkSession
    text_batches(spark)
    with open(spec_path, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    rows = documents.select("doc_id", n_bytes(F.col("text")).alias("n_bytes"), "text")
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, n_bytes long, n_tokens long, within_limit long"
    if prefixes:
        schema += ", prefix_counts array<int>"
    counted = rows.mapInPandas(_rows(spec, limit, prefixes), schema)
    counted = counted.withColumn("over_limit", F.col("n_tokens") > limit)
    more = ["within_limit", *(["prefix_counts"] if prefixes else [])]
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", *more)
