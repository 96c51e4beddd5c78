"""Byte-level BPE by ranks: overlapping chunks, stitched where their pre-tokens agree again."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.llm.byte_level import (
    BLANK,
    LATER_LETTERS,
    LATER_NUMBERS,
    LATIN_BLANK,
    LATIN_LETTER,
    LATIN_NUMBER,
    is_latin,
)
from comanda.llm.common import stored, text_batches

# Characters of a chunk, and how far it reads on into the next one.
CHUNK = 1 << 15
OVERLAP = 1 << 9
# A pre-token is settled by at most this many characters after its start or end.
_AHEAD = 3
# Pre-tokens whose ids a Python worker remembers; a cache, emptied when full.
CACHE = 150_000


def _pattern(blank: str, letter: str, number: str, other: str) -> str:
    """Contractions, words, numbers and signs with the blank before them, blanks."""
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+"
        rf"|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


_LATIN = re.compile(
    _pattern(LATIN_BLANK, f"[{LATIN_LETTER}]", f"[{LATIN_NUMBER}]", f"[^{LATIN_BLANK}{LATIN_LETTER}{LATIN_NUMBER}]")
)
_ANY = regex.compile(
    _pattern(
        BLANK,
        rf"[\p{{L}}--[{LATER_LETTERS}]]",
        rf"[\p{{N}}--[{LATER_NUMBERS}]]",
        rf"[[^{BLANK}\p{{L}}\p{{N}}]||[{LATER_LETTERS}{LATER_NUMBERS}]]",
    ),
    regex.V1,
)


def pre_tokens(text: str) -> list[str]:
    """The text cut into the parts that are encoded each for itself."""
    return (_LATIN if is_latin(text) else _ANY).findall(text)


class RankBPE:
    """Encodes pre-tokens and decodes ids by the ranks of byte strings."""

    def __init__(self, ranks_file: str):
        pairs = (line.split() for line in ranks_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: of all adjacent pairs the lowest rank merges first, leftmost.

        A heap holds the pairs that could merge, by rank and place; a pair of
        which a side has changed since is passed over. n log n in the length.
        """
        rank = self.ranks.get
        whole = rank(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        # Symbols by their first byte: where they end (0: merged into the one before), and who is before.
        ends, before = list(range(1, size + 1)), list(range(-1, size))
        heap = []
        for i in range(size - 1):
            r = rank(piece[i : i + 2])
            if r is not None:
                heap.append((r, i, i + 1, i + 2))
        heapq.heapify(heap)
        while heap:
            _, start, middle, end = heapq.heappop(heap)
            if ends[start] != middle or ends[middle] != end:
                continue
            ends[start], ends[middle] = end, 0
            if end < size:
                before[end] = start
                r = rank(piece[start : ends[end]])
                if r is not None:
                    heapq.heappush(heap, (r, start, end, ends[end]))
            front = before[start]
            if front >= 0:
                r = rank(piece[front:end])
                if r is not None:
                    heapq.heappush(heap, (r, front, start, end))
        found, at = [], 0
        while at < size:
            found.append(self.ranks[piece[at : ends[at]]])
            at = ends[at]
        return found

    def encode(self, pieces: Sequence[str]) -> bytes:
        """Ids of a row of pre-tokens, little-endian, four bytes each."""
        known, out = self.known, []
        if len(known) > CACHE:
            known.clear()
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = known[piece] = np.array(self.merge(piece.encode()), "<i4").tobytes()
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=1)
def rank_bpe(ranks_file: str) -> RankBPE:
    """One encoder, with its memory of pre-tokens, per Python worker."""
    return RankBPE(ranks_file)


def _id_lists(encoded: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, encoded)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), "<i4")))


def _encode_whole(ranks):
    """Texts of one chunk: nothing to stitch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rank_bpe(ranks.value)
        for batch in batches:
            encoded = [own.encode(pre_tokens(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _id_lists(encoded)], ["doc_id", "ids"])

    return run


_CHUNK = pa.schema(
    [("key", pa.string()), ("chunk", pa.int32()), ("size", pa.int32()), ("last", pa.bool_()), ("text", pa.string())]
)
_CUTS = "key string, chunk int, size int, last boolean, text string, cuts array<int>"


def _cut_chunks(chunk: int, overlap: int):
    """Chunks by place: the ``size`` characters that are its own, and those it reads on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for i, start in enumerate(range(0, len(text), chunk)):
                    row = {
                        "key": key,
                        "chunk": i,
                        "size": min(chunk, len(text) - start),
                        "last": start + chunk >= len(text),
                        "text": text[start : start + chunk + overlap + _AHEAD],
                    }
                    yield pa.RecordBatch.from_pylist([row], _CHUNK)

    return run


def _settled_cuts(text: str, last: bool) -> np.ndarray:
    """Where pre-tokens end when the text is read from its start, as far as no more text can change it."""
    ends = np.cumsum([0, *map(len, pre_tokens(text))])
    return ends[ends <= (len(text) if last else len(text) - _AHEAD)].astype(np.int32)


def _pre_tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("text").to_pylist(), batch.column("last").to_pylist())
        yield batch.append_column("cuts", pa.array([_settled_cuts(*r) for r in rows], pa.list_(pa.int32())))


def _glue(rows: pa.Table) -> pa.Table:
    """Chunks in a row between which no cuts agreed, as one chunk read anew; one alone stays."""
    rows = rows.drop_columns("run")
    if rows.num_rows == 1:
        return rows
    parts = rows.sort_by("chunk").to_pylist()
    text = "".join([*(p["text"][: p["size"]] for p in parts[:-1]), parts[-1]["text"]])
    one = {
        **parts[-1],
        "chunk": parts[0]["chunk"],
        "size": sum(p["size"] for p in parts),
        "text": text,
        "cuts": _settled_cuts(text, parts[-1]["last"]),
    }
    return pa.Table.from_pylist([one], rows.schema)


def _encode_chunk(ranks):
    """The ids of a chunk from its first to its last common cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rank_bpe(ranks.value)
        for batch in batches:
            parts = []
            columns = ("text", "cuts", "begin", "finish")
            for text, cuts, begin, finish in zip(*(batch.column(c).to_pylist() for c in columns)):
                inside = [c for c in cuts if begin <= c <= finish]
                parts.append(own.encode([text[a:b] for a, b in pairwise(inside)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("chunk"), pa.array(parts, pa.binary())], ["key", "chunk", "part"]
            )

    return run


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        encoded = [b"".join(part["part"] for part in parts) for parts in batch.column("parts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), _id_lists(encoded)], ["key", "ids"])


def _stitched(chunks: DataFrame, overlap: int) -> DataFrame:
    """key and chunk with begin, the first cut that it and the chunk before have both, and next, that of the next.

    Only what neighbours read in common goes into the window, of which a text
    has a few numbers a chunk.
    """
    order = Window.partitionBy("key").orderBy("chunk")
    head = F.filter("cuts", lambda c: c <= overlap)
    tail = F.transform(F.filter("cuts", lambda c: c >= F.col("size")), lambda c: c - F.col("size"))
    ends = chunks.select("key", "chunk", head.alias("head"), tail.alias("tail"))
    common = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    begun = ends.select("key", "chunk", F.when(F.col("chunk") == 0, 0).otherwise(common).alias("begin"))
    return begun.withColumns(
        {
            "next": F.lead("begin").over(order),
            "run": F.sum(F.col("begin").isNotNull().cast("int")).over(order),
        }
    )


def _encode_chunks(texts: DataFrame, ranks, chunk: int, overlap: int) -> DataFrame:
    """key and ids of every distinct text of rows (key, text), however long a text is.

    Chunks are dealt over all tasks and read from their starts. Two neighbours
    are stitched at the first place of the overlap at which both have a cut,
    since from a common cut on they cut alike. Where there is none, as in a
    pre-token longer than the overlap, the chunks are glued and read anew, until
    every chunk agrees with the one before.
    """
    cut = texts.mapInArrow(_cut_chunks(chunk, overlap), _CUTS.removesuffix(", cuts array<int>"))
    # Copies of a text are read once; whichever comes first is the same.
    apart = cut.groupBy("key", "chunk").agg(*[F.first(c).alias(c) for c in ("size", "last", "text")])
    chunks = stored(apart.mapInArrow(_pre_tokenise, _CUTS), "chunks")
    while True:
        stitched = stored(_stitched(chunks, overlap), "stitched")
        if stitched.where(F.col("begin").isNull()).isEmpty():
            break
        runs = chunks.join(stitched.select("key", "chunk", "run"), ["key", "chunk"])
        runs = runs.select(*chunks.columns, "run").groupBy("key", "run")
        chunks = stored(runs.applyInArrow(_glue, _CUTS), "chunks")
    finish = F.when(F.col("last"), F.length("text")).otherwise(F.col("next") + F.col("size"))
    rows = chunks.join(stitched.drop("run"), ["key", "chunk"]).select(
        "key", "chunk", "text", "cuts", "begin", finish.alias("finish")
    )
    parts = rows.mapInArrow(_encode_chunk(ranks), "key string, chunk int, part binary")
    joined = parts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("chunk", "part"))).alias("parts"))
    return joined.mapInArrow(_join_parts, "key string, ids array<int>")


def _broadcast(df: DataFrame, ranks_path: str):
    text_batches(df.sparkSession)
    with open(ranks_path, encoding="ascii") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(documents: DataFrame, ranks_path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Token ids of whole texts: doc_id and ids, a row for each row.

    The file at ``ranks_path`` has a token in base64 and its rank in each line.
    A text is cut into pre-tokens (contractions, words, numbers and signs with
    the blank before them, blanks), and each is encoded alone, without special
    tokens. Texts of more than ``chunk`` characters are read in chunks that
    other tasks may work on, each reading ``overlap`` characters on into the
    next, and stitched; other texts are their only chunk. Equal long texts are
    encoded once. A text and a pre-token may be of any length.

    Other columns are left out. Null or empty text: no ids. Null or repeated
    doc_ids: a row for each row. No rows: no rows.
    """
    if overlap + _AHEAD > chunk:
        raise ValueError("a chunk must be longer than what it reads on")
    ranks = _broadcast(documents, ranks_path)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, ids array<int>"
    short = rows.where(F.length("text") <= chunk).mapInArrow(_encode_whole(ranks), schema)
    long = rows.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    found = _encode_chunks(long.select("key", "text"), ranks, chunk, overlap)
    return short.unionByName(long.select("doc_id", "key").join(found, "key").select("doc_id", "ids"))


def _decode_rows(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rank_bpe(ranks.value)
        for batch in batches:
            column = batch.column("ids")
            values, ends = column.values.to_numpy(), column.offsets.to_numpy()
            texts = [own.decode(values[a:b].tolist()) for a, b in pairwise(ends)]
            yield batch.append_column("decoded", pa.array(texts, pa.binary()))

    return run


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Add decoded, the bytes of the tokens one after another; null ids: no bytes.

    A column named decoded that is there already is replaced.
    """
    encoded = encoded.drop("decoded")
    schema = ", ".join([*[f"`{c}` {t}" for c, t in encoded.dtypes], "decoded binary"])
    return encoded.mapInArrow(_decode_rows(_broadcast(encoded, ranks_path)), schema)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        values, ends = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
        columns = {
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array(np.diff(ends), pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in pairwise(ends)], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in batch.column("decoded").to_pylist()], pa.string()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian, four bytes) and of the decoded bytes."""
    schema = f"doc_id {dict(found.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return found.select("doc_id", "ids", "decoded").mapInArrow(_digest_rows, schema)
