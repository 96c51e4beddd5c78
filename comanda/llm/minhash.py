"""MinHash near-duplicates with sequential Bayesian verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import stored, text_batches
from comanda.llm.components import components

WORDS = 5
# Jaccard similarity in hundredths, from which two texts are linked.
PERCENT = 80
BANDS, BAND_ROWS = 42, 6
HASHES = BANDS * BAND_ROWS
# A pair at the threshold is pruned wrongly with at most this probability a look.
MISS = 1e-7
# Hashes looked at in one step of the comparison.
STEP = 28
# Members of a bucket that are compared within one block, and rows of one task.
BLOCK = 2_048
TASK_ROWS = 8_192
# Bytes of the sets of one task.
TASK_BYTES = 24 << 20

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0xD6E8FEB86659FD93)
_FACTORS = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Shingles whose hashes are computed at once.
_CHUNK = 1 << 15

PAIR = "a binary, b binary"


def _scramble(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that lie end to end, A-Z taken as a-z.

    ``ends`` holds 0 and the end of each text; the second array does so for words.
    """
    inside = ~_IS_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    # A text's first letter starts a word whatever the text before ends with.
    first = ends[:-1][ends[:-1] < len(data)]
    starts[first] = inside[first]
    begin = np.flatnonzero(starts)
    stops = np.ones(len(data) + 1, bool)
    stops[:-1] = ~inside | starts
    stop = np.flatnonzero(stops)
    length = stop[np.searchsorted(stop, begin, side="right")] - begin
    order = np.argsort(-length, kind="stable")
    at_begin, longest = begin[order], -length[order]
    found = np.zeros(len(begin), np.uint64)
    # Letter by letter over all words that are long enough, the longest first.
    at, left = 0, len(begin)
    while left:
        part = (found[:left] + _BYTE[data[at_begin[:left] + at]]) * _MIX
        found[:left] = part ^ (part >> np.uint64(29))
        at += 1
        left = int(np.searchsorted(longest, -at, side="left"))
    hashes = np.empty(len(begin), np.uint64)
    hashes[order] = _scramble(found)
    return hashes, np.searchsorted(begin, ends)


def shingle_sets(data: np.ndarray, ends: np.ndarray, words: int) -> list[np.ndarray]:
    """Per text, the sorted hashes of its distinct runs of ``words`` words.

    A text with fewer words has its whole sequence as one; without words, none.
    """
    hashes, at = word_hashes(data, ends)
    found = np.full(max(0, len(hashes) - words + 1), words, np.uint64)
    for i in range(words):
        found = found * _PLACE + hashes[i : i + len(found)]
    found = _scramble(found)
    sets = []
    for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
        n = end - start
        if n >= words:
            sets.append(np.unique(found[start : end - words + 1]))
        elif n:
            whole = np.array([n], np.uint64)
            for i in range(start, end):
                whole = whole * _PLACE + hashes[i : i + 1]
            sets.append(_scramble(whole))
        else:
            sets.append(hashes[:0])
    return sets


def signatures(sets: list[np.ndarray]) -> list[bytes | None]:
    """For each set, the least of HASHES products over it, 16 mixed bits of each; none if empty."""
    blocks = [(i, s[at : at + _CHUNK]) for i, s in enumerate(sets) for at in range(0, len(s), _CHUNK)]
    out: list[bytes | None] = [None] * len(sets)
    least = np.empty((len(blocks), HASHES), np.uint64)
    first = 0
    while first < len(blocks):
        last, size = first, 0
        while last < len(blocks) and (last == first or size + len(blocks[last][1]) <= _CHUNK):
            size += len(blocks[last][1])
            last += 1
        part = np.concatenate([b for _, b in blocks[first:last]])
        edges = np.cumsum([0, *[len(b) for _, b in blocks[first : last - 1]]])
        for j, factor in enumerate(_FACTORS):
            least[first:last, j] = np.minimum.reduceat(part * factor, edges)
        first = last
    if blocks:
        owner = np.array([i for i, _ in blocks])
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        mixed = (_scramble(np.minimum.reduceat(least, heads, axis=0)) >> np.uint64(48)).astype("<u2")
        for i, row in zip(owner[heads].tolist(), mixed):
            out[i] = row.tobytes()
    return out


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of texts end to end, and where each ends; null is empty."""
    binary = column.fill_null("").cast(pa.large_string())
    _, offsets, data = binary.buffers()
    ends = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def _keys(data: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Per text, a 128-bit digest of its sequence of words."""
    raw = data.tobytes()
    texts = (raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))
    return [blake2b(b" ".join(t.lower().split()), digest_size=16).digest() for t in texts]


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _bytes_of(batch.column("text"))
            sets = shingle_sets(data, ends, words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("rid"),
                    pa.array(_keys(data, ends), pa.binary()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(signatures(sets), pa.binary()),
                ],
                ["doc_id", "rid", "key", "n_shingles", "signature"],
            )

    return run


def _sets(words: int):
    """Sets of the texts that have the key they were looked up for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _bytes_of(batch.column("text"))
            sets = [x.astype("<u8").tobytes() for x in shingle_sets(data, ends, words)]
            right = [a == b for a, b in zip(_keys(data, ends), batch.column("key").to_pylist())]
            found = pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], ["key", "shingles"])
            yield found.filter(pa.array(right, pa.bool_()))

    return run


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """Per number of hashes looked at, how many must agree for a pair to go on.

    With a uniform prior, the similarity after m of n hashes agreed is
    Beta(m + 1, n - m + 1). A pair goes on while the posterior probability of
    a similarity at or above the threshold is at least ``miss``. For whole
    numbers that probability is a binomial one: of at most m in n + 1 draws.
    """
    t = percent / 100

    def probability(m: int, n: int) -> float:
        return sum(math.comb(n + 1, i) * t**i * (1 - t) ** (n + 1 - i) for i in range(m + 1))

    return [next(m for m in range(n + 1) if probability(m, n) >= miss) for n in range(HASHES + 1)]


def _matrix(signatures: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), "<u2").reshape(len(signatures), HASHES)


def _surviving(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, needed: list[int], agreed=0, at=0):
    """Of the pairs (a, b) of rows, those no look at ever more hashes prunes."""
    agreed = np.broadcast_to(agreed, len(a)).astype(np.int64)
    while at < HASHES and len(a):
        agreed = agreed + (left[a, at : at + STEP] == right[b, at : at + STEP]).sum(1)
        at += STEP
        go_on = agreed >= needed[at]
        a, b, agreed = a[go_on], b[go_on], agreed[go_on]
    return a, b


def _bayes(percent: int, miss: float):
    needed = least_matches(percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_matrix(batch.column(c).to_pylist()) for c in ("sig_a", "sig_b"))
            every = np.arange(batch.num_rows)
            alive, _ = _surviving(left, right, every, every, needed)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return run


def _are_near(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the similarity; 100 * common >= percent * union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _compare_blocks(percent: int, miss: float):
    """Links between two blocks of a bucket, all blocks of a task in turn.

    A pair is compared in the first bucket that it shares. Pairs that survive
    the looks are confirmed on their sets, unless links of this task connect
    them already; so a task returns fewer links than it has members.
    """
    needed = least_matches(percent, miss)

    def tile(rows: pd.DataFrame, signed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        first, second = (np.flatnonzero(rows["block"] == rows[c]) for c in ("lower", "upper"))
        same = rows["lower"].iloc[0] == rows["upper"].iloc[0]
        band = int(rows["band"].iloc[0])
        low = np.unique(rows["low"].to_numpy(), return_inverse=True)[1]
        size, outside = rows["n_shingles"].to_numpy(), rows["outside"].to_numpy()
        for at in range(0, len(first), 128):
            strip = first[at : at + 128]
            wanted = (low[strip][:, None] != low[second][None, :]) & (outside[strip][:, None] | outside[second][None, :])
            # Sets so different in size can't reach the threshold.
            less = np.minimum(size[strip][:, None], size[second][None, :])
            more = np.maximum(size[strip][:, None], size[second][None, :])
            wanted &= 100 * less >= percent * more
            if same:
                wanted &= strip[:, None] < second[None, :]
            q, c = np.nonzero(wanted)
            for part in range(0, len(q), 1 << 16):
                a, b = strip[q[part : part + (1 << 16)]], second[c[part : part + (1 << 16)]]
                a, b = _surviving(signed, signed, a, b, needed)
                before = (signed[a, : band * BAND_ROWS] == signed[b, : band * BAND_ROWS]).reshape(len(a), band, BAND_ROWS)
                new = ~before.all(2).any(1)
                yield a[new], b[new]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parent: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        links = []
        for _, group in rows.groupby(["bucket", "lower", "upper"]):
            group = group.reset_index(drop=True)
            keys, lows = group["key"].tolist(), group["low"].tolist()
            sets = [np.frombuffer(x, "<u8") for x in group["shingles"]]
            for a, b in tile(group, _matrix(group["signature"].tolist())):
                for i, j in zip(a.tolist(), b.tolist()):
                    left, right = root(lows[i]), root(lows[j])
                    if left != right and _are_near(sets[i], sets[j], percent):
                        parent[max(left, right)] = min(left, right)
                        links.append((keys[i], keys[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype=object)

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = (np.frombuffer(x.as_buffer(), "<u8") for x in (left, right))
                keep.append(_are_near(a, b, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _pairs_with(pairs: DataFrame, table: DataFrame, column: str, left: str, right: str) -> DataFrame:
    """Put a column of both texts beside each pair."""
    for end, name in (("a", left), ("b", right)):
        pairs = pairs.join(table.select(F.col("key").alias(end), F.col(column).alias(name)), end)
    return pairs


def _confirmed(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    return _pairs_with(near, sets, "shingles", "set_a", "set_b").mapInArrow(_confirm(percent), PAIR)


def _links(members: DataFrame, signed: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links (a, b) that connect all that the similar pairs of any bucket connect.

    ``members`` has bucket, key and mates. First every bucket's member with most
    mates is compared with all others of it: no more pairs than members, however
    large the bucket, and copies of one text are mostly connected by that. Of
    the pairs left, only those not connected yet need a look, and each has an
    end outside its bucket's largest component. Buckets are cut into blocks, and
    two blocks meet, with their signatures and sets, in a task of bounded size,
    which returns only confirmed links; so no pairs are listed to be rejected.
    """
    size = F.col("n_shingles")
    listed = members.join(signed.select("key", "n_shingles"), "key")
    pivots = listed.groupBy("bucket").agg(F.max(F.struct("mates", "key", "n_shingles")).alias("first"))
    alike = 100 * F.least(size, F.col("first.n_shingles")) >= percent * F.greatest(size, F.col("first.n_shingles"))
    star = listed.join(pivots, "bucket").where((F.col("key") != F.col("first.key")) & alike)
    pairs = star.select(F.least("key", "first.key").alias("a"), F.greatest("key", "first.key").alias("b")).distinct()
    near = _pairs_with(pairs, signed, "signature", "sig_a", "sig_b").mapInArrow(_bayes(percent, miss), PAIR)
    links = stored(_confirmed(stored(near, "near"), sets, percent), "links")

    lows = components(links).select(F.col("node").alias("key"), F.col("low").alias("_low"))
    now = stored(
        members.join(lows, "key", "left").select("bucket", "band", "key", F.coalesce("_low", "key").alias("low")), "members"
    )
    parts = now.groupBy("bucket", "low").agg(F.count(F.lit(1)).alias("n"))
    buckets = parts.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "low")).alias("largest")
    )
    active = buckets.where("parts > 1").select(
        "bucket", F.col("largest.low").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = (
        now.join(active, "bucket")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", "band", "key", "low", "block", (F.col("low") != F.col("main")).alias("outside"),
            F.least("block", "other").alias("lower"), F.greatest("block", "other").alias("upper"),
        )
    )
    dealt = stored(dealt, "dealt")
    # Tasks are dealt by the bytes of their sets, of which long texts have many.
    whole = dealt.join(signed.select("key", "n_shingles"), "key").agg(F.count(F.lit(1)), F.sum("n_shingles")).first()
    tasks = max(1, -(-(whole[0] or 0) // TASK_ROWS), -(-8 * (whole[1] or 0) // TASK_BYTES))
    tiles = (
        dealt.join(signed.select("key", "n_shingles", "signature"), "key")
        .join(sets, "key")
        .withColumn("task", F.pmod(F.xxhash64("bucket", "lower", "upper"), F.lit(tasks)).cast("int"))
    )
    more = tiles.groupBy("task").applyInPandas(_compare_blocks(percent, miss), PAIR)
    return links.union(stored(more.distinct(), "links"))


def row_digest(documents: DataFrame):
    """A 64-bit digest that finds a row's text again; equal rows share it."""
    return F.xxhash64(documents["doc_id"], documents["text"])


def _grouped(documents: DataFrame, words: int, percent: int, miss: float) -> tuple[DataFrame, DataFrame]:
    """Signed rows (doc_id, rid, key, n_shingles, signature), and (key, least, low) of
    each node with words: its least doc_id, and the least key of its component."""
    text_batches(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    rows = documents.select("doc_id", row_digest(documents).alias("rid"), "text")
    signed = stored(
        rows.mapInArrow(_sign(words), f"doc_id {kind}, rid long, key binary, n_shingles long, signature binary"),
        "signed",
    )
    filled = signed.where("n_shingles > 0")
    nodes = stored(
        filled.groupBy("key").agg(
            F.min("doc_id").alias("least"), F.min("rid").alias("rid"),
            F.any_value("n_shingles").alias("n_shingles"), F.any_value("signature").alias("signature"),
        ),
        "nodes",
    )
    width = 2 * BAND_ROWS
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("signature", 1 + width * i, width)) for i in range(BANDS)])
    dealt = nodes.select("key", F.posexplode(bands).alias("band", "bucket")).repartition("bucket")
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(dealt.join(sizes, "bucket"), "shared")
    mates = shared.groupBy("key").agg(F.sum("n").alias("mates"))
    members = stored(shared.drop("n").join(mates, "key"), "members")
    wanted = members.select("key").distinct().join(nodes.select("key", "rid", "n_shingles", "signature"), "key")
    wanted = stored(wanted, "wanted")
    sets = stored(
        rows.join(wanted.select("key", "rid"), "rid")
        .select("key", "text")
        .mapInArrow(_sets(words), "key binary, shingles binary")
        .dropDuplicates(["key"]),
        "sets",
    )
    links = _links(members, wanted, sets, percent, miss)
    lows = components(links).select(F.col("node").alias("key"), "low")
    grouped = nodes.select("key", "least").join(lows, "key", "left").withColumn("low", F.coalesce("low", "key"))
    return signed, grouped


def near_duplicates(
    documents: DataFrame, words: int = WORDS, percent: int = PERCENT, miss: float = MISS
) -> DataFrame:
    """Components of near-equal documents: doc_id, rid, n_shingles, component_id, kept.

    ``documents`` needs doc_id and text; other columns are left out. Texts are
    compared as sets of runs of ``words`` words (A-Z small, cut at ASCII white
    space); a text with fewer words is one run of all of them. Two texts are
    linked if their sets' Jaccard similarity is at least ``percent`` hundredths.
    Each row comes back with the smallest doc_id reachable by links, its own
    included; kept tells whether that is its own. rid is ``row_digest``.

    Texts of equal words are one node, whatever their number. Each node has a
    MinHash signature, of which bands of hashes name buckets. Candidates of a
    bucket are compared signature batch by signature batch; a pair is dropped
    when the posterior probability that it reaches the threshold falls below
    ``miss``, and the others are confirmed on their full sets. A pair at the
    threshold shares no bucket with probability (1 - 0.8**6)**42 < 3e-6.

    Null, empty or blank text: no set, linked with nothing, a component of its
    own. Null doc_ids count as larger than all others, so a component of only
    such has the id null, and its rows are not kept apart (kept is null).
    Repeated rows each come back, with equal results. No rows: no rows.
    """
    signed, grouped = _grouped(documents, words, percent, miss)
    ids = grouped.groupBy("low").agg(F.min("least").alias("component_id"))
    by_key = stored(grouped.join(ids, "low").select("key", "component_id"), "components")
    found = signed.drop("signature").join(by_key, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", "rid", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def drop_near_duplicates(
    documents: DataFrame, words: int = WORDS, percent: int = PERCENT, miss: float = MISS
) -> DataFrame:
    """One document of each group of near-equal ones, with all its columns.

    Groups are the components of linked texts, whatever their doc_ids: texts that
    share a doc_id and aren't linked are of different groups, and those without
    one are of the group of their text. The row with the smallest doc_id stays,
    nulls last; among rows that share it, the one of the smallest digest, once.
    Documents without words all stay, but for repeats of one row.
    """
    signed, grouped = _grouped(documents, words, percent, miss)
    # Copies of a text are one row before they are joined.
    turn = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    texts = signed.where("n_shingles > 0").groupBy("key").agg(turn.alias("first"))
    first = texts.join(grouped.select("key", "low"), "key").groupBy("low").agg(F.min("first").alias("first"))
    blank = signed.where("n_shingles = 0").select("rid")
    left = first.select(F.col("first.rid").alias("_rid")).union(blank).distinct()
    # Equal rows share a digest; one of them is left.
    marked = documents.withColumn("_rid", row_digest(documents))
    stays = marked.join(left, "_rid", "left_semi")
    return stays.dropDuplicates(["_rid", "doc_id"]).select(*documents.columns)
