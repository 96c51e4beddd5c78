"""Removal of long stretches that occur earlier, by sharded suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.llm import bloom
from comanda.llm.anchors import PIECE, doubled_hashes, scramble, stretch_hash, window_choices
from comanda.llm.common import stored, text_batches
from comanda.llm.suffix_array import byte_suffix_arrays, permuted_common_prefixes

LENGTH = 100
# Bytes of a gram; a power of two below LENGTH.
GRAM = 32
# Windows of a territory that are settled together, where all of it can't be.
BLOCK = 16
# Kinds of shards, by the blocks of one core that they take; beyond the last,
# windows are dealt singly. Bytes of all shards of one task, which are of one kind.
SHARD_BLOCKS = (2, 4, 16, 64, 256)
TASK_BYTES = 1 << 20
# One document in so many tells which keys are frequent. This steers how rows are
# dealt over tasks; results don't depend on it.
PILOT = 64
# Largest filter of document ids that is handed to tasks.
FILTER_BITS = 1 << 28

_ODD = np.uint64(0x9E3779B97F4A7C15)
_WHO = "doc long, tie long"
_SPAN = f"{_WHO}, start int, end int"


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column end to end, and where each value ends; null is empty."""
    binary = column.fill_null(b"").cast(pa.large_binary())
    _, offsets, data = binary.buffers()
    ends = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def territories(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, stretch hash, place, first and last window) per gram of texts end to end.

    Every window of ``length`` bytes belongs to the gram of least hash in it; the
    windows of one gram's occurrence follow each other and are its territory.
    Equal windows belong to equal grams at equal offsets.
    """
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    levels = doubled_hashes(data, 256)
    grams = scramble(levels[gram.bit_length() - 1])
    chosen = window_choices(grams, length - gram + 1)
    own_end = np.repeat(ends[1:], np.diff(ends))[: len(chosen)]
    windows = np.flatnonzero(np.arange(len(chosen)) + length <= own_end)
    chosen = chosen[windows]
    new = np.ones(len(chosen), bool)
    new[1:] = chosen[1:] != chosen[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(chosen))[: len(first)] - 1
    place, low, high = chosen[first], windows[first], windows[last]
    size = high - low + length
    stretch = np.empty(len(place), np.uint64)
    for n in np.unique(size).tolist():
        of = np.flatnonzero(size == n)
        stretch[of] = stretch_hash(levels, low[of], n)
    stretch = scramble(stretch + (place - low).astype(np.uint64) * _ODD)
    return grams[place], stretch, place, low, high


def _pieces(data: np.ndarray, ends: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch of bounded size: bytes, ends, text and offset of each part.

    A text above the bound comes in pieces that overlap by less than a window,
    so that each window is in one of them.
    """
    cuts = []
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        if b - a >= length:
            cuts += [(i, at - a, at, min(b, at + PIECE + length - 1)) for at in range(a, b - length + 1, PIECE)]
    at = 0
    while at < len(cuts):
        end, size = at, 0
        while end < len(cuts) and (end == at or size + cuts[end][3] - cuts[end][2] <= PIECE):
            size += cuts[end][3] - cuts[end][2]
            end += 1
        part = cuts[at:end]
        yield (
            np.concatenate([data[a:b] for _, _, a, b in part]),
            np.cumsum([0, *[b - a for _, _, a, b in part]]),
            np.array([i for i, _, _, _ in part]),
            np.array([offset for _, offset, _, _ in part]),
        )
        at = end


def _decided(key: np.ndarray, stretch: np.ndarray, doc: np.ndarray, tie: np.ndarray, low: np.ndarray):
    """(key, sure): rows with an earlier equal one in the batch are sure to be repeated.

    They need no company any more, so their key is replaced by a random one:
    copies of one text by the thousand don't meet in one task.
    """
    both = scramble(key) ^ stretch
    order = np.lexsort((low, tie, doc, both))
    again = both[order][1:] == both[order][:-1]
    sure = np.zeros(len(both), bool)
    sure[order[1:][again]] = True
    dealt = scramble(key + scramble(doc.astype(np.uint64) + low.astype(np.uint64) * _ODD))
    return np.where(sure, dealt, key), sure


def _anchor_rows(length: int, gram: int):
    """gram, stretch, doc, tie, low, windows, back, sure; back: bytes from low to the gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _buffers(batch.column("text"))
            docs, ties = (batch.column(c).to_numpy() for c in ("doc", "tie"))
            parts = []
            for piece, piece_ends, text, offset in _pieces(data, ends, length):
                grams, stretch, place, low, high = territories(piece, piece_ends, length, gram)
                owner = np.searchsorted(piece_ends, low, side="right") - 1
                at = low - piece_ends[owner] + offset[owner]
                parts.append((grams, stretch, text[owner], at, high - low + 1, place - low))
            if not parts:
                continue
            grams, stretch, text, low, windows, back = map(np.concatenate, zip(*parts))
            doc, tie = docs[text], ties[text]
            grams, sure = _decided(grams, stretch, doc, tie, low)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grams.view(np.int64)),
                    pa.array(stretch.view(np.int64)),
                    pa.array(doc),
                    pa.array(tie),
                    pa.array(low.astype(np.int32)),
                    pa.array(windows.astype(np.int32)),
                    pa.array(back.astype(np.int32)),
                    pa.array(sure),
                ],
                ["gram", "stretch", "doc", "tie", "low", "windows", "back", "sure"],
            )

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(bytes, doc, tie, low, windows, gram's distance) of stretches of texts.

    A stretch runs from a text's first wanted territory on and is of bounded
    length; places in it count from its own start, which is returned as well.
    """
    docs, ties = (batch.column(c).to_numpy() for c in ("doc", "tie"))
    for text, places, doc, tie in zip(batch.column("text"), batch.column("places"), docs, ties):
        rows = places.values
        columns = [rows.field(c).to_numpy() for c in ("low", "windows", "back")]
        order = np.argsort(columns[0], kind="stable")
        low, windows, back = (c[order] for c in columns)
        raw = np.frombuffer(text.as_buffer(), np.uint8)
        at = 0
        while at < len(low):
            end = int(np.searchsorted(low, low[at] + PIECE, side="left"))
            yield raw, doc, tie, *(c[at:end].astype(np.int64) for c in (low, windows, back))
            at = end


def _block_rows(length: int, gram: int):
    """Territories cut at fixed distances from their gram, keyed by what their windows share.

    The windows of a block start BLOCK places or fewer apart, so all of them
    hold the same bytes in the middle, the core. Equal windows have equal cores
    at equal distances, so blocks need only meet under equal cores; the windows
    of most blocks around which texts differ are settled by that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for raw, doc, tie, low, windows, back in _slices(batch):
                start, stop = int(low[0]), int((low + windows).max()) + length - 1
                piece = raw[start:stop]
                levels = doubled_hashes(piece, 128)
                # Distances of a territory's windows to its gram, and the blocks they span.
                far, near = back, back - windows + 1
                n = far // BLOCK - near // BLOCK + 1
                of = np.repeat(np.arange(len(low)), n)
                block = near[of] // BLOCK + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                place = (low + back)[of]
                begin = place - np.minimum(far[of], block * BLOCK + BLOCK - 1)
                count = place - np.maximum(near[of], block * BLOCK) - begin + 1
                core = stretch_hash(levels, place - block * BLOCK - start, length - BLOCK + 1)
                grams = stretch_hash(levels, place - start, gram)
                key = scramble(core + scramble(grams + block.astype(np.uint64) * _ODD))
                size = count + length - 1
                stretch = np.empty(len(of), np.uint64)
                for m in np.unique(size).tolist():
                    rows = np.flatnonzero(size == m)
                    stretch[rows] = stretch_hash(levels, begin[rows] - start, m)
                stretch = scramble(stretch + (place - begin).astype(np.uint64) * _ODD)
                cut = piece.tobytes()
                texts = [cut[a : a + m] for a, m in zip((begin - start).tolist(), size.tolist())]
                parts.append((key, stretch, np.full(len(of), doc), np.full(len(of), tie), begin, count, np.array(texts, object)))
            if not parts:
                continue
            key, stretch, doc, tie, low, windows, texts = map(np.concatenate, zip(*parts))
            key, sure = _decided(key, stretch, doc, tie, low)
            texts[sure] = None
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(stretch.view(np.int64)),
                    pa.array(doc),
                    pa.array(tie),
                    pa.array(low.astype(np.int32)),
                    pa.array(windows.astype(np.int32)),
                    pa.array(sure),
                    pa.array(texts, pa.binary()),
                ],
                ["gram", "stretch", "doc", "tie", "low", "windows", "sure", "bytes"],
            )

    return run


def _spans(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> pd.DataFrame:
    """Runs of window starts that follow each other in a group, as byte spans."""
    if not len(start):
        return pd.DataFrame({c: np.empty(0, np.int64) for c in ("doc", "tie", "start", "end")})
    new = np.ones(len(start), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return pd.DataFrame({"doc": doc[first], "tie": tie[first], "start": start[first], "end": start[last] + length})


def _repeats(rows: pd.DataFrame, shard: np.ndarray, n: int, length: int) -> pd.DataFrame:
    """Windows of shards of ``n`` bytes that an earlier row of the shard has too.

    ``shard`` is the shard of each row.
    """
    sizes = rows["size"].to_numpy()
    texts = int(shard[-1]) + 1
    used = np.bincount(shard, weights=sizes, minlength=texts).astype(np.int64)
    # Texts stand at the end of their row of bytes; what stands before is no window.
    before = np.cumsum(sizes) - sizes
    head = np.concatenate([[True], shard[1:] != shard[:-1]])
    inside = before - np.repeat(before[head], np.diff(np.append(np.flatnonzero(head), len(shard))))
    begin = inside + n - used[shard]
    data = np.full((texts, n), 255, np.uint8)
    joined = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    spread = np.repeat(shard * n + begin - before, sizes) + np.arange(len(joined))
    data.ravel()[spread] = joined
    order = byte_suffix_arrays(data)
    common = permuted_common_prefixes(data, order, length)
    windows = rows["windows"].to_numpy()
    is_window = np.zeros(texts * n, bool)
    owner_of = np.zeros(texts * n, np.int64)
    at = np.repeat(shard * n + begin - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    is_window[at] = True
    owner_of[at] = np.repeat(np.arange(len(rows)), windows)
    # Suffixes of which each shares ``length`` bytes with the one before are a class.
    turned = order.T + np.arange(texts)[:, None] * n
    starts_class = common.ravel()[turned] < length
    starts_class[:, 0] = True
    heads = np.flatnonzero(starts_class.ravel())
    place = turned.ravel()
    valued = np.where(is_window[place], place, texts * n)
    # Territories lie in the order of documents, so the least place is the earliest.
    earliest = np.repeat(np.minimum.reduceat(valued, heads), np.diff(np.append(heads, len(place))))
    again = np.sort(place[is_window[place] & (place != earliest)])
    who = owner_of[again]
    start = rows["low"].to_numpy()[who] + again - (shard * n + begin)[who]
    return _spans(rows["doc"].to_numpy()[who], rows["tie"].to_numpy()[who], start, who, length)


def _shards(length: int):
    """Pack the blocks of whole cores into shards of one length, and find repeats in each."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["gram", "doc", "tie", "low"], ignore_index=True)
        rows["size"] = rows["bytes"].map(len)
        grams = rows["gram"].to_numpy()
        head = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        bound = int(rows["kind"].iloc[0]) * (length + BLOCK - 1)
        shard_of, shard, filled = np.empty(len(head), np.int64), 0, 0
        for i, s in enumerate(np.add.reduceat(rows["size"].to_numpy(), head).tolist()):
            if filled and filled + s > bound:
                shard, filled = shard + 1, 0
            shard_of[i] = shard
            filled += s
        shards = np.repeat(shard_of, np.diff(np.append(head, len(rows))))
        return _repeats(rows, shards, bound, length)

    return run


def _single_windows(length: int):
    """Each window of a territory by itself; those met in the batch before are decided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _buffers(batch.column("bytes"))
            columns = {c: batch.column(c).to_numpy() for c in ("doc", "tie", "low", "windows")}
            windows = columns["windows"].astype(np.int64)
            owner = np.repeat(np.arange(len(windows)), windows)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            levels = doubled_hashes(data, 128)
            one = stretch_hash(levels, ends[owner] + inner, length)
            # A second digest from the halves the other way round.
            two = scramble(stretch_hash(levels, ends[owner] + inner + length // 2, length - length // 2) * _ODD)
            two = scramble(two ^ stretch_hash(levels, ends[owner] + inner, length // 2))
            doc, tie, start = columns["doc"][owner], columns["tie"][owner], columns["low"][owner] + inner
            order = np.lexsort((start, tie, doc, two, one))
            again = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            sure = np.zeros(len(one), bool)
            sure[order[1:][again]] = True
            one = np.where(sure, scramble(one + scramble(doc.astype(np.uint64) + start.astype(np.uint64) * _ODD)), one)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(doc), pa.array(tie),
                 pa.array(start.astype(np.int32)), pa.array(sure)],
                ["one", "two", "doc", "tie", "start", "sure"],
            )

    return run


def _keep_rest(decode: bool):
    """kept and removed of each text from its spans, in any order and overlapping."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _kept_of(batch, decode)

    return run


def _kept_of(batch: pa.RecordBatch, decode: bool) -> pa.RecordBatch:
    kept, removed = [], []
    for text, spans in zip(batch.column("text"), batch.column("spans")):
        raw, rows = text.as_buffer().to_pybytes(), spans.values
        start, end = (rows.field(c).to_numpy().astype(np.int64) for c in ("start", "end"))
        order = np.argsort(start, kind="stable")
        start, end = start[order], np.maximum.accumulate(end[order])
        new = np.ones(len(start), bool)
        new[1:] = start[1:] > end[:-1]
        first = np.flatnonzero(new)
        runs = list(zip(start[first].tolist(), end[np.append(first, len(start))[1:] - 1].tolist()))
        cuts = [0, *[x for run in runs for x in run], len(raw)]
        rest = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
        kept.append(rest.decode("utf-8", "ignore") if decode else rest)
        removed.append([{"start": a, "end": b} for a, b in runs])
    names = [c for c in batch.schema.names if c not in ("text", "spans")]
    runs_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in names], pa.array(kept, pa.string() if decode else pa.binary()), pa.array(removed, runs_type)],
        [*names, "kept", "removed"],
    )


def _with_order(documents: DataFrame) -> tuple[DataFrame, bool]:
    """Add doc and tie, which order the rows: doc_id, null last; the text, for equal ones.

    Also returns whether any doc_id is repeated; if not, all rows differ in doc.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    ids = documents.groupBy(doc.alias("doc")).agg(F.count(F.lit(1)).alias("n"))
    repeated = not ids.where("n > 1").isEmpty()
    tie = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    return documents.withColumn("doc", doc).withColumn("tie", tie), repeated


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, tie, start, end): byte spans that together cover all repeated stretches.

    ``documents`` has doc, tie and text (binary). Spans may overlap and repeat.
    """
    documents = documents.select("doc", "tie", "text")
    chosen = F.pmod(F.xxhash64("doc", "tie"), F.lit(PILOT)) == 0
    pilot = documents.where(chosen)

    def anchors(of: DataFrame) -> DataFrame:
        return of.mapInArrow(
            _anchor_rows(length, gram),
            f"gram long, stretch long, {_WHO}, low int, windows int, back int, sure boolean",
        )

    placed = stored(_classed(anchors(documents), _frequent(anchors(pilot)), "back"), "territories")
    unsure = placed.where("not covered")
    near = _only(documents, unsure, 5)

    def blocks_of(of: DataFrame, territories: DataFrame) -> DataFrame:
        places = territories.groupBy("doc", "tie").agg(F.collect_list(F.struct("low", "windows", "back")).alias("places"))
        return of.join(places, ["doc", "tie"]).select("doc", "tie", "text", "places").mapInArrow(
            _block_rows(length, gram),
            f"gram long, stretch long, {_WHO}, low int, windows int, sure boolean, bytes binary",
        )

    frequent = _frequent(blocks_of(pilot, unsure.where(chosen)).drop("bytes"))
    found = _classed(blocks_of(near, unsure), frequent, "bytes")
    blocks = stored(found.withColumn("bytes", F.expr("if(covered, null, bytes)")), "blocks")

    # What equals an earlier one is repeated throughout.
    end = F.col("low") + F.col("windows") + F.lit(length - 1)
    span = ["doc", "tie", F.col("low").alias("start"), end.alias("end")]
    covered = placed.where("covered").select(*span).union(blocks.where("covered").select(*span))

    open_blocks = blocks.where("not covered")
    # The bytes of a core are bounded by its blocks, and the kind of shard by those.
    kind = F.lit(None).cast("int")
    for blocks_of_core in reversed(SHARD_BLOCKS):
        kind = F.when(F.col("many") <= blocks_of_core, F.lit(blocks_of_core)).otherwise(kind)
    few = open_blocks.withColumn("kind", kind).where("kind is not null")
    # One row per kind.
    sizes = few.groupBy("kind").agg(F.sum(F.octet_length("bytes")).alias("n")).collect()
    dealt = {row["kind"]: -(-row["n"] // TASK_BYTES) for row in sizes}
    task, tasks = F.lit(0).cast("long"), 0
    for k, n in dealt.items():
        task = F.when(F.col("kind") == k, F.lit(tasks) + F.pmod(F.xxhash64("gram"), F.lit(n))).otherwise(task)
        tasks += n
    parts = few.withColumn("task", task).repartition(max(1, tasks), "task")
    in_shards = parts.groupBy("task").applyInPandas(_shards(length), _SPAN)

    singles = open_blocks.where(F.col("many") > SHARD_BLOCKS[-1])
    windows = singles.select("doc", "tie", "low", "windows", "bytes").mapInArrow(
        _single_windows(length), f"one long, two long, {_WHO}, start int, sure boolean"
    )
    alone = Window.partitionBy("one", "two").orderBy("doc", "tie", "start")
    again = windows.withColumn("nth", F.row_number().over(alone)).where("nth > 1 or sure")
    dealt_singly = again.select("doc", "tie", "start", (F.col("start") + length).alias("end"))
    return covered.union(stored(in_shards, "spans")).union(stored(dealt_singly, "spans"))


def _frequent(rows: DataFrame) -> DataFrame:
    """Keys (gram) of a pilot that would fill a good part of a task, were a key one task's.

    At most four a shuffle partition, as each has that share of the pilot's rows.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "pilot")
    whole = counts.agg(F.sum("n")).first()[0] or 0
    return stored(counts.where(F.col("n") > max(8, whole / (4 * partitions))).select("gram"), "frequent")


def _classed(rows: DataFrame, frequent: DataFrame, *more: str) -> DataFrame:
    """Territories or blocks that an equal one precedes (covered), and those that
    share their key with ``many`` different ones; what is alone is left out.

    Rows of ``frequent`` keys meet their equals only, not all of their key: these
    have company in any case, and count as more than a shard takes.
    """
    turn = ["doc", "tie", "low"]
    marked = rows.join(F.broadcast(frequent.withColumn("hot", F.lit(True))), "gram", "left")
    marked = marked.withColumn("hot", F.col("hot").isNotNull() & ~F.col("sure"))
    marked = marked.withColumn("gram", F.when(F.col("hot"), F.xxhash64("gram", "stretch")).otherwise(F.col("gram")))
    by_key = Window.partitionBy("gram").orderBy(*turn)
    alike = Window.partitionBy("gram", "stretch").orderBy(*turn)
    # Most keys occur once: they go before anything is gathered.
    company = F.lag("doc").over(by_key).isNotNull() | F.lead("doc").over(by_key).isNotNull()
    shared = marked.withColumn("_company", company).where("_company or sure or hot")
    first = (F.col("nth") == 1).cast("int")
    variants = F.sum(first).over(Window.partitionBy("gram"))
    return (
        shared.withColumn("nth", F.row_number().over(alike))
        .withColumn("many", F.when(F.col("hot"), F.lit(SHARD_BLOCKS[-1] + 1).cast("long")).otherwise(variants))
        .withColumn("covered", F.col("sure") | (F.col("nth") > 1))
        .where("covered or many > 1")
        .select("gram", *turn, "windows", "many", "covered", *more)
    )


def _only(documents: DataFrame, wanted: DataFrame, seed: int, hit: bool = True) -> DataFrame:
    """Rows whose doc may be wanted, by a filter of bounded size; with hit=False, the rest."""
    keys = wanted.select(F.col("doc").alias("key")).distinct()
    n = max(1, keys.count())
    inside = bloom.passes(F.col("doc"), bloom.build(keys, n, 0.01, seed, FILTER_BITS))
    return documents.where(inside if hit else ~inside)


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, decode: bool = False
) -> DataFrame:
    """Texts without the stretches that occur earlier: the columns of ``documents``
    but text, with doc, tie, n_bytes, kept (bytes) and removed (list of start, end).
    With ``decode``, kept is a string, without characters of which a part went.

    Texts are UTF-8 bytes, null as none. A byte goes if a string of ``length``
    bytes that covers it also starts earlier: in a smaller doc_id, or further in
    front in the same document. Strings are judged on the input, overlaps count,
    and none crosses documents. removed lists maximal runs in order.

    Every window of ``length`` bytes belongs to the gram of least hash within
    it, so equal windows meet under equal grams, wherever they stand. Grams that
    occur once are dropped after one shuffle of their places. The windows of a
    gram's occurrence, its territory, are all repeated if an earlier occurrence
    has the same bytes around. Territories that differ are cut into blocks of
    windows, which meet under the bytes that a block's windows share; equal
    blocks are settled alike. Blocks that differ at their ends are put into
    shards, of which suffix arrays by induced sorting and permuted common
    prefixes show the classes of equal windows. Where very many different blocks
    share their middle, they would outgrow a shard; their windows are dealt out
    one by one. Stretches and windows are taken as equal when two 64-bit digests
    agree.

    Null doc_ids come last. Rows with one doc_id are in the order of a digest of
    their texts; rows equal in both are one document, repeated: none of them is
    earlier than another, and each comes back with what the document keeps. No
    rows: no rows. The names doc, tie, n_bytes, kept and removed must be free.
    """
    taken = {"doc", "tie", "n_bytes", "kept", "removed", "spans"} & set(documents.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} must be free")
    text_batches(documents.sparkSession)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows, repeated = _with_order(documents.withColumn("text", raw))
    distinct = rows.where(F.octet_length("text") >= length).select("doc", "tie", "text")
    if repeated:
        # A repeated row must not meet itself, or all its copies would lose what they share.
        distinct = stored(distinct.dropDuplicates(["doc", "tie"]), "distinct")
    spans = repeated_spans(distinct, length, gram)
    grouped = stored(
        spans.distinct().groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "by_doc"
    )
    sized = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    keys = grouped.select(F.col("doc").alias("key")).distinct()
    inside = bloom.passes(F.col("doc"), bloom.build(keys, max(1, grouped.count()), 0.01, 7, FILTER_BITS))
    none = F.array().cast("array<struct<start:int,end:int>>")
    columns = [c for c in documents.columns if c != "text"]
    out = [*columns, "doc", "tie", "n_bytes"]
    met = sized.where(inside).join(grouped, ["doc", "tie"], "left").select(*out, "text", F.coalesce("spans", none).alias("spans"))
    kinds, kind = dict(met.dtypes), "string" if decode else "binary"
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in out], f"kept {kind}, removed array<struct<start:int,end:int>>"])
    changed = met.mapInArrow(_keep_rest(decode), schema)
    return changed.union(sized.where(~inside).select(*out, F.col("text").cast(kind).alias("kept"), none.alias("removed")))


def drop_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``documents`` with shorter texts: all rows and columns, n_chars to match if there.

    Null texts stay null. Of a character that is partly removed nothing is left.
    """
    found = remove_repeats(documents.withColumn("_null", F.col("text").isNull()), length, decode=True)
    changed = F.size("removed") > 0
    out = found.withColumn("text", F.when(~F.col("_null"), F.col("kept")))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of what is kept."""
    return found.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
