import zlib

import pytest
from llm.helpers import DOCUMENTS, WORD, documents, grouped, tuples

from comanda.llm import mixing, sharding

ROWS = (
    [(i, "w " * (i % 7) + "end", "a") for i in range(60)]
    + [(100 + i, "one two three", "b") for i in range(3)]
    + [(200 + i, " \t few\n", None) for i in range(2)]
    + [(300, None, "c"), (301, "", "c"), (None, "lost id", "a"), (5, "x y", "a"), (5, "x y", "a")]
    + [(400, "long " * 5000, "d")]
)


def words(text):
    return len(WORD.findall(text or ""))


def brute_targets(rows, weights=(5, 2, 1), epochs=3):
    sizes = {s: sum(words(r[1]) for r in rs) for s, rs in grouped(rows, lambda r: r[2]).items()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        rest = sum(sizes.values()) - sum(epochs * sizes[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped) or 1
        more = {s for s in order if s not in capped and rest * weight[s] > epochs * sizes[s] * share}
        if not more:
            return sizes, {s: float(epochs * sizes[s]) if s in capped else rest * weight[s] / share for s in order}
        capped |= more


def test_mix_meets_its_targets(spark):
    found = mixing.mix(documents(spark, ROWS)).collect()
    sizes, targets = brute_targets(ROWS)
    assert len(found) == len(ROWS)
    assert any(targets[s] == 3 * sizes[s] > 0 for s in sizes)
    for source, rows in grouped(found, lambda r: r.source).items():
        assert {r.source_size for r in rows} == {sizes[source]}
        assert all(r.target == pytest.approx(targets[source]) for r in rows)
        assert sum(r.taken for r in rows) == (int(targets[source]) if sizes[source] else 0)
        whole = int(targets[source]) // sizes[source] if sizes[source] else 0
        assert all(whole * r.size <= r.taken <= min(3, whole + 1) * r.size for r in rows)
    again = mixing.mix(documents(spark, ROWS[::-1]).repartition(5))
    assert tuples(again) == tuples(mixing.mix(documents(spark, ROWS)))


def test_mixed_texts_hold_the_taken_words(spark):
    rows = [r for r in ROWS if r[0] != 5]
    docs = documents(spark, rows)
    mixed = mixing.mix(docs)
    taken = {r.doc_id: r.taken for r in mixed.collect()}
    out = mixing.take_mix(docs, mixed)
    assert out.columns == docs.columns
    texts = {i: t for i, t, _ in rows}
    for doc, copies in grouped(out.collect(), lambda r: r.doc_id).items():
        assert sum(words(r.text) for r in copies) == taken[doc]
        assert all((texts[doc] or "").startswith(r.text or "") for r in copies)
        assert all(r.n_chars == len(r.text) for r in copies if r.text is not None)


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert mixing.mix(empty).count() == 0
    assert mixing.take_mix(empty, mixing.mix(empty)).count() == 0
    blank = documents(spark, [(1, None, "a"), (2, "", None)])
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]


def test_shards_are_contiguous_and_even(spark):
    found = sharding.shard_documents(documents(spark, ROWS), 6).collect()
    texts = grouped(ROWS, lambda r: r[0])
    assert len(found) == len(ROWS)
    for r in found:
        assert (r.size, r.text_crc32) in {
            (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _ in texts[r.doc_id]
        }
    order = sorted(found, key=lambda r: (r.doc_id is None, r.doc_id, r.text_crc32))
    assert [r.shard for r in order] == sorted(r.shard for r in found)
    for rows in grouped(order, lambda r: r.shard).values():
        assert [r.slot for r in rows] == list(range(len(rows)))
    whole, before = sum(r.size for r in found), 0
    for r in order:
        assert r.shard == min(5, (2 * before + r.size) * 6 // (2 * whole))
        before += r.size


def test_shard_files_hold_the_texts(spark, tmp_path):
    docs = documents(spark, ROWS)
    sharding.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert tuples(back, *docs.columns) == tuples(docs)
    assert sharding.shard_documents(spark.createDataFrame([], DOCUMENTS)).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(docs.withColumnRenamed("size", "slot"), ["doc_id"], "n_chars")
