import random

import numpy as np
import pytest
from llm.helpers import DOCUMENTS, components, documents, near_components, repeated, shingles, tuples

from comanda.llm import minhash, suffix_array, suffix_dedup
from comanda.llm.components import components as linked

VOCABULARY = [f"w{i}" for i in range(400)]


def prose(draw, n):
    return " ".join(draw.choice(VOCABULARY) for _ in range(n))


def edited(draw, text, edits):
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = draw.choice(VOCABULARY)
    return " ".join(words)


def corpus():
    """Copies, chains of edits, a large group around one text, short and blank texts."""
    draw = random.Random(3)
    texts = [prose(draw, draw.randint(30, 150)) for _ in range(60)]
    hot = prose(draw, 120)
    texts += [edited(draw, hot, 3) for _ in range(60)] + [hot] * 30
    drift = prose(draw, 100)
    for _ in range(40):
        drift = edited(draw, drift, 2)
        texts.append(drift)
    texts += [texts[0].upper(), texts[1].replace(" ", "\n\t "), "a b", "A  B", "a b c", "", " ", None, "x" * 30000, "Été a b c d"]
    draw.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_equal_brute_force(spark, words):
    texts = corpus()
    docs = documents(spark, [(i, t, "s") for i, t in texts.items()])
    found = minhash.near_duplicates(docs, words).collect()
    low = near_components(texts, words)
    want = [(i, len(shingles(t, words)), low[i], low[i] == i) for i, t in texts.items()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == want
    left = minhash.drop_near_duplicates(docs, words)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i in low if low[i] == i)


def test_blocks_of_a_bucket_find_the_same_links(spark, monkeypatch):
    """However small the blocks and tasks into which large buckets are cut."""
    texts = corpus()
    docs = documents(spark, [(i, t, "s") for i, t in texts.items()])
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "TASK_ROWS", 50)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 5).collect()}
    assert found == near_components(texts, 5)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (None, "a b c d e f", "s"), (None, "g h i j k", "s"), (2, "", "s"), (3, None, "s")]
    docs = documents(spark, rows)
    found = minhash.near_duplicates(docs, 5)
    assert tuples(found, "doc_id", "n_shingles", "component_id") == sorted(
        [(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (2, 0, 2), (3, 0, 3)], key=repr
    )
    assert tuples(minhash.drop_near_duplicates(docs, 5), "doc_id", "text") == sorted(
        [(1, "a b c d e f"), (None, "g h i j k"), (2, ""), (3, None)], key=repr
    )
    assert minhash.near_duplicates(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_pruning_rests_on_the_posterior():
    least = minhash.least_matches(80, 1e-7)
    assert least[0] == 0 and all(a <= b for a, b in zip(least, least[1:]))
    # 252 hashes of a pair at 0.8 agree 202 times on average, with deviation 6.3.
    assert 160 < least[252] < 185


def test_components_of_chains_and_stars(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 80)] + [(200, 200), (7, 7)]
    links += [(draw.randrange(300, 400), draw.randrange(300, 400)) for _ in range(60)]
    found = linked(spark.createDataFrame(links, "a long, b long"))
    links = [(a, b) for a, b in links if a != b]
    want = components({n for link in links for n in link}, links)
    assert tuples(found) == sorted(want.items(), key=repr)
    assert linked(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffix_arrays_and_common_prefixes():
    draw = np.random.default_rng(2)
    for n, texts, letters in ((1, 3, 2), (2, 4, 2), (50, 40, 2), (90, 30, 3), (200, 4, 1), (128, 20, 256)):
        data = draw.integers(0, letters, (texts, n)).astype(np.uint8)
        data[0, n // 2 :] = data[0, : n - n // 2]
        order = suffix_array.byte_suffix_arrays(data)
        common = suffix_array.permuted_common_prefixes(data, order, 20)
        for i in range(texts):
            raw = data[i].tobytes()
            assert order[:, i].tolist() == sorted(range(n), key=lambda j: raw[j:])
            for before, at in zip(order[:-1, i], order[1:, i]):
                padded = raw + bytes(40)
                same = next((k for k in range(20) if padded[at + k] != padded[before + k]), 20)
                assert common[i, at] == (20 if same == 20 else same // 8 * 8)


def passages(n):
    draw = random.Random(n)
    shared = [prose(draw, 60) for _ in range(3)]
    texts = []
    for i in range(n):
        text = prose(draw, draw.randint(5, 80))
        for passage in shared:
            if draw.random() < 0.6:
                cut = draw.randint(0, 60)
                text += " é" + passage[cut:] + prose(draw, draw.randint(0, 20))
        texts.append(text)
    return texts + [texts[0], texts[1], "", None, "ab" * 4000, "z" * 700, shared[0], "é" * 300]


@pytest.mark.parametrize("kinds, pilot", [((2, 4, 16, 64, 256), 64), ((2,), 64), ((2, 4, 16, 64, 256), 1)])
def test_removal_equals_brute_force(spark, monkeypatch, kinds, pilot):
    monkeypatch.setattr(suffix_dedup, "SHARD_BLOCKS", kinds)
    monkeypatch.setattr(suffix_dedup, "PILOT", pilot)
    draw = random.Random(1)
    header = prose(draw, 30)
    # A header in a third of the documents, with other words around it each time.
    framed = [prose(draw, 3) + header + prose(draw, 3) for _ in range(40)]
    texts = passages(40) + framed
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    found = sorted(suffix_dedup.remove_repeats(docs).collect(), key=lambda r: r.doc_id)
    for r, text, marks in zip(found, texts, repeated(texts, 100)):
        data = (text or "").encode()
        assert bytes(r.kept) == bytes(b for b, m in zip(data, marks) if not m)
        runs = [(a, b) for a, b in r.removed]
        assert sum(b - a for a, b in runs) == sum(marks)
        assert all(a[1] < b[0] for a, b in zip(runs, runs[1:]))
    shorter = suffix_dedup.drop_repeats(docs)
    assert shorter.columns == docs.columns and shorter.count() == len(texts)
    for r in shorter.collect():
        rest = bytes(b for b, m in zip((texts[r.doc_id] or "").encode(), repeated(texts, 100)[r.doc_id]) if not m)
        assert (r.text or "") == rest.decode("utf-8", "ignore") and (r.text is None) == (texts[r.doc_id] is None)


def test_frequent_keys_are_found_and_meet_their_equals_only(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 7L, id) gram", "id stretch", "id doc", "0L tie", "0 low", "1 windows", "0 back", "false sure")
    frequent = suffix_dedup._frequent(rows)
    assert [r.gram for r in frequent.collect()] == [7]
    found = suffix_dedup._classed(rows, frequent, "back")
    assert found.count() == found.select("gram").distinct().count() == 1001
    assert {r.many for r in found.collect()} == {suffix_dedup.SHARD_BLOCKS[-1] + 1}


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)
    texts = passages(12) + [" ".join(passages(12)[:10])]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    batch = docs.selectExpr("doc_id doc", "0L tie", "cast(coalesce(text, '') as binary) text").toArrow().to_batches()
    pieces = list(suffix_dedup._anchor_rows(100, 32)(iter(batch)))
    windows = sum(sum(p.column("windows").to_pylist()) for p in pieces)
    assert windows == sum(max(0, len((t or "").encode()) - 99) for t in texts)


def test_removal_of_odd_rows(spark):
    text = prose(random.Random(9), 40)
    rows = [(4, text, "s"), (4, text, "s"), (None, text, "s"), (7, "short", "s"), (4, "other " + text, "s")]
    found = suffix_dedup.digests(suffix_dedup.remove_repeats(documents(spark, rows))).collect()
    assert len(found) == 5
    assert {r.n_removed for r in found if r.doc_id is None} == {len(text)}
    whole = [r for r in found if r.doc_id == 4]
    # Of the two texts with one id, one is first; the repeated row is treated like it.
    assert sorted(r.n_removed for r in whole) in ([0, 0, len(text)], [0, len(text), len(text)])
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], DOCUMENTS)).count() == 0


@pytest.mark.parametrize("doc_id", [4, None])
def test_repeated_rows_keep_their_text(spark, doc_id):
    text = prose(random.Random(9), 40)
    docs = documents(spark, [(doc_id, text, "s")] * 2)
    assert tuples(suffix_dedup.drop_repeats(docs)) == tuples(docs)


def test_a_table_loaded_twice_keeps_what_it_keeps_once(spark):
    texts = passages(12)
    rows = [(i if i % 3 else None, t, "s") for i, t in enumerate(texts)]
    once = tuples(suffix_dedup.drop_repeats(documents(spark, rows)), "doc_id", "text")
    twice = tuples(suffix_dedup.drop_repeats(documents(spark, rows * 2)), "doc_id", "text")
    # A null id's repeated rows are one document as well, so copies come in twos.
    assert twice == sorted(once * 2, key=repr)


def test_texts_that_share_a_doc_id_are_not_one_group(spark):
    a, b, c = (prose(random.Random(i), 40) for i in range(3))
    rows = [(1, a, "s"), (1, b, "s"), (2, b + " end", "s"), (3, c, "s"), (1, c + " end", "s")]
    left = minhash.drop_near_duplicates(documents(spark, rows), 5)
    assert tuples(left, "doc_id", "text") == sorted([(1, a), (1, b), (1, c + " end")], key=repr)


def test_near_copies_without_ids_are_one_group(spark):
    a, b = (prose(random.Random(i), 40) for i in range(2))
    rows = [(None, t, "s") for t in (a, a + " end", a.upper(), a.replace(" ", "  "), a, b)] + [(None, "", "s"), (5, " ", "s")]
    left = [r.text for r in minhash.drop_near_duplicates(documents(spark, rows), 5).collect()]
    assert len(left) == 4 and {"", " ", b} < set(left)
