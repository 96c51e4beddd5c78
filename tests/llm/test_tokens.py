import hashlib
import random

import numpy as np
import pytest
from llm.helpers import DOCUMENTS, documents, tuples

from comanda.llm import bpe, token_counts

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

BYTE, WORD = str(public.path("byte_bpe_50k.json")), str(public.path("word_bpe_49k.json"))
PARTS = [
    *"abdeilrstv'  \n\t!.?12", "À", "é", "ß", "Σ", "日", "\U0001f642", "́", " ", " ",
    "İ", "'re", "'ll", "'ve", "<|endoftext|>", "<|startoftext|>", "don't", "the ",
]


def texts():
    draw = random.Random(5)
    made = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 40))) for _ in range(300)]
    return [*made, "", " ", "a" * 5000, "ab" * 3000, " " * 400, "'" * 60, "<|endoftext|>" * 3, "long text " * 4000]


def test_totals_and_prefixes_equal_the_library(spark):
    library = tokenizers.Tokenizer.from_file(BYTE)
    own = token_counts.PrefixCounter(open(BYTE, encoding="utf-8").read())

    def count(text):
        return len(library.encode(text, add_special_tokens=False).ids)

    for text in texts():
        assert own.total(text) == count(text), text[:60]
    for text in texts()[:60]:
        assert own.prefix_counts(text).tolist() == [count(text[:k]) for k in range(len(text) + 1)], text


def test_the_longest_prefix_within_a_limit_is_read_off_the_counts():
    own = token_counts.PrefixCounter(open(BYTE, encoding="utf-8").read())
    for text in texts()[:-1]:
        counts = own.prefix_counts(text)
        for limit in (0, 1, 2, 3, 5, 8, 17, 60):
            assert own.within(text, limit) == np.flatnonzero(counts <= limit)[-1], (text[:60], limit)


def test_new_pieces_are_counted_on_from_shared_bytes_and_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 40)
    own = token_counts.PrefixCounter(open(BYTE, encoding="utf-8").read())
    words = [a + b for a in ("fore", "forest", "\u00e9t", "\U0001f642\U0001f643", "x" * 300) for b in ("", "er", "ing", "\u00e9", "zq", "x")]
    alone = [next(own.piece_counts([w.encode()])) for w in words[:6]]
    own.pieces.learn(set(words))
    assert [list(own.pieces[w]) for w in words[:6]] == alone
    made, calls = texts(), []
    want = [own.total(t) for t in made]
    assert [n for n, _ in own.totals_and_within(made, 17)] == want
    assert [w for _, w in own.totals_and_within(made, 17)] == [own.within(t, 17) for t in made]
    # A piece that comes again and again is counted once, however many others pass.
    counts = own.pieces.counts
    own.pieces.counts = lambda pieces: counts([(calls.append(p), p)[1] for p in pieces])
    for i in range(100):
        assert own.total(f" often {i}\u00e9{i}") > 0
    assert calls.count(b" often") <= 1


def test_token_counts_of_a_table(spark):
    library = tokenizers.Tokenizer.from_file(BYTE)
    rows = [(i, t, "s") for i, t in enumerate(texts())] + [(None, "no id", "s"), (3, "twice", None), (3, "twice", None), (9000, None, "s")]
    found = token_counts.count_tokens(documents(spark, rows), BYTE, limit=50)
    want = []
    for i, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 50))
    assert tuples(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    short = [r for r in rows if r[1] is not None and len(r[1]) < 200]
    with_prefixes = token_counts.count_tokens(documents(spark, short), BYTE, limit=5, prefixes=True).collect()
    for r, (_, t, _) in zip(with_prefixes, short):
        assert len(r.prefix_counts) == len(t) + 1
        fits = [k for k, n in enumerate(r.prefix_counts) if n <= 5]
        assert r.within_limit == max(fits)
    assert token_counts.count_tokens(spark.createDataFrame([], DOCUMENTS), BYTE).count() == 0


def test_bpe_equals_the_library():
    library = tokenizers.Tokenizer.from_file(WORD)
    own = bpe.WordBPE(open(WORD, encoding="utf-8").read())
    for text, ids in zip(texts(), own.encode(texts())):
        want = library.encode(text, add_special_tokens=False).ids
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == want, text[:60]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_of_every_code_point_equals_the_library():
    library = tokenizers.Tokenizer.from_file(WORD)
    own = bpe.WordBPE(open(WORD, encoding="utf-8").read())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 5000):
        made = [f"x{c}1{c}?a" for c in points[at : at + 5000]]
        wanted = library.encode_batch(made, add_special_tokens=False)
        for text, ids, want in zip(made, own.encode(made), wanted):
            assert np.frombuffer(ids, "<i4").tolist() == want.ids, ascii(text)


def test_bpe_of_a_table(spark):
    library = tokenizers.Tokenizer.from_file(WORD)
    rows = [(i, t, "s") for i, t in enumerate(texts())] + [(None, "no id", "s"), (3, "twice", None), (3, "twice", None), (9000, None, "s")]
    docs = documents(spark, rows)
    encoded = bpe.encode(docs, WORD)
    assert [c for c in encoded.columns if c != "ids"] == [c for c in docs.columns if c != "text"]

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    assert tuples(bpe.digests(bpe.encode_decode(docs, WORD))) == sorted(want, key=repr)
    assert bpe.encode_decode(spark.createDataFrame([], DOCUMENTS), WORD).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(encoded.withColumnRenamed("lang", "text"), WORD)
