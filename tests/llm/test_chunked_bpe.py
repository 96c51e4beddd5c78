import base64
import hashlib
import random
import struct

import pytest
from llm.helpers import DOCUMENTS, documents, tuples
from pyspark.sql import functions as F

from comanda.llm import chunked_bpe

public = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

RANKS = str(public.path("byte_bpe_multi_50k.tiktoken"))
PARTS = [
    *"abdeilrstv'  \n\t!.?12", "À", "é", "ß", "Σ", "日", "\U0001f642", "́", " ", " ",
    "՘", "\U000323b0", "İ", "'re", "'ll", "'ve", "<|endoftext|>", "don't", "the ", "Привет",
]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(RANKS, encoding="ascii") as file:
        return chunked_bpe.RankBPE(file.read())


def texts(count=200, length=40):
    draw = random.Random(7)
    made = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, length))) for _ in range(count)]
    return [*made, "", " ", "a" * 3000, "ab" * 2000, " " * 300, "\n" * 70 + "x", "'" * 60, "1" * 90, "long text " * 400]


def ids_of(data):
    return list(struct.unpack(f"<{len(data) // 4}i", data))


def test_every_code_point_is_classed_as_the_library_has_it(library, own):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}b1{c} {c}!{c}'" for c in points)
    for at in range(0, len(text), 200_000):
        part = text[at : at + 200_000]
        assert ids_of(own.encode(chunked_bpe.pre_tokens(part))) == library.encode_ordinary(part)


def test_ids_equal_the_library(library, own):
    for text in texts():
        want = library.encode_ordinary(text)
        assert ids_of(own.encode(chunked_bpe.pre_tokens(text))) == want, text[:60]
        assert own.decode(want) == text.encode()


@pytest.mark.parametrize("chunk, overlap", [(7, 3), (16, 0), (64, 20)])
def test_chunks_of_any_size_give_the_same_ids(spark, library, chunk, overlap):
    made = texts(120, 120)
    found = chunked_bpe.encode(documents(spark, [(i, t, "s") for i, t in enumerate(made)]), RANKS, chunk, overlap)
    assert {r.doc_id: r.ids for r in found.collect()} == {i: library.encode_ordinary(t) for i, t in enumerate(made)}


def test_a_pre_token_of_many_chunks_is_read_as_one(spark, library):
    made = ["x" * 500 + " y " + "z" * 333, " " * 999, "'re" * 200]
    found = chunked_bpe.encode(documents(spark, [(i, t, "s") for i, t in enumerate(made)]), RANKS, 32, 8)
    assert {r.doc_id: r.ids for r in found.collect()} == {i: library.encode_ordinary(t) for i, t in enumerate(made)}


def test_a_table_with_odd_rows(spark, library):
    rows = [(i, t, "s") for i, t in enumerate(texts(30))]
    rows += [(None, "no id", "s"), (3, "twice " * 90, None), (3, "twice " * 90, None), (4, "twice " * 90, None), (9000, None, "s")]
    docs = documents(spark, rows).withColumns({c: F.lit("caller") for c in ("ids", "key", "chunk", "decoded")})
    found = chunked_bpe.digests(chunked_bpe.decode(chunked_bpe.encode(docs, RANKS, 200, 30), RANKS))
    want = []
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        text = hashlib.sha256((t or "").encode()).hexdigest()
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), text))
    assert tuples(found) == sorted(want, key=repr)
    empty = spark.createDataFrame([], DOCUMENTS)
    assert chunked_bpe.decode(chunked_bpe.encode(empty, RANKS), RANKS).count() == 0
    with pytest.raises(ValueError):
        chunked_bpe.encode(empty, RANKS, 8, 8)
