import hashlib
import random

import duckdb
import numpy as np
import pytest
from llm.helpers import DOCUMENTS, WORD, documents, grouped, near_components, repeated, tuples
from pyspark.sql import functions as F

import corpus_pipeline
from comanda.llm import mixing, toxicity

FOLDER = "/root/testdata/sf0.001"
LABELS = "doc_id long, toxic int, quality int"


def made(n, seed):
    """(doc_id, text, toxic): some 2 % of a toxic text's words are rude."""
    draw = random.Random(seed)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}" for i in range(600)]
    rude = ["idiot", "scum", "trash", "clownish", "clowns", "clownery"]
    rows = []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randint(30, 200))]
        toxic = draw.random() < 0.2
        for _ in range(2 + len(text) // 40 if toxic else 0):
            text[draw.randrange(len(text))] = draw.choice(rude)
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = made(900, 1)
    docs = documents(spark, [(i, t, "s") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows if i < 600], LABELS)
    model = toxicity.fit(docs, labels)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    found = {r.doc_id: r for r in toxicity.grade(docs, model).collect()}
    held = [(y, found[i]) for i, _, y in rows if i >= 600]
    assert np.mean([r.rejected == (y == 1) for y, r in held]) > 0.97
    assert np.mean([r.severity for y, r in held if y]) > 1 > np.mean([r.severity for y, r in held if not y])
    assert {r.grade for _, r in held} == {0, 1, 2}
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert tuples(kept) == [r for r in tuples(docs) if not found[r[0]].rejected]


def test_thresholds_share_weights():
    draw = np.random.default_rng(0)
    x = draw.uniform(0, 2, (3000, 3))
    latent = 2 * x[:, 0] - x[:, 1] + draw.logistic(size=3000)
    grades = np.digitize(latent, [0.5, 2.0, 3.0])
    model = toxicity.fit_grades(x, grades, ["a", "b", "c"], penalty=0.0)
    assert [model.weights[f] for f in "abc"] == pytest.approx([2, -1, 0], abs=0.25)
    assert model.thresholds == pytest.approx([0.5, 2, 3], abs=0.35)


def test_toxicity_of_odd_rows(spark):
    rows = made(300, 2)
    docs = documents(spark, [(i, t, "s") for i, t, _ in rows] + [(None, "idiot scum trash " * 20, "s"), (5, None, None), (5, "", "s"), (888, "trash " * 40000, "s")])
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (7, None, 1), (1, 3, 1), (999999, 1, 0), (3, rows[3][2], 1)], LABELS)
    found = toxicity.grade(docs, toxicity.fit(docs, labels)).collect()
    assert len(found) == len(rows) + 4
    assert all(r.rejected for r in found if r.doc_id is None)
    assert [r.rejected for r in found if r.doc_id == 5 and r.n_chars in (None, 0)] == [False, False]
    assert any(r.rejected for r in found if r.doc_id == 888)
    nothing = spark.createDataFrame([], LABELS)
    assert toxicity.fit(docs, nothing) is None
    assert toxicity.drop_toxic(docs, nothing).count() == docs.count()
    empty = spark.createDataFrame([], DOCUMENTS)
    assert toxicity.grade(empty, toxicity.fit(empty, labels)).count() == 0


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_each_stage_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash near-dedup", "suffix-array dedup", "source mix", "bpe round"
    ]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")

    clean = corpus_pipeline.stored(stages["toxicity"](spark, docs, FOLDER), "test")
    graded = toxicity.grade(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    rejected = {r.doc_id for r in graded.where("rejected").collect()}
    assert rejected and clean.columns == columns
    assert tuples(clean) == [r for r in tuples(docs) if r[0] not in rejected]

    single = corpus_pipeline.stored(stages["minhash near-dedup"](spark, clean, FOLDER), "test")
    low = near_components({r["doc_id"]: r["text"] for r in rows_of(clean)}, 5)
    assert single.columns == columns and sum(a != b for a, b in low.items()) > 0
    assert tuples(single) == [r for r in tuples(clean) if low[r[0]] == r[0]]

    shorter = corpus_pipeline.stored(stages["suffix-array dedup"](spark, single, FOLDER), "test")
    before = sorted(rows_of(single), key=lambda r: r["doc_id"])
    rest = {}
    for r, marks in zip(before, repeated([r["text"] for r in before], 100)):
        rest[r["doc_id"]] = bytes(b for b, m in zip(r["text"].encode(), marks) if not m).decode("utf-8", "ignore")
    assert shorter.columns == columns and any(rest[r["doc_id"]] != r["text"] for r in before)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in rows_of(shorter)} == {i: (t, len(t)) for i, t in rest.items()}

    mixed = corpus_pipeline.stored(stages["source mix"](spark, shorter, FOLDER), "test")
    assert mixed.columns == columns
    words = {s: sum(len(WORD.findall(r["text"])) for r in rs) for s, rs in grouped(rows_of(mixed), lambda r: r["source"]).items()}
    for r in mixing.source_targets(mixing_sizes(shorter)).collect():
        assert words.get(r.source, 0) == int(r.target)

    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = []
    for r in rows_of(mixed):
        ids = library.encode(r["text"], add_special_tokens=False).ids
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append((r["doc_id"], len(ids), *digests))
    assert tuples(stages["bpe round"](spark, mixed, FOLDER)) == sorted(want, key=repr)


CLASHING = [
    "p_toxic", "severity", "grade", "rejected", "_text", "_rid", "rid", "key", "low", "doc", "tie", "n_bytes", "kept",
    "removed", "spans", "_null", "passes", "last", "_source", "_words", "_cut", "size", "ids", "shard", "slot", "_size",
    "a column", "select", "_travelling_columns_",
]


def test_stages_leave_columns_of_their_own_names_alone(spark):
    stages = dict(corpus_pipeline.STAGES)
    rows = [(i, t, "s" if i % 2 else "t") for i, t, _ in made(40, 3)]
    rows += [(90, rows[0][1], "s"), (91, "stretch " * 40 + "one end", "s"), (92, "stretch " * 40 + "other end", None), (None, None, "s")]
    plain = documents(spark, rows).drop("size", "shard_").coalesce(1)
    wide = plain.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    for name, stage in list(stages.items())[:-1]:
        given, other = (corpus_pipeline.stored(df, "test") for df in (wide, plain))
        wide = corpus_pipeline.stored(stage(spark, given, FOLDER), "test")
        plain = corpus_pipeline.stored(stage(spark, other, FOLDER), "test")
        assert wide.columns == given.columns, name
        assert tuples(wide, *plain.columns) == tuples(plain), name
        for r in wide.collect():
            assert all(r[c] == (None if r.doc_id is None else f"{c} {r.doc_id}") for c in CLASHING), name
    last = stages["bpe round"]
    assert tuples(last(spark, wide, FOLDER)) == tuples(last(spark, plain, FOLDER))


def mixing_sizes(docs):
    from comanda.llm.common import word_count
    from pyspark.sql import functions as F

    return docs.select("source", word_count(F.col("text")).alias("size"))


def test_the_pipeline_of_an_empty_table(spark, tmp_path):
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"COPY (SELECT * FROM '{FOLDER}/{name}.parquet' WHERE false) TO '{tmp_path}/{name}.parquet'")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
