import math
import random

import numpy as np
import pytest
from llm.helpers import components, tuples

from comanda.llm import topk, url_filters, vector_links
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int, rank int, node long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 0, 0) for i, v, label in rows], VECTORS)


ODD = [
    (5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, [1.0, None], 1),
    (5004, [float("inf")] + [0.0] * 15, 1), (5005, [1.0, 2.0], 1), (5006, [2.0, 4.0], 1),
]


def sample():
    draw = np.random.default_rng(4)
    base = draw.standard_normal((240, 16))
    near = base[:80] + draw.standard_normal((80, 16)) * draw.uniform(0.05, 0.6, (80, 1))
    rows = np.concatenate([base, near, np.repeat(base[:1], 40, 0)]).astype(np.float32)
    labels = [1] * len(rows)
    for i in range(0, 240, 3):
        labels[i] = 2
    labels[239] = None
    return [(i, [float(x) for x in v], labels[i]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block", [2048, 60])
def test_vector_links_equal_brute_force(spark, block):
    rows = sample()
    found = {r.vec_id: r for r in vector_links.link_vectors(vectors(spark, rows + ODD), block=block).collect()}
    units = np.array([v for _, v, _ in rows], float)
    units /= np.linalg.norm(units, axis=1)[:, None]
    near = units @ units.T >= 0.93
    links = [
        (i, j) for i in range(len(rows)) for j in range(len(rows))
        if i != j and near[i, j] and rows[i][2] is not None and rows[i][2] == rows[j][2]
    ]
    low = components(range(len(rows)), links)
    assert len(found) == len(rows) + len(ODD)
    for i, _, _ in rows:
        r = found[i]
        assert (r.n_links, r.component_id, r.kept) == (sum(a == i for a, _ in links), low[i], low[i] == i)
    assert [(found[i].n_links, found[i].component_id) for i in range(5000, 5007)] == [
        (0, 5000), (0, 5001), (0, 5002), (0, 5003), (0, 5004), (1, 5005), (1, 5005)
    ]


def test_vector_links_of_odd_rows(spark):
    assert vector_links.link_vectors(vectors(spark, [])).count() == 0
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.1], 1), (2, [1.0, 0.0], None)]
    found = vector_links.link_vectors(vectors(spark, rows))
    assert tuples(found, "vec_id", "n_links", "component_id") == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (2, 0, 2)], key=repr)


def test_collision_counts_are_calibrated():
    draw = np.random.default_rng(1)
    p = math.erf(vector_links.HALF_WINDOW / math.sqrt(2))
    for n in vector_links.LOOKS:
        counts = draw.binomial(n, p, 200_000)
        assert (counts < vector_links.least_collisions(n)).sum() <= 3


@pytest.mark.parametrize("blocks", [(16_384, 2_048), (50, 7), (12, 100)])
def test_top_k_equals_brute_force(spark, blocks):
    rows = sample()
    rows += [(900, [1.0] * 20, 1), (901, [-3.5] * 4, 1), (902, [1e12] * 2, 1)] + ODD
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, 7, 64, *blocks)
    whole = {}
    for i, v, _ in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(64 * np.float64(np.float32(x))) for x in v]
    want = []
    for q in whole:
        if q % 10 == 0:
            scores = [(-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q]
            want += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:7], 1)]
    assert tuples(found) == sorted(want, key=repr)


def test_top_k_of_few_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (None, [1.0, 1.0], 1), (10, None, 1)]
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert tuples(found) == [(0, 1, 1, 64 * 64 * 3)]
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_k(vectors(spark, rows[1:2]), F.lit(False)).count() == 0


def test_rows_of_one_vec_id_ask_and_answer_each(spark):
    rows = [(20, [1.0, 0.0], 1), (20, [0.0, 1.0], 1), (1, [0.5, 0.5], 1), (20, [1.0, 0.0], 1)]
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, 2, 64)
    one, half = 64 * 64, 32 * 64
    want = [(20, 1, 20, one), (20, 2, 1, half)] * 2 + [(20, 1, 1, half), (20, 2, 20, 0)]
    assert tuples(found) == sorted(want, key=repr)


URLS = [
    "http://Example.ORG/es/1", "https://a.example.org/en/12?x", "http://example.org/en/2", "http://bexample.org/es/",
    "http://x.com/fr/1", "http://x.com/de/", "http://x.com/de", "http://com/de/#a", "http://org", "ftp://ORG/?q=/x",
    "no scheme", "", None, "://", "http://host.net", "http://host.net/a?utm_source=1", "a://b://c/d", "http://É.net/x\ny",
    "http://listed.net/", "http://listed.net/?utm_a", "http://UserInfo@Host.net:80/p;q",
]


def brute_verdict(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [
        (len(name + start), name + start, what) for what, name, start in url_filters.RULES
        if (host == name or host.endswith("." + name)) and path.startswith(start)
    ]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if host in listed else "allow"


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_verdicts_equal_brute_force(spark, most):
    draw = random.Random(1)
    hosts = [f"h{i}.net" for i in range(3000)]
    urls = URLS + [f"http://{h}/p" for h in hosts] + ["http://h0.net/q"] * 500
    listed = {"listed.net", "host.net", *draw.sample(hosts, 900)}
    pages = spark.createDataFrame([(i, u, "k", "w") for i, u in enumerate(urls)], "page_id long, url string, key string, words string")
    keys = spark.createDataFrame([(k,) for k in [*listed, *listed, None, "absent.net"]], "key string")
    found = url_filters.judge(pages, keys, max_bytes=most)
    want = [(i, *brute_verdict(u, listed)) for i, u in enumerate(urls)]
    assert tuples(found) == sorted(want, key=repr)


def test_a_cascade_is_exact_and_small(spark):
    rows = [(f"k{i}", i % 4 == 0) for i in range(4000)]
    universe = spark.createDataFrame(rows, "key string, listed boolean")
    levels = url_filters.build_cascade(universe)
    assert 2 <= len(levels) <= 16
    assert sum(level.bits for level in levels) < 8 * 1000
    wrong = universe.where(url_filters.is_listed(F.col("key"), levels) != F.col("listed"))
    assert wrong.count() == 0
    assert url_filters.build_cascade(universe.where("not listed")) == []


def test_verdicts_without_pages_or_list(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    keys = spark.createDataFrame([], "key string")
    assert url_filters.judge(none, keys).count() == 0
    some = spark.createDataFrame([(None, "http://a.net/"), (None, None)], "page_id long, url string")
    assert tuples(url_filters.judge(some, keys), "host", "verdict") == [("", "allow"), ("a.net", "allow")]
    assert url_filters.tracking_hosts(some).count() == 0


def test_no_python_in_verdicts(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    plan = url_filters.judge(pages, url_filters.tracking_hosts(pages))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
