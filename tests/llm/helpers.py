"""Small tables and brute-force versions for the tests of this folder."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard_ string"


def documents(spark, rows):
    """(doc_id, text, source) rows with columns that clash with operators' own names."""
    full = [(i, t, "en", s, None if t is None else len(t), 7, "x") for i, t, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def components(nodes, links):
    """The least node that each is linked to."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, n):
    small = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = WORD.findall(small)
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def near_components(texts, n, percent=80):
    """{doc_id: least linked doc_id} of texts by doc_id."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    links = []
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    return components(sets, links)


def repeated(texts, length):
    """Per text, in order, whether each of its bytes is covered by an earlier string."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        marks = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                marks[i : i + length] = b"\1" * length
            else:
                seen.add(data[i : i + length])
        out.append(marks)
    return out


def grouped(rows, key):
    out = defaultdict(list)
    for row in rows:
        out[key(row)].append(row)
    return out
