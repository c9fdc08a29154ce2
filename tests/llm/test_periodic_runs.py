import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from plain import awkward_docs, empty_docs, sha
from pyspark.sql import functions as F

from fraudlens.llm import periodic_runs as pr
from fraudlens.llm.queries import QUERIES


def plain_runs(words, least=12):
    """Every period is tried over the whole text; of one stretch's periods the smallest stays."""
    n, best = len(words), {}
    numbers = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    for q in range(1, n // 2 + 1):
        equal = np.concatenate(([False], numbers[:-q] == numbers[q:], [False]))
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b + q - a >= max(least, 2 * q):
                best.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in best.items())


def plain_row(doc_id, words):
    runs = plain_runs(words)
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, sha(lines.encode()), sha(kept.encode()), kept)


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def planted(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def as_bytes(words):
    return [str(w).encode() for w in words]


def test_transform_and_zero_distances():
    rng = np.random.default_rng(0)
    t = pr.Transform(32)
    a, b = (rng.integers(0, pr.PRIME, (3, 32)).astype(np.uint64) for _ in range(2))
    assert (t.backward(t.forward(a)) == a).all()
    got = t.backward(pr._times(t.forward(a), t.forward(b)))
    for x, y, z in zip(a.tolist(), b.tolist(), got.tolist()):
        assert z == [sum(x[i] * y[(k - i) % 32] for i in range(32)) % pr.PRIME for k in range(32)]
    words = rng.integers(0, 2, 400).astype(np.uint64)
    starts = np.arange(0, 300, 8)
    got = set(zip(*(c.tolist() for c in pr.zero_distances(words, starts, 8, t))))
    want = {(s, d) for s in starts.tolist() for d in range(16, 32) if (words[s : s + 8] == words[s + d : s + d + 8]).all()}
    assert got == want and want


def test_equal_lengths():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2, 200)
    same = pr.EqualLengths(words)
    i = rng.integers(0, 150, 300)
    j = i + rng.integers(1, 50, 300)
    for a, b, left, right in zip(i, j, same.left(i, j), same.right(i, j)):
        assert (words[a : a + right] == words[b : b + right]).all()
        assert b + right == 200 or words[a + right] != words[b + right]
        assert (words[a - left : a] == words[b - left : b]).all()
        assert a == left or words[a - left - 1] != words[b - left - 1]


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_runs_of_random_words(letters):
    rng = random.Random(letters)
    texts = []
    for n in (0, 1, 11, 12, 13, 40, 150, 400):
        words = [rng.randrange(letters) for _ in range(n)]
        for _ in range(3 if n > 30 else 0):  # periodic stretches of all sizes
            p, a = rng.randrange(1, n // 2), rng.randrange(n)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        texts.append(as_bytes(words))
    got = pr.runs_of(texts)
    assert [[tuple(r) for r in rows.tolist()] for rows in got] == [plain_runs(t) for t in texts]


def test_runs_of_structured_words():
    fibonacci = ["a", "a b"]
    while len(fibonacci[-1].split()) < 600:
        fibonacci.append(f"{fibonacci[-1]} {fibonacci[-2]}")
    texts = [
        fibonacci[-1].split(),
        ("x " * 300 + "y " + "x " * 300).split(),
        ((("a b c " * 20) + "d ") * 8).split(),
        [f"w{i % 37}" for i in range(1000)],
        [f"w{i % 16}" for i in range(32)],
        [f"w{i % 15}" for i in range(30)],
        [f"w{i}" for i in range(100)],
        [f"w{i % 500}" for i in range(1000)],
    ]
    got = pr.runs_of([as_bytes(t) for t in texts])
    assert [[tuple(r) for r in rows.tolist()] for rows in got] == [plain_runs(as_bytes(t)) for t in texts]


def test_awkward_rows(spark):
    df = awkward_docs(spark, extra=True)
    df = df.unionByName(df.limit(1).selectExpr(*[f"{'repeat(chr(97) || chr(32), 40000)' if c == 'text' else c} AS {c}" for c in df.columns]))
    got = pr.run_digests(pr.periodic_runs(df)).collect()
    want = [plain_row(r.doc_id, split(r.text)) for r in df.filter("length(text) < 50000 OR text IS NULL").collect()]
    long = [tuple(r) for r in got if r.length == 40000]
    assert [x[1:6] for x in long] == [(1, 0, 40000, 1, 40_000_000)] and long[0][-1] == "a"
    assert sorted(map(repr, (tuple(r) for r in got if r.length != 40000))) == sorted(map(repr, want))
    assert pr.periodic_runs(empty_docs(spark)).collect() == []


def test_planting(spark):
    df = awkward_docs(spark)
    got = pr.with_planted_runs(df).collect()
    rows = df.collect()
    assert sorted(map(repr, ((r.doc_id, split(r.text)) for r in got))) == sorted(map(repr, ((r.doc_id, planted(r.doc_id, r.text)) for r in rows)))
    assert any(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_block_convolution_runs"](spark, sf_dir)
    assert got.columns[:8] == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain_row(r.doc_id, planted(r.doc_id, r.text)) for r in docs)
    assert got.filter(F.col("n_runs") > 0).count() > 10
    assert hashlib.sha256(b"").hexdigest() in {r.runs_sha256 for r in got.collect()}
