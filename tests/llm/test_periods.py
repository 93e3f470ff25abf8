"""Periodic runs against a comparison of all lags."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.brute import words
from verdigris.llm import periods

SCHEMA = "doc_id long, text string, runs string, n_words long, collapsed string, __text string"


def all_runs(w):
    """(start, end) -> smallest period of every maximal stretch that holds the period twice."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i >= q:
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return out


def document(doc, text):
    """The row of one document by the contract."""
    w = words(text)
    n, h = len(w), zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted((s, e - s, q) for (s, e), q in all_runs(w).items() if e - s >= 12)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def _fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def _stretches(rng):
    """Few letters, powers, powers of powers, Fibonacci and Thue-Morse words, long periods with errors."""
    n = rng.randrange(2, 300)
    s = "".join(rng.choice(rng.choice(["ab", "abcd"])) for _ in range(n))
    u = s[:rng.randrange(1, 6)]
    block = (u * 300)[:rng.randrange(17, 80)]
    long = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(15, 60))) * rng.randrange(2, 6)
    return rng.choice([
        s, u * 40 + s, (u * 60)[:n] + (s[:3] * 60)[:n], _fibonacci(n), "".join("ab"[i.bit_count() % 2] for i in range(n)),
        "x" + block * rng.randrange(2, 5) + block[:5], "".join(block[:rng.randrange(1, len(block))] for _ in range(5)),
        "".join(c if rng.random() > .01 else "z" for c in long), (block + "c") * 3 + block])


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_lags(seed):
    rng = random.Random(seed)
    for _ in range(150):
        s = _stretches(rng)
        seen = {}
        got = periods.find_runs(np.array([seen.setdefault(c, i) for i, c in enumerate(s)], dtype=np.int64))
        assert [tuple(r) for r in got.tolist()] == sorted((a, e, q) for (a, e), q in all_runs(s).items()), s


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [None, "", " \t\n", "one", "a b c d e\n" * 30, " ".join(f"w{i}" for i in range(700)), "é x " * 20, "a b " * 12 + "end"]
    texts += [" ".join(_stretches(rng)) for _ in range(150)]
    texts += [" ".join(rng.choice("ab") * 3 + str(rng.randrange(20)) for _ in range(150)) for _ in range(60)]
    out = [(i if i % 2 else 2 ** 53 + 1 + i, t, "x", 1, "y", "z") for i, t in enumerate(texts)]
    return [*out, (None, "r s t " * 9, *[None] * 4), (None, None, *[None] * 4), out[4], out[12]]


def test_documents(spark, rows):
    got = sorted(map(tuple, periods.run_documents(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()), key=repr)
    want = sorted((document(r[0], r[1]) for r in rows), key=repr)
    assert got == want
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) >= 10
    assert periods.run_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_operator_rows(spark):
    docs = spark.createDataFrame([("k", "go " + "a b c " * 5 + "stop")], "name string, body string")
    r = periods.periodic_runs(docs, ["name"], "body", min_length=6).first()
    assert (r["name"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) == ("k", 17, [(1, 15, 3)], "go a b c stop")


def test_long_texts_stay_cheap():
    """The number of seeds stays in proportion to the words where everything repeats."""
    for s in ("a" * 60000, "ab" * 30000, _fibonacci(60000), ("abcde" * 3000 + "x") * 4):
        seen = {}
        w = np.array([seen.setdefault(c, i) for i, c in enumerate(s)], dtype=np.int64)
        names, runs = periods.gram_names(w), periods.find_runs(w)
        for k in range(2, len(names)):
            assert len(periods._seeds(names[k], 1 << k, runs)[0]) <= 4 * len(w)
