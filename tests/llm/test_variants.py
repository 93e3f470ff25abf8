"""Spelling variants against a comparison of all pairs of words."""

import collections
import random
import re
import zlib

import pytest

from tests.llm.brute import LOWER
from verdigris.llm import variants

SCHEMA = "doc_id long, text string, word string, n long, node string, vec string"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def table(rows):
    """(word, form, root, n, n_near, form_n) by the contract."""
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    close = {w: [x for x in n if near(w, x)] for w in n}
    best = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in close.items() if xs}
    form = {w: x for w, x in best.items() if n[x] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w, ""), root(w), n[w], len(close[w]), n[form[w]] if w in form else -1) for w in n)


def _words(rng, letters, count):
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 9))) for _ in range(count)]
    out = set(base)
    for w in base:
        for _ in range(3):
            i, k = rng.randrange(len(w)), rng.randrange(3)
            out.add(w[:i] + w[i + 1:] if k == 0 else w[:i] + rng.choice(letters) + w[i + (k == 1):])
    return out


@pytest.mark.parametrize("node,step", [(4096, 4), (60, 4), (7, 9), (1, 13)])
def test_pairs_whatever_the_split(spark, node, step):
    """One node; several levels of nodes; and vectors that even the whole trie does not part, split by halves."""
    rng = random.Random(5)
    words = _words(rng, "abcdeé", 150) | {"e" * n for n in range(70, 79)} | {"e" * 74 + "a", "e" * 75 + "a", "a" + "e" * 74, "ea" * 4, "ae" * 4}
    n = {w: rng.randrange(5, 300) for w in sorted(words)}
    got = variants.near_pairs(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3), node, step).collect()
    assert sorted(map(tuple, got)) == sorted((a, n[a], b, n[b]) for a in n for b in n if near(a, b))


def test_documents(spark):
    rng = random.Random(8)
    words = sorted(_words(rng, "rstÉüà×", 40))
    texts = [" ".join(rng.choices(words, weights=[4 ** (i % 6) for i in range(len(words))], k=60)) + " Ab-CDEFGH 12" for _ in range(120)]
    chain = "abcdefg " * 5 + "abcdefh " * 25 + "abcdehh " * 125 + "abceehh " * 625  # roots over three forms
    rows = [*enumerate([*texts, None, "", "word", chain, "X" + "y" * 5000 + " "]), (None, "nullid " * 6), (2 ** 53 + 1, "nullis " * 31), (3, texts[3])]
    docs = spark.createDataFrame([(*r, "w", 1, "x", "y") for r in rows], SCHEMA).repartition(4)
    got = sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"])
                 for r in variants.variant_documents(docs).collect())
    want = table(rows)
    assert got == want
    assert ("abcdefg", "abcdefh", "abceehh", 5, 1, 25) in want and sum(r[1] != "" for r in want) > 10
    assert variants.variant_documents(spark.createDataFrame([], SCHEMA)).count() == 0
