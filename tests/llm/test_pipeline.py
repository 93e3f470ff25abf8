"""Every stage of the corpus pipeline, on what its predecessor kept, against brute force; and the whole run."""

import collections
import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm import brute as B
from verdigris.llm import packing, quality, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies int, kept boolean, __row string"


def _text(rng, n=60):
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out, labels = [], []

    def add(text, lang="en", label=None, source=None, doc_id=0):
        i = len(out) if doc_id == 0 else doc_id
        out.append((i, text, lang, source or "abb"[len(out) % 3], None if text is None else len(text), 9, False, "x"))
        if label is not None:
            labels.append((i, label))

    add(_text(rng))
    for _ in range(1700):
        add(_text(rng), label=1)
    for k in range(120):
        add(_text(rng, 54) + " ####### ####### #######", label=0 if k < 90 else None)
    for k in range(12):  # near copies: one word of 60 differs; and exact ones
        text = _text(rng)
        add(text)
        add(text.replace(text.split()[30], "changed"))
        add(text, lang=None)
    for text in (None, "", " \n", "a b c " * 30, "one two three"):
        add(text)
        add(text, lang=None)
    add(_text(rng) + " password = hunter2xyz and " + "0f" * 14)
    add(_text(rng) + f" {secrets.random_strings(seed=4, each=1)["mixed"][0]} end", lang=None)
    add(_text(rng), source="only")
    add(_text(rng, 9000), lang="fr")  # a long one
    add(_text(rng), doc_id=None)
    out.append(out[7])  # a repeated row
    out += [(9001, _text(rng), None, None, None, 1, True, None)]
    return out, [*labels, (3, None), (99999, 1)]


@pytest.fixture(scope="module")
def sf(spark, rows, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows[0], SCHEMA).repartition(5).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(rows[1], "doc_id long, quality int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Rows of the input and of every stage's result."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [[tuple(r)[:5] for r in docs.collect()]]
    for name, stage in P.STAGES:
        result = stage(spark, docs, sf)
        assert name == "best_fit_packing" or result.columns == P.COLUMNS
        result.write.parquet(path := str(tmp_path_factory.mktemp(name) / "t"))
        docs = spark.read.parquet(path)
        out.append([tuple(r) for r in docs.collect()])
    return out


def _key(row):
    return tuple((x is None, "" if x is None else x) for x in row)


def test_quality_keeps_what_brute_force_keeps(stages, rows):
    cutoffs = B.cutoffs([(r[0], r[2], r[1]) for r in stages[0]], rows[1], quality.RULES, quality.RISK, quality.DELTA)
    assert any(cutoffs.values())  # the fixture is large enough for a certificate
    want = [r for r in stages[0] if B.kept(r[1], cutoffs.get(r[2], {}), quality.RULES)]
    assert sorted(stages[1], key=_key) == sorted(want, key=_key)


def _one_of_each(rows):
    """One row of every component of texts: the smallest id, null last; rows equal in id and text once."""
    rows = list(dict.fromkeys(rows))
    found = B.jaccard_components([(i, r[1]) for i, r in enumerate(rows)], percent=P.PERCENT, words=P.WORDS)
    first = {}
    for i, n, c in found:
        key = c if n else ("alone", i)
        first[key] = min(first.get(key, i), i, key=lambda j: (rows[j][0] is None, rows[j][0] or 0))
    return [rows[i] for i in first.values()]


def test_one_document_of_each_component_stays(stages):
    want = _one_of_each(stages[1])
    assert len(want) < len(stages[1])
    assert sorted(stages[2], key=_key) == sorted(want, key=_key)


def test_different_texts_of_one_id_stay(spark, sf):
    """Clean texts are no copies because they share an id, or have none; copies are, whatever their ids."""
    rng = random.Random(21)
    a, b, c, d, e = (_text(rng) for _ in range(5))
    rows = [(1, a), (1, b), (1, c), (2, d), (2, d), (2 ** 53 + 1, e), (2 ** 53 + 3, e + " more"), (None, a), (None, e), (None, "only " + b[::-1]),
            (None, "only " + b[::-1]), (7, ""), (7, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in P.near_duplicate_stage(spark, docs.repartition(3), sf).collect()]
    want = [(1, a), (1, b), (1, c), (2, d), (2 ** 53 + 1, e), (None, "only " + b[::-1])]
    assert sorted((r for r in got if r[1]), key=_key) == sorted(want, key=_key)
    assert [r[0] for r in got if not r[1]] == [7]  # an empty and a null text are one text


def test_near_copies_of_five_words_and_80_percent_go(spark, sf):
    """Copies with one to four changed words, on both sides of 80 % of 5-grams and of 85 % of 4-grams."""
    rng, out = random.Random(5), []
    for k in range(40):
        n = rng.choice((30, 60, 100, 200))
        words = _text(rng, n).split()
        copy = list(words)
        for i in range(1 + k % 4):
            copy[(i + 1) * n // 6] = f"changed{k}x{i}"
        out += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in out],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"] for r in P.near_duplicate_stage(spark, docs, sf).collect()}
    firsts = [{d for d, _, c in B.jaccard_components(out, **how) if d == c} for how in (dict(percent=80, words=5), {})]
    assert got == firsts[0] and firsts[0] < firsts[1] < {d for d, _ in out}


def test_secrets_are_replaced(spark, stages):
    docs = spark.createDataFrame(stages[2], "doc_id long, text string, lang string, source string, n_chars long")
    spans = {r["doc_id"]: r["spans"] for r in secrets.secret_documents(docs).collect()}
    want = []
    for doc, text, lang, source, _ in stages[2]:
        clean = B.redacted(text, spans[doc])
        want.append((doc, clean, lang, source, len(clean)))
        assert B.secret_digest(clean)[:3] == (0, 0, 0)
    assert any(spans.values()) and sorted(stages[3], key=_key) == sorted(want, key=_key)


def test_copies_bring_every_source_to_its_target(spark, sf, stages):
    size, taken = collections.Counter(), collections.Counter()
    for r in stages[3]:
        size[r[3]] += len(B.words(r[1]))
    for r in stages[4]:
        taken[r[3]] += len(B.words(r[1]))
    target, copies = B.targets(size), collections.Counter(stages[4])
    assert set(copies) <= set(stages[3])
    for r in stages[3]:
        whole = int(target[r[3]] / size[r[3]] + 1e-9)
        assert copies[r] in (whole, min(2, whole + 1)), r[0]
    for s in size:
        longest = max(len(B.words(r[1])) for r in stages[3] if r[3] == s)
        assert abs(taken[s] - target[s]) <= longest
    docs = spark.createDataFrame(stages[3], "doc_id long, text string, lang string, source string, n_chars long")
    again = P.mixing_stage(spark, docs.repartition(3), sf).collect()
    assert collections.Counter(tuple(r) for r in again) == copies


def test_packing_holds_every_piece_once(stages):
    t = Tokenizer.from_file(packing.tokenizer_path())
    ids = {x: t.encode(x, add_special_tokens=False).ids for x in {r[1] for r in stages[4]}}
    want = [p for r in stages[4] for p in B.pieces(r[0], ids[r[1]])]
    assert sorted((r[:5] for r in stages[5]), key=_key) == sorted(want, key=_key)
    filled = collections.defaultdict(list)
    for r in stages[5]:
        filled[r[5]].append((r[6], r[3]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    least = -(-sum(p[3] for p in want) // packing.CAPACITY)
    assert least <= len(filled) <= 11 * least // 9 + 1


def test_run_is_the_stages_in_turn(spark, sf, stages):
    got = [tuple(r)[:5] for r in P.run(spark, sf).collect()]
    assert sorted(got, key=_key) == sorted((r[:5] for r in stages[5]), key=_key)


def test_empty_tables(spark, sf, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
