"""Secret scans: fixed patterns, and character Markov models for what they miss.

First-order Markov models over the characters of tokens are trained from labelled
samples: random strings (values found by the patterns, and seeded random strings
of usual alphabets) and ordinary ones, of two kinds (the other long words, and words
joined to identifiers in the usual styles; and characters in an order). Half of a character's chance comes from the
pairs seen, half from the classes of the two (lower, upper, digit, each sign), so
words of another language are ordinary too. A token is a secret if its
log-likelihood ratio per character exceeds its alphabet's cut, which is set on
held-out identifiers: at most one in ``1 / FALSE_RATE`` of them is above it.
"""

from __future__ import annotations

import random
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KINDS = ("assign", "access", "hex", "markov")
# The base patterns; matches shorter than the given length are dropped.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run under 20 characters fails as a whole
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORD = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SAMPLE_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{5,}")
WORDS = re.compile(r"[A-Za-z]{2,}")
ALPHABET = string.ascii_letters + string.digits + "+/_=-."
INDEX = np.full(128, len(ALPHABET), dtype=np.int64)
INDEX[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
N_STATES = len(ALPHABET) + 1

TRAIN_DOCS = 20_000  # bound of the labelled sample: about so many documents, chosen by hash
FALSE_RATE = 0.002  # of held-out ordinary identifiers above their alphabet's cut
LEAST_CUT, LEAST_SAMPLE = 0.1, 500  # a cut of fewer identifiers is not lower than that of mixed tokens
BIN = 0.02
ALPHABETS = ("digits", "hex", "mixed")
SPAN = "array<struct<kind:string,start:int,end:int>>"
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the base matches, in code points."""
    out = []
    if KEYWORD.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _codes(token: str) -> np.ndarray:
    return INDEX[np.frombuffer(token.encode("ascii"), dtype=np.uint8)]


#: classes of characters: lower, upper, digit, and each sign by itself
CLASS = np.array([0] * 26 + [1] * 26 + [2] * 10 + list(range(3, 3 + N_STATES - 62)))


def alphabet(token: str) -> int:
    """Place in ``ALPHABETS``."""
    return 0 if token.isdigit() else 1 if not token.strip("0123456789abcdef") else 2


def random_strings(seed: int = 5, each: int = 300) -> dict[str, list[str]]:
    """Seeded random strings by alphabet; mixed ones of base 62 and base 64."""
    rng = random.Random(seed)
    kinds = (("digits", string.digits), ("hex", string.hexdigits[:16]), ("mixed", string.ascii_letters + string.digits),
             ("mixed", string.ascii_letters + string.digits + "+/"))
    out: dict[str, list[str]] = {k: [] for k in ALPHABETS}
    for kind, letters in kinds:
        out[kind] += ["".join(rng.choices(letters, k=rng.randint(20, 48))) for _ in range(each)]
    return out


def ordinary_runs(lengths: tuple[int, ...] = (16, 33), first_year: int = 1990) -> list[str]:
    """Characters in an order: alphabets and digits up and down, keyboard rows, dates, and (three times) repeated characters."""
    rows = [string.ascii_lowercase, string.ascii_uppercase, string.digits, string.digits[1:] + "0", "qwertyuiop", "asdfghjkl", "zxcvbnm"]
    out = [(r * 6)[i:i + n] for row in rows for r in (row, row[::-1]) for i in range(len(row)) for n in lengths]
    out += [c * n for c in ALPHABET for n in lengths] * 3
    out += [f"{y}{m:02d}{d:02d}{h:02d}0000" + "0" * (m % 9) for y in range(first_year, 2031, 4) for m in range(1, 13) for d in (1, 15, 28) for h in (0, 12)]
    return out


def identifiers(text: str) -> list[str]:
    """Consecutive words of a text joined as identifiers, in turn in camel, Pascal, snake, constant, kebab and path style."""
    words, out = WORDS.findall(text), []
    for i in range(0, len(words) - 4, 9):
        w = [x.lower() for x in words[i:i + 2 + i % 3]]
        style = i // 9 % 8
        number = str(i % 100) if i % 4 == 1 else ""
        joined = (w[0] + "".join(map(str.capitalize, w[1:])), "".join(map(str.capitalize, w)), "_".join(w), "_".join(w).upper(),
                  "-".join(w), "/".join(w), "".join(w), "//" + "/".join(w) + "/index")[style]
        out.append(joined + number)
    return out


def _outside(text: str, spans: list, pattern: re.Pattern) -> list[re.Match]:
    """Matches of ``pattern`` that touch no span; ``spans`` are sorted by start, so one pass over both is enough."""
    out, at, covered = [], 0, 0  # covered: where the spans that start before a match's end are all over
    for m in pattern.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            covered = max(covered, spans[at][2])
            at += 1
        if covered <= m.start():
            out.append(m)
    return out


def _pairs(tokens: list[str]) -> np.ndarray:
    """How often each character follows each other within the tokens, which use the alphabet only."""
    c = _codes("\n".join(tokens))  # a line end has the last state, which no token uses
    n = np.bincount(c[:-1] * N_STATES + c[1:], minlength=N_STATES ** 2).reshape(N_STATES, N_STATES)
    n[-1, :] = n[:, -1] = 0
    return n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.zeros((2, N_STATES, N_STATES), dtype=np.int64)
        for text in batch["text"].to_pylist():
            spans = base_spans(text or "")
            counts[0] += _pairs([m[0] for m in _outside(text or "", spans, SAMPLE_TOKEN)] + identifiers(text or ""))
            counts[1] += _pairs([text[s:e] for s, k, e in spans if k == 1])
        at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*at, counts[at])], ["label", "a", "b", "n"])


def _log_chance(counts: np.ndarray) -> np.ndarray:
    """Log chance of every character after every other: half by the pairs, half by their classes."""
    n_classes = CLASS.max() + 1
    one_hot = np.eye(n_classes)[CLASS]
    classes = one_hot.T @ counts @ one_hot + 0.5
    single = counts.sum(axis=0) + 0.5
    share = single / (one_hot.T @ single)[CLASS]
    back = (classes / classes.sum(axis=1, keepdims=True))[CLASS][:, CLASS] * share
    total = counts.sum(axis=1, keepdims=True)
    return np.log(np.where(total > 0, 0.5 * counts / np.maximum(total, 1) + 0.5 * back, back))


class Markov:
    """Per alphabet the log-likelihood ratios of every character pair, random against words and against characters in an
    order, and the cut per character."""

    def __init__(self, ratios: np.ndarray, cuts: np.ndarray):
        self.ratios, self.cuts = ratios, cuts

    def per_char(self, token: str) -> float:
        c = _codes(token)
        return float(self.ratios[alphabet(token)][:, c[:-1], c[1:]].mean(axis=1).min())

    def is_random(self, token: str) -> bool:
        return self.per_char(token) > self.cuts[alphabet(token)]


def _half(which: int):
    return F.pmod(F.xxhash64(F.lit("secret halves"), "doc_id", "text"), F.lit(2)) == which


def train(docs: DataFrame, sample_docs: int = TRAIN_DOCS, false_rate: float = FALSE_RATE) -> Markov:
    """Models and cuts from about ``sample_docs`` documents: one half is counted, the identifiers of the other set the cuts.

    An empty table leaves the seeded samples.
    """
    total = docs.count()
    share = min(1.0, sample_docs / max(1, total))
    picked = docs.where(F.pmod(F.xxhash64(F.lit("secrets"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = (picked.where(_half(0)).select("text").mapInArrow(_count, "label long, a long, b long, n long")
            .groupBy("label", "a", "b").agg(F.sum("n").alias("n")).collect())  # at most 2 * 69 * 69 rows
    counts = np.zeros((2, N_STATES, N_STATES))
    for r in rows:
        counts[r["label"], r["a"], r["b"]] += r["n"]
    seeded = random_strings()
    sure = [_pairs(seeded["digits"]), _pairs(seeded["hex"]), _pairs(seeded["mixed"]) + counts[1]]
    plain = np.stack([_log_chance(counts[0]), _log_chance(_pairs(ordinary_runs()).astype(float))])
    model = Markov(np.stack([_log_chance(a) - plain for a in sure]), np.zeros(len(ALPHABETS)))

    def bins(tokens: list[str]) -> Counter:
        return Counter((alphabet(t), int(np.floor(model.per_char(t) / BIN))) for t in tokens if len(t) >= 16)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sum((bins(identifiers(t or "")) for t in batch["text"].to_pylist()), Counter())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (
                [k for k, _ in found], [b for _, b in found], list(found.values()))], ["kind", "bin", "n"])

    held = bins(ordinary_runs((24,), 1992))
    for r in (picked.where(_half(1)).select("text").mapInArrow(score, "kind long, bin long, n long")
              .groupBy("kind", "bin").agg(F.sum("n").alias("n")).collect()):  # a few hundred bins
        held[r["kind"], r["bin"]] += r["n"]
    for kind in (2, 1, 0):
        of = sorted((b, n) for (k, b), n in held.items() if k == kind)
        left = int(sum(n for _, n in of) * false_rate)
        cut = LEAST_CUT
        for b, n in reversed(of):  # the lowest cut that few enough identifiers exceed
            if n > left:
                cut = max(cut, (b + 1) * BIN)
                break
            left -= n
        few = kind == 1 and sum(n for _, n in of) < LEAST_SAMPLE
        model.cuts[kind] = max(cut, model.cuts[2]) if few else cut
    return model


def secret_spans(text: str, model: Markov) -> list[tuple[int, int, int]]:
    """Base spans and Markov spans, which touch no base span, by start and kind."""
    spans = base_spans(text)
    spans += [(m.start(), 3, m.end()) for m in _outside(text, spans, TOKEN) if model.is_random(m[0])]
    return sorted(spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every run of overlapping spans replaced by a mark."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], "[secret]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, model: Markov, keep: list[str], clean: str | None = None) -> DataFrame:
    """The ``keep`` columns of every row with its ``spans`` and, if ``clean`` names it, the redacted text.

    Null texts count as empty and have no spans; repeated rows are scanned alike; texts of any length are read whole;
    an empty table gives no rows.
    """
    names = [*keep, *([clean] if clean else []), "spans"]
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = StructType([*source.select(*keep).schema.fields])
    if clean:
        schema = schema.add(clean, "string")
    schema = schema.add("spans", docs.sparkSession.range(0).select(F.lit(None).cast(SPAN)).schema[0].dataType)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["__text"].to_pylist()
            found = [secret_spans(t or "", model) for t in texts]
            columns = [batch[k] for k in keep]
            if clean:
                columns.append(pa.array([t if t is None else redact(t, s) for t, s in zip(texts, found)], pa.string()))
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in f] for f in found]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, SPAN_ARROW)], names)

    return source.mapInArrow(scan, schema)


def secret_documents(docs: DataFrame, sample_docs: int = TRAIN_DOCS) -> DataFrame:
    """Counts, digest and list of the spans of every document row."""
    found = find_secrets(docs, train(docs, sample_docs), ["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
