"""Periodic run detection by multi-scale minimizers.

A run is a stretch of words whose smallest period fits into it twice and that no
neighbouring word extends. Inside a run, equal windows stand one period apart, so
their minima do too. At the scale of g-word grams a window holds 2g words; the
smallest gram of every window is its minimizer, pairs of equal minimizers 4g to 8g
apart are seeds, and a seed is extended to both sides as far as the words agree.
Periods below ``SHORT`` are found by comparing the words with themselves at that lag.

Grams are compared by exact names: grams of 2g words are named by the names of their
halves, and only those that occur again keep a name, so scales end where nothing
repeats. Longest agreements are found on the same names, halving the step.

Grams inside a run whose period fits into the gram twice are no minimizers: they
would repeat everywhere in that run. What they could find are runs whose period block
lies wholly in such a run; the next block then lies in the adjoining run of that
period, and such neighbours give their seeds directly (``_across``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from verdigris.llm.common import let, words_of

SHORT = 16  # smaller periods are found by direct lag scans
MIN_LENGTH = 12
CHUNK_WORDS = 1 << 17  # texts are scanned together up to so many words
RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"
RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def gram_names(words: np.ndarray) -> list[np.ndarray]:
    """Per level k the names of the grams of 2^k words; equal names are equal grams, -1 is a gram that occurs once.

    ``words`` holds small integers, equal for equal words; the last level has a repeated gram (but for level 0).
    """
    n = len(words)
    names = [np.where(np.bincount(words, minlength=1)[words] > 1, words, -1)]
    while True:
        low, g = names[-1], 1 << (len(names) - 1)
        at = np.flatnonzero((low[:max(0, n - g)] >= 0) & (low[g:] >= 0))
        codes = pd.factorize(low[at] * (n + 1) + low[at + g])[0]
        again = np.bincount(codes, minlength=1)[codes] > 1
        if not again.any():
            return names
        high = np.full(n, -1, dtype=np.int64)
        high[at[again]] = codes[again]
        names.append(high)


def _agree(names: list[np.ndarray], left: np.ndarray, lag: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``left`` on (step 1) or before it (step -1) equal those ``lag`` words later."""
    n, length = len(names[0]), np.zeros(len(left), dtype=np.int64)
    for k in range(len(names) - 1, -1, -1):
        a = left + length if step > 0 else left - length - (1 << k)
        ok = (a >= 0) & (a + lag < n)
        a, b = np.where(ok, a, 0), np.where(ok, a + lag, 0)
        ok &= (names[k][a] >= 0) & (names[k][a] == names[k][b])
        length += ok.astype(np.int64) << k
    return length


def _extend(names: list[np.ndarray], left: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the stretches around the seeds that the lag fits into twice."""
    before, after = _agree(names, left, lag, -1), _agree(names, left, lag, 1)
    ok = before + after >= lag
    return np.unique(np.stack([left - before, left + after + lag, lag], axis=1)[ok], axis=0)


def _by_lag(words: np.ndarray, lag: int) -> np.ndarray:
    same = np.zeros(max(0, len(words) - lag) + 2, dtype=np.int8)
    same[1:-1] = words[lag:] == words[:-lag] if len(words) > lag else 0
    edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
    edges = edges[edges[:, 1] - edges[:, 0] >= lag]
    return np.stack([edges[:, 0], edges[:, 1] + lag, np.full(len(edges), lag)], axis=1)


def _smallest(runs: list[np.ndarray]) -> np.ndarray:
    """Of rows with one start and end that with the smallest period, by start and end."""
    rows = np.concatenate(runs)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def _seeds(names: np.ndarray, g: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags, from 4g to less than 8g, of equal minimizers of windows of 2g words."""
    none = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    inner = runs[(2 * runs[:, 2] <= g) & (runs[:, 1] - runs[:, 0] >= g)]
    depth = np.zeros(len(names) + 1, dtype=np.int64)
    np.add.at(depth, inner[:, 0], 1)
    np.add.at(depth, inner[:, 1] - g + 1, -1)
    usable = (names >= 0) & (np.cumsum(depth[:-1]) == 0)
    if len(names) <= g or not usable.any():
        return none
    last = np.iinfo(np.int64).max
    mixed = (names * 0x5BD1E995) & 0x7FFFFFFF  # another order than that of first occurrence; no two names meet
    smallest = np.where(usable, (mixed << 32) | np.arange(len(names)), last)
    width = 1
    while 2 * width <= g + 1:
        smallest = np.minimum(smallest[:-width], smallest[width:])
        width *= 2
    rest = g + 1 - width
    if rest:
        smallest = np.minimum(smallest[:-rest], smallest[rest:])
    at = np.unique(smallest[smallest < last]) & 0xFFFFFFFF  # by name, then place
    key, found = names[at], []
    for j in count(1):
        if j >= len(at):
            break
        lag = at[j:] - at[:-j]
        near = (key[j:] == key[:-j]) & (lag < 8 * g)
        if not near.any():  # equal grams of one name lie more than g / 2 apart, so this ends soon
            break
        seed = near & (lag >= 4 * g)
        found.append((at[:-j][seed], lag[seed]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else none


def _across(names: list[np.ndarray], runs: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of runs whose blocks lie in two adjoining runs of one period d, low <= d < high; lags are 8d or more."""
    some = runs[(runs[:, 2] >= low) & (runs[:, 2] < high) & (runs[:, 1] - runs[:, 0] >= np.maximum(SHORT, 8 * runs[:, 2]))]
    some = some[np.lexsort((some[:, 0], some[:, 2]))]
    meet = np.flatnonzero((some[1:, 2] == some[:-1, 2]) & (some[1:, 0] <= some[:-1, 1])) if len(some) > 1 else []
    left, lags = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for i in meet:
        (s, e, d), (s2, e2, _) = some[i].tolist(), some[i + 1].tolist()
        k = d.bit_length() - 1
        at = np.arange(s, s + d)  # where the first run's block begins as the second run does
        rest = d - (1 << k)
        same = at[(names[k][at] == names[k][s2]) & (names[k][at + rest] == names[k][s2 + rest])]
        if len(same):
            least = max(SHORT, 8 * d)
            lag = np.arange(least + (s2 - int(same[0]) - least) % d, min(e - s, e2 - s2) + 1, d)
            left.append(np.maximum(s2 - lag, s))
            lags.append(lag)
    return np.concatenate(left), np.concatenate(lags)


def find_runs(words: np.ndarray) -> np.ndarray:
    """Rows (start, end, period), by start and end, of all runs that hold their smallest period twice."""
    if len(words) < 2:
        return np.empty((0, 3), dtype=np.int64)
    runs = _smallest([_by_lag(words, lag) for lag in range(1, SHORT)])
    names = gram_names(words)
    runs = _smallest([runs, _extend(names, *_across(names, runs, 1, SHORT))])
    for k in range(2, len(names)):
        g = 1 << k
        runs = _smallest([runs, _extend(names, *_seeds(names[k], g, runs))])
        runs = _smallest([runs, _extend(names, *_across(names, runs, 4 * g, 8 * g))])
    return runs


def _scan_texts(texts: list[bytes], min_length: int) -> tuple[list, list, list]:
    """Word counts, runs (arrays of start, length, period) and texts without repeated periods."""
    split = [t.split() for t in texts]  # bytes: ASCII white space only
    first, total = [], 0
    for w in split:  # a word is named by its first place in its text, so texts share no names
        seen: dict[bytes, int] = {}
        first.append(np.fromiter(map(seen.setdefault, w, count(total)), dtype=np.int64, count=len(w)))
        total += len(w)
    runs = find_runs(np.concatenate(first) if first else np.empty(0, dtype=np.int64))
    runs = runs[runs[:, 1] - runs[:, 0] >= min_length]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(runs[:, 0], np.concatenate([[0], ends]))  # no run crosses from text to text
    out_runs, out_texts = [], []
    for i, w in enumerate(split):
        own = runs[cuts[i]:cuts[i + 1]] - np.array([ends[i] - sizes[i], ends[i] - sizes[i], 0])
        own = own[np.lexsort((own[:, 2], own[:, 0]))]
        if len(own):
            cover = np.zeros(len(w) + 1, dtype=np.int64)
            np.add.at(cover, own[:, 0] + own[:, 2], 1)
            np.add.at(cover, own[:, 1], -1)
            w = [w[j] for j in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
        out_runs.append(np.stack([own[:, 0], own[:, 1] - own[:, 0], own[:, 2]], axis=1))
        out_texts.append(b" ".join(w))
    return sizes.tolist(), out_runs, out_texts


def periodic_runs(docs: DataFrame, keep: list[str], text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """The ``keep`` columns of every row, its word count, its runs by start and period, and its collapsed text.

    Words are split at ASCII white space. A run has at least ``min_length`` words; the collapsed text joins
    by single spaces the words that no run holds after its first period. A null text has no words, no runs
    and an empty collapsed text; repeated rows are treated alike; texts of any length are scanned whole, and
    an empty table gives no rows. The columns ``n_words``, ``runs`` and ``collapsed`` are added.
    """
    source = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    schema = StructType(source.select(*keep).schema.fields)
    extra = docs.sparkSession.range(0).select(F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUN).alias("runs"),
                                              F.lit("").alias("collapsed")).schema.fields
    for f in extra:
        schema = schema.add(f.name, f.dataType)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["__text"].to_pylist()
            at = 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end]) <= 6 * CHUNK_WORDS):
                    held += len(texts[end])
                    end += 1
                sizes, runs, plain = _scan_texts(texts[at:end], min_length)
                rows = np.concatenate(runs)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(rows[:, j])) for j in range(3)], fields=list(RUN_ARROW)))
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in keep], pa.array(sizes, pa.int64()), listed, pa.array(plain, pa.binary()).cast(pa.string())],
                    [*keep, "n_words", "runs", "collapsed"])
                at = end

    return source.mapInArrow(scan, schema)


def repeated_tail(text: Column, h: Column) -> Column:
    """The text with its words from one on repeated with a period; place and period follow from the hash ``h``.

    Of n words, word i >= a becomes word a + (i - a) % p, where g = floor(h / 10), a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). A text without words, or a null hash, is left as it is.
    """
    g = F.floor(h / 10)

    def rewrite(words: Column) -> Column:
        n = F.size(words).cast("long")
        return let(F.struct((g % n).alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8))).alias("p")), lambda x: F.array_join(
            F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(
                i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int"))), " "))

    return F.when(h.isNotNull() & (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]")) > 0), let(words_of(text), rewrite)).otherwise(text)


def run_documents(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Number, longest run and digests of every document row, a tenth of them rewritten by ``repeated_tail``.

    A row without doc_id is not rewritten.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    texts = docs.select("doc_id", F.when(h % 10 == 0, repeated_tail(F.col("text"), h)).otherwise(F.col("text")).alias("text"))
    found = periodic_runs(texts, ["doc_id"], min_length=min_length)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return found.withColumn("__best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("__best.start")).alias("start"),
        F.col("__best.length").alias("length"), (-F.col("__best.period")).alias("period"),
        F.floor(1000 * F.col("__best.length") / -F.col("__best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
