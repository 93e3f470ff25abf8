"""Spelling variant grouping by a frequency-vector trie.

A word's vector counts its letters by letter group; the trie branches by the counts of
successive groups. Two words one edit apart differ by a deficit of at most one and a
surplus of at most one, so a search walks the trie depth first with a budget of one
each. Of every pair, the word that is larger by (vector, length, word) searches for the
other: it meets the deficit before the surplus, and each pair is found once. The words
of a leaf are verified letter by letter.

The upper trie is spread over the cluster: a node of more than ``NODE`` words is split
by its next ``STEP`` counts, and searches go on to the nodes below it that their budget
reaches. Every other node is one part: a task holds its words, its searches pass as
a stream, many of them in chunks. A full vector shared by more than ``NODE``
words is split once more by halves of the words, of which one edit leaves one whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.session import materialize

#: fixed values: the letter groups from the most frequent letter on; accented letters join by their code point
GROUPS = "etaoinsrhldcumfpgwybvkxjqz"
RUNS = re.compile("[a-zÀ-ÿ]+")
MIN_POINTS, MIN_COUNT = 6, 5
TIMES = 5  # a form is at least so many times as frequent as the word
EVERY = 199
NODE = 4096
STEP = 4
SEARCHES = 1 << 14  # of one chunk, about
LEAF = 4
FLUSH = 200_000  # distinct words held while counting


def _group(letter: str) -> int:
    at = ord(letter) - ord("a") if letter <= "z" else ord(letter)
    return GROUPS.index(chr(ord("a") + at % len(GROUPS)))


PLACE = {c: _group(c) for c in map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])}


def vector(word: str) -> str:
    """Counts by group, one character each; counts of 74 or more share one character."""
    counts = [48] * len(GROUPS)
    for c in word:
        counts[PLACE[c]] += 1
    return "".join(chr(min(x, 122)) for x in counts)


def spell(run: str, seed: int) -> str:
    """The run, without one code point if ``EVERY`` divides the crc32 of ``<doc_id>:<run>``; ``seed`` is that of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), seed)
    return run if h % EVERY else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, min_points: int = MIN_POINTS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words of at least ``min_points`` code points that occur ``min_count`` times.

    Words are counted in every task before they are shuffled. A null text has no words, a row without doc_id
    counts as one whose doc_id is the empty text; repeated rows count each.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in Counter(RUNS.findall(text.lower().decode())).items():  # bytes: A-Z only
                    if len(run) >= min_points and len(word := spell(run, seed)) >= min_points:
                        total[word] += n
                if len(total) > FLUSH:
                    yield out()
                    total.clear()
        yield out()

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return (texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point inserted, deleted or replaced makes one word the other."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i + 1:] == b[i:]


def build(words: list[tuple[bytes, int, str, int]], level: int = 0) -> dict | list:
    """The trie of (vector, length, word, n) from ``level`` on; few words are kept as a list."""
    if len(words) <= LEAF or level == len(GROUPS):
        return words
    below: dict[int, list] = {}
    for w in words:
        below.setdefault(w[0][level], []).append(w)
    return {c: build(x, level + 1) for c, x in below.items()}


def reach(trie: dict | list, vec: bytes) -> list[tuple[bytes, int, str, int]]:
    """The words of all leaves within the budget, depth first; the deficit is spent before the surplus."""
    found, stack = [], [(trie, 0, True, True)]
    while stack:
        node, level, deficit, surplus = stack.pop()
        if type(node) is list:
            found += node
            continue
        c = vec[level]
        if (same := node.get(c)) is not None:
            stack.append((same, level + 1, deficit, surplus))
        if deficit and (less := node.get(c - 1)) is not None:
            stack.append((less, level + 1, False, True))
        elif not deficit and surplus and (more := node.get(c + 1)) is not None:
            stack.append((more, level + 1, False, False))
    return found


def nodes_within(vec: str, depth: int) -> Iterator[str]:
    """The prefixes of ``depth`` counts that a search may visit, itself first."""
    head = vec[:depth]
    yield head
    for i in range(depth):
        less = head[:i] + chr(ord(head[i]) - 1) + head[i + 1:]
        if head[i] > "0":
            yield less
            for j in range(i + 1, depth):
                if head[j] < "z":
                    yield less[:j] + chr(ord(less[j]) + 1) + less[j + 1:]


def _halves(words: DataFrame, longer: bool) -> DataFrame:
    """``node`` replaced by keys of the word's halves: its own, or (``longer``) those of words one letter shorter too."""
    def keys(less: int) -> list:
        size = F.char_length("word") - less
        half = F.floor(size / 2).cast("int")
        tail = size - half
        return [F.concat_ws("|", "node", F.lit(kind), size.cast("string"), part) for kind, part in (
            ("head", F.substr("word", F.lit(1), half)), ("tail", F.substr("word", F.char_length("word") - tail + 1, tail)))]

    return words.withColumn("node", F.explode(F.array(*keys(0), *(keys(1) if longer else []))))


def near_pairs(words: DataFrame, node: int = NODE, step: int = STEP) -> DataFrame:
    """word, n, other, other_n of every pair of words one edit apart, in both directions; ``words`` has distinct word, n."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["word"], b["n"], pa.array(map(vector, b["word"].to_pylist()), pa.string())], ["word", "n", "vec"])

    def visit(depth: int, before: int):
        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, to = [], []
                for i, (vec, held) in enumerate(zip(b["vec"].to_pylist(), b["node"].to_pylist())):
                    for x in nodes_within(vec, depth):
                        if x[:before] == held:
                            at.append(i)
                            to.append(x)
                yield pa.RecordBatch.from_arrays([*[b[c].take(pa.array(at, pa.int64())) for c in ("word", "n", "vec")], pa.array(to, pa.string())],
                                                 ["word", "n", "vec", "node"])
        return go

    columns = ["node", "word", "n", "vec"]
    known = materialize(words.select("word", "n").mapInArrow(measure, "word string, n long, vec string"), "vectors")
    total = known.count()
    at_root = known.withColumn("node", F.lit("")).select(columns)
    held, asked = (at_root, at_root) if total <= node else (at_root.limit(0), at_root.limit(0))
    open_, searches, depth = at_root, at_root, 0
    while total > node:
        depth, before = min(depth + step, len(GROUPS)), depth
        placed = open_.withColumn("node", F.substring("vec", 1, depth))
        sizes = materialize(placed.groupBy("node").agg(F.count(F.lit(1)).alias("size")), "nodes")
        searches = materialize(searches.select("word", "n", "vec", "node")
                               .mapInArrow(visit(depth, before), "word string, n long, vec string, node string")
                               .join(sizes, "node").select(*columns, (F.col("size") > node).alias("large")), "searches")
        placed = materialize(placed.join(sizes, "node").select(*columns, (F.col("size") > node).alias("large")), "placed")
        held = held.unionByName(placed.where("NOT large").select(columns))
        asked = asked.unionByName(searches.where("NOT large").select(columns))
        open_, searches = placed.where("large").select(columns), searches.where("large").select(columns)
        if open_.isEmpty():
            break
        if depth == len(GROUPS):
            held, asked = held.unionByName(_halves(open_, False)), asked.unionByName(_halves(searches, True))
            break
    per = asked.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / SEARCHES).cast("int").alias("chunks"))
    per = materialize(per, "chunks")
    words_of_node = (held.join(per, "node").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                     .select(*columns, "chunk", F.lit(0).alias("search")))
    searches_of_node = (asked.join(per, "node").withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
                        .select(*columns, "chunk", F.lit(1).alias("search")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own, trie = None, [], None
        for b in batches:
            found = []
            for at, word, n, vec, asks in zip(zip(b["node"].to_pylist(), b["chunk"].to_pylist()), b["word"].to_pylist(),
                                              b["n"].to_pylist(), b["vec"].to_pylist(), b["search"].to_pylist()):
                if at != here:
                    here, own, trie = at, [], None
                me = (vec.encode(), len(word), word, n)
                if not asks:
                    own.append(me)
                    continue
                if trie is None:
                    trie = build(own)
                for it in reach(trie, me[0]):
                    if len(word) - it[1] <= 1 and it[:3] < me[:3] and one_edit(word, it[2]):
                        found += ((word, n, it[2], it[3]), (it[2], it[3], word, n))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*found) if found else [()] * 4, (pa.string(), pa.int64(), pa.string(), pa.int64()))], ["word", "n", "other", "other_n"])

    pairs = (words_of_node.unionByName(searches_of_node).repartition("node", "chunk").sortWithinPartitions("node", "chunk", "search")
             .select("node", "chunk", "word", "n", "vec", "search").mapInArrow(search, "word string, n long, other string, other_n long"))
    return pairs.distinct() if depth == len(GROUPS) else pairs  # halves may find a pair twice


def variants(words: DataFrame, times: int = TIMES, node: int = NODE, step: int = STEP) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (distinct word, and its n).

    A form is the near word of largest n (ties: the smallest), if that is ``times`` the word's or more. A
    root follows the forms to the last: each is ``times`` as frequent as the one before, so there are few.
    An empty table gives no rows.
    """
    words = materialize(words, "words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = near_pairs(words, node, step).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.n") >= times * F.col("n")
    out = materialize(joined.select("word", F.when(is_form, F.col("best.word")).alias("form"), "n",
                                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                    F.when(is_form, -F.col("best.n")).alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or 1
    to = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(2.0, math.log(most, times))))):  # pointers double their reach
        then = to.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        to = materialize(to.join(then, "root", "left").select("word", F.coalesce("__next", "root").alias("root")), "roots")
    return (out.join(to, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def variant_documents(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of all documents."""
    return variants(word_counts(docs))
