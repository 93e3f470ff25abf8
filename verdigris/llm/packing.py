"""Best-fit packing of tokenised documents by matching large items.

Only lengths matter to a packing, and there are at most ``capacity`` of them.
So the plan is made on the histogram of lengths: pieces above a third of the
capacity are matched greedily, at most two in a sequence; smaller pieces go
longest first into the smallest gap that holds them. A plan row says that the
pieces of one length with ranks r, r+1, ... lie q to a sequence from sequence s
on, at a fixed offset; every piece finds its row by its rank in its length.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from verdigris.llm.common import number_within
from verdigris.session import materialize

CAPACITY, END_ID = 4096, 1
CACHE_PARTS, CACHE_WORDS = 1_000_000, 200_000
#: ASCII and letters that lower one to one
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*").fullmatch
# Fixed value: how the tokenizer splits words, for such texts in lower case
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+").findall
PIECE = {"piece": (IntegerType(), pa.int32()), "start": (LongType(), pa.int64()), "length": (LongType(), pa.int64()),
         "ids_crc32": (LongType(), pa.int64())}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Ids(dict):
    """Ids of what was asked before; computes what is missing and forgets all when full."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        self[key] = ids = self.compute(key)
        return ids


class WordEncoder:
    """Token ids of a text, part by part with a bounded cache.

    The tokenizer lowers case, drops white space and never joins across it, so
    a text's ids are its words' ids in turn. Texts of plain Latin letters and
    ASCII are split like the tokenizer splits words, so that fewer different
    parts are to be encoded, and go to its merges at once; all others are split
    at white space only and encoded in full.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        encode, merge = tokenizer.encode, tokenizer.model.tokenize
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        table = {c: as_bytes(chr(c))[0][0] for c in range(0xDF, 0x100)}

        def part_ids(part: str) -> bytes:
            found = [t.id for t in merge(part.translate(table))]
            return struct.pack(f"<{len(found)}I", *found)

        def word_ids(word: str) -> bytes:
            found = encode(word, add_special_tokens=False).ids
            return struct.pack(f"<{len(found)}I", *found)

        self.parts, self.words = _Ids(part_ids, CACHE_PARTS), _Ids(word_ids, CACHE_WORDS)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if "<|" not in text and PLAIN(text):
            return b"".join(map(self.parts.__getitem__, PARTS(text.lower())))
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.words.__getitem__, words))


_ENCODERS: dict[str, WordEncoder] = {}


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document row (null text: empty), its end id included."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    source = docs.select("doc_id", "text")
    schema = StructType([source.schema["doc_id"]])
    for name, (kind, _) in PIECE.items():
        schema = schema.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path or tokenizer_path()
        if where not in _ENCODERS:  # once a Python worker
            _ENCODERS[where] = WordEncoder(where)
        encoder = _ENCODERS[where]
        step = 4 * capacity
        for batch in batches:
            out = []
            for row, text in enumerate(batch["text"].to_pylist()):
                ids = memoryview(encoder.encode(text or "") + end)
                out += [(row, j // step, j // 4, min(step, len(ids) - j) // 4, zlib.crc32(ids[j:j + step]))
                        for j in range(0, len(ids), step)]
            row, *columns = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(row, pa.int64())), *[pa.array(c, t) for c, (_, t) in zip(columns, PIECE.values())]], schema.names)

    return source.mapInArrow(cut, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces a sequence, offset) of a packing."""
    rows: list[tuple[int, int, int, int, int]] = []
    left = dict(histogram)
    ranked = dict.fromkeys(histogram, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []  # gaps in use, in order
    opened = 0

    def put(length: int, first: int, n: int, each: int, offset: int) -> None:
        rows.append((length, ranked[length], first, each, offset))
        ranked[length] += n
        left[length] -= n

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    large = sorted(x for x in left if 3 * x > capacity)
    for a in reversed(large):
        while left[a]:
            # the largest partner that fits: at most a itself
            at = bisect_left(large, min(a, capacity - a) + 1) - 1
            while at >= 0 and (not left[large[at]] or (large[at] == a and left[a] < 2)):
                at -= 1
            if at < 0:
                n, b = left[a], 0
                put(a, opened, n, 1, 0)
            elif (b := large[at]) == a:
                n = left[a] // 2
                put(a, opened, 2 * n, 2, 0)
            else:
                n = min(left[a], left[b])
                put(a, opened, n, 1, 0)
                put(b, opened, n, 1, a)
            leave(capacity - a - b, opened, n)
            opened += n
    for x in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[x]:
            at = bisect_left(sizes, x)
            if at == len(sizes):
                n = -(-left[x] // (capacity // x))
                leave(capacity, opened, n)
                opened += n
                continue
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            each = min(gap // x, left[x])
            full = min(n, left[x] // each)
            put(x, first, full * each, each, capacity - gap)
            leave(gap - each * x, first, full)
            leave(gap, first + full, n - full)
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Place of every piece: ``pieces`` columns with sequence_id and offset.

    Repeated rows and ids are packed each by itself, ids of any type stay as they are, an empty
    or null text is its end id alone, a text of any length is cut into pieces, an empty table
    gives no rows. The driver holds the histogram (at most ``capacity`` rows) and the plan made
    from it.
    """
    cut = materialize(pieces(docs, path, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan(counts, capacity)
    numbered = number_within(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "__rank")
    key = rows[:, 0].astype(object) * (1 << 48) + rows[:, 1].astype(object)  # length, then first rank
    keys = np.array(key.tolist(), dtype=np.int64)

    numbered = numbered.select("doc_id", *PIECE, "__rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b["length"].to_numpy(), b["__rank"].to_numpy()
            r = rows[np.searchsorted(keys, length * (1 << 48) + rank, side="right") - 1]
            nth = rank - r[:, 1]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in ("doc_id", *PIECE)], pa.array(r[:, 2] + nth // r[:, 3]),
                                              pa.array(r[:, 4] + nth % r[:, 3] * length)], ["doc_id", *PIECE, "sequence_id", "offset"])

    return numbered.mapInArrow(place, cut.schema.add("sequence_id", "long").add("offset", "long"))
