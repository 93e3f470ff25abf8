"""N-gram Jaccard join by a grouped prefix join.

A document's set holds the 64-bit hashes of its distinct word n-grams. Under
one global order, rare n-grams first, two sets of Jaccard similarity t or more
share an n-gram of their prefixes, the first n - ceil(t * n) + 1. Rows with equal
sets fall into one class, classes of equal size and prefix into one group. Groups
that share a prefix n-gram are candidates; their members are expanded and
verified on whole sets.

Candidates are compared by parity sketches first: the number of differing bits
is a lower bound of the symmetric difference, so no link is lost. Components
need no more links than connect them. In the first rounds the members of a
token lie in blocks, and in each block every member is verified against its
nearest member of another component. The last round looks at all pairs of a
token's members that pass the sketch and are still apart: the members of
its largest component against the others, and the others among themselves. No
link that could join two components is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from verdigris.session import materialize

WORDS, PERCENT = 4, 85
HEAVY = 1 << 18  # most frequent n-grams whose order is by count; the others are ordered by hash, before them
MIN_IN_BATCH = 3
CHUNK = 64
BLOCK = 1024
FEW = 8
EARLY = 4  # postings of a group that the first round looks at
SHARE = 1000  # a token with at least 1/SHARE of the rows is hot
WIDE_FROM = 64  # members of a token from which on wide sketches are compared
FEATURES = "t long, n long, f1 long, f2 long, g long, prefix array<long>, short binary, sketch binary"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams; A-Z lower-cased, all words as one gram if fewer."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only, and ASCII white space
    if not w:
        return np.empty(0, dtype=np.uint64)
    h = pd.util.hash_array(np.array(w, dtype=object), categorize=False)
    n = min(words, len(w))
    out = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(w) - n + 1 + i]
    return np.unique(_mix(out))


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Parity bits of a set, four to eight a member: how many members hash to a bit, modulo 2."""
    bits = max(512, 1 << (4 * len(s) - 1).bit_length())
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def short_sketch(sketch: bytes) -> bytes:
    """A sketch folded to a quarter, one to two bits a member."""
    x = np.frombuffer(sketch, dtype=np.uint64)[None, :]
    return _fold(x, max(8, x.shape[1] // 4)).tobytes()


def _fold(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) brought to ``width`` words; bounds stay bounds."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def heavy_shingles(docs: DataFrame, words: int = WORDS, most: int = HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` most frequent n-grams at most, rarest first, and their counts over all documents.

    Each Arrow batch reports the n-grams that it holds several times; only the order of
    comparison and the way of hot n-grams depend on them, never a result.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingle_set(t, words) for t in b["text"]]
            h, n = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_counts=True)
            often = n >= MIN_IN_BATCH
            yield pd.DataFrame({"h": _as_long(h[often]), "n": n[often]})

    top = (docs.select("text").mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "h").limit(most).toPandas())
    return top["h"].to_numpy(dtype=np.int64)[::-1].view(np.uint64), top["n"].to_numpy(dtype=np.int64)[::-1]


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shingle_features(docs: DataFrame, heavy: np.ndarray, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id as it is, t (hash of the text), n (set size), f1 and f2 (fingerprint of the set), g (of
    the prefix), prefix and sketch."""
    at = np.argsort(heavy, kind="stable")
    known, place = heavy[at], (at + 1).astype(np.int64)
    source = docs.select("doc_id", text_hash(F.col("text")).alias("t"), "text")
    schema = StructType([source.schema["doc_id"]])
    for f in docs.sparkSession.createDataFrame([], FEATURES).schema:
        schema = schema.add(f)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers, prefixes, shorts, sketches = [], [], [], []
            for text in b["text"].to_pylist():
                s = shingle_set(text, words)
                if len(s) == 0:
                    numbers.append((0, 0, 0, 0))
                    prefixes.append(np.empty(0, np.int64))
                    shorts.append(b"")
                    sketches.append(b"")
                    continue
                order = np.zeros(len(s), dtype=np.int64)
                if len(known):
                    i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    order = np.where(known[i] == s, place[i], 0)
                p = s[np.argsort(order, kind="stable")[:prefix_length(len(s), percent)]]
                numbers.append((len(s), *[int(_as_long(x.sum(keepdims=True))[0]) for x in (_mix(s), _mix(s ^ np.uint64(0xA5A5A5A5)), _mix(p))]))
                prefixes.append(_as_long(p))
                sketches.append(parity_sketch(s).tobytes())
                shorts.append(short_sketch(sketches[-1]))
            numbers = np.array(numbers, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["t"], *[pa.array(np.ascontiguousarray(numbers[:, i])) for i in range(4)],
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(shorts, pa.binary()), pa.array(sketches, pa.binary())], schema.names)

    return source.mapInArrow(measure, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of an edge: the smallest node of its component.

    Every node points to its smallest neighbour and edges are contracted along the pointers until
    none is left; each round at least halves the nodes that still have edges.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "edges")
    label = None
    while not e.isEmpty():
        both = e.union(e.select("b", "a"))
        to = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("to")), "pointers")
        end = lambda side: to.select(F.col("node").alias(side), F.col("to").alias(f"to_{side}"))  # noqa: E731,B023
        e = materialize(e.join(end("a"), "a").join(end("b"), "b").where("to_a <> to_b")
                        .select(F.greatest("to_a", "to_b").alias("a"), F.least("to_a", "to_b").alias("b")).distinct(), "edges")
        if label is None:
            label = to.select("node", F.col("to").alias("label"))
        else:
            step = to.select(F.col("node").alias("label"), "to")
            label = materialize(label.join(step, "label", "left")
                                .select("node", F.coalesce("to", "label").alias("label")), "labels")
    return label if label is not None else e.select(F.col("a").alias("node"), F.col("b").alias("label"))


def verified(pairs: DataFrame, texts: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough.

    The members a of a hub b are dealt into chunks of about ``CHUNK``; a chunk's rows stand sorted, the hub
    first, so a task holds one hub's set and one member at a time.
    """
    sized = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("__n"))
    chunk = F.pmod(F.xxhash64("a"), F.ceil(F.col("__n") / CHUNK))
    dealt = materialize(pairs.join(sized, "b").select("a", "b", chunk.alias("chunk")), "pairs")
    member = dealt.join(texts.withColumnRenamed("id", "a"), "a").select("b", "chunk", "a", F.lit(1).alias("member"), "text")
    hub = (dealt.select("b", "chunk").distinct().join(texts.withColumnRenamed("id", "b"), "b")
           .select("b", "chunk", F.lit(None).cast("long").alias("a"), F.lit(0).alias("member"), "text"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.empty(0, np.uint64)
        for batch in batches:
            out = []
            for a, b, is_member, text in zip(batch["a"], batch["b"], batch["member"], batch["text"]):
                s = shingle_set(text, words)
                if not is_member:
                    held = s
                    continue
                both = len(np.intersect1d(held, s, assume_unique=True))
                if both and 100 * both >= percent * (len(held) + len(s) - both):
                    out.append((int(a), b))
            yield pd.DataFrame(out, columns=["a", "b"])

    return (member.unionByName(hub).repartition("b", "chunk").sortWithinPartitions("b", "chunk", "member")
            .mapInPandas(check, "a long, b long"))


def _apart(ids: np.ndarray, gids: np.ndarray, n: np.ndarray, labels: np.ndarray, sketches: list, first: np.ndarray,
           own_token: bool, percent: int, every: bool) -> list[tuple[int, int, int]]:
    """(a, b, distance) of pairs of one block pair that are in different components and may be similar.

    ``first`` marks the rows of the first block; a pair of two blocks has one row of each. Members of one
    group are compared at their group's own token alone. Only each row's nearest partner unless ``every``.
    """
    out, best = [], {}
    two = not first.all()
    if two and not first.any():
        return out
    widths = np.array([len(x) // 8 for x in sketches])
    for w in np.unique(widths):  # sizes that can be similar differ by one width at most
        rows = np.flatnonzero(widths == w)
        cols = np.flatnonzero((widths == w) | (widths == 2 * w))
        left = np.frombuffer(b"".join(sketches[i] for i in rows), dtype=np.uint64).reshape(len(rows), w)
        right = np.concatenate([_fold(np.frombuffer(sketches[i], dtype=np.uint64)[None, :], w) for i in cols])
        for i, sketch in zip(rows, left):
            ok = (labels[cols] != labels[i]) & (np.minimum(n[cols], n[i]) * 100 >= np.maximum(n[cols], n[i]) * percent)
            ok &= (widths[cols] > w) | (ids[cols] > ids[i])
            if two:
                ok &= first[cols] != first[i]
            if not own_token:
                ok &= gids[cols] != gids[i]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            away = np.bitwise_count(right[at] ^ sketch).sum(axis=1, dtype=np.int64)
            near = away * (100 + percent) <= (n[cols[at]] + n[i]) * (100 - percent)
            for j, d in zip(cols[at[near]].tolist(), away[near].tolist()):
                if every:
                    out.append((int(ids[i]), int(ids[j]), d))
                else:
                    for x, y in ((i, j), (j, i)):
                        if x not in best or (d, ids[y]) < best[x]:
                            best[x] = (d, ids[y])
    return out if every else [(int(ids[x]), int(y), int(d)) for x, (d, y) in best.items()]


def _apart_few(ids, gids, n, labels, sketches, first, own_token: bool, percent: int, every: bool) -> list:
    """``_apart`` for a handful of rows, where plain integers are faster than arrays."""
    ids, gids, n, labels = ids.tolist(), gids.tolist(), n.tolist(), labels.tolist()
    two, out, best = not first.all(), [], {}
    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            if (labels[i] == labels[j] or (two and first[i] == first[j]) or (gids[i] == gids[j] and not own_token)
                    or min(n[i], n[j]) * 100 < max(n[i], n[j]) * percent):
                continue
            width = min(len(sketches[i]), len(sketches[j]))
            x, y = (_folded_int(sketches[k], width) for k in (i, j))
            d = (x ^ y).bit_count()
            if d * (100 + percent) > (n[i] + n[j]) * (100 - percent):
                continue
            if every:
                out.append((ids[i], ids[j], d))
            else:
                for x, y in ((i, j), (j, i)):
                    if x not in best or (d, ids[y]) < best[x]:
                        best[x] = (d, ids[y])
    return out if every else [(ids[x], y, d) for x, (d, y) in best.items()]


def _folded_int(sketch: bytes, width: int) -> int:
    """A sketch as one integer, brought to ``width`` bytes."""
    x, size = int.from_bytes(sketch, "little"), len(sketch)
    while size > width:
        size //= 2
        x = (x >> (8 * size)) ^ (x & ((1 << (8 * size)) - 1))
    return x


def candidates(postings: DataFrame, members: DataFrame, percent: int, every: bool, seed: int) -> DataFrame:
    """Pairs (a, b, distance) of members that share a token, pass the sketch and are still apart.

    ``postings``, a written table, has token, gid, id and label, ``members`` id, n, short and sketch; sketches travel
    only with tokens that still span several components, the wide ones only where ``every`` pair of many is looked at. A token's members are dealt into blocks of about
    ``BLOCK`` by ``seed``. Only members of one block are compared, each with its nearest, unless ``every``: then
    all blocks are compared with each other but those of the token's largest component, whose members are compared
    with the others alone. Tokens are counted before they are joined, and hot ones, at most ``SHARE``, are broadcast.
    """
    per = postings.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    sized = materialize(per.groupBy("token").agg(F.sum("n").alias("size"), F.max("n").alias("most"), F.max_by("label", "n").alias("major"),
                                                 (F.count(F.lit(1)) > 1).alias("open")), "tokens")
    least = max(2, -(-(sized.agg(F.sum("size")).first()[0] or 0) // SHARE))
    hot = F.broadcast(sized.where(F.col("size") >= least))
    cold = sized.where((F.col("size") < least) & F.col("open"))
    open_ = (postings.join(hot, "token").where("open").unionByName(
        postings.join(hot.select("token"), "token", "left_anti").join(cold, "token")))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK).cast("int"))
    place = lambda n: F.pmod(F.xxhash64(F.lit(seed), "id"), n).cast("int")
    part = lambda kind, lo, hi, first: F.struct(F.lit(kind).alias("kind"), lo.cast("int").alias("lo"),
                                                hi.cast("int").alias("hi"), first.alias("first"))
    to = lambda n, f: F.transform(F.sequence(F.lit(0), n - 1), f)
    if every:
        is_major, a, b = F.col("label") == F.col("major"), blocks(F.col("most")), blocks(F.col("size") - F.col("most"))
        i = place(F.when(is_major, a).otherwise(b))
        of_major = to(b, lambda j: part(1, i, j, F.lit(True)))
        of_others = F.concat(to(a, lambda j: part(1, j, i, F.lit(False))), to(b, lambda j: part(0, F.least(i, j), F.greatest(i, j), i <= j)))
        parts = F.when(is_major, of_major).otherwise(of_others)
    else:
        i = place(blocks(F.col("size")))
        parts = F.array(part(0, i, i, F.lit(True)))
    wide = F.lit(every) & (F.col("size") >= WIDE_FROM)
    sketch = F.when(F.col("wide"), F.col("sketch")).otherwise(F.col("short"))
    dealt = (open_.select("token", "gid", "id", "label", wide.alias("wide"), parts.alias("parts"))
             .join(members.select("id", "n", "short", "sketch" if every else F.lit(None).cast("binary").alias("sketch")), "id")
             .select("token", "gid", "id", "label", "n", sketch.alias("sketch"), F.explode("parts").alias("part"))
             .select("token", "part.*", "gid", "id", "n", "label", "sketch"))

    def compare(rows: pd.DataFrame, last: bool) -> tuple[list, int]:
        """Pairs of all groups but, unless ``last``, the final one, which may go on; and its first row."""
        key = rows[["token", "kind", "lo", "hi"]].to_numpy()
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), *([len(rows)] if last else [])]
        columns = [rows[c].to_numpy() for c in ("id", "gid", "n", "label")]
        first, sketches, own, out = rows["first"].to_numpy(), rows["sketch"].tolist(), key[:, 0] == columns[1], []
        for s, e in zip(cuts[:-1], cuts[1:]):
            out += (_apart_few if e - s <= FEW else _apart)(
                *[c[s:e] for c in columns], sketches[s:e], first[s:e], bool(own[s:e].all()), percent, every)
        return out, cuts[-1]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(rows):
                out, at = compare(rows, False)
                held = rows.iloc[at:]
                yield pd.DataFrame(out, columns=["a", "b", "d"])
        if held is not None:
            yield pd.DataFrame(compare(held, True)[0], columns=["a", "b", "d"])

    return (dealt.repartition("token", "kind", "lo", "hi").sortWithinPartitions("token", "kind", "lo", "hi")
            .mapInPandas(scan, "a long, b long, d long"))


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members with the label of their component so far."""
    return (members.join(label.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("label", F.coalesce("label", "id")))


def _postings(leads: DataFrame, hot: np.ndarray, percent: int) -> DataFrame:
    """gid, pos, token of the prefix n-grams that a group may share with another of fitting size.

    At the first n-gram that a similar pair shares, neither can have lost too many before it for the
    other's size; and of the groups that hold the n-gram, the next smaller or the next larger must be near enough in
    size. ``hot`` n-grams, at most ``HEAVY``, are taken to have such neighbours.
    """
    spark = leads.sparkSession
    posted = leads.select(F.col("rid").alias("gid"), "n", F.posexplode("prefix").alias("pos", "token"))
    often = F.broadcast(spark.createDataFrame(pd.DataFrame({"token": _as_long(hot)}), "token long").withColumn("__hot", F.col("token")))
    # a posting of a hot n-gram is a part by itself
    posted = posted.join(often, "token", "left").withColumn("__part", F.when(F.col("__hot").isNotNull(), F.col("gid")).otherwise(F.lit(-1)))
    by_token = Window.partitionBy("token", "__part")
    by_size = by_token.orderBy("n")
    fits = lambda m: (F.col("n") - F.col("pos")) * (100 + percent) >= (F.col("n") + F.col(m)) * percent
    near = (((F.col("__less") * 100 >= F.col("n") * percent) & fits("__least"))
            | ((F.col("__more") * percent <= F.col("n") * 100) & fits("__more")))
    posted = (posted.select("*", F.min("n").over(by_size).alias("__least"), F.lag("n").over(by_size).alias("__less"),
                            F.lead("n").over(by_size).alias("__more"))
              .where(F.col("__hot").isNotNull() | near)
              .withColumn("__df", F.count(F.lit(1)).over(by_token)).where(F.col("__hot").isNotNull() | (F.col("__df") > 1)))
    return posted.select("gid", "pos", "token")


def jaccard_rows(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, same_id: bool = False) -> DataFrame:
    """Per row its doc_id, t (hash of the text), rid (a number of its own), n_shingles and label.

    Rows have one label if their texts are linked, directly or over others; a row without words has none. With
    ``same_id`` rows with one doc_id are linked too, whatever their texts. Rows, not ids, are compared: ids may
    be null, repeat, or be of any type. An empty table gives no rows; texts are read whole.
    """
    heavy, often = heavy_shingles(docs, words)
    rows = materialize(shingle_features(docs, heavy, words, percent).withColumn("rid", F.monotonically_increasing_id()), "shingles")
    full = rows.where("n > 0")
    classes = materialize(full.groupBy("n", "f1", "f2").agg(F.min("rid").alias("id"), F.min("g").alias("g")), "classes")
    groups = classes.groupBy("n", "g").agg(F.min("id").alias("gid"), F.count(F.lit(1)).alias("size"))
    groups = materialize(classes.join(groups, ["n", "g"]).select("id", "n", "gid", "size"), "groups")
    leads = full.join(groups.where("id = gid").select(F.col("id").alias("rid")), "rid", "left_semi")
    hot = heavy[often >= max(2, rows.count() // SHARE)]
    # besides shared n-grams, one token of its own for every group of several members
    own = groups.where("id = gid AND size > 1").select("gid", F.lit(-1).alias("pos"), F.col("gid").alias("token"))
    shared = _postings(leads, hot, percent).unionByName(own)
    early = F.row_number().over(Window.partitionBy("gid").orderBy("pos")) <= EARLY
    shared = materialize(shared.select("gid", "token", early.alias("early")), "postings")
    wanted = groups.join(shared.select("gid").distinct(), "gid", "left_semi").select("id", "gid")
    members = materialize(wanted.join(full.select(F.col("rid").alias("id"), "n", "short", "sketch", "doc_id", "t"), "id"), "members")
    # the members' texts; only those of repeated rows are shuffled to leave one of each
    again = rows.groupBy("doc_id", "t").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    same_row = lambda x, y: x["doc_id"].eqNullSafe(y["doc_id"]) & (x["t"] == y["t"])
    named = members.select("id", "doc_id", "t")
    whole = docs.select("doc_id", text_hash(F.col("text")).alias("t"), "text")
    take = lambda ids: whole.join(ids, same_row(whole, ids)).select("id", "text")
    repeated = materialize(named.join(again, same_row(named, again), "left_semi"), "repeated_members")
    once = materialize(named.join(repeated.select("id"), "id", "left_anti"), "single_members")
    # one plan at every size: texts are shuffled to their ids, not ids broadcast while they are few
    texts = materialize(take(once.hint("merge")).unionByName(take(repeated).dropDuplicates(["id"])), "texts")
    links = full.limit(0).select(F.col("rid").alias("a"), F.col("rid").alias("b"))
    if same_id:
        of_id = full.where("doc_id IS NOT NULL").select("doc_id", "n", "f1", "f2").join(classes, ["n", "f1", "f2"]).select("doc_id", "id").distinct()
        first = of_id.groupBy("doc_id").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id", "b")
        links = of_id.join(first, "doc_id").where("id <> b").select(F.col("id").alias("a"), "b")
    links = materialize(links, "links")
    members = members.select("id", "gid", "n", "short", "sketch")
    for step in range(3):
        every = step == 2
        now = _labelled(members.select("id", "gid"), components(links))
        postings = (shared if step else shared.where("early")).select("token", "gid").join(now, "gid")
        found = candidates(materialize(postings.select("token", "gid", "id", "label"), "labelled"), members, percent, every, step)
        if not every:
            found = found.groupBy("a").agg(F.min_by("b", F.struct("d", "b")).alias("b"))
        pairs = found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        links = materialize(links.union(verified(pairs, texts, words, percent)), "links")
    named = materialize(_labelled(classes.select("n", "f1", "f2", "id"), components(links)), "labelled_classes")
    return (rows.select("doc_id", "t", "rid", F.col("n").alias("n_shingles"), "n", "f1", "f2")
            .join(named.select("n", "f1", "f2", "label"), ["n", "f1", "f2"], "left")
            .select("doc_id", "t", "rid", "n_shingles", "label"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, of every row.

    Equal texts are linked, and so are rows that repeat a doc_id, whatever their texts. Rows without words are
    linked with nothing and have their own id. Rows without doc_id link the others as all do; their component_id
    is null if no row of their component has an id.
    """
    rows = materialize(jaccard_rows(docs, words, percent, same_id=True), "labelled_rows")
    first = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    alone = rows.where("label IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows.join(first, "label").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of every component of linked texts, all columns: that of the smallest doc_id (null last), then text hash.

    Rows are linked by their texts alone, so different texts under one doc_id all stay; copies go whether they
    have an id or not. Rows without words are linked with nothing and stay, rows equal in doc_id and text once.
    """
    rows = materialize(jaccard_rows(docs, words, percent), "labelled_rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("t"))
    first = rows.where("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("first")).select("first.doc_id", "first.t")
    kept = materialize(first.unionByName(rows.where("label IS NULL").select("doc_id", "t")).distinct(), "kept")
    whole = docs.withColumn("__t", text_hash(F.col("text")))
    kept = kept.select(F.col("doc_id").alias("__of_id"), F.col("t").alias("__of_t"))
    return (whole.join(kept, F.col("doc_id").eqNullSafe(F.col("__of_id")) & (F.col("__t") == F.col("__of_t")), "left_semi")
            .dropDuplicates(["doc_id", "__t"]).drop("__t"))
