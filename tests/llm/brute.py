"""Plain Python versions of the operators' contracts, over rows held in memory."""

import collections
import hashlib
import math
import re
import zlib

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return SPACE.findall(text or "")


def size_bytes(text):
    return len((text or "").encode()) + 8


def measures(text):
    w = words(text)
    text = text or ""
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    windows = collections.defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i:i + 3])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w)}


def license_places(text, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = [(i, label) for label, phrase in phrases for p in [phrase.split()]
             for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(found)


def secret_digest(text):
    text, out = text or "", []
    kinds = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
             r"AKIA[A-Z0-9]+", r"[0-9a-f]+")
    for k, (pattern, least) in enumerate(zip(kinds, (6, 20, 24))):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m[m.lastindex or 0]) >= least:
                out.append((m.start(), k, m.end()))
    n = [sum(x[1] == k for x in out) for k in range(3)]
    named = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))
    return (*n, hashlib.sha256(named.encode()).hexdigest(), named)


def shingles(text, n=4):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard_components(rows, percent=85, words=4):
    sets = [(d, shingles(t, words)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[i + 1:]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted((d, len(s), find(d)) for d, s in sets)


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """source -> target; sources by code point, None last; the excess is reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, rest = {}, set(order), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if rest * w[s] / total > most * sizes[s]}
        if not over:
            return out | {s: rest * w[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
        rest -= sum(out[s] for s in over)
        open_ -= over
    return out


def pieces(doc_id, ids, capacity=4096):
    import numpy as np

    ids = [*ids, 1]
    return [(doc_id, i // capacity, i, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))
            for i in range(0, len(ids), capacity) for part in [ids[i:i + capacity]]]


def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path, rules):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: len(r[0]), default=None)


def top_k(rows, queries, k=5):
    import math

    import numpy as np

    ok = [(i, np.array([math.floor(256 * float(x)) for x in v])) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q in queries:
            best = sorted((-int((v * u).sum()), i) for i, u in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def more_measures(text):
    """``measures`` and what the certified rules need besides."""
    text = text or ""
    w = words(text)
    return measures(text) | {"n_capitals": sum("A" <= c <= "Z" for c in text),
                             "n_lines": sum(bool(SPACE.search(x)) for x in text.split("\n"))}


def cutoffs(rows, labels, rules, risk, delta):
    """stratum -> rule -> cutoff, from (doc_id, stratum, text) rows and (doc_id, quality) labels."""
    truth = {}
    for doc, q in labels:
        if q is not None:
            truth[doc] = min(q, truth.get(doc, q))
    known, strata = collections.defaultdict(list), {s for d, s, _ in rows if d in truth}
    for doc, stratum, text in rows:
        if truth.get(doc) in (0, 1):
            known[stratum].append((zlib.crc32(str(doc).encode()) % 2 == 0, truth[doc], more_measures(text)))
    tests = max(1, len(strata)) * len(rules)
    p, out = risk / len(rules), {}
    for stratum, found in known.items():
        n = sum(held and q == 1 for held, q, _ in found)
        out[stratum] = {}
        for name, (above, below, grid) in rules.items():
            tried = []
            for c in grid:
                hit = [(held, q) for held, q, m in found if 1000 * m[above] > c * m[below]]
                x, caught = hit.count((True, 1)), hit.count((False, 0))
                bound = sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(x + 1)) if x < n * p else 1
                if bound <= delta / tests and caught:
                    tried.append((caught, c))
            if tried:
                out[stratum][name] = max(tried)[1]
    return out


def kept(text, cuts, rules):
    m = more_measures(text)
    return not m["base_failed"] and not any(1000 * m[rules[r][0]] > c * m[rules[r][1]] for r, c in cuts.items())


def redacted(text, spans):
    """The text with each run of overlapping spans (kind:start:end, comma-joined) replaced by a mark."""
    hidden = set()
    starts = []
    for _, s, e in sorted((x.split(":") for x in spans.split(",") if x), key=lambda x: int(x[1])):
        if int(s) not in hidden:
            starts.append(int(s))
        hidden.update(range(int(s), int(e)))
    return "".join("[secret]" if i in starts else "" if i in hidden else c for i, c in enumerate(text))


def url_templates(rows, wide=20, rare=0.2, prior=10.0, z=2.0, evidence=5):
    """(host, path) -> (template, blocked share, labels it rests on), from (host, path, labelled, blocked) rows, one tree a host."""
    def count(found):
        return sum(r[2] for r in found), sum(r[3] for r in found)

    def purity(found, share, n):
        own, b = count(found)
        return ((b + prior * share) / (own + prior), own) if own >= evidence else (share, n)

    def number(segment):
        return bool(re.fullmatch(r"[0-9]+(\.[A-Za-z]+)?", segment))

    n, b = count(rows)
    overall = b / n if n else 0.0
    ended = {}  # (host, path) -> (template, share and labels of the node above)

    def grow(level, prefix, share, known, found):
        paths = {r[1] for r in found}
        going = collections.defaultdict(list)
        for r in found:
            if len(paths) == 1 or len(r[4]) <= level:
                ended[r[0], r[1]] = ("/".join([prefix, *["{var}" if number(s) else s for s in r[4][level:]]]), share, known)
            else:
                going[r[4][level]].append(r)
        rest = [r for x in going.values() for r in x]
        total_n, total_b = count(rest)
        single = sum(len(x) == 1 for x in going.values())
        merged = collections.defaultdict(list)
        for segment, x in going.items():
            n, b = count(x)
            step = segment
            if number(segment) or (len(going) >= wide and len(x) < rare * len(rest) and 2 * single >= len(going)):
                step = "{var}"
            elif len(going) > 1 and min(n, total_n - n) >= evidence:
                s = total_b / total_n
                error = math.sqrt(s * (1 - s) * (1 / n + 1 / (total_n - n)))
                if abs(b / n - (total_b - b) / (total_n - n)) <= z * error:
                    step = "{any}"
            merged[step] += x
        for step, x in merged.items():
            grow(level + 1, f"{prefix}/{step}", *purity(x, share, known), x)

    for host in {r[0] for r in rows}:
        found = [(*r, r[1].removeprefix("/").split("/")) for r in rows if r[0] == host]
        grow(0, "", *purity(found, overall, n), found)
    shapes, own = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        template = ended[r[0], r[1]][0]
        shapes[template].append(r)
        own[r[0], template].append(r)
    out = {}
    for (host, path), (template, share, known) in ended.items():
        n, b = count(shapes[template])
        if n >= evidence:
            share, known = ((b + prior * overall) / (n + prior), n) if count(own[host, template])[0] < evidence else (share, known)
        out[host, path] = (template, *purity(own[host, template], share, known))
    return out
