"""Language ID by nearest centroid over hashed character trigrams.

A text becomes a normalised TF-IDF vector of hashed trigrams. Spherical
k-means gives several centroids per language; a text takes the language of the
nearest centroid by cosine and is flagged ``rejected`` if it is farther from it
than nearly all of the centroid's own training texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from verdigris.session import materialize

DIM_BITS = 13
CLUSTERS = 4
SAMPLE_PER_LANG = 300  # bound of the training sample: about so many labelled texts a language
SLACK = 0.1
CHUNK = 256
LETTER = regex.compile(r"\p{L}")
_FOLD = np.array([c if 97 <= c <= 122 else 32 for c in range(128)], dtype=np.uint32)


def trigram_counts(text: str) -> np.ndarray:
    """Counts of hashed trigrams of the lower-cased text; ASCII other than letters counts as space."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = cp < 128
    c = np.full(len(cp) + 2, 32, dtype=np.uint32)
    c[1:-1] = np.where(low, _FOLD[np.where(low, cp, 0)], cp)
    keep = c[1:-1] != 32
    h = (c[:-2] * np.uint32(0x9E3779B1)) ^ (c[1:-1] * np.uint32(0x85EBCA77)) ^ (c[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    return np.bincount(h[keep] >> np.uint32(32 - DIM_BITS), minlength=1 << DIM_BITS)


def _normalised(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm == 0, 1, norm)


def tfidf(texts: list[str], idf: np.ndarray) -> np.ndarray:
    tf = np.stack([trigram_counts(t) for t in texts]).astype(np.float32)
    return _normalised(np.log1p(tf) * idf)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and each row's centroid; starts from rows far apart, so it is deterministic."""
    start = [0]
    near = x @ x[0]
    while len(start) < min(k, len(x)):
        start.append(int(near.argmin()))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        c = _normalised(np.stack([x[at == i].sum(axis=0) if (at == i).any() else c[i] for i in range(len(c))]))
    return c, (x @ c.T).argmax(axis=1)


class Centroids:
    """idf, centroids, their languages and rejection distances."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, langs: list[str], radius: np.ndarray):
        self.idf, self.centroids, self.langs, self.radius = idf, centroids, langs, radius

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        lang, score, rejected = [], [], []
        for i in range(0, len(texts), CHUNK):
            cos = tfidf(texts[i:i + CHUNK], self.idf) @ self.centroids.T
            best = cos.argmax(axis=1)
            top = np.clip(cos[np.arange(len(best)), best], 0, 1)
            lang += [self.langs[b] for b in best]
            score += top.astype(float).tolist()
            rejected += (1 - top > self.radius[best]).tolist()
        return lang, score, rejected


def fit(labelled: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG, clusters: int = CLUSTERS) -> Centroids:
    """Centroids from a bounded sample: of each language the texts of smallest hash, by its own rate.

    ``labelled`` has doc_id, text and lang; rows with a null lang, or a text without letter, are left out.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rate = {r["lang"]: min(1.0, sample_per_lang / r["n"]) for r in
            rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    chosen = F.lit(False)
    if rate:
        rates = F.create_map(*[F.lit(x) for kv in sorted(rate.items()) for x in kv])
        chosen = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) < rates[F.col("lang")] * (1 << 30)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c = [trigram_counts(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang": b["lang"], "at": [np.flatnonzero(x) for x in c],
                                "n": [x[np.flatnonzero(x)] for x in c]})

    sample = materialize(rows.where(chosen).select("doc_id", "lang", "text")
                         .mapInPandas(count, "doc_id long, lang string, at array<long>, n array<long>"), "langid_sample")
    total = sample.count()
    seen = np.zeros(1 << DIM_BITS)
    for r in sample.select(F.explode("at").alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect():
        seen[r["at"]] = r["n"]  # at most 2**DIM_BITS rows
    idf = (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id")
        x = np.zeros((len(part), 1 << DIM_BITS), dtype=np.float32)
        for i, (at, n) in enumerate(zip(part["at"], part["n"])):
            x[i, at] = n
        x = _normalised(np.log1p(x) * idf)
        c, at = spherical_kmeans(x, clusters)
        away = 1 - (x * c[at]).sum(axis=1)
        radius = [float(np.quantile(away[at == i], 0.99)) + SLACK if (at == i).any() else 1.0 for i in range(len(c))]
        return pd.DataFrame({"lang": part["lang"].iloc[0], "centroid": list(c), "radius": radius})

    found = (sample.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, radius double")
             .orderBy("lang").collect())  # languages * clusters rows
    return Centroids(idf, np.array([r["centroid"] for r in found], dtype=np.float32).reshape(-1, 1 << DIM_BITS),
                     [r["lang"] for r in found], np.array([r["radius"] for r in found]))


def identify(docs: DataFrame, model: Centroids, keep: list[str]) -> DataFrame:
    """``keep`` columns, as they are, with lang_pred, score (cosine) and rejected; reads only the text.

    A null text, one without letter, and any text if nothing was learned are ``und`` with score 0. Repeated rows are
    judged alike, texts of any length whole; an empty table gives no rows.
    """
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = StructType(source.select(*keep).schema.fields).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["__text"].to_pylist()
            known = [i for i, t in enumerate(texts) if model.langs and t is not None and LETTER.search(t) is not None]
            lang, score, rejected = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
            for i, *found in zip(known, *model.predict([texts[i] for i in known])):
                lang[i], score[i], rejected[i] = found
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(rejected, pa.bool_())], [*keep, "lang_pred", "score", "rejected"])

    return source.mapInArrow(predict, schema)


def language_documents(docs: DataFrame) -> DataFrame:
    """Predictions for every document; learns where crc32(doc_id as text) mod 3 is not 1."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    model = fit(docs.where(~held).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), model, ["doc_id", "held_out"])
