"""Catalogue of registered queries over the driver tables and their DuckDB oracles.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from
them).  ``ORACLES[name]`` is the equivalent SQL over the same tables; queries
without an oracle (Bernoulli sampling, iterative models) are checked by rows
or by invariants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdigris.functions import labels as L
from verdigris.functions.vectors import to_array, to_vector
from verdigris.operators import dataset as D
from verdigris.operators import decode as DEC
from verdigris.operators import evaluate as EV
from verdigris.operators import features as FE
from verdigris.operators import partitions as PT
from verdigris.operators import pixels as PX
from verdigris.operators import train as TR
from verdigris.operators.features import UnitClip
from verdigris.plans import score as SC
from verdigris.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# parameters of the catalogue queries (fixed, shared by Spark and SQL)
SEED = 42
URL_LABEL_PATTERN = r"_([a-z]+)"
HEALTHY_DEMO_PATTERN = "red"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def _md5_order(key: str) -> str:
    return f"md5('{SEED}|' || CAST({key} AS VARCHAR))"


# ---------------------------------------------------------------- labels ----

@register("label_from_name", f"""
SELECT page_id,
       nullif(regexp_extract(regexp_extract(url, '[^/]+$', 0), '{URL_LABEL_PATTERN}', 1), '') AS label
FROM pages
""")
def q_label_from_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", L.label_from_name("url", URL_LABEL_PATTERN, scope="basename").alias("label"))


@register("basename_key", """
SELECT page_id, regexp_extract(url, '[^/]+$', 0) AS basename FROM pages
""")
def q_basename_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", L.basename("url").alias("basename"))


@register("label_from_parent_dir", """
SELECT page_id, string_split(url, '/')[-2] AS label FROM pages
""")
def q_label_from_parent_dir(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", L.label_from_parent_dir("url").alias("label"))


@register("healthy_flag", f"""
SELECT p_partkey, p_name, contains(lower(p_name), '{HEALTHY_DEMO_PATTERN}') AS healthy
FROM part
""")
def q_healthy_flag(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", L.healthy_flag("p_name", HEALTHY_DEMO_PATTERN).alias("healthy"))


# ----------------------------------------------------- filters and counts ----

@register("labelled_only", """
SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL
""")
def q_labelled_only(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return D.labelled_only(joined, "quality").select("doc_id", "lang", "quality", "toxic")


@register("class_slice", """
SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'fr'
""")
def q_class_slice(spark, sf_dir):
    return D.class_slice(table(spark, sf_dir, "documents"), "lang", "fr") \
        .select("doc_id", "lang", "n_chars")


@register("class_distribution", """
SELECT lang, count(*) AS n FROM documents GROUP BY lang
""")
def q_class_distribution(spark, sf_dir):
    return D.class_distribution(table(spark, sf_dir, "documents"), "lang")


@register("class_distribution_top", """
SELECT source, count(*) AS n FROM documents GROUP BY source
ORDER BY n DESC, source ASC LIMIT 5
""")
def q_class_distribution_top(spark, sf_dir):
    return D.class_distribution_top(table(spark, sf_dir, "documents"), "source", k=5)


@register("n_classes", """
SELECT count(DISTINCT label) AS n_classes FROM embeddings
""")
def q_n_classes(spark, sf_dir):
    return D.n_classes(table(spark, sf_dir, "embeddings"), "label")


_HASH_SPLIT_SQL = f"""
CASE WHEN substr({_md5_order('doc_id')}, 1, 8) < '{D.split_threshold_hex(0.8)}'
     THEN 'train' ELSE 'test' END
"""


@register("hash_split", f"""
SELECT doc_id, lang, {_HASH_SPLIT_SQL} AS split FROM documents
""")
def q_hash_split(spark, sf_dir):
    return D.hash_split(table(spark, sf_dir, "documents").select("doc_id", "lang"),
                        "doc_id", 0.8, SEED)


@register("split_counts", f"""
SELECT split, count(*) AS n FROM (SELECT {_HASH_SPLIT_SQL} AS split FROM documents) GROUP BY split
""")
def q_split_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return D.split_counts(D.hash_split(docs, "doc_id", 0.8, SEED))


@register("random_split")
def q_random_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return D.random_split(docs, 0.8, SEED)


@register("union_classes", """
SELECT doc_id, lang FROM documents WHERE lang = 'en'
UNION ALL SELECT doc_id, lang FROM documents WHERE lang = 'fr'
UNION ALL SELECT doc_id, lang FROM documents WHERE lang NOT IN ('en', 'fr') OR lang IS NULL
""")
def q_union_classes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    parts = [D.class_slice(docs, "lang", "en"), D.class_slice(docs, "lang", "fr"),
             docs.where(~F.col("lang").isin("en", "fr") | F.col("lang").isNull())]
    return D.union_all(parts)


# ------------------------------------------------------------------ joins ----

@register("join_on_basename", """
WITH k AS (
  SELECT page_id, url, length(html) AS html_len,
         nullif(regexp_extract(url, '[^/]+$', 0), '') AS key FROM pages),
firsts AS (SELECT key, min(url) AS url FROM k WHERE key IS NOT NULL GROUP BY key),
r AS (SELECT k.key, k.page_id AS match_page_id, k.html_len
      FROM k JOIN firsts f ON k.url = f.url)
SELECT l.page_id, l.url, r.match_page_id, r.html_len
FROM k l JOIN r ON l.key = r.key
""")
def q_join_on_basename(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    meta = pages.select("page_id", F.col("url").alias("path"))
    feats = pages.select(F.col("url").alias("path"), F.col("page_id").alias("match_page_id"),
                         F.length("html").cast("long").alias("html_len"))
    return D.join_on_basename(meta, feats, "path", duplicates="first", decode=False) \
        .select("page_id", F.col("path").alias("url"), "match_page_id", "html_len")


# -------------------------------------------------------------- balancing ----

@register("balance_exact", f"""
WITH c AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang),
cap AS (SELECT 2 * min(n) AS cap FROM c),
r AS (SELECT doc_id, lang,
             row_number() OVER (PARTITION BY lang ORDER BY {_md5_order('doc_id')}, doc_id) AS rn
      FROM documents WHERE lang IS NOT NULL)
SELECT doc_id, lang FROM r WHERE rn <= (SELECT cap FROM cap)
""")
def q_balance_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return D.balance_exact(docs, "lang", "doc_id", factor=2, seed=SEED)


@register("balance_bernoulli")
def q_balance_bernoulli(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return D.balance_bernoulli(docs, "lang", factor=2, seed=SEED)


# ---------------------------------------------------------------- indexing ----

@register("label_index", """
WITH c AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT source, CAST(row_number() OVER (ORDER BY n DESC, source) - 1 AS DOUBLE) AS label_index
      FROM c)
SELECT d.doc_id, d.source, m.label_index FROM documents d JOIN m ON d.source = m.source
""")
def q_label_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    indexed, _ = D.index_labels(docs, "source", "label_index")
    return indexed


@register("label_map", """
WITH c AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)
SELECT CAST(row_number() OVER (ORDER BY n DESC, lang) - 1 AS DOUBLE) AS label_index,
       lang AS label
FROM c
""")
def q_label_map(spark, sf_dir):
    return D.label_map(table(spark, sf_dir, "documents"), "lang")


# ---------------------------------------------------------------- scaling ----


_SCALE_COLS = ("l_quantity", "l_extendedprice", "l_discount")


def _minmax_sql(c: str) -> str:
    return (f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.5 ELSE "
            f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 6) AS {c}_mm")


def _std_sql(c: str) -> str:
    return (f"round(CASE WHEN coalesce(stddev_samp({c}) OVER (), 0) = 0 THEN 0.0 ELSE "
            f"{c} / stddev_samp({c}) OVER () END, 6) AS {c}_std")


@register("minmax_scale", f"""
SELECT l_orderkey, l_linenumber, {', '.join(_minmax_sql(c) for c in _SCALE_COLS)} FROM lineitem
""")
def q_minmax_scale(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    return FE.scale_columns(li, _SCALE_COLS, "minmax").drop(*_SCALE_COLS)


@register("standard_scale", f"""
SELECT l_orderkey, l_linenumber, {', '.join(_std_sql(c) for c in _SCALE_COLS)} FROM lineitem
""")
def q_standard_scale(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    return FE.scale_columns(li, _SCALE_COLS, "standard").drop(*_SCALE_COLS)


# ------------------------------------------------------------- evaluation ----

_RULE_PRED_SQL = """
SELECT l.quality AS label, CAST(d.n_chars > 600 AS INTEGER) AS prediction
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def _rule_predictions(spark, sf_dir, threshold: int = 600) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
                .select(F.col("quality").alias("label"),
                        (F.col("n_chars") > threshold).cast("int").alias("prediction")))


def _metrics_sql(pred_sql: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    on = f" AND t.{group} = q.{group}" if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
WITH p AS ({pred_sql}),
cells AS (SELECT {g}label, prediction, count(*) AS n FROM p GROUP BY ALL),
t AS (SELECT {g}label, sum(n) AS n_true,
             sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS hits
      FROM cells GROUP BY ALL),
q AS (SELECT {g}prediction AS label, sum(n) AS n_pred FROM cells GROUP BY ALL),
c AS (SELECT t.*, coalesce(q.n_pred, 0) AS n_pred2, t.hits / t.n_true AS rec,
             CASE WHEN coalesce(q.n_pred, 0) = 0 THEN 0.0 ELSE t.hits / q.n_pred END AS prec
      FROM t LEFT JOIN q ON t.label = q.label{on}),
f AS (SELECT *, CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END AS f1 FROM c)
SELECT {g}round(sum(hits) / sum(n_true), 6) AS accuracy,
       round(sum(n_true * prec) / sum(n_true), 6) AS weighted_precision,
       round(sum(n_true * rec) / sum(n_true), 6) AS weighted_recall,
       round(sum(n_true * f1) / sum(n_true), 6) AS weighted_f1
FROM f {gb}
"""


@register("confusion_matrix", f"""
SELECT label, prediction, count(*) AS n FROM ({_RULE_PRED_SQL}) GROUP BY label, prediction
""")
def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_cells(_rule_predictions(spark, sf_dir), "label", "prediction")


@register("accuracy", f"""
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM ({_RULE_PRED_SQL})
""")
def q_accuracy(spark, sf_dir):
    return EV.accuracy(_rule_predictions(spark, sf_dir), "label", "prediction")


@register("weighted_metrics", _metrics_sql(_RULE_PRED_SQL))
def q_weighted_metrics(spark, sf_dir):
    return EV.evaluate(_rule_predictions(spark, sf_dir), "label", "prediction")


# rule "models" scored like classifiers: (name, registration order, threshold)
_RULE_MODELS = (("rule_400", 0, 400), ("rule_600", 1, 600), ("rule_800", 2, 800))
_RULES_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, {o} AS ord, l.quality AS label, "
    f"CAST(d.n_chars > {t} AS INTEGER) AS prediction "
    f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id" for m, o, t in _RULE_MODELS)


@register("best_model", f"""
WITH m AS ({_metrics_sql(_RULES_SQL, 'model')}),
o AS (SELECT DISTINCT model, ord FROM ({_RULES_SQL}))
SELECT m.model, m.accuracy, m.weighted_precision, m.weighted_recall, m.weighted_f1, o.ord
FROM m JOIN o ON m.model = o.model
ORDER BY m.accuracy DESC, o.ord ASC LIMIT 1
""")
def q_best_model(spark, sf_dir):
    # one join, then every rule "model" scores each row (one expand)
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    joined = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    rules = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(o).alias("ord"),
                 (F.col("n_chars") > t).cast("int").alias("prediction"))
        for m, o, t in _RULE_MODELS]))
    preds = joined.select(F.col("quality").alias("label"), rules.alias("r")).select(
        "label", "r.model", "r.ord", "r.prediction")
    metrics = EV.evaluate(preds, "label", "prediction", group_cols=("model", "ord"))
    return EV.best_model(metrics, "accuracy", "ord")


# --------------------------------------------------------- naive bayes ----

def _embedding_features(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label_index"),
        to_vector("embedding").alias("features"))


def _fit_nb_minmax(spark, sf_dir):
    feats = _embedding_features(spark, sf_dir)
    nb = NaiveBayes(featuresCol="features_mm", labelCol="label_index",
                    **TR.PRESET_PARAMS[TR.NAIVE_BAYES])
    model = Pipeline(stages=[FE.minmax_stage("features", "features_mm"), nb]).fit(feats)
    return model.transform(feats)


_NB_SQL = """
WITH x AS (
  SELECT vec_id, label, unnest(range(len(embedding))) AS j, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings),
mm AS (SELECT j, min(v) AS mn, max(v) AS mx FROM x GROUP BY j),
s AS (SELECT x.vec_id, x.label, x.j,
             CASE WHEN mm.mx = mm.mn THEN 0.5 ELSE (x.v - mm.mn) / (mm.mx - mm.mn) END AS s
      FROM x JOIN mm ON x.j = mm.j),
sc AS (SELECT label, j, sum(s) AS t FROM s GROUP BY label, j),
tot AS (SELECT label, sum(t) AS tt FROM sc GROUP BY label),
nf AS (SELECT count(*) AS f FROM mm),
th AS (SELECT sc.label, sc.j, ln(sc.t + 1.0) - ln(tot.tt + (SELECT f FROM nf) * 1.0) AS theta
       FROM sc JOIN tot ON sc.label = tot.label),
cn AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
k AS (SELECT count(*) AS k, sum(n) AS n FROM cn),
pr AS (SELECT cn.label, ln(cn.n + 1.0) - ln((SELECT n FROM k) + (SELECT k FROM k) * 1.0) AS pi
       FROM cn),
dot AS (SELECT s.vec_id, th.label AS c, sum(s.s * th.theta) AS d
        FROM s JOIN th ON s.j = th.j GROUP BY s.vec_id, th.label),
raw AS (SELECT dot.vec_id, dot.c, dot.d + pr.pi AS raw FROM dot JOIN pr ON dot.c = pr.label),
ranked AS (SELECT vec_id, c, raw,
                  row_number() OVER (PARTITION BY vec_id ORDER BY raw DESC, c ASC) AS r,
                  max(raw) OVER (PARTITION BY vec_id) AS mx
           FROM raw)
"""


@register("train_nb", _NB_SQL + """
SELECT vec_id, CAST(c AS DOUBLE) AS prediction FROM ranked WHERE r = 1
""")
def q_train_nb(spark, sf_dir):
    return _fit_nb_minmax(spark, sf_dir).select("vec_id", "prediction")


@register("confidence", _NB_SQL + """
SELECT vec_id, round(100.0 / sum(exp(raw - mx)), 1) AS confidence FROM ranked GROUP BY vec_id
""")
def q_confidence(spark, sf_dir):
    pred = DEC.add_confidence(_fit_nb_minmax(spark, sf_dir))
    return pred.select("vec_id", "confidence")


@register("decode_label", """
WITH c AS (SELECT CAST(label AS VARCHAR) AS label, count(*) AS n FROM embeddings GROUP BY 1),
m AS (SELECT row_number() OVER (ORDER BY n DESC, label) - 1 AS idx, label AS name FROM c),
m2 AS (SELECT * FROM m WHERE idx < (SELECT count(*) FROM c) - 2)
SELECT e.vec_id, CAST(e.label AS VARCHAR) AS class_index,
       coalesce(m2.name, 'class_' || CAST(e.label AS VARCHAR)) AS prediction_label
FROM embeddings e LEFT JOIN m2 ON e.label = m2.idx
""")
def q_decode_label(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    full = D.label_map(emb.withColumn("label", F.col("label").cast("string")), "label")
    # a map that lacks the two least frequent classes
    partial = (full.withColumn("__k", F.count(F.lit(1)).over(Window.partitionBy()))
                   .where(F.col("label_index") < F.col("__k") - 2).drop("__k"))
    pred = emb.select("vec_id", F.col("label").cast("double").alias("prediction"))
    return DEC.decode_prediction(pred, partial).select("vec_id", "class_index", "prediction_label")


# ------------------------------------------- iterative models: invariants ----

_INV_SQL = """
SELECT vec_id, true AS present_once, true AS probability_sums_to_one,
       true AS prediction_is_argmax
FROM embeddings
"""


def model_invariants(pred: DataFrame, key_col: str) -> DataFrame:
    """Per key: occurs once, probabilities sum to 1, prediction = arg-max."""
    arr = to_array("probability")
    checks = pred.select(
        key_col,
        (F.abs(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) - 1.0) < 1e-9).alias("__p"),
        ((F.array_position(arr, F.array_max(arr)) - 1).cast("double")
         == F.col("prediction")).alias("__a"))
    return checks.groupBy(key_col).agg(
        (F.count(F.lit(1)) == 1).alias("present_once"),
        F.bool_and("__p").alias("probability_sums_to_one"),
        F.bool_and("__a").alias("prediction_is_argmax"))


def _train_invariants(spark, sf_dir, name):
    feats = _embedding_features(spark, sf_dir)
    split = D.hash_split(feats, "vec_id", 0.8, SEED)
    train = split.where(F.col("split") == "train")
    fit = TR.fit_preset(name, train)
    return model_invariants(fit.model.transform(feats), "vec_id")


for _q, _name in (("train_lr", TR.LOGISTIC_REGRESSION), ("train_dt", TR.DECISION_TREE),
                  ("train_rf", TR.RANDOM_FOREST)):
    register(_q, _INV_SQL)(lambda spark, sf_dir, _n=_name: _train_invariants(spark, sf_dir, _n))


# ------------------------------------------------------------------ pixels ----


EMB_SIDE = 8  # 64 embedding values -> an 8 x 8 image


def embeddings_as_images(emb: DataFrame, corrupt: bool = False) -> DataFrame:
    """``embeddings`` rows -> image structs (8 x 8, 3 channels, BGR), built in the JVM.

    Values are quantised q = clip(floor(v * 255 + 128), 0, 255); pixel i has
    B = q[i], G = q[(i+1) % 64], R = q[(i+2) % 64].  The origin is a file name
    carrying the class (``.../v<id>___C<label> 0.png``).  With ``corrupt=True``
    class-0 images lose their last byte and class-1 images claim 2 channels.
    """
    n = EMB_SIDE * EMB_SIDE
    # two hex digits per quantised value; G and R are the same list rotated
    hq = F.transform("embedding", lambda v: F.lpad(F.hex(F.least(F.greatest(
        F.floor(v.cast("double") * 255.0 + 128.0), F.lit(0)), F.lit(255))), 2, "0"))
    g = F.concat(F.slice(hq, 2, n - 1), F.slice(hq, 1, 1))
    r = F.concat(F.slice(hq, 3, n - 2), F.slice(hq, 1, 2))
    bgr = F.zip_with(F.zip_with(hq, g, lambda x, y: F.concat(x, y)), r,
                     lambda xy, z: F.concat(xy, z))
    data = F.unhex(F.array_join(bgr, ""))
    channels = F.lit(3)
    if corrupt:
        data = F.when(F.col("label") == 0, F.substring(data, 1, 3 * n - 1)).otherwise(data)
        channels = F.when(F.col("label") == 1, F.lit(2)).otherwise(F.lit(3))
    origin = F.concat(F.lit("file:///data/images/v"), F.col("vec_id").cast("string"),
                      F.lit("___C"), F.col("label").cast("string"), F.lit(" 0.png"))
    return (emb.select("vec_id", "label", F.struct(
                   origin.alias("origin"), F.lit(EMB_SIDE).alias("height"),
                   F.lit(EMB_SIDE).alias("width"), channels.alias("nChannels"),
                   F.lit(PX.MODE_BGR).alias("mode"), data.alias("data")).alias("image")))


def _emb_images(spark, sf_dir, corrupt=False):
    return embeddings_as_images(table(spark, sf_dir, "embeddings"), corrupt)


def _q(expr: str) -> str:
    return f"least(greatest(floor(CAST({expr} AS DOUBLE) * 255 + 128), 0), 255)::INTEGER"


_LUMA_SQL = f"""
WITH p AS (SELECT vec_id, embedding AS e, unnest(range(64)) AS i FROM embeddings),
c AS (SELECT vec_id, i, {_q('e[i + 1]')} AS b, {_q('e[(i + 1) % 64 + 1]')} AS g,
             {_q('e[(i + 2) % 64 + 1]')} AS r FROM p),
l AS (SELECT vec_id, i, (r * {PX.LUMA_R} + g * {PX.LUMA_G} + b * {PX.LUMA_B} + {PX.LUMA_ROUND})
                        // {1 << PX.LUMA_SHIFT} AS luma FROM c)
"""


@register("grayscale", _LUMA_SQL + """
SELECT vec_id, string_agg(printf('%02X', luma), '' ORDER BY i) AS gray_hex,
       8 AS height, 8 AS width, 1 AS channels
FROM l GROUP BY vec_id
""")
def q_grayscale(spark, sf_dir):
    g = PX.grayscale(_emb_images(spark, sf_dir))
    return g.select("vec_id", F.hex("image.data").alias("gray_hex"),
                    F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                    F.col("image.nChannels").alias("channels"))


@register("flatten_normalise", _LUMA_SQL + """
SELECT vec_id, i, round(CAST(CAST(luma AS FLOAT) / CAST(255 AS FLOAT) AS DOUBLE), 5) AS value FROM l
""")
def q_flatten_normalise(spark, sf_dir):
    f = PX.flatten_normalise(_emb_images(spark, sf_dir))
    return f.select("vec_id", F.posexplode("features").alias("i", "v")) \
        .select("vec_id", F.col("i").cast("bigint").alias("i"),
                F.round(F.col("v").cast("double"), 5).alias("value"))


@register("resize_box", _LUMA_SQL + """
, cells AS (SELECT vec_id, (i // 16) * 4 + (i % 8) // 2 AS cell, (sum(luma) + 2) // 4 AS v
            FROM l GROUP BY vec_id, cell)
SELECT vec_id, string_agg(printf('%02X', v), '' ORDER BY cell) AS small_hex FROM cells GROUP BY vec_id
""")
def q_resize_box(spark, sf_dir):
    r = PX.resize(_emb_images(spark, sf_dir), 4, filter="box")
    return r.select("vec_id", F.hex("image.data").alias("small_hex"))


@register("image_rejects", """
SELECT vec_id, CASE label WHEN 0 THEN 'size_mismatch' ELSE 'unsupported_channels' END AS reason
FROM embeddings WHERE label IN (0, 1)
""")
def q_image_rejects(spark, sf_dir):
    return PX.image_rejects(_emb_images(spark, sf_dir, corrupt=True), keep=["vec_id"]) \
        .select("vec_id", "reason")


# ------------------------------------------------------------ scoring ----



@register("score_batch", """
SELECT vec_id, true AS present_once, true AS known_class, true AS confidence_in_range
FROM embeddings
""")
def q_score_batch(spark, sf_dir):
    """Images -> features -> label from file name -> index -> NB pipeline
    (train split) -> score every image; checked by invariants."""
    images = _emb_images(spark, sf_dir)
    feats = PX.image_features(images, size=PX.DEFAULT_SIZE, keep_origin="origin")
    # pixels are computed once; fits and scoring re-read the written table
    feats = materialize(feats.withColumn("label", L.label_from_name("origin")), "features")
    indexed, indexer = D.index_labels(feats, "label", "label_index")
    split = D.hash_split(indexed, "vec_id", 0.8, SEED)
    train = split.where(F.col("split") == "train").withColumn("features", to_vector("features"))
    model = TR.fit_preset(TR.NAIVE_BAYES, train).model
    scored = SC.score_images(images, model, D.indexer_label_map(indexer), TR.NAIVE_BAYES,
                             keep=("vec_id",))
    k = len(indexer.labels)
    return scored.groupBy("vec_id").agg(
        (F.count(F.lit(1)) == 1).alias("present_once"),
        F.bool_and(F.col("class_index").cast("int").between(0, k - 1)
                   & ~F.col("prediction_label").startswith("class_")).alias("known_class"),
        F.bool_and(F.col("confidence").between(0.0, 100.0)).alias("confidence_in_range"))


# ------------------------------------------------------------- partitions ----

@register("partition_profile", """
SELECT 8 AS n_partitions, count(*) AS total_rows FROM lineitem
""")
def q_partition_profile(spark, sf_dir):
    return PT.partition_profile(table(spark, sf_dir, "lineitem"), 8) \
        .select("n_partitions", "total_rows")


@register("partition_sweep")
def q_partition_sweep(spark, sf_dir):
    feats = _embedding_features(spark, sf_dir)
    split = D.hash_split(feats, "vec_id", 0.8, SEED)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")

    def pipeline():
        return Pipeline(stages=[LogisticRegression(featuresCol="features", labelCol="label_index",
                                                   **TR.SWEEP_LR_PARAMS)])
    return PT.partition_sweep(train, test, pipeline, PT.SWEEP_COUNTS, warmup=True)


_GUARD_REASON = PT.SKIP_REASON.split("{n}")


@register("sweep_guard", f"""
WITH s AS (SELECT l.quality, l.toxic, {_HASH_SPLIT_SQL} AS split FROM labels l),
c AS (SELECT quality, toxic, count(*) FILTER (WHERE split = 'train') AS train_rows,
             count(*) FILTER (WHERE split = 'test') AS test_rows FROM s GROUP BY quality, toxic)
SELECT quality, toxic, train_rows, test_rows, train_rows < {PT.MIN_TRAIN_ROWS} AS skipped,
       CASE WHEN train_rows < {PT.MIN_TRAIN_ROWS}
            THEN '{_GUARD_REASON[0]}' || CAST(train_rows AS VARCHAR) || '{_GUARD_REASON[1]}' END AS reason
FROM c
""")
def q_sweep_guard(spark, sf_dir):
    """Which groups (quality x toxic) have too few training rows to train on."""
    lab = D.hash_split(table(spark, sf_dir, "labels"), "doc_id", 0.8, SEED)
    return PT.guard_rows(lab, "split", ("quality", "toxic"))


# --------------------------------------------------------------- flagship ----


_FLAGSHIP_SQL = f"""
WITH c0 AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
bal AS (SELECT vec_id, label, embedding FROM (
          SELECT e.*, row_number() OVER (PARTITION BY label ORDER BY {_md5_order('vec_id')}, vec_id) AS rn
          FROM embeddings e) WHERE rn <= (SELECT 2 * min(n) FROM c0)),
sp AS (SELECT *, substr({_md5_order('vec_id')}, 1, 8) < '{D.split_threshold_hex(0.8)}' AS is_train FROM bal),
x AS (SELECT vec_id, label, is_train, unnest(range(len(embedding))) AS j,
             CAST(unnest(embedding) AS DOUBLE) AS v FROM sp),
mm AS (SELECT j, min(v) AS mn, max(v) AS mx FROM x WHERE is_train GROUP BY j),
s AS (SELECT x.vec_id, x.label, x.is_train, x.j,
             CASE WHEN mm.mx = mm.mn THEN 0.5
                  ELSE least(greatest((x.v - mm.mn) / (mm.mx - mm.mn), 0.0), 1.0) END AS s
      FROM x JOIN mm ON x.j = mm.j),
sc AS (SELECT label, j, sum(s) AS t FROM s WHERE is_train GROUP BY label, j),
tot AS (SELECT label, sum(t) AS tt FROM sc GROUP BY label),
nf AS (SELECT count(*) AS f FROM mm),
th AS (SELECT sc.label, sc.j, ln(sc.t + 1.0) - ln(tot.tt + (SELECT f FROM nf) * 1.0) AS theta
       FROM sc JOIN tot ON sc.label = tot.label),
cn AS (SELECT label, count(*) AS n FROM sp WHERE is_train GROUP BY label),
k AS (SELECT count(*) AS k, sum(n) AS n FROM cn),
pr AS (SELECT cn.label, ln(cn.n + 1.0) - ln((SELECT n FROM k) + (SELECT k FROM k) * 1.0) AS pi
       FROM cn),
dot AS (SELECT s.vec_id, s.label AS truth, th.label AS c, sum(s.s * th.theta) AS d
        FROM s JOIN th ON s.j = th.j WHERE NOT s.is_train GROUP BY s.vec_id, s.label, th.label),
raw AS (SELECT dot.vec_id, dot.truth, dot.c, dot.d + pr.pi AS raw FROM dot JOIN pr ON dot.c = pr.label),
pred AS (SELECT truth AS label, c AS prediction FROM (
           SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY raw DESC, c ASC) AS r FROM raw)
         WHERE r = 1),
cells AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY ALL),
t AS (SELECT label, sum(n) AS n_true, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS hits
      FROM cells GROUP BY label),
q AS (SELECT prediction AS label, sum(n) AS n_pred FROM cells GROUP BY prediction),
m AS (SELECT t.label, t.n_true, coalesce(q.n_pred, 0) AS n_pred, t.hits,
             CASE WHEN coalesce(q.n_pred, 0) = 0 THEN 0.0 ELSE t.hits / q.n_pred END AS prec,
             t.hits / t.n_true AS rec
      FROM t LEFT JOIN q ON t.label = q.label)
SELECT CAST(label AS DOUBLE) AS label, CAST(n_true AS BIGINT) AS n_true,
       CAST(n_pred AS BIGINT) AS n_pred, CAST(hits AS BIGINT) AS hits,
       round(prec, 6) AS precision, round(rec, 6) AS recall,
       round(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END, 6) AS f1
FROM m
"""


@register("flagship_nb_per_class", _FLAGSHIP_SQL)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> exact balance -> hash split -> [min-max (train only), clip,
    Naive Bayes] -> per-class precision / recall / F1 on the test rows."""
    emb = table(spark, sf_dir, "embeddings")
    bal = D.balance_exact(emb, "label", "vec_id", factor=2, seed=SEED)
    rows = D.hash_split(bal, "vec_id", 0.8, SEED).select(
        "vec_id", "split", F.col("label").cast("double").alias("label_index"),
        to_vector("embedding").alias("features"))
    train = rows.where(F.col("split") == "train")
    test = rows.where(F.col("split") == "test")
    nb = NaiveBayes(featuresCol="features_clip", labelCol="label_index",
                    **TR.PRESET_PARAMS[TR.NAIVE_BAYES])
    model = Pipeline(stages=[FE.minmax_stage("features", "features_mm"),
                             UnitClip(inputCol="features_mm", outputCol="features_clip"),
                             nb]).fit(train)
    cells = EV.confusion_cells(model.transform(test), "label_index", "prediction")
    per = EV.per_class_metrics(cells)
    return per.select("label", F.col("n_true").cast("long"), F.col("n_pred").cast("long"),
                      F.col("hits").cast("long"),
                      *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@register("stratified_split", f"""
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
r AS (SELECT doc_id, lang,
             row_number() OVER (PARTITION BY lang ORDER BY {_md5_order('doc_id')}, doc_id) AS rn
      FROM documents)
SELECT r.doc_id, r.lang, CASE WHEN r.rn <= round(c.n * 0.8) THEN 'train' ELSE 'test' END AS split
FROM r JOIN c ON r.lang = c.lang
""")
def q_stratified_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return D.stratified_hash_split(docs, "lang", "doc_id", 0.8, SEED)


from verdigris import catalog_flows  # noqa: E402,F401  (registers its queries)
