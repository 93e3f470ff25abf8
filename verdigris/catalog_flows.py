"""More registered queries: streams, writes that run again, merged statistics, ranks and cuts.

Part of ``verdigris.catalog``, which imports it.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.catalog import (
    _LUMA_SQL, _NB_SQL, _RULE_MODELS, EMB_SIDE, SEED, URL_LABEL_PATTERN, _embedding_features, _emb_images, _md5_order, _metrics_sql,
    embeddings_as_images, register, table,
)
from verdigris.functions import labels as L
from verdigris.functions.vectors import to_array, to_vector
from verdigris.operators import dataset as D
from verdigris.operators import evaluate as EV
from verdigris.operators import features as FE
from verdigris.operators import merged as MG
from verdigris.operators import pixels as PX
from verdigris.operators import train as TR
from verdigris.plans import score as SC
from verdigris.session import materialize, scratch_table_path
from verdigris.sources import sinks, tables
from verdigris.streaming import ingest_once, read_scored, score_to_tables

# ------------------------------------------------- images scored by naive Bayes ----


def _image_nb_sql(valid: str) -> str:
    """CTEs up to ``scored`` (vec_id, prediction_label, class_index, confidence) of the valid images."""
    return _LUMA_SQL + f"""
, f AS (SELECT l.vec_id, 'C' || e.label AS name, l.i AS j, CAST(CAST(l.luma AS FLOAT) / CAST(255 AS FLOAT) AS DOUBLE) AS x,
               substr({_md5_order('l.vec_id')}, 1, 8) < '{D.split_threshold_hex(0.8)}' AS is_train
        FROM l JOIN embeddings e ON l.vec_id = e.vec_id WHERE {valid}),
idx AS (SELECT name, row_number() OVER (ORDER BY n DESC, name) - 1 AS c FROM (SELECT name, count(DISTINCT vec_id) AS n FROM f GROUP BY name)),
mm AS (SELECT j, min(x) AS mn, max(x) AS mx FROM f WHERE is_train GROUP BY j),
u AS (SELECT f.vec_id, idx.c, f.is_train, f.j,
             CASE WHEN mm.mx = mm.mn THEN 0.5 ELSE least(greatest((f.x - mm.mn) / (mm.mx - mm.mn), 0.0), 1.0) END AS u
      FROM f JOIN mm ON f.j = mm.j JOIN idx ON f.name = idx.name),
sd AS (SELECT j, coalesce(stddev_samp(u), 0) AS sd FROM u WHERE is_train GROUP BY j),
z AS (SELECT u.vec_id, u.c, u.is_train, u.j, CASE WHEN sd.sd = 0 THEN 0.0 ELSE u.u / sd.sd END AS z FROM u JOIN sd ON u.j = sd.j),
sc AS (SELECT c, j, sum(z) AS t FROM z WHERE is_train GROUP BY c, j),
tot AS (SELECT c, sum(t) AS tt, count(*) AS nf FROM sc GROUP BY c),
th AS (SELECT sc.c, sc.j, ln(sc.t + 1.0) - ln(tot.tt + tot.nf * 1.0) AS theta FROM sc JOIN tot ON sc.c = tot.c),
cn AS (SELECT c, count(DISTINCT vec_id) AS n FROM z WHERE is_train GROUP BY c),
pr AS (SELECT c, ln(n + 1.0) - ln((SELECT sum(n) + count(*) FROM cn)) AS pi FROM cn),
raw AS (SELECT z.vec_id, th.c, sum(z.z * th.theta) + any_value(pr.pi) AS raw
        FROM z JOIN th ON z.j = th.j JOIN pr ON th.c = pr.c GROUP BY z.vec_id, th.c),
top AS (SELECT vec_id, arg_max(c, raw) AS c, max(raw) AS mx FROM raw GROUP BY vec_id),
scored AS (SELECT top.vec_id, any_value(idx.name) AS prediction_label, CAST(any_value(top.c) AS VARCHAR) AS class_index,
                  round(100.0 / sum(exp(raw.raw - top.mx)), 1) AS confidence
           FROM top JOIN raw ON top.vec_id = raw.vec_id JOIN idx ON top.c = idx.c GROUP BY top.vec_id)
"""


def _image_model(images: DataFrame):
    """Naive Bayes over the pixels of the images' train rows, and its label map."""
    feats = PX.image_features(images, size=EMB_SIDE, keep_origin="origin")
    feats = materialize(feats.withColumn("label", L.label_from_name("origin")), "features")  # decoded once
    indexed, indexer = D.index_labels(feats, "label", "label_index")
    train = D.hash_split(indexed, "vec_id", 0.8, SEED).where("split = 'train'").withColumn("features", to_vector("features"))
    return TR.fit_preset(TR.NAIVE_BAYES, train).model, D.indexer_label_map(indexer)


@register("score_images", _image_nb_sql("true") + "SELECT * FROM scored")
def q_score_images(spark, sf_dir):
    """Images -> pixels -> naive Bayes fitted on the train split -> every image scored."""
    images = _emb_images(spark, sf_dir)
    model, label_map = _image_model(images)
    scored = SC.score_images(images, model, label_map, TR.NAIVE_BAYES, size=EMB_SIDE, keep=("vec_id",))
    return scored.select("vec_id", *SC.PREDICTED)


@register("score_stream_tables", _image_nb_sql("e.label NOT IN (0, 1)") + """
SELECT vec_id, prediction_label, class_index, confidence, CAST(NULL AS VARCHAR) AS reason FROM scored
UNION ALL SELECT vec_id, NULL, NULL, NULL, CASE label WHEN 0 THEN 'size_mismatch' ELSE 'unsupported_channels' END
FROM embeddings WHERE label IN (0, 1)
""")
def q_score_stream_tables(spark, sf_dir):
    """The images arrive as files in two drops; the stream is ended after each and started again.

    Scores and rejects are two tables from one decode; classes 0 and 1 cannot be decoded."""
    images = _emb_images(spark, sf_dir, corrupt=True)
    model, label_map = _image_model(images)
    arrivals, out, progress = (scratch_table_path(spark, n) for n in ("arrivals", "scored", "progress"))
    for drop in (0, 1):
        images.where(F.col("vec_id") % 2 == drop).repartition(3).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(images.schema).option("maxFilesPerTrigger", 2).parquet(arrivals)
        score_to_tables(stream, model, label_map, TR.NAIVE_BAYES, out, progress, size=EMB_SIDE, keep=("vec_id",)).awaitTermination()
    scores = read_scored(spark, out, "scores").select("vec_id", *SC.PREDICTED, F.lit(None).cast("string").alias("reason"))
    rejects = read_scored(spark, out, "rejects").select("vec_id", *[F.lit(None).cast("double" if c == "confidence" else "string").alias(c)
                                                                     for c in SC.PREDICTED], "reason")
    return scores.unionByName(rejects)


# ------------------------------------------------------------ ingest and writes ----

@register("ingest_pages_once", f"""
SELECT url, nullif(regexp_extract(regexp_extract(url, '[^/]+$', 0), '{URL_LABEL_PATTERN}', 1), '') AS label
FROM pages WHERE url IS NOT NULL GROUP BY url
""")
def q_ingest_pages_once(spark, sf_dir):
    """Pages arrive in overlapping drops, and the first drop is delivered again: each url is ingested once."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    arrivals, out, progress = (scratch_table_path(spark, n) for n in ("arrivals", "ingested", "progress"))
    for thirds in ((0, 1), (1, 2), (0, 1)):
        pages.where((F.col("page_id") % 3).isin(*thirds)).repartition(2).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(pages.schema).parquet(arrivals).withColumn("arrived", F.col("_metadata.file_modification_time"))
        ingest_once(stream, out, progress, "url", "page_id", "arrived", "1 hour").awaitTermination()
    return spark.read.parquet(out).select("url", L.label_from_name("url", URL_LABEL_PATTERN).alias("label"))


@register("rerun_steps", """
SELECT CAST(o_orderkey % 3 AS INTEGER) AS step, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1
""")
def q_rerun_steps(spark, sf_dir):
    """Three steps write their part of one table; the second runs three times, once with half its rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    out = scratch_table_path(spark, "steps")
    for step, part in ((0, True), (1, F.col("o_custkey") % 2 == 0), (1, True), (2, True), (1, True)):
        sinks.write_step(orders.where((F.col("o_orderkey") % 3 == step) & F.lit(part)), out, step)
    return spark.read.parquet(out).groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@register("counted_write", """
SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_read_back, count(*) FILTER (WHERE lang IS NULL) AS unlabelled,
       CAST(sum(n_chars) AS BIGINT) AS chars, max(n_chars) AS longest
FROM documents
""")
def q_counted_write(spark, sf_dir):
    """Counts observed while a table is written, beside the rows that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    out = scratch_table_path(spark, "counted")
    seen = sinks.write_counted(docs, out, {
        "n_rows": F.count(F.lit(1)), "unlabelled": F.count_if(F.col("lang").isNull()), "chars": F.sum("n_chars"), "longest": F.max("n_chars")})
    back = spark.read.parquet(out).agg(F.count_distinct("doc_id").alias("n_read_back"))
    return back.select("n_read_back", *[F.lit(v).cast("long").alias(k) for k, v in seen.items()])


@register("label_map_json", """
WITH c AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source)
SELECT CAST(row_number() OVER (ORDER BY n DESC, source) - 1 AS DOUBLE) AS label_index, source AS label FROM c
""")
def q_label_map_json(spark, sf_dir):
    """The label map written as one JSON object and read back as rows."""
    out = scratch_table_path(spark, "label_map.json")
    sinks.write_json_map(D.label_map(table(spark, sf_dir, "documents"), "source"), out)
    return tables.label_map_rows(spark, out)


_RECORD_MODELS = tuple((m, o, t) for o, (m, _, t) in enumerate(reversed(_RULE_MODELS)))  # not in the order of names
_RECORD_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, l.quality AS label, CAST(d.n_chars > {t} AS INTEGER) AS prediction "
    f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id" for m, _, t in _RECORD_MODELS)


@register("results_json", f"""
WITH m AS ({_metrics_sql(_RECORD_SQL, 'model')})
SELECT CAST(CASE model {' '.join(f"WHEN '{m}' THEN {o}" for m, o, _ in _RECORD_MODELS)} END AS INTEGER) AS pos, model, accuracy,
       weighted_precision AS precision, weighted_recall AS recall, weighted_f1 AS f1
FROM m
""")
def q_results_json(spark, sf_dir):
    """The results record: one JSON object, its entries in the order of registration; read back as rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    joined = docs.join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(o).alias("ord"), (F.col("n_chars") > t).cast("int").alias("prediction"))
                                 for m, o, t in _RECORD_MODELS]))
    metrics = EV.evaluate(joined.select("label", models.alias("r")).select("label", "r.*"), "label", "prediction", ("model", "ord"))
    out = scratch_table_path(spark, "results.json")
    sinks.write_json_object(EV.result_record(metrics), "model", out, order_col="ord")
    return tables.json_rows(spark, out, "struct<accuracy: double, precision: double, recall: double, f1: double>", "model")


# ---------------------------------------------------------------- ranks and cuts ----

@register("label_index_orders", """
WITH c AS (SELECT CAST(l_orderkey AS VARCHAR) AS label, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1),
m AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_index FROM c)
SELECT l.l_linenumber, m.label, m.label_index FROM lineitem l JOIN m ON CAST(l.l_orderkey AS VARCHAR) = m.label
""")
def q_label_index_orders(spark, sf_dir):
    """Very many labels: every order is a class, ranked by its lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", F.col("l_orderkey").cast("string").alias("label"))
    return D.index_by_rank(lines, "label", "label_index")


def _cut_sql(key: str) -> str:
    return f"""
WITH d AS (SELECT lang, {key} AS key FROM documents WHERE lang IS NOT NULL),
r AS (SELECT lang, key, row_number() OVER (PARTITION BY lang ORDER BY md5('{SEED}|' || coalesce(CAST(key AS VARCHAR), chr(0)))) AS rn FROM d),
cap AS (SELECT 2 * min(n) AS cap FROM (SELECT count(*) AS n FROM d GROUP BY lang))
SELECT lang, key, count(*) AS n FROM r WHERE rn <= (SELECT cap FROM cap) GROUP BY lang, key
"""


def _cut_counts(spark, sf_dir, key) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", key.alias("key"))
    return D.balance_exact(docs, "lang", "key", factor=2, seed=SEED).groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n"))


@register("balance_null_keys", _cut_sql("CASE WHEN doc_id % 3 > 0 THEN doc_id END"))
def q_balance_null_keys(spark, sf_dir):
    """Exact balance where a third of the rows has no key: the kept rows per class and key."""
    return _cut_counts(spark, sf_dir, F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))


@register("balance_repeated_keys", _cut_sql("doc_id % 7"))
def q_balance_repeated_keys(spark, sf_dir):
    """Exact balance where seven keys hold all rows: the kept rows per class and key."""
    return _cut_counts(spark, sf_dir, F.col("doc_id") % 7)


# ------------------------------------------------------------- merged statistics ----

_COMPONENTS_SQL = """
WITH x AS (SELECT vec_id, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
"""


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    emb = table(spark, sf_dir, "embeddings")
    return emb.where("vec_id % 2 = 0"), emb.where("vec_id % 2 = 1")


@register("scaler_state", _COMPONENTS_SQL + """
, m AS (SELECT j, count(*) AS n, min(v) AS lo, max(v) AS hi, avg(v) AS mean, stddev_samp(v) AS sd FROM x GROUP BY j)
SELECT j, n, lo, hi, round(mean, 6) AS mean, round(sd, 6) AS std, round(sd / (hi - lo), 6) AS std_after_minmax FROM m
""")
def q_scaler_state(spark, sf_dir):
    """Scaler state of two halves, each fitted in one pass, merged."""
    state = MG.merge_scaler_states(*[MG.scaler_state(h, "embedding") for h in _halves(spark, sf_dir)])
    rows = state.select("n", F.posexplode(F.arrays_zip("lo", "hi", "mean", "m2")).alias("j", "s")).select("j", "n", "s.*")
    std = F.sqrt(F.col("m2") / (F.col("n") - 1))
    return rows.select("j", "n", "lo", "hi", F.round("mean", 6).alias("mean"), F.round(std, 6).alias("std"),
                       F.round(std / (F.col("hi") - F.col("lo")), 6).alias("std_after_minmax"))


_SCALED_SQL = _COMPONENTS_SQL + """
, m AS (SELECT vec_id, j, (v - min(v) OVER (PARTITION BY j)) / (max(v) OVER (PARTITION BY j) - min(v) OVER (PARTITION BY j)) AS u FROM x)
SELECT vec_id, j, round(u / stddev_samp(u) OVER (PARTITION BY j), 6) AS value FROM m
"""


@register("scale_by_state", _SCALED_SQL)
def q_scale_by_state(spark, sf_dir):
    """Both scalers applied from one stored state."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    scaled = MG.scale_by_state(emb, MG.scaler_state(emb, "embedding"), "embedding")
    return scaled.select("vec_id", F.posexplode("scaled_features").alias("j", "v")).select("vec_id", "j", F.round("v", 6).alias("value"))


@register("scale_stages", _SCALED_SQL)
def q_scale_stages(spark, sf_dir):
    """The training pipeline's scaler stages: min-max, then standard."""
    feats = _embedding_features(spark, sf_dir)
    scaled = Pipeline(stages=[FE.minmax_stage(), FE.standard_stage()]).fit(feats).transform(feats)
    return (scaled.select("vec_id", F.posexplode(to_array("scaled_features")).alias("j", "v"))
            .select("vec_id", "j", F.round("v", 6).alias("value")))


@register("nb_merged", _NB_SQL + """
SELECT vec_id, CAST(any_value(c) FILTER (WHERE r = 1) AS DOUBLE) AS prediction, round(100.0 / sum(exp(raw - mx)), 1) AS confidence
FROM ranked GROUP BY vec_id
""")
def q_nb_merged(spark, sf_dir):
    """Naive Bayes of one half of the rows, brought up to date by the statistics of the other."""
    halves = _halves(spark, sf_dir)
    state = MG.merge_scaler_states(*[MG.scaler_state(h, "embedding") for h in halves])
    statistics = MG.merge_nb_statistics(*[MG.nb_statistics(h, "embedding", "label") for h in halves])
    return MG.nb_predict(table(spark, sf_dir, "embeddings"), MG.nb_model(statistics, state), ["vec_id"], "embedding")


# -------------------------------------------------------- classifiers, by a known rule ----

_RULE_SQL = "CAST(l_linenumber >= 4 AS DOUBLE)"


def _learn_rule(spark, sf_dir, name) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") >= 4).cast("double").alias("label_index"),
        to_vector(F.array(*[F.col(c).cast("double") for c in ("l_linenumber", "l_quantity", "l_discount")])).alias("features"))
    split = D.hash_split(lines, "l_orderkey", 0.8, SEED)
    model = TR.fit_preset(name, split.where("split = 'train'").drop("split")).model
    return model.transform(split).select("l_orderkey", "l_linenumber", "split", "prediction")


for _q, _name in (("learn_rule_lr", TR.LOGISTIC_REGRESSION), ("learn_rule_dt", TR.DECISION_TREE), ("learn_rule_rf", TR.RANDOM_FOREST)):
    register(_q, f"""
SELECT l_orderkey, l_linenumber, CASE WHEN substr({_md5_order('l_orderkey')}, 1, 8) < '{D.split_threshold_hex(0.8)}'
       THEN 'train' ELSE 'test' END AS split, {_RULE_SQL} AS prediction
FROM lineitem
""")(lambda spark, sf_dir, _n=_name: _learn_rule(spark, sf_dir, _n))


# ------------------------------------------------------------------------- pixels ----

def _bicubic_sql(out: int) -> str:
    """Two 8-bit passes with weights in fixed point, over the 8 x 8 luma images."""
    one = 1 << PX.RESAMPLE_PRECISION_BITS
    a, fs = PX.CUBIC_A, max(EMB_SIDE / out, 1.0)
    center = f"((o + 0.5) * {EMB_SIDE / out!r})"
    clip = f"least(greatest(floor(({{}} + {one // 2}) / {one}.0), 0), 255)"
    return _LUMA_SQL + f"""
, tap AS (SELECT o, t, abs((t - {center} + 0.5) / {fs!r}) AS x FROM range({out}) a(o), range({EMB_SIDE}) b(t)
          WHERE t >= greatest(trunc({center} - {2 * fs!r} + 0.5), 0) AND t < least(trunc({center} + {2 * fs!r} + 0.5), {EMB_SIDE})),
k AS (SELECT o, t, CASE WHEN x < 1 THEN (({a} + 2) * x - ({a} + 3)) * x * x + 1 WHEN x < 2 THEN (((x - 5) * x + 8) * x - 4) * {a} ELSE 0 END AS k FROM tap),
s AS (SELECT o, t, k / sum(k) OVER (PARTITION BY o) * {one} AS s FROM k),
w AS (SELECT o, t, CAST(CASE WHEN s < 0 THEN ceil(s - 0.5) ELSE floor(s + 0.5) END AS BIGINT) AS w FROM s),
h AS (SELECT vec_id, i // {EMB_SIDE} AS y, o AS x, {clip.format('sum(luma * w)')} AS v
      FROM l JOIN w ON l.i % {EMB_SIDE} = w.t GROUP BY vec_id, i // {EMB_SIDE}, o),
v AS (SELECT vec_id, o AS y, x, CAST({clip.format('sum(v * w)')} AS INTEGER) AS v FROM h JOIN w ON h.y = w.t GROUP BY vec_id, o, x)
SELECT vec_id, string_agg(printf('%02X', v), '' ORDER BY y, x) AS resized_hex FROM v GROUP BY vec_id
"""


for _q, _side in (("resize_bicubic_down", 4), ("resize_bicubic_up", 16)):
    @register(_q, _bicubic_sql(_side))
    def _resize_bicubic(spark, sf_dir, _side=_side):
        """The default filter, to half and to twice the side."""
        return PX.resize(_emb_images(spark, sf_dir), _side).select("vec_id", F.hex("image.data").alias("resized_hex"))


# ----------------------------------------------------------- sampling and joins by key ----

@register("balance_bernoulli_keyed", f"""
WITH c AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang),
s AS (SELECT lang, least(1.0, CAST(2 * (SELECT min(n) FROM c) AS DOUBLE) / n) AS share FROM c)
SELECT d.doc_id, d.lang FROM documents d JOIN s ON d.lang = s.lang
WHERE CAST('0x' || substr({_md5_order('doc_id')}, 1, 8) AS BIGINT) < s.share * 4294967296
""")
def q_balance_bernoulli_keyed(spark, sf_dir):
    """Every class above the cap is sampled at its rate, by a hash of the key: the same rows in every run."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return D.balance_bernoulli_keyed(docs, "lang", "doc_id", factor=2, seed=SEED)


@register("join_copartitioned", """
WITH f AS (SELECT url, min(page_id) AS match_page_id, arg_min(length(html), page_id) AS html_len FROM pages WHERE url IS NOT NULL GROUP BY url)
SELECT p.page_id, p.url, f.match_page_id, CAST(f.html_len AS BIGINT) AS html_len FROM pages p JOIN f ON p.url = f.url
""")
def q_join_copartitioned(spark, sf_dir):
    """Metadata and features bucketed by their key when they are written: the join shuffles nothing."""
    pages = table(spark, sf_dir, "pages")
    meta = tables.write_bucketed(pages.select("page_id", "url"), scratch_table_path(spark, "meta"), "url", 8)
    feats = tables.write_bucketed(pages.select("url", F.col("page_id").alias("match_page_id"), F.length("html").cast("long").alias("html_len")),
                                  scratch_table_path(spark, "feats"), "url", 8)
    return D.join_on_key(meta, feats, "url", "match_page_id")
