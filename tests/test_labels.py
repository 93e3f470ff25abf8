from pyspark.sql import functions as F

from verdigris.functions import labels as L
from verdigris.functions.paths import canonical_path


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "p string").select(expr.alias("v")).first()[0]


def test_label_stops_at_first_non_word_character(spark):
    # S3: "RS_Late.B 5050" -> "RS_Late"
    assert _one(spark, L.label_from_name("p"), "file:/a/u2___RS_Late.B 5050.png") == "RS_Late"
    assert _one(spark, L.label_from_name("p"), "file:/a/u1___RS_HL 0474.png") == "RS_HL"


def test_no_match_is_null_not_empty(spark):
    # C5 / I4
    assert _one(spark, L.label_from_name("p"), "file:/a/nolabel.png") is None


def test_label_scope_basename_vs_whole_path(spark):
    # S4: a directory called X___Y wins only when the whole path is scanned
    p = "file:/d/Tomato___Late_blight/u1___RS_HL 0474.png"
    assert _one(spark, L.label_from_name("p", scope="path"), p) == "Late_blight"
    assert _one(spark, L.label_from_name("p"), p) == "RS_HL"


def test_parent_dir_is_null_safe(spark):
    # S2: negative index is ANSI-safe
    assert _one(spark, L.label_from_parent_dir("p"), "file:/x/Tomato/a.png") == "Tomato"
    assert _one(spark, L.label_from_parent_dir("p"), "a.png") is None


def test_basename_and_empty_key(spark):
    # S5: a path ending in "/" has no basename, which becomes NULL
    assert _one(spark, L.basename("p"), "http://h/x/") == ""
    assert _one(spark, L.basename("p", empty_as_null=True), "http://h/x/") is None
    assert _one(spark, L.basename("p", decode=True), "file:///a/b%20c.png") == "b c.png"


def test_canonical_path_equates_binaryfile_and_image_forms(spark):
    a = _one(spark, canonical_path("p"), "file:///tmp/a%20b.png")
    b = _one(spark, canonical_path("p", encoded=False), "file:/tmp/a b.png")
    assert a == b == "file:/tmp/a b.png"
    # a name that literally contains "%20" (raw in binaryFile, "%2520" in image.origin)
    c = _one(spark, canonical_path("p"), "file:///tmp/x%2520y.png")
    d = _one(spark, canonical_path("p", encoded=False), "file:/tmp/x%20y.png")
    assert c == d == "file:/tmp/x%20y.png"


def test_healthy_flag_and_name_normalisation(spark):
    assert _one(spark, L.healthy_flag("p"), "Tomato_Healthy") is True
    assert _one(spark, L.healthy_flag("p"), "RS_HL") is False
    assert _one(spark, L.normalise_name("p"), "Random Forest") == "Random_Forest"


def test_null_label_is_its_own_group(spark):
    # S25: distribution keeps NULL; training drops it
    from verdigris.operators import dataset as D
    df = spark.createDataFrame([("a",), ("a",), (None,)], "label string")
    dist = {r["label"]: r["n"] for r in D.class_distribution(df).collect()}
    assert dist == {"a": 2, None: 1}
    assert D.labelled_only(df).count() == 2
    assert F  # keep import
