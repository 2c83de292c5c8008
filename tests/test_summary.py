"""Segment collapse, parcel means, alias scores and top-k, cross-checked with NumPy/fnmatch."""

from __future__ import annotations

import fnmatch
import json
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streetscape.functions.glob import glob_to_regex
from streetscape.operators import atlas as AT
from streetscape.operators import summary as S


def _segments(spark, data):
    rows = [(iid, f"clip_{iid}", i, [float(x) for x in vec]) for iid, mat in data.items() for i, vec in enumerate(mat)]
    return spark.createDataFrame(rows, "image_id string, timeline string, segment_idx int, activity array<float>")


def test_collapse_mean_max_against_numpy(spark):
    rng = np.random.default_rng(1)
    data = {"one": rng.normal(size=(1, 16)).astype(np.float32), "many": rng.normal(size=(7, 16)).astype(np.float32)}
    nan = rng.normal(size=(3, 16)).astype(np.float32)
    nan[1, 4] = np.nan
    data["nan"] = nan
    seg = _segments(spark, data)
    for mode, fn in (("mean", lambda a: a.mean(axis=0)), ("max", lambda a: a.max(axis=0))):
        got = {r.image_id: r for r in S.collapse_segments(seg, mode).collect()}
        for iid, mat in data.items():
            exp = fn(mat).astype(np.float32)
            vec = np.array(got[iid].brain_activity, dtype=np.float32)
            assert got[iid].n_segments == mat.shape[0]
            np.testing.assert_allclose(vec, exp, rtol=1e-5, atol=1e-6, equal_nan=True)
        assert math.isnan(got["nan"].brain_activity[4])
    with pytest.raises(ValueError):
        S.collapse_segments(seg, "median")


def test_no_segments_means_absent(spark):
    seg = _segments(spark, {"a": np.ones((2, 4), np.float32)})
    assert {r.image_id for r in S.collapse_segments(seg).collect()} == {"a"}


@pytest.fixture
def small_atlas(spark):
    """Two vertices each: V1 on 0 and 1, MT on 2 and 3, MST on 4 and 5, PHA1 on 6 and 7, and PH beyond the vectors."""
    spots = {"V1": (0, 1), "MT": (2, 3), "MST": (4, 5), "PHA1": (6, 7), "PH": (100, 101)}
    return spark.createDataFrame([(p, k, v) for k, (p, vs) in enumerate(spots.items()) for v in vs], "parcel string, ordinal int, vertex int")


def test_means_scores_and_regions_by_hand(spark, small_atlas):
    vectors = spark.createDataFrame(
        [("up", [1.0, 3.0, 10.0, 20.0, 4.0, 6.0, 7.0, 9.0]), ("tied", [5.0] * 8), ("hole", [1.0, float("nan"), 2.0, 2.0, 3.0, 3.0, 4.0, 4.0]), ("short", [8.0, 9.0, 1.0])],
        "image_id string, brain_activity array<float>",
    )
    means = {}
    for r in S.parcel_means(vectors, small_atlas).collect():
        means.setdefault(r.image_id, {})[r.parcel] = r.mean
    assert means["up"] == {"V1": 2.0, "MT": 15.0, "MST": 5.0, "PHA1": 8.0}
    assert means["short"] == {"V1": 8.5, "MT": 1.0}
    assert math.isnan(means["hole"]["V1"]) and means["hole"]["MT"] == 2.0
    amap, names = AT.alias_map_df(spark), AT.alias_names()
    scores = {}
    for r in S.alias_scores(vectors, small_atlas, amap, names).collect():
        scores.setdefault(r.image_id, [None] * len(names))[r.alias_ord] = (r.alias, r.score)
    assert all([a for a, _ in got] == names for got in scores.values())
    told = {k: {a: v for a, v in got if not math.isnan(v)} for k, got in scores.items()}
    assert told["up"] == {"PPA": 8.0, "EBA": 8.0, "MT": 10.0, "V1": 2.0}  # MT takes MT* and MST*, EBA's PH* takes PHA1
    assert told["tied"] == {"PPA": 5.0, "EBA": 5.0, "MT": 5.0, "V1": 5.0}
    assert told["hole"] == {"PPA": 4.0, "EBA": 4.0, "MT": 2.5}
    assert told["short"] == {"MT": 1.0, "V1": 8.5}
    tops = {r.image_id: [(t.name, t.score) for t in r.top_regions] for r in S.top_regions(vectors, small_atlas, amap, names, 3).collect()}
    assert tops["up"] == [("MT", 10.0), ("PPA", 8.0), ("EBA", 8.0)]
    assert tops["tied"] == [("PPA", 5.0), ("EBA", 5.0), ("MT", 5.0)]  # declaration order decides
    assert tops["short"] == [("V1", 8.5), ("MT", 1.0)]


def test_an_image_without_any_parcel_has_every_alias(spark, small_atlas):
    vectors = spark.createDataFrame([("none", [1.0, 2.0])], "image_id string, brain_activity array<float>")
    far = small_atlas.where("vertex >= 100")
    rows = S.alias_scores(vectors, far, AT.alias_map_df(spark), AT.alias_names()).collect()
    assert [r.alias for r in sorted(rows, key=lambda r: r.alias_ord)] == AT.alias_names() and all(math.isnan(r.score) for r in rows)
    assert S.top_regions(vectors, far, AT.alias_map_df(spark), AT.alias_names()).first().top_regions == []


def test_globs_that_overlap_count_a_parcel_once(spark):
    parcels = spark.createDataFrame([(p,) for p in ("PH", "PHA2", "PHT", "TE2p", "FFC", "Q")], "parcel string")
    got = {}
    for r in S.alias_parcels(parcels, AT.alias_map_df(spark)).collect():
        got.setdefault(r.alias, []).append(r.parcel)
    assert {k: sorted(v) for k, v in got.items()} == {"FFA": ["FFC"], "PPA": ["PHA2"], "EBA": ["PH", "PHA2", "PHT", "TE2p"], "VWFA": ["TE2p"]}


def test_a_large_atlas_is_refused(spark, small_atlas):
    vectors = spark.createDataFrame([("a", [1.0])], "image_id string, brain_activity array<float>")
    with pytest.raises(ValueError):
        S.summarise(vectors, small_atlas, max_bytes=10)


def test_top_k_larger_than_list_and_zero(spark):
    df = spark.createDataFrame(
        [("a", [("X", 0, 1.0), ("Y", 1, float("nan")), ("Z", 2, 1.0)])],
        "image_id string, scores array<struct<name:string, alias_ord:int, score:double>>",
    )
    r = df.select(S.top_k_regions(F.col("scores"), 50).alias("t")).first().t
    assert [x.name for x in r] == ["X", "Z"]
    assert df.select(S.top_k_regions(F.col("scores"), 0).alias("t")).first().t == []


def test_name_parcels_cut_to_shorter_and_fallback(spark):
    vals = spark.createDataFrame([("a", [0.5, 1.5, 2.5])], "image_id string, v array<float>")
    names = spark.createDataFrame([(0, "n0"), (1, "n1")], "ordinal int, name string")
    assert [(r.ordinal, r.name) for r in S.name_parcels(vals, "v", names).orderBy("ordinal").collect()] == [(0, "n0"), (1, "n1")]
    long_names = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "ordinal int, name string")
    assert S.name_parcels(vals, "v", long_names).count() == 3
    assert [r.name for r in S.name_parcels(vals, "v").orderBy("ordinal").collect()] == ["parcel_000", "parcel_001", "parcel_002"]


def test_normalize_regions_pairs_and_structs(spark):
    pairs = spark.createDataFrame([("a", [["FFA", "0.5"], ["MT", "1"]])], "image_id string, top_regions array<array<string>>")
    r = S.normalize_regions(pairs).first().top_regions
    assert [(x.name, x.score) for x in r] == [("FFA", 0.5), ("MT", 1.0)]
    structs = spark.createDataFrame([("a", [("FFA", 0.25)])], "image_id string, top_regions array<struct<name:string, score:double>>")
    assert S.normalize_regions(structs).first().top_regions[0].score == 0.25


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab*?[]!^.$\\x(", max_size=8), st.text(alphabet="ab.x![]^$\\(", max_size=8))
def test_glob_translation_matches_fnmatch(pattern, name):
    import re

    # Java and Python agree on these constructs; checked with Python's engine here.
    rx = glob_to_regex(pattern).replace("(?s:", "(?:")
    assert bool(re.match(rx, name, re.S)) == fnmatch.fnmatchcase(name, pattern)


def test_glob_in_spark_rlike(spark):
    names = ["PH", "PHA1", "PHT", "ph", "APH", "P.H"]
    df = spark.createDataFrame([(n,) for n in names], "parcel string")
    for pat in ["PH*", "P?A*", "[AP]H*", "[!P]*", "P.H"]:
        got = {r.parcel for r in df.filter(F.col("parcel").rlike(glob_to_regex(pat))).collect()}
        assert got == {n for n in names if fnmatch.fnmatchcase(n, pat)}, pat


def test_labels_to_parcels_to_aliases(spark):
    """Every alias has its row and its key, in declaration order; vertices off the hemisphere go."""
    labels = spark.createDataFrame(
        [("L_V4_ROI-lh", "lh", 9), ("R_V4_ROI-rh", "rh", 2), ("R_V4_ROI-rh", "rh", 2), ("L_TE2p_ROI-lh", "lh", 5), ("R_PHT_ROI-rh", "rh", 10242)],
        "name string, hemi string, vertex bigint",
    )
    merged = AT.merge_labels(labels)
    assert sorted(tuple(r) for r in merged.select("parcel", "ordinal", "vertex", "hemi").distinct().collect()) == [("TE2p", 0, 5, "lh"), ("V4", 1, 9, "lh"), ("V4", 1, 10244, "rh")]
    rows = {r.alias: (r.vertices, r.n_parcels, r.n_vertices) for r in AT.alias_vertices(merged, AT.alias_map_df(spark)).collect()}
    assert {k: v for k, v in rows.items() if v[0]} == {"V4": ([9, 10244], 1, 2), "EBA": ([5], 1, 1), "VWFA": ([5], 1, 1)}
    assert all(rows[a] == ([], 0, 0) for a in set(AT.ALIAS_GLOBS) - {"V4", "EBA", "VWFA"})
    text = AT.alias_atlas_json(AT.alias_vertices(merged, AT.alias_map_df(spark))).first().value
    assert list(json.loads(text)) == list(AT.ALIAS_GLOBS) and json.loads(text)["FFA"] == []
    vectors = spark.createDataFrame([("a", [float(v) for v in range(10)])], "image_id string, brain_activity array<float>")
    assert {(r.parcel, r.mean) for r in S.parcel_means(vectors, merged).collect()} == {("TE2p", 5.0), ("V4", 9.0)}


@pytest.mark.parametrize("mode", ["mean", "max"])
def test_folds_agree_with_numpy_however_often_they_flush(spark, monkeypatch, mode):
    """Many images over many partitions, one segment a row in any order, ragged widths, NULL elements."""
    monkeypatch.setattr(S, "COMBINE_FLUSH_IMAGES", 2)
    rng = np.random.default_rng(8)
    data = {f"i{k:02d}": rng.normal(size=(int(rng.integers(1, 6)), 12)).astype(np.float32) for k in range(30)}
    rows = [(k, [float(x) for x in v]) for k, mat in data.items() for v in mat]
    rows += [("ragged", [1.0, 2.0]), ("ragged", [3.0, 4.0, 5.0]), ("null", [1.0, None]), ("null", [3.0, 4.0]), ("nothing", []), ("nothing", None), (None, [1.0])]
    seg = spark.createDataFrame(rows, "image_id string, activity array<float>").repartition(7)
    got = {r.image_id: (np.array(r.brain_activity, np.float32), r.n_segments) for r in S.collapse_segments(seg, mode).collect()}
    assert sorted(got) == sorted([*data, "ragged", "null"])
    for k, mat in data.items():
        want = mat.astype(np.float64).mean(axis=0) if mode == "mean" else mat.max(axis=0)
        np.testing.assert_allclose(got[k][0], want, rtol=1e-5, atol=1e-6)
        assert got[k][1] == len(mat)
    assert got["ragged"][0].tolist() == ([2.0, 3.0, 5.0] if mode == "mean" else [3.0, 4.0, 5.0])
    assert got["null"][0][0] == (2.0 if mode == "mean" else 3.0) and math.isnan(got["null"][0][1])
