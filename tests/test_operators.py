"""Hand cases, brute force and properties on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glimmer.functions import calling, codebook
from glimmer.operators import decode, preprocess, register, rules, spots
from glimmer.operators import stencil as st
from glimmer.operators.preprocess import Shape
from glimmer.sources import tables

FOUR = codebook.STANDARD_4COLOR


def image(spark, a, fov=0, rnd=1, channel=0):
    rows = [(fov, rnd, channel, 0, y, x, float(v)) for (y, x), v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "fov int, round int, channel int, z int, y int, x int, v double")


def array(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r["y"], r["x"]] = r["v"]
    return out


def test_codes_lead_back(spark):
    df = spark.createDataFrame([("CGAAAA",), ("CA",), ("C",), ("CN",)], "s string")
    code = codebook.slide_encoded(F.col("s"), FOUR)
    got = df.select(code.alias("c"), codebook.colours_decoded(code, "C", FOUR).alias("b")).collect()
    assert [(r.c, r.b) for r in got] == [("32000", "CGAAAA"), ("1", "CA"), (".", ""), (".", "")]


def test_conflicting_table():
    with pytest.raises(ValueError):
        codebook.reverse_lookup({"AA": 1, "AC": 1})


def test_zero_round_is_not_valid(spark):
    df = spark.createDataFrame([([[0.0, 0.0], [1.0, 2.0]],), ([[3.0, 1.0], [1.0, 2.0]],)], "v array<array<double>>").withColumn("fov", F.lit(0))
    got = decode.called(df, n_channels=2).select("call", "valid", "quality", "intensity").collect()
    assert got[0].call == [-1, 1] and not got[0].valid and got[0].quality is None
    assert got[1].call == [0, 1] and got[1].valid and got[1].intensity == 3.0


def test_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([[0.1, 0.4, 0.2]],)], "v array<array<double>>")
    assert abs(sum(df.select(calling.softmax(F.col("v"), 0.5).alias("s")).first().s[0]) - 1) < 1e-9


def test_unknown_rule():
    with pytest.raises(ValueError):
        rules.active([rules.Rule("nothing", "spot")], "spot")


def test_rescue_with_one_code_and_none_near(spark):
    book = spark.createDataFrame([(0, "0000", "g")], "code_ix int, barcode string, gene string")
    seen = spark.createDataFrame([("0001", "background"), ("1111", "background"), ("00", "background")], "barcode string, gene string")
    got = {r.barcode: (r.gene, r.rescue_applied, r.rescue_gap) for r in decode.rescued(seen, book, 1.0, 0.0).collect()}
    assert got == {"0001": ("g", True, 0.0), "1111": ("background", False, None), "00": ("background", False, None)}


def test_erosion_and_dilation(spark):
    a = np.random.default_rng(1).random((9, 8))
    offsets = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if i * i + j * j <= 4]
    for f, op in ((preprocess.erosion, min), (preprocess.dilation, max)):
        want = np.array([[op(a[y + i, x + j] for i, j in offsets if 0 <= y + i < 9 and 0 <= x + j < 8) for x in range(8)] for y in range(9)])
        assert np.allclose(array(f(image(spark, a), Shape(9, 8), 2), a.shape), want)


def test_gaussian_equals_numpy(spark):
    a = np.random.default_rng(2).random((7, 9))
    w = np.array(st.gaussian_weights(1.0))
    pad = np.pad(a, 3, mode="reflect")
    rows = np.apply_along_axis(lambda r: np.convolve(r, w, "valid"), 1, pad)
    want = np.apply_along_axis(lambda c: np.convolve(c, w, "valid"), 0, rows)
    assert np.allclose(array(preprocess.gaussian_blur(image(spark, a), Shape(7, 9), 1.0), a.shape), want)


def test_reconstruction_fills_under_the_mask(spark):
    mask = np.array([[1, 1, 0, 2, 2], [1, 1, 0, 2, 2]], float)
    marker = np.zeros_like(mask)
    marker[0, 0] = 0.5
    want = np.where(mask == 1, 0.5, 0)
    assert np.allclose(array(preprocess.reconstruction(image(spark, marker), image(spark, mask)), mask.shape), want)


def test_match_with_itself_changes_nothing(spark):
    a = np.random.default_rng(3).integers(0, 9, (6, 6)) / 10
    v = image(spark, a)
    assert np.allclose(array(preprocess.histogram_match(v, v, "inter_round"), a.shape), a)


def test_flat_image_becomes_zero(spark):
    assert not array(preprocess.min_max_normalize(image(spark, np.full((3, 3), 0.7))), (3, 3)).any()


def test_unknown_step(spark):
    with pytest.raises(ValueError):
        preprocess.run_steps(image(spark, np.zeros((2, 2))), [("nothing", {})], Shape(2, 2))


def test_shift_is_recovered(spark):
    a = np.zeros((16, 16))
    a[4:9, 5:8] = np.random.default_rng(4).random((5, 3)) + 0.5
    moved = np.roll(a, (2, -3), (0, 1))
    both = image(spark, a).unionByName(image(spark, moved, rnd=2)).filter("v > 0").drop("channel", "z")
    got = register.global_shift(both, 1, 4).first()
    assert (got.dy, got.dx) == (2, -3) and got.score > 0.999
    back = register.shifted(both.filter("round = 2"), spark.createDataFrame([(0, 2, -2.0, 3.0)], "fov int, round int, dy double, dx double"), {"y": 16, "x": 16})
    assert np.allclose(array(back, a.shape), a)


def test_components_of_a_plateau(spark):
    a = np.zeros((6, 6))
    a[1, 1:4] = 5
    a[4, 4] = 3
    got = spots.maxima_spots(image(spark, a), 0.1).orderBy("y").collect()
    assert [(r.y, r.x, r.intensity) for r in got] == [(1.0, 2.0, 5.0), (4.0, 4.0, 3.0)]


def test_empty_tables(spark):
    none = image(spark, np.zeros((0, 0))) if False else spark.createDataFrame([], "fov int, round int, channel int, z int, y int, x int, v double")
    assert spots.maxima_spots(none, 0.1).count() == 0
    assert preprocess.min_max_normalize(none).count() == 0


def test_catalog_prefers_padded_names(spark):
    m = tables.manifest(spark, [1], {1: [0, 1, 2, 3]}, {3: "anchor"})
    files = spark.createDataFrame([("a/fov1_r1_ch00.tif",), ("a/fov1_r1_ch0.tif",), ("a/fov1_r1_ch01.tif",), ("b/fov1_r1_ch01.tif",), ("a/fov1_r1_ch3.tif",)], "path string")
    got = {r.channel: (r.status, r.path, r.role) for r in tables.file_catalog(files, m).collect()}
    assert got[0][:2] == ("ok", "a/fov1_r1_ch00.tif") and got[1][0] == "ambiguous" and got[2][:2] == ("missing", None) and got[3] == ("ok", "a/fov1_r1_ch3.tif", "anchor")


def test_volumes_and_reports_come_back(spark, tmp_path):
    v = image(spark, np.ones((2, 2)))
    m = tables.manifest(spark, [0], {1: [0]}, {})
    tables.write_volumes(v, f"{tmp_path}/v")
    assert tables.read_volumes(spark, f"{tmp_path}/v", m).count() == 4
    with pytest.raises(FileNotFoundError):
        tables.read_volumes(spark, f"{tmp_path}/v", tables.manifest(spark, [0], {1: [0, 1]}, {})).count()
    lines = spark.createDataFrame([(0, "spot", 0, "a", 5, 4, 1)], "fov int, stage string, place int, name string, before long, after long, failed long")
    tables.write_reports(lines, f"{tmp_path}/r")
    assert spark.read.json(f"{tmp_path}/r").first().rules[0].name == "a"


def test_selection():
    assert tables.parsed_selection("2-4") == [2, 3, 4] and tables.parsed_selection("1,5") == [1, 5] and tables.parsed_selection(7) == [7]
    with pytest.raises(ValueError):
        tables.parsed_selection("x")


def test_spots_and_intensities_must_match(spark):
    s = spark.createDataFrame([(0, 1)], "fov int, spot_id long")
    i = spark.createDataFrame([(0, 2, 0, 0, 1.0)], "fov int, spot_id long, round_idx int, chan_idx int, v double")
    with pytest.raises(ValueError):
        tables.checked_intensities(s, i)


def test_peaks_on_plateaus_equal_a_greedy_search(spark):
    rng = np.random.default_rng(9)
    a = np.where(rng.random((16, 40)) < 0.5, 5.0, 0.0)
    a[8, 4:30] = 9
    a[3, 20:26:2] = 9
    top = lambda y, x: a[max(y - 2, 0) : y + 3, max(x - 2, 0) : x + 3].max()
    kept = []
    for v, y, x in sorted((-a[y, x], y, x) for y in range(2, 14) for x in range(2, 38) if 0 < a[y, x] == top(y, x)):
        if all(max(abs(y - p), abs(x - q)) > 2 for _, p, q in kept):
            kept.append((v, y, x))
    assert len([k for k in kept if k[0] == -9]) > 9
    got = spots.separated_peaks(image(spark, a), 2, 16, 40, 1)
    assert sorted((-r.v, r.y, r.x) for r in got.collect()) == kept


def test_reconstruction_of_a_long_path(spark):
    marker = np.zeros((1, 240))
    marker[0, 0] = 0.5
    got = preprocess.reconstruction(image(spark, marker), image(spark, np.ones((1, 240))))
    assert (array(got, marker.shape) == 0.5).all()


def test_components_of_a_long_line_are_finished(spark):
    """There is no cap on rounds: a line of any length has one label."""
    labels = {(r.label.z, r.label.y, r.label.x) for r in spots.components(image(spark, np.ones((1, 12)))).collect()}
    assert labels == {(0, 0, 0)}


def test_margin_rule_drops_spots_that_are_not_valid(spark):
    tied, clear = [[5.0, 5.0, 0.0], [9.0, 0.0, 0.0]], [[9.0, 1.0, 0.0], [9.0, 0.0, 0.0]]
    spots = decode.called(spark.createDataFrame([(1, tied), (2, clear)], "id int, v array<array<double>>"), n_channels=3)
    of = rules.with_rules(spots, [rules.Rule("channel_margin_mean_gt", "spot", params={"threshold": 0.9})], "spot")
    assert {r.id: (r.valid, r.keep, round(r.penalty, 3)) for r in of.collect()} == {1: (False, False, 0.0), 2: (True, True, 0.0)}
    low = rules.with_rules(spots, [rules.Rule("channel_margin_mean_gt", "spot", params={"threshold": 0.3})], "spot")
    assert {r.id: (r.keep, r.penalty) for r in low.collect()} == {1: (False, 0.0), 2: (True, 0.0)}


def test_calls_are_computed_once(spark):
    spots = spark.createDataFrame([(1, [[9.0, 1.0], [2.0, 3.0]])], "id int, v array<array<double>>")
    plan = decode.quality_filtered(decode.called(spots, n_channels=2))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("SQRT") == 1
