"""Whole jobs on planted data, their sinks, and small sources."""

import json
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from glimmer.functions import codebook
from glimmer.operators import align, decode, expression, extract, job, register, rules, run, spots
from glimmer.plans import fixtures as fx
from glimmer.sources import tables

SIZES = {"z": 5, "y": 60, "x": 60}


@pytest.fixture(scope="module")
def planted(spark):
    """Voxels of four rounds and channels (rounds moved), the codebook, and the genes planted in each FOV."""
    rnd = random.Random(2)
    seqs = {f"g{k}": "C" + a + b + "G" + c + d for k, (a, b, c, d) in enumerate([*zip("ACGT", "CATG", "GGTA", "TCCA"), ("A", "A", "T", "T")])}
    genes = spark.createDataFrame([(k, g, s) for k, (g, s) in enumerate(seqs.items())], "code_ix int, gene string, seq string")
    book = codebook.compile_codebook(genes, fx.PAIR_SEGMENTS, fx.PAIR_ORDER)
    codes = {r.gene: r.barcode for r in book.collect()}
    rows, truth = [], Counter()
    for fov in (3, 5):
        grid = [(2, y, x) for y in range(12, 48, 5) for x in range(12, 48, 5)]
        for z, y, x in rnd.sample(grid, 30):
            gene = rnd.choice([*codes, *codes, "none"])
            code = codes.get(gene) or "0000"
            truth[fov, gene] += 1
            light = rnd.randint(150, 250)
            for r in range(1, 5):
                dz, dy, dx = ((r + fov) % 3 - 1, 2 * r - fov, fov - 3 * r) if r > 1 else (0, 0, 0)
                rows.append((fov, r, int(code[r - 1]), z + dz, y + dy, x + dx, float(light)))
                rows.append((fov, r, int(code[r - 1]), z + dz, y + dy, x + dx + 1, float(light // 3)))
    assert "0000" not in codes.values()
    truth = Counter({k: n for k, n in truth.items() if k[1] != "none"})
    return spark.createDataFrame(rows, "fov int, round int, channel int, z int, y int, x int, v double"), book, truth


def test_planted_genes_are_counted(spark, planted, tmp_path):
    voxels, book, truth = planted
    manifest = tables.manifest(spark, [3, 5], {r: [0, 1, 2, 3, 4] for r in range(1, 5)}, {4: "anchor"})
    s = job.Settings(SIZES, steps=[("gamma_correction", {"gamma": 0.5})], rules=job.default_rules(fx.PAIR_SEGMENTS, fx.PAIR_ORDER), rescue={"max_distance": 0.0, "min_gap": 1.0})
    t = job.run_job(voxels, manifest, book, s)
    assert {(r.fov, r.gene): r.n for r in t.counts.collect()} == truth
    moved = {(r.fov, r["round"]): (r.dz, r.dy, r.dx) for r in t.shifts.collect()}
    for (fov, r), d in moved.items():
        want = ((r + fov) % 3 - 1, 2 * r - fov, fov - 3 * r) if r > 1 else (0, 0, 0)
        assert np.allclose(d, [-x for x in want], atol=0.2)
    assert t.spots.count() == 60 and tables.checked_intensities(t.spots, t.intensities).count() == 60 * 16
    tables.write_decoded(t.decoded, t.report, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/decoded").count() == 60
    docs = [json.loads(x) for f in sorted(Path(f"{tmp_path}/out/reports").rglob("*.json")) for x in f.read_text().splitlines()]
    assert len(docs) == 2 and all(d["n_total_spots"] == 30 == d["n_after_barcode_rules"] for d in docs)
    assert docs[0]["spot_rules"][0]["name"] == "quality_mean_lt" and docs[0]["spot_rules"][0]["details"]["threshold"] == 0.5
    assert json.loads(docs[0]["spot_rules"][0]["params"]) == {"threshold": 0.5} and docs[0]["weighted_rescue"]["n_rescued_spots"] == 0
    warned = run.warnings(t.decoded, book, 4).collect()
    assert {r.fov for r in warned} == {3, 5} and not any(r.weak or r.length_differs for r in warned)
    assert decode.lengths_match(book, 4) and not decode.lengths_match(book, 5)


def test_planted_genes_with_local_fields_and_dense_steps(spark, planted):
    voxels, book, truth = planted
    voxels = voxels.filter("fov = 3")
    manifest = tables.manifest(spark, [3], {r: [0, 1, 2, 3] for r in range(1, 5)}, {})
    s = job.Settings(SIZES, steps=[("min_max_normalize", {})], dense=True, tile={"z": 5, "y": 20, "x": 20}, radius={"z": 0, "y": 1, "x": 1}, rules=job.default_rules(fx.PAIR_SEGMENTS, fx.PAIR_ORDER))
    t = job.run_job(voxels, manifest, book, s)
    assert {(r.fov, r.gene): r.n for r in t.counts.collect()} == {k: n for k, n in truth.items() if k[0] == 3}
    assert all(r.final_corr >= r.global_corr for r in t.shifts.collect())


def test_a_field_is_kept_where_it_helps(spark):
    rng = np.random.default_rng(3)
    size = {"z": 2, "y": 48, "x": 48}
    a = rng.random((2, 48, 48)) * (rng.random((2, 48, 48)) < 0.3)
    bent, same = np.zeros_like(a), np.zeros_like(a)
    for (z, y, x), v in np.ndenumerate(a):
        for to, d in ((bent, (3, -2 + (1 if y >= 24 else -1))), (same, (3, -2))):
            q = (y + d[0], x + d[1])
            if v and all(0 <= c < 48 for c in q):
                to[z, *q] = v
    rows = [(0, r, *p, float(v)) for r, b in ((1, a), (2, bent), (3, same)) for p, v in np.ndenumerate(b) if v]
    rows += [(0, 4, *p, float(v)) for p, v in np.ndenumerate(rng.random((2, 48, 48)) * (rng.random((2, 48, 48)) < 0.3)) if v]
    table, flow = align.align(spark.createDataFrame(rows, "fov int, round int, z int, y int, x int, v double"), 1, size, {"z": 2, "y": 12, "x": 12}, {"z": 0, "y": 1, "x": 2}, sigma=0.4)
    got = {r["round"]: r for r in table.collect()}
    assert got[1].final_corr == 1.0 and not got[1].local_kept and (got[1].dz, got[1].dy, got[1].dx) == (0, 0, 0)
    assert got[2].local_kept and got[2].final_corr > got[2].global_corr + 0.1
    assert (got[3].dy, got[3].dx) == (-3.0, 2.0) and got[3].final_corr > 0.85
    assert not got[4].local_kept and got[4].global_corr < 0.2
    kept = {r["round"] for r in flow.select("round").distinct().collect()}
    assert kept == {r for r, x in got.items() if x.local_kept} and 4 not in kept


def test_a_region_reads_its_chunks_only(spark, tmp_path):
    rows = [(0, 1, c, z, y, x, float(z + y + x + c + 1)) for c in (0, 1) for z in range(4) for y in range(0, 40, 3) for x in range(0, 40, 3)]
    v = spark.createDataFrame(rows, "fov int, round int, channel int, z int, y int, x int, v double")
    chunk, path = (4, 16, 16), f"{tmp_path}/v"
    tables.write_volumes(v, path, chunk)
    m = tables.manifest(spark, [0], {1: [0]}, {})
    region = {"z": (1, 2), "y": (17, 31), "x": (0, 15)}
    part = tables.read_volumes(spark, path, m, region, chunk)
    want = {r[3:6] for r in rows if r[2] == 0 and 1 <= r[3] <= 2 and 17 <= r[4] <= 31 and r[5] <= 15}
    assert {(r.z, r.y, r.x) for r in part.collect()} == want and want
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*chunk#\d+ (= 0_1_0|IN \(0_1_0\))", plan)
    assert len(list(Path(path).rglob("*.parquet"))) == 18 and tables.read_volumes(spark, path, m).count() == len(rows) // 2
    assert sorted(tables.chunks_of({"z": (0, 3), "y": (15, 16), "x": (0, 0)}, chunk)) == ["0_0_0", "0_1_0"]


def test_small_sources_and_sinks(spark, tmp_path):
    m = tables.manifest(spark, [0, 1], {1: [0, 1, 2], 2: [0, 2]}, {0: "anchor"})
    seq = {(r.fov, r["round"], r.channel): r.chan_idx for r in tables.sequencing_channels(m).collect()}
    assert seq == {(f, r, c): i for f in (0, 1) for r, cs in ((1, [1, 2]), (2, [2])) for i, c in enumerate(cs)}
    shifts = spark.createDataFrame([(0, 2, 1.0, 2.0, 3.0)], "fov int, round int, dz double, dy double, dx double")
    all_of = {(r.fov, r["round"]): (r.dz, r.dy, r.dx) for r in tables.shifts_or_identity(m, shifts).collect()}
    assert all_of == {(f, r): ((1.0, 2.0, 3.0) if (f, r) == (0, 2) else (0.0, 0.0, 0.0)) for f in (0, 1) for r in (1, 2)}
    flow = spark.createDataFrame([(1, 2, 0, 3, 4, 0.5, -1.0, 0.0)], "fov int, round int, gz int, gy int, gx int, dz double, dy double, dx double")
    tables.write_flow(flow, f"{tmp_path}/flow")
    assert [tuple(r) for r in tables.flow_or_none(spark, f"{tmp_path}/flow").select(*flow.columns).collect()] == [tuple(r) for r in flow.collect()]
    assert tables.flow_or_none(spark, None).isEmpty()
    (tmp_path / "genes.csv").write_text("Abc,ACGT\nDef,CCGT\n")
    assert [(r.gene, r.seq) for r in tables.read_genes(spark, f"{tmp_path}/genes.csv").collect()] == [("Abc", "ACGT"), ("Def", "CCGT")]
    book = spark.createDataFrame([(1, "01", "b"), (0, "10", "a")], "code_ix int, barcode string, gene string")
    tables.write_codebook(book, f"{tmp_path}/book")
    assert "".join(p.read_text() for p in Path(f"{tmp_path}/book").glob("*.csv")) == "code_ix,barcode,gene\n0,10,a\n1,01,b\n"
    (tmp_path / "ref.tsv").write_text("gene\tvalue\na\t1.5\nb\t2\na\t2\n")
    assert {r.gene: r.value_ref for r in tables.read_reference(spark, f"{tmp_path}/ref.tsv").collect()} == {"a": 3.5, "b": 2.0}
    (tmp_path / "ref.csv").write_text("name,value\na,1\n")
    with pytest.raises(ValueError):
        tables.read_reference(spark, f"{tmp_path}/ref.csv")
    (tmp_path / "im").mkdir()
    for n in ("fov00_r01_ch01.tif", "fov00_r01_ch2.tif", "fov01_r01_ch01.tif", "fov01_r01_ch1.tif"):
        (tmp_path / "im" / n).write_bytes(b"x")
    two = tables.manifest(spark, [0, 1], {1: [1, 2]}, {})
    found = tables.file_catalog(tables.image_files(spark, f"{tmp_path}/im"), two)
    assert {(r.fov, r.channel): r.status for r in found.collect()} == {(0, 1): "ok", (0, 2): "ok", (1, 1): "ok", (1, 2): "missing"}


@pytest.mark.parametrize(("text", "want"), [(3, [3]), ([1, "2"], [1, 2]), ("2-4", [2, 3, 4]), ("5", [5]), ("1, 7,3", [1, 7, 3]), ("4-2", None), ("a-b", None), ("", None), ("1,,2", None), ("-3", None)])
def test_selections(text, want):
    if want is None:
        with pytest.raises(ValueError):
            tables.parsed_selection(text)
    else:
        assert tables.parsed_selection(text) == want


def test_rules_that_keep_all_and_defaults(spark):
    df = spark.createDataFrame([(0.4, True, "01"), (0.9, True, "10")], "quality double, valid boolean, barcode string")
    assert rules.with_rules(df, [rules.Rule("keep_all", "spot")], "spot").filter("keep").count() == 2
    assert rules.with_rules(df, [rules.Rule("keep_all", "barcode")], "barcode").filter("keep and penalty = 0").count() == 2
    made = rules.with_defaults([], fx.SEGMENTS, fx.ORDER, 0.3)
    assert [r.name for r in made] == ["quality_mean_lt", "end_base_pattern"] and made[0].params == {"threshold": 0.3}
    one = [rules.Rule("keep_all", "spot")]
    assert rules.with_defaults(one, fx.SEGMENTS, fx.ORDER) is one


def test_samples_trajectories_and_unions(spark):
    cells = spark.createDataFrame([(0, i, r, c, float(i)) for i in range(20) for r in (0, 1) for c in (0, 1)], "fov int, spot_id int, round_idx int, chan_idx int, v double")
    a, b = (sorted(r.spot_id for r in extract.sampled(cells, 5, s).collect()) for s in (1, 1))
    assert a == b and len(set(a)) == 5 and a != sorted(r.spot_id for r in extract.sampled(cells, 5, 2).collect())
    points = spark.createDataFrame([(0, 1, r, 1.0 * r, 2.0, 3.0) for r in (2, 1)], "fov int, spot_id int, round int, pz double, py double, px double")
    assert [r["round"] for r in extract.trajectory(points, 0, 1).collect()] == [1, 2]
    one = spark.createDataFrame([(0, 1.0, "a")], "fov int, z double, algo string")
    two = spark.createDataFrame([(0, 2.0, "b", 1.5)], "fov int, z double, algo string, sigma double")
    assert {(r.algo, r.sigma) for r in spots.united(one, two).collect()} == {("a", None), ("b", 1.5)}
    before = spark.createDataFrame([(0, r, y, x, float((y * 5 + x * r) % 7 + (r == 2))) for r in (1, 2) for y in range(6) for x in range(6)], "fov int, round int, y int, x int, v double")
    got = {r["round"]: r for r in register.overlay(before, before.withColumn("v", F.col("v") * 2), 1, 6, 6).collect()}
    assert got[1].corr_before == pytest.approx(1.0) and got[2].corr_before == pytest.approx(got[2].corr_after)
    large = spark.createDataFrame([(0, r, y, x, float((y * 3 + x * 5) % 11 if min(y, x) > 1 and max(y, x) < 6 else r * y)) for r in (1, 2) for y in range(8) for x in range(8)], before.schema)
    assert {r["round"]: round(r["corr"], 6) for r in register.correlations(large, 1, 8, 8, crop=4).collect()} == {1: 1.0, 2: 1.0}
    assert [r.gene for r in expression.without_background(spark.createDataFrame([("background",), ("g",)], "gene string")).collect()] == ["g"]
