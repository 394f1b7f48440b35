"""Queries over image volumes: cleaning, alignment, spots and their intensities."""

from pyspark.sql import functions as F

from glimmer.operators import extract, preprocess, register, spots
from glimmer.operators import stencil as st
from glimmer.operators.preprocess import Shape
from glimmer.operators.stencil import VOXEL
from glimmer.plans import fixtures as fx
from glimmer.sources import tables

QUERIES: dict = {}
ORACLE_SQL: dict = {}
SHAPE = Shape(24, 31)


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return add


def r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) + 0.0 for c in cols or ("v",)})


def plane(spark, d):
    """Dense planes of events, z 0, values from 0 to 1; FOVs grow with the events."""
    g = fx.grid_events(spark, d).groupBy("fov", "round", "channel", F.lit(0).alias("z"), "y", "x").agg(F.sum("v").alias("v"))
    return st.densified(g, SHAPE.height, SHAPE.width).withColumn("v", F.least(F.col("v") / 8.0, F.lit(1.0)))


PLANE = fx.GRID + """, pl AS (SELECT fov, round, channel, 0 z, y, x, sum(v) v FROM grid GROUP BY ALL),
dn AS (SELECT i.fov, i.round, i.channel, i.z, CAST(a.y AS INT) y, CAST(b.x AS INT) x, least(coalesce(pl.v, 0) / 8.0, 1.0) v FROM (SELECT DISTINCT fov, round, channel, z FROM pl) i CROSS JOIN range(24) a(y) CROSS JOIN range(31) b(x) LEFT JOIN pl ON pl.fov = i.fov AND pl.round = i.round AND pl.channel = i.channel AND pl.z = i.z AND pl.y = a.y AND pl.x = b.x)"""
IMG = "fov, round, channel"
OUT = "fov, round, channel, z, y, x, round(v, 6) + 0.0 v"


def _step(name, f, sql):
    query(name, f"WITH {PLANE}, {sql}")(lambda spark, d: r6(f(plane(spark, d))))


_step("minmax", lambda v: preprocess.min_max_normalize(v), f"s AS (SELECT {IMG}, min(v) lo, max(v) hi FROM dn GROUP BY ALL), o AS (SELECT dn.* EXCLUDE v, CASE WHEN hi - lo < 1e-9 THEN 0 ELSE (v - lo) / (hi - lo) END v FROM dn JOIN s USING ({IMG})) SELECT {OUT} FROM o")
_step("clip_percentile", lambda v: preprocess.clip_percentile(v, None, 5.0, 95.0), f"s AS (SELECT {IMG}, quantile_cont(v, 0.05) lo, quantile_cont(v, 0.95) hi FROM dn GROUP BY ALL), o AS (SELECT dn.* EXCLUDE v, least(greatest(v, lo), hi) v FROM dn JOIN s USING ({IMG})) SELECT {OUT} FROM o")
_step("gamma", lambda v: preprocess.gamma_correction(v, None, 0.5), f"o AS (SELECT * EXCLUDE v, pow(v, 0.5) v FROM dn) SELECT {OUT} FROM o")
_step("quantise", lambda v: preprocess.quantised(v), f"o AS (SELECT * EXCLUDE v, round_even(least(greatest(v, 0), 1) * 255, 0) v FROM dn) SELECT {OUT} FROM o")
_step("scale", lambda v: preprocess.scaled(v, "uint16"), f"o AS (SELECT * EXCLUDE v, v / 65535.0 v FROM dn) SELECT {OUT} FROM o")
_step("robust_normalize", lambda v: preprocess.robust_normalised(v, 5.0, 95.0), f"s AS (SELECT {IMG}, quantile_cont(v, 0.05) lo, quantile_cont(v, 0.95) hi FROM dn GROUP BY ALL), o AS (SELECT dn.* EXCLUDE v, CASE WHEN hi - lo > 1e-9 THEN least(greatest((v - lo) / (hi - lo), 0), 1) ELSE 0 END v FROM dn JOIN s USING ({IMG})) SELECT {OUT} FROM o")
_step("median", lambda v: preprocess.median_filter(v, SHAPE, 3), f"b AS (SELECT *, floor(v * 255) b FROM dn), o AS (SELECT t.fov, t.round, t.channel, t.z, t.y, t.x, list_sort(list(s.b))[5] / 255.0 v FROM dn t CROSS JOIN range(-1, 2) dy(i) CROSS JOIN range(-1, 2) dx(j) JOIN b s ON s.fov = t.fov AND s.round = t.round AND s.channel = t.channel AND s.z = t.z AND s.y = least(greatest(t.y + i, 0), 23) AND s.x = least(greatest(t.x + j, 0), 30) GROUP BY ALL) SELECT {OUT} FROM o")


def _kernel(name: str, sigma: float) -> str:
    w = st.gaussian_weights(sigma)
    return f"{name}(k, w) AS (VALUES {', '.join(f'({i - len(w) // 2}, {x!r})' for i, x in enumerate(w))})"


def _blur(out: str, kernel: str, src: str = "dn") -> str:
    mirror = lambda c, n: f"CASE WHEN {c} + k < 0 THEN -({c} + k) WHEN {c} + k > {n - 1} THEN {2 * (n - 1)} - ({c} + k) ELSE {c} + k END"
    key = "s.fov = t.fov AND s.round = t.round AND s.channel = t.channel AND s.z = t.z"
    one = lambda name, src, own, other, n: f"{name} AS (SELECT t.fov, t.round, t.channel, t.z, t.y, t.x, sum(s.v * w) v FROM {src} t CROSS JOIN {kernel} JOIN {src} s ON {key} AND s.{other} = t.{other} AND s.{own} = {mirror(f't.{own}', n)} GROUP BY ALL)"
    return one(f"{out}x", src, "x", "y", 31) + ", " + one(out, f"{out}x", "y", "x", 24)


_step("gaussian", lambda v: preprocess.gaussian_blur(v, SHAPE, 1.0), f"{_kernel('g1', 1.0)}, {_blur('o', 'g1')} SELECT {OUT} FROM o")
_step("dog", lambda v: preprocess.difference_of_gaussians(v, SHAPE, 1.0, 3.0), f"{_kernel('g1', 1.0)}, {_kernel('g3', 3.0)}, {_blur('a', 'g1')}, {_blur('b', 'g3')}, o AS (SELECT a.* EXCLUDE v, greatest(a.v - b.v, 0) v FROM a JOIN b USING (fov, round, channel, z, y, x)) SELECT {OUT} FROM o")


def _matched(ref: str, keys: str, src: str = "dn", calibrated: str = "dn") -> str:
    on = " AND ".join(f"s.{k} = r.{k}" for k in keys.split(", "))
    return f"""ct AS (SELECT {IMG}, v, count(*) n FROM {src} GROUP BY ALL), src AS (SELECT {IMG}, v, CAST(sum(n) OVER (PARTITION BY {IMG} ORDER BY v) AS DOUBLE) / sum(n) OVER (PARTITION BY {IMG}) q FROM ct),
rc AS (SELECT {keys}, v, count(*) n FROM {calibrated} WHERE {ref} GROUP BY ALL), rq AS (SELECT {keys}, v, CAST(sum(n) OVER (PARTITION BY {keys} ORDER BY v) AS DOUBLE) / sum(n) OVER (PARTITION BY {keys}) q FROM rc),
r AS (SELECT *, lead(q) OVER w q1, lead(v) OVER w v1, row_number() OVER w k FROM rq WINDOW w AS (PARTITION BY {keys} ORDER BY q)),
m AS (SELECT s.fov, s.round, s.channel, s.v sv, min(CASE WHEN q1 IS NULL OR s.q < r.q THEN r.v ELSE r.v + (v1 - r.v) * (s.q - r.q) / (q1 - r.q) END) nv FROM src s JOIN r ON {on} AND ((s.q >= r.q AND (q1 IS NULL OR s.q < q1)) OR (k = 1 AND s.q < r.q)) GROUP BY ALL),
o AS (SELECT s.* EXCLUDE v, coalesce(nv, s.v) v FROM {src} s LEFT JOIN m ON m.fov = s.fov AND m.round = s.round AND m.channel = s.channel AND m.sv = s.v)"""


_step("hist_match_inter", lambda v: preprocess.histogram_match(v, v, "inter_round", 1), f"{_matched('round = 1', 'fov, channel')} SELECT {OUT} FROM o")
_step("hist_match_intra", lambda v: preprocess.histogram_match(v, v, "intra_round"), f"{_matched('channel = 0', 'fov, round')} SELECT {OUT} FROM o")


def _morph(out: str, src: str, f: str, r: int = 2) -> str:
    return f"{out} AS (SELECT t.fov, t.round, t.channel, t.z, t.y, t.x, {f}(s.v) v FROM {src} t CROSS JOIN range({-r}, {r + 1}) a(i) CROSS JOIN range({-r}, {r + 1}) b(j) JOIN {src} s ON s.fov = t.fov AND s.round = t.round AND s.channel = t.channel AND s.z = t.z AND s.y = t.y + i AND s.x = t.x + j WHERE i * i + j * j <= {r * r} GROUP BY ALL)"


_VX = "fov, round, channel, z, y, x"
_step("erode", lambda v: preprocess.erosion(v, SHAPE, 2), f"{_morph('o', 'dn', 'min')} SELECT {OUT} FROM o")
_step("dilate", lambda v: preprocess.dilation(v, SHAPE, 2), f"{_morph('o', 'dn', 'max')} SELECT {OUT} FROM o")
_step("white_tophat", lambda v: preprocess.white_tophat(v, SHAPE, 2), f"{_morph('e', 'dn', 'min')}, {_morph('p', 'e', 'max')}, o AS (SELECT dn.* EXCLUDE v, dn.v - p.v v FROM dn JOIN p USING ({_VX})) SELECT {OUT} FROM o")
_step("black_tophat", lambda v: preprocess.black_tophat(v, SHAPE, 2), f"{_morph('e', 'dn', 'max')}, {_morph('p', 'e', 'min')}, o AS (SELECT dn.* EXCLUDE v, p.v - dn.v v FROM dn JOIN p USING ({_VX})) SELECT {OUT} FROM o")
_step("downsample", lambda v: preprocess.downsampled(v, 4), f"o AS (SELECT fov, round, channel, z, y // 4 y, x // 4 x, CAST(sum(CAST(round_even(v * 1099511627776.0, 0) AS HUGEINT)) AS DOUBLE) / count(*) / 1099511627776.0 v FROM dn GROUP BY fov, round, channel, z, y // 4, x // 4) SELECT {OUT} FROM o")
query("reconstruct")(lambda spark, d: r6(preprocess.reconstruction(preprocess.erosion(plane(spark, d), SHAPE, 2), plane(spark, d))))
_AT = "least(greatest(CAST(floor(({c} + 0.5) / {t}.0 - 0.5) AS INT) + {i}, 0), 4)"
_PART = "CASE {i} WHEN 1 THEN ({c} + 0.5) / {t}.0 - 0.5 - floor(({c} + 0.5) / {t}.0 - 0.5) ELSE 1 - (({c} + 0.5) / {t}.0 - 0.5 - floor(({c} + 0.5) / {t}.0 - 0.5)) END"
_TILE = f"{IMG}, z, ty, tx"
# shares of few voxels end in few digits, so they are compared to ten: none is half way between two
query("clahe", f"""WITH {PLANE}, bn AS (SELECT *, CAST(least(floor(least(greatest(v, 0), 1) * 60), 59) AS INT) b FROM dn), ct AS (SELECT {IMG}, z, y // 5 ty, x // 7 tx, b, count(*) n FROM bn GROUP BY ALL),
kp AS (SELECT *, sum(n) OVER (PARTITION BY {_TILE}) total, least(n, greatest(1.0, 0.05 * sum(n) OVER (PARTITION BY {_TILE}))) kept FROM ct), tl AS (SELECT {_TILE}, any_value(total) total, sum(kept) taken FROM kp GROUP BY ALL),
cv AS (SELECT tl.*, CAST(t.b AS INT) b, (sum(coalesce(kp.kept, 0)) OVER (PARTITION BY {', '.join('tl.' + c for c in _TILE.split(', '))} ORDER BY t.b) + (tl.total - taken) * (t.b + 1) / 60) / tl.total cdf FROM tl CROSS JOIN range(60) t(b) LEFT JOIN kp ON {' AND '.join(f'kp.{c} = tl.{c}' for c in _TILE.split(', '))} AND kp.b = t.b),
o AS (SELECT bn.fov, bn.round, bn.channel, bn.z, y, x, sum({_PART.format(c='y', t=5, i='i')} * {_PART.format(c='x', t=7, i='j')} * cdf) v FROM bn CROSS JOIN range(2) p(i) CROSS JOIN range(2) q(j) JOIN cv ON cv.fov = bn.fov AND cv.round = bn.round AND cv.channel = bn.channel AND cv.z = bn.z AND cv.b = bn.b AND ty = {_AT.format(c='y', t=5, i='CAST(i AS INT)')} AND tx = {_AT.format(c='x', t=7, i='CAST(j AS INT)')} GROUP BY ALL) SELECT {OUT.replace('6)', '10)')} FROM o""")(lambda spark, d: preprocess.clahe(plane(spark, d), SHAPE, 0.05, 60, 5).withColumn("v", F.round("v", 10) + 0.0))
query("morpho_contrast")(lambda spark, d: r6(preprocess.morpho_reconstruction_contrast(plane(spark, d), SHAPE, 4, 0.5)))
_RANGE = lambda out, src: f"{out} AS (SELECT t.* EXCLUDE (v, lo, hi), CASE WHEN hi - lo < 1e-9 THEN 0 ELSE (v - lo) / (hi - lo) END v FROM (SELECT *, min(v) OVER w lo, max(v) OVER w hi FROM {src} WINDOW w AS (PARTITION BY {IMG})) t)"
# the reference round passes all steps without a match; the others are matched to its finished images
_step(
    "clean_pipeline",
    lambda v: preprocess.cleaned(v, [("clip_percentile", {"min_percentile": 1.0, "max_percentile": 99.0}), ("histogram_match", {"scope": "inter_round"}), ("gaussian_blur", {"sigma": 0.8}), ("min_max_normalize", {})], SHAPE),
    f"""ps AS (SELECT {IMG}, quantile_cont(v, 0.01) lo, quantile_cont(v, 0.99) hi FROM dn GROUP BY ALL), cp AS (SELECT dn.* EXCLUDE v, least(greatest(v, lo), hi) v FROM dn JOIN ps USING ({IMG})), {_kernel('g8', 0.8)},
c1 AS (SELECT * FROM cp WHERE round = 1), {_blur('b1', 'g8', 'c1')}, {_RANGE('f1', 'b1')}, c2 AS (SELECT * FROM cp WHERE round <> 1), {_matched('round = 1', 'fov, channel', 'c2', 'f1')}, {_blur('b2', 'g8', 'o')}, {_RANGE('f2', 'b2')} SELECT {OUT} FROM (SELECT {_VX}, v FROM f1 UNION ALL SELECT {_VX}, v FROM f2)""",
)

VOL = fx.volume_sql(4)
_MIP = f"{VOL}, cm AS (SELECT fov, round, z, y, x, max(v) v FROM vol GROUP BY ALL), mp AS (SELECT fov, round, y, x, max(v) v FROM cm GROUP BY ALL)"


def mip(spark, d):
    return register.z_projection(register.channel_projection(fx.volume_li(spark, d, 4)))


@query("channel_mip", f"WITH {_MIP} SELECT * FROM cm")
def _(spark, d):
    return register.channel_projection(fx.volume_li(spark, d, 4))


@query("z_mip", f"WITH {_MIP} SELECT * FROM mp")
def _(spark, d):
    return mip(spark, d)


@query("xy_stride", f"WITH {_MIP} SELECT fov, round, z, y // 2 y, x // 2 x, v FROM cm WHERE y % 2 = 0 AND x % 2 = 0")
def _(spark, d):
    return register.strided(register.channel_projection(fx.volume_li(spark, d, 4)), 2)


_CC = f"""{_MIP}, cc AS (SELECT m.fov, m.round, dy, dx, sum(r.v * m.v) cc FROM mp m CROSS JOIN range(-3, 4) a(dy) CROSS JOIN range(-3, 4) b(dx) JOIN mp r ON r.fov = m.fov AND r.round = 1 AND m.round <> 1 AND r.y = m.y - dy AND r.x = m.x - dx GROUP BY ALL)"""


@query("global_shift", f"WITH {_CC}, b AS (SELECT *, row_number() OVER (PARTITION BY fov, round ORDER BY cc DESC, dy*dy + dx*dx, dy, dx) k FROM cc), p AS (SELECT fov, round, sum(v*v) p FROM mp GROUP BY ALL) SELECT b.fov, b.round, CAST(dy AS INT) dy, CAST(dx AS INT) dx, cc, round(1 - sqrt(greatest(1 - cc*cc / (p.p * r.p), 0)), 6) score, sqrt(dy*dy + dx*dx) > 200 suspect FROM b JOIN p USING (fov, round) JOIN p r ON r.fov = b.fov AND r.round = 1 WHERE k = 1")
def _(spark, d):
    return r6(register.global_shift(mip(spark, d), 1, 3), "score")


@query("rigid_shift", f"WITH {_MIP}, h AS (SELECT fov, round, y + 1 + a.i y, x - 2 + b.j x, CASE a.i WHEN 0 THEN 0.75 ELSE 0.25 END * CASE b.j WHEN 0 THEN 0.5 ELSE 0.5 END * v v FROM mp CROSS JOIN range(2) a(i) CROSS JOIN range(2) b(j)) SELECT fov, round, CAST(y AS INT) y, CAST(x AS INT) x, round(sum(v), 6) v FROM h WHERE y BETWEEN 0 AND 49 AND x BETWEEN 0 AND 63 GROUP BY ALL")
def _(spark, d):
    m = mip(spark, d)
    s = m.select("fov", "round").distinct().withColumns({"dy": F.lit(1.25), "dx": F.lit(-1.5)})
    return r6(register.shifted(m, s, {"y": 50, "x": 64}))


@query("quality_mask", f"WITH {_MIP} SELECT * FROM mp WHERE v > 1e-5 AND y BETWEEN 5 AND 44 AND x BETWEEN 5 AND 58 AND y >= 7 AND x < 58")
def _(spark, d):
    m = mip(spark, d)
    s = m.select("fov", "round").distinct().withColumns({"dy": F.lit(7.6), "dx": F.lit(-6.9)})
    return register.quality_mask(m, s, 50, 64, 5)


@query("mip_corr", f"WITH {_MIP}, g AS (SELECT i.fov, i.round, y, x FROM (SELECT DISTINCT fov, round FROM mp) i CROSS JOIN range(50) a(y) CROSS JOIN range(64) b(x)), j AS (SELECT g.fov, g.round, coalesce(m.v, 0) v, coalesce(r.v, 0) rv FROM g LEFT JOIN mp m ON m.fov = g.fov AND m.round = g.round AND m.y = g.y AND m.x = g.x LEFT JOIN mp r ON r.fov = g.fov AND r.round = 1 AND r.y = g.y AND r.x = g.x) SELECT fov, round, round(corr(v, rv), 6) corr FROM j GROUP BY fov, round")
def _(spark, d):
    return r6(register.correlations(mip(spark, d), 1, 50, 64), "corr")


_BLOCK = f"""{_MIP}, mt AS (SELECT m.fov, m.round, r.y // 16 gy, r.x // 16 gx, dy, dx, CAST(count(*) AS DOUBLE) n, sum(r.v) a, sum(m.v) b, sum(r.v*m.v) ab, sum(r.v*r.v) aa, sum(m.v*m.v) bb FROM mp m CROSS JOIN range(-2, 3) p(dy) CROSS JOIN range(-2, 3) q(dx) JOIN mp r ON r.fov = m.fov AND r.round = 1 AND m.round <> 1 AND r.y = m.y - dy AND r.x = m.x - dx GROUP BY ALL),
rr AS (SELECT *, round(CASE WHEN (n*aa - a*a) * (n*bb - b*b) > 1e-9 THEN (n*ab - a*b) / sqrt((n*aa - a*a) * (n*bb - b*b)) END, 9) r FROM mt), k AS (SELECT *, row_number() OVER (PARTITION BY fov, round, gy, gx ORDER BY r DESC, dy*dy + dx*dx, dy DESC, dx DESC) k FROM rr WHERE r IS NOT NULL), bf AS (SELECT fov, round, 0 gz, gy, gx, 0.0 dz, CAST(dy AS DOUBLE) dy, CAST(dx AS DOUBLE) dx FROM k WHERE k = 1)"""


@query("block_flow", f"WITH {_BLOCK} SELECT * FROM bf")
def _(spark, d):
    return register.block_flow(mip(spark, d), 1, 16, 2)


@query("warp", f"WITH {_MIP}, f AS (SELECT fov, round, y, x, y + 0.5 py, x - 1.25 px FROM mp), c AS (SELECT f.fov, f.round, f.y, f.x, CAST(floor(py) AS INT) + i sy, CAST(floor(px) AS INT) + j sx, 0.5 * CASE j WHEN 0 THEN 0.25 ELSE 0.75 END w FROM f CROSS JOIN range(2) a(i) CROSS JOIN range(2) b(j)) SELECT c.fov, c.round, c.y, c.x, round(sum(w * m.v), 6) v FROM c JOIN mp m ON m.fov = c.fov AND m.round = c.round AND m.y = c.sy AND m.x = c.sx GROUP BY ALL")
def _(spark, d):
    m = mip(spark, d)
    return r6(register.warped(m, m.select(*register.PLANE, F.lit(0.5).alias("fy"), F.lit(-1.25).alias("fx"))))


@query("flow_smooth", f"WITH {_BLOCK} SELECT a.fov, a.round, a.gz, a.gy, a.gx, median(b.dz) dz, median(b.dy) dy, median(b.dx) dx FROM bf a JOIN bf b ON a.fov = b.fov AND a.round = b.round AND abs(a.gy - b.gy) <= 1 AND abs(a.gx - b.gx) <= 1 GROUP BY ALL")
def _(spark, d):
    return register.smoothed_flow(register.block_flow(mip(spark, d), 1, 16, 2))


_UP = lambda c, n: f"least(greatest(({c} + 0.5) / 16 - 0.5, 0), {n - 1})"


@query("flow_upscale", f"WITH {_BLOCK}, pu AS (SELECT fov, round, y, x, {_UP('y', 4)} uy, {_UP('x', 4)} ux FROM mp) SELECT pu.fov, pu.round, pu.y, pu.x, " + ", ".join(f"round(sum(CASE i WHEN 1 THEN uy - floor(uy) ELSE 1 - uy + floor(uy) END * CASE j WHEN 1 THEN ux - floor(ux) ELSE 1 - ux + floor(ux) END * coalesce(bf.d{c}, 0)), 6) + 0.0 f{c}" for c in "yx") + " FROM pu CROSS JOIN range(2) a(i) CROSS JOIN range(2) b(j) LEFT JOIN bf ON bf.fov = pu.fov AND bf.round = pu.round AND bf.gy = least(floor(uy) + i, 3) AND bf.gx = least(floor(ux) + j, 3) GROUP BY ALL")
def _(spark, d):
    return r6(register.dense_flow(register.block_flow(mip(spark, d), 1, 16, 2), mip(spark, d).select(*register.PLANE), 16, 4, 4), "fy", "fx")


# all planes: shifted onto round 1, scored, given a field, warped and scored again
def _corr_sql(out: str, plane: str) -> str:
    own = f"SELECT fov, round, sum(v) s, sum(v * v) ss FROM {plane} GROUP BY ALL"
    both = f"SELECT m.fov, m.round, sum(m.v * r.v) sp FROM {plane} m JOIN {plane} r ON r.fov = m.fov AND r.round = 1 AND r.y = m.y AND r.x = m.x GROUP BY ALL"
    return f"{out} AS (SELECT o.fov, o.round, (3200 * coalesce(sp, 0) - o.s * r.s) / nullif(sqrt((3200 * o.ss - o.s * o.s) * (3200 * r.ss - r.s * r.s)), 0) corr FROM ({own}) o JOIN ({own}) r ON r.fov = o.fov AND r.round = 1 LEFT JOIN ({both}) b ON b.fov = o.fov AND b.round = o.round)"


_SIDE = lambda c, k: f"CASE {k} WHEN 1 THEN {c} - floor({c}) ELSE 1 - {c} + floor({c}) END"
_FIELD = ", ".join(f"sum({_SIDE('uy', 'i')} * {_SIDE('ux', 'j')} * coalesce(bf.d{c}, 0)) f{c}" for c in "yx")
_REGISTERED = f"""{_CC}, bs AS (SELECT *, row_number() OVER (PARTITION BY fov, round ORDER BY cc DESC, dy*dy + dx*dx, dy, dx) k FROM cc), sh AS (SELECT fov, round, CAST(-dy AS INT) dy, CAST(-dx AS INT) dx FROM bs WHERE k = 1),
al AS (SELECT m.fov, m.round, CAST(m.y + sh.dy AS INT) y, CAST(m.x + sh.dx AS INT) x, m.v FROM mp m JOIN sh USING (fov, round) WHERE m.y + sh.dy BETWEEN 0 AND 49 AND m.x + sh.dx BETWEEN 0 AND 63 UNION ALL SELECT * FROM mp WHERE round = 1),
{_BLOCK[_BLOCK.index('mt AS ('):].replace('mp m CROSS', 'al m CROSS').replace('JOIN mp r', 'JOIN al r')},
pu AS (SELECT fov, round, y, x, {_UP('y', 4)} uy, {_UP('x', 4)} ux FROM al), fd AS (SELECT pu.fov, pu.round, pu.y, pu.x, {_FIELD} FROM pu CROSS JOIN range(2) a(i) CROSS JOIN range(2) b(j) LEFT JOIN bf ON bf.fov = pu.fov AND bf.round = pu.round AND bf.gy = least(floor(uy) + i, 3) AND bf.gx = least(floor(ux) + j, 3) GROUP BY ALL),
co AS (SELECT fov, round, y, x, CAST(floor(y + fy) AS INT) + i sy, CAST(floor(x + fx) AS INT) + j sx, {_SIDE('(y + fy)', 'i')} * {_SIDE('(x + fx)', 'j')} w FROM fd CROSS JOIN range(2) a(i) CROSS JOIN range(2) b(j) WHERE round <> 1),
wp AS (SELECT co.fov, co.round, co.y, co.x, sum(w * m.v) v FROM co JOIN al m ON m.fov = co.fov AND m.round = co.round AND m.y = co.sy AND m.x = co.sx WHERE w > 0 GROUP BY ALL UNION ALL SELECT fov, round, y, x, v FROM mp WHERE round = 1),
{_corr_sql('gc', 'al')}, {_corr_sql('lc', 'wp')},
gt AS (SELECT fov, round, gc.corr global_corr, lc.corr local_corr, coalesce(gc.corr >= 0.02 AND lc.corr >= gc.corr, false) local_kept FROM gc LEFT JOIN lc USING (fov, round) WHERE round <> 1)"""


def _registered(spark, d):
    """Gates with shifts, and the nodes of all fields. The gate's least correlation is low, as two rounds of line items have
    little in common."""
    m = mip(spark, d)
    shift = register.global_shift(m, 1, 3).select("fov", "round", F.lit(0).alias("dz"), (-F.col("dy")).alias("dy"), (-F.col("dx")).alias("dx"))
    ref = m.filter("round = 1")
    moved = register.shifted(m.filter("round <> 1"), shift, {"y": 50, "x": 64}).unionByName(ref)
    flow = register.block_flow(moved, 1, 16, 2)
    dense = register.dense_flow(flow, moved.filter("round <> 1").select(*register.PLANE), 16, 4, 4)
    warped = register.warped(moved, dense).unionByName(ref)
    corr = lambda p, name: register.correlations(p, 1, 50, 64).filter("round <> 1").withColumnRenamed("corr", name)
    scores = shift.join(corr(moved, "global_corr"), ["fov", "round"]).join(corr(warped, "local_corr"), ["fov", "round"], "left")
    return register.gated(scores, 0.02), flow


@query("local_gate", f"WITH {_REGISTERED} SELECT fov, round, round(global_corr, 6) global_corr, round(local_corr, 6) local_corr, local_kept, round(CASE WHEN local_kept THEN local_corr ELSE global_corr END, 6) final_corr FROM gt")
def _(spark, d):
    return r6(_registered(spark, d)[0].drop("dz", "dy", "dx"), "global_corr", "local_corr", "final_corr")


@query("transform_table", f"WITH {_REGISTERED} SELECT fov, round, 0.0 dz, CAST(dy AS DOUBLE) dy, CAST(dx AS DOUBLE) dx, round(global_corr, 6) global_corr, round(CASE WHEN local_kept THEN local_corr ELSE global_corr END, 6) final_corr, local_kept FROM gt JOIN sh USING (fov, round) UNION ALL SELECT DISTINCT fov, 1, 0.0, 0.0, 0.0, 1.0, 1.0, false FROM gt")
def _(spark, d):
    return r6(register.transform_table(_registered(spark, d)[0], 1), "global_corr", "final_corr")


@query("kept_flow", f"WITH {_REGISTERED} SELECT bf.* FROM bf JOIN gt USING (fov, round) WHERE local_kept")
def _(spark, d):
    gates, flow = _registered(spark, d)
    return register.kept_flow(flow, gates)


_MAX = f"""{VOL}, lm AS (SELECT c.* FROM vol c WHERE c.v > 0.1 * 255 AND NOT EXISTS (SELECT 1 FROM vol n WHERE n.fov = c.fov AND n.round = c.round AND n.channel = c.channel AND abs(n.z - c.z) <= 1 AND abs(n.y - c.y) <= 1 AND abs(n.x - c.x) <= 1 AND n.v > c.v))"""


def _maxima(spark, d):
    return spots.local_maxima(fx.volume_li(spark, d, 4), 0.1, 255.0)


@query("local_max", f"WITH {_MAX} SELECT * FROM lm")
def _(spark, d):
    return _maxima(spark, d)


@query("components", f"""WITH RECURSIVE {_MAX}, ed AS (SELECT a.fov, a.round, a.channel, a.z*10000 + a.y*100 + a.x p, b.z*10000 + b.y*100 + b.x q FROM lm a JOIN lm b ON a.fov = b.fov AND a.round = b.round AND a.channel = b.channel AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
re AS (SELECT fov, round, channel, p, p AS q FROM ed UNION SELECT re.fov, re.round, re.channel, re.p, ed.q FROM re JOIN ed ON ed.fov = re.fov AND ed.round = re.round AND ed.channel = re.channel AND ed.p = re.q),
lb AS (SELECT fov, round, channel, p, min(q) label FROM re GROUP BY ALL), cs AS (SELECT lm.*, label FROM lm JOIN lb ON lb.fov = lm.fov AND lb.round = lm.round AND lb.channel = lm.channel AND lb.p = lm.z*10000 + lm.y*100 + lm.x)
SELECT fov, round, channel, round(sum(v*z)/sum(v), 6) z, round(sum(v*y)/sum(v), 6) y, round(sum(v*x)/sum(v), 6) x, max(v) intensity FROM cs GROUP BY fov, round, channel, label""")
def _(spark, d):
    return r6(spots.component_spots(spots.components(_maxima(spark, d))), "z", "y", "x")


query("peak_min_distance")(lambda spark, d: spots.separated_peaks(fx.volume_li(spark, d, 4), 2, 50, 64, 7, 0.3))
query("blob_dog")(lambda spark, d: spots.blob_dog(_dense_volume(spark, d), spots.scales((0.8, 1.0, 1.0), (1.6, 2.0, 2.0)), 0.01, {"z": 7, "y": 50, "x": 64}))


def _dense_volume(spark, d):
    v = fx.volume_li(spark, d, 4).withColumn("v", F.col("v") / 255.0)
    return st.densified(v, 50, 64, 7)


@query("volume_profile", f"WITH {VOL}, s AS (SELECT fov, round, channel, count(*) n, min(v) lo, max(v) high, sum(v) / 22400.0 mean, sum(v*v) / 22400.0 ss FROM vol GROUP BY ALL) SELECT fov, round, channel, CASE WHEN n < 22400 THEN 0 ELSE lo END low, high, round(mean, 6) mean, round(sqrt(ss - mean*mean), 6) std FROM s")
def _(spark, d):
    return r6(spots.profile(fx.volume_li(spark, d, 4), 22400), "mean", "std")


_SPOT = "so AS (SELECT CAST(sk % 4 AS INT) fov, ((ok * 1000000 + pk) * 100000 + sk) * 10 + ln spot_id, CAST((pk * 7) % 60 AS DOUBLE) / 10 z, CAST((ok * 3) % 490 AS DOUBLE) / 10 y, CAST((ok + pk) % 630 AS DOUBLE) / 10 x, CAST(ok % 3 AS INT) channel, CASE WHEN pk % 2 = 0 THEN 'a' ELSE 'b' END algo FROM (SELECT DISTINCT l_orderkey ok, l_partkey pk, l_suppkey sk, l_linenumber ln FROM lineitem))"


def spot_number(ok, pk, sk, ln):
    """The number SQL makes of four keys. Where that takes more than 64 bits, which SQL ends with an error, a negative number
    from a hash of the keys."""
    number = F.try_add(F.try_multiply(F.try_add(F.try_multiply(F.try_add(F.try_multiply(ok, F.lit(1000000)), pk), F.lit(100000)), sk), F.lit(10)), ln)
    hashed = -1 - F.shiftrightunsigned(F.xxhash64(ok, pk, sk, ln), 1)
    return F.coalesce(number, F.when(ok.isNotNull() & pk.isNotNull() & sk.isNotNull() & ln.isNotNull(), hashed))


def some_spots(spark, d):
    """Spots at places from keys: one of each distinct line item, numbered by its four keys."""
    li = fx.spots_li(spark, d)
    ok, pk = F.col("ok"), F.col("pk")
    return li.select((F.col("sk") % 4).cast("int").alias("fov"), spot_number(ok, pk, F.col("sk"), F.col("ln")).alias("spot_id"), ((pk * 7) % 60 / 10.0).alias("z"), ((ok * 3) % 490 / 10.0).alias("y"), ((ok + pk) % 630 / 10.0).alias("x"), (ok % 3).cast("int").alias("channel"), F.when(pk % 2 == 0, "a").otherwise("b").alias("algo"))


def _points(spark, d):
    rounds = spark.createDataFrame([(f, r) for f in range(4) for r in (1, 2)], "fov int, round int")
    shifts = spark.createDataFrame([(f, 2, 0.0, 1.5, -0.75) for f in range(4)], "fov int, round int, dz double, dy double, dx double")
    return extract.mapped_coordinates(some_spots(spark, d), rounds, shifts)


_POINT = f"{_SPOT}, pt AS (SELECT so.*, CAST(r AS INT) AS round, z pz, y - CASE r WHEN 2 THEN 1.5 ELSE 0 END py, x + CASE r WHEN 2 THEN 0.75 ELSE 0 END px FROM so CROSS JOIN (VALUES (1), (2)) t(r))"
_BOX = f"{_POINT}, {VOL}, bf AS (SELECT fov, round, channel, CAST(z + i AS INT) z, CAST(y + j AS INT) y, CAST(x + k AS INT) x, sum(v) v FROM vol CROSS JOIN range(-1, 2) oa(i) CROSS JOIN range(-1, 2) ob(j) CROSS JOIN range(-1, 2) oc(k) GROUP BY ALL), bx AS (SELECT pt.fov, spot_id, pt.round, bf.channel, bf.v FROM pt JOIN bf ON bf.fov = pt.fov AND bf.round = pt.round AND bf.z = CAST(round_even(pz, 0) AS INT) AND bf.y = CAST(round_even(py, 0) AS INT) AND bf.x = CAST(round_even(px, 0) AS INT)), it AS (SELECT so.fov, so.spot_id, CAST(r - 1 AS INT) round_idx, CAST(c AS INT) chan_idx, coalesce(v, 0) v FROM so CROSS JOIN (VALUES (1), (2)) t(r) CROSS JOIN range(3) u(c) LEFT JOIN bx ON bx.fov = so.fov AND bx.spot_id = so.spot_id AND bx.round = r AND bx.channel = c)"


@query("map_coords", f"WITH {_POINT} SELECT fov, spot_id, round, round(pz, 6) pz, round(py, 6) py, round(px, 6) px FROM pt")
def _(spark, d):
    return r6(_points(spark, d).select("fov", "spot_id", "round", "pz", "py", "px"), "pz", "py", "px")


def _sums(spark, d):
    return extract.box_sums(_points(spark, d), fx.volume_li(spark, d, 4))


@query("box_sum", f"WITH {_BOX} SELECT * FROM bx")
def _(spark, d):
    return _sums(spark, d)


def _manifest(spark):
    return tables.manifest(spark, [0, 1, 2, 3], {1: [0, 1, 2], 2: [0, 1, 2]}, {})


def _table(spark, d):
    return extract.intensity_table(some_spots(spark, d), _manifest(spark), _sums(spark, d))


@query("intensity_table", f"WITH {_BOX} SELECT * FROM it")
def _(spark, d):
    return _table(spark, d)


@query("top_intensity", f"WITH {_BOX} SELECT fov, spot_id, sum(v) total FROM it GROUP BY ALL ORDER BY total DESC, fov, spot_id LIMIT 5")
def _(spark, d):
    return extract.brightest(_table(spark, d))


@query("spot_traces", f"WITH {_BOX}, t AS (SELECT fov, spot_id, sum(v) total FROM it GROUP BY ALL ORDER BY total DESC, fov, spot_id LIMIT 5) SELECT it.* FROM it JOIN t USING (fov, spot_id)")
def _(spark, d):
    t = _table(spark, d)
    return extract.traces(t, extract.brightest(t))


@query("crosstalk", f"WITH {_BOX} SELECT a.chan_idx chan_a, b.chan_idx chan_b, round(corr(a.v, b.v), 6) r FROM it a JOIN it b ON a.fov = b.fov AND a.spot_id = b.spot_id AND a.round_idx = 0 AND b.round_idx = 0 AND a.chan_idx < b.chan_idx GROUP BY ALL")
def _(spark, d):
    return r6(extract.crosstalk(_table(spark, d)), "r")


@query("debug_pivot", f"""WITH {_BOX}, f AS (SELECT DISTINCT fov, spot_id FROM it ORDER BY ALL LIMIT 100) SELECT fov, spot_id, {', '.join(f'max(v) FILTER (round_idx = {r} AND chan_idx = {c}) "R{r + 1}_C{c + 1}"' for r in range(2) for c in range(3))} FROM it JOIN f USING (fov, spot_id) GROUP BY ALL""")
def _(spark, d):
    return tables.debug_table(_table(spark, d), 2, 3)


@query("roi_spots", f"WITH {_SPOT} SELECT *, abs(z - 3) <= 0.5 on_plane FROM so WHERE y >= 15 AND y < 35 AND x >= 20 AND x < 40 AND abs(z - 3) <= 1")
def _(spark, d):
    return extract.region_spots(some_spots(spark, d), 3, 25, 30, 20)


@query("detector_compare", f"WITH {_SPOT} SELECT algo, abs(z - 3) <= 0.5 on_plane, count(*) n FROM so GROUP BY ALL")
def _(spark, d):
    return spots.compared(some_spots(spark, d), 3)


@query("spot_crop", f"WITH {_POINT}, {VOL}, zm AS (SELECT fov, round, channel, CAST(z + i AS INT) z, y, x, max(v) v FROM vol CROSS JOIN range(-1, 2) oa(i) GROUP BY ALL), ak AS (SELECT fov, spot_id, round, CAST(round_even(pz, 0) AS INT) z, CAST(round_even(py, 0) + j AS INT) y, CAST(round_even(px, 0) + k AS INT) x, CAST(j AS INT) oy, CAST(k AS INT) ox FROM pt CROSS JOIN range(-2, 3) ob(j) CROSS JOIN range(-2, 3) oc(k)) SELECT fov, spot_id, round, channel, oy, ox, v FROM ak JOIN zm USING (fov, round, z, y, x)")
def _(spark, d):
    return extract.spot_crop(_points(spark, d), fx.volume_li(spark, d, 4), 2)


@query("five_regions", f"WITH {VOL}, rg(region, cy, cx) AS (VALUES (0, 25, 32), (1, 12, 16), (2, 12, 48), (3, 37, 16), (4, 37, 48)) SELECT region, fov, round, channel, count(*) n, round(quantile_cont(v, 0.01), 6) p_low, round(quantile_cont(v, 0.995), 6) p_high FROM vol JOIN rg ON y >= cy - 5 AND y < cy + 5 AND x >= cx - 5 AND x < cx + 5 WHERE z = 3 GROUP BY ALL")
def _(spark, d):
    return r6(extract.five_regions(fx.volume_li(spark, d, 4), 3, 50, 64, 10), "p_low", "p_high")


@query("manifest_pad", f"WITH {VOL} SELECT CAST(f AS INT) fov, CAST(r AS INT) AS round, CAST(c AS INT) channel, sum(coalesce(v, 0)) total FROM range(5) a(f) CROSS JOIN (VALUES (1), (2)) t(r) CROSS JOIN range(3) u(c) LEFT JOIN vol ON vol.fov = f AND vol.round = r AND vol.channel = c GROUP BY ALL")
def _(spark, d):
    m = tables.manifest(spark, [0, 1, 2, 3, 4], {1: [0, 1, 2], 2: [0, 1, 2]}, {})
    return tables.padded(fx.volume_li(spark, d, 4), m).groupBy("fov", "round", "channel").agg(F.sum("v").alias("total"))


@query("select_images", f"WITH {VOL} SELECT fov, round, channel, z, y, x, v, z * 300.0 z_nm, y * 100.0 y_nm, x * 100.0 x_nm FROM vol WHERE fov IN (1, 2) AND round = 1")
def _(spark, d):
    return tables.physical(tables.selected(fx.volume_li(spark, d, 4), "1-2", 1), (300.0, 100.0, 100.0)).select(*VOXEL, "v", "z_nm", "y_nm", "x_nm")
