"""Queries over several stages: codes of several segments, whole decoding runs and their report, voxels to counts."""

from pyspark.sql import functions as F

from glimmer.functions import codebook
from glimmer.operators import job, rules, run
from glimmer.plans import fixtures as fx
from glimmer.sources import tables

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f
    return add


@query("codebook_segments", f"WITH {fx.LONG} SELECT min(code_ix) code_ix, barcode, max_by(gene, code_ix) gene, bool_or(good) ends_hold FROM lb GROUP BY barcode")
def _(spark, d):
    book = codebook.compile_codebook(fx.long_genes(spark, d), fx.LONG_SEGMENTS, fx.LONG_ORDER, "reverse_string")
    return book.select(F.col("code_ix").cast("long"), "barcode", "gene", F.coalesce(codebook.ends_hold(F.col("barcode"), fx.LONG_SEGMENTS, fx.LONG_ORDER), F.lit(False)).alias("ends_hold"))


_RULES = [
    rules.Rule("quality_mean_lt", "spot", params={"threshold": 0.5}),
    rules.Rule("channel_margin_mean_gt", "spot", hard=False, weight=2.0, params={"threshold": 0.3}),
    rules.Rule("end_base_pattern", "barcode", params={"segments": fx.SEGMENTS, "order": fx.ORDER}),
]
_RESCUE = {"max_distance": 1.0, "min_gap": 0.5, "weights": [1.0, 0.5, 1.0, 0.5]}

# the run: spots judged by rules, those kept read and named, judged by their end base, and the background of these rescued
_RUN = f"""{fx.SPOTS}, {fx.GENES}, r1 AS (SELECT *, coalesce(valid AND quality < 0.5, false) k1, valid AND margin >= 0.3 k2, CASE WHEN valid THEN greatest(quality - 0.5, 0) + 2 * greatest(0.3 - margin, 0) ELSE 0 END pen FROM sp),
r2 AS (SELECT r1.*, pen <= 0.2 k3, valid AND k1 AND pen <= 0.2 spot_keep FROM r1), back AS (SELECT substr(key, 1, 1) || (colour - 1) k, substr(key, 2, 1) nx FROM enc),
s1 AS (SELECT DISTINCT barcode FROM r2 WHERE spot_keep), s2 AS (SELECT barcode, nx b FROM s1 LEFT JOIN back ON k = 'C' || substr(barcode, 1, 1)), s3 AS (SELECT barcode, nx b FROM s2 LEFT JOIN back ON k = b || substr(barcode, 2, 1)),
s4 AS (SELECT barcode, nx b FROM s3 LEFT JOIN back ON k = b || substr(barcode, 3, 1)), s5 AS (SELECT barcode, coalesce(nx = 'G', false) ends FROM s4 LEFT JOIN back ON k = b || substr(barcode, 4, 1)),
r3 AS (SELECT r2.*, coalesce(ends AND spot_keep, false) barcode_keep, CASE WHEN spot_keep THEN coalesce(book.gene, 'background') END gene FROM r2 LEFT JOIN s5 ON s5.barcode = r2.barcode AND spot_keep LEFT JOIN book ON book.barcode = r2.barcode),
un AS (SELECT DISTINCT barcode FROM r3 WHERE barcode_keep AND gene = 'background'),
ds AS (SELECT un.barcode, book.gene, book.code_ix, list_sum([CASE WHEN substr(un.barcode, i, 1) <> substr(book.barcode, i, 1) THEN [1.0, 0.5, 1.0, 0.5][i] ELSE 0.0 END FOR i IN [1, 2, 3, 4]]) d FROM un, book),
rk AS (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY d, code_ix) k, lead(d) OVER (PARTITION BY barcode ORDER BY d, code_ix) d2 FROM ds),
res AS (SELECT barcode, gene new_gene FROM rk WHERE k = 1 AND d <= 1.0 AND coalesce(d2, d) - d >= 0.5),
r4 AS (SELECT r3.*, barcode_keep AND gene = 'background' asked, coalesce(barcode_keep AND gene = 'background' AND new_gene IS NOT NULL, false) rescued, CASE WHEN barcode_keep AND gene = 'background' AND new_gene IS NOT NULL THEN new_gene ELSE gene END final FROM r3 LEFT JOIN res USING (barcode))"""


def _run(spark, d):
    return run.decoded(fx.spots_li(spark, d), fx.codebook_part(spark, d), _RULES, max_soft_penalty=0.2, rescue=_RESCUE)


@query("decode_run", f"WITH {_RUN} SELECT ok, pk, sk, ln, valid, spot_keep, barcode_keep, CASE WHEN spot_keep THEN barcode END barcode, final gene, rescued rescue_applied FROM r4")
def _(spark, d):
    return _run(spark, d).select(*fx.KEYS, "valid", "spot_keep", "barcode_keep", "barcode", "gene", F.coalesce("rescue_applied", F.lit(False)).alias("rescue_applied"))


@query("decode_report", f"""WITH {_RUN} SELECT fov, count(*) n_total_spots, count(*) FILTER (spot_keep) n_after_spot_rules, count(*) FILTER (barcode_keep) n_after_barcode_rules,
count(*) FILTER (k1) quality_after, count(*) FILTER (NOT k1) quality_failed, count(*) FILTER (valid) quality_valid, count(*) FILTER (k2) margin_pass, round(avg(margin) FILTER (valid), 6) margin_mean, count(*) FILTER (k1) gate_before, count(*) FILTER (k1 AND k3) gate_after, count(*) FILTER (NOT k3) gate_failed,
count(*) FILTER (spot_keep) ends_before, count(*) FILTER (barcode_keep) ends_after, count(*) FILTER (spot_keep AND NOT barcode_keep) ends_failed,
count(*) FILTER (asked) n_candidates, count(DISTINCT CASE WHEN asked THEN barcode END) n_unique_barcodes, count(DISTINCT CASE WHEN rescued THEN barcode END) n_rescue_rules, count(*) FILTER (rescued) n_rescued_spots FROM r4 GROUP BY fov""")
def _(spark, d):
    """The report's counts side by side."""
    r = run.report(_run(spark, d), _RULES, 0.2, _RESCUE)
    of = lambda stage, k, c: F.col(f"{stage}_rules")[k][c]
    detail = lambda k, c: F.col("spot_rules")[k]["details"][c]
    return r.select(
        "fov", "n_total_spots", "n_after_spot_rules", "n_after_barcode_rules",
        of("spot", 0, "after").alias("quality_after"), of("spot", 0, "failed_by_rule").alias("quality_failed"), detail(0, "n_valid_input").alias("quality_valid"),
        detail(1, "n_pass").alias("margin_pass"), F.round(detail(1, "avg_margin_valid"), 6).alias("margin_mean"),
        *[of("spot", 2, a).alias(f"gate_{b}") for a, b in (("before", "before"), ("after", "after"), ("failed_by_rule", "failed"))],
        *[of("barcode", 0, a).alias(f"ends_{b}") for a, b in (("before", "before"), ("after", "after"), ("failed_by_rule", "failed"))],
        *[F.col(f"weighted_rescue.{c}") for c in ("n_candidates", "n_unique_barcodes", "n_rescue_rules", "n_rescued_spots")],
    )


def stack_settings() -> job.Settings:
    return job.Settings(fx.STACK, steps=[("gamma_correction", {"gamma": 0.5})], threshold=0.3, rules=[rules.Rule("quality_mean_lt", "spot", params={"threshold": 0.45})], decimals=0)


_ID = "z * 100000 + y * 300 + x"


@query("voxels_to_counts", f"""WITH RECURSIVE {fx.STACK_SQL}, cl AS (SELECT * EXCLUDE v, round_even(sqrt(v / 255.0) * 255, 0) v FROM sv), r1 AS (SELECT * FROM cl WHERE round = 1),
nb AS (SELECT r1.fov, r1.channel, CAST(r1.z + i AS INT) z, CAST(r1.y + j AS INT) y, CAST(r1.x + k AS INT) x, max(v) m FROM r1 CROSS JOIN range(-1, 2) a(i) CROSS JOIN range(-1, 2) b(j) CROSS JOIN range(-1, 2) c(k) GROUP BY ALL),
lm AS (SELECT r1.*, {_ID} p FROM r1 JOIN nb USING (fov, channel, z, y, x) WHERE v = m AND v > 0.3 * 255),
ask AS (SELECT lm.fov, lm.channel, p, CAST(z + i AS INT) z, CAST(y + j AS INT) y, CAST(x + k AS INT) x FROM lm CROSS JOIN range(-1, 2) a(i) CROSS JOIN range(-1, 2) b(j) CROSS JOIN range(-1, 2) c(k)),
ed AS (SELECT ask.fov, ask.channel, ask.p, lm.p q FROM ask JOIN lm USING (fov, channel, z, y, x)),
re AS (SELECT fov, channel, p, p AS q FROM ed UNION SELECT re.fov, re.channel, re.p, ed.q FROM re JOIN ed ON ed.fov = re.fov AND ed.channel = re.channel AND ed.p = re.q),
lb AS (SELECT fov, channel, p, min(q) label FROM re GROUP BY ALL),
so AS (SELECT fov, channel, label, sum(v * z) / sum(v) z, sum(v * y) / sum(v) y, sum(v * x) / sum(v) x FROM lm JOIN lb USING (fov, channel, p) GROUP BY ALL),
pt AS (SELECT so.fov, so.channel ch, label, CAST(r AS INT) AS round, CAST(round_even(z + CASE WHEN r > 1 THEN (r + so.fov) % 3 - 1 ELSE 0 END, 0) AS INT) z, CAST(round_even(y + CASE WHEN r > 1 THEN 3 * r - so.fov ELSE 0 END, 0) AS INT) y, CAST(round_even(x + CASE WHEN r > 1 THEN so.fov - 4 * r ELSE 0 END, 0) AS INT) x FROM so CROSS JOIN range(1, 5) t(r)),
bf AS (SELECT fov, round, channel, CAST(z + i AS INT) z, CAST(y + j AS INT) y, CAST(x + k AS INT) x, sum(v) v FROM cl CROSS JOIN range(-1, 2) a(i) CROSS JOIN range(-1, 2) b(j) CROSS JOIN range(-1, 2) c(k) GROUP BY ALL),
iv AS (SELECT pt.fov, ch, label, pt.round r, c, coalesce(bf.v, 0) v FROM pt CROSS JOIN range(4) u(c) LEFT JOIN bf ON bf.fov = pt.fov AND bf.round = pt.round AND bf.channel = c AND bf.z = pt.z AND bf.y = pt.y AND bf.x = pt.x),
nv AS (SELECT *, v / (sqrt(sum(v*v) OVER (PARTITION BY fov, ch, label, r)) + 1e-6) n FROM iv),
rd AS (SELECT fov, ch, label, r, max(n) m, count(*) FILTER (n = m0) k, min(c) FILTER (n = m0) c0 FROM (SELECT *, max(n) OVER (PARTITION BY fov, ch, label, r) m0 FROM nv) GROUP BY ALL),
sp AS (SELECT fov, ch, label, string_agg(CAST(c0 AS VARCHAR), '' ORDER BY r) barcode, avg(-ln(m)) quality FROM rd GROUP BY ALL HAVING bool_and(k = 1 AND m > 0)),
bk AS (SELECT code, max_by(gene, code_ix) gene FROM pc GROUP BY code)
SELECT fov, gene, count(*) n FROM sp JOIN bk ON code = barcode WHERE quality < 0.45 GROUP BY ALL""")
def _(spark, d):
    rounds = {r: [0, 1, 2, 3] for r in (1, 2, 3, 4)}
    book = codebook.compile_codebook(fx.pair_genes(spark, d), fx.PAIR_SEGMENTS, fx.PAIR_ORDER)
    return job.run_job(fx.stack_li(spark, d), tables.manifest(spark, [0, 1, 2, 3], rounds, {}), book, stack_settings()).counts
