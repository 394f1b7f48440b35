"""Queries over codebooks, base calls, rules, rescue and expression."""

from pyspark.sql import functions as F

from glimmer.functions import calling, codebook
from glimmer.operators import decode, expression, rules
from glimmer.plans import fixtures as fx

QUERIES: dict = {}
ORACLE_SQL: dict = {}
K = fx.KEYS


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return add


def r6(c):
    return F.round(c, 6)


def _cells(df, col):
    """One row for each round and channel of a matrix column."""
    rounds = df.select(*K, F.posexplode(col).alias("r", "row"))
    return rounds.select(*K, "r", F.posexplode("row").alias("c", "n"))


@query("l2_normalize", f"WITH {fx.NORMAL} SELECT ok, pk, sk, ln, CAST(r AS INT) r, CAST(c AS INT) c, round(n, 6) n FROM nv")
def _(spark, d):
    return _cells(fx.spots_li(spark, d).withColumn("m", calling.l2_normalised(F.col("v"))), "m").withColumn("n", r6(F.col("n")))


_BIASED = ", b1 AS (SELECT *, greatest(n + CASE WHEN r = 1 THEN [-0.1, 0.0, 0.05, 0.0][c + 1] ELSE 0 END, 0) b FROM nv), b2 AS (SELECT *, sqrt(sum(b*b) OVER (PARTITION BY ok, pk, sk, ln, r)) w FROM b1)"


@query("round_channel_bias", f"WITH {fx.NORMAL}{_BIASED} SELECT ok, pk, sk, ln, CAST(r AS INT) r, CAST(c AS INT) c, round(b / CASE WHEN w > 1e-6 THEN w ELSE 1 END, 6) n FROM b2")
def _(spark, d):
    m = calling.biased(calling.l2_normalised(F.col("v")), {1: [-0.1, 0.0, 0.05, 0.0]}, 4)
    return _cells(fx.spots_li(spark, d).withColumn("m", m), "m").withColumn("n", r6(F.col("n")))


@query("softmax", f"WITH {fx.NORMAL}, e AS (SELECT *, exp((n - max(n) OVER (PARTITION BY ok, pk, sk, ln, r)) / 0.5) e FROM nv) SELECT ok, pk, sk, ln, CAST(r AS INT) r, CAST(c AS INT) c, round(e / sum(e) OVER (PARTITION BY ok, pk, sk, ln, r), 6) n FROM e")
def _(spark, d):
    normal = fx.spots_li(spark, d).withColumn("l", calling.l2_normalised(F.col("v")))
    return _cells(normal.withColumn("m", calling.softmax(F.col("l"), 0.5)), "m").withColumn("n", r6(F.col("n")))


@query("base_call", f"WITH {fx.SPOTS} SELECT ok, pk, sk, ln, valid, barcode, round(quality, 6) quality, intensity FROM sp")
def _(spark, d):
    s = decode.called(fx.spots_li(spark, d))
    return s.select(*K, "valid", calling.barcode(F.col("call")).alias("barcode"), r6(F.col("quality")).alias("quality"), "intensity")


@query("matrix_assembly", f"WITH {fx.LI} SELECT ok, pk, sk, ln, sum(v) total, max(v) FILTER (r = 2 AND c = 1) v21, CAST(count(*) AS BIGINT) n FROM iv GROUP BY ALL")
def _(spark, d):
    """The long table of intensities, put together into one matrix a spot."""
    s = fx.spots_li(spark, d)
    long = s.select(*K, F.posexplode("v").alias("round_idx", "row")).select(*K, "round_idx", F.posexplode("row").alias("chan_idx", "v"))
    m = decode.matrices(long, K)
    flat = F.flatten("v")
    return m.select(*K, F.aggregate(flat, F.lit(0.0), lambda a, x: a + x).alias("total"), F.col("v")[2][1].alias("v21"), F.size(flat).cast("long").alias("n"))


@query("quality_filter", f"WITH {fx.SPOTS} SELECT ok, pk, sk, ln, barcode, round(quality, 6) quality FROM sp WHERE valid AND quality < 0.5")
def _(spark, d):
    return decode.quality_filtered(decode.called(fx.spots_li(spark, d))).select(*K, "barcode", r6(F.col("quality")).alias("quality"))


def _decoded(spark, d):
    return decode.mapped(decode.quality_filtered(decode.called(fx.spots_li(spark, d))), fx.codebook_part(spark, d))


@query("gene_counts", f"WITH {fx.DECODED} SELECT gene, count(*) n FROM dec GROUP BY gene")
def _(spark, d):
    return _decoded(spark, d).groupBy("gene").agg(F.count("*").alias("n"))


@query("gene_map", f"WITH {fx.DECODED} SELECT ok, pk, sk, ln, fov, barcode, gene, intensity FROM dec")
def _(spark, d):
    return _decoded(spark, d).select(*K, "fov", "barcode", "gene", "intensity")


_RULED = fx.SPOTS + """, ru AS (SELECT *, CASE WHEN valid THEN greatest(quality - 0.5, 0) ELSE 0 END p1, CASE WHEN valid THEN greatest(0.3 - margin, 0) ELSE 0 END p2, coalesce(valid AND quality < 0.5, false) k1, valid AND margin >= 0.3 k2 FROM sp)"""
_RULES = [rules.Rule("quality_mean_lt", "spot", params={"threshold": 0.5}), rules.Rule("channel_margin_mean_gt", "spot", hard=False, weight=2.0, params={"threshold": 0.3})]


@query("rule_quality", f"WITH {_RULED} SELECT ok, pk, sk, ln, k1 AS keep, round(p1, 6) penalty FROM ru")
def _(spark, d):
    s = rules.with_rules(decode.called(fx.spots_li(spark, d)), _RULES[:1], "spot")
    return s.select(*K, F.coalesce("keep", F.lit(False)).alias("keep"), r6(F.col("penalty")).alias("penalty"))


@query("rule_margin", f"WITH {_RULED} SELECT ok, pk, sk, ln, k2 AS keep, round(p2, 6) penalty FROM ru")
def _(spark, d):
    hard = rules.Rule("channel_margin_mean_gt", "spot", params={"threshold": 0.3})
    s = rules.with_rules(decode.called(fx.spots_li(spark, d)), [hard], "spot")
    return s.select(*K, "keep", r6(F.col("penalty")).alias("penalty"))


@query("rule_pipeline_soft", f"WITH {_RULED} SELECT ok, pk, sk, ln, k1 AND p1 + 2 * p2 <= 0.2 AS keep, round(p1 + 2 * p2, 6) penalty FROM ru")
def _(spark, d):
    s = rules.with_rules(decode.called(fx.spots_li(spark, d)), _RULES, "spot", 0.2)
    return s.select(*K, F.coalesce("keep", F.lit(False)).alias("keep"), r6(F.col("penalty")).alias("penalty"))


@query("rule_report", f"""WITH {_RULED}, g AS (SELECT *, p1 + 2 * p2 <= 0.2 k3 FROM ru)
SELECT fov, 'spot' AS stage, 0 AS place, 'quality_mean_lt' AS name, count(*) before, count(*) FILTER (k1) AS after, count(*) FILTER (NOT k1) failed FROM g GROUP BY fov
UNION ALL SELECT fov, 'spot', 1, 'channel_margin_mean_gt', count(*) FILTER (k1), count(*) FILTER (k1), count(*) FILTER (NOT k2) FROM g GROUP BY fov
UNION ALL SELECT fov, 'spot', 2, 'soft_penalty_gate', count(*) FILTER (k1), count(*) FILTER (k1 AND k3), count(*) FILTER (NOT k3) FROM g GROUP BY fov""")
def _(spark, d):
    s = decode.called(fx.spots_li(spark, d)).withColumn("quality", F.coalesce("quality", F.lit(1e9)))
    return rules.rule_report(s, _RULES, "spot", 0.2)


@query("rule_end_base", f"""WITH {fx.DECODED}, back AS (SELECT substr(key, 1, 1) || (colour - 1) k, substr(key, 2, 1) nx FROM enc),
s1 AS (SELECT DISTINCT barcode FROM dec), s2 AS (SELECT barcode, nx b FROM s1 LEFT JOIN back ON k = 'C' || substr(barcode, 1, 1)), s3 AS (SELECT barcode, nx b FROM s2 LEFT JOIN back ON k = b || substr(barcode, 2, 1)),
s4 AS (SELECT barcode, nx b FROM s3 LEFT JOIN back ON k = b || substr(barcode, 3, 1)), s5 AS (SELECT barcode, nx b FROM s4 LEFT JOIN back ON k = b || substr(barcode, 4, 1))
SELECT ok, pk, sk, ln, barcode, coalesce(b = 'G', false) AS keep FROM dec JOIN s5 USING (barcode)""")
def _(spark, d):
    one = [rules.Rule("end_base_pattern", "barcode", params={"segments": fx.SEGMENTS, "order": fx.ORDER})]
    return rules.with_rules(_decoded(spark, d), one, "barcode").select(*K, "barcode", "keep")


@query("encode_sliding", f"WITH {fx.GENES} SELECT code_ix, gene, barcode FROM coded")
def _(spark, d):
    g = fx.genes_part(spark, d)
    return g.select(F.col("code_ix").cast("long"), "gene", codebook.slide_encoded(F.col("seq"), fx.FOUR).alias("barcode"))


@query("codebook_compile", f"WITH {fx.GENES} SELECT * FROM book")
def _(spark, d):
    return fx.codebook_part(spark, d).withColumn("code_ix", F.col("code_ix").cast("long"))


@query("digit_codebook", f"WITH {fx.GENES} SELECT code_ix, barcode, gene FROM book WHERE regexp_full_match(barcode, '[0-9]+') AND length(barcode) = 4")
def _(spark, d):
    return codebook.digit_codebook(fx.codebook_part(spark, d)).withColumn("code_ix", F.col("code_ix").cast("long"))


@query("decode_colors", f"WITH {fx.GENES} SELECT code_ix, seq bases FROM genes")
def _(spark, d):
    """Sequences come back from their colours."""
    g = fx.genes_part(spark, d)
    code = codebook.slide_encoded(F.col("seq"), fx.FOUR)
    return g.select(F.col("code_ix").cast("long"), codebook.colours_decoded(code, "C", fx.FOUR).alias("bases"))


@query("reverse_segment", "SELECT p_partkey, reverse(p_name) o, CASE WHEN length(p_name) >= 12 THEN substr(p_name, 3, 10) ELSE 'ERROR_LEN' END s FROM part")
def _(spark, d):
    n = F.col("p_name")
    return fx.read(spark, d, "part").select("p_partkey", codebook.oriented(n, "reverse_string").alias("o"), codebook.sliced(n, 3, 12).alias("s"))


_RESCUE = fx.DECODED + """, d2 AS (SELECT sp.*, coalesce(book.gene, 'background') gene FROM sp LEFT JOIN book USING (barcode) WHERE valid AND quality < 0.5),
un AS (SELECT DISTINCT barcode FROM d2 WHERE gene = 'background'),
ds AS (SELECT un.barcode, book.gene, book.code_ix, list_sum([CASE WHEN substr(un.barcode, i, 1) <> substr(book.barcode, i, 1) THEN [1.0, 0.5, 1.0, 0.5][i] ELSE 0.0 END FOR i IN [1, 2, 3, 4]]) d FROM un, book),
rk AS (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY d, code_ix) k, lead(d) OVER (PARTITION BY barcode ORDER BY d, code_ix) d2 FROM ds),
res AS (SELECT barcode, gene new_gene, CAST(d AS DOUBLE) d, CAST(coalesce(d2, d) - d AS DOUBLE) gap FROM rk WHERE k = 1 AND d <= 1.0 AND coalesce(d2, d) - d >= 0.5)"""


def _with_book(spark, d):
    book = fx.codebook_part(spark, d)
    return decode.mapped(decode.quality_filtered(decode.called(fx.spots_li(spark, d))), book), book


@query("weighted_rescue", f"WITH {_RESCUE} SELECT ok, pk, sk, ln, barcode, CASE WHEN d2.gene = 'background' AND new_gene IS NOT NULL THEN new_gene ELSE d2.gene END gene, coalesce(d2.gene = 'background' AND new_gene IS NOT NULL, false) rescue_applied, CASE WHEN d2.gene = 'background' THEN d END rescue_distance, CASE WHEN d2.gene = 'background' THEN gap END rescue_gap FROM d2 LEFT JOIN res USING (barcode)")
def _(spark, d):
    spots, book = _with_book(spark, d)
    out = decode.rescued(spots, book, 1.0, 0.5, [1.0, 0.5, 1.0, 0.5])
    return out.select(*K, "barcode", "gene", "rescue_applied", "rescue_distance", "rescue_gap")


@query("rescue_report", f"WITH {_RESCUE.replace('[1.0, 0.5, 1.0, 0.5]', '[1.0, 1.0, 1.0, 1.0]')} SELECT (SELECT count(*) FROM d2 WHERE gene = 'background') n_candidates, (SELECT count(*) FROM un) n_unique_barcodes, (SELECT count(*) FROM res) n_rescue_rules, (SELECT count(*) FROM d2 JOIN res USING (barcode) WHERE d2.gene = 'background') n_rescued_spots")
def _(spark, d):
    spots, book = _with_book(spark, d)
    return decode.rescue_report(spots, decode.rescued(spots, book, 1.0, 0.5), book, 1.0, 0.5)


@query("round_quality", f"WITH {fx.SPOTS}, q AS (SELECT rs.fov, CAST(r AS INT) round_idx, avg(score) quality FROM rs JOIN sp USING (ok, pk, sk, ln) WHERE valid AND sp.quality < 0.5 GROUP BY ALL) SELECT fov, round_idx, round(quality, 6) quality, quality < 0.5 AS passed FROM q")
def _(spark, d):
    return decode.round_quality(decode.quality_filtered(decode.called(fx.spots_li(spark, d)))).withColumn("quality", r6(F.col("quality")))


@query("mapping_rates", f"WITH {fx.SPOTS}, {fx.GENES}, t AS (SELECT sp.*, valid AND quality < 0.5 qk, valid AND quality < 0.5 AND margin >= 0.3 rk, coalesce(book.gene, 'background') gene FROM sp LEFT JOIN book USING (barcode)), c AS (SELECT fov, count(*) n_total, count(*) FILTER (valid) n_valid, count(*) FILTER (qk) n_quality, count(*) FILTER (rk) n_rules, count(*) FILTER (rk AND gene <> 'background') n_mapped FROM t GROUP BY fov) SELECT *, round(n_mapped / n_quality, 6) rate_quality, round(n_mapped / n_rules, 6) rate_rules FROM c")
def _(spark, d):
    s = decode.called(fx.spots_li(spark, d)).withColumn("barcode", calling.barcode(F.col("call")))
    ok = F.coalesce(F.col("valid") & (F.col("quality") < 0.5), F.lit(False))
    s = decode.mapped(s, fx.codebook_part(spark, d)).withColumns({"quality_keep": ok, "rule_keep": ok & (F.col("margin") >= 0.3)})
    return decode.mapping_rates(s).withColumns({c: r6(F.col(c)) for c in ("rate_quality", "rate_rules")})


@query("top_genes", f"WITH {fx.DECODED} SELECT gene, count(*) n FROM dec WHERE gene <> 'background' GROUP BY gene ORDER BY n DESC, gene LIMIT 10")
def _(spark, d):
    return decode.top_genes(_decoded(spark, d))


@query("gene_lookup", f"WITH {fx.DECODED}, h AS (SELECT *, row_number() OVER (ORDER BY ok, pk, sk, ln) k FROM dec WHERE upper(gene) = (SELECT upper(min(p_name)) FROM part)) SELECT ok, pk, sk, ln, gene FROM h WHERE k = 1")
def _(spark, d):
    first = fx.read(spark, d, "part").agg(F.min("p_name")).first()[0]
    return expression.nth_spot(_decoded(spark, d), first.lower(), 1, K).select(*K, "gene")


@query("background_filter", f"WITH {fx.DECODED} SELECT ok, pk, sk, ln, gene FROM dec WHERE gene <> 'background'")
def _(spark, d):
    return expression.without_background(_decoded(spark, d)).select(*K, "gene")


_EXPR = "ge AS (SELECT p_partkey, p_name || CASE p_partkey % 3 WHEN 0 THEN '_ntRNA' WHEN 1 THEN '_rbRNA' ELSE '' END raw, p_name gene FROM part), ref AS (SELECT gene, sum(l_extendedprice) value_ref FROM ge JOIN lineitem ON l_partkey = p_partkey GROUP BY gene), cnt AS (SELECT gene, count(*) AS count FROM ge JOIN lineitem ON l_partkey = p_partkey WHERE l_quantity > 25 GROUP BY gene), jn AS (SELECT gene, count, value_ref FROM cnt JOIN ref USING (gene))"


def _expressed(spark, d):
    raw = F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, "_ntRNA").when(F.col("p_partkey") % 3 == 1, "_rbRNA").otherwise(""))
    rows = fx.read(spark, d, "lineitem").join(fx.read(spark, d, "part").select("p_partkey", raw.alias("gene")), F.col("l_partkey") == F.col("p_partkey"))
    ref = expression.reference(rows.select(expression.cleaned(F.col("gene")).alias("gene"), F.col("l_extendedprice").alias("value")))
    return expression.gene_counts(rows.filter("l_quantity > 25")), ref


@query("gene_clean", f"WITH {_EXPR} SELECT p_partkey, raw, gene FROM ge")
def _(spark, d):
    raw = F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, "_ntRNA").when(F.col("p_partkey") % 3 == 1, "_rbRNA").otherwise(""))
    return fx.read(spark, d, "part").select("p_partkey", raw.alias("raw")).withColumn("gene", expression.cleaned(F.col("raw")))


@query("clean_gene_counts", f"WITH {_EXPR} SELECT * FROM cnt")
def _(spark, d):
    return _expressed(spark, d)[0]


@query("expression_matrix", f"WITH {fx.DECODED} SELECT CAST(fov AS BIGINT) fov, gene, count(*) n FROM dec WHERE gene <> 'background' GROUP BY ROLLUP (fov, gene)")
def _(spark, d):
    return expression.matrix(_decoded(spark, d))


@query("validate_join", f"WITH {_EXPR} SELECT gene, count, round(value_ref, 2) value_ref, round(ln(1 + count), 6) log_count, round(ln(1 + value_ref), 6) log_ref FROM jn")
def _(spark, d):
    j = expression.joined(*_expressed(spark, d))
    return j.select("gene", "count", F.round("value_ref", 2).alias("value_ref"), r6(F.col("log_count")).alias("log_count"), r6(F.col("log_ref")).alias("log_ref"))


@query("validate_pearson", f"WITH {_EXPR} SELECT round(corr(count, value_ref), 6) r, round(corr(ln(1 + count), ln(1 + value_ref)), 6) r_log, count(*) n FROM jn")
def _(spark, d):
    return expression.pearson(expression.joined(*_expressed(spark, d))).select(r6(F.col("r")).alias("r"), r6(F.col("r_log")).alias("r_log"), "n")


@query("validate_spearman", f"WITH {_EXPR}, rk AS (SELECT rank() OVER (ORDER BY count) + (count(*) OVER (PARTITION BY count) - 1) / 2.0 a, rank() OVER (ORDER BY value_ref) + (count(*) OVER (PARTITION BY value_ref) - 1) / 2.0 b FROM jn) SELECT round(corr(a, b), 6) r FROM rk")
def _(spark, d):
    return expression.spearman(expression.joined(*_expressed(spark, d))).select(r6(F.col("r")).alias("r"))


@query("top_labels", f"WITH {_EXPR} SELECT gene, count FROM jn ORDER BY count DESC, gene LIMIT 5")
def _(spark, d):
    return expression.top(expression.joined(*_expressed(spark, d)), 5).select("gene", "count")
