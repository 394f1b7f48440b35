"""Imaging tables derived from the driver's star-schema tables, in Spark and as SQL text for the oracle."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.functions.codebook import OMICS_SPECIAL, STANDARD_3COLOR, STANDARD_4COLOR, Segment, assembled, compile_codebook
from glimmer.operators.decode import numbered

KEYS = ["ok", "pk", "sk", "ln"]
FOUR = STANDARD_4COLOR
SEGMENTS = [Segment("a", (0, 1, 2, 3), 1, 5, FOUR, ("C", "G"))]
ORDER = ["a"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spots_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ok, pk, sk, ln, fov, v`` (4 rounds of 4 channels) of each distinct line item."""
    li = read(spark, sf_dir, "lineitem")
    keys = li.select(F.col("l_orderkey").alias("ok"), F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"), F.col("l_linenumber").alias("ln")).distinct()
    cell = lambda r, c: ((F.col("ok") * (r * 4 + c + 3) * 7 + F.col("pk") * (c + 2) * 13 + F.col("sk") * 31 * (r + 1)) % 101).cast("double")
    return keys.select(*KEYS, (F.col("sk") % 8).alias("fov"), F.array(*[F.array(*[cell(r, c) for c in range(4)]) for r in range(4)]).alias("v"))


def genes_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``code_ix, gene, seq``: C and four bases from the part's key."""
    part = read(spark, sf_dir, "part")
    base = lambda i: F.substring(F.lit("ACGT"), (F.floor(F.col("p_partkey") % 128 / 4**i) % 4 + 1).cast("int"), F.lit(1))
    return numbered(part.select("p_partkey", F.col("p_name").alias("gene"), F.concat(F.lit("C"), *[base(i) for i in range(4)]).alias("seq")), "p_partkey").select("code_ix", "gene", "seq", "p_partkey")


def codebook_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compile_codebook(genes_part(spark, sf_dir), SEGMENTS, ORDER)


TYPES = ["click", "purchase", "refund", "signup", "view"]


def grid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fov, round, channel, z, y, x, v``: events counted by type, hour and day; each 2500 of them in turn are a FOV."""
    e = read(spark, sf_dir, "events")
    channel = F.when(F.lit(False), 0)
    for k, t in enumerate(TYPES):
        channel = channel.when(F.col("event_type") == t, k)
    cells = e.select(F.floor(F.col("event_id") / 2500).cast("int").alias("fov"), (1 + F.col("user_id") % 3).cast("int").alias("round"), F.coalesce(channel, F.lit(len(TYPES))).alias("channel"), (F.col("user_id") % 4).cast("int").alias("z"), F.hour("ts").alias("y"), (F.dayofmonth("ts") - 1).alias("x"))
    return cells.groupBy(*cells.columns).agg(F.count("*").cast("double").alias("v"))


def volume_li(spark: SparkSession, sf_dir: str, fovs: int = 1) -> DataFrame:
    """``fov, round, channel, z, y, x, v``: line items counted on a 7 x 50 x 64 grid, 20 a row up to 255."""
    li = read(spark, sf_dir, "lineitem")
    cells = li.select(
        (F.col("l_suppkey") % fovs).cast("int").alias("fov"), F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("round"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("channel"),
        (F.col("l_linenumber") - 1).cast("int").alias("z"), (F.col("l_quantity") - 1).cast("int").alias("y"), (F.col("l_partkey") % 64).cast("int").alias("x"),
    )
    return cells.groupBy(*cells.columns).agg(F.least(F.count("*") * 20, F.lit(255)).cast("double").alias("v"))


def moved_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fov, round, z, y, x, v``: line items counted in 8 FOVs on a 7 x 50 x 64 grid in round 1; in round 2 those of three quarters
    of the orders are moved by a shift of the FOV's own (what leaves the grid is lost), the others lie elsewhere."""
    li = read(spark, sf_dir, "lineitem")
    f, own = F.col("fov"), F.col("l_orderkey") % 4 != 0
    at = li.select((F.col("l_suppkey") % 8).cast("int").alias("fov"), "l_orderkey", *[c.cast("int").alias(n) for n, c in (("z", F.col("l_linenumber") - 1), ("y", F.col("l_quantity") - 1), ("x", F.col("l_partkey") % 64))])
    place = {"z": (F.col("z") + f % 3 - 1, F.col("z")), "y": (F.col("y") + 9 + f, (F.col("y") * 7 + 3) % 50), "x": (F.col("x") - 11 - 2 * f, (F.col("x") * 5 + 1) % 64)}
    second = at.select("fov", F.lit(2).alias("round"), *[F.when(own, a).otherwise(b).alias(c) for c, (a, b) in place.items()])
    both = at.select("fov", F.lit(1).alias("round"), "z", "y", "x").unionByName(second.filter("z between 0 and 6 and y between 0 and 49 and x between 0 and 63"))
    return both.groupBy("fov", "round", "z", "y", "x").agg(F.count("*").cast("double").alias("v"))


#: Eleven rounds in three segments, in another order than in the reversed sequence, with two tables; the last has no end base.
LONG_SEGMENTS = [
    Segment("F", (5, 6, 7, 8, 9), 1, 6, STANDARD_3COLOR, ("A", "A")),
    Segment("D", (0, 1, 2, 3, 4), 7, 12, STANDARD_3COLOR, ("G", "A")),
    Segment("E", (10,), 13, 14, OMICS_SPECIAL, ("G",)),
]
LONG_ORDER = ["D", "F", "E"]


def long_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``code_ix, gene, seq``: 14 bases from the part's key; each fifth sequence ends its first segment in another base, and each
    eleventh is too short."""
    base = lambda i: F.substring(F.lit("AGT"), (F.floor(F.col("p_partkey") / 3**i) % 3 + 1).cast("int"), F.lit(1))
    last = F.when(F.col("p_partkey") % 5 == 0, base(2)).otherwise("A")
    seq = F.concat(F.lit("A"), *[base(i) for i in range(4)], last, F.lit("G"), *[base(i) for i in range(4, 8)], F.lit("AG"), F.when(F.col("p_partkey") % 2 == 0, "C").otherwise("T"))
    seq = F.when(F.col("p_partkey") % 11 == 0, F.substring(seq, 1, 13)).otherwise(seq)
    return numbered(read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("gene"), F.reverse(seq).alias("seq")), "p_partkey").select("code_ix", "gene", "seq")


#: Four rounds in two segments of three bases.
PAIR_SEGMENTS = [Segment("a", (0, 1), 1, 3, FOUR, ("C",)), Segment("b", (2, 3), 4, 6, FOUR, ("G",))]
PAIR_ORDER = ["a", "b"]
STACK = {"z": 7, "y": 128, "x": 128}


def pair_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``code_ix, p_partkey, gene, seq``: two segments from the part's key."""
    base = lambda i: F.substring(F.lit("ACGT"), (F.floor(F.col("p_partkey") % 256 / 4**i) % 4 + 1).cast("int"), F.lit(1))
    rows = read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("gene"), F.concat(F.lit("C"), base(0), base(1), F.lit("G"), base(2), base(3)).alias("seq"))
    return numbered(rows, "p_partkey").select("code_ix", "p_partkey", "gene", "seq")


def stack_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fov, round, channel, z, y, x, v``: bytes of four rounds on a 7 x 128 x 128 grid. A line item is a spot; in each round it
    shines in the channel of its part's colour, moved by the round's shift (round 1 is not moved; what leaves is lost)."""
    codes = pair_genes(spark, sf_dir).select(F.col("p_partkey").alias("l_partkey"), assembled(F.col("seq"), PAIR_SEGMENTS, PAIR_ORDER).alias("code"))
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    spots = read(spark, sf_dir, "lineitem").join(codes, "l_partkey").select((sk % 4).cast("int").alias("fov"), "code", (60 + 15 * (ok % 7)).alias("light"), (F.col("l_linenumber") - 1).alias("z"), ((ok * 37 + pk * 11) % 128).alias("y"), ((pk * 53 + sk * 7 + ok) % 128).alias("x"))
    f, r = F.col("fov"), F.col("round")
    moved = {"z": F.when(r > 1, (r + f) % 3 - 1).otherwise(0), "y": F.when(r > 1, 3 * r - f).otherwise(0), "x": F.when(r > 1, f - 4 * r).otherwise(0)}
    lit = spots.withColumn("round", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3, 4)])))
    lit = lit.select("fov", "round", F.substring("code", r, F.lit(1)).cast("int").alias("channel"), *[(F.col(c) + d).cast("int").alias(c) for c, d in moved.items()], "light")
    inside = lit.filter(" and ".join(f"{c} between 0 and {n - 1}" for c, n in STACK.items()))
    return inside.groupBy("fov", "round", "channel", "z", "y", "x").agg(F.least(F.sum("light"), F.lit(255)).cast("double").alias("v"))


# ---- the same as SQL: a query is "WITH " + the CTEs it needs + its own text
_CASES = " ".join(f"WHEN event_type = '{t}' THEN {k}" for k, t in enumerate(TYPES))
LI = """li AS (SELECT DISTINCT l_orderkey ok, l_partkey pk, l_suppkey sk, l_linenumber ln FROM lineitem),
iv AS (SELECT ok, pk, sk, ln, sk % 8 AS fov, r, c, CAST((ok*(r*4+c+3)*7 + pk*(c+2)*13 + sk*31*(r+1)) % 101 AS DOUBLE) v FROM li, range(4) t(r), range(4) u(c))"""
NORMAL = LI + """, nv AS (SELECT *, v / (sqrt(sum(v*v) OVER (PARTITION BY ok, pk, sk, ln, r)) + 1e-6) n FROM iv)"""
CALLS = """mx AS (SELECT *, max(n) OVER (PARTITION BY ok, pk, sk, ln, r) m FROM nv),
rd AS (SELECT ok, pk, sk, ln, fov, r, count(*) FILTER (n = m) k, min(c) FILTER (n = m) c0, max(m) m, max(v) mv, max(m) - coalesce(max(n) FILTER (n < m), CASE WHEN count(*) FILTER (n = m) > 1 THEN max(m) ELSE 0 END) gap0,
  list_sort(list(n), 'DESC') ns FROM mx GROUP BY ALL),
rs AS (SELECT *, CASE WHEN k = 1 THEN c0 ELSE -1 END call, CASE WHEN k = 1 AND m > 0 THEN -ln(m) END score, ns[1] - ns[2] margin FROM rd),
sp AS (SELECT ok, pk, sk, ln, fov, count(score) = 4 AS valid, CASE WHEN count(score) = 4 THEN avg(score) END quality, avg(margin) margin, string_agg(CAST(call AS VARCHAR), '' ORDER BY r) barcode, max(mv) intensity FROM rs GROUP BY ALL)"""
SPOTS = NORMAL + ", " + CALLS
_PAIRS = ", ".join(f"('{k}', {v})" for k, v in FOUR.items())
GENES = f"""enc(key, colour) AS (VALUES {_PAIRS}),
genes AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 code_ix, p_partkey, p_name gene, 'C' || string_agg(substr('ACGT', CAST(((p_partkey % 128) // CAST(pow(4, i) AS BIGINT)) % 4 + 1 AS INT), 1), '' ORDER BY i) seq FROM part, range(4) t(i) GROUP BY p_partkey, p_name),
coded AS (SELECT code_ix, gene, string_agg(coalesce(CAST(colour - 1 AS VARCHAR), '.'), '' ORDER BY i) barcode FROM genes, range(1, 5) t(i) LEFT JOIN enc ON key = substr(seq, CAST(i AS INT), 2) GROUP BY code_ix, gene),
book AS (SELECT min(code_ix) code_ix, barcode, max_by(gene, code_ix) gene FROM coded GROUP BY barcode)"""
DECODED = SPOTS + ", " + GENES + """, dec AS (SELECT sp.*, coalesce(book.gene, 'background') gene FROM sp LEFT JOIN book USING (barcode) WHERE valid AND quality < 0.5)"""
GRID = f"""grid AS (SELECT CAST(event_id // 2500 AS INT) fov, CAST(1 + user_id % 3 AS INT) AS round, CASE {_CASES} ELSE {len(TYPES)} END channel, CAST(user_id % 4 AS INT) z, CAST(hour(ts) AS INT) y, CAST(day(ts) - 1 AS INT) x, CAST(count(*) AS DOUBLE) v FROM events GROUP BY ALL)"""


_AT = "SELECT CAST(l_suppkey % 8 AS INT) fov, l_orderkey ok, CAST(l_linenumber - 1 AS INT) z, CAST(l_quantity - 1 AS INT) y, CAST(l_partkey % 64 AS INT) x FROM lineitem"
MOVED = f"""pos AS ({_AT}), bo AS (SELECT fov, 1 AS round, z, y, x FROM pos UNION ALL SELECT fov, 2, CASE WHEN ok % 4 <> 0 THEN z + fov % 3 - 1 ELSE z END, CASE WHEN ok % 4 <> 0 THEN y + 9 + fov ELSE (y * 7 + 3) % 50 END, CASE WHEN ok % 4 <> 0 THEN x - 11 - 2 * fov ELSE (x * 5 + 1) % 64 END FROM pos),
mv AS (SELECT fov, CAST(round AS INT) AS round, CAST(z AS INT) z, CAST(y AS INT) y, CAST(x AS INT) x, CAST(count(*) AS DOUBLE) v FROM bo WHERE z BETWEEN 0 AND 6 AND y BETWEEN 0 AND 49 AND x BETWEEN 0 AND 63 GROUP BY ALL)"""


def volume_sql(fovs: int = 1) -> str:
    return f"""vol AS (SELECT CAST(l_suppkey % {fovs} AS INT) fov, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS round, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END channel, CAST(l_linenumber - 1 AS INT) z, CAST(l_quantity - 1 AS INT) y, CAST(l_partkey % 64 AS INT) x, CAST(least(count(*) * 20, 255) AS DOUBLE) v FROM lineitem GROUP BY ALL)"""


def _map(table: dict[str, int]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v - 1}'" for k, v in table.items()) + "}"


_BASE = lambda alphabet, modulo, i, n: f"substr('{alphabet}', CAST(({modulo} // {n**i}) % {n} + 1 AS INT), 1)"
LONG = f"""ls AS (SELECT code_ix, p_name gene, 'A' || {' || '.join(_BASE('AGT', 'p_partkey', i, 3) for i in range(4))} || CASE WHEN p_partkey % 5 = 0 THEN {_BASE('AGT', 'p_partkey', 2, 3)} ELSE 'A' END || 'G' || {' || '.join(_BASE('AGT', 'p_partkey', i, 3) for i in range(4, 8))} || 'AG' || CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'T' END s, p_partkey % 11 <> 0 AND substr(s, 6, 1) = 'A' good FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 code_ix FROM part) WHERE p_partkey % 11 <> 0),
lb AS (SELECT code_ix, gene, good, list_aggregate([{_map(STANDARD_3COLOR)}[substr(s, i, 2)] FOR i IN [7, 8, 9, 10, 11, 1, 2, 3, 4, 5]], 'string_agg', '') || {_map(OMICS_SPECIAL)}[substr(s, 13, 2)] barcode FROM ls)"""
_PAIR = f"""pg AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 code_ix, p_partkey, p_name gene, 'C' || {_BASE('ACGT', '(p_partkey % 256)', 0, 4)} || {_BASE('ACGT', '(p_partkey % 256)', 1, 4)} || 'G' || {_BASE('ACGT', '(p_partkey % 256)', 2, 4)} || {_BASE('ACGT', '(p_partkey % 256)', 3, 4)} s FROM part),
pc AS (SELECT code_ix, p_partkey, gene, list_aggregate([{_map(FOUR)}[substr(s, i, 2)] FOR i IN [1, 2, 4, 5]], 'string_agg', '') code FROM pg)"""
STACK_SQL = f"""{_PAIR}, sl AS (SELECT CAST(l_suppkey % 4 AS INT) fov, code, 60 + 15 * (l_orderkey % 7) light, l_linenumber - 1 z, (l_orderkey * 37 + l_partkey * 11) % 128 y, (l_partkey * 53 + l_suppkey * 7 + l_orderkey) % 128 x FROM lineitem JOIN pc ON p_partkey = l_partkey),
sr AS (SELECT fov, CAST(r AS INT) AS round, CAST(substr(code, CAST(r AS INT), 1) AS INT) channel, z + CASE WHEN r > 1 THEN (r + fov) % 3 - 1 ELSE 0 END z, y + CASE WHEN r > 1 THEN 3 * r - fov ELSE 0 END y, x + CASE WHEN r > 1 THEN fov - 4 * r ELSE 0 END x, light FROM sl CROSS JOIN range(1, 5) t(r)),
sv AS (SELECT fov, round, channel, CAST(z AS INT) z, CAST(y AS INT) y, CAST(x AS INT) x, CAST(least(sum(light), 255) AS DOUBLE) v FROM sr WHERE z BETWEEN 0 AND 6 AND y BETWEEN 0 AND 127 AND x BETWEEN 0 AND 127 GROUP BY ALL)"""
