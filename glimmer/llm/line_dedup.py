"""Removal of repeated runs of lines over a corpus."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmer.llm._common import SPACES, ordered, running_sum, stage, table


def line_ids(docs: DataFrame) -> DataFrame:
    """``doc_id, th, k, line, h1, h2, chars`` of every line that is not blank: ``k`` counts them from 0, ``line`` counts
    all lines; two 64-bit hashes stand for the text of the line, without surrounding white space.

    ``th`` is a hash of the text: with it, rows that repeat an id are told apart unless the text repeats too.
    """
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.btrim(x, F.lit(SPACES)).alias("l"), i.alias("line")))
    split = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.filter(lines, lambda x: x["l"] != "")).alias("k", "x"))
    return split.select("doc_id", "th", "k", "x.line", F.xxhash64("x.l").alias("h1"), F.xxhash64("x.l", F.lit(1)).alias("h2"), F.length("x.l").alias("chars"))


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The rows of ``lines`` (staged) whose line occurs more than once."""
    often = stage(lines.groupBy("h1", "h2").count().filter("count > 1"))
    return named(lines, often, ["h1", "h2"]).drop("count").dropDuplicates(["doc_id", "th", "line"])


def named(rows: DataFrame, names: DataFrame, keys: list[str], hot: int = 1000) -> DataFrame:
    """``rows`` joined with ``names`` (both staged; one row a key, with its ``count`` among ``rows``) on ``keys``.

    Keys with at least one in ``hot`` of all counted rows, so no more than ``hot`` keys, are broadcast; a line that a third
    of all documents have does not meet in one task.
    """
    total = names.agg(F.sum("count")).first()[0] or 0
    often = F.broadcast(names.filter(F.col("count") * hot >= total))
    seldom = rows.join(F.broadcast(often.select(*keys)), keys, "left_anti").join(names.filter(F.col("count") * hot < total), keys)
    return rows.join(often, keys).unionByName(seldom)


def placed(repeats: DataFrame) -> DataFrame:
    """``repeats`` with places ``p``: these run over all documents in ascending order of ``doc_id``, a place
    left free between documents, so that no run goes from one into the next."""
    spans = repeats.groupBy("doc_id", "th").agg((F.max("k") + 2).alias("span"))
    docs = running_sum(ordered(spans, ["doc_id", "th"]), ["doc_id", "th"], F.col("span"), "base").select("doc_id", "th", "base")
    same = repeats["doc_id"].eqNullSafe(docs["doc_id"]) & (repeats["th"] == docs["th"])
    return repeats.join(docs, same).select(repeats["doc_id"], repeats["th"], "line", "h1", "h2", "chars", (F.col("base") + F.col("k")).alias("p"))


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``p, r`` of ``rows`` (staged: ``p`` and ``keys``) whose keys occur more than once: ``r`` is the number of rows before
    theirs in the order of ``keys``, so rows with one rank are an interval of that order."""
    groups = rows.groupBy(*keys).count().filter("count > 1")
    ranks = running_sum(ordered(groups, keys), keys, F.col("count"), "rank").select(*keys, "count", "rank")
    return named(rows, stage(ranks), keys).select("p", F.col("rank").alias("r"))


def suffix_ranks(places: DataFrame, most_lines: int) -> list[DataFrame]:
    """For each k up to the logarithm of ``most_lines`` a table ``p, r``: suffixes of the line sequence ranked by their first
    ``2 ** k`` lines, without those that no other equals so far.

    Prefix doubling: the pair of ranks at ``p`` and ``p + 2 ** k`` is ranked anew. Suffixes of one rank are an interval of
    the suffix array whose longest common prefix has at least ``2 ** k`` lines; a suffix alone in its interval leaves. The
    rounds end when none is left, or the longest prefix that is asked for is covered.
    """
    tables, span = [stage(ranked(places, ["h1", "h2"]))], 1
    while 2 * span <= most_lines and not tables[-1].isEmpty():
        follow = tables[-1].select((F.col("p") - span).alias("p"), F.col("r").alias("r2"))
        tables.append(stage(ranked(stage(tables[-1].join(follow, "p")), ["r", "r2"])))
        span *= 2
    return tables


def least_runs(places: DataFrame, least_chars: int) -> DataFrame:
    """``p, n``: of the runs of ``n`` lines with at least ``least_chars`` characters the shortest from each first line, and the
    shortest to each last line.

    A line of a longer run is in one of these within the run: in the one from it, the one to it, or, if the run has too
    few characters on either side, the one from the run's first line. So they cover what maximal repeated runs cover.
    """
    whole = Window.partitionBy("doc_id", "th").orderBy("p")
    parts = places.withColumn("part", F.col("p") - F.row_number().over(whole))
    part = ["doc_id", "th", "part"]
    summed = parts.withColumn("to", F.sum("chars").over(Window.partitionBy(*part).orderBy("p"))).withColumn("from", F.col("to") - F.col("chars"))
    all_of = Window.partitionBy(*part)
    summed = summed.withColumns({"total": F.max("to").over(all_of), "first": F.min("p").over(all_of), "last": F.max("p").over(all_of)})
    after = F.min("p").over(all_of.orderBy("from").rangeBetween(least_chars, Window.unboundedFollowing))
    stop = F.coalesce(after, F.when(F.col("total") - F.col("from") >= least_chars, F.col("last") + 1))
    before = F.max("p").over(all_of.orderBy("to").rangeBetween(Window.unboundedPreceding, -least_chars))
    start = F.coalesce(before + 1, F.when(F.col("to") >= least_chars, F.col("first")))
    both = summed.select("p", stop.alias("stop"), start.alias("start"))
    ahead = both.select("p", (F.col("stop") - F.col("p")).alias("n"))
    return ahead.unionByName(both.select(F.col("start").alias("p"), (F.col("p") + 1 - F.col("start")).alias("n"))).dropna().distinct()


def repeated_runs(places: DataFrame, least_chars: int = 40) -> DataFrame:
    """``p, stop``: lines from place ``p`` up to before ``stop`` repeat a run that starts at an earlier place.

    Only runs of at least ``least_chars`` characters in all count, so short lines that chance repeats stay. Suffixes that
    share their first ``n`` lines are an interval of the suffix array (longest common prefix of ``n`` lines or more); it is
    named by the ranks of the first and of the last ``2 ** k`` of these lines, which overlap. Within each such interval the
    smallest place has the first copy, the others later ones. See :func:`least_runs` for the ``n`` that are asked for.
    """
    runs = stage(least_runs(places, least_chars))
    most = runs.agg(F.max("n")).first()[0] or 0
    found = None
    for k, ranks in enumerate(suffix_ranks(places, most)):
        own = runs.filter((F.col("n") >= 1 << k) & (F.col("n") < 2 << k))
        last = ranks.select((F.col("p") + (1 << k)).alias("stop"), F.col("r").alias("r2"))
        pairs = own.withColumn("stop", F.col("p") + F.col("n")).join(ranks, "p").join(last, "stop").select("p", "n", "stop", "r", "r2")
        found = pairs if found is None else found.unionByName(pairs)
    found, keys = stage(found), ["n", "r", "r2"]
    first = stage(found.groupBy(*keys).agg(F.min("p").alias("first"), F.count("*").alias("count")).filter("count > 1"))
    return named(found, first, keys).filter("p > first").select("p", "stop")


def dedup_lines(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40) -> DataFrame:
    """All columns of ``df``, the text without its repeated line runs, and ``n_lines``, ``n_removed`` (long).

    In ascending order of id (null first) and line, the first copy of a run of lines stays and later ones go (see
    :func:`repeated_runs`). Lines are compared without surrounding white space; blank lines belong to no run and are
    never removed. What is left keeps its order and bytes.

    Null text stays null with 0 lines. Rows with the same id and text count as one document: each keeps the lines
    that one copy keeps. Rows with the same id and other text are ordered by a hash of the text. An empty table gives
    an empty result. Columns of ``df`` named ``n_lines`` or ``n_removed`` are replaced; others stay, whatever their names.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).dropna(subset=["text"])
    places = stage(placed(repeated_lines(stage(line_ids(docs)))))
    runs = repeated_runs(places, least_chars).groupBy("p").agg(F.max("stop").alias("stop"))
    so_far = Window.partitionBy("doc_id", "th").orderBy("line")
    covered = places.join(runs, "p", "left").withColumn("reach", F.max("stop").over(so_far)).filter("reach > p")
    gone = covered.groupBy(F.col("doc_id").alias("doc"), "th").agg(F.collect_list("line").alias("gone"))
    others = [c for c in df.columns if c not in (text_col, "n_lines", "n_removed")]
    row = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)])
    rows = df.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))
    joined = rows.join(gone, rows["id"].eqNullSafe(gone["doc"]) & (rows["hash"] == gone["th"]), "left")
    lines = F.split("text", "\n")
    ends = F.when(F.col("gone").isNotNull(), F.concat(F.array(F.lit(-1)), F.sort_array("gone"), F.array(F.size(lines))))
    cut = joined.select("row", "text", F.size("gone").alias("n"), lines.alias("lines"), ends.alias("ends"))
    gaps = F.transform("ends", lambda x, i: F.struct((x + 2).alias("at"), (F.get("ends", i + 1) - x - 1).alias("n")))
    parts = F.transform(F.filter(gaps, lambda g: g["n"] > 0), lambda g: F.slice("lines", g["at"], g["n"]))
    left = F.coalesce(F.array_join(F.flatten(parts), "\n"), F.col("text"))
    return cut.select(
        *[(left if c == text_col else F.col(f"row.c{others.index(c)}")).alias(c) for c in df.columns if c not in ("n_lines", "n_removed")],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


QUERIES = {"op2_line_dedup": op2_line_dedup}
