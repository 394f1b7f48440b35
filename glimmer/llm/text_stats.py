"""Statistics of texts as Spark column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glimmer.llm._common import SPACES, documents

_GAP = r"[\x20\x09-\x0D]+"
_SYMBOLS = "[#*$%&|<>]"

#: Columns that :func:`with_stats` adds.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_marks", "n_bars"]


def with_stats(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, ``keep`` and the counts of ``COUNTS`` (long) of ``docs`` (``doc_id, text``; text not null).

    Words are runs of characters other than ASCII white space; lines are what line feeds part. Empty text: all 0.
    Each step below is a projection of its own, so Spark computes the arrays once per row.
    """
    gap = F.btrim("text", F.lit(SPACES))
    words = docs.select("doc_id", *keep, F.col("text").alias("_text"), F.when(gap == "", F.array().cast("array<string>")).otherwise(F.split(gap, _GAP)).alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    n = F.size("_words")
    windows = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))),
    )
    counted = words.select(
        "doc_id",
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct_words"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        _times_in("_text", "!").alias("n_marks"),
        _times_in("_text", "|").alias("n_bars"),
        lines.alias("_lines"),
        windows.alias("_windows"),
    )
    counts = [c for c in COUNTS if c not in ("n_lines", "n_dup_lines", "n_repeat_words")]
    sized = counted.select(
        "doc_id",
        *keep,
        *counts,
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "_windows",
        (F.size("_windows") > F.size(F.array_distinct("_windows"))).alias("_twice"),
    )
    at = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    paired = sized.select("doc_id", *keep, *counts, "n_lines", "n_dup_lines", F.when(F.col("_twice"), at).alias("_at"))
    same = lambda x, k: F.coalesce(x["h"] == F.get("_at", k)["h"], F.lit(False))
    found = F.filter(F.transform("_at", lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"])), lambda i: i.isNotNull())
    marked = paired.select("doc_id", *keep, *counts, "n_lines", "n_dup_lines", F.sort_array(found).alias("_from"))
    covered = F.aggregate(
        F.transform("_from", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_from", k + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    return marked.select("doc_id", *keep, *counts, "n_lines", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).select("doc_id", *keep, *COUNTS)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, th`` of ``df``: the id with a hash of the text finds a row again."""
    return documents(df, id_col, text_col).withColumn("th", F.xxhash64("text"))


def only(df: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` whose id and text are those of a row of ``chosen`` (``doc_id, th``), all columns as they were."""
    wanted = chosen.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).distinct()
    rows = df.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"))
    kept = rows.join(wanted, rows["id"].eqNullSafe(wanted["_doc"]) & (rows["hash"] == wanted["_th"]), "left_semi")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in df.columns])


def _times_in(text: str, mark: str) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit(mark), F.lit("")))).cast("long")


def ratios() -> dict[str, Column]:
    """Size-free statistics from the counts; 0 where there is nothing to divide by."""
    over = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "word_length": over("word_chars", "n_words"),
        "symbols": over("n_symbols", "n_words"),
        "repeats": over("n_repeat_words", "n_words"),
        "dup_lines": over("n_dup_lines", "n_lines"),
        "distinct": over("n_distinct_words", "n_words"),
        "upper": over("n_upper", "word_chars"),
        "marks": over("n_marks", "n_words"),
        "bars": over("n_bars", "n_words"),
        "line_words": over("n_words", "n_lines"),
        "other_symbols": F.coalesce(F.try_divide((F.col("n_symbols") - F.col("n_bars")).cast("double"), F.col("n_words").cast("double")), F.lit(0.0)),
        "shouting": F.greatest(over("n_upper", "word_chars"), over("n_marks", "n_words")),
    }
