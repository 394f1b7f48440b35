"""Canonical exact fingerprints of texts."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmer.llm._common import documents, ordered, stage, table


def canonical(text: Column) -> Column:
    """``text`` in Unicode form NFC, case-folded, with runs of white space as one space and none at the ends.

    ASCII texts need only lower case. Others go through ICU's static methods, which Spark ships and SQL's ``reflect``
    calls: no Python is involved. Case folding can undo the normal form, so it is restored after it.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    name = "com.ibm.icu.text.Normalizer"
    compose = lambda x: F.reflect(F.lit(name), F.lit("compose"), x, F.lit(False))
    folded = compose(F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(text), F.lit(True)))
    spaces = r"[\s\x1c-\x1f\x85\xa0  -     　]+"
    return F.btrim(F.regexp_replace(F.when(ascii_only, F.lower(text)).otherwise(folded), spaces, " "))


def wide_hash(text: Column) -> Column:
    """128 bits of ``text`` as 32 hex digits: two 64-bit xxhash values with different seeds."""
    part = lambda *x: F.lower(F.lpad(F.hex(F.xxhash64(*x)), 16, "0"))
    return F.concat(part(F.lit(1), text), part(text, F.lit(2)))


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = 1_000_000) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row of ``df``.

    The fingerprint is :func:`wide_hash` of the :func:`canonical` text. Rows with one hash form a bucket. The texts of
    buckets with several rows are read again and compared byte by byte: a bucket is sound if the smallest and the largest
    canonical text in it are the same, which needs one text per bucket and task, however many copies there are. In a
    bucket that is not, each fingerprint gets a SHA-256 suffix. So fingerprints are equal exactly if canonical texts are.
    The hashes of such buckets are broadcast if there are at most ``most_broadcast``, and joined by a shuffle otherwise.

    Null text counts as empty. A null id stays null. Repeated rows are rows of their own. An empty table gives an empty
    result. Other columns are ignored.
    """
    return _fingerprints(documents(df, id_col, text_col), most_broadcast).drop("th")


def _fingerprints(docs: DataFrame, most_broadcast: int = 1_000_000) -> DataFrame:
    """``doc_id, th, n_chars, fingerprint`` of ``docs`` (``doc_id, text``); ``th``: a hash of the text as it is."""
    plain = docs.select("doc_id", F.xxhash64("text").alias("th"), F.length("text").cast("long").alias("n_chars"), canonical(F.col("text")).alias("_c"))
    hashed = plain.select("doc_id", "th", "n_chars", wide_hash(F.col("_c")).alias("fingerprint"), "_c")
    found = stage(hashed.drop("_c"))
    shared = stage(found.groupBy("fingerprint").count().filter("count > 1").select("fingerprint"))
    wanted = F.broadcast(shared) if shared.count() <= most_broadcast else shared
    ends = hashed.join(wanted, "fingerprint").groupBy("fingerprint").agg(F.min("_c").alias("low"), F.max("_c").alias("high"))
    unsound = stage(ends.filter("low <> high").select("fingerprint"))
    if unsound.isEmpty():
        return found
    mixed = hashed.join(unsound.withColumn("_mixed", F.lit(True)), "fingerprint", "left")
    suffix = F.when(F.col("_mixed"), F.concat(F.lit("-"), F.sha2("_c", 256))).otherwise("")
    return mixed.select("doc_id", "th", "n_chars", F.concat("fingerprint", suffix).alias("fingerprint"))


def next_in_order(found: DataFrame) -> DataFrame:
    """``found`` (one row a document: ``id, th`` and others) with ``next_id, next_th`` and ``next_fingerprint`` of the next one in
    ascending order of id and hash, the first after the last.

    Documents are dealt out by ranges; only the first row of each range is looked at by all.
    """
    ranges = ordered(found, ["id", "th"])
    row = F.struct("id", "th", "fingerprint")
    follow = Window.partitionBy("range_no").orderBy("id", "th")
    firsts = ranges.groupBy("range_no").agg(F.min(row).alias("_first"))
    over = Window.orderBy("range_no")
    edges = firsts.select("range_no", F.coalesce(F.lead("_first").over(over), F.min("_first").over(Window.partitionBy())).alias("_edge"))
    led = ranges.withColumn("_next", F.lead(row).over(follow)).join(F.broadcast(edges), "range_no")
    chosen = F.coalesce("_next", "_edge")
    return led.select(*found.columns, *[chosen[c].alias(f"next_{c}") for c in ("id", "th", "fingerprint")])


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of edited copies: the second half replaced by the start of the next document.

    Documents are in order of id (null first) and a hash of the text. Rows that repeat both are one document; each of them
    has its result. ``edited_fingerprint`` is the wide hash; texts that share one with another text by chance are told apart
    in ``fingerprint`` only.
    """
    lowest = F.lit(-(1 << 63))
    docs = documents(table(spark, sf_dir, "documents"))
    named = docs.select(F.coalesce("doc_id", lowest).alias("id"), F.xxhash64("text").alias("th"), "text").repartition("id", "th")
    rows = _fingerprints(docs).withColumn("id", F.coalesce("doc_id", lowest))
    ones = rows.groupBy("id", "th").agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.first("fingerprint").alias("fingerprint"), F.count("*").alias("n_rows"))
    order = stage(next_in_order(ones))
    texts = named if order.filter("n_rows > 1").isEmpty() else named.dropDuplicates(["id", "th"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    asked = order.select(F.col("next_id").alias("id"), F.col("next_th").alias("th"), F.col("id").alias("of"), F.col("th").alias("of_th"), half.alias("n"))
    heads = texts.join(asked, ["id", "th"]).select(F.col("of").alias("id"), F.col("of_th").alias("th"), F.substring("text", F.lit(1), F.col("n")).alias("head"))
    both = texts.join(order, ["id", "th"]).join(heads, ["id", "th"])
    edited = both.select("*", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), "head").alias("edited"))
    hashed = edited.select("*", wide_hash(canonical(F.col("edited"))).alias("edited_fingerprint"))
    like = lambda x: F.when(F.col("fingerprint") == F.col(x), 1.0).otherwise(0.0)
    out = hashed.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        like("edited_fingerprint").alias("near_edited"), like("next_fingerprint").alias("near_next"), "n_rows",
    )
    return out.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))).drop("_n", "n_rows")


QUERIES = {"op8_fingerprints": op8_fingerprints}
