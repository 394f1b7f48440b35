"""Packing of tokenized documents into sequences of one length."""

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmer.llm._common import documents, stage, table
from glimmer.llm._tokenize import encoder, slices

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(df: DataFrame, tokenizer: str, *, length: int = 1024, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian 32-bit, if ``keep_ids``) of the pieces of
    all texts. A document of at most ``length`` ids, with its end id, is one piece. A longer one is cut so that all
    pieces but the first are full.

    Null text is empty: the end id alone (no piece if there is no end id). Null ids and repeated rows are pieces of
    their own. Other columns are ignored.
    """

    def cut(batches):
        enc, end = encoder(tokenizer), b"" if end_id is None else end_id.to_bytes(4, "little")
        for part, texts in slices(batches):
            rows = []
            for doc, ids in zip(part.column("doc_id").to_pylist(), enc.ids(texts), strict=True):
                ids += end
                n, at, k = len(ids) // 4, 0, 0
                while at < n:
                    stop = min(n, at + ((n % length or length) if k == 0 else length))
                    data = ids[4 * at : 4 * stop]
                    rows.append((doc, k, at, stop - at, zlib.crc32(data), *[data] * keep_ids))
                    at, k = stop, k + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * keep_ids]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return documents(df, id_col, text_col).mapInArrow(cut, _PIECES + ", ids binary" * keep_ids)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """The lengths, at most ``counts[x]`` of each x, whose sum is the largest up to ``room``.

    Bit s of ``reached`` is set when some of the lengths seen so far, the longest first, add up to s. The search stops
    as soon as ``room`` is reached; the sets after each length lead back to the lengths.
    """
    reached, seen, within = 1, [], (1 << room + 1) - 1
    for x in sorted((x for x, n in counts.items() if n > 0 and x <= room), reverse=True):
        for _ in range(min(counts[x], room // x)):
            more = (reached | reached << x) & within
            if more == reached:
                break
            seen.append((x, reached))
            reached = more
        if reached >> room & 1:
            break
    left, chosen = reached.bit_length() - 1, []
    for x, before in reversed(seen):
        if not before >> left & 1:
            chosen.append(x)
            left -= x
    return chosen


def patterns(counts: dict[int, int], length: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins): minimum bin slack with the longest piece left as each bin's first.

    The fullest bin that has the longest piece left is taken as often as the counts allow before the next is sought,
    so the work depends on the number of distinct lengths (at most ``length``), not on the number of pieces.
    """
    counts, bins = {x: n for x, n in counts.items() if n > 0}, []
    while counts:
        first = max(counts)
        counts[first] -= 1
        chosen = [first, *fullest(counts, length - first)]
        counts[first] += 1
        of = {x: chosen.count(x) for x in chosen}
        times = min(counts[x] // k for x, k in of.items())
        bins.append((sorted(chosen, reverse=True), times))
        for x, k in of.items():
            counts[x] -= k * times
            if not counts[x]:
                del counts[x]
    return bins


def pack(pieces: DataFrame, *, length: int = 1024) -> DataFrame:
    """``pieces`` (staged or cheap to read twice; column ``length`` from 1 to ``length``) with ``sequence_id`` and ``offset``.

    Pieces of one length are interchangeable, so only the histogram of lengths, at most ``length`` rows however many
    pieces there are, comes to the driver, which plans bins by minimum bin slack. Pieces are numbered within their
    length, by input range first, so that no window holds all pieces of a common length; a piece's number then says
    which bin of which pattern it fills. An empty table gives an empty result.
    """
    found = pieces.groupBy("length").count().collect()
    slots, base = [], 0
    used: dict[int, int] = {}
    for chosen, times in patterns({r["length"]: r["count"] for r in found}, length):
        offsets, at = {}, 0
        for x in chosen:
            offsets.setdefault(x, []).append(at)
            at += x
        for x, places in offsets.items():
            slots.append((x, used.get(x, 0), used.get(x, 0) + times * len(places), base, places))
            used[x] = slots[-1][2]
        base += times
    spark = pieces.sparkSession
    plan = spark.createDataFrame(slots, "length long, _from long, _to long, _base long, _places array<long>")
    counts = pieces.groupBy("length", "range_no").count()
    before = Window.partitionBy("length").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "range_no", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy("length", "range_no").orderBy("doc_id", "piece")
    numbered = pieces.withColumn("_rank", F.row_number().over(own) - 1).join(firsts, ["length", "range_no"])
    rank = F.col("_rank") + F.col("_first")
    placed = numbered.withColumn("_at", rank).join(F.broadcast(plan), "length").filter((F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to")))
    nth, per = F.col("_at") - F.col("_from"), F.size("_places")
    return (
        placed.withColumn("sequence_id", (F.col("_base") + F.floor(nth / per)).cast("long"))
        .withColumn("offset", F.get("_places", (nth % per).cast("int")))
        .drop("_rank", "_first", "_at", "_from", "_to", "_base", "_places", "range_no")
    )


def pack_documents(df: DataFrame, tokenizer: str, *, length: int = 1024, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all texts (see :func:`cut_pieces`) with their ``sequence_id`` and ``offset`` (see :func:`pack`)."""
    pieces = cut_pieces(df, tokenizer, length=length, end_id=end_id, id_col=id_col, text_col=text_col, keep_ids=keep_ids)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids, "sequence_id", "offset"]
    return pack(stage(pieces.withColumn("range_no", F.spark_partition_id())), length=length).select(*names)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
