"""Token ids in a content-addressed store: unique chunks, recipes of documents, Merkle manifests."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmer.llm._common import documents, ordered, running_sum, scratch, stage, table
from glimmer.llm._tokenize import encoder, slices

_STAGED = "doc_id long, n_tokens long, root binary, chunks array<struct<hash: binary, n: int, data: binary>>"
_ORDER = ["doc_id", "n_tokens", "root"]
#: Documents under one node of a range's tree.
_LEAVES = 1024
#: Fixed value: the reflected CRC-32 polynomial.
_POLYNOMIAL = 0xEDB88320


def write_store(
    df: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    smallest: int = 128,
    mask_bits: int = 9,
    largest: int = 4096,
) -> None:
    """Write the token ids of all texts of ``df`` under ``path``.

    ``chunks``: ``hash, n, data``, one row for each distinct chunk. A rolling hash of the last 16 ids cuts a
    document's stream where its low ``mask_bits`` bits are 0, between ``smallest`` and ``largest`` ids apart, so equal
    passages give equal chunks wherever they stand. ``data``: little-endian ids, 2 bytes each if the vocabulary fits.

    ``recipes``: ``doc_id, n_tokens, root, hashes, range_no`` in ascending order of ``doc_id`` (null first) over its
    part files; ``root`` is the Merkle root of the document's chunk hashes.

    ``manifest``: ``range_no, n_docs, n_tokens, root``; a range's root covers the roots of its documents in order.

    Null text is empty: its stream is the end id alone (nothing if ``end_id`` is None). Null ids and repeated rows
    are stored as documents of their own. An empty table gives empty tables.
    """
    width = 2 if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else 4

    def cut(batches):
        enc, end = encoder(tokenizer), b"" if end_id is None else np.uint32(end_id).tobytes()
        for part, texts in slices(batches):
            yield _chunked(part.column("doc_id"), [b + end for b in enc.ids(texts)], width, smallest, mask_bits, largest)

    staged = stage(documents(df, id_col, text_col).mapInArrow(cut, _STAGED))
    chunks = staged.select(F.explode("chunks").alias("c")).select("c.hash", "c.n", "c.data").dropDuplicates(["hash"])
    chunks.write.option("compression", "zstd").parquet(f"{path}/chunks")
    recipes = staged.select("doc_id", "n_tokens", "root", F.col("chunks.hash").alias("hashes"))
    _manifest(_recipes_sorted(recipes, f"{path}/recipes")).write.parquet(f"{path}/manifest")


def _recipes_sorted(recipes: DataFrame, path: str) -> DataFrame:
    return ordered(recipes, _ORDER, path)


def _manifest(recipes: DataFrame) -> DataFrame:
    place = Window.partitionBy("range_no").orderBy(*[F.col(k).asc_nulls_first() for k in _ORDER])
    leaves = recipes.select("range_no", "n_tokens", "root", (F.row_number().over(place) - 1).alias("at"))
    node = lambda at, of: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, of))), lambda x: x[of]), ""), 256)
    nodes = leaves.select("range_no", "n_tokens", F.hex("root").alias("leaf"), "at", F.floor(F.col("at") / _LEAVES).alias("block"))
    blocks = nodes.groupBy("range_no", "block").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"), node("at", "leaf").alias("node"))
    return blocks.groupBy("range_no").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), node("block", "node").alias("root"))


def _chunked(doc_ids: pa.Array, streams: list[bytes], width: int, smallest: int, mask_bits: int, largest: int) -> pa.RecordBatch:
    ends = np.cumsum([len(s) // 4 for s in streams])
    ids = np.frombuffer(b"".join(streams), "<u4")
    stored = ids.astype("<u2") if width == 2 else ids
    marks = np.flatnonzero(_rolled(ids) & np.uint64((1 << mask_bits) - 1) == 0)
    hashes, sizes, data, counts, roots, at = [], [], [], [], [], 0
    for end in ends.tolist():
        own, begin = marks[np.searchsorted(marks, at + smallest - 1) : np.searchsorted(marks, end)].tolist(), at
        cuts, k = [], 0
        while begin < end:
            while k < len(own) and own[k] + 1 - begin < smallest:
                k += 1
            stop = min(own[k] + 1 if k < len(own) else end, begin + largest, end)
            cuts.append((begin, stop))
            begin = stop
        for a, b in cuts:
            data.append(stored[a:b].tobytes())
            hashes.append(_hash(data[-1]))
            sizes.append(b - a)
        counts.append(len(cuts))
        roots.append(merkle(hashes[len(hashes) - len(cuts) :]))
        at = end
    rows = pa.StructArray.from_arrays([pa.array(hashes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())], ["hash", "n", "data"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), rows)
    n = pa.array(np.diff(np.concatenate([[0], ends])), pa.int64())
    return pa.RecordBatch.from_arrays([doc_ids, n, pa.array(roots, pa.binary()), lists], ["doc_id", "n_tokens", "root", "chunks"])


def _rolled(ids: np.ndarray, window: int = 16) -> np.ndarray:
    """A polynomial hash of the ``window`` ids up to each place. The first places of a document also see the document
    before it; no cut is made there, since a chunk is longer than the window."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    power, base = 1, 0x5851F42D4C957F2D
    while power < window:
        step = np.uint64(pow(base, power, 1 << 64))
        h[power:] = h[power:] + h[:-power] * step
        power *= 2
    return h ^ (h >> np.uint64(33))


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle(nodes: list[bytes]) -> bytes:
    """The root of a binary hash tree; a last node without a partner rises as it is."""
    while len(nodes) > 1:
        nodes = [_hash(b"".join(nodes[i : i + 2])) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    return nodes[0] if nodes else b""


def _product(a: np.ndarray, b: int) -> np.ndarray:
    """Products of polynomials over GF(2) with ``b`` modulo the CRC polynomial (highest power in the lowest bit)."""
    p = np.zeros_like(a)
    for k in range(31, -1, -1):
        p ^= (a >> np.uint32(k) & np.uint32(1)) * np.uint32(b)
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return p


def crc_shifted(crcs: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """What CRC-32 values (uint32) add to that of a longer string in which so many bytes follow: the CRC of parts put
    together is the exclusive or of what they add."""
    out, power = crcs.copy(), 1 << 23  # x ** 8: one byte
    for bit in range(int(n_bytes.max(initial=0)).bit_length()):
        own = np.flatnonzero(n_bytes >> bit & 1)
        out[own] = _product(out[own], power)
        power = int(_product(np.array([power], np.uint32), power)[0])
    return out


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, n_chunks`` of each stored document, from the files under ``path``.

    Every stored chunk is read, compared with its hash and reduced to the CRC of its ids as 32-bit integers; a
    document's CRC is joined from those of its chunks, so no ids are shuffled. Every document's chunk hashes must give
    its Merkle root, and every range its manifest; anything else raises.
    """
    _verify_manifest(spark, path)

    def digest(batches):
        for batch in batches:
            data, n = batch.column("data").to_pylist(), batch.column("n").to_pylist()
            for h, d in zip(batch.column("hash").to_pylist(), data, strict=True):
                if _hash(d) != h:
                    raise ValueError(f"stored chunk {h.hex()} is damaged")
            crc = [zlib.crc32(_wide(d, k)) for d, k in zip(data, n, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("n"), pa.array(crc, pa.int64())], ["hash", "n", "crc"])

    chunks = spark.read.parquet(f"{path}/chunks").mapInArrow(digest, "hash binary, n int, crc long")
    recipes = running_sum(spark.read.parquet(f"{path}/recipes"), _ORDER, F.col("n_tokens"), "start")
    parts = recipes.select("doc_id", "start", "n_tokens", "root", F.posexplode_outer("hashes").alias("seq", "hash")).join(chunks, "hash", "left")
    lists = parts.groupBy("doc_id", "start", "n_tokens", "root").agg(F.array_sort(F.collect_list(F.struct("seq", "hash", "n", "crc"))).alias("parts"))

    def fold(batches):
        for batch in batches:
            rows, size = batch.column("parts").flatten(), pa.compute.list_value_length(batch.column("parts")).to_numpy()
            doc, real = np.repeat(np.arange(len(size)), size), rows.field("seq").is_valid().to_numpy(zero_copy_only=False)
            doc, hashes = doc[real], rows.field("hash").filter(pa.array(real)).to_pylist()
            n, crc = (rows.field(c).fill_null(0).to_numpy().astype(np.int64)[real] for c in ("n", "crc"))
            counts, lengths = np.bincount(doc, minlength=len(size)), np.zeros(len(size), np.int64)
            np.add.at(lengths, doc, n)
            ends = np.cumsum(counts)
            if (lengths != batch.column("n_tokens").to_numpy()).any() or any(merkle(hashes[e - k : e]) != r for e, k, r in zip(ends.tolist(), counts.tolist(), batch.column("root").to_pylist(), strict=True)):
                raise ValueError("a recipe does not give its document's root")
            after = np.cumsum(lengths)[doc] - np.cumsum(n)
            crcs = np.zeros(len(size), np.uint32)
            np.bitwise_xor.at(crcs, doc, crc_shifted(crc.astype(np.uint32), 4 * after))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crcs.astype(np.int64)), pa.array(counts, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32", "n_chunks"])

    return lists.mapInArrow(fold, "doc_id long, start long, n_tokens long, ids_crc32 long, n_chunks long")


def _wide(data: bytes, n: int) -> bytes:
    return data if len(data) == 4 * n else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def _verify_manifest(spark: SparkSession, path: str) -> None:
    said, found = spark.read.parquet(f"{path}/manifest"), _manifest(spark.read.parquet(f"{path}/recipes"))
    if said.join(found, ["range_no", "n_docs", "n_tokens", "root"], "full_outer").count() != said.count():
        raise ValueError("the recipes do not give the manifest")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` (array of int) of each stored document, put together from its chunks."""
    recipes = running_sum(spark.read.parquet(f"{path}/recipes"), _ORDER, F.col("n_tokens"), "start")
    parts = recipes.select("doc_id", "start", F.posexplode_outer("hashes").alias("seq", "hash")).join(spark.read.parquet(f"{path}/chunks"), "hash", "left")
    lists = parts.groupBy("doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("seq", "n", "data"))).alias("parts"))

    def joined(batches):
        for batch in batches:
            ids = [np.frombuffer(b"".join(_wide(p["data"], p["n"]) for p in x if p["n"]), "<i4") for x in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    return lists.mapInArrow(joined, "doc_id long, start long, ids array<int>")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark)
    write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_digests(spark, path)


QUERIES = {"op3_token_store": op3_token_store}
