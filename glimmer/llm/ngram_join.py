"""Jaccard similarity join of documents on word n-grams."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import documents, stage, table
from glimmer.llm._tokenize import slices
from glimmer.llm.components import components

#: Least and most bits of a bucket's number in the table of shingle frequencies; two bytes a bucket are broadcast.
_LEAST_BITS, _MOST_BITS = 12, 22
#: Buckets that one row of partial counts holds.
_BLOCK = 1 << 12
#: Bits of the sketch that goes with postings, 64 to a long; a wide sketch has at least as many bits as its set has shingles.
_SKETCH = 256
#: Neighbours in a token's order with which a document is compared before the join.
_NEIGHBOURS = 16
#: Ids up to this many are broadcast; more are joined by a shuffle.
_MOST_IDS = 2_000_000
#: Bits of the table of documents whose sets are needed: so many an id, up to so many in all.
_BITS_AN_ID, _MOST_TABLE = 16, 1 << 29
_ONE_BYTE = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's ``width``-word shingles, A-Z in lower case.

    A text with fewer words has one shingle, all its words; one without words has none.
    """
    encoded = [t.encode().translate(_ONE_BYTE) for t in texts]
    buffer = np.frombuffer(b" ".join([b"", *encoded, b""]), np.uint8)
    in_word = buffer != 32
    starts = np.flatnonzero(in_word[1:] & ~in_word[:-1]) + 1
    ends = np.cumsum([len(e) + 1 for e in encoded]) + 1 if encoded else np.zeros(0, np.int64)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    n_chars = np.diff(np.append(starts, len(buffer)))
    place = np.arange(starts[0], len(buffer)) - np.repeat(starts, n_chars)
    powers = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    words = np.add.reduceat(np.where(in_word[starts[0] :], _VALUES[buffer[starts[0] :]], np.uint64(0)) * powers[place], starts - starts[0])
    words = _mixed(words)
    out, at = [], 0
    for stop in np.searchsorted(starts, ends).tolist():
        own, n = words[at:stop], min(width, stop - at)
        at = stop
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.full(len(own) - n + 1, n, np.uint64)
        for k in range(n):
            h = _mixed(h * np.uint64(0xD6E8FEB86659FD93) + own[k : k + len(h)])
        out.append(np.unique(h))
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def frequencies(docs: DataFrame, width: int) -> np.ndarray:
    """For each bucket of shingle hashes a level that rises with the number of its shingles over all documents.

    There are about as many buckets as shingles, between ``2 ** _LEAST_BITS`` and ``2 ** _MOST_BITS``, so that rare
    shingles are told from middling ones at any size of the corpus. A task counts its texts in an array of that length and
    hands on the buckets it has met in blocks, which are added up block by block.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = min(_MOST_BITS, max(_LEAST_BITS, (size // 6).bit_length()))

    def count(batches):
        total = np.zeros(1 << bits, np.uint32)
        for _, texts in slices(batches):
            found = np.concatenate([np.zeros(0, np.uint64), *shingle_sets(texts, width)]) >> np.uint64(64 - bits)
            np.add.at(total, found.astype(np.int64), np.uint32(1))
        for k, own in enumerate(total.reshape(-1, _BLOCK)):
            if own.any():
                size = next(b for b in (1, 2, 4) if own.max() < 1 << 8 * b)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(own.astype(f"<u{size}").tobytes(), 1)], pa.binary())], ["block", "data"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist(), strict=True):
                raw = zlib.decompress(data)
                sums.setdefault(k, np.zeros(_BLOCK, np.int64))[:] += np.frombuffer(raw, f"<u{len(raw) // _BLOCK}")
        for k, total in sums.items():
            levels = np.rint(16 * np.log2(np.maximum(total, 1))).astype("<u2")
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(levels.tobytes(), 1)], pa.binary())], ["block", "data"])

    parts = docs.select("text").mapInArrow(count, "block int, data binary").repartition("block").mapInArrow(add, "block int, data binary")
    levels = np.zeros(1 << bits, np.uint16)
    for r in parts.toLocalIterator():
        levels[r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = np.frombuffer(zlib.decompress(r["data"]), "<u2")
    return levels


def rarest_first(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A sorted set in the order that all sets share: by the level of a shingle's bucket, then by its hash."""
    bits = len(levels).bit_length() - 1
    return s[np.argsort(levels[(s >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")]


def wide_sketch(s: np.ndarray) -> np.ndarray:
    """Bits (in 64-bit words), each the parity of the number of shingles that hash to it; about as many as shingles."""
    bits = 1 << (max(_SKETCH, len(s)) - 1).bit_length()
    return np.packbits(np.bincount((s >> np.uint64(3) & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """A sketch of fewer bits of the same set: its halves are laid over each other."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _reaches(t: int, n, pos, m, pos_m, least=F.least, greatest=F.greatest):
    """Length and positional filters in integers: overlap >= t * (n + m) / (100 + t). The shingles before the first
    common one are in one set only, so there can be no more of them than shingles may differ."""
    most = 1 + least(n - pos - 1, m - pos_m - 1)
    first = ((100 + t) * (pos + pos_m) <= (100 - t) * (n + m)) & ((100 + t) * (least(pos, pos_m) + most) >= t * (n + m))
    return (100 * least(n, m) >= t * greatest(n, m)) & first


class Join:
    """Documents linked when ``100 * intersection >= percent * union`` of their shingle sets.

    Documents with equal sets form a class, which the smallest id stands for; only these are joined. All sets have one
    order, in which frequent shingles come last (see :func:`frequencies`); any common order gives exact results. Two sets
    can only reach the threshold if they share a shingle of their prefixes. Candidates then pass the length filter, the
    positional filter, and a suffix filter on sketches; what is left is verified once a pair. A bit of a sketch is the
    parity of the number of shingles that hash to it: a shingle in one set only turns one bit over, so no more bits differ
    than there are such shingles. Short sketches go with postings, wide ones are compared once a pair.
    """

    def __init__(self, df: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text"):
        self.docs, self.width, self.percent = documents(df, id_col, text_col), width, percent
        self.spark = df.sparkSession
        self.sets = self._described()
        full = self.sets.filter("n_shingles > 0")
        self.classes = stage(full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_rows")))
        others = stage(full.select("doc_id", "digest").join(self.classes.filter("n_rows > 1"), "digest").filter("doc_id <> rep or doc_id is null").select("digest", "doc_id"))
        copies = others.select("doc_id", "digest").dropna().distinct()
        copies = F.broadcast(copies) if copies.count() <= _MOST_IDS else copies
        self.own = full.filter("doc_id is not null").join(copies, ["doc_id", "digest"], "left_anti")
        self.postings = self._postings()

    def _described(self) -> DataFrame:
        levels, width, percent = self.spark.sparkContext.broadcast(frequencies(self.docs, self.width)), self.width, self.percent

        def describe(batches):
            for part, texts in slices(batches):
                sets = shingle_sets(texts, width)
                heads = [rarest_first(s, levels.value)[: len(s) - -(-percent * len(s) // 100) + 1] if len(s) else s for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(h) for h in heads])])
                prefix = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*heads, np.zeros(0, np.uint64)]).view(np.int64)))
                wide = [wide_sketch(s) for s in sets]
                short = np.concatenate([np.zeros(0, np.uint64), *[folded(w, _SKETCH // 64) for w in wide]]).view(np.int64)
                short = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * (_SKETCH // 64), pa.int32()), pa.array(short))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), short, pa.array([w.tobytes() for w in wide], pa.binary()), prefix],
                    ["doc_id", "n_shingles", "digest", "sketch", "wide", "prefix"],
                )

        return stage(self.docs.mapInArrow(describe, "doc_id long, n_shingles long, digest binary, sketch array<long>, wide binary, prefix array<long>"))

    def _postings(self) -> DataFrame:
        """``token, n, pos, doc`` of the prefix shingles that more than one class may have.

        Postings are dealt out by ranges of (token, n, doc), so a token that a third of all classes have fills many
        tasks. Each task reads its postings once in order and leaves out tokens that occur once. The range's first and
        last token may go on in other ranges and stay.
        """
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        size = F.shiftleft(F.col("n_shingles"), 32)
        rows = self.own.select(size.alias("size"), F.col("doc_id").alias("doc"), F.posexplode("prefix").alias("pos", "token"))
        dealt = rows.select("token", F.col("size").bitwiseOR(F.col("pos").cast("long")).alias("size_pos"), "doc").repartitionByRange(n, "token", "size_pos", "doc").sortWithinPartitions("token", "size_pos", "doc")
        kept = stage(dealt.mapInArrow(_shared, "token long, size_pos long, doc long"))
        return kept.select("token", F.shiftright("size_pos", 32).alias("n"), F.col("size_pos").bitwiseAND((1 << 32) - 1).alias("pos"), "doc")

    def _sketched(self, postings: DataFrame) -> DataFrame:
        sketches = self.own.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch").distinct()
        return postings.join(sketches, ["doc", "n"])

    def _neighbours(self) -> DataFrame:
        """Pairs (``a, b``) of documents that pass all filters and stand at most ``_NEIGHBOURS`` apart in the order of a
        token they share: at most so many a posting, however many documents share the token."""
        n, percent, longs = int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.percent, _SKETCH // 64

        def meet(batches):
            for batch in batches:
                token, size, pos, doc = (batch.column(c).to_numpy() for c in ("token", "n", "pos", "doc"))
                sketch = batch.column("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, longs)
                found = []
                for k in range(1, min(_NEIGHBOURS, len(token) - 1) + 1):
                    i = np.flatnonzero((token[k:] == token[:-k]) & (doc[k:] != doc[:-k]))
                    i = i[_reaches(percent, size[i], pos[i], size[i + k], pos[i + k], np.minimum, np.maximum)]
                    apart = np.bitwise_count(sketch[i] ^ sketch[i + k]).sum(1, dtype=np.int64)
                    total = size[i] + size[i + k]
                    i = i[100 * (total - apart) >= percent * (total + apart)]
                    found.append(np.stack([np.minimum(doc[i], doc[i + k]), np.maximum(doc[i], doc[i + k])], 1))
                if found:
                    pairs = np.unique(np.concatenate(found), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        dealt = stage(self._sketched(self.postings)).repartitionByRange(n, "token", "n", "doc").sortWithinPartitions("token", "n", "doc")
        return dealt.mapInArrow(meet, "a long, b long").distinct()

    def _needed(self, ids: DataFrame, n_ids: int) -> DataFrame:
        """``doc_id, shingles`` (their set as bytes) of the classes in ``ids`` (``doc_id``), from another pass over all texts.

        A table of ``_BITS_AN_ID`` bits an id lets most other documents pass by before their words are read.
        """
        size = min(_MOST_TABLE, max(1 << 16, 1 << (n_ids * _BITS_AN_ID).bit_length()))
        place = F.pmod(F.xxhash64("doc_id"), F.lit(size)).cast("int")
        parts = ids.select(F.floor(place / 32768).alias("k"), (place % 32768).cast("long").alias("bit")).groupBy("k").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
        bits = np.zeros(size // 8, np.uint8)
        for r in parts.toLocalIterator():
            bits[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
        found, width = self.spark.sparkContext.broadcast(bits), self.width

        def read(batches):
            for batch in batches:
                p = batch.column("place").to_numpy()
                batch = batch.filter(pa.array(found.value[p >> 3] >> (p & 7).astype(np.uint8) & 1 > 0))
                for part, texts in slices([batch]):
                    sets = shingle_sets(texts, width)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "shingles"])

        numbered = self.docs.filter("doc_id is not null").withColumn("place", place)
        return stage(numbered.mapInArrow(read, "doc_id long, shingles binary"))

    def _likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs of ``pairs`` (staged) whose wide sketches allow a link, staged."""
        ids, percent = _ends(pairs), self.percent
        ids = F.broadcast(ids) if 2 * pairs.count() <= _MOST_IDS else ids
        wide = self.own.select("doc_id", "n_shingles", "wide").join(ids, "doc_id", "left_semi")

        def sift(batches):
            for batch in batches:
                keep = []
                for n, m, *both in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "x", "y")), strict=True):
                    x, y = (np.frombuffer(v, np.uint64) for v in both)
                    words = min(len(x), len(y))
                    apart = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
                    keep.append(100 * (n + m - apart) >= percent * (n + m + apart))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        left = wide.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n"), F.col("wide").alias("x"))
        right = wide.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"), F.col("wide").alias("y"))
        return stage(pairs.join(right, "b").join(left, "a").mapInArrow(sift, "a long, b long").distinct())

    def _verified(self, candidates: DataFrame) -> DataFrame:
        """The linked pairs of ``candidates`` (``a, b``), staged. Sets are read only of documents that are in one."""
        pairs, percent = self._likely(stage(candidates)), self.percent
        sets = self._needed(_ends(pairs), 2 * pairs.count())

        def verify(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                    p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * both >= percent * (len(p) + len(q) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
        right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
        return stage(pairs.join(right, "b").join(left, "a").mapInArrow(verify, "a long, b long").distinct())

    def links(self) -> DataFrame:
        """``a, b`` of all linked pairs of classes, each once. Their number may grow with the square of a group's size;
        :meth:`components` needs only some of them."""
        return self._verified(self._pairs(self._sketched(self.postings), F.col("doc_a") < F.col("doc_b")))

    def _pairs(self, postings: DataFrame, different: Column) -> DataFrame:
        left, right = (postings.select("token", *[F.col(c).alias(f"{c}_{s}") for c in postings.columns if c != "token"]) for s in "ab")
        n, m = F.col("n_a"), F.col("n_b")
        apart = sum((F.bit_count(F.get("sketch_a", F.lit(k)).bitwiseXOR(F.get("sketch_b", F.lit(k)))) for k in range(_SKETCH // 64)), F.lit(0))
        near = 100 * (n + m - apart) >= self.percent * (n + m + apart)
        may = _reaches(self.percent, n, F.col("pos_a"), m, F.col("pos_b")) & near
        meet = left.join(right, (left["token"] == right["token"]) & different & may)
        return meet.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).distinct()

    def components(self) -> DataFrame:
        """``node, component`` of the classes that have links.

        First classes are compared with their neighbours in the order of each token (see :meth:`_neighbours`), which
        joins most groups of near copies with a number of pairs in proportion to their size. Then every pair that shares
        a token and is still in different components is compared, so no link is lost.
        """
        first = self._verified(self._neighbours())
        of = components(first)
        marked = self.postings.join(of, F.col("doc") == F.col("node"), "left").select(*self.postings.columns, F.coalesce("component", "doc").alias("c"))
        mixed = marked.groupBy("token").agg((F.min("c") < F.max("c")).alias("mixed")).filter("mixed").select("token")
        rest = stage(self._sketched(marked.join(mixed, "token")))
        second = self._verified(self._pairs(rest, (F.col("doc_a") < F.col("doc_b")) & (F.col("c_a") != F.col("c_b"))))
        links = first.unionByName(second)
        several = stage(self.sets.filter("n_shingles > 0").groupBy("doc_id").agg((F.min("digest") < F.max("digest")).alias("several")).filter("several and doc_id is not null").select("doc_id"))
        if not several.isEmpty():  # an id with other sets too: its classes are one document
            bridges = self.sets.join(several, "doc_id").join(self.classes, "digest").filter("doc_id <> rep")
            links = links.unionByName(bridges.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct())
        return components(links)


def _ends(pairs: DataFrame) -> DataFrame:
    """``doc_id`` of all documents that are in a pair."""
    return pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()


def _shared(batches):
    """Of postings sorted by token: those of tokens with more than one, and of the task's first and last token."""
    held, seen, first = None, False, None  # the last posting, held back until another follows; whether its token came before it
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        token = batch.column("token").to_numpy()
        first = token[0] if first is None else first
        same = token[1:] == token[:-1]
        before, after = np.concatenate([[seen], same]), np.concatenate([same, [False]])
        keep = before | after | (token == first)
        held, seen, keep[-1] = batch.slice(len(token) - 1), bool(before[-1]), False
        yield batch.filter(pa.array(keep))
    if held is not None:
        yield held


def near_duplicates(df: DataFrame, *, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` of each row of ``df``.

    ``class_id`` is the smallest id with the same shingle set, ``component_id`` the smallest id that links lead to.
    Null text and text without words have no shingles and are linked with nothing. A row with a null id gets its
    class's ids, null if no other row is in the class. Rows that repeat an id count as one document: what one of them
    is linked with, all are. An empty table gives an empty result. Other columns are ignored.
    """
    join = Join(df, width, percent, id_col, text_col)
    found = join.components()
    named = join.classes.join(found, F.col("rep") == F.col("node"), "left").select("digest", "rep", F.coalesce("component", "rep").alias("c"))
    rows = join.sets.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("class_id"), F.coalesce("c", "doc_id").alias("component_id"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by 3-word shingles and a similarity of 0.9; rows without an id as in :func:`near_duplicates`."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=90).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op5_ngram_join": op5_ngram_join}
