"""Alignment of the tokens of two tokenizers over the bytes of the same texts."""

import hashlib
import re
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import documents, stage, table
from glimmer.llm._tokenize import WHITE_SPACE, Encoder, slices

#: Units of text kept with the ids of both sides in a Python worker; all are dropped when there are more.
_MOST_UNITS = 500_000
#: Longer units are not kept.
_LONGEST_UNIT = 64
#: Links of a group that are listed one by one; larger groups go by their distinct ids.
_MOST_LISTED = 4096
#: Characters of text aligned at once.
_SLICE = 1_000_000

_twins: dict[tuple[str, str], "Twin"] = {}


class Twin:
    """Ids of ``space + text`` by a byte-level tokenizer (A) and of ``text`` by a sentencepiece model (B), which adds the space.

    Special tokens' strings are plain text. Neither side joins characters over the edge between two units (white space with
    what follows it), as the vocabularies show, so each distinct unit is encoded once. ``bytes_a``, ``bytes_b``: what each
    id stands for.
    """

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.a = Encoder(byte_path)
        if self.a.form != "led":
            raise ValueError("A is not a byte-level tokenizer led by white space")
        self.a.tokenizer.encode_special_tokens = True
        byte_of = {c: b for b, c in self.a.bytes_as.items()}
        vocab = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of.get(ord(c), ord(c)) for c in token) if all(ord(c) in byte_of or ord(c) < 256 for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        plain = [p.replace("▁", " ") for p in pieces]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.encode() for i, p in enumerate(plain)]
        joined = "".join(sorted({y for p in plain for x, y in zip(p, p[1:]) if y in WHITE_SPACE and x not in WHITE_SPACE}))
        if " " in joined or any(len(p) > 1 and "\n" in p for p in plain):
            raise ValueError("pieces of B go on over spaces")
        on = f"(?:[{re.escape(joined)}][{WHITE_SPACE}]*[^{WHITE_SPACE}]*)*" if joined else ""
        self.unit = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+{on}|[{WHITE_SPACE}]+")
        self.ahead = len(self.b.encode("\n"))
        self.kept: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.odd: set[str] = set()  # units whose bytes one side does not give back

    def ids(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Little-endian unsigned 32-bit ids of each text by A and by B; None where a side's bytes are not the text's."""
        (kept_a, kept_b), split = self.kept, [self.unit.findall(" " + t) if t else [] for t in texts]
        new = list(set().union(*split).difference(kept_a))
        for at in range(0, len(new), 8192):
            some = new[at : at + 8192]
            ours, theirs = self.a.ids(some), self.b.encode(["\n" + u for u in some], num_threads=1)
            for u, x, y in zip(some, ours, theirs, strict=True):
                y, own = y[self.ahead :], u.encode()
                kept_a[u], kept_b[u] = x, array("I", y).tobytes()
                if not b"".join(map(self.bytes_a.__getitem__, array("I", x))) == own == b"".join(map(self.bytes_b.__getitem__, y)):
                    self.odd.add(u)
        join = lambda kept, units: b"".join(map(kept.__getitem__, units))
        got = [(join(kept_a, units), join(kept_b, units)) if units and (not self.odd or self.odd.isdisjoint(units)) else None for units in split]
        for u in new:
            if len(u) > _LONGEST_UNIT:
                del kept_a[u], kept_b[u]
                self.odd.discard(u)
        if len(kept_a) > _MOST_UNITS:
            for kept in (kept_a, kept_b, self.odd):
                kept.clear()
        if len(self.a.kept) > _MOST_UNITS:
            self.a.kept.clear()
        return got


def twin(byte_path: str, piece_path: str) -> Twin:
    """The pair of tokenizers; a Python worker keeps it from task to task."""
    key = byte_path, piece_path
    if key not in _twins:
        _twins[key] = Twin(byte_path, piece_path)
    return _twins[key]


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) numbers of all tokens whose bytes overlap. ``start``: of each token in the bytes of all documents of the batch,
    ascending. Each token start finds the other side's token that covers it; two tokens overlap if and only if the
    start of one is covered by the other, so the union of both directions has all pairs, in order."""
    a = pd.DataFrame({"doc": doc_a, "at": start_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"doc": doc_b, "at": start_b, "b": np.arange(len(start_b))})
    covering_b = pd.merge_asof(a, b, on="at", by="doc")["b"].to_numpy(np.int64)
    covering_a = pd.merge_asof(b, a, on="at", by="doc")["a"].to_numpy(np.int64)
    more = np.flatnonzero(start_a[covering_a] != start_b)
    return np.r_[np.arange(len(start_a)), covering_a[more]], np.r_[covering_b, more]


def grouped(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(last token of A, last token of B, end) of each group: overlapping tokens with equal ends cut there."""
    last = end_a[a] == end_b[b]
    a, b = np.sort(a[last]), np.sort(b[last])
    return a, b, end_a[a]


def distinct_links(ids_a: np.ndarray, ids_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(document, pair, links) of the id pairs ``a * width + b`` that are linked in each document, with the number of
    their occurrences. Groups have ``n_a`` tokens of A from ``first_a`` on, and so B."""
    size, span = n_a * n_b, (int(ids_a.max(initial=0)) + 1) * width  # a document's pairs are a range of ``span`` numbers
    one, some = size == 1, np.flatnonzero((size > 1) & (size <= _MOST_LISTED))
    group = np.repeat(some, size[some])
    step = np.arange(len(group)) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
    over, under = np.divmod(step, n_b[group])
    single = doc[one] * span + ids_a[first_a[one]] * width + ids_b[first_b[one]]
    several = doc[group] * span + ids_a[first_a[group] + over] * width + ids_b[first_b[group] + under]
    keys = np.sort(np.concatenate([single, several]))
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    keys, counts = keys[first], np.diff(np.r_[first, len(keys)])
    large = np.flatnonzero(size > _MOST_LISTED)
    if large.size:
        for g in large:
            (xs, cx), (ys, cy) = (np.unique(i[f[g] : f[g] + n[g]], return_counts=True) for i, f, n in ((ids_a, first_a, n_a), (ids_b, first_b, n_b)))
            keys = np.r_[keys, (doc[g] * span + xs[:, None] * width + ys).ravel()]
            counts = np.r_[counts, (cx[:, None] * cy).ravel()]
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, counts = keys[first], np.add.reduceat(counts, first)
    return *np.divmod(keys, span), counts


_ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<long>"
_KINDS = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def align(df: DataFrame, byte_path: str, piece_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links`` of each row of ``df``.

    Tokens of A (of ``space + text``) and of B are placed by their bytes. Offsets where both have an end cut them into groups;
    ``n_links`` counts the pairs of a token of A and one of B in the same group. ``pairs``: their distinct ids, the
    id of A times the size of B's vocabulary plus the id of B, and ``links``: how often each occurs. ``groups_sha256``: of
    the ids of all groups, ``a1,a2|b1;a3|b2``. Tokens meet by ``merge_asof``, keyed by document (see :func:`overlaps`).

    Null and empty texts, and texts that either side's bytes do not give back, have no tokens: zeros, an empty string. A null
    id stays null. Repeated rows are rows of their own; ``row`` tells them apart. An empty table gives an empty result. Other
    columns are ignored. A very long text is aligned in one piece.
    """
    docs = documents(df, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")

    def find(batches):
        both = twin(byte_path, piece_path)
        size_a, size_b = (np.array([len(x) for x in t], np.int64) for t in (both.bytes_a, both.bytes_b))
        strings = [b"%d%s" % (i, end) for size, ends in ((len(size_a), (b",", b"|")), (len(size_b), (b",", b";"))) for i in range(size) for end in ends]
        for part, texts in slices(batches, _SLICE):
            got = both.ids(texts)
            ids_a, ids_b = (np.frombuffer(b"".join([g[k] for g in got if g]), np.uint32).astype(np.int64) for k in (0, 1))
            n_a, n_b = (np.array([len(g[k]) // 4 if g else 0 for g in got], np.int64) for k in (0, 1))
            doc_a, doc_b = (np.repeat(np.arange(len(got)), n) for n in (n_a, n_b))
            end_a, end_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
            a, b = overlaps(doc_a, end_a - size_a[ids_a], doc_b, end_b - size_b[ids_b])
            last_a, last_b, _ = grouped(a, b, end_a, end_b)
            first_a, first_b = np.r_[0, last_a[:-1] + 1][: len(last_a)], np.r_[0, last_b[:-1] + 1][: len(last_b)]
            many_a, many_b, doc = last_a + 1 - first_a, last_b + 1 - first_b, doc_a[last_a]
            n_groups = np.bincount(doc, minlength=len(got))
            n_links = np.bincount(doc, weights=many_a * many_b, minlength=len(got)).astype(np.int64)
            where, pair, count = distinct_links(ids_a, ids_b, first_a, first_b, many_a, many_b, doc, len(size_b))
            told = np.empty(len(ids_a) + len(ids_b), np.int64)  # strings of the tokens in the order of the groups
            code_a, code_b = 2 * ids_a, 2 * ids_b + 2 * len(size_a)
            code_a[last_a] += 1
            code_b[last_b] += 1
            told[np.arange(len(ids_a)) + np.repeat(first_b, many_a)] = code_a
            told[np.arange(len(ids_b)) + np.repeat(last_a + 1, many_b)] = code_b
            ends = np.cumsum(n_a + n_b)
            digests = [hashlib.sha256(b"".join(map(strings.__getitem__, told[z - n : z].tolist()))[:-1]).hexdigest() if n else "" for n, z in zip((n_a + n_b).tolist(), ends.tolist(), strict=True)]
            cuts = pa.array(np.searchsorted(where, np.arange(len(got) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int64())) for x in (pair, count)]
            numbers = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *numbers, pa.array(digests, pa.string()), *lists], [c.split()[0] for c in _ALIGNED.split(", ")])

    return docs.mapInArrow(find, _ALIGNED)


def linked_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair, count, best`` of all linked pairs of ids: in how many rows of ``aligned`` (staged) they are linked, and whether
    that is the most of all pairs with that id of A."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").count()
    counts = stage(counts.withColumn("a", F.expr(f"pair div {width}")))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return stage(counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


def scored(aligned: DataFrame, counts: DataFrame, most_broadcast: int = 300_000) -> DataFrame:
    """``row, n_best, count_sum`` of the rows of ``aligned`` that have links: how many of them have a best pair, and the sum of
    their counts. The pairs with the largest counts, at most ``most_broadcast``, are broadcast; only occurrences of rarer ones,
    which no pair has many of, are shuffled."""
    level = F.floor(4 * F.log2("count"))
    sizes = counts.groupBy(level.alias("least")).agg(F.count("*").alias("n")).orderBy(F.desc("least")).collect()
    least, total = 4 * 64, 0
    for r in sizes:
        total += r["n"]
        if total > most_broadcast:
            break
        least = r["least"]
    each = aligned.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.links")
    often = F.broadcast(counts.filter(level >= least))
    found = each.join(often, "pair", "left")
    key = F.when(F.col("count").isNull(), F.col("pair")).otherwise(-1 - F.col("row"))
    best = lambda n: F.sum(F.when(F.col("best"), n).otherwise(0))
    parts = found.groupBy("row", key.alias("key")).agg(F.sum("links").alias("links"), best(F.col("links")).alias("n_best"), F.sum(F.col("links") * F.col("count")).alias("count_sum"))
    seldom = counts.filter(level < least).select(F.col("pair").alias("key"), "count", "best")
    met = parts.join(seldom, "key", "left")
    n_best = F.when(F.col("best"), F.col("links")).otherwise(F.when(F.col("count").isNull(), F.col("n_best")).otherwise(0))
    return met.groupBy("row").agg(F.sum(n_best).alias("n_best"), F.sum(F.coalesce(F.col("links") * F.col("count"), "count_sum")).alias("count_sum"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the byte-level (A) and the piece tokenizer (B)."""
    import public_tokenizers
    import sentencepiece

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = stage(align(table(spark, sf_dir, "documents"), *paths))
    width = sentencepiece.SentencePieceProcessor(model_file=paths[1]).get_piece_size()
    sums = scored(aligned, linked_counts(aligned, width))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return aligned.drop("pairs", "links").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


QUERIES = {"op12_token_alignment": op12_token_alignment}
