"""Removal of repeated byte strings over a corpus, by longest previous factors."""

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import stage, table

#: Bytes of text that are hashed at once.
_CHUNK = 1 << 18
#: The low bits of an ordered hash hold the place in a chunk.
_PLACE = np.uint64((1 << 20) - 1)
#: Odd multipliers of the two rolling hashes, and the seed of their byte tables.
_BASES, _SEED = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), 20240607
#: Windows of the suffix order that are sorted at once.
_WINDOWS = 50_000
#: Of the windows of a hot anchor, one in so many distances from it gets a name of its own (see :func:`parts`), for windows of 200 bytes.
_APART = 16

_KEY = ["id", "th"]
_REGION = "id long, th long, lo int, n int, core long, region long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xA24BAED4963EE407)


class Rolling:
    """Hashes of any substring of a chunk from one running sum: modulo 2 ** 64, bytes stand for random numbers."""

    def __init__(self, which: int):
        self.base = _BASES[which]
        self.of_byte = np.random.default_rng(_SEED + which).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.grow(_CHUNK + 4096)

    def grow(self, n: int) -> None:
        powers = np.ones((2, n + 1), np.uint64)
        powers[:, 1:] = np.array([[self.base], [pow(self.base, -1, 1 << 64)]], dtype=np.uint64)
        self.up, self.down = np.cumprod(powers, axis=1, dtype=np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            self.grow(2 * len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.up[: len(data)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (sums[stop] - sums[start]) * self.down[start]


_rolling: dict[int, Rolling] = {}


def rolling(which: int) -> Rolling:
    if which not in _rolling:
        _rolling[which] = Rolling(which)
    return _rolling[which]


def spans_of(least: int) -> tuple[int, int]:
    """(windows an anchor may stand for, bytes of an anchor): every string of ``least`` bytes holds that many anchors."""
    span = max(1, least * 3 // 4)
    return span, least - span + 1


def anchored(data: np.ndarray, valid: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """``lo, hi, core, region`` of a chunk: windows (strings of ``least`` bytes) that start from ``lo`` to ``hi`` have
    their anchor, the leftmost of the smallest hashes of the strings in them, in common.

    Equal windows have equal anchors at equal distances. ``core`` is a hash of the anchor's bytes, ``region`` one of all
    bytes of the windows and of the anchor's place among them. ``valid`` marks the starts of windows.
    """
    span, size = spans_of(least)
    roll, last = rolling(0), len(data) - size + 1
    sums = roll.sums(data)
    cores = _mixed((sums[size:] - sums[:-size]) * roll.down[:last])
    placed = (cores & ~_PLACE) | np.arange(last, dtype=np.uint64)
    padded = np.full(-(-last // span) * span, np.iinfo(np.uint64).max)
    padded[:last] = placed
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.flatnonzero(valid)
    at = (np.minimum(behind[starts], ahead[starts + span - 1]) & _PLACE).astype(np.int64)
    new = np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]
    first = np.flatnonzero(new)
    lo, hi, at = starts[first], starts[np.r_[first[1:] - 1, len(starts) - 1]], at[first]
    other = rolling(1)
    region = _mixed(other.hashes(other.sums(data), lo, hi + least) + ((hi - lo).astype(np.uint64) << np.uint64(32)) + (at - lo).astype(np.uint64))
    return lo, hi, cores[at], region


def chunked(rows, least: int):
    """(data, valid starts, [(row, place of its text in the chunk, place of the chunk in its text)]) of texts put together;
    a long text goes into several chunks that overlap, so that each of its windows is in one of them."""
    parts, size, owners = [], 0, []

    def closed():
        data, valid = np.frombuffer(b"".join(p for p, _ in parts), np.uint8), np.zeros(size, bool)
        at = 0
        for p, _ in parts:
            valid[at : at + len(p) - least + 1] = True
            at += len(p)
        return data, valid, owners

    for row, text in rows:
        for begin in range(0, max(len(text) - least + 1, 0), _CHUNK):
            part = text[begin : begin + _CHUNK + least - 1]
            if parts and size + len(part) > _CHUNK:
                yield closed()
                parts, size, owners = [], 0, []
            owners.append((row, size, begin))
            parts.append((part, begin))
            size += len(part)
    if parts:
        yield closed()


def zipped(docs: DataFrame) -> DataFrame:
    """``id, th, doc_id, zip``: UTF-8 texts compressed, for the shuffles. ``id`` is 0 for a null ``doc_id``; ``th`` is a hash
    of the text: both name a document, unless rows repeat both."""
    named = docs.select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("th"), "doc_id", F.encode("text", "UTF-8").alias("zip"))

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for b in batches:
            zips = pa.array([packer.compress(t) for t in b.column("zip").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], zips], b.schema.names)

    return named.mapInArrow(pack, "id long, th long, doc_id long, zip binary")


def regions(docs: DataFrame, least: int) -> DataFrame:
    """``id, th, lo, n, core, region`` of every anchor (see :func:`anchored`): ``n`` windows start from byte ``lo`` of the text on."""
    named = docs.select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("th"), F.encode("text", "UTF-8").alias("text")).filter(F.octet_length("text") >= least)
    names, kinds = ["id", "th", "lo", "n", "core", "region"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def find(batches):
        for b in batches:
            ids, ths = (b.column(c).to_numpy() for c in ("id", "th"))
            for data, valid, owners in chunked(((k, t.as_py()) for k, t in enumerate(b.column("text"))), least):
                lo, hi, core, region = anchored(data, valid, least)
                row, place, begin = (np.array(x) for x in zip(*owners, strict=True))
                own = np.searchsorted(place, lo, side="right") - 1
                columns = [ids[row[own]], ths[row[own]], lo - place[own] + begin[own], hi - lo + 1, core.view(np.int64), region.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds, strict=True)], names)

    return named.mapInArrow(find, _REGION)


def nearest(place: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """For suffixes in suffix order (``place``: of each in the corpus; ``lcp[i]``: common prefix of the suffixes i - 1 and i) the
    longest factor that the suffix shares with one at a smaller place: the larger of the common prefixes with the previous
    and with the next smaller place in suffix order. Factors under ``least`` are not followed and may come out smaller."""

    def one_way(place, lcp):
        to, shared = np.arange(len(place)) - 1, lcp.copy()
        open_ = np.flatnonzero((to >= 0) & (shared >= least))
        while open_.size:
            open_ = open_[(place[to[open_]] > place[open_]) & (shared[open_] >= least)]
            over = to[open_]
            shared[open_], to[open_] = np.minimum(shared[open_], shared[over]), to[over]
            open_ = open_[(to[open_] >= 0) & (shared[open_] >= least)]
        return np.where(to >= 0, shared, 0)

    back = one_way(place[::-1], np.r_[0, lcp[:0:-1]])[::-1]
    return np.maximum(one_way(place, lcp), back)


def factors(data: np.ndarray, starts: np.ndarray, place: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For the suffixes of ``data`` at ``starts`` whether the longest previous factor, and whether the longest one from a later
    place, has ``least`` bytes. Suffixes are sorted by that many bytes, so longer factors count as ``least``."""
    text = np.lib.stride_tricks.sliding_window_view(data, least)[starts]
    order = np.argsort(text.view(f"S{least}").ravel(), kind="stable")
    lcp, place = np.zeros(len(starts), np.int64), place[order]
    for k in range(1, len(starts), 10_000):
        unlike = text[order[k : k + 10_000]] != text[order[k - 1 : k - 1 + 10_000][: len(order[k : k + 10_000])]]
        lcp[k : k + 10_000] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), least)
    found = []
    for p in (place, -place):
        flags = np.zeros(len(starts), bool)
        flags[order] = nearest(p, lcp, least) >= least
        found.append(flags)
    return found[0], found[1]


def runs(flags: np.ndarray, group: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(group, start, stop) of the bytes that runs of flagged windows cover; windows come by group and place ``at``."""
    k = np.flatnonzero(flags)
    if not k.size:
        return k, k, k
    new = np.r_[True, (k[1:] != k[:-1] + 1) | (group[k[1:]] != group[k[:-1]])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(k) - 1]
    return group[k[first]], at[k[first]], at[k[last]] + least


_TEXTS = "core long, lo int, n int, hot boolean, id long, th long, bytes binary"


def texts_of(asked: DataFrame, zips: DataFrame, least: int) -> DataFrame:
    """``asked`` (regions with ``id, th``) with their ``bytes``: one row a document meets its text."""
    wanted = asked.groupBy(*_KEY).agg(F.collect_list(F.struct("core", "lo", "n", "hot")).alias("asked"))
    met = wanted.join(zips.select(*_KEY, "zip"), _KEY)
    names = ["core", "lo", "n", "hot", *_KEY, "bytes"]

    def read(batches):
        unpacker, most = zstandard.ZstdDecompressor(), 20_000
        for b in batches:
            done, count = [], 0
            for k in range(b.num_rows):
                text, rows = unpacker.decompress(b.column("zip")[k].as_py()), b.column("asked")[k].values
                own = [b.column(c)[k].as_py() for c in _KEY]
                for at in range(0, len(rows), most):
                    some = rows.slice(at, most).flatten()
                    cut = [text[x : x + m + least - 1] for x, m in zip(some[1].to_pylist(), some[2].to_pylist(), strict=True)]
                    keys = [pa.array(np.full(len(cut), x), pa.int64()) for x in own]
                    done.append(pa.RecordBatch.from_arrays([*some, *keys, pa.array(cut, pa.binary())], names))
                    count += len(cut)
                    if count >= most:
                        yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                        done, count = [], 0
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()

    return met.mapInArrow(read, _TEXTS)


def windows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(bytes of all regions, start of each window in them, its region, its place in its text)."""
    texts = batch.column("bytes")
    size, n, lo = (np.asarray(x, np.int64) for x in (pa.compute.binary_length(texts), batch.column("n"), batch.column("lo")))
    data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    group = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    return data, (np.cumsum(size) - size)[group] + step, group, lo[group] + step


def suffix_spans(texts: DataFrame, least: int, first_stays: bool) -> DataFrame:
    """``id, th, start, stop``: bytes of regions covered by a long previous (or, unless ``first_stays``, also later) factor.

    Regions of one anchor come together and are put in suffix order in a task; a task sorts a bounded number of windows at once.
    A row that repeats the one before it, of a document that occurs twice, is left out.
    """
    dealt = texts.repartition("core").sortWithinPartitions("core", "id", "th", "lo")

    def find(batches):
        kept, count, last = [], 0, None

        def spans():
            b = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            ids, ths, lo = (np.asarray(b.column(c), np.int64) for c in ("id", "th", "lo"))
            data, starts, group, at = windows_of(b)
            rank = np.empty(len(ids), np.int64)
            rank[np.lexsort((lo, ths, ids))] = np.arange(len(ids))
            before, after = factors(data, starts, rank[group] * (at.max() + 1) + at, least)
            g, start, stop = runs(before if first_stays else before | after, group, at, least)
            return pa.RecordBatch.from_arrays([pa.array(ids[g]), pa.array(ths[g]), pa.array(start), pa.array(stop)], ["id", "th", "start", "stop"])

        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([np.asarray(b.column(c), np.int64) for c in ("core", "id", "th", "lo")])
            again = np.r_[last is not None and (keys[:, 0] == last).all(), (keys[:, 1:] == keys[:, :-1]).all(axis=0)]
            b, last = b.filter(pa.array(~again)), keys[:, -1]
            if not b.num_rows:
                continue
            core, n = np.asarray(b.column("core")), np.asarray(b.column("n"), np.int64)
            ends = np.r_[np.flatnonzero(core[1:] != core[:-1]) + 1, len(core)]
            begin = 0
            for end in ends:  # whole anchors are added up to the bound
                if kept and count >= _WINDOWS and kept[-1].column("core")[-1].as_py() != core[begin]:
                    yield spans()
                    kept, count = [], 0
                kept.append(b.slice(begin, end - begin))
                count += int(n[begin:end].sum())
                begin = end
        if kept:
            yield spans()

    return dealt.mapInArrow(find, "id long, th long, start long, stop long")


def parts(texts: DataFrame, least: int) -> DataFrame:
    """Regions of hot anchors cut into parts: ``id, th, lo, n, core, region, bytes`` of each.

    Windows whose distances from the anchor have one quotient by ``width`` are a part. ``core`` is a hash of the bytes that
    all windows of these distances have in common, ``region`` one of all bytes of the part and of its distance. So equal
    windows, which have equal distances, are in parts of one ``core``, whatever else their regions hold.
    """
    size, width = spans_of(least)[1], max(1, least * _APART // 200)
    names = ["id", "th", "lo", "n", "core", "region", "bytes"]

    def find(batches):
        roll, other = rolling(0), rolling(1)
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                data, starts, group, at = windows_of(part)
                ids, ths, core = (np.asarray(part.column(c), np.int64) for c in ("id", "th", "core"))
                sums = roll.sums(data)
                cores = _mixed((sums[size:] - sums[:-size]) * roll.down[: len(data) - size + 1]).view(np.int64)
                begin = starts[np.searchsorted(group, np.arange(len(ids)))]
                owner = np.searchsorted(begin, np.arange(len(cores)), side="right") - 1
                same = np.flatnonzero(cores == core[owner])
                anchor = same[np.searchsorted(owner[same], np.arange(len(ids)))]  # the leftmost one is the anchor
                block = (anchor[group] - starts) // width
                first = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (group[1:] != group[:-1])])
                last = np.r_[first[1:], len(starts)] - 1
                lo, hi, g, b = starts[first], starts[last], group[first], block[first]
                shared = anchor[g] - b * width  # the last start of a window of these distances
                told = (b.astype(np.uint64) << np.uint64(32)) + (hi - lo).astype(np.uint64)
                common = _mixed(roll.hashes(sums, shared, shared + (least - width + 1)) + b.astype(np.uint64))
                whole = _mixed(other.hashes(other.sums(data), lo, hi + least) + told + ((anchor[g] - lo).astype(np.uint64) << np.uint64(16)))
                cut = [data[x:y].tobytes() for x, y in zip(lo.tolist(), (hi + least).tolist(), strict=True)]
                columns = [ids[g], ths[g], at[first].astype(np.int32), (last - first + 1).astype(np.int32), common.view(np.int64), whole.view(np.int64)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(cut, pa.binary())], names)

    return texts.mapInArrow(find, "id long, th long, lo int, n int, core long, region long, bytes binary")


def hot_spans(texts: DataFrame, least: int, first_stays: bool, most_in_task: int) -> DataFrame:
    """The same of anchors with too many different regions for one task: their parts are treated as regions are, and those
    which still have too many different ones by the names of their windows."""
    rows = stage(parts(texts, least))
    groups = stage(rows.groupBy("core", "region").agg(F.count("*").alias("same"), F.min(F.struct("id", "th", "lo", "n", "bytes")).alias("first")))
    mixed = groups.groupBy("core").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    left = stage(groups.join(mixed, "core").select("core", "first.*", (F.col("kinds") > most_in_task).alias("hot")))
    whole = whole_spans(rows, groups, least, first_stays)
    return whole.unionByName(suffix_spans(left.filter("not hot"), least, first_stays)).unionByName(named_spans(left.filter("hot"), least, first_stays))


def whole_spans(rows: DataFrame, groups: DataFrame, least: int, first_stays: bool) -> DataFrame:
    """``id, th, start, stop`` of regions that have an equal one (with ``first_stays``, a smaller place)."""
    copies = groups.filter("same > 1").select("core", "region", F.col("first.id").alias("id0"), F.col("first.th").alias("th0"), F.col("first.lo").alias("lo0"))
    whole = rows.join(copies, ["core", "region"])
    if first_stays:
        whole = whole.filter("id <> id0 or th <> th0 or lo <> lo0")
    start, stop = F.col("lo").cast("long"), (F.col("lo") + F.col("n") + (least - 1)).cast("long")
    return whole.select(*_KEY, start.alias("start"), stop.alias("stop"))


def named_spans(texts: DataFrame, least: int, first_stays: bool) -> DataFrame:
    """The same of parts with too many different ones for one task: a window is a row, named by two hashes of its bytes,
    and an interval of the suffix order is a group of these names."""

    def names(batches):
        a, b = rolling(0), rolling(1)
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                data, starts, group, at = windows_of(part)
                ids, ths = (np.asarray(part.column(c), np.int64) for c in ("id", "th"))
                h = [_mixed(r.hashes(r.sums(data), starts, starts + least)).view(np.int64) for r in (a, b)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[group], ths[group], at, *h)], ["id", "th", "at", "h1", "h2"])

    rows = stage(texts.mapInArrow(names, "id long, th long, at long, h1 long, h2 long"))
    often = rows.groupBy("h1", "h2").agg(F.count("*").alias("count"), F.min(F.struct("id", "th", "at")).alias("first")).filter("count > 1")
    met = rows.join(often, ["h1", "h2"])
    gone = met.filter(F.struct("id", "th", "at") != F.col("first")) if first_stays else met
    return gone.select("id", "th", F.col("at").alias("start"), (F.col("at") + least).alias("stop"))


def dedup_factors(df: DataFrame, *, least_bytes: int = 200, keep: str = "first", id_col: str = "doc_id", text_col: str = "text", most_in_task: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, kept, spans`` of each row of ``df``: ``kept`` (binary) is its text as UTF-8 without the bytes of
    ``spans`` (``begin``, ``end``; in order, apart from each other).

    A position of a text whose longest previous factor, the longest string from it that also starts at an earlier place
    (by id, hash of the text, position), has at least ``least_bytes`` bytes is a later copy; with ``keep="first"`` these
    bytes go. With ``keep="none"`` the bytes of the first copy go as well: all positions that a factor of that length from a
    later place has count too. Matches never cross documents. Bytes are judged on the input, whatever else goes.

    Suffixes are not sorted all over the corpus: every string of ``least_bytes`` holds an anchor, chosen by its content, and
    suffixes whose anchor occurs once have no copy. Of the others, neighbouring ones with one anchor are a region; equal
    regions count once, all but the smallest place as later copies. What then has an anchor in common with a different
    region is put in suffix order, in bounded pieces by anchor; previous and next smaller places give the factors (see
    :func:`nearest`). Anchors with more than ``most_in_task`` different regions take :func:`hot_spans` instead, exact as well:
    their windows meet by distance from the anchor and by the bytes next to it, before any window becomes a row.

    Null texts are empty. A null id stays null. Rows that repeat an id and its text are copies like any others; with
    ``keep="first"`` one of them counts as the first. An empty table gives an empty result. Other columns are ignored.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    first_stays = keep == "first"
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = stage(regions(docs, least_bytes))
    often = stage(found.groupBy("core").count().filter("count > 1").select("core"))  # written, so that the join splits hot anchors
    shared = stage(found.join(often, "core"))
    place = F.struct("id", "th", "lo", "n")
    groups = stage(shared.groupBy("core", "region").agg(F.count("*").alias("same"), F.min(place).alias("first")))
    mixed = groups.groupBy("core").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    asked = groups.join(mixed, "core").select("core", "first.id", "first.th", "first.lo", "first.n", (F.col("kinds") > most_in_task).alias("hot"))
    zips = zipped(docs)
    texts = stage(texts_of(asked, zips, least_bytes))
    gone = [whole_spans(shared, groups, least_bytes, first_stays), suffix_spans(texts.filter("not hot"), least_bytes, first_stays)]
    gone.append(hot_spans(texts.filter("hot"), least_bytes, first_stays, most_in_task))
    spans = reduce(DataFrame.unionByName, gone).groupBy(*_KEY).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    met = zips.join(spans, _KEY, "left")
    if first_stays:
        met = met.repartition(*_KEY).sortWithinPartitions(*_KEY)

    def cut(batches):
        unpacker, before = zstandard.ZstdDecompressor(), None
        for b in batches:
            out, size = [], 0
            for doc_id, i, th, packed, given in zip(*(b.column(c).to_pylist() for c in ("doc_id", "id", "th", "zip")), b.column("spans"), strict=True):
                text = unpacker.decompress(packed)
                if first_stays and before == (i, th) and len(text) >= least_bytes:
                    merged = [(0, len(text))]
                else:
                    merged = joined(*(np.asarray(x) for x in given.values.flatten())) if given.is_valid else []
                before, at, left = (i, th), 0, []
                for a, z in merged:
                    left.append(text[at:a])
                    at = z
                out.append({"doc_id": doc_id, "n_bytes": len(text), "kept": b"".join([*left, text[at:]]), "spans": [{"begin": a, "end": z} for a, z in merged]})
                size += len(text)
                if size >= 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, kind)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, kind)

    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    kind = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(span))])
    return met.select("doc_id", *_KEY, "zip", "spans").mapInArrow(cut, "doc_id long, n_bytes long, kept binary, spans array<struct<begin: long, end: long>>")


def joined(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Spans that meet or overlap put together, in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return list(zip(start[first].tolist(), reach[np.r_[first[1:] - 1, len(start) - 1]].tolist(), strict=True))


def op13_factor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without any byte of a 200-byte string that occurs more than once."""
    cut = dedup_factors(table(spark, sf_dir, "documents"), least_bytes=200, keep="none")
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long")
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op13_factor_dedup": op13_factor_dedup}
