"""SentencePiece encoding and decoding as joins with the table of pieces."""

import hashlib
import heapq
import re
import string
import uuid
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import documents, stage, table
from glimmer.llm._tokenize import slices

#: Longest unit whose boundaries fit into the bits of a long.
_BITS = 60
#: In a model's pieces a mark stands for a space; here both are a space, so texts need no translation.
_SPACE, _MARK = " ", "▁"
_EDGE = "array<struct<rank:double,s:int,e:int,id:int>>"
#: The key of a byte-pair model's edge, one long: rank, start (6 bits), end (6 bits), whether it is late (see Pieces.late), id.
_RANK, _START, _END, _LATE, _ID = 37, 31, 25, 24, (1 << 24) - 1
#: Set in a fold's boundaries when an edge that was passed by has become possible.
_REDO = 1 << 62
#: Distinct units in one task of the lattice.
_UNITS_A_TASK = 40_000
#: Characters of a long unit whose edges are found together.
_BLOCK = 1024
#: Units that are broadcast with their ids, the most frequent ones; only occurrences of others are shuffled.
_MOST_BROADCAST = 400_000
#: Distinct cuts of texts (see Cutter) that a Python worker keeps.
_MOST_CUTS = 200_000
#: Documents whose units are counted to choose the units that are broadcast. No result depends on the choice.
_COUNTED = 40_000
#: UTF-8 bytes of the texts that are numbered together, but for a longer text.
_BATCH = 1_000_000
#: A rare unit of a batch as one long: partition and number of the batch in it (16 bits), place in the batch's list (25 bits).
_BATCHES, _PLACES = 16, 25
_MODULUS = 1_000_000_007


class Pieces:
    """The pieces of a model: ``table`` (``piece, id, score``) of at most the vocabulary's size, which may be broadcast.

    ``kind``: "bpe" where scores are ranks of merges, otherwise "unigram".
    """

    def __init__(self, rows: list[tuple[str, int, float]], bytes_from: int | None = None, unknown: int = 0):
        self.rows, self.bytes_from, self.unknown = rows, bytes_from, unknown
        self.kind = "bpe" if all(float(s).is_integer() for _, _, s in rows) else "unigram"
        self.longest = max((len(p) for p, _, _ in rows), default=1)
        pairs = {(a, b) for p, _, _ in rows for a, b in zip(p, p[1:])}
        if any(b == _SPACE != a for a, b in pairs):
            raise ValueError("pieces go on over white space")
        inside = {c for p in pairs for c in p}
        self.alone = "".join(c for c in "\n\t\r" if c not in inside)
        after_letters = {b for a, b in pairs if a.isalpha()}
        self.ends = "".join(c for c in string.punctuation if c not in after_letters)

    @classmethod
    def of_model(cls, path: str) -> "Pieces":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        first = next((i for i in range(n) if sp.is_byte(i)), None)
        return cls([(sp.id_to_piece(i).replace(_MARK, _SPACE), i, sp.get_score(i)) for i in plain], first, sp.unk_id())

    def pattern(self) -> str:
        """Units of a text: no piece goes over an edge between two of them."""
        one = lambda chars: "[" + re.sub(r"([\[\]\\^&-])", r"\\\1", chars) + "]"
        parts = [rf"{_SPACE}*+\p{{L}}++(?={one(self.ends)})"] * bool(self.ends)
        parts += [f"{_SPACE}*+[^{_SPACE}{self.alone}]++", f"{_SPACE}+", *[one(self.alone)] * bool(self.alone)]
        return "|".join(parts)

    def late(self) -> set[str]:
        """Pieces that may complete a pair which merges into a piece of lower rank than their own. Without one of them, the
        merges of a unit come in order of rank, so one pass over its edges finds them all."""
        rank = {p: -s for p, _, s in self.rows}
        halves = ((x, x[:k], x[k:]) for x in rank for k in range(1, len(x)))
        return {y for x, a, b in halves for y, z in ((a, b), (b, a)) if (z in rank or len(z) == 1) and rank.get(y, -1) > rank[x]}

    def table(self, spark: SparkSession) -> DataFrame:
        """``piece, id, score, rank, late`` and a row for the empty substring, whose ``id`` is null. Equal scores have one rank."""
        late, ranks = self.late() if self.kind == "bpe" else set(), {s: k for k, s in enumerate(sorted({s for _, _, s in self.rows}, reverse=True))}
        rows = [(p, i, float(s), ranks[s], int(p in late)) for p, i, s in self.rows]
        return spark.createDataFrame([*rows, ("", None, 0.0, 0, 0)], "piece string, id int, score double, rank long, late long")

    def code(self) -> list[bytes]:
        """Bytes by id; control pieces have none."""
        code = [b""] * (1 + max([i for _, i, _ in self.rows] + [(self.bytes_from or 0) + 255]))
        for p, i, _ in self.rows:
            code[i] = p.encode()
        if self.bytes_from is not None:
            code[self.bytes_from : self.bytes_from + 256] = [bytes([c]) for c in range(256)]
        return code

    def heads(self, spark: SparkSession, least: int) -> DataFrame:
        """``head``, the first ``least`` characters of pieces, and the ``lengths`` that pieces with it have."""
        found = defaultdict(set)
        for p, _, _ in self.rows:
            if len(p) >= least:
                found[p[:least]].add(len(p))
        return spark.createDataFrame([(h, sorted(x)) for h, x in found.items()], "head string, lengths array<int>")


class Cutter:
    """Units of texts in a Python worker.

    A text is cut by string methods before each run of spaces and, where no piece goes over it, each line feed. Units end
    there too, so a distinct cut meets the pattern once, however often it occurs. A cut is named without one leading space.
    """

    def __init__(self, pieces: Pieces):
        self.find, self.lines, self.ends = regex.compile(pieces.pattern()).findall, "\n" in pieces.alone, pieces.ends
        self.runs = re.compile(" *[^ \n]+|\n[^ \n]*| +" if self.lines else " *[^ ]+| +")

    def cuts(self, text: str) -> list[str]:
        if not text:
            return []
        if text[0] == _SPACE or 2 * _SPACE in text:
            return [c if self.lines and c[0] == "\n" else c[1:] for c in self.runs.findall(_SPACE + text)]
        return (text.replace("\n", " \n") if self.lines else text).split(_SPACE)

    def units(self, cut: str) -> list[str]:
        """As the pattern gives them; most cuts are letters, then perhaps marks, and need no pattern."""
        if cut.isalpha():
            return [_SPACE + cut]
        letters = cut.rstrip(self.ends) if self.ends else ""
        if letters.isalpha():
            return [_SPACE + letters, cut[len(letters) :]]
        return self.find(cut if self.lines and cut[:1] == "\n" else _SPACE + cut)


def _counts(cutter: Cutter):
    """``unit, count`` of texts, summed over many of them."""

    def run(batches):
        cuts = Counter()

        def summed():
            found = defaultdict(int)
            for cut, n in cuts.items():
                for unit in cutter.units(cut):
                    found[unit] += n
            cuts.clear()
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["unit", "count"])

        for _, texts in slices(batches):
            for text in texts:
                cuts.update(cutter.cuts(text))
            if len(cuts) > _MOST_CUTS:
                yield summed()
        yield summed()

    return run


def lattice(words: DataFrame, pieces: Pieces, dealt: bool = False) -> DataFrame:
    """All columns of ``words`` (``unit``: distinct units) with ``n`` and all pieces in each unit.

    At each place the lengths of the pieces with the first characters found there are exploded (see Pieces.heads), and these
    substrings joined with the pieces' table by equality; edges are grouped by unit. Units are dealt out before that (with
    ``dealt`` they are already), and no step moves a row, so only units are shuffled and never edges. The empty substring keeps
    units without any piece. ``edges``: the best score and then the leftmost first; for byte-pair models only those of two
    characters and more, with the bits of their ends and of the boundaries inside.
    """
    n, kept, least = F.length("unit"), words.columns, 2 if pieces.kind == "bpe" else 1
    if not dealt:
        parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), words.count() // _UNITS_A_TASK)
        words = words.repartition(parts, "unit")
    starts = words.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
    headed = starts.withColumn("head", F.substring("unit", F.col("s") + 1, F.lit(least))).join(F.broadcast(pieces.heads(words.sparkSession, least)), "head", "left")
    lengths = F.coalesce("lengths", F.array().cast("array<int>"))
    subs = headed.select(*kept, "s", F.explode(F.when(F.col("s") == 0, F.concat(F.array(F.lit(0)), lengths)).otherwise(lengths)).alias("k"))
    subs = subs.filter(F.col("k") <= n - F.col("s")).withColumn("piece", F.substring("unit", F.col("s") + 1, F.col("k")))
    found = subs.join(F.broadcast(pieces.table(words.sparkSession)), "piece")
    e = F.col("s") + F.col("k")
    if pieces.kind == "bpe":
        key = F.shiftleft("rank", _RANK) + F.shiftleft(F.col("s").cast("long"), _START) + F.shiftleft(e.cast("long"), _END) + F.shiftleft("late", _LATE) + F.col("id")
        edge = F.struct(key.alias("key"), (_bit(F.col("s")) + _bit(e)).alias("ends"), (_bit(e) - 2 * _bit(F.col("s"))).alias("inner"))
    else:
        edge = F.struct((-F.col("score")).alias("rank"), "s", e.alias("e"), "id")
    listed = found.select(*kept, F.when(F.col("id").isNotNull(), edge).alias("edge")).groupBy(*kept).agg(F.collect_list("edge").alias("edges"))
    return listed.select(*kept, n.alias("n"), F.sort_array("edges").alias("edges"))


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _bit(place) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def fold_merges(n: Column, edges: Column) -> Column:
    """Boundaries (bits of a long) after all merges of a byte-pair model.

    The model merges the pair of best score, the leftmost first, until none is left. The fold goes over the edges in
    that order; an edge is taken if its ends are boundaries with just one between them, which goes. Where taking a late
    edge makes one possible that was passed by before it, the unit is folded anew: each step then looks for the first
    edge that fits among all.
    """
    fits = lambda b, x: (b.bitwiseAND(x["ends"]) == x["ends"]) & (F.bit_count(b.bitwiseAND(x["inner"])) == 1)
    without = lambda b, x: b.bitwiseAND(F.bitwise_not(x["inner"]))
    missed = lambda b, x: (x["key"].bitwiseAND(1 << _LATE) != 0) & F.exists(edges, lambda y: (y["key"] < x["key"]) & fits(without(b, x), y))
    taken = lambda b, x: F.when(missed(b, x), without(b, x).bitwiseOR(F.lit(_REDO))).otherwise(without(b, x))
    start = _bit(n + 1) - 1
    once = F.aggregate(edges, start, lambda b, x: F.when(fits(b, x), taken(b, x)).otherwise(b))
    first = lambda b: F.get(F.filter(edges, lambda x: fits(b, x)), F.lit(0))
    step = lambda b: _let(first(b), lambda x: F.coalesce(without(b, x), b))
    every = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), start, lambda b, _: step(b))
    return _let(once, lambda b: F.when(b < _REDO, b).otherwise(every))


def fold_viterbi(n: Column, edges: Column, penalty: float) -> Column:
    """(start, id) of the pieces of the best path of a unigram model, the last first; id -1 for a character without piece.

    The fold goes over the end positions and keeps for each the best score so far, its last piece and its start.
    """
    def best(paths, e):
        arriving = F.transform(F.filter(edges, lambda x: x["e"] == e), lambda x: F.struct((F.get(paths, x["s"])["score"] - x["rank"]).alias("score"), x["s"].alias("s"), x["id"].alias("id")))
        bare = F.array(F.struct((F.get(paths, e - 1)["score"] - penalty).alias("score"), (e - 1).alias("s"), F.lit(-1).alias("id")))
        single = F.exists(edges, lambda x: (x["e"] == e) & (x["s"] == e - 1))
        return F.concat(paths, F.array(F.array_max(F.when(single, arriving).otherwise(F.concat(arriving, bare)))))

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("s"), F.lit(-1).alias("id")))
    paths = F.aggregate(F.sequence(F.lit(1), n), first, best)
    return paths


def _ids_of_bytes(char: Column, bytes_from: int) -> Column:
    code = F.hex(F.encode(char, "UTF-8"))
    return F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda i: (F.conv(F.substring(code, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + bytes_from))


def merged(n: int, edges: dict[tuple[int, int], tuple[float, int]]) -> list[tuple[int, int]]:
    """(start, end) of the pieces after all merges of a byte-pair model; ``edges``: (rank, id) by (start, end)."""
    stop, begin, alive = list(range(1, n + 1)), list(range(-1, n)), [True] * n
    heap = [(edges[s, s + 2][0], s, s + 1, s + 2) for s in range(n - 1) if (s, s + 2) in edges]
    heapq.heapify(heap)
    while heap:
        _, s, m, e = heapq.heappop(heap)
        if not (alive[s] and alive[m] and stop[s] == m and stop[m] == e):
            continue
        stop[s], begin[e], alive[m] = e, s, False
        for x, y, z in [(begin[s], s, e)] * (s > 0) + ([(s, e, stop[e])] if e < n else []):
            if (x, z) in edges:
                heapq.heappush(heap, (edges[x, z][0], x, y, z))
    return [(s, stop[s]) for s in range(n) if alive[s]]


def best_path(n: int, edges: dict[tuple[int, int], tuple[float, int]], penalty: float) -> list[tuple[int, int]]:
    """(start, end) of the best path of a unigram model, see :func:`fold_viterbi`; a character without piece costs ``penalty``."""
    arriving = [[] for _ in range(n + 1)]
    for (s, e), (rank, i) in edges.items():
        arriving[e].append((s, rank, i))
    paths = [(0.0, 0, -1)]
    for e in range(1, n + 1):
        ways = [(paths[s][0] - rank, s, i) for s, rank, i in arriving[e]]
        if (e - 1, e) not in edges:
            ways.append((paths[e - 1][0] - penalty, e - 1, -1))
        paths.append(max(ways))
    out, e = [], n
    while e:
        out.append((paths[e][1], e))
        e = paths[e][1]
    return out[::-1]


def long_units(words: DataFrame, pieces: Pieces) -> DataFrame:
    """All columns of ``words`` with ``ids``, for units whose boundaries do not fit into a long.

    Their lattice comes from the same join: blocks of a unit, which overlap by the longest piece, are dealt out, and the
    edges that start in each meet by the unit's digest. The fold keeps them by boundary and takes time in proportion to them.
    """
    kept, least = words.columns, 2 if pieces.kind == "bpe" else 1
    named = words.withColumn("u", F.sha2("unit", 256))
    count = F.floor((F.length("unit") - 1) / _BLOCK).cast("int")
    block = F.transform(F.sequence(F.lit(0), count), lambda b: F.substring(F.col("unit"), b * _BLOCK + 1, F.lit(_BLOCK + max(pieces.longest, 1) - 1)))
    blocks = named.select("u", F.posexplode(block).alias("b", "text"))
    left = F.length("text") - F.col("s")
    starts = blocks.repartition("u", "b").select("u", "b", "text", F.explode(F.sequence(F.lit(0), F.least(F.lit(_BLOCK), F.length("text")) - 1)).alias("s"))
    subs = starts.filter(left >= least).select("u", (F.col("b") * _BLOCK + F.col("s")).alias("at"), F.explode(F.transform(F.sequence(F.lit(least), F.least(F.lit(max(least, pieces.longest)), left)), lambda k: F.substring(F.col("text"), F.col("s") + 1, k))).alias("piece"))
    found = subs.join(F.broadcast(pieces.table(words.sparkSession).filter("id is not null")), "piece")
    edges = found.groupBy("u").agg(F.collect_list(F.struct(F.col("at").alias("s"), (F.col("at") + F.length("piece")).alias("e"), (F.col("rank").cast("double") if pieces.kind == "bpe" else -F.col("score")).alias("rank"), "id")).alias("edges"))
    single = {p: i for p, i, _ in pieces.rows if len(p) == 1}
    kind, first, unknown = pieces.kind, pieces.bytes_from, pieces.unknown
    penalty = 10.0 - min((x for _, _, x in pieces.rows), default=0.0)

    def fold(batches):
        def ids(unit, given):
            s, e, rank, i = (x.to_pylist() for x in given.flatten()) if given is not None else ([],) * 4
            known = dict(zip(zip(s, e), zip(rank, i)))
            out = []
            for x, y in merged(len(unit), known) if kind == "bpe" else best_path(len(unit), known, penalty):
                if (x, y) in known:
                    out.append(known[x, y][1])
                elif unit[x:y] in single:
                    out.append(single[unit[x:y]])
                else:
                    out += [unknown] if first is None else [first + c for c in unit[x:y].encode()]
            return out

        for b in batches:
            given = b.column("edges")
            got = [ids(u, given[k].values if given[k].is_valid else None) for k, u in enumerate(b.column("unit").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(got, pa.list_(pa.int32()))], [*kept, "ids"])

    kinds = ", ".join(f"{k} {t}" for k, t in words.dtypes)
    return named.join(edges, "u", "left").select(*kept, "edges").mapInArrow(fold, f"{kinds}, ids array<int>")


def encode_units(words: DataFrame, pieces: Pieces) -> DataFrame:
    """All columns of ``words`` (staged: ``unit``, distinct and not empty, and others) with ``ids``.

    Units up to ``_BITS`` characters are folded over the lattice by expressions, longer ones by :func:`long_units`.
    """
    return short_units(words.filter(F.length("unit") <= _BITS), pieces).unionByName(long_units(words.filter(F.length("unit") > _BITS), pieces))


def short_units(words: DataFrame, pieces: Pieces, dealt: bool = False) -> DataFrame:
    """All columns of ``words`` with ``ids``, for units of ``_BITS`` characters at most; ``dealt``: see :func:`lattice`."""
    kept, short = words.columns, lattice(words, pieces, dealt)
    none = lambda char: _ids_of_bytes(char, pieces.bytes_from) if pieces.bytes_from is not None else F.array(F.lit(pieces.unknown))
    single = {ord(p): i for p, i, _ in pieces.rows if len(p) == 1}
    codes = F.split(F.lit(",".join(str(single.get(c, -1)) for c in range(1 + max(single, default=0)))), ",").cast("array<int>")
    one = lambda s: _let(F.substring(F.col("unit"), s + 1, F.lit(1)), lambda char: _let(F.get(codes, F.ascii(char)), lambda i: F.when(i >= 0, F.array(i)).otherwise(none(char))))
    if pieces.kind == "bpe":
        n = F.col("n")
        left = lambda b, x: b.bitwiseAND(x["ends"].bitwiseOR(x["inner"])) == x["ends"]
        many = lambda b: F.transform(F.filter("edges", lambda x: left(b, x)), lambda x: F.shiftleft(F.shiftright(x["key"], _START).bitwiseAND(63), _LATE).bitwiseOR(x["key"].bitwiseAND(_ID)))
        alone = lambda b: F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda p: b.bitwiseAND(3 * _bit(p)) == 3 * _bit(p)), lambda p: F.shiftleft(p.cast("long"), _LATE).bitwiseOR(F.lit(_ID)))
        every = lambda b: F.when(b.bitwiseAND(F.shiftright(b, 1)) == 0, many(b)).otherwise(F.concat(many(b), alone(b)))
        of = lambda x: F.when(x.bitwiseAND(_ID) != _ID, F.array(x.bitwiseAND(_ID).cast("int"))).otherwise(one(F.shiftright(x, _LATE).cast("int")))
        ids = _let(fold_merges(n, F.col("edges")), lambda b: F.flatten(F.transform(F.sort_array(every(b)), of)))
        return short.select(*kept, ids.alias("ids"))
    lowest = min(s for _, _, s in pieces.rows)
    paths = short.select(*kept, "n", fold_viterbi(F.col("n"), F.col("edges"), 10.0 - lowest).alias("paths"))
    start = F.struct(F.col("n").alias("at"), F.array().cast("array<struct<s:int,id:int>>").alias("found"))
    back = lambda a, p: F.when(p == a["at"], F.struct(F.get("paths", p)["s"].alias("at"), F.concat(F.array(F.struct(F.get("paths", p)["s"].alias("s"), F.when(F.get("paths", p)["id"] >= 0, F.get("paths", p)["id"]).alias("id"))), a["found"]).alias("found"))).otherwise(a)
    found = paths.select(*kept, F.aggregate(F.reverse(F.sequence(F.lit(1), F.col("n"))), start, back)["found"].alias("found"))
    ids = F.flatten(F.transform("found", lambda x: F.when(x["id"].isNotNull(), F.array(x["id"])).otherwise(one(x["s"]))))
    return found.select(*kept, ids.alias("ids"))


def frequent(counted: DataFrame, most: int) -> Column:
    """Whether a unit is among the most frequent ones, at most ``most``, by levels of ``count``."""
    level = F.floor(4 * F.log2("count"))
    sizes = counted.groupBy(level.alias("least")).agg(F.count("*").alias("n")).orderBy(F.desc("least")).collect()
    least, total = 4 * 64, 0
    for r in sizes:
        total += r["n"]
        if total > most:
            break
        least = r["least"]
    return level >= least


#: The latest vocabulary of a Python worker, by name.
_vocabularies: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Frequent units of texts, numbered from 1, the most frequent first: ``numbers`` by unit, and the ids of each.

    ``shared``: their Arrow table (``unit, ids``), broadcast; a worker prepares it once.
    """

    def __init__(self, known: pa.Table):
        units, ids = known.column("unit").combine_chunks(), known.column("ids").combine_chunks()
        self.numbers = dict(zip(units.to_pylist(), range(1, len(units) + 1)))
        self.sizes = np.r_[0, pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False)].astype(np.int64)
        self.begins, self.ids = np.cumsum(self.sizes) - self.sizes, ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)

    @staticmethod
    def of(shared, name: str) -> "Vocabulary":
        if name not in _vocabularies:
            _vocabularies.clear()
            _vocabularies[name] = Vocabulary(shared.value)
        return _vocabularies[name]


def pack(numbers: np.ndarray) -> bytes:
    """Numbers of units, most of them below 65,535, compressed by planes of bytes."""
    low = np.minimum(numbers, 65535).astype("<u2")
    more = numbers[numbers >= 65535].astype("<u4")
    return _packer.compress(low.view(np.uint8).reshape(-1, 2).T.tobytes() + more.tobytes())


def unpack(packed: bytes, n: int) -> np.ndarray:
    got = np.frombuffer(_unpacker.decompress(packed), np.uint8)
    numbers = got[:n] + got[n : 2 * n].astype(np.int64) * 256
    numbers[numbers == 65535] = got[2 * n :].view("<u4")
    return numbers


_packer, _unpacker = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


class _Numbers(dict):
    """Numbers of a cut's units as bytes, found when a cut is first asked for; ``odd``: cuts' rare units."""

    def __init__(self, cutter: Cutter, numbers: dict[str, int]):
        self.cutter, self.numbers, self.odd = cutter, numbers, {}

    def __missing__(self, cut: str) -> bytes:
        units = self.cutter.units(cut)
        if more := [u for u in units if u not in self.numbers]:
            self.odd[cut] = more
        self[cut] = got = array("I", [self.numbers.get(u, 0) for u in units]).tobytes()
        return got

    def of(self, cuts: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, cuts)), np.uint32)


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=8).digest()


def _one(*values, names: list[str]) -> pa.RecordBatch:
    """A row; each value is a number, bytes, or an array that becomes a list."""
    listed = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
    return pa.RecordBatch.from_arrays([listed(v) if isinstance(v, pa.Array) else pa.array([v]) for v in values], names)


def _numbered(cutter: Cutter, shared, name: str):
    """A row for each batch of texts: their numbers of units together, 0 for a rare one, and each distinct rare unit once."""

    def run(batches):
        kept, b = _Numbers(cutter, Vocabulary.of(shared, name).numbers), TaskContext.get().partitionId() << _BATCHES
        odd, last = kept.odd, b + (1 << _BATCHES)
        for batch, texts in slices(batches, _BATCH):
            cuts = [cutter.cuts(text) for text in texts]
            got, rare = [kept.of(own) for own in cuts], {}
            place = [rare.setdefault(u, len(rare)) for own in cuts for cut in own if cut in odd for u in odd[cut]]
            if b == last or b >> 38 or len(rare) >> _PLACES:
                raise ValueError("too many batches, or rare units in one text, for their bits")
            n = pa.array([len(x) for x in got], pa.int32())
            th = pa.array(np.frombuffer(b"".join(_digest(t.encode()) for t in texts), np.int64))
            yield _one(b, batch.column("doc_id"), n, th, pack(np.concatenate(got)), pack(np.array(place, np.uint32)), pa.array(rare, pa.string()), names=["b", "doc_id", "n", "th", "zip", "place", "rare"])
            b += 1
            if len(kept) > _MOST_CUTS:
                kept.clear()
                odd.clear()

    return run


def _rare_units(longer: bool):
    """``at, unit`` of the rare units of batches, those up to ``_BITS`` characters or the longer ones."""

    def run(batches):
        for batch in batches:
            lists = batch.column("rare")
            sizes = pa.compute.list_value_length(lists).to_numpy()
            first, units = np.cumsum(sizes) - sizes, lists.flatten()
            at = np.repeat((batch.column("b").to_numpy() << _PLACES) - first, sizes) + np.arange(len(units))
            fits = pa.compute.less_equal(pa.compute.utf8_length(units), _BITS)
            own = pa.RecordBatch.from_arrays([pa.array(at), units], ["at", "unit"])
            yield own.filter(pa.compute.invert(fits) if longer else fits)

    return run


def _put_together(shared, name: str, code: list[bytes] | None, names: list[str]):
    """``doc_id, ids`` of a batch from :func:`_numbered` and the ids of its rare units, or ``names``, the columns that
    :func:`op7_sentence_pieces` returns. With ``code`` (bytes by id) the ids are put into bytes and compared with the text."""

    def run(batches: pa.Table, found: pa.Table) -> pa.Table:
        known, out = Vocabulary.of(shared, name), []
        for b in batches.combine_chunks().to_batches():
            for k in range(len(b)):
                doc_id, n, th = (b.column(c)[k].values for c in ("doc_id", "n", "th"))
                n = n.to_numpy().astype(np.int64)
                number, first, ids = unpack(b.column("zip")[k].as_py(), int(n.sum())), np.cumsum(n) - n, known.ids
                size, begin = known.sizes[number], known.begins[number]
                rare = np.flatnonzero(number == 0)
                if len(rare):
                    place, more = found.column("place").to_numpy(), found.column("ids").combine_chunks()
                    own, own_begin = (np.zeros(place.max(initial=-1) + 1, np.int64) for _ in range(2))
                    own[place] = lengths = pa.compute.list_value_length(more).to_numpy()
                    own_begin[place] = len(ids) + np.cumsum(lengths) - lengths
                    which = unpack(b.column("place")[k].as_py(), len(rare))
                    if which.max() >= len(own):
                        raise RuntimeError("a unit has no ids")
                    size[rare], begin[rare] = own[which], own_begin[which]
                    ids = np.concatenate([ids, more.flatten().to_numpy()])
                if not size.all():
                    raise RuntimeError("a unit has no ids")
                ends = np.r_[0, np.cumsum(size)]
                inside = np.arange(ends[-1]) - np.repeat(ends[:-1], size)
                ids = ids[np.repeat(begin, size) + inside]
                cuts = ends[np.r_[first, n.sum()]]
                row = [doc_id, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))]
                same = np.ones(len(n), bool)
                if code is not None:
                    every, at = ids.tolist(), cuts.tolist()
                    texts = (b"".join(map(code.__getitem__, every[x:y])) for x, y in zip(at[:-1], at[1:]))
                    same = np.frombuffer(b"".join(_digest(t[t[:1] == b" " :]) for t in texts), np.int64) == th.to_numpy()
                if len(names) > 2:
                    weight = np.add.reduceat((inside + 1) * (ids + 1), ends[:-1]) if len(ids) else inside
                    checks = np.r_[0, np.cumsum((np.arange(len(number)) - np.repeat(first, n) + 1) * (weight % _MODULUS) % _MODULUS)]
                    row += [pa.array(n), pa.array(np.diff(cuts), pa.int64()), pa.array((checks[first + n] - checks[first]) % _MODULUS), pa.array(same)]
                elif not same.all():
                    raise RuntimeError("ids do not give their text: the rows of a partition changed when it was made again")
                out.append(pa.RecordBatch.from_arrays(row, names))
        return pa.Table.from_batches(out)

    return run


def encoded(df: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = _MOST_BROADCAST, checks: bool = False) -> DataFrame:
    """``doc_id, ids`` of each row (see :func:`encode`) and with ``checks`` the columns that :func:`op7_sentence_pieces` derives.

    Units that are frequent in ``_COUNTED`` documents are broadcast with their ids; which ones these are changes the plan, not
    the result. Every text is then cut once, and batches of texts are shuffled as the numbers of their units. A batch's other
    units are named by it and their place in its list; each distinct one meets its ids by unit, and these go to the batch. One
    shuffle of the batches serves both sides. Batches are named by partition, so ids are compared with their texts at the end.
    """
    cutter, spark = Cutter(pieces), df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = documents(df, id_col, text_col).withColumn("text", F.replace("text", F.lit(_MARK), F.lit(_SPACE)))
    rows = docs.count()
    some = docs.sample(_COUNTED / rows, seed=1) if rows > _COUNTED else docs
    counted = stage(some.select("text").mapInArrow(_counts(cutter), "unit string, count long").groupBy("unit").agg(F.sum("count").alias("count")))
    often = stage(encode_units(counted.filter(frequent(counted, most_broadcast)), pieces))
    common = often.toArrow().sort_by([("count", "descending")]).select(["unit", "ids"])
    shared, name = spark.sparkContext.broadcast(common), uuid.uuid4().hex
    batches = docs.mapInArrow(_numbered(cutter, shared, name), "b long, doc_id array<long>, n array<int>, th array<long>, zip binary, place binary, rare array<string>").repartition(parts, "b")

    def found(longer: bool) -> DataFrame:
        # both sides of the join read all columns of one shuffle, so it is made once
        rare = batches.mapInArrow(_rare_units(longer), "at long not null, unit string not null").repartition(parts, "unit")
        units = rare.groupBy("unit").agg(F.min("at").alias("first")).filter("first >= 0").select("unit")
        ids = long_units(units, pieces) if longer else short_units(units, pieces, dealt=True)
        at = rare.join(ids, "unit")
        return at.select(F.shiftright("at", _PLACES).alias("b"), F.col("at").bitwiseAND((1 << _PLACES) - 1).cast("int").alias("place"), "ids")

    columns = {"doc_id": "long", "ids": "array<int>"} | ({"n_units": "long", "n_pieces": "long", "ids_check": "long", "decodes": "boolean"} if checks else {})
    code = pieces.code() if checks or pieces.bytes_from is not None else None
    both = found(False).unionByName(found(True)).repartition(parts, "b")
    together = batches.groupBy("b").cogroup(both.groupBy("b"))
    return together.applyInArrow(_put_together(shared, name, code, list(columns)), ", ".join(f"{c} {t}" for c, t in columns.items()))


def encode(df: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of each row of ``df``: the ids that the sentencepiece library gives.

    For models that leave characters as they are and put a space before the text, as the byte-pair models with byte
    fallback do. Each distinct unit of text is encoded once. Null and empty texts have no ids. A null id stays null.
    Repeated rows are rows of their own. An empty table gives an empty result. Other columns are ignored.
    """
    return encoded(df, Pieces.of_model(model), id_col, text_col).select("doc_id", "ids")


def decoded(ids: Column, pieces: Pieces, lead: bool = True) -> Column:
    """Text of ``ids``: the UTF-8 bytes of the pieces, looked up by position, put together; with ``lead`` the space before
    the text is taken off. Ids without text (control pieces) give none."""
    size = 1 + max([i for _, i, _ in pieces.rows] + [(pieces.bytes_from or 0) + 255])
    code = [""] * size
    for p, i, _ in pieces.rows:
        code[i] = p.encode().hex()
    if pieces.bytes_from is not None:
        code[pieces.bytes_from : pieces.bytes_from + 256] = [f"{b:02x}" for b in range(256)]
    table_of = F.split(F.lit(",".join(code)), ",")
    text = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table_of, i)), "")), "UTF-8")
    return F.regexp_replace(text, "^ ", "") if lead else text


def op7_sentence_pieces(spark: SparkSession, sf_dir: str, most_broadcast: int = _MOST_BROADCAST) -> DataFrame:
    """``doc_id, n_units, n_pieces, ids_check, decodes, ids`` of all documents, derived from the ids that :func:`encoded` gives.

    ``ids_check`` sums, over a document's units, (place + 1) times the sum of (k + 1) * (id + 1) over the unit's ids,
    modulo 1,000,000,007: it depends on every id and its place. ``decodes``: the ids give the text (with spaces for marks).
    The given model is a byte-pair model, so :func:`fold_merges` folds the lattice, not :func:`fold_viterbi`. Null texts are
    empty. Rows that repeat an id are rows of their own.
    """
    import public_tokenizers

    pieces = Pieces.of_model(public_tokenizers.path("piece_bpe_32k.model"))
    done = encoded(table(spark, sf_dir, "documents"), pieces, most_broadcast=most_broadcast, checks=True)
    return done.select("doc_id", "n_units", "n_pieces", "ids_check", "decodes", "ids")


QUERIES = {"op7_sentence_pieces": op7_sentence_pieces}
