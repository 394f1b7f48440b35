"""Two-base colour codes of gene sequences, as Spark column expressions."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Colours (from 1) of two-base keys.
STANDARD_3COLOR = {"AT": 3, "GT": 1, "TT": 2, "AG": 1, "GG": 2, "TG": 3, "AA": 2, "GA": 3, "TA": 1}
STANDARD_4COLOR = {
    "AA": 1, "CA": 2, "GA": 3, "TA": 4, "AC": 2, "CC": 1, "GC": 4, "TC": 3,
    "AG": 3, "CG": 4, "GG": 1, "TG": 2, "AT": 4, "CT": 3, "GT": 2, "TT": 1,
}
OMICS_SPECIAL = {"GC": 1, "GT": 2}

ERROR_LENGTH = "ERROR_LEN"


@dataclass(frozen=True)
class Segment:
    """A part of the sequence (1-based, inclusive) that one encoding table turns into colours of some rounds."""

    id: str
    rounds: tuple[int, ...]
    start: int
    end: int
    table: dict[str, int] = field(hash=False)
    anchors: tuple[str, ...] = ()
    base_index: int = 1


def oriented(seq: Column, how: str = "none") -> Column:
    if how not in ("none", "reverse_string"):
        raise ValueError(f"unknown orientation {how}")
    return F.reverse(seq) if how == "reverse_string" else seq


def sliced(seq: Column, start: int, end: int) -> Column:
    """Bases ``start`` to ``end`` (a start of 0 counts as 1); ``ERROR_LEN`` if the sequence is shorter."""
    first = max(start, 1)
    return F.when(F.length(seq) >= end, F.substring(seq, first, end - first + 1)).otherwise(ERROR_LENGTH)


def _lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def slide_encoded(seq: Column, table: dict[str, int], base_index: int = 1) -> Column:
    """One colour for each step of a window as wide as the table's keys, ``.`` for unknown keys; a sequence shorter than
    the window gives one ``.`` a base."""
    width = len(next(iter(table)))
    colour = {k: str(v - base_index) for k, v in table.items()}
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.length(seq) - width + 1, F.lit(1))), lambda i: F.coalesce(_lookup(colour, F.substring(seq, i, F.lit(width))), F.lit(".")))
    return F.when(F.length(seq) < width, F.repeat(F.lit("."), F.length(seq))).otherwise(F.array_join(steps, ""))


def assembled(seq: Column, segments: list[Segment], order: list[str]) -> Column:
    """The barcode: codes of the segments in ``order``; ``ERROR_LEN`` if any segment is out of the sequence."""
    by = {s.id: s for s in segments}
    if missing := [x for x in order if x not in by]:
        raise ValueError(f"undefined segments {missing}")
    rounds = [r for x in order for r in by[x].rounds]
    if rounds != sorted(rounds):
        raise ValueError("rounds of the ordered segments must ascend")
    parts = {x: sliced(seq, by[x].start, by[x].end) for x in order}
    failed = F.lit(False)
    for p in parts.values():
        failed = failed | (p == ERROR_LENGTH)
    return F.when(failed, ERROR_LENGTH).otherwise(F.concat(*[slide_encoded(parts[x], by[x].table, by[x].base_index) for x in order]))


def compile_codebook(genes: DataFrame, segments: list[Segment], order: list[str], orientation: str = "none") -> DataFrame:
    """``code_ix, barcode, gene`` of ``genes`` (``code_ix, gene, seq``): sequences out of range are dropped; of genes with
    one barcode the last wins, at the place of the first."""
    coded = genes.select("code_ix", "gene", assembled(oriented(F.col("seq"), orientation), segments, order).alias("barcode"))
    return coded.filter(F.col("barcode") != ERROR_LENGTH).groupBy("barcode").agg(F.max_by("gene", "code_ix").alias("gene"), F.min("code_ix").alias("code_ix")).select("code_ix", "barcode", "gene")


def digit_codebook(codebook: DataFrame) -> DataFrame:
    """The codes of digits only that are as long as the first code."""
    first = codebook.agg(F.length(F.min_by("barcode", "code_ix")).alias("n"))
    return codebook.join(F.broadcast(first), F.length("barcode") == F.col("n")).filter(F.col("barcode").rlike("^[0-9]+$")).drop("n")


def reverse_lookup(table: dict[str, int], base_index: int = 1) -> dict[str, str]:
    """``{previous base + colour: next base}``; keys of other than two bases are skipped, conflicts are errors."""
    out: dict[str, str] = {}
    for key, colour in table.items():
        if len(key) == 2 and out.setdefault(f"{key[0]}{colour - base_index}", key[1]) != key[1]:
            raise ValueError(f"colour {colour} after {key[0]} has two next bases")
    return out


def colours_decoded(code: Column, start: str, table: dict[str, int], base_index: int = 1) -> Column:
    """Bases that the colours lead to from ``start``, itself included; empty if the code is, or if any step is undefined."""
    back = reverse_lookup(table, base_index)
    step = lambda acc, c: F.concat(acc, _lookup(back, F.concat(F.substring(acc, -1, 1), c)))
    return F.when(F.coalesce(code, F.lit("")) == "", "").otherwise(F.coalesce(F.aggregate(F.split(code, ""), F.lit(start), step), F.lit("")))


def ends_hold(barcode: Column, segments: list[Segment], order: list[str]) -> Column:
    """Whether each ordered segment with two anchors decodes from the first and ends in the second."""
    by, at, ok = {s.id: s for s in segments}, 1, F.lit(True)
    for x in order:
        s = by[x]
        n = len(s.rounds)
        if len(s.anchors) == 2:
            bases = colours_decoded(F.substring(barcode, at, n), s.anchors[0], s.table, s.base_index)
            ok = ok & (F.substring(bases, -1, 1) == s.anchors[1])
        at += n
    return ok
