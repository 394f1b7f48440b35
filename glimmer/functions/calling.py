"""Base calls from the intensities of a spot (``array<array<double>>``: rounds of channels), as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-6


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def l2_normalised(matrix: Column) -> Column:
    """Each round divided by its Euclidean norm plus 1e-6."""
    norm = lambda r: F.sqrt(_total(F.transform(r, lambda x: x * x))) + EPSILON
    return F.transform(matrix, lambda r: let(norm(r), lambda n: F.transform(r, lambda x: x / n)))


def biased(matrix: Column, bias: dict[int, list[float]], n_channels: int) -> Column:
    """Rounds (from 0) plus their channel bias, at least 0, normalised again (a norm up to 1e-6 counts as 1). Without any
    bias the matrix stays as it is; with one, all rounds are normalised again."""
    if any(len(b) != n_channels for b in bias.values()):
        raise ValueError("a bias needs one value for each channel")
    if not bias:
        return matrix
    zero = F.array(*[F.lit(0.0)] * n_channels)
    table = F.create_map(*[x for k, b in bias.items() for x in (F.lit(k), F.array(*[F.lit(float(v)) for v in b]))])
    moved = F.transform(matrix, lambda r, i: F.zip_with(r, F.coalesce(F.try_element_at(table, i), zero), lambda x, b: F.greatest(x + b, F.lit(0.0))))
    norm = lambda r: F.sqrt(_total(F.transform(r, lambda x: x * x)))
    safe = lambda r: F.when(norm(r) > EPSILON, norm(r)).otherwise(1.0)
    return F.transform(moved, lambda r: F.zip_with(r, F.array_repeat(safe(r), F.size(r)), lambda x, n: x / n))


def softmax(matrix: Column, temperature: float = 1.0) -> Column:
    raised = lambda r: let(F.array_max(r), lambda top: F.transform(r, lambda x: F.exp((x - top) / temperature)))
    shares = lambda e: let(_total(e), lambda total: F.transform(e, lambda x: x / total))
    return F.transform(matrix, lambda r: let(raised(r), shares))


def rounds(matrix: Column) -> Column:
    """``call, score, margin`` of each round. ``call``: the channel (from 0) of the largest value, -1 for a tie; ``score``: -ln of
    that value, null (not valid) for a tie or a largest value of 0; ``margin``: the largest value less the second."""
    def of(r, ranked):
        top, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
        single = F.coalesce(top != second, top.isNotNull())
        return F.struct(
            F.when(single, F.array_position(r, top).cast("int") - 1).otherwise(-1).alias("call"),
            F.when(single & (top > 0), -F.ln(top)).alias("score"),
            (top - F.coalesce(second, F.lit(0.0))).alias("margin"),
        )

    return F.transform(matrix, lambda r: let(F.sort_array(r, asc=False), lambda ranked: of(r, ranked)))


def calls(matrix: Column) -> Column:
    return F.transform(rounds(matrix), lambda x: x["call"])


def scores(matrix: Column) -> Column:
    return F.transform(rounds(matrix), lambda x: x["score"])


def all_valid(score: Column) -> Column:
    return ~F.exists(score, lambda x: x.isNull())


def mean(values: Column) -> Column:
    """The mean of an array without nulls; null if it is empty or has a null."""
    return F.try_divide(_total(values), F.size(values))


def margins(matrix: Column) -> Column:
    return F.transform(rounds(matrix), lambda x: x["margin"])


def barcode(call: Column) -> Column:
    return F.array_join(F.transform(call, lambda c: c.cast("string")), "")


def largest(matrix: Column) -> Column:
    return F.array_max(F.transform(matrix, lambda r: F.array_max(r)))
