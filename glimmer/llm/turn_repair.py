"""Repair of the turn structure of conversations at least cost, over an automaton of shared suffixes."""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glimmer.llm._common import SPACES, stage, table

#: The states of the grammar ``(s?(ua)+)?`` as what came last, the role that each lets follow by
#: insertion or a new role, and the roles' states.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEPT = {BEGIN: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEEP, _REROLE, _DELETE, _INSERT, _TRUNCATED = 0, 3, 4, 3, 3
_NEVER = 1 << 60


def damaged(chats: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by a checksum of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text,
    2 takes ``.!?`` out of it, 3 repeats the row, 4 sets its role to user. Nulls in these strings, roles and texts are a space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    role = F.when(F.col("code") == 4, F.lit("user")).otherwise(said("role"))
    text = F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    kept = chats.withColumn("code", code).filter("code <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), "code")
    return kept.withColumn("_copy", F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_copy", "code")


def marked(chats: DataFrame) -> DataFrame:
    """``conv_id, n, turn, role, text, fault, sign, pair``: rows in order of turn (null first), role and text, ``n`` from 1 on.

    ``fault``: the first of ``blank``, ``duplicate`` (role and text were there before) and ``truncated`` (the last character
    that is not white space is none of ``.!?``), or null. ``sign``: what repair needs to know of a row, in one letter: ``x``
    must go, else the initial of its role (``o``: none of ``s u a``), a capital if truncated. ``pair``: the initials of the
    row before and of this one. One exchange by conversation serves both windows, which sort and spill.
    """
    dealt = chats.repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    left = F.rtrim("text", F.lit(SPACES))
    fault = F.when(left == "", "blank").when(F.col("again"), "duplicate").when(~F.substring(left, -1, 1).isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    sign = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    numbered = dealt.withColumn("again", again).withColumns({"n": F.row_number().over(order), "before": F.lag(initial).over(order)})
    return numbered.withColumn("fault", fault).select("conv_id", "n", "turn", "role", "text", "fault", sign.alias("sign"), F.concat("before", initial).alias("pair"))


def plans(signs: DataFrame) -> DataFrame:
    """``signs, cost, audit`` of distinct strings of ``signs``: the least cost of edits after which the roles are
    ``(s?(ua)+)?``, and the least such string of edits in the order of their letters.

    A row is kept (K, free), gets another role (R, 3) or goes (D, 4, a must for ``x``); a row may be put in anywhere (I, 3);
    a truncated row that stays adds 3. The automaton's nodes are suffixes of the strings. Strings are dealt out by ranges of
    their reversal and sorted, so those that end alike are neighbours; a task holds the nodes of one path, and each node,
    with the cheapest way on from it in each state of the grammar, is worked out when the path first comes to it. Nodes of a
    path that two tasks share are worked out in both. Equal costs differ in the next letter, so a letter, not a string,
    decides, and a node takes the same room however long its suffix is.
    """
    n = int(signs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = signs.select("signs", F.reverse("signs").alias("back")).repartitionByRange(n, "back").sortWithinPartitions("back")

    def fold(batches):
        path, last = [_with_inserts({BEGIN: (0, "", None), ASSISTANT: (0, "", None)})], ""
        for b in batches:
            out = []
            for back in b.column("back").to_pylist():
                same = next((k for k, (x, y) in enumerate(zip(back, last)) if x != y), min(len(back), len(last)))
                del path[same + 1 :]
                for sign in back[same:]:
                    path.append(node(sign, path[-1]))
                last = back
                out.append((back[::-1], path[-1][BEGIN][0], walked(path)))
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)], ["signs", "cost", "audit"])

    return dealt.mapInArrow(fold, "signs string, cost long, audit string")


def node(sign: str, after: dict) -> dict:
    """For each state of the grammar (cost, first letter, state after it) of the best way through a row and the suffix
    ``after`` it."""
    extra = _TRUNCATED if sign.isupper() else 0
    found = {}
    for state in range(4):
        ways = [(_DELETE + after[state][0], "D", state)]
        if sign != "x":
            kept = _KEPT[state].get(sign.lower())
            if kept is not None:
                ways.append((_KEEP + extra + after[kept][0], "K", kept))
            ways.append((_REROLE + extra + after[_NEXT[state]][0], "R", _NEXT[state]))
        found[state] = min(ways)
    return _with_inserts(found)


def _with_inserts(found: dict) -> dict:
    """What may be put in before the row: two rows in a row may be worth it, a third one never is."""
    never = (_NEVER, "", None)
    out = {s: found.get(s, never) for s in range(4)}
    put = lambda s: (_INSERT + out[_NEXT[s]][0], "I", _NEXT[s])
    user = min(out[USER], put(USER))
    out[ASSISTANT] = min(out[ASSISTANT], put(ASSISTANT))
    out[USER] = user
    for s in (BEGIN, SYSTEM):
        out[s] = min(out[s], put(s))
    return out


def walked(path: list[dict]) -> str:
    """The letters of the best way from the last node of a path back to its first."""
    letters, at, state = [], len(path) - 1, BEGIN
    while True:
        _, letter, to = path[at][state]
        if not letter:
            return "".join(letters)
        letters.append(letter)
        at, state = at - (letter != "I"), to


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, signs, gaps, blank, duplicate, truncated, illegal`` of each conversation of rows from :func:`marked`."""
    count = lambda c: F.coalesce(F.count_if(c), F.lit(0)).cast("long")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    signs = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "sign"))), lambda x: x["sign"]), "")
    kinds = [count(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")]
    return rows.groupBy("conv_id").agg(signs.alias("signs"), gaps.alias("gaps"), *kinds, count(~F.col("pair").isin("su", "ua", "au")).alias("illegal"))


def repair_turns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(summary, repaired)`` of conversations ``df`` (``conv_id, turn, role, text``).

    ``summary``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` (see :func:`marked`, :func:`plans`;
    ``gaps``: turns missing between the first and the last; ``illegal``: neighbours whose initials are not su, ua or au).
    ``repaired``: ``conv_id, place, edit, role, text`` of the rows that are left or put in, in order of ``place`` within each
    partition; a conversation of which nothing is left has none.

    Texts and roles that are null count as a space. A null id is a conversation of its own. Repeated rows are duplicates. An
    empty table gives empty results. Other columns are ignored. A conversation passes through one task as a sorted stream;
    besides its letters, one a row, only one row is in memory.
    """
    said = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = stage(marked(df.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role"), said("text"))))
    found = stage(faults(rows))
    known = plans(found.select("signs").distinct())
    summary = stage(found.join(known, "signs").drop("signs"))
    heads = summary.select("conv_id", F.lit(0).alias("n"), F.lit("").alias("role"), F.col("audit").alias("text"))
    dealt = rows.select("conv_id", "n", "role", "text").unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "n")
    kind = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def edit(batches):
        conv, audit, at, place, state = None, "", 0, 0, BEGIN

        def put_in():
            nonlocal at, place, state
            while at < len(audit) and audit[at] == "I":
                state, at, place = _NEXT[state], at + 1, place + 1
                yield conv, place, "I", _ROLE[state], ""

        def repaired(batch):
            nonlocal conv, audit, at, place, state
            for c, n, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "n", "role", "text")), strict=True):
                if n == 0:
                    yield from put_in()
                    conv, audit, at, place, state = c, text, 0, 0, BEGIN
                    continue
                yield from put_in()
                letter, at = audit[at], at + 1
                if letter != "D":
                    state, place = _KEPT[state][role[0]] if letter == "K" else _NEXT[state], place + 1
                    yield conv, place, letter, role if letter == "K" else _ROLE[state], text

        for b in batches:
            yield _batch(repaired(b), kind)
        yield _batch(put_in(), kind)

    return summary, dealt.mapInArrow(edit, "conv_id long, place long, edit string, role string, text string")


def _batch(rows, kind: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kind)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of ``role:text`` of the rows, joined by line feeds, as they come."""
    kind = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def read(batches):
        conv, digest = None, None
        for b in batches:
            out = []
            for c, place, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "place", "role", "text")), strict=True):
                if place == 1:
                    if digest:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield _batch(out, kind)
        if digest:
            yield _batch([(conv, digest.hexdigest())], kind)

    return repaired.mapInArrow(read, "conv_id long, repaired_sha256 string")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired; one without rows after the damage has zeros, no edits and the hash of nothing."""
    chats = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    summary, repaired = repair_turns(damaged(chats))
    both = lambda a, b, how: a.join(b.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")), how).drop("_conv")
    rows = both(both(chats.select("conv_id").distinct(), summary, "left"), digests(repaired), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


QUERIES = {"op11_turn_repair": op11_turn_repair}
