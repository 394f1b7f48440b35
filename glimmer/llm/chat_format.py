"""Chat formatting in windows of a token budget."""

import hashlib
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import stage, table
from glimmer.llm._tokenize import encoder, slices

#: What begins a turn, parts its role from its text, and ends it.
HEAD, COLON, END = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>|: ")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
_UNIT = r"(?:\\(?:\\|###|</turn>|: )|[^\\])*?"
_TURN = re.compile(f"{HEAD}({_UNIT}){COLON}({_UNIT}){END}", re.DOTALL)

_WINDOW = "conv_id long, window int, text string, loss array<struct<begin: int, end: int>>, n_tokens long, n_kept int, n_turns int"
_WINDOW_KIND = pa.schema([("conv_id", pa.int64()), ("window", pa.int32()), ("text", pa.string()), ("loss", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), ("n_tokens", pa.int64()), ("n_kept", pa.int32()), ("n_turns", pa.int32())])


def escape(text: str) -> str:
    """``text`` with a backslash before every control string and backslash, so that none of them can act in it."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def format_chats(df: DataFrame, tokenizer: str, *, budget: int = 2048, history_turns: int = 4, history_share: float = 0.25) -> DataFrame:
    """Windows over the conversations of ``df`` (``conv_id, turn, role, text``): ``conv_id, window, text, loss, n_tokens,
    n_kept, n_turns``.

    Turns are escaped, marked and counted in tokens where they lie. Prefix sums of these counts choose turn-aligned
    spans: a window takes new turns as long as the budget holds them after what it repeats, and at least one, so a
    single turn over the budget makes a window of its own. Each window but the first repeats the leading system turn
    and at most the last ``history_turns`` turns before it, as far as they fit into ``history_share`` of the budget.
    ``n_kept`` repeated turns come first, ``n_turns`` new ones follow. ``loss`` marks the texts of new assistant turns
    only (code points of ``text``): a repeated target is masked, so each target counts once.

    Turns are in order of ``turn`` (null first), then role and text. Null text and null role are empty. A null id is a
    conversation of its own. Repeated rows are turns of their own. An empty table gives an empty result. A conversation
    passes through one task as a sorted stream; no more than one window and its history are in memory.
    """
    chats = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def mark(batches):
        enc = encoder(tokenizer)
        for part, texts in slices(batches):
            heads = [f"{HEAD}{escape(r)}{COLON}" for r in part.column("role").to_pylist()]
            marked = [f"{h}{escape(t)}{END}" for h, t in zip(heads, texts, strict=True)]
            counts = pa.array([len(i) // 4 for i in enc.ids(marked)], pa.int64())
            whole = [part.column(c) for c in ("conv_id", "turn", "role")]
            yield pa.RecordBatch.from_arrays([*whole, pa.array(marked, pa.string()), pa.array([len(h) for h in heads], pa.int32()), counts], ["conv_id", "turn", "role", "marked", "head", "n_tokens"])

    marked = chats.mapInArrow(mark, "conv_id long, turn long, role string, marked string, head int, n_tokens long")
    keys = ["conv_id", "turn", "role", "marked"]
    dealt = marked.repartition("conv_id").sortWithinPartitions(*keys)

    def windows(batches):
        rows = (r for b in batches for r in b.to_pylist())
        done: list[dict] = []
        for w in spans(rows, budget, history_turns, int(budget * history_share)):
            done.append(w)
            if len(done) >= 256:
                yield pa.RecordBatch.from_pylist(done, _WINDOW_KIND)
                done = []
        yield pa.RecordBatch.from_pylist(done, _WINDOW_KIND)

    return dealt.mapInArrow(windows, _WINDOW)


def spans(rows, budget: int, history_turns: int, history_budget: int):
    """Windows of turns that come sorted by conversation; see :func:`format_chats`."""
    begun, conv, number, system, history, new, total = False, None, 0, None, deque(), [], 0

    def repeated() -> list[dict]:
        kept, room = [], history_budget
        for r in reversed(history):
            if r["n_tokens"] > room:
                break
            room -= r["n_tokens"]
            kept.append(r)
        return [system] * (system is not None) + kept[::-1] if number else []

    def window() -> dict:
        text, loss, at = [], [], 0
        for k, r in enumerate(kept + new):
            if k >= len(kept) and r["role"] == "assistant":
                loss.append({"begin": at + r["head"], "end": at + len(r["marked"]) - len(END)})
            text.append(r["marked"])
            at += len(r["marked"])
        return {"conv_id": conv, "window": number, "text": "".join(text), "loss": loss, "n_tokens": total, "n_kept": len(kept), "n_turns": len(new)}

    kept: list[dict] = []
    for r in rows:
        if not begun or r["conv_id"] != conv:
            if new:
                yield window()
            begun, conv, number, system, history, new, kept, total = True, r["conv_id"], 0, None, deque(maxlen=history_turns), [], [], 0
        if new and total + r["n_tokens"] > budget:
            yield window()
            for x in new:
                if x is not system:
                    history.append(x)
            number, new = number + 1, []
            kept = repeated()
            total = sum(x["n_tokens"] for x in kept)
            while kept and total + r["n_tokens"] > budget:  # what is repeated gives way, the system turn last
                total -= kept.pop(1 if len(kept) > 1 and kept[0] is system else 0)["n_tokens"]
        if system is None and number == 0 and not new and r["role"] == "system":
            system = r
        new.append(r)
        total += r["n_tokens"]
    if new:
        yield window()


def read_chats(windows: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows`` of each conversation, from
    its windows alone: the turns that are new in each, and the text under the loss marks."""
    dealt = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")

    def read(batches):
        conv, state, out = None, None, []
        for w in (r for b in batches for r in b.to_pylist()):
            if state is None or w["conv_id"] != conv:
                if state is not None:
                    out.append(_closed(conv, state))
                conv, state = w["conv_id"], {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "loss_chars": 0, "chars": 0, "windows": 0}
            for role, text in parse(w["text"])[w["n_kept"] :]:
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["n"] += 1
            for m in w["loss"]:
                target = unescape(w["text"][m["begin"] : m["end"]])
                state["loss"].update(target.encode())
                state["loss_chars"] += len(target)
            state["chars"] += len(w["text"])
            state["windows"] += 1
        if state is not None:
            out.append(_closed(conv, state))
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return dealt.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")


def _closed(conv, s: dict) -> tuple:
    return conv, s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"], s["windows"]


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose turns hold control strings."""
    import public_tokenizers

    said = r"\### Assistant: </turn> ok"
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_chats(stage(format_chats(chats.unionByName(extra), public_tokenizers.path("word_bpe_49k.json"))))


QUERIES = {"op6_chat_format": op6_chat_format}
