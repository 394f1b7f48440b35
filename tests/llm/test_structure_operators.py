"""Turn repair, token alignment and factor dedup against brute force, on whole small tables and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from glimmer.llm import factor_dedup, token_alignment, turn_repair

SF = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha(s: str | bytes) -> str:
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


# turn repair


def damage(rows):
    """Rows of one conversation after the damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def fault_of(rows):
    seen, found = set(), []
    for _, role, text in rows:
        left = text.rstrip(" \t\n\x0b\x0c\r")
        found.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def by_search(rows, faults):
    """(cost, audit, roles and texts) by trying all edits, whole strings compared, with up to three rows put in before each row."""
    table = {}

    def best(k, done, put):
        key = k, done, put
        if key not in table:
            ways = [(0, "", ())] if k == len(rows) and done in ("", "a") else []
            follow = {"": "su", "s": "u", "u": "a", "a": "u"}[done]

            def on(cost, letter, k2, initial, row, put2):
                c, audit, kept = best(k2, initial or done, put2)
                ways.append((cost + c, letter + audit, row + kept))

            if k < len(rows):
                _, role, text = rows[k]
                extra = 3 * (faults[k] == "truncated")
                on(4, "D", k + 1, "", (), 0)
                if faults[k] not in ("blank", "duplicate"):
                    if role[:1] and role[:1] in follow:
                        on(extra, "K", k + 1, role[0], ((role, text),), 0)
                    for new in ("user", "assistant"):
                        if new[0] in follow:
                            on(3 + extra, "R", k + 1, new[0], ((new, text),), 0)
            if put < 3:
                for new in ("user", "assistant"):
                    if new[0] in follow:
                        on(3, "I", k, new[0], ((new, ""),), put + 1)
            table[key] = min(ways, default=(10**9, "", ()))
        return table[key]

    return best(0, "", 0)


def wanted_repairs(rows):
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]].append(r)
    out = []
    for conv, own in convs.items():
        after = damage(own)
        faults = fault_of(after)
        turns = [t for t, _, _ in after if t is not None]
        pairs = [(a[1][:1] + b[1][:1]) for a, b in itertools.pairwise(after)]
        cost, audit, kept = by_search(after, faults)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(k) for k in ("blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(f"{r}:{t}" for r, t in kept))))
    return sorted(out, key=str)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_turn_repair_of_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = turn_repair.op11_turn_repair(spark, SF).select(*NAMES).collect()
    assert sorted(map(tuple, got), key=str) == wanted_repairs(rows)


def test_turn_repair_of_odd_conversations(spark, tmp_path):
    rnd = random.Random(5)
    texts = ["Yes.", "No", "why?", "", " \t", None, "é !", "Yes.", "x" * 50_000]
    rows = [(c, rnd.choice([t, t, None, 3]), rnd.choice(["user", "assistant", "system", "tool", "", "unknown", "sys", None]), rnd.choice(texts)) for c in [*range(150), None] for t in range(rnd.randint(1, 9))]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"turn {t}.") for t in range(300)] + rows[:20]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as n", "'c' as sign", "2 as code", "0 as cost")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = turn_repair.op11_turn_repair(spark, str(tmp_path)).select(*NAMES).collect()
    assert sorted(map(tuple, got), key=str) == wanted_repairs(rows)
    df.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert turn_repair.op11_turn_repair(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("signs", ["", "x", "u", "a", "s", "ua", "sua", "oO", "AuUx", "uuaas", "xxsaaU", "AAAA"])
def test_a_node_decides_by_cost_and_letter(signs):
    path = [turn_repair._with_inserts({turn_repair.BEGIN: (0, "", None), turn_repair.ASSISTANT: (0, "", None)})]
    for s in reversed(signs):
        path.append(turn_repair.node(s, path[-1]))
    rows = [(0, {"o": "tool", "x": "user"}.get(s.lower(), s.lower()), "") for s in signs]
    faults = ["blank" if s == "x" else "truncated" if s.isupper() else None for s in signs]
    assert (path[-1][turn_repair.BEGIN][0], turn_repair.walked(path)) == by_search(rows, faults)[:2]


# token alignment


def aligned(texts):
    """For each text its groups, lists of the ids of both sides, from the libraries; None without tokens."""
    t, sp = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t.encode_special_tokens = True
    both = token_alignment.twin(BYTES, PIECES)
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        sizes = [[len(side[i]) for i in ids] for side, ids in ((both.bytes_a, a), (both.bytes_b, b))]
        if not all(b"".join(side[i] for i in ids) == (" " + text).encode() for side, ids in ((both.bytes_a, a), (both.bytes_b, b))):
            out.append(None)
            continue
        ends = [list(itertools.accumulate(s)) for s in sizes]
        cuts, groups, at = sorted(set(ends[0]) & set(ends[1])), [], 0
        for c in cuts:
            groups.append([[i for i, e in zip(ids, es) if at < e <= c] for ids, es in ((a, ends[0]), (b, ends[1]))])
            at = c
        out.append(groups)
    return out


def wanted_alignment(rows):
    groups = aligned([t for _, t in rows])
    links = [Counter((x, y) for a, b in g for x in a for y in b) if g else Counter() for g in groups]
    count = Counter(p for own in links for p in own)
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (i, _), g, own in zip(rows, groups, links):
        told = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g or [])
        out.append((i, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), own.total(), sum(n for p, n in own.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in own.items()), sha(told) if g else ""))
    return sorted(out, key=str)


ODD = ["a<|endoftext|>b </s> <s>", "don't I'll  x\n\n y \t z\t", "{ \r\n;\r\r x;\r", "▁a ▁▁b", " lead", "trail  ", "\n", " ", "東京 　é\xa0 x\xa0", "\x00 \x01", "🙂🙂 👨‍👩‍👧", "https://a.b/c?d=e&f", "=" * 300 + "\n" + "-" * 77, "ab" * 3000, "é" * 5000, "xy" * 2000 + "☃" * 999]


@pytest.mark.parametrize("most_broadcast", [300_000, 50])
def test_token_alignment(spark, odd, most_broadcast, monkeypatch):
    monkeypatch.setattr(token_alignment, "_MOST_LISTED", 50)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).select("doc_id", "text")
    more = spark.createDataFrame(list(enumerate(ODD, 10_000)), "doc_id long, text string")
    df = docs.unionByName(more).unionByName(odd.select("doc_id", "text"))
    rows = [tuple(r) for r in df.collect()]
    from glimmer.llm._common import stage

    found = stage(token_alignment.align(df, BYTES, PIECES))
    sums = {r.row: r for r in token_alignment.scored(found, token_alignment.linked_counts(found, 32_000), most_broadcast).collect()}
    got = []
    for r in found.collect():
        s = sums.get(r.row)
        got.append((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, s.n_best if s else 0, s.count_sum if s else 0, r.groups_sha256))
    assert sorted(got, key=str) == wanted_alignment(rows)


def test_token_alignment_query_and_no_rows(spark, none):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = token_alignment.op12_token_alignment(spark, SF).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == wanted_alignment(rows)
    assert token_alignment.align(none, BYTES, PIECES).count() == 0


def test_overlaps_are_all_pairs_that_share_bytes():
    rnd = random.Random(2)
    size = [[rnd.randint(1, 4) for _ in range(40)] for _ in range(2)]
    size[1].append(max(0, sum(size[0]) - sum(size[1])) or 1)
    size[0].append(sum(size[1]) - sum(size[0]) or 1)
    if sum(size[0]) != sum(size[1]):
        size[1][-1] += sum(size[0]) - sum(size[1])
    ends = [np.cumsum(s) for s in size]
    starts = [e - s for e, s in zip(ends, size)]
    a, b = token_alignment.overlaps(np.zeros(len(starts[0]), int), starts[0], np.zeros(len(starts[1]), int), starts[1])
    want = {(i, j) for i in range(len(starts[0])) for j in range(len(starts[1])) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]}
    assert Counter(zip(a.tolist(), b.tolist())) == Counter(want)


# factor dedup


def wanted_spans(rows, least, first):
    places, texts = defaultdict(list), [(t or "").encode() for _, t in rows]
    for k, t in enumerate(texts):
        for p in range(len(t) - least + 1):
            places[t[p : p + least]].append((k, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        for k, p in sorted(found)[first:] if first else found if len(found) > 1 else []:
            gone[k][p : p + least] = True
    out = []
    for (i, _), t, g in zip(rows, texts, gone):
        edge = np.flatnonzero(np.diff(np.r_[0, g.astype(int), 0]))
        out.append((i, len(t), bytes(np.frombuffer(t, np.uint8)[~g]), tuple(zip(edge[::2].tolist(), edge[1::2].tolist()))))
    return out


def collection(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abc é") for _ in range(rnd.randint(0, 120))) for _ in range(30)]
    return [(i, "".join(rnd.choice(base)[rnd.randint(0, 20) :] for _ in range(rnd.randint(0, 4)))) for i in range(150)]


def spans_by_row(df):
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept), tuple((x.begin, x.end) for x in r.spans)) for r in df.collect()), key=str)


@pytest.mark.parametrize(("least", "most_in_task"), [(40, 4096), (40, 1), (17, 4096), (3, 1)])
def test_bytes_of_repeated_strings_go(spark, odd, least, most_in_task):
    rows = collection(least)
    rows += [(500, "x" * 700), (501, None), (None, "x" * 300), (502, rows[7][1]), (7, rows[7][1]), (503, "ab" * 400), (504, ""), (504, "other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd, allowMissingColumns=True)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = spans_by_row(factor_dedup.dedup_factors(df, least_bytes=least, keep="none", most_in_task=most_in_task))
    assert got == sorted(wanted_spans(rows, least, 0), key=str)


@pytest.mark.parametrize("most_in_task", [4096, 1])
def test_first_copies_stay(spark, most_in_task):
    rows = collection(1) + [(200, "z" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spans_by_row(factor_dedup.dedup_factors(df, least_bytes=40, keep="first", most_in_task=most_in_task))
    assert got == sorted(wanted_spans(rows, 40, 1), key=str)
    twice = df.filter("doc_id = 200").unionByName(df.filter("doc_id = 200"))
    kept = sorted(len(r.kept) for r in factor_dedup.dedup_factors(twice, least_bytes=40).collect())
    assert kept == [0, 1]  # every later "z" starts a factor that starts one earlier too


def near_copies_of_one_text():
    """Texts of 400 characters, each with one of its own somewhere, and exact copies of some."""
    rnd = random.Random(5)
    base = [rnd.choice("abcdefgh ") for _ in range(400)]
    own = ["".join([*base[:k], chr(0x100 + i), *base[k + 1 :]]) for i, k in enumerate(rnd.sample(range(400), 120))]
    return list(enumerate([*own, *own[:40]]))


@pytest.mark.parametrize(("keep", "most_in_task"), [("none", 4), ("first", 4), ("none", 30), ("first", 30)])
def test_windows_of_hot_anchors_meet_by_parts(spark, keep, most_in_task, monkeypatch):
    rows, seen = near_copies_of_one_text(), []
    was = factor_dedup.named_spans
    monkeypatch.setattr(factor_dedup, "named_spans", lambda texts, *a: seen.append(texts) or was(texts, *a))
    hot, cut = [], factor_dedup.parts
    monkeypatch.setattr(factor_dedup, "parts", lambda texts, *a: hot.append(texts) or cut(texts, *a))
    got = spans_by_row(factor_dedup.dedup_factors(spark.createDataFrame(rows, "doc_id long, text string"), keep=keep, most_in_task=most_in_task))
    assert got == sorted(wanted_spans(rows, 200, keep == "first"), key=str)
    windows = sum(r.n for r in hot[0].collect())
    named = sum(r.n for r in seen[0].collect())
    assert cut(hot[0], 200).count() * 6 < windows and named * (1 if most_in_task == 4 else 6) < windows


def test_factor_dedup_of_all_documents(spark, none):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, n - len(kept), len(spans), sha(kept)) for i, n, kept, spans in wanted_spans(rows, 200, 0)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in factor_dedup.op13_factor_dedup(spark, SF).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 0
    assert factor_dedup.dedup_factors(none).count() == 0


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(factor_dedup, "_CHUNK", 1000)
    rnd = random.Random(4)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(7000))
    for rows in (list(enumerate([long, long[3000:5000], long[6900:]])),):
        parts = list(factor_dedup.chunked([(k, t.encode()) for k, t in rows], 200))
        starts = Counter()
        for data, valid, owners in parts:
            for row, place, begin in owners:
                part = min([p for _, p, _ in owners if p > place], default=len(data)) - place
                starts.update((row, begin + k) for k in range(part) if valid[place + k])
        assert starts == Counter((k, p) for k, t in rows for p in range(len(t) - 199))


def test_previous_and_next_smaller_places_give_the_longest_factor():
    rnd = random.Random(9)
    text = "".join(rnd.choice("ab") for _ in range(300))
    order = sorted(range(len(text)), key=lambda p: text[p:])
    common = lambda p, q: next((k for k in range(len(text)) if p + k >= len(text) or q + k >= len(text) or text[p + k] != text[q + k]), 0)
    lcp = np.array([0] + [common(p, q) for p, q in itertools.pairwise(order)])
    got = factor_dedup.nearest(np.array(order), lcp, 5)
    for p, n in zip(order, got):
        want = max((common(p, q) for q in range(p)), default=0)
        assert n == want or want < 5 and n < 5
