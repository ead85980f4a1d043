"""Conversation repair: against a search over all edit strings and a plain dynamic programme."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from cardlake.llm import conversation as C
from cardlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
BODY = re.compile("[\x20\x09-\x0D]+")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def best(rows):
    """(cost, audit, repaired rows) by Dijkstra over (cost, audit): the first final state popped is the answer."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, said, out = heapq.heappop(heap)
        if (i, said) in done:
            continue
        done.add((i, said))
        if i == len(rows) and said in ("", "a"):
            return cost, audit, out
        steps = [(2, "I", i, r[0], (*out, f"{r}:")) for r in ("user", "assistant") if (said, r[0]) in NEXT]
        if i < len(rows):
            role, text, fault = rows[i]
            steps.append((3, "D", i + 1, said, out))
            if fault in ("", "truncated"):
                more = fault == "truncated"
                if (said, role[:1]) in NEXT:
                    steps.append((more, "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                steps += [(2 + more, "R", i + 1, r[0], (*out, f"{r}:{text}")) for r in ("user", "assistant") if (said, r[0]) in NEXT]
        for c, letter, j, state, o in steps:
            heapq.heappush(heap, (cost + c, audit + letter, j, state, o))


def expected(rows, ids):
    """The reports of damaged ``rows``; conversations by Dijkstra."""
    out = {}
    for conv in ids:
        own = sorted((r for r in rows if r[0] == conv),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, graded, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            body = BODY.sub("", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] = counts.get(fault, 0) + 1
            graded.append((role, text, fault))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, repaired = best(graded)
        sha = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return out


def reports(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def random_rows(rnd, conversations, most):
    texts = ["Yes.", "no", "Why?", "", " \t", "So it is! ", "same text here.", "end\n", None]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "user", "assistant"]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rnd.randrange(most)):
            rows.append((conv, None if rnd.random() < .1 else turn * rnd.choice([1, 1, 1, 2]), rnd.choice(roles),
                         rnd.choice(texts) if rnd.random() < .5 else f"Text {rnd.randrange(10 ** 6)}."))
    rows += rows[:7]
    return rows


def test_steps_of_a_piece_run_again_only_until_they_agree():
    rnd = random.Random(1)
    ends = {C.END}
    for _ in range(300):
        codes = bytes(rnd.randrange(16) for _ in range(rnd.randrange(1, 60)))
        end = rnd.choice(sorted(ends))
        speculative = C.backward(codes, C.END)
        assert C.fix_up(codes, *speculative, end) == C.backward(codes, end)
        ends.add(C.backward(codes, end)[1])
    assert len(ends) < 100


@pytest.mark.parametrize("piece_bits", [1, 2, 14])
def test_repair_against_search(spark, piece_bits):
    rows = random_rows(random.Random(3), 60, 14)
    hot = random.Random(4)
    rows += [(1000, t, hot.choice(["user", "assistant", "tool"]), hot.choice(["a.", "b", f"{t}.", f"{t}!"])) for t in range(300)]
    rows += [(1001, 5, "user", "equal.")] * 40                        # equal rows over many pieces
    rows += [(1002, 0, "user", "x " * 500_000 + "."), (1002, 1, "assistant", "y")]
    clean = [tuple(" " if v is None and i > 1 else v for i, v in enumerate(r)) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = reports(C.repair_reports(df, piece_bits=piece_bits))
    assert got == expected(clean, {r[0] for r in rows})


def test_repaired_rows_are_what_the_digest_is_of(spark):
    rows = random_rows(random.Random(9), 25, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    kept = {}
    for r in sorted(C.repair_rows(df, piece_bits=2).collect(), key=lambda r: (r.conv is None, r.conv or 0, r.seq)):
        kept.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
        assert (r.edit == "I") <= (r.turn is None and r.text == "")
    for conv, report in reports(C.repair_reports(df)).items():
        assert hashlib.sha256("\n".join(kept.get(conv, [])).encode()).hexdigest() == report[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in kept.get(conv, [])))


def test_query_against_search(spark, tmp_path):
    rnd = random.Random(12)
    rows = random_rows(rnd, 80, 12) + [(5000 + i, None, "user", f"Alone {i}.") for i in range(60)]
    ids = {r[0] for r in rows}
    extra = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", conv string, kind int").repartition(3)
    extra.write.parquet(f"{tmp_path}/conversations.parquet")
    got = reports(QUERIES["op11_rank_viterbi"](spark, str(tmp_path)))
    assert got == expected(damage(rows), ids)
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for v in got.values())


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op11_rank_viterbi"](spark, sf)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert reports(df) == expected(damage(rows), {r[0] for r in rows})


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair_reports(empty, empty.select("conv_id")).isEmpty() and C.repair_rows(empty).isEmpty()
