"""Spelling variants against brute force over all pairs, for several block limits."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from cardlake.llm import spelling as S
from cardlake.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counts(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    words, near = sorted(n), {w: [] for w in n}
    for w in words:     # all one-edit strings would be as many: compare with all words of near lengths
        near[w] = [v for v in words if abs(len(v) - len(w)) < 2 and v != w and is_near(w, v)]
    form = {}
    for w in words:
        top = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 10 * n[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def vocabulary(rnd, size):
    bases = ["".join(rnd.choice("aabcé") for _ in range(rnd.randrange(7, 12))) for _ in range(size)]
    out = Counter()
    for b in bases:
        out[b] += rnd.choice([2, 30, 900])
        for _ in range(rnd.randrange(8)):
            i, c = rnd.randrange(len(b) + 1), rnd.choice("abcéÀ")
            v = rnd.choice([b[:i] + c + b[i:], b[:i] + b[i + 1:], b[:i] + c + b[i + 1:]])
            if len(v) >= 7:
                out[v] += rnd.choice([2, 3, 40])
                b = rnd.choice([b, v])
    for run in ("aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "ababababa", "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499):
        out[run] += rnd.choice([2, 50])
    return dict(out)


@pytest.mark.parametrize("limit", [1, 10, 8192])
def test_variants_against_brute_force(spark, limit, monkeypatch):
    if limit == 10:
        monkeypatch.setattr(S, "TILE", 3)       # large blocks over several matrices
    n = vocabulary(random.Random(limit), 150)
    got = S.variants(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3), limit=limit)
    assert sorted(map(str, got.collect())) == sorted(map(str, [type(r)(*x) for r in got.limit(1).collect() for x in brute(n)])) or \
        {tuple(r) for r in got.collect()} == brute(n)


def test_tiles_in_process_against_brute_force():
    n = vocabulary(random.Random(7), 120)
    import pyarrow as pa
    rows = sorted((hash((len(w) if own else len(w) - 1)), w.encode("latin-1"), n[w], len(w) if own else len(w) - 1)
                  for w in n for own in (True, False) if len(w) - (not own) >= 7)
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()),
                                        *[pa.array(v, pa.int32()) for v in ([r[3] for r in rows], [0] * len(rows), [r[3] for r in rows])],
                                        pa.array([r[0] for r in rows], pa.int64())], ["word", "n", "l", "lo", "hi", "block"])
    for tile, size in ((512, 10_000), (5, 7), (64, 1)):
        old, S.TILE = S.TILE, tile
        got = Counter()
        for part in S._near_words(batch.slice(i, size) for i in range(0, len(rows), size)):
            for r in part.to_pylist():
                got[r["word"].decode("latin-1")] += r["near"]
        S.TILE = old
        assert got == Counter({w: k for w, _, _, _, k, _ in brute(n) if k})


def test_every_hash_collision_is_harmless(spark, monkeypatch):
    n = vocabulary(random.Random(2), 60)
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    halved = S._halved
    monkeypatch.setattr(S, "_halved", lambda rows: halved(rows).selectExpr("word", "n", "l", "lo", "hi", "block % 3 as block"))
    assert {tuple(r) for r in S.variants(words).collect()} == brute(n)


def docs(rnd):
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(5, 10))) for _ in range(60)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(300))) + rnd.choice(["", "é", "_x1 ABCABCAB×÷", "\n"])) for i in range(60)]
    rows += [(None, " ".join(words)), (None, " ".join(words)), (70, None), (71, ""), (72, "12 ΑΒ ....."), rows[0], (73, "q" * 50_000 + " " + "q" * 50_001)]
    return rows


def test_query_against_brute_force(spark, tmp_path):
    rows = docs(random.Random(6))
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], "doc_id long, text string, word string, n int, run int")
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_gram_variants"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(counts(rows))
    assert {tuple(r) for r in got.collect()} == want and any(r[1] for r in want)


def test_empty_table(spark):
    assert S.variants(spark.createDataFrame([], "word string, n long")).isEmpty()
    assert S.runs(spark.createDataFrame([], "doc_id long, text string")).isEmpty()
