"""Each stage of the pipeline against brute force on its own input, with clashing columns and long texts."""

from __future__ import annotations

import random
import re
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row_number long, token_ids string, n_tokens int"
BLANKS = re.compile("[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(21)

    def prose(n, k=600):
        return " ".join(f"word{rnd.randrange(k)}" for _ in range(n)) + "."
    texts = [prose(rnd.randrange(60, 150)) for _ in range(50)]
    base = texts[0].split()
    near = [" ".join(base[:i] + [f"odd{i}"] + base[i + 1:]) for i in (3, 30)]
    out = [(i, t) for i, t in enumerate(texts)] + [(60, texts[4]), (61, texts[4].replace(" ", " \n")), (2, texts[5]), (62, near[0]), (63, near[1]),
                                                    (64, prose(30_000, 20_000)), (65, "few words"), (66, None), (67, ""), (68, "same word here " * 40), (None, texts[6]), (60, texts[4])]
    return [(i, t, "en", f"s{n % 3}", 0, 7, "clash", 1) for n, (i, t) in enumerate(out)]


def collected(df):
    return Counter(tuple(r) for r in df.collect())


def words(text):
    return (text or "").encode().split()


def shingles(text):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_quality_stage(spark, rows):
    got = collected(corpus_pipeline.quality_stage(spark, spark.createDataFrame(rows, COLUMNS), ""))
    for r in rows:
        w = words(r[1])
        grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        repeated = {j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(k, k + 3)}
        if len(w) < 50 or 100 * len(repeated) > 50 * len(w):
            assert r not in got, r[0]
        elif not r[1].startswith("same"):
            assert got[r] == rows.count(r), r[0]


def test_exact_stage(spark, rows):
    groups = {}
    for r in rows:
        groups.setdefault(BLANKS.sub(" ", r[1] or ""), []).append(r)
    got = collected(corpus_pipeline.exact_stage(spark, spark.createDataFrame(rows, COLUMNS).repartition(4), ""))
    assert sum(got.values()) == len(groups)
    for group in groups.values():
        least = min((r[0] is None, r[0] or 0) for r in group)
        kept = [r for r in group if got[r]]
        assert len(kept) == 1 and got[kept[0]] == 1 and (kept[0][0] is None, kept[0][0] or 0) == least


def test_near_stage(spark, rows):
    unique = list({BLANKS.sub(" ", r[1] or ""): r for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0), reverse=True)}.values())
    sets, parent = [shingles(r[1]) for r in unique], list(range(len(unique)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(unique)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(unique):
        groups.setdefault(find(i), []).append(r)
    want = Counter(min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values())
    assert len(want) < len(unique)
    assert collected(corpus_pipeline.near_stage(spark, spark.createDataFrame(unique, COLUMNS).repartition(3), "")) == want


def test_mix_stage(spark, rows):
    docs = spark.createDataFrame(rows, COLUMNS)
    got = collected(corpus_pipeline.mix_stage(spark, docs, ""))
    own = Counter(rows)
    assert set(got) <= set(own) and all(n <= 3 * own[r] for r, n in got.items())
    sizes = {s: sum(len(words(r[1])) for r in rows if r[3] == s) for s in ("s0", "s1", "s2")}
    weights, total = {"s0": 5, "s1": 2, "s2": 1}, sum(sizes.values())
    targets, free = {}, set(sizes)
    while True:
        rest = total - sum(targets.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        targets |= {s: 3 * sizes[s] for s in over}
        free -= over
        if not over:
            targets |= {s: share[s] for s in free}
            break
    largest = max(len(words(r[1])) for r in rows if len(words(r[1])) < 10_000)
    for s, target in targets.items():
        taken = sum(n * len(words(r[1])) for r, n in got.items() if r[3] == s)
        slack = max(len(words(r[1])) for r in rows if r[3] == s)
        assert abs(taken - target) <= slack + largest, (s, taken, target)


def test_token_stage(spark, rows):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    got = corpus_pipeline.token_stage(spark, spark.createDataFrame(rows, COLUMNS), "")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "row_number", "token_ids", "n_tokens"]
    want = Counter()
    for r in rows:
        ids = library.encode(r[1] or "")
        want[(r[0], library.decode(ids), *r[2:6], tuple(ids), len(ids))] += 1
    assert Counter((*tuple(r)[:6], tuple(r.token_ids), r.n_tokens) for r in got.collect()) == want


def test_token_columns_replace_those_of_the_input(spark, rows):
    got = corpus_pipeline.token_stage(spark, spark.createDataFrame(rows[:3], COLUMNS), "")
    assert dict(got.dtypes)["token_ids"] == "array<int>" and dict(got.dtypes)["n_tokens"] == "bigint"
