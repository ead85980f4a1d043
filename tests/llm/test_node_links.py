"""Links found inside a node: as many as join its components, for any number of near pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cardlake.llm import near_dedup as N
from test_operators import brute_components, prose, table


def node(sets, label=None, side=None, slot=0, slots=1):
    n = len(sets)
    signed = [N.signature(s) for s in sets]
    bits = [np.packbits(short[:64] & 1).view(">i8").astype(np.int64)[0] for _, short in signed]
    return pa.table({
        "id": np.arange(n) * 3, "n": np.array([len(s) for s in sets], np.int64), "bits": np.array(bits, np.int64),
        "label": np.arange(n) if label is None else np.array(label), "side": np.zeros(n, np.int64) if side is None else np.array(side),
        "slot": np.full(n, slot, np.int32), "slots": np.full(n, slots, np.int64), "set": [s.tobytes() for s in sets],
        "sig": [whole.tobytes() for whole, _ in signed], "sketch": [short.tobytes() for _, short in signed]})


def edited(rng, n, size, most):
    base = rng.integers(1, 1 << 62, size, dtype=np.uint64)
    out = []
    for _ in range(n):
        one = base.copy()
        one[rng.integers(0, size, rng.integers(0, most))] = rng.integers(1, 1 << 62, dtype=np.uint64)
        out.append(np.unique(one))
    return out


def partition(n, links, label):
    part = list(label)
    for u, v in links:
        a, b = part[u], part[v]
        part = [a if p == b else p for p in part]
    return {frozenset(i for i in range(n) if part[i] == p) for p in part}


@pytest.mark.parametrize("at_once", [1 << 22, 500])
@pytest.mark.parametrize("n", [2, 40, 300])
def test_forest_joins_what_all_pairs_join(monkeypatch, n, at_once):
    monkeypatch.setattr(N, "AT_ONCE", at_once)
    rng = np.random.default_rng(n)
    sets = edited(rng, n, 200, 60)
    label = rng.integers(0, n, n)
    got = N._join_sets(node(sets, label)).to_pydict()
    links = [(u // 3, v // 3) for u, v in zip(got["u"], got["v"])]

    def similar(a, b):
        both = len(np.intersect1d(a, b))
        return 100 * both >= N.SIMILARITY * (len(a) + len(b) - both)

    assert all(similar(sets[u], sets[v]) for u, v in links)
    assert len(links) == len(set(label.tolist())) - len(partition(n, links, label))     # a forest
    every = [(u, v) for u in range(n) for v in range(u) if similar(sets[u], sets[v])]
    assert partition(n, links, label) == partition(n, every, label)


def test_two_blocks_are_compared_with_each_other_only():
    rng = np.random.default_rng(1)
    sets = edited(rng, 60, 100, 6)
    side = [i % 2 for i in range(60)]
    got = N._join_sets(node(sets, side=side)).to_pydict()
    assert got["u"] and all(side[u // 3] != side[v // 3] for u, v in zip(got["u"], got["v"]))


def test_one_component_gives_no_link():
    sets = edited(np.random.default_rng(2), 20, 50, 3)
    assert N._join_sets(node(sets, [7] * 20)).num_rows == 0


def test_dense_group_in_blocks_of_few_bytes(spark, monkeypatch):
    """Texts two to five edits from one base, many pairs of which are just below the threshold."""
    for name, value in (("SMALL", 6), ("LARGE", 40), ("SET_BYTES", 20_000), ("NEAREST_ROUNDS", 1)):
        monkeypatch.setattr(N, name, value)
    rnd = random.Random(8)
    base, rows = prose(rnd, 120, 10_000).split(), []
    for i in range(160):
        changed = list(base)
        for _ in range(rnd.randrange(2, 6)):
            changed[rnd.randrange(120)] = f"y{rnd.randrange(10**6)}"
        rows.append((i, " ".join(changed), "s"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(table(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_nodes_of_the_same_documents_are_compared_once(spark, monkeypatch):
    monkeypatch.setattr(N, "LARGE", 2)
    nodes = {1: (5, 9), 2: (5, 9), 3: (5, 9, 11), 4: (5, 11), 6: (9, 11, 5), 7: (7,), 20: (1, 2, 3, 4, 5), 21: (1, 2, 3, 4, 5)}
    rows = spark.createDataFrame([(k, k % 13, i, 100 + i, i) for k, ids in nodes.items() for i in ids], "node long, slot int, id long, n long, bits long")
    got = sorted((r.node, r.id, r.docs) for r in N._open_nodes(N._labelled(rows, None)).collect())
    assert got == sorted((k, i, len(nodes[k])) for k in (1, 3, 4, 20, 21) for i in nodes[k])   # wide ones branch apart


def test_dense_group_in_large_nodes_that_do_not_branch(spark, monkeypatch):
    """Pairs are left to the first of the nodes they share that are still there."""
    monkeypatch.setattr(N, "SMALL", 6)
    monkeypatch.setattr(N, "NEAREST_ROUNDS", 1)
    rnd = random.Random(9)
    base, rows = prose(rnd, 120, 10_000).split(), []
    for i in range(120):
        changed = list(base)
        for _ in range(rnd.randrange(2, 6)):
            changed[rnd.randrange(30, 120)] = f"y{rnd.randrange(10**6)}"
        rows.append((i, " ".join(changed), "s"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(table(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_sets_are_gathered_without_joining_the_slots_again(spark, monkeypatch):
    """The ids whose sets are needed come from the nodes as they are: the rows of all nodes are joined with their slots once."""
    for name, value in (("SMALL", 6), ("LARGE", 10), ("NEAREST_ROUNDS", 1)):
        monkeypatch.setattr(N, name, value)
    plans, write = [], N.materialise

    def kept(df, name):
        if name == "near-sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(N, "materialise", kept)
    rnd = random.Random(10)
    base, rows = prose(rnd, 60, 10_000).split(), []
    for i in range(40):
        changed = list(base)
        for _ in range(rnd.randrange(1, 4)):
            changed[rnd.randrange(20, 60)] = f"y{rnd.randrange(10**6)}"
        rows.append((i, " ".join(changed), "s"))
    N.near_duplicates(table(spark, rows)).collect()
    assert len(plans) == 1 and len(re.findall(r"Join Inner, \(id#\d+L = id#\d+L\)", plans[0])) == 1
