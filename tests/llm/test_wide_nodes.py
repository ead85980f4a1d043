"""Recall of the near-dedup trees for pairs that are in wide nodes at every level."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from cardlake.llm import near_dedup
from test_operators import prose, table


@pytest.mark.parametrize("depth", range(1, near_dedup.DEPTH + 1))
def test_trees_keep_pairs_together_at_every_depth(depth):
    """Pairs of similarity 0.75 whose nodes all branch on: the trees miss less than 0.004 of them."""
    pairs = 8000
    rng = np.random.default_rng(depth)
    left, right = rng.integers(0, 1 << 32, (2, pairs, near_dedup.POSITIONS), dtype=np.uint32)
    right = np.where(rng.random(left.shape) < 0.75, left, right)
    together = np.zeros(pairs, bool)
    for root in near_dedup._roots():
        of, nodes = np.arange(pairs), np.full(pairs, root)
        for level in range(depth):
            children = []
            for side in (left, right):
                batch = pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(of))), pa.array(of), pa.array(of), pa.array([r.tobytes() for r in side[of]], pa.binary())],
                    ["id", "n", "bits", "sig"])
                child = near_dedup._branch(batch, nodes, level == 0)
                children.append((child.column("node").to_numpy(), child.column("n").to_numpy()))
            (a, of), (b, same) = children   # the pair branches alike as long as it is in one node
            assert (of == same).all()
            of, nodes = of[a == b], a[a == b].view(np.uint64)
        together[of] = True
    assert (~together).sum() < 0.004 * pairs


def test_pairs_inside_a_group_that_stays_wide(spark, monkeypatch):
    """Texts of one shared part: all nodes of that part are wide to the last level; the pairs in them link."""
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    monkeypatch.setattr(near_dedup, "LARGE", 8)
    rnd = random.Random(11)
    common_part, rows = prose(rnd, 130, 10_000), []
    for i in range(150):
        own = prose(rnd, 30, 10_000)
        rows += [(2 * i + side, f"{common_part} {own} {prose(rnd, 20, 10_000)}", "s") for side in (0, 1)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(spark, rows)).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(150)) >= 149
    assert all(component in (i, i - i % 2) for i, component in got.items())
