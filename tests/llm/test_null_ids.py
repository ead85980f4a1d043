"""Near-dedup of texts that occur only in rows with a null doc_id."""

from __future__ import annotations

import random
from collections import Counter

from cardlake.llm import near_dedup
from test_operators import prose, table


def test_texts_without_an_id_are_linked(spark):
    rnd = random.Random(4)
    base, other = prose(rnd, 200, 10_000), prose(rnd, 200, 10_000)
    rows = [(7, base, "s"), (None, base + " one", "s"), (None, base + " one", "s"), (None, "two " + base, "s"), (5, "two " + base + " more", "s"),
            (None, other, "s"), (None, other + " x", "s"), (9, prose(rnd, 100, 10_000), "s"), (None, None, "s")]
    got = near_dedup.near_duplicates(table(spark, rows)).collect()
    assert Counter((r.n_shingles, r.doc_id, r.component_id, r.kept) for r in got) == Counter([
        (196, 7, 5, False), (197, None, 5, False), (197, None, 5, False), (197, None, 5, False), (198, 5, 5, True),
        (196, None, None, True), (197, None, None, True), (96, 9, 9, True), (0, None, None, True)])
