"""Property tests: deck text written from (deck, quantity, name) rows parses back to the
same rows under both rules; the progress counters of a stream report what it read."""

import os
import string

from hypothesis import given, settings, strategies as st

from cardlake.sources import decks as D
from cardlake.streaming import jobs as SJ

NAME_CHARS = string.ascii_letters + string.digits + " ,'-/()!?.&"
names = st.text(alphabet=NAME_CHARS, min_size=1, max_size=30).map(str.strip).filter(
    lambda s: s and not s.startswith(("//", "#")))
line = st.tuples(st.sampled_from(["a.deck", "b.deck", "c.deck.txt"]), st.integers(1, 10 ** 12), names)


@settings(max_examples=5, deadline=None)
@given(st.lists(line, min_size=1, max_size=60))
def test_deck_text_round_trip(spark, rows):
    df = spark.createDataFrame([(f, f"{q} {n}") for f, q, n in rows], "file_path string, line string")
    for rule in ("cli", "library"):
        back = sorted((r.file_path, r.quantity, r.card_name) for r in D.parse_deck_lines(df, rule=rule).collect())
        assert back == sorted(rows)
    totals = {r.file_path: (r.total_cards, r.unique_cards)
              for r in D.summarise_decks(D.parse_deck_lines(df, keep_rejects=True)).collect()}
    for f in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == f]
        assert totals[f] == (sum(q for _, q, _ in mine), len(mine))


def test_progress_counters(spark, tmp):
    src = os.path.join(tmp, "msgs")
    spark.createDataFrame([(None, '{"a":1}')] * 7, "key string, value string").write.json(src)
    q = SJ.run_stream(SJ.file_source(spark, src), "progress_probe", trigger={"availableNow": True},
                      checkpoint=os.path.join(tmp, "ck"))
    q.processAllAvailable()
    c = SJ.progress_counters(q)
    q.stop()
    assert c["num_input_rows"] == 7 and sum(c["sources"].values()) == 7


# ---- price tree: random documents with junk, against a plain walk of the same rules
import json  # noqa: E402

from cardlake.sources import catalog as CAT  # noqa: E402

KEYS = st.sampled_from(["paper", "mtgo", "ck", "tcg", "retail", "buylist", "normal", "foil", "etched",
                        "2024-01-01", "2024-01-02"])
LEAF_JUNK = st.one_of(st.text(max_size=3), st.none(), st.booleans())
JUNK = st.dictionaries(st.sampled_from(["currency", "note"]), st.one_of(LEAF_JUNK, st.lists(LEAF_JUNK, max_size=2)),
                       max_size=1)
LEAF = st.one_of(st.integers(-10 ** 6, 10 ** 6), st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False),
                 st.text(max_size=3), st.none(), st.booleans())


def _level(depth):
    """format -> source -> type -> finish -> date -> price, with junk siblings (text, null,
    booleans, lists) at every level and junk leaves among the prices."""
    if depth == 0:
        return LEAF
    children = st.dictionaries(KEYS, _level(depth - 1), min_size=1, max_size=2)
    return st.builds(lambda c, j: {**c, **j}, children, JUNK)


def _walk(uuid, node, path, out, currency=None):
    if len(path) == 4:                     # node should be {date: price}
        for date, price in (node.items() if isinstance(node, dict) else []):
            if isinstance(price, (int, float)) and not isinstance(price, bool):
                out.append((uuid, *path, path[3] == "foil", date, float(price), currency))
        return
    if isinstance(node, dict):
        if len(path) == 2:                 # a source node: its text 'currency' sibling
            c = node.get("currency")
            currency = c if isinstance(c, str) else None
        for k, v in node.items():
            _walk(uuid, v, path + [k], out, currency)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), _level(5)), min_size=1, max_size=12))
def test_price_tree_matches_plain_walk(spark, docs):
    df = spark.createDataFrame([(u, json.dumps(d)) for u, d in docs], "key string, doc string")
    got = [(r.card_uuid, r.format, r.source, r.type, r.finish, r.foil, r.date, r.price, r.currency)
           for r in CAT.flatten_price_tree(df).collect()]
    want = []
    for u, d in docs:
        _walk(u, d, [], want)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_price_tree_walk_is_not_vacuous():
    out = []
    _walk("u", {"paper": {"ck": {"currency": "USD", "retail": {"foil": {"2024-01-01": 2, "x": "7"}}}}}, [], out)
    assert out == [("u", "paper", "ck", "retail", "foil", True, "2024-01-01", 2.0, "USD")]
