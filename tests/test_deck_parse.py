"""Deck line rules (CLI and library) and deck-name rules, on literal edge cases."""


from cardlake.functions import columns as C
from cardlake.sources import decks as D

EDGE = ["// c", "# c", "0 X", "+3 X", "-1 X", "3  X", "3\tX", "99999999999999999999 X", "3", "3 ",
        "  4 Lightning Bolt \r", "1 Sol Ring -OK", "10 Island", "", "Sideboard", "2 Forest"]


def _parse(spark, rule):
    df = spark.createDataFrame([("d.deck", x) for x in EDGE], "file_path string, line string")
    return {(r.quantity, r.card_name) for r in D.parse_deck_lines(df, rule=rule).collect()}


def test_cli_rule(spark):
    assert _parse(spark, "cli") == {(3, "X"), (3, "X"), (4, "Lightning Bolt"), (1, "Sol Ring -OK"), (10, "Island")}


def test_library_rule(spark):
    got = _parse(spark, "library")
    # quantity 0 kept, tab separator kept, sign and overflow rejected
    assert (0, "X") in got and (3, "X") in got
    assert (4, "Lightning Bolt") in got and (1, "Sol Ring -OK") in got and (10, "Island") in got
    assert all(q >= 0 for q, _ in got)
    # U+00A0 is not RE2 \s, so '2<NBSP>Forest' does not match the library regex
    assert (2, "Forest") not in got


def test_reject_reasons(spark):
    df = spark.createDataFrame([("d.deck", x) for x in EDGE], "file_path string, line string")
    rows = D.parse_deck_lines(df, rule="cli", keep_rejects=True).groupBy("reject_reason").count().collect()
    counts = {r.reject_reason: r["count"] for r in rows}
    assert counts["comment"] == 2 and counts["blank"] == 1
    assert counts["non_positive"] == 2            # '0 X', '-1 X'
    assert counts["bad_quantity"] == 1            # 20-digit number overflows 64 bits
    assert counts[None] == 5


def test_long_lines_are_lines_like_others(spark):
    rows = [("a.deck", "1 X"), ("a.deck", "2 " + "Y" * 70000), ("b.deck", "1 Z")]
    df = spark.createDataFrame(rows, "file_path string, line string")
    lib = D.parse_deck_lines(df, rule="library").select("file_path").distinct().collect()
    cli = D.parse_deck_lines(df, rule="cli").select("file_path").distinct().collect()
    assert {r.file_path for r in lib} == {"a.deck", "b.deck"}
    assert {r.file_path for r in cli} == {"a.deck", "b.deck"}


def test_deck_names(spark):
    paths = ["/decks/the-ur-dragon-online-update.deck.txt", "/decks/kaalia_of-the-vast.deck",
             "/decks/élan-vital.deck", "file:/decks/The%20Ur+Dragon.deck", "/decks/x.deck.bak.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select(C.deck_name("p", "cli").alias("cli"), C.deck_name("p", "library").alias("lib")).collect()
    cli = [r.cli for r in got]
    lib = [r.lib for r in got]
    assert cli[0] == "The Ur Dragon Online Update"
    assert lib[0] == "The Ur Dragon Online Update.Deck"
    assert cli[1] == "Kaalia Of The Vast" and lib[1] == "Kaalia Of The Vast"
    assert cli[2] == "élan Vital"          # CLI only upper-cases a-z
    assert lib[2] == "Élan Vital"          # library title-cases any letter
    assert cli[3] == "The Ur+Dragon"       # percent-decoded, '+' kept
    assert cli[4] == "X"                   # cut at the last '.deck'


def test_summary_counts_lines_not_names(spark):
    rows = [("r.deck", "1 A"), ("r.deck", "1 A"), ("r.deck", "2 B"), ("e.deck", "// only a comment")]
    lines = spark.createDataFrame(rows, "file_path string, line string")
    graded = D.parse_deck_lines(lines, keep_rejects=True)
    s = {r.file_path: r for r in D.summarise_decks(graded, with_distinct_names=True).collect()}
    assert s["r.deck"].total_cards == 4 and s["r.deck"].unique_cards == 3
    assert s["e.deck"].total_cards == 0 and s["e.deck"].unique_cards == 0
    assert s["r.deck"].distinct_names == 2 and s["e.deck"].distinct_names == 0
    assert len(s["r.deck"].id) == 36


def test_deck_id_is_stable_across_ingests(spark):
    # D10: re-ingesting the same file must not add a new deck to the portfolio
    df = spark.createDataFrame([("/d/a.deck", "1 X")], "file_path string, line string")
    first = D.summarise_decks(D.parse_deck_lines(df, keep_rejects=True)).first().id
    again = D.summarise_decks(D.parse_deck_lines(df.union(df), keep_rejects=True)).collect()
    assert len(again) == 1 and again[0].id == first
