"""Deck directory source on fixture files: globs, CRLF, empty file, both rules, totals."""

import os

from cardlake.sources import decks as D

FIX = os.path.join(os.path.dirname(__file__), "fixtures", "decks")


def _summary(spark, rule):
    lines = D.read_deck_lines(spark, FIX)
    s = D.summarise_decks(D.parse_deck_lines(lines, rule=rule, keep_rejects=True), rule=rule)
    return {r.name: (r.total_cards, r.unique_cards) for r in s.collect()}


def test_cli_directory(spark):
    got = _summary(spark, "cli")
    # alpha-strike: Atraxa 1, Plains 10, Island 9, Sol Ring 1, '+2 Swamp' 2 -> 23 cards, 5 lines
    assert got["Alpha Strike"] == (23, 5)
    assert got["Burn It Down"] == (25, 3)          # CRLF lines are trimmed
    assert got["No Cards"] == (0, 0)               # a file without a valid line is still a deck
    assert "Empty" not in got                      # zero-byte files are invisible to Spark file sources
    assert "Not A Deck" not in got                 # '*.txt' without '.deck' is outside the glob
    assert len(got) == 3                           # hidden files are skipped by the file source


def test_library_directory(spark):
    got = _summary(spark, "library")
    # library: '0 Nothing' kept, '+2 Swamp' rejected, '3<TAB>Forest' kept -> 1+10+9+1+0+3 = 24, 6 lines
    assert got["Alpha Strike"] == (24, 6)
    assert got["Burn It Down.Deck"] == (25, 3)     # library keeps '.deck' of '.deck.txt' and title-cases it
