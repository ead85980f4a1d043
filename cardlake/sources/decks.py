"""Deck text files: directory source, line parser (two rules) and deck summaries.

Files are read in *line* mode so a large file is split across tasks; a deck is
re-assembled with an aggregate keyed by its file path (partial aggregation
happens map-side, so one huge deck never lands in one task as raw lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import columns as C
from cardlake.sources.files import list_files

DEFAULT_GLOB = "*{.deck,.deck.txt}"


DECK_NAMES = ("*.deck", "*.deck.txt")


def read_deck_lines(spark: SparkSession, path: str, glob: str = DEFAULT_GLOB, with_place: bool = False) -> DataFrame:
    """(file_path, line) for every line of every deck file directly under ``path``; ``with_place`` adds
    ``place``, which orders the lines of a file.

    Lines are split on '\\n' only (a '\\r' stays and is trimmed by the parser),
    as in the source tool. A file that cannot be read fails the job: skipping it would
    leave a deck with part of its lines.
    """
    return (spark.read.option("lineSep", "\n")
            .option("pathGlobFilter", glob)
            .text(path)
            .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line"),
                    *([F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("place")]
                      if with_place else [])))


def empty_decks(spark: SparkSession, path: str, rule: str = "cli") -> DataFrame:
    """Summaries (0 cards) of the deck files directly under ``path`` that have no byte, which no reader shows."""
    files = list_files(spark, path, patterns=DECK_NAMES).where("length = 0")
    none = F.lit(0).cast("bigint")
    return files.select(C.stable_id("path").alias("id"), C.deck_name("path", rule).alias("name"), F.col("path").alias("file_path"),
                        none.alias("total_cards"), none.alias("unique_cards"))


def deck_lists(graded: DataFrame, path_col: str = "file_path") -> DataFrame:
    """path_col and cards: the accepted lines of each file as an array of (quantity, name), in the order of ``place`` where
    the lines have one, else of name and quantity. A deck's list is one value, as it is in the deck event."""
    ok = graded.where(F.col("reject_reason").isNull()) if "reject_reason" in graded.columns else graded
    place = F.col("place") if "place" in graded.columns else F.struct("card_name", "quantity")
    per_file = ok.groupBy(path_col).agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), "quantity", "card_name"))).alias("lines"))
    return per_file.select(path_col, F.transform("lines", lambda x: F.struct(x["quantity"].alias("quantity"), x["card_name"].alias("name"))).alias("cards"))


def with_cards(decks: DataFrame, graded: DataFrame) -> DataFrame:
    """Deck summaries with their ``cards`` (an empty array for decks without an accepted line)."""
    lists = deck_lists(graded)
    return decks.join(lists, "file_path", "left").select(
        *decks.columns, F.coalesce("cards", F.array().cast(lists.schema["cards"].dataType)).alias("cards"))


def parse_deck_lines(lines: DataFrame, rule: str = "cli", line_col: str = "line",
                     path_col: str = "file_path", keep_rejects: bool = False) -> DataFrame:
    """Parse ``<quantity> <name>`` lines.

    rule='cli'     (deployed tool): trim ASCII blanks; skip '', '//…', '#…';
                   split at the first single space; signed 64-bit integer > 0;
                   name (trimmed) not empty.
    rule='library' (library variant): Unicode trim; ^(\\d+)\\s+(.+)$; quantity >= 0
                   (64-bit). Lines may have any length.

    Output: path_col, quantity (bigint), card_name, plus the other input columns.
    With keep_rejects=True every line is kept with a ``reject_reason`` column
    (NULL for accepted lines) instead of being filtered.
    """
    raw = F.col(line_col)
    if rule == "cli":
        trim, sep, qty_re, min_qty = C.cli_trim, " ", C.CLI_QTY_RE, 1
    elif rule == "library":
        trim, sep, qty_re, min_qty = C.unicode_trim, C.RE2_PERL_SPACE + "+", C.LIB_QTY_RE, 0
    else:
        raise ValueError(f"unknown rule {rule!r}")
    # Stage the trimmed line and its split as columns (each computed once per line).
    staged = lines.withColumn("_t", trim(raw)).withColumn("_parts", F.split("_t", sep, 2))
    t, parts = F.col("_t"), F.col("_parts")
    qty_txt = F.element_at(parts, 1)
    has_shape = (F.size(parts) == 2) & qty_txt.rlike(qty_re)
    name = F.when(has_shape, trim(F.element_at(parts, 2))).otherwise(F.lit(""))
    qty = F.when(has_shape, qty_txt.try_cast("bigint"))
    reason = (F.when(t == "", "blank")
              .when(t.startswith("//") | t.startswith("#"), "comment")
              .when(~has_shape, "malformed")
              .when(qty.isNull(), "bad_quantity")
              .when(qty < min_qty, "non_positive")
              .when(name == "", "empty_name"))
    # The parse result comes out of a generator: a later filter on reject_reason
    # cannot be pushed below it, so the parse is not evaluated twice.
    result = F.struct(qty.alias("quantity"), name.alias("card_name"), reason.alias("reject_reason"))
    out = staged.select(*lines.columns, F.inline(F.array(result)))
    if keep_rejects:
        return out
    return out.where(F.col("reject_reason").isNull()).drop("reject_reason")


def summarise_decks(graded: DataFrame, path_col: str = "file_path", rule: str = "cli",
                    with_distinct_names: bool = False) -> DataFrame:
    """One row per deck file: id, name, file_path, total_cards (Σ quantity) and unique_cards
    (number of accepted *lines*, as the source counts them: a repeated name counts
    twice); optionally distinct_names, the number of different card names.

    ``graded`` are the lines from ``parse_deck_lines(..., keep_rejects=True)``: the
    aggregate counts only accepted lines, so a file whose lines are all rejected still
    yields a deck with 0 cards, in the same single pass (no separate file listing).
    Already-filtered lines (no ``reject_reason`` column) are accepted as well.
    """
    ok = F.col("reject_reason").isNull() if "reject_reason" in graded.columns else F.lit(True)
    aggs = [F.coalesce(F.sum(F.when(ok, F.col("quantity"))), F.lit(0)).alias("total_cards"),
            F.count_if(ok).alias("unique_cards")]
    if with_distinct_names:
        aggs.append(F.count_distinct(F.when(ok, F.col("card_name"))).alias("distinct_names"))
    per_file = graded.groupBy(path_col).agg(*aggs)
    return per_file.select(
        C.stable_id(path_col).alias("id"),
        C.deck_name(path_col, rule).alias("name"),
        F.col(path_col).alias("file_path"),
        F.col("total_cards").cast("bigint").alias("total_cards"),
        F.col("unique_cards").cast("bigint").alias("unique_cards"),
        *([F.col("distinct_names").cast("bigint").alias("distinct_names")] if with_distinct_names else []),
    )


# Annotations seen in hand-written deck lists; the line is kept and counted as is,
# only flagged for review.
SUSPECT_NAME_RE = r"(\s-\s|\s->|-OK$|\(proxy\)|proxy$)"
SUSPECT_MAX_QTY = 99


def flag_suspect(parsed: DataFrame, name_col: str = "card_name", qty_col: str = "quantity") -> DataFrame:
    """Add ``suspect``: the name carries an annotation ('- proxy', '-> X', '-OK') or the
    quantity is implausibly large (a stray sentence that happens to start with a number)."""
    return parsed.withColumn("suspect", F.col(name_col).rlike(SUSPECT_NAME_RE)
                             | (F.col(qty_col) > SUSPECT_MAX_QTY))


def deck_cards(parsed: DataFrame, path_col: str = "file_path", rule: str = "cli") -> DataFrame:
    """Per accepted line: deck_id, deck_name, card_name, quantity (one card event each)."""
    return parsed.select(
        C.stable_id(path_col).alias("deck_id"),
        C.deck_name(path_col, rule).alias("deck_name"),
        F.col("card_name"),
        F.col("quantity"),
    )
