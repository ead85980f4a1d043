"""Column-level building blocks (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's rules for equal results.
# ---------------------------------------------------------------------------
# Bytes trimmed by the deployed deck CLI (its own helper, ASCII only).
CLI_BLANKS = " \t\n\r"
# Characters Go's unicode.IsSpace reports as space (used by strings.TrimSpace):
# \t \n \v \f \r space U+0085 U+00A0 U+1680 U+2000..U+200A U+2028 U+2029 U+202F U+205F U+3000
UNICODE_SPACES = ("\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                  + "\u2028\u2029\u202f\u205f\u3000")
# Go regexp \s (RE2 Perl class): tab, newline, form feed, carriage return, space.
RE2_PERL_SPACE = r"[\t\n\f\r ]"
# Word separators of Go's strings.Title: every ASCII byte except letters,
# digits and underscore, plus the non-ASCII spaces of unicode.IsSpace.
TITLE_SEPARATOR_CLASS = (
    r"[\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{5E}\x{60}\x{7B}-\x{7F}\x{85}\x{A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
TITLE_WORD_CLASS = TITLE_SEPARATOR_CLASS.replace("[", "[^", 1)
# Deck line rules: CLI = split at the first single space, signed integer;
# library = ^(\d+)\s+(.+)$ on the Unicode-trimmed line (a split at the first run of
# \s characters, digits only before it, is the same match).
CLI_QTY_RE = r"^[+-]?[0-9]+$"
LIB_QTY_RE = r"^[0-9]+$"
# Mana-cost tiers, colour categories and deck format buckets.
TIER_LOW_MAX, TIER_MEDIUM_MAX = 2, 4
COLOR_CATEGORIES = ["Colorless", "Monocolored", "Two-colored", "Three-colored",
                    "Four-colored", "Five-colored"]
FORMAT_BUCKETS = ["Standard (60 cards)", "Limited (75 cards)", "Commander (100 cards)", "Other"]
# ---------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cli_trim(c) -> Column:
    """Trim the four ASCII blanks the deck CLI strips."""
    return F.btrim(col_(c), F.lit(CLI_BLANKS))


def unicode_trim(c) -> Column:
    """strings.TrimSpace: strip Unicode white space at both ends."""
    return F.btrim(col_(c), F.lit(UNICODE_SPACES))


def base_name(path) -> Column:
    """Last path element; Spark file URIs are percent-encoded, so decode them
    (a literal '+' is protected first because url_decode reads it as a space)."""
    p = col_(path)
    decoded = F.url_decode(F.replace(p, F.lit("+"), F.lit("%2B")))
    decoded = F.when((p.startswith("file:") | p.contains("://")) & p.contains("%"), decoded).otherwise(p)
    return F.substring_index(decoded, "/", -1)


def _cut_at_last(name: Column, marker: str) -> Column:
    """Everything before the last occurrence of ``marker`` (unchanged if absent)."""
    after = F.substring_index(name, marker, -1)
    return F.when(name.contains(marker),
                  F.substring(name, F.lit(1), F.length(name) - F.length(after) - F.lit(len(marker)))) \
        .otherwise(name)


def _ascii_title_words(name: Column) -> Column:
    """Upper-case the first ASCII letter of every space-separated word, keep the rest.

    Fast path: for ASCII text without upper-case letters, initcap (space-delimited,
    lower-cases the rest) gives exactly this result and is code-generated; other
    names take the per-word transform.
    """
    return F.when(name.rlike(r"^[\x00-\x40\x5B-\x7F]*$"), F.initcap(name)).otherwise(_title_words_slow(name))


def _title_words_slow(name: Column) -> Column:
    words = F.split(name, " ", -1)
    fixed = F.transform(
        words,
        lambda w: F.when(
            (F.substring(w, 1, 1) >= F.lit("a")) & (F.substring(w, 1, 1) <= F.lit("z")),
            F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))),
        ).otherwise(w),
    )
    return F.array_join(fixed, " ")


def _go_title(name: Column) -> Column:
    """strings.Title: upper-case a letter that follows a separator (or starts the text)."""
    pattern = f"({TITLE_SEPARATOR_CLASS}*)({TITLE_WORD_CLASS}*)"
    seps = F.regexp_extract_all(name, F.lit(pattern), 1)
    words = F.regexp_extract_all(name, F.lit(pattern), 2)
    pieces = F.zip_with(
        seps, words,
        lambda s, w: F.concat(F.coalesce(s, F.lit("")), F.upper(F.substring(F.coalesce(w, F.lit("")), 1, 1)),
                              F.substr(F.coalesce(w, F.lit("")), F.lit(2))),
    )
    return F.array_join(pieces, "")


def deck_name(path, rule: str = "cli") -> Column:
    """Deck display name from a file path.

    cli:     cut at the last '.deck', then at the last '.txt'; '-'/'_' -> ' ';
             upper-case the first a-z letter of each space-separated word.
    library: drop a trailing '.deck', then a trailing '.txt'; same replacement;
             title-case after every separator (so 'x.deck.txt' keeps '.Deck').
    """
    name = base_name(path)
    if rule == "cli":
        name = _cut_at_last(_cut_at_last(name, ".deck"), ".txt")
        name = F.translate(name, "-_", "  ")
        return _ascii_title_words(name)
    if rule == "library":
        name = F.regexp_replace(name, r"\.deck$", "")
        name = F.regexp_replace(name, r"\.txt$", "")
        name = F.translate(name, "-_", "  ")
        return _go_title(name)
    raise ValueError(f"unknown rule {rule!r}")


def stable_id(*cols) -> Column:
    """Deterministic UUID-shaped id from natural-key columns (md5, 8-4-4-4-12)."""
    h = F.md5(F.concat_ws("\u0001", *[col_(c).cast("string") for c in cols]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def mana_cost_tier(cmc) -> Column:
    """<=2 low, <=4 medium, else high; a missing cost counts as 0 (Go zero value)."""
    c = F.coalesce(col_(cmc).cast("double"), F.lit(0.0))
    return (F.when(c <= TIER_LOW_MAX, "low")
            .when(c <= TIER_MEDIUM_MAX, "medium")
            .otherwise("high"))


def color_category(colors, missing_as_colorless: bool = False) -> Column:
    """Category by array size 0..5; >5 -> 'Unknown'. A NULL list (an empty list is
    omitted on write, so it reads as NULL) is 'Unknown' as in the source, or
    'Colorless' with ``missing_as_colorless``."""
    n = F.array_size(col_(colors))
    if missing_as_colorless:
        n = F.coalesce(n, F.lit(0))
    expr = None
    for i, label in enumerate(COLOR_CATEGORIES):
        expr = F.when(n == i, label) if expr is None else expr.when(n == i, label)
    return expr.otherwise("Unknown")


def deck_bucket(total_cards) -> Column:
    t = col_(total_cards)
    return (F.when(t <= 60, FORMAT_BUCKETS[0])
            .when(t <= 75, FORMAT_BUCKETS[1])
            .when(t == 100, FORMAT_BUCKETS[2])
            .otherwise(FORMAT_BUCKETS[3]))


def avg_item_value(total_value, total_items) -> Column:
    """total_value / total_items as double; NULL instead of an error on 0."""
    return F.try_divide(col_(total_value).cast("double"), col_(total_items).cast("double"))


def estimate_value(qty, unit_price: float = 5.0) -> Column:
    return col_(qty).cast("double") * F.lit(float(unit_price))


def money_text(x) -> Column:
    """A price as text with at most two decimals and no trailing zeros (500, 12.5, 7.25)."""
    s = col_(x).cast("decimal(18,2)").cast("string")
    return F.regexp_replace(F.regexp_replace(s, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def alert_message(name, price) -> Column:
    """'ALERT: <name> is priced at $<price>'; a missing name reads as empty text. Prices that a
    double would print in scientific notation are written out (two decimals at most)."""
    p = col_(price)
    text = F.when(F.abs(p.cast("double")) >= 1e7, F.regexp_replace(p.cast("decimal(38,2)").cast("string"), "0$", "")) \
        .otherwise(p.cast("string"))
    return F.concat(F.lit("ALERT: "), F.coalesce(col_(name).cast("string"), F.lit("")), F.lit(" is priced at $"), text)


def epoch_ms_text(ms, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.timestamp_millis(col_(ms).cast("long")), fmt)


def compact_number(n) -> Column:
    """1234567 -> '1.2M', 3456 -> '3.5K', below 1000 the plain integer.

    Rounding is half-up on the exact integer value (tenths of a thousand/million).
    """
    v = col_(n).cast("long")
    tenths_m = F.floor((v + F.lit(50000)) / F.lit(100000)).cast("long")
    tenths_k = F.floor((v + F.lit(50)) / F.lit(100)).cast("long")

    def one_decimal(t):
        return F.concat((t / 10).cast("long").cast("string"), F.lit("."), (t % 10).cast("string"))

    return (F.when(v >= 1000000, F.concat(one_decimal(tenths_m), F.lit("M")))
            .when(v >= 1000, F.concat(one_decimal(tenths_k), F.lit("K")))
            .otherwise(v.cast("string")))


def price_event_key(card_uuid, ts) -> Column:
    """'price-<uuid>-<yyyy-MM-dd>' (the intended per-card-per-day key)."""
    return F.concat(F.lit("price-"), col_(card_uuid).cast("string"), F.lit("-"),
                    F.date_format(col_(ts), "yyyy-MM-dd"))


def to_epoch_ms(ts) -> Column:
    return F.unix_millis(col_(ts).cast("timestamp"))


def flexible_timestamp(c) -> Column:
    """Envelope timestamps arrive as epoch millis (number) or RFC-3339 text."""
    s = F.trim(col_(c).cast("string"))
    # guard with a pattern: a failing try_cast costs an exception per row
    return F.when(s.rlike(r"^-?[0-9]{1,18}$"), F.timestamp_millis(s.try_cast("long"))) \
        .otherwise(F.try_to_timestamp(s))
