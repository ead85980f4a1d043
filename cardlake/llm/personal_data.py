"""Personal data in texts: regular expressions propose, checksums confirm, context words score.

Every kind has an expression that proposes spans, a validator (part ranges, digit counts, Luhn,
mod-97) and a confidence in percent. Words near a span that go with its kind add to the
confidence, words that speak against it take from it; "near" is 40 code points in front and 20 behind,
cut at the next proposal of the same expression. The four base kinds (email, ip, card, phone) stay whatever their score;
added spans need ``THRESHOLD``. Added are: IBANs that pass mod-97; a card or phone number within a
run of digits that fails as a whole; social security and national phone numbers without a
checksum, which only context lifts over the threshold. A span that overlaps one of a lower class
(0: base kinds and IBANs, 1: parts of failing runs, 2: without checksum) is dropped.

Native: one projection over the texts, no shuffle, no Python. A text's matches and the pieces
between them (``split`` by the same expression) give the offsets as running sums, which are taken
in two levels (within blocks and over blocks), so that a text with very many spans stays near linear. The
expressions are possessive where the base's greedy ones never need to give back, so long runs
neither recurse nor are tried again from each of their characters.

Defined cases: null and empty texts have no spans; offsets are code points, end exclusive; every
row is a row of its own, whatever its id; ``carry`` columns go through unread, other columns are not read;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import col

THRESHOLD = 50
NEAR_BEFORE, NEAR_AFTER = 40, 20
CONTEXT_BONUS, AGAINST_MALUS = 40, 30
AGAINST = "version|release|order|invoice|isbn|serial|part|sku|build"
BLOCK = 256
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "tel")   # also the order of spans with one start


@dataclass(frozen=True)
class Proposal:
    kind: str
    pattern: str             # for Spark (Java); possessive
    plain: str               # the same matches without possessive forms and look-behinds (RE2)
    confidence: int
    words: str               # context words, lower case
    level: int = 0           # class of the span
    base: bool = False
    edge: str = ""           # characters (a class body) that must not touch the span on either side


_PARTS = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
_PHONE_WORDS = "phone|tel|telephone|call|mobile|cell|fax|whatsapp"
PROPOSALS = (
    Proposal("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
             r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 90, "email|mail|contact|write", base=True),
    Proposal("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _PARTS, 60, "ip|address|host|server|client|login", base=True),
    # runs of fewer than 14 digits would fail, so they are not proposed
    Proposal("card", r"[0-9](?:[ -]?+[0-9]){13,}+", r"[0-9](?:[ -]?[0-9])+", 80, "card|visa|mastercard|credit|debit|payment|cvv", base=True),
    Proposal("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", 70, _PHONE_WORDS, base=True),
    Proposal("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
             85, "iban|account|bank|transfer", edge="A-Za-z0-9"),
    Proposal("card", r"[0-9]{14,}+", r"[0-9]+", 60, "card|visa|mastercard|credit|debit|payment|cvv", level=1),
    Proposal("phone", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{4}", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{4}",
             60, _PHONE_WORDS, level=1, edge="0-9"),
    Proposal("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 30, "ssn|social|security|taxpayer", level=2, edge="0-9-"),
    Proposal("tel", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", 30, _PHONE_WORDS, level=2, edge="0-9-"),
)
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_VALID = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"
NOT_SSN = "^(?:000|666|9)|-00-|-0000$"


def near_words(words: str) -> str:
    return f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"


# ---------------------------------------------------------------- column helpers

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: int, merge: Callable[[Column, Column], Column]) -> Column:
    """Running ``merge`` (associative, identity ``zero``) of an array of longs, itself included.

    Appending to an array copies it, so this goes by blocks, then over the blocks' last values."""
    first = F.array(F.lit(zero).cast("long"))

    def append(done: Column, x: Column) -> Column:
        return F.concat(done, F.array(merge(F.element_at(done, -1), x)))

    def cut(all_: Column) -> Column:
        n = F.ceil(F.size(all_) / F.lit(BLOCK)).cast("int")
        return F.transform(F.sequence(F.lit(1), n), lambda k: F.aggregate(F.slice(all_, (k - 1) * BLOCK + 1, BLOCK), first, append))

    def join(inner: Column) -> Column:
        return let(F.aggregate(inner, first, lambda done, b: append(done, F.element_at(b, -1))),
                   lambda heads: F.flatten(F.transform(inner, lambda b, k: F.transform(
                       F.slice(b, F.lit(2), F.size(b) - 1), lambda x: merge(F.get(heads, k), x)))))

    return let(values, lambda v: F.when(F.size(v) == 0, v).otherwise(let(cut(v), join)))


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether at most 20 digits pass Luhn: from the right every second digit counts as its double's digit sum."""
    def total(p: Column) -> Column:
        doubled = F.translate(p, "0123456789", "0246813579")
        return sum((F.ascii(F.substring(p if i % 2 == 0 else doubled, i, 1)) - 48 for i in range(1, 21)), F.lit(0))
    return let(F.lpad(number, 20, "0"), total) % 10 == 0


def mod97(number: Column) -> Column:
    """Whether an account number (capitals and digits) has the rest 1 when its first four characters
    go to the end and letters count as 10 to 35."""
    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    def rest(s: Column) -> Column:
        characters = F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substring(s, i, F.lit(1)))
        return F.aggregate(characters, F.lit(0), step)
    return let(F.concat(F.substring(number, 5, 40), F.substring(number, 1, 4)), rest) == 1


def _valid(p: Proposal, hit: Column) -> Column:
    if p.kind == "ip":
        return hit.rlike(IP_VALID)
    if p.kind == "card":
        return let(digits(hit), lambda d: F.length(d).between(14, 19) & luhn(d))
    if p.kind == "phone":
        return F.length(digits(hit)).between(10, 15)
    if p.kind == "iban":
        return let(F.replace(hit, F.lit(" "), F.lit("")), lambda n: F.length(n).between(15, 34) & mod97(n))
    if p.kind == "ssn":
        return ~hit.rlike(NOT_SSN)
    return F.lit(True)


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _spans(text: Column, p: Proposal) -> Column:
    """The confirmed spans of one proposal, as structs that sort in the order of spans."""
    def struct(start: Column, end: Column, hit: Column, before: Column, after: Column) -> Column:
        near = F.concat_ws("#", _lower(before), _lower(after))
        score = (F.lit(p.confidence) + F.when(near.rlike(near_words(p.words)), CONTEXT_BONUS).otherwise(0)
                 - F.when(near.rlike(near_words(AGAINST)), AGAINST_MALUS).otherwise(0))
        fine = _valid(p, hit)
        if p.edge:
            fine = fine & ~before.rlike(rf"[{p.edge}]\z") & ~after.rlike(f"^[{p.edge}]")
        if not p.base:
            fine = fine & (score >= THRESHOLD)
        return F.struct(start.alias("start"), F.lit(KINDS.index(p.kind)).alias("rank"), end.alias("end"), F.lit(p.level).alias("level"),
                        F.lit(p.base).alias("base"), F.least(score, F.lit(100)).alias("score"), fine.alias("fine"))

    def placed(hits: Column, pieces: Column) -> Column:
        lengths = F.transform(hits, lambda h, i: (F.length(F.get(pieces, i)) + F.length(h)).cast("long"))
        return let(running(lengths, 0, lambda a, b: a + b), lambda ends: F.transform(hits, lambda h, i: struct(
            F.get(ends, i) - F.length(h), F.get(ends, i), h,
            F.substring(F.get(pieces, i), -NEAR_BEFORE, NEAR_BEFORE), F.substring(F.get(pieces, i + 1), 1, NEAR_AFTER))))

    def found(hits: Column) -> Column:
        spans = let(F.split(text, p.pattern, -1), lambda pieces: placed(hits, pieces))
        return F.when(F.size(hits) == 0, F.lit(None)).otherwise(F.filter(spans, lambda s: s["fine"]))

    must = {"email": "@", "phone": "+"}.get(p.kind, "")
    hits = F.regexp_extract_all(text, F.lit(p.pattern), F.lit(0))
    return let(F.when(F.contains(text, F.lit(must)), hits).otherwise(F.array().cast("array<string>")) if must else hits, found)


def _resolved(spans: Column) -> Column:
    """Sorted spans without those that overlap one of a lower class."""
    far = 1 << 62

    def reach(s: Column, level: int) -> Column:
        return running(F.transform(s, lambda x: F.when(x["level"] < level, x["end"]).otherwise(F.lit(0).cast("long"))), 0, F.greatest)

    def onset(s: Column, level: int) -> Column:
        starts = F.transform(F.reverse(s), lambda x: F.when(x["level"] < level, x["start"]).otherwise(F.lit(far)))
        return F.reverse(running(starts, far, F.least))

    def keep(s: Column, e: Column) -> Column:
        def free(x: Column, i: Column) -> Column:
            return F.when(x["level"] == 0, True).otherwise(
                (F.get(F.get(e, x["level"] - 1)["reach"], i) <= x["start"]) & (F.get(F.get(e, x["level"] - 1)["onset"], i) >= x["end"]))
        return F.filter(s, free)

    def resolve(s: Column) -> Column:
        ends = F.array(*[F.struct(reach(s, level).alias("reach"), onset(s, level).alias("onset")) for level in (1, 2)])
        return F.when(~F.exists(s, lambda x: x["level"] > 0), s).otherwise(let(ends, lambda e: keep(s, e)))

    return let(F.array_sort(spans), resolve)


# ---------------------------------------------------------------- operator

def find_spans(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] | list[str] = ("doc_id",)) -> DataFrame:
    """row (a struct of the ``carry`` columns) and spans: an array of (start, end, kind, base, score),
    in the order of start, kind (as in ``KINDS``) and end."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    whole = let(text, lambda t: _resolved(F.flatten(F.array_compact(F.array(*[_spans(t, p) for p in PROPOSALS])))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return docs.select(F.struct(*[col(c).alias(c) for c in carry]).alias("row"), whole.alias("found")).select("row", F.transform(
        "found", lambda x: F.struct(x["start"], x["end"], F.get(names, x["rank"]).alias("kind"), x["base"], x["score"])).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] | list[str] = ("doc_id",)) -> DataFrame:
    """row and the text with every span (overlapping ones as one) replaced by its kind in brackets."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    found = find_spans(docs.select(*[col(c) for c in docs.columns], text.alias("redact text")), "redact text", [*carry, "redact text"])
    found = found.select(F.col("row").alias("held"), "spans")

    def shown(s: Column) -> Column:
        # a span that begins behind the reach of those in front of it opens a new mark; each mark is followed by the text up to the next
        reach = running(F.transform(s, lambda x: x["end"]), 0, F.greatest)
        body = F.col("held")["redact text"]

        def part(r: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                front = F.when(i == 0, 0).otherwise(F.get(r, i - 1))
                return F.when(x["start"] >= front, F.concat(F.substring(body, (front + 1).cast("int"), (x["start"] - front).cast("int")),
                                                            F.lit("["), x["kind"], F.lit("]"))).otherwise("")
            return F.concat(F.array_join(F.transform(s, one), ""), F.substring(body, (F.element_at(r, -1) + 1).cast("int"), F.length(body)))
        return let(reach, part)

    return found.select(F.struct(*[F.col("held")[c].alias(c) for c in carry]).alias("row"),
                        F.when(F.size("spans") == 0, F.col("held")["redact text"]).otherwise(let(F.col("spans"), shown)).alias("text"))
