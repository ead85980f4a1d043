"""Personal data: against a plain search in Python, and the registered query against its SQL."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from cardlake.llm import personal_data as P
from cardlake.llm.queries import ORACLE, QUERIES

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SCHEMA = "doc_id long, text string, spans string, kind int"


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in hit.split(".")),
            "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15,
            "iban": lambda: 15 <= len(hit.replace(" ", "")) <= 34 and int("".join(str(int(c, 36)) for c in (hit[4:] + hit[:4]).replace(" ", ""))) % 97 == 1
            if " " not in hit[:4] else False,
            "ssn": lambda: not (hit[:3] in ("000", "666") or hit[0] == "9" or hit[4:6] == "00" or hit[7:] == "0000"),
            "tel": lambda: True}[kind]()


def base_spans(text):
    out = [(m.start(), P.KINDS.index(k), m.end(), k) for k, p in BASE.items() for m in re.finditer(p, text) if valid(k, m.group())]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def all_spans(text):
    found = []
    for p in P.PROPOSALS:
        hits = list(re.finditer(BASE[p.kind] if p.base else p.plain, text))
        for i, m in enumerate(hits):
            before = text[hits[i - 1].end() if i else 0:m.start()][-40:]
            if p.base and p.kind == "card":    # runs of fewer than 14 digits are not proposals
                runs = [h for h in hits[:i] if len(re.sub("[^0-9]", "", h.group())) >= 14]
                before = text[runs[-1].end() if runs else 0:m.start()][-40:]
            if not p.base and p.kind == "card":
                runs = [h for h in hits[:i] if len(h.group()) >= 14]
                before = text[runs[-1].end() if runs else 0:m.start()][-40:]
            following = [h for h in hits[i + 1:] if p.kind != "card" or len(re.sub("[^0-9]", "", h.group())) >= 14]
            after = text[m.end():following[0].start() if following else None][:20]
            near = "#".join([before, after])
            near = "".join(c.lower() if c.isascii() else c for c in near)
            score = (p.confidence + 40 * bool(re.search(P.near_words(p.words), near)) - 30 * bool(re.search(P.near_words(P.AGAINST), near)))
            if not valid(p.kind, m.group()) or not p.base and score < 50:
                continue
            if p.edge and (re.search(f"[{p.edge}]\\Z", before) or re.match(f"[{p.edge}]", after)):
                continue
            found.append((m.start(), P.KINDS.index(p.kind), m.end(), p.level, p.kind))
    kept = [x for x in found if not any(y[3] < x[3] and y[0] < x[2] and y[2] > x[0] for y in found)]
    return [f"{k}:{s}:{e}" for s, _, e, _, k in sorted(kept)]


def card(rnd, n, sep=""):
    d = "".join(rnd.choice("0123456789") for _ in range(n - 1))
    d += next(c for c in "0123456789" if luhn(d + c))
    return sep.join(d[i:i + 4] for i in range(0, n, 4))


FIXED = [
    None, "", " ", "@", "a@b", "a@b.c_d@e.f", "a@b@c.d", "x.y+z@host-1.example.com.", "a@b..c", "é@é.fr ü.x@y.zz",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.01.000.9", "version 1.2.3.4", "1.2.3", "99999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "00000000000000", "4111111111111111 5",
    "call +1 (269) 555-3296 4524132264652876 and", "+1 (269) 555-3296", "+12345", "+1 -", "++49 30 1234567", "+1" + " " * 30 + "x",
    "IBAN GB82 WEST 1234 5698 7654 32 ok", "DE89370400440532013000", "DE89370400440532013001", "xDE89370400440532013000",
    "ssn 123-45-6789", "123-45-6789", "social security 000-45-6789", "my ssn: 123-45-67890", "phone: (269) 555-3296", "order 269.555.3296",
    "tel 555 123 4567, fax 555-123-4568; 555-123-4569", "日本 a@b.co 日本 +81 3 1234 5678", "\U0001F600 mail bob@x.org \U0001F600",
    "Card ⁴ 4111111111111111, serial 4111111111111111", "12 34" * 40,
]


def cases():
    rnd = random.Random(8)
    bits = ["a.b@c.de", "1.2.3.4", "255.255.255.255", "+1 (555) 123-4567", " ", ", ", "é", "ssn ", "phone ", "order ", "123-45-6789",
            "(555) 123-4567", "DE89370400440532013000", ".", "@", "-", "7", "\n", "A", "card "]
    out = list(FIXED)
    out += [card(rnd, rnd.randrange(12, 22), rnd.choice(["", " ", "-"])) + rnd.choice(["", " 1", " x"]) for _ in range(60)]
    out += ["".join(rnd.choice([*bits, card(rnd, 16), card(rnd, 16, " ")]) for _ in range(rnd.randrange(1, 25))) for _ in range(400)]
    out += [" ".join(rnd.choice(["a.b@c.de", "1.2.3.4", "phone (555) 123-4567", card(rnd, 16), "wörd"]) for _ in range(3000))]
    return [(i, t, "clash", 7) for i, t in enumerate(out)] + [(3, "a@b.c", "same id", 1)] * 2


@pytest.fixture(scope="module")
def found(spark):
    rows = cases()
    df = P.find_spans(spark.createDataFrame(rows, SCHEMA).repartition(4), carry=["doc_id", "text", "spans"])
    assert not any(k in df._jdf.queryExecution().toString() for k in ("Python", "Arrow", "Exchange hash"))
    return rows, df.select("row.*", P.span_text(F.col("spans")).alias("got"), F.expr("filter(spans, x -> x.base)").alias("base")).collect()


def test_base_spans(found):
    rows, got = found
    assert len(got) == len(rows)
    for r in got:
        assert [f"{x.kind}:{x.start}:{x.end}" for x in r.base] == base_spans(r.text or ""), r.text


def test_all_spans(found):
    for r in found[1]:
        assert r.got == ",".join(all_spans(r.text or "")), r.text


def test_added_spans_and_context(spark):
    texts = ["call +1 (269) 555-3296 4524132264652876 and", "ssn 123-45-6789", "123-45-6789", "phone: (269) 555-3296", "IBAN GB82 WEST 1234 5698 7654 32 ok"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in P.find_spans(df).select("row.doc_id", P.span_text(F.col("spans")).alias("s")).collect()}
    assert got == {0: "phone:5:22,card:23:39", 1: "ssn:4:15", 2: "", 3: "tel:7:21", 4: "iban:5:32"}
    shown = {r.doc_id: r.text for r in P.redact(df).select("row.doc_id", "text").collect()}
    assert shown == {0: "call [phone] [card] and", 1: "ssn [ssn]", 2: texts[2], 3: "phone: [tel]", 4: "IBAN [iban] ok"}


def test_long_runs_and_many_spans(spark):
    texts = ["1 " * 200_000, "a" * 300_000, "1." * 200_000, "+1" + "(" * 200_000, "a@b.c " * 20_000, "1" * 300_000 + "@", " " * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n, r.last) for r in P.find_spans(df).select("row.doc_id", F.size("spans").alias("n"), F.expr("get(spans, size(spans) - 1).end").alias("last")).collect()}
    assert got == {0: (0, None), 1: (0, None), 2: (50_000, 399_999), 3: (0, None), 4: (20_000, 119_999), 5: (0, None), 6: (0, None)}


def test_query_on_edge_rows_equals_sql_and_search(spark, tmp_path):
    rows = [r for r in cases() if r[2] == "clash"]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_span_rules"](spark, str(tmp_path)).collect()}
    for doc_id, text, *_ in rows:
        base = base_spans(text or "")
        assert got[doc_id].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert tuple(got[doc_id][f"n_{k}"] for k in BASE) == tuple(sum(b.startswith(k + ":") for b in base) for k in BASE)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    res = con.sql(ORACLE["op12_span_rules"])
    for row in res.fetchall():
        want = dict(zip(res.columns, row))
        assert got[want["doc_id"]].asDict() == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.find_spans(empty).isEmpty() and P.redact(empty).isEmpty()
