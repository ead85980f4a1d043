"""Repair of conversation structure: the cheapest edits that make the roles alternate.

The roles' initials of a repaired conversation match ``(s?(ua)+)?``. Keep costs 0, Rerole (to
user or assistant) 2, Delete 3 and Insert (an empty user or assistant text) 2; a row that is
blank or a duplicate must be deleted, a truncated one that stays costs 1 more. Of the cheapest
edits those with the ASCII-least string of initials D, I, K, R are taken.

Rank-convergence parallel Viterbi. States are what has been said so far: nothing, s, u or a.
``backward`` gives for each row the vector of costs to the end, less its least (a small
number of different vectors: the states' costs differ by a few edits at most). A conversation
is cut into pieces of at most 2**PIECE_BITS rows, which all start from the same speculative vector,
that of a conversation's end. A piece whose successor begins with another vector runs again from
that, until its vectors equal the ones it had: from there on they differ from the true ones only
by a constant, and the constants are sums of the rows' own steps. Passes repeat until no piece is
stale. The edits are then traced forward along the stitched vectors.

What is shuffled: texts once, to the conversation's own task, which reads them as a sorted
stream (the digest of a conversation needs its texts in order), holding one row and the
edit letters; everything else moves keys, digests and a few bytes per row.

Defined cases. Null roles and texts count as one space. Rows go by turn, nulls first, rows of one
turn by role and then by the SHA-256 of their text, so repeated rows are adjacent. Conversations
without an id are one conversation. A role whose initial is not s, u or a can only be reroled or
deleted; an empty role has no initial. Turns that are null don't count for gaps. Other columns are
not read. A conversation of ``ids`` without rows gives zeros, an empty audit and the empty digest;
empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from cardlake.llm.common import col, materialise

PIECE_BITS = 14
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1   # costs
FINE, CUT, BLANK, DUPLICATE = range(4)                    # a row's first fault
START, SYSTEM, USER, ASSISTANT = range(4)                 # what was said last
FORCED = (USER, USER, ASSISTANT, USER)                    # the only user/assistant that may follow
END = bytes((0, 2 * INSERT, INSERT, 0))                   # costs to the end behind the last row
NAME = {USER: "user", ASSISTANT: "assistant"}
BATCH = 4096


# ---------------------------------------------------------------- one row's step

def _kept(state: int, role: int) -> bool:
    """Whether a row of the role (as a state; START: any other role) may follow the state."""
    return role == SYSTEM and state == START or role in (USER, ASSISTANT) and role == FORCED[state]


def _takes(after: bytes, code: int) -> list[int]:
    """Least cost from each state when the next edit uses up the row."""
    role, fault = divmod(code, 4)
    stays = TRUNCATED if fault == CUT else 0
    out = []
    for state in range(4):
        cost = DELETE + after[state]
        if fault < BLANK:
            cost = min(cost, REROLE + stays + after[FORCED[state]])
            if _kept(state, role):
                cost = min(cost, KEEP + stays + after[role])
        out.append(cost)
    return out


def _costs(after: bytes, code: int) -> list[int]:
    """Least cost from each state in front of the row."""
    take = _takes(after, code)
    user, assistant = min(take[USER], INSERT + take[ASSISTANT]), min(take[ASSISTANT], INSERT + take[USER])
    return [min(take[START], INSERT + user), min(take[SYSTEM], INSERT + user), user, assistant]


@lru_cache(maxsize=None)
def before(after: bytes, code: int) -> tuple[bytes, int]:
    """The vector in front of a row, less its least, and that least."""
    cost = _costs(after, code)
    return bytes(c - min(cost) for c in cost), min(cost)


@lru_cache(maxsize=None)
def edits(after: bytes, code: int, state: int) -> tuple[str, int]:
    """The ASCII-least letters of a cheapest way past the row, and the state it leads to."""
    role, fault = divmod(code, 4)
    cost, stays, letters = _costs(after, code), TRUNCATED if fault == CUT else 0, ""
    while True:
        if cost[state] == DELETE + after[state]:
            return letters + "D", state
        if cost[state] == INSERT + cost[FORCED[state]]:
            letters, state = letters + "I", FORCED[state]
        elif _kept(state, role) and cost[state] == KEEP + stays + after[role]:
            return letters + "K", role
        else:
            return letters + "R", FORCED[state]


def backward(codes: bytes, end: bytes) -> tuple[bytes, bytes, int]:
    """(vectors behind each row, the vector in front of the first, its constant) of a piece
    behind which the costs are ``end``."""
    out, vector, total = bytearray(4 * len(codes)), end, 0
    for i in range(len(codes) - 1, -1, -1):
        out[4 * i:4 * i + 4] = vector
        vector, step = before(vector, codes[i])
        total += step
    return bytes(out), vector, total


def fix_up(codes: bytes, vectors: bytes, start: bytes, total: int, end: bytes) -> tuple[bytes, bytes, int]:
    """``backward`` for another ``end``: runs until the vectors are those it had."""
    out, vector = bytearray(vectors), end
    for i in range(len(codes) - 1, -1, -1):
        had = vectors[4 * i:4 * i + 4]
        if had == vector:
            return bytes(out), start, total
        out[4 * i:4 * i + 4] = vector
        vector, step = before(vector, codes[i])
        total += step - before(had, codes[i])[1]
    return bytes(out), vector, total


# ---------------------------------------------------------------- rows and pieces

def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, digest, text of every row; null roles and texts are one space."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(" "))
    return conversations.select(
        col(conv_col).alias("conv"), col(turn_col).cast("long").alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))


def _light(rows: DataFrame, piece_bits: int) -> DataFrame:
    """The rows without texts, in the order of all conversations: pos, chunk, conv, turn, role,
    digest and code (role as a state, and fault as far as a row alone shows it)."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(START)
    body = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(body == "", BLANK).when(F.right(body, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT)
    order = ["conv", "turn", "role", "digest"]
    # rows equal in all of these are interchangeable: a random last key spreads them over partitions
    placed = (rows.select(*order, (role * 4 + fault).cast("int").alias("code")).withColumn("salt", F.rand(11))
              .repartitionByRange(*order, "salt").sortWithinPartitions(*order)
              .drop("salt").withColumn("pos", F.monotonically_increasing_id()))
    return materialise(placed.withColumn("chunk", F.shiftright("pos", piece_bits)), "conversation-rows")


def _piece_schema(light: DataFrame) -> StructType:
    return StructType([light.schema[c] for c in ("conv", "turn", "role", "digest", "chunk")] + [
        StructField("piece", LongType()), StructField("codes", BinaryType()), StructField("vectors", BinaryType()),
        StructField("start", BinaryType()), StructField("end", BinaryType()), StructField("total", LongType())])


def _arrow(columns: dict[str, list], like: pa.Schema) -> pa.RecordBatch:
    fixed = {"piece": pa.int64(), "codes": pa.binary(), "vectors": pa.binary(), "start": pa.binary(), "end": pa.binary(), "total": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(v, fixed[k] if k in fixed else like.field(k).type) for k, v in columns.items()], list(columns))


def _pieces(light: DataFrame) -> DataFrame:
    """One row for each conversation's part of a chunk, with its rows' codes and the vectors that
    follow from the speculative end."""
    firsts = (light.where(F.col("code") % 4 != BLANK).groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos"), F.min("chunk").alias("chunk"))
              .select("chunk", "pos", F.lit(-1).alias("code"), *[F.lit(None).cast(light.schema[c].dataType).alias(c) for c in ("conv", "turn", "role", "digest")]))
    stream = (light.select(*firsts.columns).unionByName(firsts)
              .repartition("chunk").sortWithinPartitions("chunk", "pos", "code"))  # a first row's mark is in front of it
    schema = _piece_schema(light)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {f.name: [] for f in schema.fields}
        key, head, codes, marked, like = None, None, bytearray(), -1, None

        def close() -> None:
            vectors, start, total = backward(bytes(codes), END)
            for name, value in zip(out, (*head, bytes(codes), vectors, start, END, total)):
                out[name].append(value)

        for batch in batches:
            like = batch.schema
            for chunk, pos, code, conv, turn, role, digest in zip(*(c.to_pylist() for c in batch.columns)):
                if code < 0:
                    marked = pos
                    continue
                if head is None or key != (conv, chunk):
                    if head is not None:
                        close()
                    key, head, codes = (conv, chunk), (conv, turn, role, digest, chunk, pos), bytearray()
                codes.append(code if code % 4 == BLANK or marked == pos else code - code % 4 + DUPLICATE)
            if len(out["piece"]) >= BATCH:
                yield _arrow(out, like)
                out = {f.name: [] for f in schema.fields}
        if head is not None:
            close()
            yield _arrow(out, like)

    return materialise(stream.mapInArrow(pack, schema), "conversation-pieces")


def _run_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        for i, due in enumerate(rows.pop("due")):
            if due is not None:
                rows["vectors"][i], rows["start"][i], rows["total"][i] = fix_up(
                    rows["codes"][i], rows["vectors"][i], rows["start"][i], rows["total"][i], due)
                rows["end"][i] = due
        yield _arrow(rows, batch.schema)


def _converge(pieces: DataFrame) -> DataFrame:
    """Passes over the pieces until each one's end is the start of the next of its conversation."""
    following = F.lead("start").over(Window.partitionBy("conv").orderBy("chunk"))  # a row per piece, without its vectors
    while True:
        stale = (pieces.select("conv", "chunk", "piece", "start", "end").withColumn("due", following)
                 .where(F.col("due") != F.col("end")).select("piece", "due"))
        if stale.isEmpty():
            return pieces
        pieces = materialise(pieces.join(stale, "piece", "left").select(*pieces.columns, "due")
                             .mapInArrow(_run_again, pieces.schema), "conversation-pieces")


# ---------------------------------------------------------------- the forward pass

class _Conversation:
    """What the forward pass holds of the conversation it is in."""

    def __init__(self, conv, sink) -> None:
        self.conv, self.sink = conv, sink
        self.codes, self.vectors, self.at = bytearray(), bytearray(), 0
        self.state, self.audit, self.cost, self.first = START, [], 0, True
        self.faults, self.illegal, self.last = [0, 0, 0, 0], 0, None
        self.low = self.high = None
        self.turns = 0

    def piece(self, codes: bytes, vectors: bytes, start: bytes, total: int) -> None:
        self.codes, self.vectors, self.at = bytearray(self.codes[self.at:]) + codes, bytearray(self.vectors[4 * self.at:]) + vectors, 0
        self.cost += total + (start[START] if self.first else 0)
        self.first = False

    def _insert(self, state: int) -> int:
        state = FORCED[state]
        self.sink.put(self.conv, "I", None, NAME[state], b"")
        return state

    def row(self, turn: int | None, role: str, text: bytes) -> None:
        code, after = self.codes[self.at], bytes(self.vectors[4 * self.at:4 * self.at + 4])
        self.at += 1
        self.faults[code % 4] += 1
        initial = role[:1]
        self.illegal += self.last is not None and self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        letters, state = edits(after, code, self.state)
        for _ in letters[:-1]:
            self.state = self._insert(self.state)
        if letters[-1] != "D":
            self.sink.put(self.conv, letters[-1], turn, role if letters[-1] == "K" else NAME[state], text)
        self.audit.append(letters)
        self.state = state

    def close(self) -> None:
        while self.state in (SYSTEM, USER):
            self.audit.append("I")
            self.state = self._insert(self.state)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        self.sink.done(self.conv, (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, self.cost), "".join(self.audit))


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Reports:
    """One row per conversation; the repaired rows go into its digest one by one."""
    fields = [*[StructField(c, LongType()) for c in REPORT], StructField("audit", StringType()), StructField("repaired_sha256", StringType())]
    types = [*[pa.int64()] * len(REPORT), pa.string(), pa.string()]

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.digest, self.empty = hashlib.sha256(), True

    def put(self, conv, edit, turn, role: str, text: bytes) -> None:
        self.digest.update((role if self.empty else "\n" + role).encode() + b":")
        self.digest.update(text)
        self.empty = False

    def done(self, conv, report: tuple, audit: str) -> None:
        self.rows.append((conv, *report, audit, self.digest.hexdigest()))
        self.digest, self.empty = hashlib.sha256(), True


class _Repaired:
    """The repaired rows."""
    fields = [StructField("seq", LongType()), StructField("edit", StringType()), StructField("turn", LongType()),
              StructField("role", StringType()), StructField("text", StringType())]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.seq = 0

    def put(self, conv, edit, turn, role: str, text: bytes) -> None:
        self.rows.append((conv, self.seq, edit, turn, role, text.decode(errors="replace")))
        self.seq += 1

    def done(self, conv, report: tuple, audit: str) -> None:
        self.seq = 0


def _trace(rows: DataFrame, pieces: DataFrame, ids: DataFrame | None, sink_type: type) -> DataFrame:
    """Streams each conversation's pieces and texts in order through the forward pass."""
    empty = {"total": F.lit(None).cast("long"), **{c: F.lit(None).cast("binary") for c in ("data", "vectors", "start")}}
    texts = rows.select("conv", "turn", "role", "digest", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("chunk"),
                        F.col("text").cast("binary").alias("data"), *[empty[c].alias(c) for c in ("vectors", "start", "total")])
    # a piece sorts to its first row; where equal rows span pieces, it comes before those of the piece in front
    parts = pieces.select("conv", "turn", "role", "digest", F.lit(0).alias("kind"), "chunk", F.col("codes").alias("data"), "vectors", "start", "total")
    stream = parts.unionByName(texts)
    if ids is not None:
        stream = stream.unionByName(ids.select(F.col("conv"), F.lit(2).alias("kind")).distinct(), allowMissingColumns=True)
    conv_type = stream.schema["conv"]
    stream = (stream.repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest", "kind", "chunk")
              .select("conv", "kind", "turn", "role", "data", "vectors", "start", "total"))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, now, like = sink_type(), None, pa.null()
        names = ["conv", *[f.name for f in sink_type.fields]]

        def taken() -> pa.RecordBatch:
            held, sink.rows = sink.rows, []
            columns = list(zip(*held)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, [like, *sink_type.types])], names)

        for batch in batches:
            like = batch.schema.field(0).type
            for conv, kind, turn, role, data, vectors, start, total in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv != conv:
                    if now is not None:
                        now.close()
                    now = _Conversation(conv, sink)
                if kind == 0:
                    now.piece(data, vectors, start, total)
                elif kind == 1:
                    now.row(turn, role, data)
                if len(sink.rows) >= BATCH:
                    yield taken()
        if now is not None:
            now.close()
            yield taken()

    return stream.mapInArrow(trace, StructType([conv_type, *sink_type.fields]))


def _repair(conversations: DataFrame, ids: DataFrame | None, sink_type: type, conv_col: str, turn_col: str,
            role_col: str, text_col: str, piece_bits: int) -> DataFrame:
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col)
    pieces = _converge(_pieces(_light(rows, piece_bits)))
    if ids is not None:
        ids = ids.select(col(ids.columns[0]).alias("conv"))
    return _trace(rows, pieces, ids, sink_type)


def repair_reports(conversations: DataFrame, ids: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text", piece_bits: int = PIECE_BITS) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 (of the
    repaired rows as ``role:text``, joined by newlines) of every conversation, and of every
    further one in the first column of ``ids``.

    ``conversations`` is evaluated twice and must give the same rows both times."""
    return _repair(conversations, ids, _Reports, conv_col, turn_col, role_col, text_col, piece_bits)


def repair_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", piece_bits: int = PIECE_BITS) -> DataFrame:
    """conv, seq (from 0), edit (K, R or I), turn (null for inserted rows), role and text of the
    repaired conversations."""
    return _repair(conversations, None, _Repaired, conv_col, turn_col, role_col, text_col, piece_bits)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties
    its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    def text_of(c: str):
        return F.coalesce(col(c).cast("string"), F.lit(" "))

    rows = conversations.select(
        "conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
        (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20).alias("damage"))
    changed = rows.where("damage <> 0").select(
        "conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.expr("array_repeat(0, if(damage = 3, 2, 1))")).alias("copy"))
    return changed.drop("copy")
