"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

A text is marked (blanks become ``▁``, one in front) and cut into marked words. The
distinct words of a batch, sorted, are a trie in depth-first order: a word keeps the
forward states of the prefix that it shares with the word before and goes on from there.

The model at hand is a BPE model, whose result is not the segmentation with the best sum
of piece scores; a Viterbi pass over sums would give other ids than the library. The
forward recursion is therefore over what makes a segmentation the BPE one: the encoding of
a prefix ends in exactly one piece, and a piece may follow another only if merging the two
pieces' text by score gives back these two. So the state of a prefix is its last piece, a
step scores 0 or minus infinity, and the backward walk yields the library's ids.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from cardlake.llm.common import blocks, col, utf8

MARK = "▁"
KNOWN_BYTES = 48 << 20    # of encoded words that a worker keeps within a task; beyond, those of the last texts stay
KEPT_BYTES = 20 << 20     # of encoded words between tasks
KNOWN_PAIRS = 250_000     # graded pairs of pieces that a worker keeps; beyond, it starts anew
WORD_BYTES = 250          # what a kept word takes besides its characters and ids
BLOCK_BYTES = 4 << 20     # of texts that are split, encoded and joined at a time
LETTER = 1 << 21          # in front of the code point of a letter outside the vocabulary, to number it as a piece
NOTHING = (1 << 22) - 1   # the piece in front of the first
_WORD = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


class Pieces:
    """The pieces of a model file and the encoder over them."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.bytes_of: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes_of.append(b"" if sp.is_control(i) else " ⁇ ".encode())
            else:
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        crossing = [p for p in self.ids if re.search(f"[^{MARK}]{MARK}", p) or "\n" in p]
        if crossing:
            raise ValueError(f"pieces cross word borders, so words cannot be encoded alone: {crossing[:3]}")
        if not self._is_plain_bpe(model):
            raise ValueError("only BPE models without normaliser rules, with a blank put in front and blanks kept, can be encoded word by word")
        self.ending: dict = {}      # pieces read backwards, letter by letter: what ends at a place; under 0 the piece's id
        for piece, i in self.ids.items():
            node = self.ending
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[0] = i
        self.text_of = {i: p for p, i in self.ids.items()}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.used: set[str] = set()     # words of the last texts
        self.held = 0

    @staticmethod
    def _is_plain_bpe(model: bytes) -> bool:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        rules = proto.normalizer_spec
        return (proto.trainer_spec.model_type == proto.trainer_spec.BPE and not rules.precompiled_charsmap
                and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces)

    def rest(self) -> None:
        """At a task's end keep no more than the words of its last texts: workers are used again by other stages."""
        if self.held > KEPT_BYTES:
            self._keep(self.used)
        if self.held > KEPT_BYTES:
            self._keep(set())

    def _keep(self, used: set[str]) -> None:
        known = self.words
        self.words = {w: known[w] for w in used}
        self.held = self._bytes(self.words)

    @staticmethod
    def _bytes(words: dict[str, bytes]) -> int:
        return sum(map(len, words)) + sum(map(len, words.values())) + WORD_BYTES * len(words)

    def merge(self, text: str) -> list[str]:
        """BPE of a short text: join the neighbours whose joint piece scores best, leftmost first."""
        parts, scores = list(text), self.score
        joint = [scores.get(x + y, -np.inf) for x, y in zip(parts, parts[1:])]
        while joint:
            best = max(joint)
            if best == -np.inf:
                break
            at = joint.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            joint[at:at + 1] = []
            if at:
                joint[at - 1] = scores.get(parts[at - 1] + parts[at], -np.inf)
            if at < len(joint):
                joint[at] = scores.get(parts[at] + parts[at + 1], -np.inf)
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether the piece ``right`` can follow ``left`` (``NOTHING`` in front of the first)."""
        known = self.pairs.get(left << 22 | right)
        if known is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            texts = [self.text_of[x] if x < LETTER else chr(x - LETTER) for x in (left, right) if x != NOTHING]
            known = self.merge("".join(texts)) == texts
            self.pairs[left << 22 | right] = known
        return known

    def encode_sorted(self, words: Sequence[str]) -> dict[str, bytes]:
        """Ids (packed int32) of distinct sorted words."""
        out: dict[str, bytes] = {}
        # of the first i characters: the last piece (a single letter outside the vocabulary is one too) and where it begins
        before, last, begin = "", [NOTHING], [0]
        ending, fits, pairs = self.ending, self.fits, self.pairs
        for word in words:
            same = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                same += 1
            del last[same + 1:], begin[same + 1:]
            for end in range(same, len(word)):
                letter = word[end]
                node = ending.get(letter)
                if node is None:
                    found = [(LETTER + ord(letter), end)]
                else:
                    i = node.get(0)
                    found = [(LETTER + ord(letter) if i is None else i, end)]
                    at = end
                    while at:
                        node = node.get(word[at - 1])
                        if node is None:
                            break
                        at -= 1
                        i = node.get(0)
                        if i is not None:
                            found.append((i, at))
                for i, at in reversed(found):
                    left = last[at]
                    known = pairs.get(left << 22 | i)
                    if known or known is None and fits(left, i):
                        last.append(i)
                        begin.append(at)
                        break
                else:
                    raise AssertionError(f"no piece ends at {end} of {word!r}")
            ids, end = [], len(word)
            while end:
                i = last[end]
                if i < LETTER:
                    ids.append(i)
                else:   # its bytes
                    ids += [self.byte_ids[b] for b in reversed(chr(i - LETTER).encode("utf-8", "replace"))]
                end = begin[end]
            ids.reverse()
            out[word] = array("i", ids).tobytes()
            before = word
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (packed int32) of each text, as the library encodes it; '' gives none."""
        split = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        used = self.used = set().union(*split)
        new = self.encode_sorted(sorted(used.difference(self.words)))
        self.words.update(new)
        self.held += self._bytes(new)
        known = self.words
        if self.held > KNOWN_BYTES:     # for the next texts
            self._keep(used)
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: Sequence[int]) -> bytes:
        """Text of the ids; the blank that encoding put in front goes."""
        text = b"".join(map(self.bytes_of.__getitem__, ids))
        return text[1:] if text[:1] == b" " else text


_MODELS: dict[bytes, Pieces] = {}


def pieces(model: bytes) -> Pieces:
    """The model, loaded once per worker."""
    if model not in _MODELS:
        _MODELS[model] = Pieces(model)
    return _MODELS[model]


def read_model(path: str) -> bytes:
    """The model file, read on the driver (executors get its bytes with the task)."""
    with open(path, "rb") as f:
        return f.read()


def _encoded(model: Pieces, texts: list[bytes]) -> pa.ListArray:
    packed: list[bytes] = []
    for a, b in blocks(texts, BLOCK_BYTES):
        packed += model.encode([t.decode("utf-8", "replace") for t in texts[a:b]])
    ends = np.cumsum([0, *[len(p) // 4 for p in packed]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def _decoded(model: Pieces, ids: pa.ListArray) -> pa.Array:
    ends, values = ids.offsets.to_pylist(), ids.values.to_numpy(zero_copy_only=False)
    there = ids.is_valid().to_pylist()
    return pa.array([model.decode(values[a:b].tolist()) if x else None for a, b, x in zip(ends, ends[1:], there)], pa.binary())


def _run(df: DataFrame, model_path: str, fn: Callable[[Pieces, pa.RecordBatch], pa.RecordBatch], schema: StructType) -> DataFrame:
    """``mapInArrow`` of a function of the model and a batch; what the model keeps of the words is cut down behind it."""
    file = read_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(file)
        try:
            for batch in batches:
                if batch.num_rows:
                    yield fn(model, batch)
        finally:
            model.rest()

    return df.mapInArrow(run, schema)


def _rows(docs: DataFrame, text_col: str, carry: Sequence[str]) -> DataFrame:
    return docs.select(F.struct(*[col(c).alias(c) for c in carry]).alias("row"), utf8(text_col).alias("bytes"))


_IDS = StructField("ids", ArrayType(IntegerType()))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """row (struct of the ``carry`` columns) and ids: the tokens of each whole text.

    One row per input row, without a shuffle. Null and empty texts have no tokens; characters
    outside the vocabulary become bytes. Repeated rows are encoded each; carried columns sit
    in a struct and cannot clash.
    """
    rows = _rows(docs, text_col, carry)

    def one(model: Pieces, batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("row"), _encoded(model, batch.column("bytes").to_pylist())], ["row", "ids"])

    return _run(rows, model_path, one, StructType([rows.schema["row"], _IDS]))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", carry: Sequence[str] = ("row",)) -> DataFrame:
    """The ``carry`` columns and bytes: the UTF-8 text of the ids. Null ids give null."""
    names = [c for c in carry] + [ids_col]
    rows = encoded.select(*[col(c) for c in names])

    def one(model: Pieces, batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [batch.column(c) for c in carry]
        return pa.RecordBatch.from_arrays([*kept, batch.column(ids_col), _decoded(model, batch.column(ids_col))], [*names, "bytes"])

    return _run(rows, model_path, one, StructType([*rows.schema.fields, StructField("bytes", BinaryType())]))


def round_trip(docs: DataFrame, model_path: str, text_col: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """row, ids and bytes: ``encode`` and ``decode`` of each whole text in one pass over the rows."""
    rows = _rows(docs, text_col, carry)

    def one(model: Pieces, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _encoded(model, batch.column("bytes").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("row"), ids, _decoded(model, ids)], ["row", "ids", "bytes"])

    return _run(rows, model_path, one, StructType([rows.schema["row"], _IDS, StructField("bytes", BinaryType())]))
