"""Spelling variants: words one edit apart, and from each rare word the way to the common form.

Words are counted in Spark. Two words are near if they differ by exactly one inserted, deleted or
replaced code point. Near words are found by blocked Gram matrices: words of lengths l and l + 1 meet in
the blocks of l; a NumPy product of their letter-count vectors gives all squared distances of a
block, of which an insertion changes 1 and a replacement 2, so pairs at most two apart are
kept and their edits verified on the words themselves.

Which words meet in a block: one edit leaves the front or the back half of a word as it is. A
block's words agree in the first ``lo`` code points and in those from ``hi`` on (counted on
the shorter word); the edit lies between. A block of more than ``LIMIT`` words is
halved again: the edit lies in the back half (front equal) or else in the front half (back
equal). A pair for which both hold counts in the first only, so every pair is found in exactly one
block, and a block's words give partial counts that simply add up: one row per word
and block leaves it, never its pairs. When one code point is left between lo and hi a block has at most
one word per letter and two-letter string, so blocks are bounded whatever the words are.

Defined cases. Null and empty texts have no words; a null id reads as the empty text in the check sum of
``misspelt``; repeated rows count again; letters are ``[A-Za-z\\u00C0-\\u00FF]``, of which only A-Z are lower-cased.
Ties of the largest n go to the smallest word in code-point order. Other columns are not read. Words of any
length are handled (blocks of long words hold fewer of them). Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import col, materialise, shuffle_partitions

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
LIMIT = 8192          # words of a block that is not halved again
TILE = 512            # rows of a Gram matrix
TILE_BYTES = 1 << 22  # of the words of a matrix, and of the pairs verified at a time
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# ---------------------------------------------------------------- words and their counts


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """doc_id and run (lower-cased) of every maximal run of at least ``least`` letters: shorter ones are not emitted."""
    found = F.regexp_extract_all(F.coalesce(col(text_col).cast("string"), F.lit("")), F.lit(rf"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    return docs.select(col(id_col).alias("doc_id"), F.explode(found).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))


def misspelt(run: Column, doc_id: Column) -> Column:
    """The run, without its code point h % length (from 0) where 31 divides h, the crc32 of ``doc_id:run``."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(words: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n for the words (first column) of at least ``least`` code points and ``least_count`` rows."""
    word = col(words.columns[0])
    return (words.select(word.alias("word")).where(F.length("word") >= least)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


# ---------------------------------------------------------------- blocks

def _halved(rows: DataFrame) -> DataFrame:
    """The two blocks that a row of a block goes to; ``word`` is one byte per letter."""
    size = F.length("word")
    middle = "(lo + hi) div 2"
    both = rows.withColumn("part", F.explode(F.array(F.expr(f"named_struct('lo', cast({middle} as int), 'hi', hi)"),
                                                     F.expr(f"named_struct('lo', lo, 'hi', cast({middle} as int))"))))
    both = both.select("word", "n", "l", F.col("part.lo").alias("lo"), F.col("part.hi").alias("hi"))
    back = F.col("l") - F.col("hi")
    return both.withColumn("block", F.xxhash64("l", "lo", "hi", F.substring(F.col("word"), F.lit(1), F.col("lo")),
                                               F.substring(F.col("word"), size - back + 1, back)))


def blocks(words: DataFrame, limit: int = LIMIT, least: int = LEAST_LENGTH) -> DataFrame:
    """word (bytes), n, l, lo, hi, block: each word's rows in the blocks of its own length and of
    the length below."""
    rows = words.select(F.encode("word", "ISO-8859-1").alias("word"), "n").withColumn("l", F.explode(F.array(F.length("word"), F.length("word") - 1)))
    rows = _halved(rows.where(F.col("l") >= least).select("word", "n", "l", F.lit(0).alias("lo"), F.col("l").alias("hi")))
    done = None
    while True:
        wide = rows.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("hi") - F.col("lo")).alias("between")) \
            .where((F.col("rows") > limit) & (F.col("between") > 1)).select("block")
        wide = materialise(wide, "wide-blocks")
        if wide.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(wide, "block", "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        rows = _halved(rows.join(wide, "block", "left_semi"))


# ---------------------------------------------------------------- Gram matrices

_CLASS = np.zeros(256, np.int64)    # letters to dimensions, 0 for the padding; accented letters share some
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[0xC0:] = 27 + np.arange(64) % 22
_DIMENSIONS = 49


def _matrix(words: list[bytes]) -> np.ndarray:
    width = max(map(len, words)) + 1
    return np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(len(words), width)


def _vectors(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter counts of words and their squared lengths; exact, as are all their products."""
    n = len(letters)
    places = _CLASS[letters] + (np.arange(n) * _DIMENSIONS)[:, None]
    counts = np.bincount(places.ravel(), minlength=n * _DIMENSIONS).reshape(n, _DIMENSIONS)[:, 1:]
    counts = counts.astype(np.float32 if letters.shape[1] < 1000 else np.float64)
    return counts, (counts * counts).sum(1)


def _near(a: np.ndarray, b: np.ndarray, longer: np.ndarray, l: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether words ``a`` and ``b`` (b the longer one, if either is) are one edit apart, between lo and hi, and not
    a pair of the block in which the front half agrees."""
    width = a.shape[1]
    row = np.arange(len(a))
    same = a[:, :-1] == b[:, :-1]
    front = np.ones((len(a), width), bool)      # front[f]: the first f agree
    np.logical_and.accumulate(same, axis=1, out=front[:, 1:])
    shifted = np.where(longer[:, None], a[:, :-1] == b[:, 1:], same)
    back = np.ones((len(a), width), bool)       # back[f]: from f on they agree, b shifted by one if it is longer
    back[:, :-1] = np.logical_and.accumulate(shifted[:, ::-1], axis=1)[:, ::-1]
    edit = np.where(longer, (front & back).any(1), (~same).sum(1) == 1)
    first = front[row, hi] & (hi < l)           # the pair meets where the front half agrees
    return edit & front[row, lo] & back[row, hi] & ~first


class _Tiles:
    """Near pairs of blocks of words, as partial results of their words."""

    def __init__(self) -> None:
        self.out: list[tuple[bytes, int, int, bytes]] = []

    def run(self, word: list[bytes], n: np.ndarray, l: np.ndarray, lo: np.ndarray, hi: np.ndarray, block: np.ndarray) -> None:
        """Whole blocks, in order: small ones share a matrix, large ones take several."""
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])).tolist() + [len(word)]
        at = 0
        while at < len(starts) - 1:
            width = max(len(word[i]) for i in range(starts[at], starts[at + 1])) + 1
            stop = at + 1
            while stop < len(starts) - 1:
                wide = max(width, max(len(word[i]) for i in range(starts[stop], starts[stop + 1])) + 1)
                rows = starts[stop + 1] - starts[at]
                if rows > TILE or rows * wide > TILE_BYTES:
                    break
                width, stop = wide, stop + 1
            a, b = starts[at], starts[stop]
            if b - a > 1:
                self._matrices(word[a:b], n[a:b], l[a:b], lo[a:b], hi[a:b], block[a:b], max(1, min(TILE, TILE_BYTES // width)))
            at = stop

    def _matrices(self, word, n, l, lo, hi, block, tile: int) -> None:
        size = np.array([len(w) for w in word])
        pieces = [(i, min(i + tile, len(word))) for i in range(0, len(word), tile)]
        ready = {}
        near = np.zeros(len(word), np.int64)
        best: list[tuple[int, bytes] | None] = [None] * len(word)
        for s, (i0, i1) in enumerate(pieces):
            for t in range(s, len(pieces)):
                j0, j1 = pieces[t]
                for x in (s, t):
                    if x not in ready:
                        letters = _matrix(word[slice(*pieces[x])])
                        ready[x] = (letters, *_vectors(letters))
                (la, ca, qa), (lb, cb, qb) = ready[s], ready[t]
                distance = ca @ cb.T
                distance *= -2
                distance += qa[:, None]
                distance += qb[None, :]
                i, j = np.nonzero(distance <= 2)
                i, j = i + i0, j + j0
                keep = (i < j) & (block[i] == block[j])
                i, j = i[keep], j[keep]
                # blocks of other halves may share a hash; two words of the longer length meet in their own blocks
                keep = (l[i] == l[j]) & (lo[i] == lo[j]) & (hi[i] == hi[j]) & (np.minimum(size[i], size[j]) == l[i])
                i, j = i[keep], j[keep]
                swap = size[i] > size[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                self._verify(word, n, size, l, lo, hi, i, j, near, best)
                if t != s and t != s + 1:
                    del ready[t]        # two matrices at a time are held
            ready = {s + 1: ready[s + 1]} if s + 1 in ready else {}
        for k in np.flatnonzero(near).tolist():
            self.out.append((word[k], int(near[k]), -best[k][0], best[k][1]))

    @staticmethod
    def _verify(word, n, size, l, lo, hi, i, j, near, best) -> None:
        if not len(i):
            return
        width = int(size[j].max()) + 1
        step = max(1, TILE_BYTES // width)
        for at in range(0, len(i), step):
            a, b = i[at:at + step], j[at:at + step]
            members, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            letters = _matrix([word[k] for k in members.tolist()])
            found = _near(letters[place[:len(a)]], letters[place[len(a):]], size[b] > size[a], l[a], lo[a], hi[a])
            for x, y in ((a[found], b[found]), (b[found], a[found])):
                np.add.at(near, x, 1)
                for p, q, m in zip(x.tolist(), y.tolist(), n[y].tolist()):
                    if best[p] is None or (-m, word[q]) < best[p]:
                        best[p] = (-m, word[q])


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial near counts and best near words of the words of each block; rows come sorted by block."""
    held: list = []
    tiles = _Tiles()

    def taken() -> pa.RecordBatch:
        rows, tiles.out = tiles.out, []
        columns = list(zip(*rows)) or [()] * 4
        types = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "near", "best_n", "best"])

    def joined() -> tuple:
        return (sum((h[0] for h in held), []), *[np.concatenate([h[k] for h in held]) for k in range(1, 6)])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = (batch.column(0).to_pylist(), *[batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 6)])
        block = rows[5]
        cut = int(np.flatnonzero(block != block[-1])[-1]) + 1 if (block != block[-1]).any() else 0
        held.append(tuple(c[:cut] for c in rows) if cut else rows)
        if cut:     # all blocks but the last are whole
            tiles.run(*joined())
            held = [tuple(c[cut:] for c in rows)]
        yield taken()
    if held:
        tiles.run(*joined())
        yield taken()


def near_words(words: DataFrame, limit: int = LIMIT, least: int = LEAST_LENGTH) -> DataFrame:
    """word, n_near and best (n, word of the largest near word) of the words that have near ones."""
    spark = words.sparkSession
    rows = (blocks(words, limit, least).select("word", "n", "l", "lo", "hi", "block")
            .repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", "l", "lo", "hi", "word"))
    parts = rows.mapInArrow(_near_words, "word binary, near long, best_n long, best binary")
    return parts.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))).alias("best")).select(
        F.decode("word", "ISO-8859-1").alias("word"), "n_near",
        F.struct((-F.col("best.less")).alias("n"), F.decode("best.form", "ISO-8859-1").alias("word")).alias("best"))


# ---------------------------------------------------------------- forms and roots

def _roots(forms: DataFrame) -> DataFrame:
    """word, root from word, form by pointer doubling: n grows at least ``RATIO`` times with each
    step, so there is no circle and a way of k steps takes about log2(k) rounds."""
    current = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        current = materialise(current.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        if current.where("moved").isEmpty():
            return current.select("word", "root")
        current = current.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, limit: int = LIMIT, least: int = LEAST_LENGTH) -> DataFrame:
    """word, form, root, n, n_near and form_n for ``words`` (word, n) of at least ``least`` code points,
    letters of one byte in ISO-8859-1 each.

    form is the near word of largest n if that n is at least ``ratio`` (above 1) times the word's own, else null."""
    words = materialise(words.select("word", "n"), "spelling-words")
    best = materialise(words.join(near_words(words, limit, least), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), F.col("best.word")).alias("form"),
        F.when(F.col("best.n") >= ratio * F.col("n"), F.col("best.n")).alias("form_n")), "spelling-forms")
    roots = _roots(best.where("form is not null").select("word", "form"))
    return best.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
