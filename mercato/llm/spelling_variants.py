"""Spelling variants: words one edit apart, by reduced-alphabet generation.

Letters are hashed to ``symbols`` symbols.  Words within one edit of each other have
reduced words within one edit of each other, so the *full* one-edit neighbourhood of
every reduced word, which is short over few symbols, joined to the reduced
vocabulary finds every pair; the pairs are then verified on the original strings.

* A reduced word is carried as a 64-bit code: its digits in base ``symbols + 1``,
  modulo 2 ** 64.  Beyond some 20 letters codes may meet by chance, which costs a
  verification and nothing else.
* Most neighbours are no word's reduction.  They are dropped where they are made
  by a Bloom filter of the reduced vocabulary: ``FILTER_BITS`` bits at most (16 MB),
  built by a bit-wise aggregate.  A fuller filter lets more through to the join, which decides.
* A word's form is its most frequent near word, if that occurs ``ratio`` times as often
  or more; counts grow tenfold along a chain of forms, so a few doublings reach the root.

Null and empty texts hold no words; very long texts and words are taken whole (a word
of L letters has some ``2 * symbols * L`` neighbours); repeated rows count each time; a
null doc_id is written as an empty string before the colon; an empty table gives no
rows.  Among near words of equal count the first in code-point order is the form.
Other columns play no part.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import gathered, map_rows, materialise

SYMBOLS = 8
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
DROP_EVERY = 31  # a run whose crc32 this divides loses a letter
FILTER_BITS = 1 << 27  # the most; BITS_PER_KEY for each reduced word up to there
BITS_PER_KEY = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPREAD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd multipliers
_CELLS = 1 << 16  # letters whose neighbourhoods are made at once, for memory
GATHER = 4096  # words to a batch


# ------------------------------------------------------------------ vocabulary
def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of at least ``min_length`` letters that occur ``min_count`` times or more."""
    runs = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), _UPPER, _LOWER),
                                       F.lit(r"[a-zÀ-ÿ]{%d,}" % min_length), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    word = F.when(h % DROP_EVERY == 0, F.concat(F.expr("left(run, gone)"), F.expr("substring(run, gone + 2)"))
                  ).otherwise(F.col("run"))
    return (runs.withColumn("gone", at).select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# ------------------------------------------------------------------ reduced words
def letter_symbols(symbols: int) -> np.ndarray:
    """Symbol (1 ..) of every code point up to 255, by a hash."""
    return np.array([1 + zlib.crc32(chr(c).encode()) % symbols for c in range(256)], np.uint8)


def reduce_word(word: str, table: np.ndarray) -> bytes:
    return table[np.frombuffer(word.encode("latin-1"), np.uint8)].tobytes()


def codes_of(digits: np.ndarray, base: int) -> np.ndarray:
    """Codes of reduced words of one length (a row each)."""
    code = np.zeros(len(digits), np.uint64)
    for column in digits.T:
        code = code * np.uint64(base) + column
    return code


def neighbourhood(digits: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of the reduced words (rows of one length) and of all words one
    insertion, deletion or replacement away, each once."""
    n, length = digits.shape
    base = np.uint64(symbols + 1)
    d = digits.astype(np.uint64)
    power = np.cumprod(np.concatenate([[1], np.full(length + 1, base)]), dtype=np.uint64)
    before = np.zeros((n, length + 1), np.uint64)  # code of the first i digits
    after = np.zeros((n, length + 1), np.uint64)   # code of the digits from i on
    for i in range(length):
        before[:, i + 1] = before[:, i] * base + d[:, i]
        after[:, length - 1 - i] = d[:, length - 1 - i] * power[i] + after[:, length - i]
    rows, every = [np.arange(n)], [before[:, length]]

    def add(code: np.ndarray, take: np.ndarray) -> None:
        r, c = np.nonzero(take)
        rows.append(r)
        every.append(code[r, c])

    first = np.ones((n, length), bool)
    first[:, 1:] = digits[:, 1:] != digits[:, :-1]  # of equal neighbours one deletion counts
    place = power[length - 1::-1][:length]          # weight of digit i
    add(before[:, :length] * place + after[:, 1:], first)
    for s in range(1, symbols + 1):
        add(before[:, length:] + (np.uint64(s) - d) * place, digits != s)
        ahead = np.ones((n, length + 1), bool)
        ahead[:, 1:] = digits != s  # beside an equal digit the place before it counts
        at = power[length::-1][:length + 1]
        add(before * (at * base) + np.uint64(s) * at + after, ahead)
    return np.concatenate(rows), np.concatenate(every)


def _place(code: np.ndarray, bits: int, k: int) -> np.ndarray:
    """The k-th place of codes in a filter of ``2 ** bits`` bits."""
    return ((code * _SPREAD[k]) >> np.uint64(64 - bits)).astype(np.int64)


def _by_length(reduced: list[bytes]):
    """(indices, digits) of equally long reduced words, some _CELLS digits at a time."""
    at: dict[int, list[int]] = {}
    for i, w in enumerate(reduced):
        at.setdefault(len(w), []).append(i)
    for length, every in at.items():
        step = max(1, _CELLS // max(length, 1))
        for k in range(0, len(every), step):
            part = every[k:k + step]
            yield part, np.frombuffer(b"".join(reduced[i] for i in part), np.uint8).reshape(len(part), length)


def _signed(code: np.ndarray) -> np.ndarray:
    return code.astype(np.uint64).view(np.int64)


def with_codes(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, reduced binary, code long) per word."""
    def run(batches):
        table = letter_symbols(symbols)
        for b in gathered(batches, GATHER):
            reduced = [reduce_word(w, table) for w in b["word"]]
            code = np.zeros(len(reduced), np.uint64)
            for part, digits in _by_length(reduced):
                code[part] = codes_of(digits, symbols + 1)
            yield {"word": b["word"], "n": b["n"], "reduced": reduced, "code": _signed(code)}
    return map_rows(words.select("word", "n"), run, "word string, n long, reduced binary, code long")


def vocabulary_filter(codes: DataFrame) -> np.ndarray:
    """Bit array (uint64 words) of the distinct ``codes``; FILTER_BITS at most."""
    keys = codes.count()
    bits = int(np.clip(int(max(1, keys) * BITS_PER_KEY - 1).bit_length(), 12, FILTER_BITS.bit_length() - 1))

    def run(batches):
        for b in gathered(batches, GATHER):
            code = np.array(b["code"], np.int64).view(np.uint64)
            places = np.concatenate([_place(code, bits, k) for k in range(len(_SPREAD))])
            yield {"block": places >> 6, "bit": places & 63}

    blocks = (map_rows(codes, run, "block long, bit int").groupBy("block")
              .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word")).toPandas())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[blocks["block"].to_numpy(np.int64)] = blocks["word"].to_numpy(np.int64)
    return out.view(np.uint64)


def candidate_codes(reduced: DataFrame, present: np.ndarray, symbols: int = SYMBOLS) -> DataFrame:
    """(code, near): codes of the reduced words (reduced, code) with each neighbour
    that the filter doesn't rule out."""
    told = reduced.sparkSession.sparkContext.broadcast(present)

    def run(batches):
        filled = told.value
        bits = len(filled).bit_length() + 5
        for b in gathered(batches, GATHER):
            codes = np.array(b["code"], np.int64)
            for part, digits in _by_length(b["reduced"]):
                row, near = neighbourhood(digits, symbols)
                for k in range(len(_SPREAD)):
                    place = _place(near, bits, k)
                    set_ = (filled[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
                    row, near = row[set_], near[set_]
                yield {"code": codes[part][row], "near": _signed(near)}

    return map_rows(reduced.select("reduced", "code"), run, "code long, near long")


# ------------------------------------------------------------------ variants
def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, near, near_n): every ordered pair of words exactly one edit apart."""
    coded = materialise(with_codes(words, symbols), "variant-words")
    present = vocabulary_filter(coded.select("code").distinct())
    found = candidate_codes(coded.select("reduced", "code").distinct(), present, symbols)
    own = coded.select("code", "word")
    other = coded.select(F.col("code").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    return (found.join(other, "near").join(own, "code")
            .where(F.levenshtein("word", "near_word", 1) == 1)
            .select("word", F.col("near_word").alias("near"), "near_n").distinct())


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, by doubling."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        new = materialise(now.join(ahead, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")),
            "variant-roots")
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, symbols: int = SYMBOLS, ratio: int = RATIO, **how) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of ``docs``; see the module."""
    words = materialise(vocabulary(docs, **how), "variant-vocabulary")
    best = near_words(words, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    told = words.join(best, "word", "left")
    fits = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    told = materialise(told.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n")),
        "variant-forms")
    last = roots(told.where("form IS NOT NULL").select("word", "form"))
    return told.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
