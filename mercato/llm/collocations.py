"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Every word position of every piece of text points at the suffix that begins there;
suffixes are compared word by word down to ``DEPTH`` words.  Sorting the pointers by
multikey (radix) quicksort puts equal prefixes into the *equal* partitions, whose
sizes are the counts of the phrases; a partition lighter than the least count is
abandoned unsorted, since no phrase in it can be frequent.

1. **Words.**  One pass counts the words per language (counted per chunk before
   the shuffle); phrases need these as their one-word parts.
2. **Routing.**  A second pass folds equal suffixes of a chunk into one with a
   weight and sends each to the bucket of its language and two leading words, so all
   suffixes of a two-word prefix meet.  Prefixes of two *hot* words (each at least
   ``1 / share`` of all words, so few words are) could outgrow a bucket; they are
   dealt by all three words instead and their two-word counts added up afterwards.
   The number of buckets follows the number of words (``BUCKET_WORDS``).
3. **Sorting.**  Each bucket is sorted on its own: prefixes that a hashed count
   shows to be rare are abandoned at once, the others sorted, all active partitions
   one step at a time with numpy.  A bucket emits phrases and counts: only frequent phrases, and the
   partial two-word counts of hot words, leave it.
4. **Scores.**  Joins of the frequent phrases with their parts; decimal arithmetic,
   which is exact for counts up to 10 ** 15.

Chunks of text go to Python as Arrow buffers and are cut into words with numpy on
bytes: a document is taken whole whatever its length, and a long one is a chunk of its own.

Null and empty texts hold no words; a null lang is ``und``; a null or repeated doc_id
plays no part, repeated rows count each time; an empty table gives no rows; ties are
broken as ``top`` says; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import materialise

DEPTH = 3
LEAST = 10            # occurrences of a phrase that is kept
TOP = 2000
CHUNK_BYTES = 8 << 20  # text cut into words at once
BUCKET_WORDS = 2_000_000
MOST_SHARES = 1 << 16  # hot words are at most so many
COVER_PERCENT = 50     # a longer phrase with this share of the count drops the shorter
UNDEFINED = "und"

_BREAKS = b".,;:!?\n\x0b\x0c\r"
# A-Z lower-cased, white space and breaks as the bytes 0x20 and 0x0A
_PLAIN = bytes(10 if c in _BREAKS else 32 if c in b"\t " else c + 32 if 65 <= c <= 90 else c for c in range(256))
CELLS = 1 << 22  # cells of the table that abandons rare prefixes before the sort


# ------------------------------------------------------------------ words of a chunk
def cut(texts: list[bytes], pieces: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray | None]:
    """(distinct words, word number per position, piece number per position) of
    UTF-8 texts; A-Z lower-cased, texts and pieces never joined."""
    raw = np.frombuffer(b"\n".join(texts).translate(_PLAIN), np.uint8)
    broken = raw == 10
    inside = (raw != 32) & ~broken
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1 if len(raw) else np.zeros(0, np.int64)
    if len(raw) and inside[0]:
        edge = np.concatenate([[0], edge])
    if len(raw) and inside[-1]:
        edge = np.concatenate([edge, [len(raw)]])
    starts, ends = edge[::2], edge[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
    piece = np.cumsum(broken, dtype=np.int64)[starts] if pieces else None
    return words.dictionary, words.indices.to_numpy().astype(np.int64), piece


def suffixes(ids: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Suffixes of two words or more, cut off at three: a row of word numbers plus
    one each, 0 past the end of the piece; equal ones folded, weight in the last column."""
    one = ids + 1
    two, three = np.zeros_like(one), np.zeros_like(one)
    two[:-1] = np.where(piece[1:] == piece[:-1], one[1:], 0)
    three[:-2] = np.where(piece[2:] == piece[:-2], one[2:], 0)
    keep = two > 0
    one, two, three = one[keep], two[keep], three[keep]
    base = int(ids.max(initial=0)) + 2
    if base ** 3 >= 1 << 63:  # a very long text with millions of words: fold pairs first
        pairs, pair = np.unique(one * base + two, return_inverse=True)
        found, weight = np.unique(pair * base + three, return_counts=True)
        head = pairs[found // base]
        return np.stack([head // base, head % base, found % base, weight], 1)
    found, weight = np.unique((one * base + two) * base + three, return_counts=True)
    head = found // base
    return np.stack([head // base, head % base, found % base, weight], 1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, texts) of one language each; what is held stays below 3 chunks and a text."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            held.setdefault(lang, []).append(text.as_py())
            size[lang] = size.get(lang, 0) + len(held[lang][-1]) + 1
            if size[lang] >= CHUNK_BYTES:
                yield lang, held.pop(lang)
                del size[lang]
            elif sum(size.values()) >= 3 * CHUNK_BYTES:
                yield from held.items()
                held, size = {}, {}
    yield from held.items()


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNDEFINED)).alias("lang"),
                       F.col(f"`{text_col}`").alias("text")).where(F.length("text") > 0)


# ------------------------------------------------------------------ words
def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) over all of ``texts`` (lang, text)."""
    def run(batches):
        for lang, part in _chunks(batches):
            words, ids, _ = cut(part, pieces=False)
            n = np.bincount(ids, minlength=len(words))
            for k in range(0, len(words), 50_000):
                w = words.slice(k, 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(w)), w.cast(pa.large_string()).cast(pa.string()),
                     pa.array(n[k:k + 50_000])], ["lang", "word", "n"])
    return (texts.mapInArrow(run, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


# ------------------------------------------------------------------ routing
def _mix(*parts: np.ndarray) -> np.ndarray:
    h = np.uint64(0x9E3779B97F4A7C15)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(32))
    return h


def route(texts: DataFrame, hot: dict[str, set[bytes]], buckets: int) -> DataFrame:
    """(bucket, lang, words, rows): folded suffixes by bucket, a block of words
    (one per line) and of rows (word numbers plus one, weight) per chunk."""
    told = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for lang, part in _chunks(batches):
            words, ids, piece = cut(part)
            every = words.to_pylist()
            rows = suffixes(ids, piece)
            del ids, piece
            mark = np.array([0] + [zlib.crc32(w) for w in every], np.uint64)
            often = told.value.get(lang, ())
            is_hot = np.array([False] + [w in often for w in every])
            spread = is_hot[rows[:, 0]] & is_hot[rows[:, 1]]
            tail = np.where(spread, mark[rows[:, 2]] + np.uint64(1), np.uint64(0))
            first = np.full(len(rows), zlib.crc32(lang.encode()), np.uint64)
            to = (_mix(first, mark[rows[:, 0]], mark[rows[:, 1]], tail) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            rows, to = rows[order], to[order]
            seen = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, int)
            for a, b in zip(seen, [*seen[1:], len(to)]):
                used, local = np.unique(rows[a:b, :DEPTH], return_inverse=True)
                shift = 0 if used[0] == 0 else 1  # number 0 stays the end of a piece
                block = np.concatenate([local.reshape(b - a, DEPTH) + shift, rows[a:b, DEPTH:]], 1)
                lines = b"\n".join(every[i - 1] for i in used if i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([to[a]], pa.int32()), pa.array([lang]), pa.array([pack(lines)], pa.binary()),
                     pa.array([pack(np.ascontiguousarray(block.T, "<u4").tobytes())], pa.binary())],
                    ["bucket", "lang", "words", "rows"])
    return texts.mapInArrow(run, "bucket int, lang string, words binary, rows binary")


# ------------------------------------------------------------------ sorting
def multikey_quicksort(keys: np.ndarray, weight: np.ndarray, least: tuple[int, ...]
                       ) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to the columns of ``keys`` (depth x n).

    Returns (depth, pointer, count) arrays: one pointer into each equal partition of
    that depth whose weight reaches ``least[depth - 1]``, with that weight.  Every
    round splits each active partition at its pivot into less, equal and greater; the equal
    part moves on to the next key.  A partition is abandoned when its weight can no
    longer reach the least of any depth still ahead.
    """
    deepest = len(keys)
    ahead = [min(least[d:]) for d in range(deepest)] + [np.iinfo(np.int64).max]
    found = []
    # per depth: pointers, weights and keys of its active partitions, and where these begin
    active = {0: (np.arange(keys.shape[1]), weight, keys[0], np.zeros(1 if keys.shape[1] else 0, np.int64))}
    while active:
        depth = min(active)
        pointer, heavy, key, begin = active.pop(depth)
        deeper = []
        while len(begin):
            size = np.diff(np.append(begin, len(key)))
            three = np.sort(np.stack([key[begin], key[begin + size // 2], key[begin + size - 1]]), axis=0)
            pivot = np.repeat(three[1], size)
            less, equal = key < pivot, key == pivot
            rest = []
            for side in (less, equal, ~(less | equal)):
                n = np.add.reduceat(side, begin, dtype=np.int64)
                total = np.add.reduceat(np.where(side, heavy, 0), begin)
                is_equal = side is equal
                if is_equal:
                    good = total >= least[depth]
                    if good.any():  # the first pointer stands for its partition
                        first = pointer[side][np.concatenate([[0], np.cumsum(n)[:-1]])[good]]
                        found.append((depth + 1, first, total[good]))
                live = (n > 0) & (total >= ahead[depth + is_equal])
                if not live.any():
                    continue
                keep = side & np.repeat(live, size)
                n = n[live]
                p = pointer[keep]
                part = (p, heavy[keep], keys[depth + 1][p] if is_equal else key[keep], n)
                (deeper if is_equal else rest).append(part)
            pointer, heavy, key, begin = _laid_out(rest)
        if deeper:
            active[depth + 1] = _laid_out(deeper)
    return found


def _laid_out(parts: list) -> tuple:
    """Parts one after another; of their sizes, where each partition begins."""
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    pointer, heavy, key, n = (np.concatenate(x) for x in zip(*parts))
    return pointer, heavy, key, np.concatenate([[0], np.cumsum(n)[:-1]])


def not_surely_rare(keys: np.ndarray, weight: np.ndarray, least: int) -> np.ndarray:
    """Which columns may have a two-word prefix of weight ``least``: prefixes are added up
    by a hash, and a cell below that holds no such prefix, so all in it is abandoned."""
    cell = ((keys[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + keys[1].astype(np.uint64))
            * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(42)).astype(np.int64) % CELLS
    return (np.bincount(cell, weights=weight, minlength=CELLS) >= least)[cell]


def _phrases(blocks: list[tuple[bytes, bytes]], lang: str, hot: set[bytes], least: int) -> Iterator[pa.RecordBatch]:
    """Frequent phrases of one bucket and language; whole: the count is final."""
    number: dict[bytes, int] = {}
    parts = []
    for words, rows in blocks:
        lines = zstandard.decompress(words).split(b"\n")
        ids = np.array([0] + [number.setdefault(w, len(number) + 1) for w in lines], np.int64)
        block = np.frombuffer(zstandard.decompress(rows), "<u4").reshape(DEPTH + 1, -1)
        parts.append(np.concatenate([ids[block[:DEPTH]], block[DEPTH:].astype(np.int64)]))
    rows = np.concatenate(parts, 1)
    del parts
    every = [b"", *number]
    is_hot = np.array([w in hot for w in every])
    spread = is_hot[rows[0]] & is_hot[rows[1]]
    for hot_ones, minima in ((False, (least, least, least)), (True, (1, 1, least))):
        mine = rows[:, spread == hot_ones]
        if not hot_ones:
            mine = mine[:, not_surely_rare(mine[:2], mine[DEPTH], least)]
        for depth, at, n in multikey_quicksort(mine[:DEPTH], mine[DEPTH], minima):
            phrase = mine[:depth, at]
            if depth == 1 or not len(at):
                continue
            if depth == DEPTH:
                real = phrase[-1] > 0
                phrase, n = phrase[:, real], n[real]
            texts = [pa.array([every[i].decode() for i in column], pa.string()) for column in phrase]
            texts += [pa.nulls(len(n), pa.string())] * (DEPTH - depth)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), *texts, pa.array(n, pa.int64())],
                ["lang", "w1", "w2", "w3", "n"])


def frequent_phrases(routed: DataFrame, hot: dict[str, set[bytes]], least: int = LEAST) -> DataFrame:
    """(lang, w1, w2, w3, n): phrases of two (w3 null) and three words that occur
    ``least`` times or more."""
    told = routed.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        now, blocks = None, []
        for b in batches:
            for bucket, lang, words, rows in zip(*(c.to_pylist() for c in b.columns)):
                if (bucket, lang) != now and blocks:
                    yield from _phrases(blocks, now[1], told.value.get(now[1], set()), least)
                    blocks = []
                now = (bucket, lang)
                blocks.append((words, rows))
        if blocks:
            yield from _phrases(blocks, now[1], told.value.get(now[1], set()), least)

    sorted_ = (routed.repartition("bucket").sortWithinPartitions("bucket", "lang")
               .select("bucket", "lang", "words", "rows"))
    # counts of hot pairs come from several buckets
    return (sorted_.mapInArrow(run, "lang string, w1 string, w2 string, w3 string, n long")
            .groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


# ------------------------------------------------------------------ scores
def _score(a, left, right):
    big = "decimal(15,0)"
    square = a.cast(big) * a.cast(big) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square, left.cast(big) * right.cast(big)).cast("long")


def score(words: DataFrame, phrases: DataFrame, least: int = LEAST, cover: int = COVER_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one drops."""
    w = words.where(F.col("n") >= least)
    two = phrases.where("w3 IS NULL").select("lang", "w1", "w2", F.col("n").alias("a"))
    three = phrases.where("w3 IS NOT NULL").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))

    def word(name: str, count: str) -> DataFrame:
        return w.select("lang", F.col("word").alias(name), F.col("n").alias(count))

    def pair(first: str, second: str, count: str) -> DataFrame:
        return two.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(count))

    longest = (three.select("lang", "w1", "w2", "a")
               .unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
               .groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer")))
    short = (two.join(longest, ["lang", "w1", "w2"], "left")
             .where(F.coalesce(100 * F.col("longer") < cover * F.col("a"), F.lit(True)))
             .join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r",
                     _score(F.col("a"), F.col("l"), F.col("r")).alias("score")))
    cuts = (three.join(word("w1", "l1"), ["lang", "w1"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
            .join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(word("w3", "r2"), ["lang", "w3"])
            .withColumn("s1", _score(F.col("a"), F.col("l1"), F.col("r1")))
            .withColumn("s2", _score(F.col("a"), F.col("l2"), F.col("r2"))))
    first = F.col("s1") <= F.col("s2")  # ties: the earlier cut
    long_ = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                        F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                        F.least("s1", "s2").alias("score"))
    return short.unionByName(long_)


def top(scored: DataFrame, most: int = TOP) -> DataFrame:
    """The first ``most`` of each language by score, count (both descending), phrase;
    ``rank`` from 1.  Slices of a language are ranked first, so no task holds all of one."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(64))
    kept = (scored.withColumn("slice", slice_)
            .withColumn("place", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
            .where(F.col("place") <= most).drop("slice", "place"))
    return (kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= most))


def mine(docs: DataFrame, least: int = LEAST, most: int = TOP, lang_col: str = "lang",
         text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the collocations of each language."""
    spark = docs.sparkSession
    texts = _texts(docs, lang_col, text_col)
    words = materialise(word_counts(texts), "collocation-words")
    totals = words.groupBy("lang").agg(F.sum("n").cast("long").alias("n"))
    every = words.agg(F.sum("n")).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * tasks, -(-every // BUCKET_WORDS))
    share = min(MOST_SHARES, max(1024, 8 * buckets))
    hot: dict[str, set[bytes]] = {}
    for r in words.where(F.col("n") * share >= every).select("lang", "word").collect():  # ``share`` rows at most
        hot.setdefault(r.lang, set()).add(r.word.encode())
    phrases = materialise(frequent_phrases(route(texts, hot, buckets), hot, least), "collocation-phrases")
    return (top(score(words, phrases, least), most).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
cut AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
span AS (SELECT lang, unnest(flatten(list_transform(range(1, len(w) + 1), lambda i:
           list_transform(range(1, least(3, len(w) - i + 1) + 1), lambda k: w[i:i + k - 1])))) AS p FROM cut),
f AS (SELECT lang, p, count(*) AS a FROM span GROUP BY lang, p),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE len(p) >= 2 AND a >= 10),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM cand),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r,
         (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k]
              JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_ AS (SELECT lang, unnest([p[1:2], p[2:3]]) AS p, a FROM cand WHERE len(p) = 3),
longest AS (SELECT lang, p, max(a) AS longer FROM inner_ GROUP BY lang, p),
kept AS (SELECT b.* FROM best b LEFT JOIN longest g ON g.lang = b.lang AND g.p = b.p
         WHERE g.longer IS NULL OR 100 * g.longer < 50 * b.a),
ranked AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM ranked JOIN total USING (lang)
QUALIFY rank <= 2000
"""
