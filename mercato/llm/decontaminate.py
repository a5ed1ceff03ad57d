"""Benchmark decontamination: an exact word-count filter, then Smith-Waterman alignment.

A document is contaminated by an item if their local alignment of words (Smith and
Waterman 1981), which finds edited and paraphrased copies, scores a stated share of
what the item would score against itself.  Every pair that can reach the share is
aligned: a passage that does is at most so many words long and holds at least so
many words of the item, whatever was changed in it and however many documents
hold it.  So windows of the text are compared by word counts, then bounded by the
best sum of hits and misses, and only what passes both is aligned.

Items are a stated query set: they go to the executors in blocks of at most
BLOCK_WORDS words, one pass over the documents per block, so the items of a pass
don't outgrow a fixed size.  Items travel, documents don't.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import WORD, map_rows, materialise, words_of

MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SHARE = 0.5  # of an item's own score, for a document to count as contaminated
BLOCK_WORDS = 1_000_000
SLICE = 1_000_000  # pairs of window and item that are counted at once
SPELLINGS = 300_000  # of words that a worker remembers

_EDGE = re.compile(r"^\W+|\W+$")


def normal_words(text: str | None) -> list[str]:
    """Words in lower case without punctuation at their ends."""
    out = []
    for w in WORD.findall((text or "").lower()):
        if not (w[0].isalnum() and w[-1].isalnum()):
            w = _EDGE.sub("", w)
        if w:
            out.append(w)
    return out


# ------------------------------------------------------------------ alignment
def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two arrays of word numbers: its score and the first
    and last place (inclusive) in ``passage``.  Row by row; along a row the best
    chain of gaps is a running maximum, since a gap costs the same per word."""
    m = len(passage)
    if not m or not len(item):
        return 0, 0, -1
    ramp = np.arange(m + 1) * -GAP
    score = np.zeros(m + 1, np.int64)
    begin = np.arange(m + 1)
    best = (0, 0, -1)
    for w in item:
        diag = score[:-1] + np.where(passage == w, MATCH, MISMATCH)
        up = score[1:] + GAP
        new = np.zeros(m + 1, np.int64)
        from_diag = diag >= up
        new[1:] = np.maximum(0, np.maximum(diag, up))
        start = np.arange(m + 1)
        live = new[1:] > 0
        start[1:] = np.where(live, np.where(from_diag, begin[:-1], begin[1:]), start[1:])
        lifted = new + ramp
        top = np.maximum.accumulate(lifted)
        gapped = top - ramp
        better = gapped > new
        if better.any():
            place = np.maximum.accumulate(np.where(lifted == top, np.arange(m + 1), 0))
            start = np.where(better, start[place], start)
            new = np.where(better, gapped, new)
        score, begin = new, start
        j = int(score.argmax())
        if score[j] > best[0]:
            best = (int(score[j]), int(begin[j]), j - 1)
    return best


# ------------------------------------------------------------------ items
class _Numbers(dict):
    """Word as spelt: its number among the items' words, -1 if it is none of
    them, -2 if nothing but punctuation."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __reduce__(self):
        return _Numbers, (self.vocabulary,)

    def __missing__(self, spelt: str) -> int:
        word = spelt if spelt[0].isalnum() and spelt[-1].isalnum() else _EDGE.sub("", spelt)
        number = self.vocabulary.get(word, -1) if word else -2
        if len(self) < SPELLINGS:
            self[spelt] = number
        return number


class Items:
    """The items of one pass, numbered from 0: ids (only passed on), words by
    number, and per word the items that hold it."""

    def __init__(self, rows: list[tuple[int | None, list[str]]], min_share: float = MIN_SHARE):
        vocabulary: dict[str, int] = {}
        number = vocabulary.setdefault
        self.ids = [i for i, _ in rows]
        self.words = [np.array([number(w, len(vocabulary)) for w in words], np.int64) for _, words in rows]
        self.numbers = _Numbers(vocabulary)
        self.min_share = min_share
        sizes = np.array([len(w) for w in self.words], np.int64)
        # 2 * matches - other words of the passage >= share * 2 * size, and matches <= size
        self.need = np.maximum(1, np.ceil(min_share * sizes - 1e-9)).astype(np.int64)
        self.reach = max(1, int(np.ceil((3 - 2 * min_share) * sizes.max(initial=1))))
        pairs, self.times = np.unique(
            np.concatenate([w * len(rows) + i for i, w in enumerate(self.words)] or [np.zeros(0, np.int64)]),
            return_counts=True)
        self.holder = pairs % max(1, len(rows))
        self.first = np.searchsorted(pairs, np.arange(len(vocabulary) + 1) * len(rows))

    def numbered(self, text: str | None) -> np.ndarray:
        """Word numbers of a text, -1 where no item has the word."""
        spelt = words_of((text or "").lower())
        words = np.fromiter(map(self.numbers.__getitem__, spelt), np.int64, len(spelt))
        return words[words > -2]

    def candidates(self, texts: list[np.ndarray]) -> list[tuple[int, int]]:
        """(text, item) of every pair of which some window of the text has as many
        of the item's words as the share needs.  A window is two cells of
        ``reach`` words, the next one begins a cell later: each passage that
        can reach the share lies in one of them."""
        n = len(self.words)
        cells = np.cumsum([0] + [len(w) // self.reach + 1 for w in texts])
        codes = []
        for t, w in enumerate(texts):
            at = np.flatnonzero(w >= 0)
            cell = cells[t] + at // self.reach
            code = cell * len(self.first) + w[at]
            codes += [code, code[cell > cells[t]] - len(self.first)]
        if not codes or not n:
            return []
        codes, count = np.unique(np.concatenate(codes), return_counts=True)
        window, word = np.divmod(codes, len(self.first))
        size = self.first[word + 1] - self.first[word]
        ends = np.cumsum(size)
        found, begin = set(), 0
        while begin < len(codes):
            # whole windows, until the pairs or the counters fill a slice
            low = ends[begin] - size[begin]
            end = min(np.searchsorted(ends, low + SLICE, "right"),
                      np.searchsorted(window, window[begin] + max(1, SLICE // n)))
            if end < len(codes):
                end = np.searchsorted(window, window[end])
            if end <= begin:
                end = np.searchsorted(window, window[begin], "right")
            part = slice(begin, end)
            of = np.repeat(np.arange(begin, end), size[part])
            spot = self.first[word[of]] + np.arange(len(of)) - (ends[of] - size[of] - low)
            key = (window[of] - window[begin]) * n + self.holder[spot]
            hits = np.bincount(key, np.minimum(self.times[spot], count[of]))
            for k in np.flatnonzero(hits >= np.resize(self.need, len(hits))).tolist():
                found.add((int(np.searchsorted(cells, window[begin] + k // n, "right")) - 1, k % n))
            begin = end
        return sorted(found)

    def align(self, words: np.ndarray, item: int) -> tuple[float, int, int] | None:
        """Share of its own score, first and last word of the best place of an item
        in a text; None if it doesn't reach the share.

        A word of the passage counts MATCH at most if the item has it and else
        costs one, so only stretches whose sum reaches the share are aligned."""
        own = MATCH * len(self.words[item])
        has = np.zeros(len(self.first), bool)  # its last place is word -1
        has[self.words[item]] = True
        total = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.where(has[words], MATCH, MISMATCH), out=total[1:])
        if (total - np.minimum.accumulate(total)).max() / own < self.min_share:
            return None
        # best sum of the stretches that hold a word: its best end less its best begin
        best = np.maximum.accumulate(total[:0:-1])[::-1] - np.minimum.accumulate(total[:-1])
        live = np.concatenate([[0], np.minimum(best, own) / own >= self.min_share, [0]]).astype(np.int8)
        turns = np.flatnonzero(np.diff(live)).tolist()
        found = (0, 0, -1)
        for a, b in zip(turns[::2], turns[1::2]):
            score, first, last = smith_waterman(self.words[item], words[a:b])
            if score > found[0]:
                found = (score, a + first, a + last)
        share = found[0] / own
        return (share, found[1], found[2]) if found[0] and share >= self.min_share else None


def _blocks(benchmark: DataFrame):
    """Blocks of items with at most BLOCK_WORDS words each (or one item), in id
    order: every row with a word is an item of its own, whatever its id."""
    block, size = [], 0
    for r in benchmark.orderBy(F.col("item_id").asc_nulls_first(), "text").toLocalIterator():
        words = normal_words(r.text)
        if not words:
            continue
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((r.item_id, words))
        size += len(words)
    if block:
        yield block


# ------------------------------------------------------------------ operator
def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, item_id, share, first_word, last_word) for every document and item
    whose alignment reaches ``min_share`` of the item's own score.

    Texts without a word match nothing, nor do such items.  Every other row of
    either table is searched, also without an id (the result's is null) or with a
    repeated one; repeated rows give repeated results, other columns play no part,
    an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, share double, first_word int, last_word int"
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    out = None
    for block in _blocks(benchmark):
        items = Items(block, min_share)

        def run(batches, items=items):
            for b in batches:
                texts = [items.numbered(t) for t in b["text"]]
                rows = [(b["doc_id"][t], items.ids[i], *m) for t, i in items.candidates(texts)
                        if (m := items.align(texts[t], i))]
                yield {c: [r[k] for r in rows] for k, c in
                       enumerate(("doc_id", "item_id", "share", "first_word", "last_word"))}

        part = materialise(map_rows(narrow, run, schema), "decontaminate")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """``docs`` without the contaminated rows.  Rows are judged where they are read:
    the items travel, so nothing is shuffled or joined."""
    kept = docs
    for block in _blocks(benchmark):
        items = Items(block, min_share)

        def run(batches, items=items):
            import pyarrow as pa
            for batch in batches:
                texts = [items.numbered(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
                clean = [True] * len(texts)
                for t, i in items.candidates(texts):
                    if clean[t] and items.align(texts[t], i):
                        clean[t] = False
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
        kept = kept.mapInArrow(run, docs.schema)
    return kept
