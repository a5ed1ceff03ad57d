"""Token ids in range-coded blocks.

A static range asymmetric numeral system (rANS): one frequency table, counted
over the whole corpus and stored beside the blocks, codes every block.  A block
holds whole documents, is coded on its own in interleaved lanes (id ``i`` goes to
lane ``i % lanes``), and carries checkpoints (lane states and position in the
words) from which its segments decode independently, each with a checksum.

File format: a folder with ``freq`` (id, freq: the table, sum ``2 ** SCALE``)
and ``blocks`` (Parquet, one row per block, files in ascending id order):
shard, block, first (ids of the shard before the block), doc_ids, doc_lengths,
n_ids, lanes, checkpoints, checksums, payload.  Parquet frames the rows, so any
file system that Spark writes will do.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import gathered, map_rows, materialise
from mercato.session import scratch_path

SCALE = 20  # frequencies sum to 2 ** SCALE; must exceed the vocabulary
LOW = 1 << 31  # a lane's state stays in [LOW, LOW << 32)
BLOCK_IDS = 1 << 18  # a block closes once it holds so many ids
LANES = 1024
SEGMENT_STEPS = 128  # steps (of one id per lane) between checkpoints
END_ID = 0
CHUNK_BYTES = 1 << 20  # text cut into pieces at once; a longer text is a chunk of its own
KNOWN_BYTES = 80 << 20  # ids of pieces remembered: in the table and, twice, in dictionaries of longer ones
ENTRY = 200  # what a dictionary takes for each
KEY = 15  # bytes of the longest piece that the table holds: with its length they fill two words
GATHER_ROWS = 4096  # rows encoded at once; their texts are cut into chunks
SHORT = 64  # bytes of the longest piece that is remembered


# ------------------------------------------------------------------ tokenizing
class PieceTable:
    """Ids of pieces of at most KEY bytes, looked up many at once.

    A piece is two words, its bytes and its length (never 0), which are compared whole; it
    lies at the first free slot from its hash on.  When ``room`` bytes are full, pieces that
    were never asked for again are forgotten.
    """

    def __init__(self, room: int):
        bits = max(4, (room // 33).bit_length() - 1)  # 8 bytes each in four arrays, a flag
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.most = 5 << bits >> 3
        self._clear()

    def _clear(self) -> None:
        slots = self.last + 1
        self.low, self.high = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.where = np.zeros(slots, np.int64)  # start of its ids, times 16, and their number
        self.asked = np.zeros(slots, bool)
        self.ids = np.zeros(2 * slots, np.uint32)
        self.count = self.used = 0

    def _home(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
        return (((mixed >> np.uint64(29)) ^ mixed) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each piece is known, and if so the start and number of its ids."""
        at = self._home(low, high)
        there = self.high[at]
        known = (there == high) & (self.low[at] == low)
        left = np.flatnonzero(~known & (there != 0))
        while len(left):  # slots that hold another piece
            at[left] = p = (at[left] + 1) & self.last
            there = self.high[p]
            known[left] = hit = (there == high[left]) & (self.low[p] == low[left])
            left = left[~hit & (there != 0)]
        self.asked[at] = True  # of a free slot: unset once a piece is put there
        where = self.where[at]
        return known, where >> 4, where & 15

    def followed_by(self, ids: np.ndarray) -> np.ndarray:
        """The ids held and, from ``used`` on, other ones; until the next call."""
        if self.used + len(ids) > len(self.ids):
            return np.concatenate([self.ids[:self.used], ids])
        self.ids[self.used:self.used + len(ids)] = ids
        return self.ids

    def add(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Remember distinct pieces that aren't known, as many as there is room for."""
        if self.count + len(n) > self.most or self.used + len(ids) > len(self.ids):
            kept = np.flatnonzero(self.asked & (self.high != 0))
            size = self.where[kept] & 15
            old = self.low[kept], self.high[kept], _laid(self.ids, self.where[kept] >> 4, size), size
            self._clear()
            if 2 * len(kept) < self.most and 2 * len(old[2]) < len(self.ids):
                self._put(*old)
        fit = min(self.most - self.count, int(np.searchsorted(np.cumsum(n), len(self.ids) - self.used, "right")))
        self._put(low[:fit], high[:fit], ids[:int(n[:fit].sum())], n[:fit])

    def _put(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        where = (self.used + np.cumsum(n) - n) * 16 + n
        self.ids[self.used:self.used + len(ids)] = ids
        self.used, self.count = self.used + len(ids), self.count + len(n)
        at, left = self._home(low, high), np.arange(len(n))
        while len(left):
            p = at[left]
            free = self.high[p] == 0
            self.where[p[free]] = where[left[free]]  # starts differ: whoever reads its own has the slot
            won = free & (self.where[p] == where[left])
            p, had = p[won], left[won]
            self.low[p], self.high[p], self.asked[p] = low[had], high[had], False
            left = left[~won]
            at[left] = (at[left] + 1) & self.last


def _laid(ids: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches ``ids[start:start + n]``, one after the other."""
    after = np.cumsum(n)
    return ids[np.arange(after[-1] if len(n) else 0) + np.repeat(start - (after - n), n)]


# Bytes of a piece that count in its two words, by its length, and the length itself.
_LOW = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(KEY + 2)], np.uint64)
_HIGH = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(KEY + 1)] + [0], np.uint64)
_LENGTH = np.array([n << 56 for n in range(KEY + 1)] + [(1 << 64) - 1], np.uint64)  # longer ones: never in the table


class PieceTokenizer:
    """A byte-level BPE tokenizer that encodes each distinct piece of many texts once.

    The pre-tokenizer never joins text across a single space between two non-white
    characters, nor a letter with a mark after it (an apostrophe apart), nor a single line break
    with a letter after it, so texts are cut there, wherever else they hold odd spacing.  The pieces
    of a chunk are looked up at once (PieceTable), those not known numbered with Arrow and encoded
    by the library, and the ids of all laid out with numpy.  New pieces are encoded side by side
    in one text: a piece that begins with its only space has its ids from the id that holds one,
    and words of letters alone are parted by line breaks.  Texts with a special token's opening are encoded whole.

    Ids of pieces are remembered from chunk to chunk: in the table, and those of more than KEY
    bytes in two generations of KNOWN_BYTES each: when the young one is full, the old one goes.
    Pieces of more than SHORT bytes are never remembered, so memory is bounded whatever the texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.table = PieceTable(KNOWN_BYTES)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        breaks = self._ids("\n")
        self.line_break = breaks[0] if len(breaks) == 1 else -1  # -1: every word alone

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32."""
        out: list[bytes] = [b""] * len(texts)
        plain, raw, size = [], [], 0
        for i, text in enumerate(texts):
            if "<|" in text:
                out[i] = self._ids(text).tobytes()
                continue
            plain.append(i)
            raw.append(text.encode())
            size += len(raw[-1])
            if size >= CHUNK_BYTES:
                self._chunk(plain, raw, out)
                plain, raw, size = [], [], 0
        self._chunk(plain, raw, out)
        return out

    def _chunk(self, places: list[int], raw: list[bytes], out: list[bytes]) -> None:
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        if not len(ends) or not ends[-1]:
            return
        joined = b"".join([*raw, bytes(16)])  # the last piece's words end in these
        whole = np.frombuffer(joined, np.uint8)[:-16]
        starts = np.concatenate([[0], ends[:-1]])
        kind = np.frombuffer(joined.translate(_KINDS), np.uint8)[:-16]
        cut = np.zeros(len(whole), bool)
        cut[starts[starts < ends]] = cut[_safe_spaces(kind, ends)] = True
        cut[1:] |= (kind[:-1] == _LETTER) & (kind[1:] == _MARK)
        cut[2:] |= _is_ink(kind[:-2]) & (kind[1:-1] == _BREAK) & (kind[2:] == _LETTER)
        cuts = np.flatnonzero(cut)
        length = np.minimum(np.diff(cuts, append=len(whole)), KEY + 1)
        words = np.ndarray(len(whole), "V16", joined, strides=(1,))[cuts].view("<u8").reshape(-1, 2)
        low, high = words[:, 0] & _LOW[length], words[:, 1] & _HIGH[length] | _LENGTH[length]
        known, start, n = self.table.find(low, high)
        new = np.flatnonzero(~known)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(whole))), pa.py_buffer(joined)]
        ).take(pa.array(new)).dictionary_encode()
        fresh, begin, size = self._ids_of(pieces.dictionary)
        which = pieces.indices.to_numpy()
        start[new], n[new] = self.table.used + begin[which], size[which]
        every = _laid(self.table.followed_by(fresh), start, n)
        after = np.cumsum(n)
        one = np.zeros(len(size), np.int64)
        one[which] = new  # a place of each new piece
        held = length[one] <= KEY
        self.table.add(low[one[held]], high[one[held]], _laid(fresh, begin[held], size[held]), size[held])
        # a text's ids end where its last piece's do
        last = np.searchsorted(cuts, ends)
        at = np.concatenate([[0], after])[last]
        for i, a, b in zip(places, [0, *at[:-1].tolist()], at.tolist()):
            out[i] = every[a:b].tobytes()

    def _ids_of(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces that the table doesn't hold, and the start and number of each one's."""
        start, n = np.zeros((2, len(pieces)), np.int64)
        laid: list[np.ndarray] = [np.zeros(0, np.uint32)]
        used = 0

        def lay(part: np.ndarray, ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
            nonlocal used
            start[part], n[part] = used + begin, end - begin
            laid.append(ids)
            used += len(ids)

        data, bounds = _buffers(pieces)
        size = np.diff(bounds)
        new = np.ones(len(pieces), bool)
        got: dict[int, bytes] = {}
        long = np.flatnonzero(size > KEY)
        texts = dict(zip(long.tolist(), pieces.take(pa.array(long)).to_pylist()))
        for i, p in texts.items():
            ids = self.young.get(p) or self.old.get(p)
            if ids:
                got[i], new[i] = ids, False
        spaced = new & (size > 1) & (data[bounds[:-1]] == 32) & (_count(data == 32, bounds) == 1)
        lettered = new & (_count((data | 32) - np.uint8(97) < 26, bounds) == size)  # ASCII letters
        alone = new & ~spaced & ~lettered
        which = np.flatnonzero(spaced)
        data, bounds = _buffers(pieces.take(pa.array(which)))
        for k in range(0, len(which), 2000):
            part, end = which[k:k + 2000], min(k + 2000, len(which))
            ids = self._ids(data[bounds[k]:bounds[end]].tobytes().decode())
            at = np.flatnonzero(self.opens[ids])
            if len(at) != len(part) or at[0]:
                alone[part] = True
                continue
            lay(part, ids, at, np.append(at[1:], len(ids)))
        which = np.flatnonzero(lettered)
        for k in range(0, len(which), 2000):
            part = which[k:k + 2000]
            ids = self._ids(b"\n".join(pieces.take(pa.array(part)).to_pylist()).decode())
            at = np.flatnonzero(ids == self.line_break)
            if len(at) != len(part) - 1:
                alone[part] = True
                continue
            lay(part, ids, np.append(0, at + 1), np.append(at, len(ids)))
        which = np.flatnonzero(alone)
        for i, p in zip(which.tolist(), pieces.take(pa.array(which)).to_pylist()):
            got[i] = self._ids(p.decode()).tobytes()
        end = np.cumsum([len(ids) // 4 for ids in got.values()], dtype=np.int64)
        lay(np.array(list(got), np.int64), np.frombuffer(b"".join(got.values()), "<u4"),
            np.append(0, end[:-1])[:len(end)], end)
        every = np.concatenate(laid)
        for i, p in texts.items():
            if new[i] and len(p) <= SHORT:
                self.young[p] = ids = every[start[i]:start[i] + n[i]].tobytes()
                self.held += len(p) + len(ids) + ENTRY
        if self.held > KNOWN_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        return every, start, n

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


def _buffers(pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some pieces and their bounds in them."""
    if not len(pieces):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = pieces.buffers()
    return np.frombuffer(data, np.uint8), np.frombuffer(bounds, np.int64)[pieces.offset:][:len(pieces) + 1]


def _count(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between each two bounds."""
    total = np.append(0, np.cumsum(flags))
    return total[bounds[1:]] - total[bounds[:-1]]


# Kinds of bytes; characters beyond ASCII are told by their first byte.
_OTHER, _SPACE, _BREAK, _LETTER, _MARK, _INK, _NEXT, _LATIN, _WIDE, _DOUBTFUL = range(10)


def _kind_of(byte: int) -> int:
    c = chr(byte)
    if byte >= 0x80:
        # lead bytes of U+0080 .. U+00BF and of U+1000 .. U+3FFF: some of these are white space
        return (_NEXT if byte < 0xC0 else _LATIN if byte == 0xC2 else _DOUBTFUL if 0xE1 <= byte <= 0xE3 else _WIDE)
    if not 32 < byte < 127:  # white space and control
        return {32: _SPACE, 10: _BREAK}.get(byte, _OTHER)
    return _LETTER if c.isalpha() else _INK if c.isdigit() or c == "'" else _MARK


_KINDS = bytes(_kind_of(b) for b in range(256))


def _is_ink(kind: np.ndarray) -> np.ndarray:
    return (kind >= _LETTER) & (kind <= _INK)


def _safe_spaces(kind: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of single spaces between two characters that surely aren't white space.
    Beyond ASCII, characters that share a lead byte with one that is count as such:
    a space beside them is no place to cut, which costs nothing but a longer piece."""
    last = np.zeros(len(kind) + 1, bool)
    last[ends - 1] = True
    at = np.flatnonzero(kind[1:-1] == _SPACE) + 1
    at = at[~last[at]]
    before, after = kind[at - 1], kind[at + 1]
    surely = (before == _NEXT) & (kind[at - 2] != _LATIN) & (kind[at - 3] != _DOUBTFUL) & (at >= 3)
    return at[(_is_ink(before) | surely) & (_is_ink(after) | (after == _WIDE))]


def tokenizer(path: str) -> PieceTokenizer:
    """One per worker process, which keeps what it knows from task to task; it
    hangs on the library's module, as this one travels anew with every task."""
    import tokenizers
    kept = vars(tokenizers).setdefault("_piece_tokenizers", {})
    if path not in kept:
        kept[path] = PieceTokenizer(path)
    return kept[path]


# ------------------------------------------------------------------ coder
class Table:
    """Frequencies of the ids, normalised so that they sum to ``2 ** SCALE``."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.freq = ids[order].astype(np.uint32), freq[order].astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.place = np.zeros(int(self.ids.max(initial=0)) + 1, np.int32)
        self.place[self.ids] = np.arange(len(self.ids))
        self.slot = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))


def normalise(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies of sum ``2 ** SCALE``, at least 1 for every id seen."""
    total, room = int(counts.sum()), (1 << SCALE) - len(counts)
    if room < 0:
        raise ValueError("the vocabulary doesn't fit the scale")
    freq = 1 + np.array([int(c) * room // max(total, 1) for c in counts], np.int64)
    if len(freq):
        freq[int(np.argmax(counts))] += (1 << SCALE) - int(freq.sum())
    return freq


def encode_block(ids: np.ndarray, table: Table) -> dict:
    """Payload, lanes, checkpoints and checksums of one block."""
    n = len(ids)
    lanes = max(1, min(LANES, 1 << max(0, (n // 64).bit_length() - 1)))
    steps = -(-n // lanes)
    sym = table.place[ids]
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks, count = {}, 0
    freq, start = table.freq[sym], table.start[sym]
    limit, rest = freq * np.uint64((LOW >> SCALE) << 32), np.uint64(1 << SCALE) - freq
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x = state[:b - a]
        full = np.flatnonzero(x >= limit[a:b])
        y = x[full]
        out = y.astype("<u4")  # the lower half
        x[full] = y >> np.uint64(32)
        # (x // f << SCALE) + x % f + start
        x += (x // freq[a:b]) * rest[a:b] + start[a:b]
        words.append(out)
        count += len(out)
        if step % SEGMENT_STEPS == 0:
            marks[step] = (count, state.copy())
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    checkpoints = b"".join(
        struct.pack("<I", count - at) + st.astype("<u8").tobytes()
        for _, (at, st) in sorted(marks.items()))
    size = lanes * SEGMENT_STEPS
    sums = [zlib.crc32(ids[i:i + size].astype("<u4").tobytes()) for i in range(0, n, size)]
    return {"n_ids": n, "lanes": lanes, "checkpoints": checkpoints, "checksums": sums,
            "payload": stream.tobytes()}


def decode_segment(block: dict, table: Table, segment: int) -> np.ndarray:
    """Ids of one segment, from its checkpoint alone; raises on a wrong checksum."""
    lanes, n = block["lanes"], block["n_ids"]
    width = 4 + 8 * lanes
    mark = block["checkpoints"][segment * width:(segment + 1) * width]
    at = struct.unpack_from("<I", mark)[0]
    state = np.frombuffer(mark, "<u8", offset=4).astype(np.uint64)
    words = np.frombuffer(block["payload"], "<u4")[at:].astype(np.uint64)
    at = 0
    begin = segment * SEGMENT_STEPS * lanes
    end = min(n, begin + SEGMENT_STEPS * lanes)
    out = np.empty(end - begin, np.int32)
    mask, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for i in range(begin, end, lanes):
        k = min(lanes, end - i)
        x = state[:k]
        low = x & mask
        s = table.slot[low.view(np.int64)]
        out[i - begin:i - begin + k] = s
        x >>= shift
        x *= table.freq[s]
        x += low - table.start[s]
        need = np.flatnonzero(x < np.uint64(LOW))
        x[need] = (x[need] << np.uint64(32)) | words[at:at + len(need)]
        at += len(need)
    ids = table.ids[out]
    if zlib.crc32(ids.astype("<u4").tobytes()) != block["checksums"][segment]:
        raise ValueError(f"segment {segment} doesn't match its checksum")
    return ids


def decode_block(block: dict, table: Table) -> np.ndarray:
    parts = [decode_segment(block, table, k) for k in range(len(block["checksums"]))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


# ------------------------------------------------------------------ on Spark
def tokenize(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, n long, ids binary, counts binary) per row: the ids with the end id, as
    zstd over little-endian uint16 or uint32 (first byte: the width).  Every so many rows
    ``counts`` holds how often each id came since the last (ids, then counts, uint64)."""
    def run(batches):
        t, press = tokenizer(vocabulary), zstandard.ZstdCompressor(level=1)
        for b in gathered(batches, GATHER_ROWS):
            raw = t.encode([x or "" for x in b["text"]])
            ids = [np.append(np.frombuffer(r, "<u4"), np.uint32(END_ID)) for r in raw]
            total = np.bincount(np.concatenate(ids))
            seen = np.flatnonzero(total)
            counts = [None] * (len(ids) - 1) + [press.compress(np.stack([seen, total[seen]]).astype("<u8").tobytes())]
            yield {"doc_id": b["doc_id"], "n": [len(x) for x in ids],
                   "ids": [_pack(x, press) for x in ids], "counts": counts}
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.col(f"`{text_col}`").alias("text"))
    return map_rows(narrow, run, "doc_id long, n long, ids binary, counts binary")


def _pack(ids: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    return bytes([width]) + press.compress(ids.astype(f"<u{width}").tobytes())


def _unpack(data: bytes, opener: zstandard.ZstdDecompressor) -> np.ndarray:
    return np.frombuffer(opener.decompress(data[1:]), f"<u{data[0]}").astype(np.uint32)


def frequencies(tokens: DataFrame) -> DataFrame:
    """(id, freq) of all ids of all documents; at most one row per vocabulary
    entry, counted as they were encoded and added up per task before the shuffle."""
    spark = tokens.sparkSession

    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for data in b["counts"]:
                seen, n = np.frombuffer(zstandard.decompress(data), "<u8").reshape(2, -1).astype(np.int64)
                more = np.bincount(seen, weights=n, minlength=len(total)).astype(np.int64)
                more[:len(total)] += total
                total = more
        seen = np.flatnonzero(total)
        yield {"id": seen, "n": total[seen]}

    rows = (map_rows(tokens.where("counts IS NOT NULL").select("counts"), count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect())
    freq = normalise(np.array([r.n for r in rows], np.int64))
    return spark.createDataFrame([(r.id, int(f)) for r, f in zip(rows, freq)], "id long, freq long")


def load_arrays(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    rows = spark.read.parquet(f"{path}/freq").collect()  # one row per id of the vocabulary at most
    return (np.array([r.id for r in rows], np.int64), np.array([r.freq for r in rows], np.int64))


def write(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Write ``docs`` as token blocks below ``path``, ids in ascending doc_id
    order (rows without an id first; repeated rows as often as they come).

    Null and empty texts hold the end id alone; an empty table gives a table of
    frequencies and blocks without rows.  Other columns play no part.
    """
    spark = docs.sparkSession
    tokens = materialise(tokenize(docs, vocabulary, id_col, text_col), "rans-tokens")
    frequencies(tokens).coalesce(1).write.parquet(f"{path}/freq")
    arrays = spark.sparkContext.broadcast(load_arrays(spark, path))

    def block(table, shard, number, first, held):
        ids = np.concatenate([x for _, x in held])
        return {"shard": shard, "block": number, "first": first,
                "doc_ids": [d for d, _ in held], "doc_lengths": [len(x) for _, x in held],
                **encode_block(ids, table)}

    def run(batches: Iterator[dict]):
        number, first, held, size = 0, 0, [], 0
        shard, table, opener = None, Table(*arrays.value), zstandard.ZstdDecompressor()
        for b in batches:
            shard = b["shard"][0]
            for doc, data in zip(b["doc_id"], b["ids"]):
                ids = _unpack(data, opener)
                held.append((doc, ids))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield _one(block(table, shard, number, first, held))
                    number, first, held, size = number + 1, first + size, [], 0
        if held:
            yield _one(block(table, shard, number, first, held))

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = (tokens.repartitionByRange(tasks, F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
               .select("doc_id", "ids", F.spark_partition_id().alias("shard")))
    (map_rows(ordered, run, "shard int, block int, first long, doc_ids array<long>, "
              "doc_lengths array<long>, n_ids long, lanes int, checkpoints binary, "
              "checksums array<long>, payload binary")
     .write.parquet(f"{path}/blocks"))


def _one(row: dict) -> dict:
    return {k: [v] for k, v in row.items()}


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, if asked for, ids array<int>) per
    document, decoded from the blocks; every segment is held against its checksum."""
    arrays = spark.sparkContext.broadcast(load_arrays(spark, path))
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()  # one row per file
    before, at = {}, 0
    for r in sorted(sizes, key=lambda r: r.shard):
        before[r.shard], at = at, at + r.n

    def run(batches):
        table = Table(*arrays.value)
        for b in batches:
            for i in range(len(b["shard"])):
                row = {k: v[i] for k, v in b.items()}
                ids = decode_block(row, table)
                ends = np.cumsum(row["doc_lengths"])
                parts = [ids[e - n:e] for e, n in zip(ends, row["doc_lengths"])]
                start = before[row["shard"]] + row["first"]
                yield {"doc_id": row["doc_ids"],
                       "start": [start + int(e) - n for e, n in zip(ends, row["doc_lengths"])],
                       "n_tokens": row["doc_lengths"],
                       "ids_crc32": [zlib.crc32(p.astype("<u4").tobytes()) for p in parts],
                       "ids": parts if with_ids else None}

    return map_rows(blocks, run, "doc_id long, start long, n_tokens long, ids_crc32 long"
                    + ", ids array<int>" * with_ids)


def round_trip(docs: DataFrame, vocabulary: str, with_ids: bool = True) -> DataFrame:
    """Write ``docs`` below the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "rans")
    write(docs, path, vocabulary)
    return read(spark, path, with_ids)
