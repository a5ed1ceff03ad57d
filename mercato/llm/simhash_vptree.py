"""SimHash near-duplicates found with vantage-point trees.

Fingerprints are 64-bit SimHashes of word shingles.  Distinct fingerprints are
dealt into shards by a vantage-point tree fitted on a bounded sample: a node
sends a fingerprint left when its Hamming distance to the vantage point is at
most the node's radius.  Two fingerprints at most ``max_bits`` apart can only
part at a node where one of them lies within ``max_bits`` of the boundary, so a
fingerprint is stored in its home shard and sent as a query to every later shard
its ball overlaps: the shards together find every pair.  Inside a shard a second
tree, over all of its rows, prunes branches by the same triangle bound.

To keep the balls small the 64 bits are cut into ``bands``: of ``max_bits``
differing bits at least one band holds at most ``max_bits // bands``, so a tree
over that band needs no wider ball, and what it finds is checked on all bits.

A shard returns a spanning forest of its links, not the links: the number of
rows stays linear in the shard, however many copies it holds, and the components
are those of the full graph.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import (
    ascii_lower, connected_components, gathered, map_rows, materialise, words_of,
)

SHINGLE = 3
MAX_BITS = 3
BANDS = 2
SAMPLE = 20_000  # fingerprints that place the vantage points; every row is indexed
SHARD_ROWS = 50_000  # fingerprints a shard should hold
LEAF = 192


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text; 0 when it has no word."""
    words = words_of(ascii_lower(text or ""))
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter((hashed(" ".join(words[i:i + shingle]).encode(), 42) for i in range(last)),
                    dtype=np.uint64, count=last)
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, last, 1 << 16):  # bounds the unpacked bits
        part = h[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > last).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp) per row, th the text's xxhash64; null texts count as empty."""
    def run(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "th": b["th"],
                   "fp": [_signed(simhash(t, shingle)) for t in b["text"]]}
    text = F.col(f"`{text_col}`")
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.xxhash64(text).alias("th"), text.alias("text"))
    return map_rows(narrow, run, "doc_id long, th long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# ------------------------------------------------------------------ trees
def band_masks(bands: int) -> list[int]:
    """Masks that cut the 64 bits into ``bands`` runs."""
    cuts = [64 * i // bands for i in range(bands + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def _distance(points: np.ndarray, vantage) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def _pick(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that split ``points`` most evenly, out of a few
    spread-out candidates; None if no candidate splits them."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, 5).astype(np.int64)]:
        d = _distance(points, v)
        radius = int(np.median(d))
        for r in (radius, radius - 1):
            left = int((d <= r).sum())
            if 0 < left < len(points):
                even = min(left, len(points) - left)
                if best is None or even > best[0]:
                    best = (even, v, r)
    return best and (best[1], best[2])


def fit_shards(sample: np.ndarray, mask: int, depth: int) -> list:
    """A tree of at most ``2 ** depth`` shards: a node is (vantage, radius,
    left, right), a leaf its shard number (in order from left to right)."""
    count = [0]

    def grow(points, level):
        split = _pick(points) if level and len(points) > 1 else None
        if split is None:
            count[0] += 1
            return count[0] - 1
        v, r = split
        d = _distance(points, v)
        return [int(v), r, grow(points[d <= r], level - 1), grow(points[d > r], level - 1)]

    return grow(np.unique(sample & np.uint64(mask)), depth)


def deal(tree, points: np.ndarray, ball: int) -> tuple[list[np.ndarray], list[np.ndarray], list[bool]]:
    """Shards of ``points`` (already masked): row numbers, shard and whether it
    is the home shard.  Only later shards are visited besides home: of two
    linked rows that part, the one at home further left asks."""
    rows, shards, homes = [], [], []

    def walk(node, at, home):
        if not len(at):
            return
        if isinstance(node, int):
            rows.append(at)
            shards.append(np.full(len(at), node, np.int32))
            homes.append(home)
            return
        v, r, left, right = node
        d = _distance(points[at], np.uint64(v)).astype(np.int16)
        walk(left, at[d <= r], home)
        walk(right, at[d > r], home)
        # the ball of a row on the left that reaches over the radius
        walk_ball(right, at[(d <= r) & (d + ball > r)])

    def walk_ball(node, at):
        if not len(at):
            return
        if isinstance(node, int):
            rows.append(at)
            shards.append(np.full(len(at), node, np.int32))
            homes.append(False)
            return
        v, r, left, right = node
        d = _distance(points[at], np.uint64(v)).astype(np.int16)
        walk_ball(left, at[d - ball <= r])
        walk_ball(right, at[d + ball > r])

    walk(tree, np.arange(len(points)), True)
    return rows, shards, homes


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def shard_links(points: np.ndarray, queries: np.ndarray, mask: int, max_bits: int, ball: int,
                leaf: int = LEAF) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``points`` and from ``queries`` to
    ``points``, as indices into points followed by queries.

    The tree takes points and asking rows in one batch: a node computes one
    vector of distances, a leaf compares its block.
    """
    everything = np.concatenate([points, queries])
    banded = everything & np.uint64(mask)
    n = len(points)
    forest, out = _Forest(len(everything)), []

    def compare(stored, asking):
        for i in range(0, len(asking), 2048):
            ask = asking[i:i + 2048]
            for j in range(0, len(stored), 2048):
                keep = stored[j:j + 2048]
                near = np.bitwise_count(everything[ask][:, None] ^ everything[keep][None, :]) <= max_bits
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                x, y = ask[a], keep[b]
                for p, q in zip(x[x != y].tolist(), y[x != y].tolist()):
                    if forest.join(p, q):
                        out.append((p, q))

    def walk(stored, asking):
        if not len(stored) or not len(asking):
            return
        split = _pick(banded[stored]) if len(stored) > leaf else None
        if split is None:
            compare(stored, asking)
            return
        v, r = split
        d = _distance(banded[stored], v).astype(np.int16)
        q = _distance(banded[asking], v).astype(np.int16)
        walk(stored[d <= r], asking[q - ball <= r])
        walk(stored[d > r], asking[q + ball > r])

    if n:
        walk(np.arange(n), np.arange(len(everything)))
    return out


# ------------------------------------------------------------------ operator
def links(nodes: DataFrame, max_bits: int = MAX_BITS, bands: int = BANDS,
          sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b) node numbers that span, per component, all pairs of ``nodes`` (fp
    distinct, node) at most ``max_bits`` apart."""
    total = nodes.count()
    picked = (nodes.select("fp", F.xxhash64("fp").alias("h")).where(
        F.expr(f"pmod(h, 1000000) < {min(1_000_000, -(-sample * 1_100_000 // max(total, 1)))}"))
        .orderBy("h").limit(sample).select("fp").collect())
    points = np.array([r.fp for r in picked], dtype=np.int64).view(np.uint64)
    depth = max(1, int(np.ceil(np.log2(max(2, total / shard_rows)))))
    masks = band_masks(bands)
    ball = max_bits // bands
    trees = [fit_shards(points, m, depth) for m in masks]

    def send(batches):
        for b in gathered(batches, 1 << 16):
            fp = np.array(b["fp"], dtype=np.int64)
            node = np.array(b["node"], dtype=np.int64)
            for k, m in enumerate(masks):
                rows, shards, homes = deal(trees[k], fp.view(np.uint64) & np.uint64(m), ball)
                for at, shard, home in zip(rows, shards, homes):
                    yield {"band": [k] * len(at), "shard": shard, "home": [home] * len(at),
                           "fp": fp[at], "node": node[at]}

    def search(frame):
        import pandas as pd
        home = frame.home.to_numpy()
        at = np.concatenate([np.flatnonzero(home), np.flatnonzero(~home)])
        fp = frame.fp.to_numpy(np.int64)[at].view(np.uint64)
        node = frame.node.to_numpy(np.int64)[at]
        n = int(home.sum())
        found = shard_links(fp[:n], fp[n:], masks[int(frame.band.iloc[0])], max_bits, ball)
        return pd.DataFrame({"a": node[[x for x, _ in found]], "b": node[[y for _, y in found]]},
                            dtype="int64")

    sent = map_rows(nodes.select("fp", "node"), send,
                    "band int, shard int, home boolean, fp long, node long")
    return sent.groupBy("band", "shard").applyInPandas(search, "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int,
             bands: int, shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, th, fp) and classes (fp, component_id, keep_id, keep_th): the
    fingerprint is the node, so repeated or missing ids can't merge two texts."""
    spark = docs.sparkSession
    fps = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th"))
    nodes = materialise(fps.groupBy("fp").agg(first.alias("first")), "simhash-nodes")
    found = materialise(
        links(nodes.select("fp", F.col("fp").alias("node")), max_bits, bands, shard_rows=shard_rows),
        "simhash-links")
    parts = (connected_components(found, "simhash") if not found.isEmpty()
             else spark.createDataFrame([], "node long, component long"))
    part = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("part"))
    keep = part.groupBy("part").agg(F.min("first").alias("keep"))
    classes = part.join(keep, "part").select(
        "fp", F.col("keep.doc_id").alias("component_id"), F.col("keep.th").alias("keep_th"))
    return fps, classes


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, bands: int = BANDS,
                    shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fp long, component_id) per row of ``docs``.

    Null or empty texts have fingerprint 0, linked like any other.  Rows without
    an id take part and get their component's id; a component in which no row
    has one has a null id.  Repeated rows share a fingerprint and are returned
    as often as they came; other columns play no part.  An empty table gives an
    empty result.
    """
    fps, classes = _grouped(docs, id_col, text_col, shingle, max_bits, bands, shard_rows)
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS, bands: int = BANDS,
             shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the
    smallest id stays (rows without an id come last, ties go by the text's hash).
    Rows that agree in id and text count as one row."""
    fps, classes = _grouped(docs, id_col, text_col, shingle, max_bits, bands, shard_rows)
    keep = materialise(classes.select(F.col("component_id").alias("__keep_id"),
                                      F.col("keep_th").alias("__keep_th")).distinct(), "simhash-keep")
    own_id, own_th = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`"))
    kept = docs.join(keep, own_id.eqNullSafe(F.col("__keep_id")) & (own_th == F.col("__keep_th")),
                     "left_semi")
    held = fps.join(keep, F.col("doc_id").eqNullSafe(F.col("__keep_id"))
                    & (F.col("th") == F.col("__keep_th")), "left_semi")
    if not held.groupBy("doc_id", "th").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, text_col])
    return kept
