"""Toxic passages as maximum-scoring segments.

Tokens get log-odds of occurring in toxic against clean labelled documents, with
an informative Dirichlet prior from their overall frequency (Monroe, Colaresi and
Quinn 2008).  A linear scan (Ruzzo and Tompa 1999) finds all maximal-scoring
segments of a document; tokens that say nothing score a small constant below zero.
By Karlin and Altschul's extreme-value law a segment of score S in n tokens arises
by chance about ``K n exp(-lambda S)`` times; the significant segments of a document
are added up in these units and a logistic curve turns the sum into a score.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_rows, materialise, words_of

PRIOR = 200.0  # weight of the Dirichlet prior, in tokens per class
FLOOR = 0.5  # its least weight per token
MIN_DOCS = 4  # toxic documents a token must occur in to count
MIN_Z = 2.5  # and its log-odds over their standard deviation
MIN_ODDS = 2.5  # log-odds below which a token scores as any other
MAX_TOKENS = 50_000  # clean-leaning tokens of the model: those of highest z are kept
BACKGROUND = -0.35  # score of any other token
MAX_SCORE = 6.0
MAX_E = 1e-2  # a segment counts if it arises by chance less often than that
BINS = 4  # steps of the evidence's histogram per unit, for the fit


class Model(NamedTuple):
    tokens: dict[str, float]
    lam: float
    log_k: float
    slope: float
    intercept: float


_STRIP = " .,;:!?\"'()[]{}<>«»“”‘’…-–—*_#"


def tokens_of(text: str | None) -> list[str]:
    return words_of((text or "").lower())


# ------------------------------------------------------------------ segments
def segments(hits: list[tuple[int, float]], background: float = BACKGROUND) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first, last token) of a text whose
    scored tokens are ``hits`` (place, score) in order; every other token scores
    ``background`` < 0, so whole runs of them are taken at once.  Linear time."""
    # candidate: [left cumulative, right cumulative, first, last]; a stack in which
    # each left sum has a link to the nearest earlier smaller left sum
    stack: list[list] = []
    links: list[int] = []
    total, upto = 0.0, -1
    for place, score in hits:
        total += background * (place - upto - 1)
        upto = place
        before, total = total, total + score
        if score <= 0:
            continue
        left, right, first, last = before, total, place, place
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = links[j]
            if j < 0 or stack[j][1] >= right:
                stack.append([left, right, first, last])
                links.append(j)
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:], links[j:]
    return [(r - l, a, b) for l, r, a, b in stack]


def scan_text(text: str | None, model: Model) -> tuple[float, int, list[tuple[float, int, int]]]:
    """Evidence, number of tokens and significant segments of a text."""
    words = tokens_of(text)
    table = model.tokens
    hits = []
    for i, w in enumerate(words):
        s = table.get(w)
        if s is None and (w[0] in _STRIP or w[-1] in _STRIP):
            s = table.get(w.strip(_STRIP))
        if s is not None:
            hits.append((i, s))
    if not hits:
        return 0.0, len(words), []
    log_kn = model.log_k + math.log(len(words))
    found = [(s, a, b) for s, a, b in segments(hits) if log_kn - model.lam * s < math.log(MAX_E)]
    return sum(model.lam * s - log_kn for s, _, _ in found), len(words), found


def probability(evidence: float, model: Model) -> float:
    x = model.slope * evidence + model.intercept
    return 1.0 / (1.0 + math.exp(-x)) if x > -700 else 0.0


# ------------------------------------------------------------------ training
def count_tokens(labelled: DataFrame) -> DataFrame:
    """(token, toxic, n, docs) over ``labelled`` (text, toxic), counted per task
    before the shuffle in dictionaries of bounded size."""
    def run(batches):
        counts: dict = {}

        def flush():
            keys = list(counts)
            return {"token": [k[0] for k in keys], "toxic": [k[1] for k in keys],
                    "n": [counts[k][0] for k in keys], "docs": [counts[k][1] for k in keys]}

        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"]):
                own: dict = {}
                for w in tokens_of(text):
                    w = w.strip(_STRIP) or w
                    own[w] = own.get(w, 0) + 1
                for w, n in own.items():
                    c = counts.setdefault((w, toxic), [0, 0])
                    c[0] += n
                    c[1] += 1
            if len(counts) > 300_000:
                yield flush()
                counts.clear()
        if counts:
            yield flush()

    return (map_rows(labelled.select("text", "toxic"), run, "token string, toxic int, n long, docs long")
            .groupBy("token").agg(
                F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"),
                F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0"),
                F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("d1"),
                F.sum(F.when(F.col("toxic") == 0, F.col("docs")).otherwise(0)).alias("d0")))


def fit(labelled: DataFrame) -> Model | None:
    """Model from ``labelled`` (doc_id, text, toxic); None without both labels.

    Four fifths of the rows give the log-odds, the rest (by the hash of the text,
    so that copies stay together) the calibration.  Counts cover all rows; what
    reaches the driver is the model (every toxic-leaning token that passes the
    thresholds, MAX_TOKENS clean-leaning ones at most) and two histograms.
    """
    rows = labelled.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(5)))
    counts = materialise(count_tokens(rows.where("fold <> 4")), "toxic-counts")
    sums = counts.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    if not sums.n1 or not sums.n0:
        return None
    both = sums.n1 + sums.n0
    n1, n0, p = F.col("n1"), F.col("n0"), FLOOR + PRIOR * (F.col("n1") + F.col("n0")) / both
    odds = (F.log((n1 + p) / (sums.n1 + PRIOR - n1 - p)) - F.log((n0 + p) / (sums.n0 + PRIOR - n0 - p)))
    scored = (counts.where(F.col("d1") >= MIN_DOCS).withColumn("score", odds)
              .withColumn("z", F.col("score") / F.sqrt(1 / (n1 + p) + 1 / (n0 + p))))
    strong = scored.where((F.abs("z") >= MIN_Z) & (F.abs("score") >= MIN_ODDS)).select("token", "score", "z", "n0")
    kept = strong.where("score > 0").collect()
    kept += strong.where("score < 0").orderBy("z", "token").limit(MAX_TOKENS).collect()
    kept.sort(key=lambda r: (-abs(r.z), r.token))
    tokens = {r.token: float(np.clip(r.score, -MAX_SCORE, MAX_SCORE)) for r in kept}
    if not any(s > 0 for s in tokens.values()):
        return Model({}, 1.0, 0.0, 1.0, math.log((sums.n1 + 1) / (sums.n0 + 1)) - 1)
    # lambda solves E[exp(lambda * score)] = 1 over the tokens of clean documents
    weight = np.array([r.n0 + 0.5 for r in kept]) / (sums.n0 + 0.5 * len(kept))
    score = np.array([tokens[r.token] for r in kept])
    rest = max(0.0, 1.0 - weight.sum())

    def excess(lam: float) -> float:
        return float((weight * np.exp(lam * score)).sum() + rest * math.exp(lam * BACKGROUND) - 1)

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    model = Model(tokens, high, 0.0, 1.0, 0.0)
    held = materialise(rows.where("fold = 4"), "toxic-held")
    # K from the clean documents: chance segments per token above any score
    chance = held.where("toxic = 0")
    k = _evidence(chance, model).agg(F.sum("above").alias("a"), F.sum("n").alias("n")).first()
    model = model._replace(log_k=math.log(((k.a or 0) + 1) / ((k.n or 0) + 1)))
    hist = (_evidence(held, model).select("toxic", F.floor(F.col("x") * BINS).alias("bin"))
            .groupBy("toxic", "bin").count().collect())
    slope, intercept = _logistic([(r.bin / BINS, r.toxic, r["count"]) for r in hist])
    return model._replace(slope=slope, intercept=intercept)


def _evidence(rows: DataFrame, model: Model) -> DataFrame:
    """(toxic, x, n, above): evidence, tokens and the sum of exp(lambda S) - 1 of
    the text's best segment, which estimates K times n."""
    def run(batches):
        for b in batches:
            got = [scan_text(t, model) for t in b["text"]]
            best = [max((s for s, _, _ in segs), default=0.0) for _, _, segs in got]
            yield {"toxic": b["toxic"], "x": [min(x, 1e3) for x, _, _ in got], "n": [n for _, n, _ in got],
                   "above": [math.exp(min(model.lam * s, 8.0)) - 1 for s in best]}
    return map_rows(rows.select("text", "toxic"), run, "toxic int, x double, n long, above double")


def _logistic(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope (not below zero) and intercept by Newton's method, lightly ridged;
    classes weigh the same, so 0.5 is where either is as likely for its size."""
    x = np.array([r[0] for r in rows], float)
    y = np.array([r[1] for r in rows], float)
    w = np.array([r[2] for r in rows], float)
    for c in (0, 1):
        if w[y == c].sum() > 0:
            w[y == c] /= w[y == c].sum()
    w *= 1000
    a, b = 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (y - p) * x).sum() - 0.1 * a, (w * (y - p)).sum() - 0.1 * b])
        v = w * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 0.1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


# ------------------------------------------------------------------ operator
def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of the rows that may be learnt from: those whose
    crc32(doc_id as text) isn't a multiple of 5.  Null labels are left out.

    Labels grow with the documents, so they are never broadcast: both sides are
    dealt by doc_id at every size."""
    key = F.col("doc_id").cast("string")
    ours = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        (F.crc32(key.cast("binary")) % 5 != 0) & F.col("toxic").isin(0, 1))
    return docs.select("doc_id", "text").join(ours.hint("merge"), "doc_id").select("doc_id", "text", "toxic")


def detect(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, n_tokens, n_segments,
    segments array<struct<score, first, last>>) per row of ``docs``.

    Null and empty texts have no evidence and score the intercept.  Rows without
    an id are scored and never learnt from (held_out null).  Without usable
    labels every score is 0.  Repeated rows give repeated results, other columns
    play no part, and an empty table gives an empty result.
    """
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    model = model or fit(training_rows(plain, labels))
    return scores(plain, model)


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """detect() for ``docs`` (doc_id, text) with a given model."""
    use = model or Model({}, 1.0, 0.0, 1.0, -1e3)

    def run(batches):
        for b in batches:
            got = [scan_text(t, use) for t in b["text"]]
            p = [probability(x, use) for x, _, _ in got]
            yield {"doc_id": b["doc_id"], "held_out": b["held_out"], "score": p,
                   "predicted": [int(x >= 0.5) for x in p], "evidence": [x for x, _, _ in got],
                   "n_tokens": [n for _, n, _ in got], "n_segments": [len(s) for _, _, s in got],
                   "segments": [[{"score": v, "first": i, "last": j} for v, i, j in s] for _, _, s in got]}

    key = F.col("doc_id").cast("string").cast("binary")
    narrow = docs.select("doc_id", "text", (F.crc32(key) % 5 == 0).alias("held_out"))
    return map_rows(narrow, run, "doc_id long, held_out boolean, score double, predicted int, evidence double, "
                    "n_tokens long, n_segments int, segments array<struct<score: double, first: int, last: int>>")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; the rest as they came."""
    model = fit(training_rows(docs.select("doc_id", "text"), labels))
    use = model or Model({}, 1.0, 0.0, 1.0, -1e3)
    schema = docs.schema

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(_mask([probability(scan_text(t, use)[0], use) < 0.5 for t in texts]))

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return docs.mapInArrow(run, schema)


def _mask(flags: list[bool]):
    import pyarrow as pa
    return pa.array(flags, pa.bool_())
