"""URL filter, spelling variants and collocations against brute force, and on awkward rows."""

from __future__ import annotations

import itertools
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import collocations, redirect_filter, spelling_variants


# ------------------------------------------------------------------ URL filter
def _canonical(to):
    return f'<html><head><LINK data-x="a>b" rel="alternate Canonical" href={to}></head>x</html>'


def _refresh(to):
    return f"<meta content='0; URL=\"{to}\"' http-equiv=Refresh>"


PAGES = [
    (1, "http://a.b.net/x", "plain"),                                   # blocked by rule
    (2, "https://clean.com/one", _canonical("http://a.b.net/x#frag")),   # alias of a blocked page
    (3, "https://clean.com/two", _refresh("https://clean.com/one")),     # alias of an alias
    (4, "https://www.example.net/en/page", _canonical('"https://clean.com/three"')),  # allowed by rule
    (5, "https://clean.com/three", "<p>"),                              # alias of an allowed page
    (6, "https://clean.com/four", _canonical("'https://www.example.net/en/page'") + _refresh("http://q.net/")),
    (7, "HTTP://Clean.COM/four#top", ""),                               # the same address
    (8, "https://clean.com/five", "<!-- <link rel=canonical href=http://q.net/> -->"),
    (9, "https://clean.com/six", "<script>'<link rel=canonical href=http://q.net/>'</script>"),
    (10, "https://clean.com/seven", "<link rel=canonical href=http://q.net/"),  # never closed
    (11, "http://q.net/", "x"),
    (12, "https://clean.com/eight", '<base href="http://other.net/z/"><link rel=canonical href="y?a=1&amp;b=2">'),
    (13, "https://fr.example.org/fr/1", _canonical("http://q.net/")),    # allowed by its own rule
    (14, None, _canonical("http://q.net/")), (15, "no address", None), (16, "", ""), (None, "http://q.net/?x", None),
    (17, "https://exampleXnet/", None), (18, "http://sub.example.com/de/1", None), (19, "http://example.com/de", None),
    (20, "https://clean.com/nine", "<link rel=canonical href=//q.net/>"), (20, "https://clean.com/nine", "again"),
    (21, "http://net/", None), (22, "http://x.org", _canonical("http://[bad")),
]


def _brute(pages, rules):
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        host, path = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url).groups()
        return "".join(c.lower() if c.isascii() else c for c in host), path

    def rule(url):
        host, path = parts(url)
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[2:] if fits else (None, None)

    def node(url):
        scheme, rest = url.split("://", 1)
        host, path = parts(url)
        query = re.match(r"[^?#]*(\?[^#]*)?", rest[len(host):])[1] or ""
        return scheme.lower() + "://" + host + (path or "/") + query

    group: dict = {}
    for _, url, html in pages:
        for t in redirect_filter.targets(url, html) if url and "://" in url else []:
            a, b = group.setdefault(node(url), {url}), group.setdefault(node(t), {t})
            a |= {url} | b | {t}
            for n in [k for k, v in group.items() if v is b] + [node(t), node(url)]:
                group[n] = a
    out = []
    for i, url, _ in pages:
        r, v = rule(url)
        if v is None:
            said = {rule(x)[1] for x in group.get(node(url), ())} if url and "://" in url else set()
            v = "block" if "block" in said and "allow" not in said else "allow"
        out.append((i, *parts(url), r, v))
    return sorted(out, key=str)


def _judged(spark, pages, **how):
    table = (spark.createDataFrame(pages, "page_id long, url string, html string")
             .withColumns({"node": F.lit(1), "rule": F.lit("x"), "host": F.lit(None), "verdict": F.lit("block")}))
    return sorted((tuple(r) for r in redirect_filter.judge(table, **how).collect()), key=str)


def test_verdicts_follow_redirects(spark):
    got = _judged(spark, PAGES)
    assert got == _brute(PAGES, redirect_filter.RULES)
    verdict = {r[0]: r[4] for r in got}
    assert [verdict[i] for i in (2, 3, 5, 6, 7, 8, 9, 10, 12, 13, 20)] == [
        "block", "block", "allow", "allow", "allow", "allow", "allow", "allow", "block", "allow", "block"]
    assert _judged(spark, PAGES[:0]) == []


def test_many_rules_and_a_hub(spark):
    r = random.Random(3)
    hosts = [f"{a}.{b}" for a in "abcdef" for b in ("com", "net", "org")]
    rules = [(h, "/" + "".join(r.choices("xy", k=k)), r.choice(["block", "allow"]))
             for h in hosts + ["com", "net"] for k in range(3)]
    rules = list({x[:2]: x for x in rules}.values())
    pages = []
    for i in range(400):
        url = f"http://{r.choice(['', 'w.', 'v.w.'])}{r.choice(hosts)}/{''.join(r.choices('xyz', k=3))}"
        to = "http://hub.zz/" if i % 3 == 0 else f"http://{r.choice(hosts)}/{''.join(r.choices('xyz', k=2))}"
        pages.append((i, url if i % 2 else f"http://free.zz/{i}", _canonical(to) if i % 5 == 0 else None))
    got = _judged(spark, pages, rules=spark.createDataFrame(rules, redirect_filter.RULES_SCHEMA))
    assert got == _brute(pages, rules)
    assert {r[4] for r in got} == {"allow", "block"}


def test_a_table_of_redirects(spark):
    moved = spark.createDataFrame([("http://old.com/", "http://x.net/"), (None, "http://x.net/")], "src string, dst string")
    assert _judged(spark, [(1, "http://old.com", "")], redirects=moved)[0][4] == "block"


def test_odd_html_takes_linear_time():
    began = time.monotonic()
    for odd in ("<a ", "<meta ", "<!--", "<link rel=canonical", "<script>", "<meta a='", '<link "'):
        redirect_filter.targets("http://x.y/", odd * 100_000)
    assert time.monotonic() - began < 20


# ------------------------------------------------------------------ spelling variants
def _edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1:] or (len(a) == len(b) and a[k + 1:] == b[k + 1:])


def _variants(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [v for v in n if _edits(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def _misspelt(r, word):
    k, c = r.randrange(len(word)), r.choice("abeé")
    return r.choice([word[:k] + word[k + 1:], word[:k] + c + word[k:], word[:k] + c + word[k + 1:]])


@pytest.fixture(scope="module")
def spelt():
    r = random.Random(4)
    stems = ["".join(r.choices("abcdeé", k=r.randint(7, 12))) for _ in range(40)] + ["a" * 30, "ba" * 15]
    rows = []
    for i in range(300):
        words = [r.choice(stems[:4]) if r.random() < 0.6 else _misspelt(r, r.choice(stems)) for _ in range(40)]
        words += [_misspelt(r, _misspelt(r, stems[0])) for _ in range(3)]
        rows.append((i, " ".join(w.upper() if r.random() < 0.1 else w for w in words)))
    return rows + [(None, "zzzzzzzz zzzzzzzz"), (7, None), (8, ""), rows[0], rows[0], (9, "x" * 3000 + " " + "x" * 3000)]


@pytest.mark.parametrize("symbols", [2, spelling_variants.SYMBOLS])
def test_variants_equal_brute_force(spark, spelt, symbols):
    docs = (spark.createDataFrame(spelt, "doc_id long, text string")
            .withColumns({"word": F.lit(1), "n": F.lit("x"), "code": F.lit(None), "id": F.lit(2), "gone": F.lit(3)}))
    got = sorted(tuple(r) for r in spelling_variants.variants(docs, symbols).collect())
    want = _variants(spelt)
    assert got == want and any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want)
    assert spelling_variants.variants(docs.limit(0), symbols).collect() == []


def test_neighbourhood_is_whole_and_without_repeats():
    symbols = 3
    for length in range(0, 6):
        for word in itertools.islice(itertools.product(range(1, symbols + 1), repeat=length), 60):
            want = {word}
            for i in range(length):
                want |= {word[:i] + word[i + 1:]} | {word[:i] + (s,) + word[i + 1:] for s in (1, 2, 3)}
            want |= {word[:i] + (s,) + word[i:] for i in range(length + 1) for s in (1, 2, 3)}
            codes = sorted(int(spelling_variants.codes_of(np.array([w], np.uint8).reshape(1, -1), symbols + 1)[0])
                           for w in want)
            _, got = spelling_variants.neighbourhood(np.array([word], np.uint8).reshape(1, -1), symbols)
            assert sorted(got.tolist()) == codes


def test_a_full_filter_loses_nothing(spark, spelt, monkeypatch):
    monkeypatch.setattr(spelling_variants, "FILTER_BITS", 1 << 12)
    monkeypatch.setattr(spelling_variants, "BITS_PER_KEY", 1)
    docs = spark.createDataFrame(spelt, "doc_id long, text string")
    assert sorted(tuple(r) for r in spelling_variants.variants(docs).collect()) == _variants(spelt)


# ------------------------------------------------------------------ collocations
def _phrases(rows, least, most):
    f = {}
    for lang, text in rows:
        count = f.setdefault(lang or "und", Counter())
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                count.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        n = sum(v for p, v in count.items() if len(p) == 1)
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in cand.items()):
                continue
            s, k = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


@pytest.fixture(scope="module")
def said():
    r = random.Random(8)
    words = [f"w{i}" for i in range(12)] + ["É", "é", "a b", "x\x1cy", "Of", "THE"]
    rows = []
    for i in range(250):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r"]) for _ in range(r.randint(1, 60)))
        rows.append((r.choice(["en", "de", None, "und"]), text + (" of the house" if i % 3 == 0 else "")))
    return rows + [("en", None), ("en", ""), ("en", " . "), rows[0], ("de", "very long words " * 5000)]


@pytest.mark.parametrize("chunk", [200, collocations.CHUNK_BYTES])
def test_collocations_equal_brute_force(spark, said, monkeypatch, chunk):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    docs = (spark.createDataFrame(said, "lang string, text string").repartition(3)
            .withColumns({"word": F.lit(1), "n": F.lit("x"), "phrase": F.lit(None), "bucket": F.lit(2)}))
    got = sorted(tuple(r) for r in collocations.mine(docs, most=60).collect())
    assert got == _phrases(said, 10, 60)
    assert collocations.mine(docs.limit(0)).collect() == []


def test_hot_words_change_nothing(spark, said, monkeypatch):
    docs = spark.createDataFrame(said, "lang string, text string")
    plain = collocations.route

    def all_hot(texts, hot, buckets):
        assert hot
        return plain(texts, hot, buckets)

    monkeypatch.setattr(collocations, "route", all_hot)  # small tables: every word is hot
    assert sorted(tuple(r) for r in collocations.mine(docs, least=2, most=500).collect()) == _phrases(said, 2, 500)
    monkeypatch.setattr(collocations, "MOST_SHARES", 1)  # and none
    monkeypatch.setattr(collocations, "route", plain)
    assert sorted(tuple(r) for r in collocations.mine(docs, least=2, most=500).collect()) == _phrases(said, 2, 500)


def test_quicksort_counts_every_prefix():
    r = np.random.default_rng(1)
    keys, weight = r.integers(0, 9, (3, 3000)), r.integers(1, 4, 3000)
    keys[:, :1000] = 5
    want = Counter()
    for column, n in zip(keys.T.tolist(), weight.tolist()):
        for d in (1, 2, 3):
            want[(d, *column[:d])] += n
    got = {(d, *keys[:d, p].tolist()): int(c) for d, at, n in collocations.multikey_quicksort(keys, weight, (1, 7, 10))
           for p, c in zip(at, n)}
    assert got == {k: v for k, v in want.items() if v >= (1, 7, 10)[k[0] - 1]}
    assert collocations.multikey_quicksort(keys[:, :0], weight[:0], (1, 1, 1)) == []


def test_scores_past_64_bits_are_exact(spark):
    big = 10 ** 14 + 7
    words = spark.createDataFrame([("en", "a", big + 9), ("en", "b", big + 3)], "lang string, word string, n long")
    two = spark.createDataFrame([("en", "a", "b", None, big)], "lang string, w1 string, w2 string, w3 string, n long")
    row = collocations.score(words, two).first()
    assert row.score == 1_000_000 * big * big // ((big + 9) * (big + 3))
