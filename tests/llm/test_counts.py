"""Token counts, ranked search and source divergence against brute force over awkward rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from liftlab.llm import divergence, ranked, tokencount
from liftlab.llm.common import vocabulary
from tests.llm import data

BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WITH_DIGITS = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id string, score string, rank string, q string, term string"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def found(pattern, text):
    return pattern.findall((text or "").translate(LOWER))


def awkward():
    rng = random.Random(11)
    more = ["Zürich ZÜRICH zürich a_b-c1D \x00\x7f", "ab1 " * 40, "ab1 cd2 " * 9, "cd2", "A1 B2 C3", "a1 b2 c3 a1"]
    more += [" ".join(rng.choice(["ab1", "cd2", "ef3", "gh4", "ij5"]) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    return data.rows() + [(1000 + i // 2, t, "en" if i % 3 else "xx", f"s{i % 7}", None) + ("clash",) * data.EXTRA
                          for i, t in enumerate(more)]


# ---------------------------------------------------------------- token counts
def test_empty_tables(spark):
    nothing, items = data.frame(spark, []), spark.createDataFrame([], ITEMS)
    assert tokencount.count_tokens(nothing, BYTES).collect() == []
    assert divergence.audit(nothing).collect() == []
    some = spark.createDataFrame([(1, "ab1") + ("c",) * 5], ITEMS)
    for docs, asked in ((nothing, items), (nothing, some), (data.frame(spark), items)):
        assert ranked.search(docs, asked).collect() == []


def test_token_counts_equal_library(spark):
    coder, want = Tokenizer.from_file(BYTES), Counter()
    for doc_id, text, *_ in awkward():
        n = len(coder.encode(text or "", add_special_tokens=False).ids)
        want[doc_id, len((text or "").encode()), n, n > 40] += 1
    assert bag(tokencount.count_tokens(data.frame(spark, awkward()), BYTES, limit=40)) == want


def test_merges_equal_library():
    counter, theirs, rng = tokencount.MergeCounter(BYTES, cached_words=50), Tokenizer.from_file(BYTES), random.Random(5)
    marks = ["a", "b", "th", "er", " ", "  ", "\n", "'s", "é", "ß", "ɐ", "—", "\U0001f600", "7", "²", "\x1c", "\x85",
             "<|endoftext|>", "<|endof", "ab" * 300, "_", "　"]
    for _ in range(800):
        text = "".join(rng.choice(marks) for _ in range(rng.randrange(40)))
        assert counter.text(text) == len(theirs.encode(text, add_special_tokens=False).ids), text


def test_every_character_is_split_as_the_library_does():
    split = Tokenizer.from_file(BYTES).pre_tokenizer.pre_tokenize_str
    for code in range(tokencount.ALIKE_UP_TO + 1):
        for form in ("x{}y", "  {} 1", "{0}{0}'s {0} "):
            text = form.format(chr(code))
            assert [text[a:b] for _, (a, b) in split(text)] == tokencount._SPLIT.findall(text)


def test_long_texts_are_counted_in_parts(monkeypatch):
    counter, rng = tokencount.MergeCounter(BYTES), random.Random(2)
    text = "".join(rng.choice("ab c  '\n1é") for _ in range(20_000))
    whole = counter.text(text)
    monkeypatch.setattr(tokencount, "PART", 100)
    assert counter.text(text) == whole == len(Tokenizer.from_file(BYTES).encode(text).ids)


def test_a_word_without_end_is_not_quadratic():
    counter = tokencount.MergeCounter(BYTES)
    assert counter.text("xy" * 200_000) == len(Tokenizer.from_file(BYTES).encode("xy" * 200_000).ids)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tokencount.MergeCounter(WORDS)


# ---------------------------------------------------------------- ranked search
def ranking(rows, items, k):
    docs = [(i, Counter(found(WITH_DIGITS, t))) for i, t, *_ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, length = len(docs), sum(d[2] for d in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    out = Counter()
    for item, text in sorted(set(items), key=repr):
        scores = []
        for i, c, size in docs:
            m = 100 - 25 + 25 * size * n // length
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                        * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w, times in Counter(found(WITH_DIGITS, text)).items() if c[w])
            if score > 0:
                scores.append((-score, i is None, i))
        for place, (score, _, i) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]):
            out[item, place + 1, i, -score] += 1
    return out


def items_of(rows):
    texts = [t for _, t, *_ in rows]
    return [(i, t) for i, t in enumerate(texts[::5])] + [
        (500, "ab1 AB1 ab1 cd2"), (501, None), (502, "..."), (503, "neverseen"), (504, "id null the"), (504, "cd2"), (504, "cd2"),
        (None, "ef3"), (505, "ab1 " * 500 + "gh4")]


@pytest.mark.parametrize("block_size, k", [(256, 20), (4, 3)])
def test_search_equals_brute_force(spark, block_size, k):
    rows = awkward()
    items = items_of(rows)
    asked = spark.createDataFrame([p + ("c",) * 5 for p in items], ITEMS)
    got = bag(ranked.search(data.frame(spark, rows), asked, k, block_size))
    assert got == ranking(rows, items, k)


def test_search_among_many_copies(spark):
    rows = [(i, "ab1 cd2 ef3 " + ("gh4" if i % 9 else "ij5 ij5"), "en", "s", None) + ("c",) * data.EXTRA for i in range(900)]
    items = [(1, "ab1 gh4"), (2, "ij5 cd2"), (3, "gh4 " * 9)]
    asked = spark.createDataFrame([p + ("c",) * 5 for p in items], ITEMS)
    assert bag(ranked.search(data.frame(spark, rows), asked)) == ranking(rows, items, 20)


def index_of(docs, bits):
    slab = []
    for i, text in enumerate(docs):
        words = Counter(found(WITH_DIGITS, text))
        keys = ranked._keys(list(words))
        own = [keys[j, level] for j, w in enumerate(words) for level, low in enumerate(ranked.LEVELS) if words[w] >= low]
        slab.append((i, sum(words.values()), np.array(own, np.uint64)))
    return ranked._slab(bits, slab)


@pytest.mark.parametrize("bits", [64, 1 << 14])
def test_bounds_are_never_too_low(bits):
    """Also where signatures are full; with room they are close."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    docs = [" ".join(rng.choices(words, [1 / (1 + j) for j in range(60)], k=rng.randrange(1, 300))) for _ in range(40)]
    counts = [Counter(found(WITH_DIGITS, d)) for d in docs]
    df, length = Counter(w for c in counts for w in c), sum(sum(c.values()) for c in counts)
    asked = [Counter(rng.choices(words, k=9)) for _ in range(12)]
    block = ranked.Block.of([(q, w, n, df[w]) for q, a in enumerate(asked) for w, n in a.items() if w in df],
                            len(asked), len(docs), length)
    slab = index_of(docs, bits)
    bounds = ranked.Bounds(block).of(bits, slab["lengths"], slab["rows"])
    close = []
    for q, a in enumerate(asked):
        for d, c in enumerate(counts):
            m = block.lengthen(sum(c.values()))
            score = sum(n * math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m))
                        for w, n in a.items() if c[w])
            assert bounds[q, d] >= score
            close.append(bounds[q, d] <= 1.15 * score)
    assert bits == 64 or np.mean(close) > 0.95


def test_bounds_of_heavy_queries_stay_above():
    block = ranked.Block.of([(0, "a", 10**9, 1)], 1, 10**6, 10**9)
    assert not block.exact
    slab = index_of(["a a", "b"], 256)
    n = 10**9 * math.floor(1000 * math.log((2 * 10**6 + 2) / 3))
    m = block.lengthen(2)
    assert ranked.Bounds(block).of(256, slab["lengths"], slab["rows"])[0, 0] > n * (2 * 10**9 // (2000 + 12 * m))


# ---------------------------------------------------------------- source divergence
def divergences(rows, top):
    docs = [(lang or "", source or "", found(LETTERS, text)) for _, text, lang, source, *_ in rows]
    groups = sorted({d[:2] for d in docs})
    df, counts, totals = Counter(), Counter(), Counter()
    for lang, source, words in docs:
        df.update((lang, w) for w in set(words))
    for lang, source, words in docs:
        for w in words:
            if df[lang, w] >= 3:
                counts[lang, source, w] += 1
                totals[lang, w] += 1
    out = Counter()
    for lang, source in groups:
        kept = sorted(w for (own, w), n in df.items() if own == lang and n >= 3)

        def shares(count):
            n = sum(count(w) for w in kept)
            return [1 + 10**9 * (count(w) + 1) // (n + len(kept)) for w in kept]

        p, q = shares(lambda w: counts[lang, source, w]), shares(lambda w: totals[lang, w])
        apart = [(-sum((a - b) ** 2 // b for a, b in zip(p, shares(lambda w: counts[lang, other, w]))), other)
                 for own, other in groups if own == lang and other != source]
        terms = [(-((a - b) ** 2 // b), w) for w, a, b in zip(kept, p, q) if counts[lang, source, w] and a > b]
        for part, ranks in (("pair", sorted(apart)), ("term", sorted(terms, key=lambda t: (t[0], t[1].encode()))[:top])):
            for place, (value, item) in enumerate(ranks):
                out[lang, source, part, item, -value, place + 1] += 1
    return out


def test_audit_equals_brute_force(spark):
    assert bag(divergence.audit(data.frame(spark, awkward()), top=15)) == divergences(awkward(), 15)


def test_audit_in_many_tasks(spark, monkeypatch):
    """Blocks of two sources and shards of a few terms give the same sums."""
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "SHARD_TERMS", 40)
    assert bag(divergence.audit(data.frame(spark, awkward()))) == divergences(awkward(), 200)


def test_merge_pair():
    rng, total = random.Random(9), 60
    for _ in range(200):
        shares = []
        for _ in range(2):
            ids = sorted(rng.sample(range(total), rng.randrange(0, total)))
            shares.append((np.array(ids, np.int64), np.array([rng.randrange(1, 10**9) for _ in ids], np.int64), rng.randrange(1, 10**6)))
        a, b = shares
        p, q = dict(zip(a[0].tolist(), a[1].tolist())), dict(zip(b[0].tolist(), b[1].tolist()))
        seen = set(p) | set(q)
        want = [sum((x.get(t, x0) - y.get(t, y0)) ** 2 // y.get(t, y0) for t in seen)
                for x, x0, y, y0 in ((p, a[2], q, b[2]), (q, b[2], p, a[2]))]
        assert divergence.merge_pair(a, b) == (*want, len(seen))


def test_shares_of_large_counts(spark):
    rows = [(c, n, v) for c, n, v in [(0, 0, 1), (10**13 - 1, 10**13, 7), (5 * 10**14, 9 * 10**14, 10**9), (2, 3, 10**12)]]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    got = [r[0] for r in df.select(divergence._share(df.c, df.n, df.v)).collect()]
    assert got == [1 + 10**9 * (c + 1) // (n + v) for c, n, v in rows]


def test_audit_counts_before_it_shuffles(spark):
    """One shuffle row per (group, term) and part of a task; the reports read the written table."""
    counts = divergence.term_counts(data.frame(spark))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    by_lang = defaultdict(int)
    for lang, _, words in [(r[2] or "", r[3], found(LETTERS, r[1])) for r in data.rows()]:
        by_lang[lang] += len(words)
    assert {r.lang: r.n for r in counts.groupBy("lang").agg({"times": "sum"}).withColumnRenamed("sum(times)", "n").collect()} \
        == {k: n for k, n in by_lang.items() if n}
