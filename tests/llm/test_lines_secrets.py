"""Line dedup and the secret scan against brute force, and their plans."""

import hashlib
import os
import pathlib
import random
import re
import time
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from liftlab import session
from liftlab.llm import lines, secrets
from tests.llm import data


def brute_lines(found, similarity=0.8):
    key = lambda i: (i is not None, i or 0)
    places = [((key(r[0]), p), frozenset(x for x in re.split("[ \t-\r]+", ln) if x))
              for r in found if r[1] is not None for p, ln in enumerate(r[1].split("\n"))]
    gone = set()
    for at, own in places:
        if own and any(before < at and other and len(own & other) >= similarity * len(own | other) - 1e-9
                       for before, other in places):
            gone.add((at, own))
    out = Counter()
    for r in found:
        ls = [] if r[1] is None else r[1].split("\n")
        cut = [p for p, ln in enumerate(ls)
               if ((key(r[0]), p), frozenset(x for x in re.split("[ \t-\r]+", ln) if x)) in gone]
        out[(r[0], len(ls), len(cut), ",".join(map(str, cut)))] += 1
    return out


def near_copies():
    """Groups of near copies with substituted words, some of them close to the limit."""
    rng = random.Random(5)
    found = []
    for g in range(6):
        base = data.words(rng, 30, 90)
        for k in range(25):
            line = list(base)
            for _ in range(rng.randrange(5)):
                line[rng.randrange(len(line))] = data.words(rng, 1, 90)[0]
            found.append((len(found), "\n".join([" ".join(line), " ".join(data.words(rng, rng.randrange(1, 9), 12))])))
    rng.shuffle(found)
    return [(i, t) for i, (_, t) in enumerate(found)]


@pytest.mark.parametrize("buckets", [1 << 4, lines.RARITY_BUCKETS])
def test_lines_near_copies(spark, buckets, monkeypatch):
    monkeypatch.setattr(lines.removed_lines, "__defaults__", (lines.SIMILARITY, buckets))
    found = near_copies()
    assert Counter(map(tuple, lines.report(data.plain(spark, found)).collect())) == brute_lines(found)


def test_lines_awkward_rows(spark):
    assert Counter(map(tuple, lines.report(data.frame(spark)).collect())) == brute_lines(data.rows())


def test_lines_clean_keeps_columns(spark):
    found = near_copies()
    docs = data.plain(spark, found)
    got = lines.clean(docs)
    assert got.columns == docs.columns
    gone = {i: set(cut.split(",")) for i, _, _, cut in brute_lines(found)}
    want = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if str(p) not in gone[i]) for i, t in found}
    assert {r.doc_id: r.text for r in got.collect()} == want
    awkward = data.frame(spark)
    assert lines.clean(awkward).count() == awkward.count()


def changed_copies(n):
    """``n`` lines, all but one word of each from one base."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    return [(i, " ".join([f"new{rng.randrange(10 ** 9)}" if k == i % 40 else w for k, w in enumerate(base)])) for i in range(n)]


def test_lines_group_of_near_copies_is_not_compared_in_pairs(spark, monkeypatch):
    seen, verify = [], lines._verified

    def counted(pairs, *rest):
        seen[-1] += pairs.count()
        return verify(pairs, *rest)

    monkeypatch.setattr(lines, "_verified", counted)
    for n in (100, 400):
        seen.append(0)
        assert sum(r.n_removed for r in lines.report(data.plain(spark, changed_copies(n))).collect()) == n - 1
    assert seen[0] <= 200 and seen[1] <= 5 * seen[0]


def test_long_lines_are_told_apart_by_the_filters(spark):
    """Two unlike lines of 150 tokens: 64 parities can't tell that they differ in more than 33, 128 can."""
    rng = random.Random(8)
    found = data.plain(spark, [(i, " ".join(f"t{rng.randrange(10 ** 9)}" for _ in range(150))) for i in range(60)])
    got = lines.sets(found, lines.rarity(found, 1 << 8), 0.8, 1 << 8)
    pairs = got.alias("a").join(got.alias("b"), lines._before("a", "b"))
    assert pairs.count() == 60 * 59 // 2 and pairs.filter(lines._near("a", "b", 0.8)).isEmpty()


def test_lines_are_split_into_tokens_once(spark):
    """A filter on the tokens is moved below the step that makes them, which then makes them twice."""
    found = data.plain(spark, near_copies())
    plan = lines.sets(found, lines.rarity(found, 1 << 8), 0.8, 1 << 8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") == 1


def test_token_names_are_sorted_as_plain_longs(spark):
    """An array that may hold nulls is sorted by comparing boxed values."""
    found = data.plain(spark, near_copies())
    got = lines.sets(found, lines.rarity(found, 1 << 8), 0.8, 1 << 8)
    assert not got.schema["prefix"].dataType.containsNull
    assert all(list(r.prefix) == sorted(r.prefix) and r.n >= len(set(r.prefix)) == len(r.prefix) for r in got.collect())


def test_only_texts_with_a_likely_line_are_split_again(spark, monkeypatch):
    seen, split = [], lines._split

    def counted(docs):
        seen.append(docs.count())
        return split(docs)

    monkeypatch.setattr(lines, "_split", counted)
    rng = random.Random(4)
    found = [(i, " ".join(f"u{rng.randrange(10 ** 9)}" for _ in range(30))) for i in range(300)]
    found += [(300, found[7][1] + " more"), (301, found[8][1] + " more")]
    assert {r.doc_id for r in lines.report(data.plain(spark, found)).collect() if r.n_removed} == {300, 301}
    assert sorted(seen)[-1] == 302 and sorted(seen)[-2] < 100


def test_scratch_options_reach_the_writer(spark):
    with session.Scratch(spark, **{"parquet.enable.dictionary": "false"}) as scratch:
        table = scratch.written(spark.range(1000).selectExpr("id % 3 as k"), "plain")
        files = list(pathlib.Path(scratch._paths[table].removeprefix("file:")).glob("*.parquet"))
        kept = [pq.ParquetFile(f).metadata.row_group(0).column(0) for f in files if pq.ParquetFile(f).metadata.num_rows]
        assert kept and not any(c.has_dictionary_page for c in kept)


def test_lines_with_any_white_space_between_tokens(spark):
    apart = [" ", "  ", "\t", "\v", "\f", "\r", " \t ", "\r "]
    words = [f"w{i}" for i in range(9)]
    rows = [(0, " ".join(words))] + [(1 + i, f"{x}{x.join(words)}{x}\n{x}") for i, x in enumerate(apart)] + [
        (20, "\u00a0".join(words)), (21, "\n \n\t\n"), (22, "")]
    got = {r.doc_id: (r.n_lines, r.removed) for r in lines.report(data.plain(spark, rows)).collect()}
    assert got == {0: (1, ""), **{1 + i: (2, "0") for i in range(len(apart))}, 20: (1, ""), 21: (4, ""), 22: (1, "")}


def test_lines_leave_only_their_result_in_the_scratch_folder(spark):
    root = pathlib.Path(session.scratch_root(spark).removeprefix("file:"))
    before = set(os.listdir(root))
    assert lines.report(data.plain(spark, near_copies())).count() == 150
    left = {x.rpartition("-")[0] for x in set(os.listdir(root)) - before}
    assert left <= {"line-removed", "array"}


def test_written_leaves_no_shuffle_files(spark):
    blocks = lambda: {b.toString() for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if "shuffle" in b.toString()}
    before = blocks()
    assert len(session.written(spark.range(1000).repartition(7, "id").groupBy("id").count(), "counts").collect()) == 1000
    deadline = time.time() + 20
    while blocks() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not blocks() - before


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def secret_rows():
    rng = random.Random(9)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    shared, key = hexa(40), "AKIA" + "Q7" * 8
    found = []
    for i in range(40):
        parts = [rng.choice(["\U0001f600 text", "Passwd", "é", "token", "secret: token = abcdefgh", "a" * 30])]
        parts += [f"token = \"{shared}\"", f"x {key} y"] * (i % 3 == 0)
        parts += [f"API_KEY: '{hexa(rng.randrange(3, 12))}'"] * (i % 4 == 0)
        parts += [f"bare kJ{hexa(9)}9Z0{hexa(12)}"] * (i % 5 == 0)
        rng.shuffle(parts)
        found.append((i, " ".join(parts), None, f"s{i % 7}", None))
    found += [(50, None, None, None, None), (51, "", None, None, None), (None, "password=abcdef12", None, None, None),
              (52, "secret=" + "z" * 4000 + " token:abc " * 500 + "k" * 60000, None, "s1", 7), found[0], found[0]]
    return [r + ("clash",) * data.EXTRA for r in found]


def test_secrets(spark):
    found = secret_rows()
    got = secrets.report(data.frame(spark, found)).collect()
    assert len(got) == len(found)
    want = Counter()
    for r in found:
        spans = brute_base(r[1])
        names = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        count = Counter(k for _, k, _ in spans)
        want[(r[0], count[0], count[1], count[2], hashlib.sha256(names.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    assert any("owned" in r.spans for r in got)
    for r in got:
        base = [s for s in r.spans.split(",") if s and not s.startswith("owned")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
    # the shared token and key are copied examples, each of seven owners
    assert all(r.n_copied >= 3 for r in got if r.doc_id is not None and r.doc_id < 40 and r.doc_id % 3 == 0)


def test_ownership_counts(spark):
    held = [("v", "o1", 1), ("v", "o1", 2), ("v", "o1", 2), ("v", "o2", 3), ("w", None, 4), ("w", None, None)]
    got = secrets.ownership(spark.createDataFrame(held, "value string, owner string, repository int"))
    assert {tuple(r) for r in got.collect()} == {("v", 2, 3), ("w", 1, 2)}


def test_redact(spark):
    found = secret_rows()
    docs = data.frame(spark, found)
    got = secrets.redact(docs)
    assert got.columns == docs.columns
    texts = defaultdict(list)
    for r in got.collect():
        texts[r.doc_id].append(r.text)
    assert sum(map(len, texts.values())) == len(found)
    assert texts[None] == ["<secret>"] and texts[50] == [None] and texts[51] == [""]
    shared = next(m for m in re.findall('token = "[0-9a-f]{40}', found[0][1]))
    assert all(shared in t for i, ts in texts.items() if i is not None and i < 40 and i % 3 == 0 for t in ts)
    for i, own in texts.items():
        for t in own:
            assert not re.search("kJ[0-9a-f]{9}9Z0", t or "")


@pytest.mark.parametrize("make", [lines.report, lines.clean, secrets.report, secrets.redact])
def test_native(spark, make):
    plan = make(data.frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
