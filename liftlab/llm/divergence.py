"""How far the sources of a language differ in their words: exact divergences of all pairs and the words behind them.

Counts become fixed-point shares ``p = 1 + floor(UNIT * (count + 1) / (N + V))``: N is the group's count over the V
words that its language keeps, so a word that a group lacks has a share as well. The divergence of p from q at a word
is ``floor((p - q)^2 / q)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftlab.llm.terms import count_pairs, text_parts, words_of
from liftlab.session import written

#: Fixed value of the contract: what lies between terms.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT = 1_000_000_000
MIN_DOCUMENTS = 3
TOP_TERMS = 200
#: Text that is counted at a time.
PART_BYTES = 16 << 20
#: Groups of one side of a pair task, and kept terms of its shard: with them its memory is bounded.
BLOCK = 32
SHARD_TERMS = 4096

_SIDE = ["lang", "i", "j", "shard", "source", "term", "p"]
_SUMS = "lang string, source string, item string, value long, seen long"


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, times, held): occurrences, and documents that hold the term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, 2, PART_BYTES):
                names = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
                code = {name: i for i, name in enumerate(dict.fromkeys(names))}
                row, word, distinct = words_of(part.column(2), SEPARATORS)
                row, word, times = count_pairs(row, word, distinct)
                keys = np.array([code[n] for n in names], np.int64)[row] * max(1, len(distinct)) + word
                order = np.argsort(keys, kind="stable")
                keys, first, held = np.unique(keys[order], return_index=True, return_counts=True)
                group, word = keys // max(1, len(distinct)), keys % max(1, len(distinct))
                total = np.add.reduceat(times[order], first) if len(first) else times[:0]
                langs, sources = (pa.array([n[c] for n in code], pa.string()).take(pa.array(group)) for c in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [langs, sources, pa.array(distinct, pa.string()).take(pa.array(word)), pa.array(total, pa.int64()),
                     pa.array(held, pa.int64())], ["lang", "source", "term", "times", "held"])

    partial = _named(docs).mapInArrow(run, "lang string, source string, term string, times long, held long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("times").alias("times"), F.sum("held").alias("held"))


def _share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (n + v)), by long division in steps of 1,000 so that longs suffice."""
    digits, rest, whole = F.lit(0).cast("long"), count + 1, n + v
    for _ in range(3):
        digits = digits * 1000 + F.call_function("div", rest * 1000, whole)
        rest = rest * 1000 % whole
    return digits + 1


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """The counted tables of one corpus, written to the shared folder, and the reports made from them."""

    def __init__(self, docs: DataFrame, min_documents: int = MIN_DOCUMENTS):
        same_term = Window.partitionBy("lang", "term")
        kept = term_counts(docs).select(
            "lang", "source", "term", "times", F.sum("held").over(same_term).alias("documents"),
            F.sum("times").over(same_term).alias("lang_times"),
            (F.row_number().over(same_term.orderBy("source")) == 1).alias("first"))
        #: one row per group and kept term it holds; ``first`` marks one row of each (lang, term)
        self.kept = written(kept.where(F.col("documents") >= min_documents).drop("documents"), "kept-terms")
        langs = self.kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("times").alias("lang_n"))
        sizes = self.kept.groupBy("lang", "source").agg(F.sum("times").alias("n"))
        groups = _named(docs).select("lang", "source").distinct().join(langs, "lang", "left") \
            .join(sizes, ["lang", "source"], "left").fillna(0, ["v", "lang_n", "n"])
        of_lang = Window.partitionBy("lang")
        #: every (lang, source) with its counts, the share of a term it lacks (0 if the language keeps none), its block
        self.groups = written(groups.select(
            "*", F.when(F.col("v") > 0, _share(F.lit(0), F.col("n"), F.when(F.col("v") > 0, F.col("v")))).otherwise(0)
            .alias("p0"), F.floor((F.row_number().over(of_lang.orderBy("source")) - 1) / BLOCK).cast("int").alias("block"),
            F.ceil(F.count("*").over(of_lang) / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("v") / SHARD_TERMS).cast("int").alias("shards")), "groups")

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """(lang, source, item, value, rank): per group the terms it uses more than its language, furthest first."""
        rows = self.kept.join(self.groups, ["lang", "source"])
        priced = rows.select(
            "lang", "source", F.col("term").alias("item"), _share(F.col("times"), F.col("n"), F.col("v")).alias("p"),
            _share(F.col("lang_times"), F.col("lang_n"), F.col("v")).alias("q"))
        found = priced.where("p > q").withColumn("value", _divergence(F.col("p"), F.col("q")))
        return _ranked(found).where(F.col("rank") <= top)

    def _partial_sums(self) -> DataFrame:
        """(lang, source, item, value, seen) of each shard and ordered pair: sums over the terms that one of them holds.

        A pair task takes two blocks of groups of one language and the terms of one shard. Every group sends
        a row without a term to each task of its block, so that one without terms there is priced as well.
        """
        shard = F.pmod(F.xxhash64("term"), F.col("shards")).cast("int")
        with_terms = self.kept.join(self.groups, ["lang", "source"]).select(
            "lang", "source", "block", "blocks", shard.alias("shard"), "term",
            _share(F.col("times"), F.col("n"), F.col("v")).alias("p"))
        without = self.groups.where("shards > 0").select(
            "lang", "source", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
            F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
        rows = with_terms.unionByName(without)
        left = rows.withColumn("i", F.col("block")).withColumn(
            "j", F.explode(F.sequence("block", F.col("blocks") - 1))).select(*_SIDE)
        right = rows.withColumn("j", F.col("block")).withColumn(
            "i", F.explode(F.sequence(F.lit(0), "block"))).select(*[F.col(c).alias(c) for c in _SIDE])
        keys = ["lang", "i", "j", "shard"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_pair_task, _SUMS)

    def pairs(self) -> DataFrame:
        """(lang, source, item, value, rank): how far each source is from each other source of its language."""
        sums = self._partial_sums().groupBy("lang", "source", "item").agg(
            F.sum("value").alias("value"), F.sum("seen").alias("seen"))
        # the result has all ordered pairs of a language's sources; groups are few beside terms
        other = self.groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
        every = self.groups.select("lang", "source", "v", "p0").join(other, "lang").where("source <> item")
        unseen = (F.col("v") - F.col("seen")) * _divergence(F.col("p0"), F.col("q0"))
        value = F.when(F.col("v") > 0, F.col("value") + unseen).otherwise(0)
        return _ranked(every.join(sums, ["lang", "source", "item"], "left").withColumn("value", value))


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return found.select("lang", "source", "item", "value", F.row_number().over(order).alias("rank"))


def _arrays(rows: pa.Table, ids: dict[str, int]) -> dict[str, tuple[np.ndarray, np.ndarray, int]]:
    """Per source its sorted term ids, their shares, and its share of a term it lacks."""
    coded = rows.column("source").combine_chunks().dictionary_encode()
    source, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    term = np.array([-1 if t is None else ids[t] for t in rows.column("term").to_pylist()], np.int64)
    order = np.lexsort((term, source))
    term, p = term[order], rows.column("p").to_numpy()[order]
    borders = np.searchsorted(source[order], np.arange(len(names) + 1)).tolist()
    # the row without a term comes first
    return {name: (term[a + 1:b], p[a + 1:b], int(p[a])) for name, a, b in zip(names, borders, borders[1:])}


def merge_pair(a: tuple, b: tuple) -> tuple[int, int, int]:
    """(sum of a from b, sum of b from a, terms seen) over the terms that a or b holds.

    The shorter list gallops through the longer one: each of its sorted ids is looked up by halving what lies
    behind the id before it. Matches are priced as overlaps, all else against the other's share of a lacking term.
    """
    (short, p, p0), (long, q, q0) = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    at = np.searchsorted(long, short)
    both = np.zeros(len(short), bool)
    inside = at < len(long)
    both[inside] = long[at[inside]] == short[inside]
    alone = np.ones(len(long), bool)
    alone[at[both]] = False
    left = np.concatenate([p[both], p[~both], np.full(alone.sum(), p0)])
    right = np.concatenate([q[at[both]], np.full((~both).sum(), q0), q[alone]])
    apart = (left - right) ** 2
    forth, back = int((apart // right).sum()), int((apart // left).sum())
    return (forth, back, len(left)) if short is a[0] else (back, forth, len(left))


def _pair_task(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    lang, i, j = (key[c].as_py() for c in range(3))
    words = set(left.column("term").to_pylist()) | set(right.column("term").to_pylist())
    ids = {w: n for n, w in enumerate(sorted(words - {None}))}
    mine, theirs = _arrays(left, ids), _arrays(right, ids)
    out = []
    for a, own in mine.items():
        for b, other in theirs.items():
            if i < j or a < b:
                forth, back, seen = merge_pair(own, other)
                out += [(lang, a, b, forth, seen), (lang, b, a, back, seen)]
    columns = list(zip(*out)) if out else [()] * 5
    return pa.table({name: pa.array(list(column), kind) for name, column, kind in zip(
        ("lang", "source", "item", "value", "seen"), columns, [pa.string()] * 3 + [pa.int64()] * 2)})


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources (``pair``) and each group's terms (``term``).

    A null text, lang or source is ''. Every (lang, source) counts as a group, also without a term; a language that
    keeps no term has value 0 for all its pairs. A language with one source has no pairs. Rows that repeat are documents
    of their own, equal values rank by item in UTF-8 order, an empty table gives no rows, other columns are not read.
    Counts are added up before they are shuffled and per (lang, source, term), so a hot source or word is as many rows
    as there are tasks; a term's window has a row per source. Pair tasks are bounded by ``BLOCK`` and ``SHARD_TERMS``.
    """
    made = Audit(docs, min_documents)
    parts = [part.withColumn("part", F.lit(name)) for name, part in (("pair", made.pairs()), ("term", made.terms(top)))]
    return reduce(DataFrame.unionByName, parts).select("lang", "source", "part", "item", "value", "rank")
