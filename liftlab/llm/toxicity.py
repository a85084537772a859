"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlab.llm.common import BoundedCache, held_out, slices
from liftlab.session import written

#: Most labelled rows that the classifier is fitted on, chosen by a hash of the id. The lexicon is mined from all.
FIT_ROWS = 12_000
#: What a stem of the lexicon needs: twice its log-likelihood ratio as evidence, and odds of being toxic
#: so many times the labels' own. Odds have no upper end, so the bar can be reached at any share.
EVIDENCE = 24.0
ODDS = 4.0
#: Most features of the classifier: in a longer lexicon, stems of like evidence share one.
FEATURES = 512
#: Stems that a task counts before it hands them on.
COUNTED_STEMS = 200_000
LEXICON_VOTERS = 8
CACHED_WORDS = 150_000
ABSTAIN, TOXIC, CLEAN = 0, 1, 2

_WORD = re.compile(r"\w+")


def stems(token: str) -> tuple[str, ...]:
    """The words of a white-space separated token in lower case, each whole and as beginnings of 4 to 6 letters."""
    return tuple(dict.fromkeys(
        s for w in _WORD.findall(token.lower()) for s in (w + "$", w[:4], w[:5], w[:6])))


def kin(words: list[str]) -> int:
    """One of 64 bits, the same for most near copies of a text: by the least hash of three words in a row."""
    joined = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    return 1 << (min(xxhash.xxh64_intdigest(x) for x in joined) * 0x9E3779B97F4A7C15 >> 32 & 63)


def features(lexicon: list[str]) -> int:
    return min(len(lexicon), FEATURES)


class Voters:
    """Votes of lexicon parts and patterns on one text, from the features of its lexicon stems."""

    def __init__(self, lexicon: list[str]):
        self.number = {s: k * features(lexicon) // len(lexicon) for k, s in enumerate(lexicon)}
        self.cache = BoundedCache(
            lambda t: tuple(self.number[s] for s in stems(t) if s in self.number), CACHED_WORDS)

    def hits(self, text: str | None) -> tuple[list[int], int, int]:
        """Distinct features of lexicon stems, words that hold one, and words of the whole text."""
        tokens = (text or "").split()
        found = [h for h in map(self.cache.__getitem__, tokens) if h]
        return sorted(set().union(*found)), len(found), len(tokens)

    @staticmethod
    def votes(hit: tuple[list[int], int, int]) -> tuple[int, ...]:
        numbers, words, length = hit
        parts = {k % LEXICON_VOTERS for k in numbers}
        lexicon = [TOXIC if v in parts else ABSTAIN for v in range(LEXICON_VOTERS)]
        quiet = CLEAN if not words else ABSTAIN
        several = TOXIC if words >= 2 else ABSTAIN
        dense = TOXIC if words * 100 >= length > 0 else CLEAN
        return (*lexicon, quiet, several, dense)


N_VOTERS = LEXICON_VOTERS + 3


def encode(votes: tuple[int, ...]) -> int:
    return sum(v << 2 * k for k, v in enumerate(votes))


def decode(pattern: int) -> list[int]:
    return [pattern >> 2 * k & 3 for k in range(N_VOTERS)]


class LabelModel:
    """Class prior and each voter's chances of its votes per class, with weights that count correlated voters less.

    Fitted by expectation maximisation on counts of vote patterns, some of them with known labels.
    """

    def fit(self, free: dict[int, float], known: dict[tuple[int, int], float], rounds: int = 50) -> LabelModel:
        patterns = list(free) + [p for p, _ in known]
        votes = np.array([decode(p) for p in patterns]).reshape(len(patterns), N_VOTERS)
        count = np.array([*free.values(), *known.values()], float)
        truth = np.array([-1] * len(free) + [y for _, y in known])
        one_hot = np.stack([votes == v for v in (ABSTAIN, TOXIC, CLEAN)], axis=2).astype(float)
        # a first guess from the voters' own claims
        q = np.where(truth >= 0, truth, np.clip(0.5 + 0.2 * ((votes == TOXIC).sum(1) - (votes == CLEAN).sum(1)), 0.05, 0.95))
        self.weights = np.ones(N_VOTERS)
        for step in range(rounds):
            w = np.stack([(1 - q) * count, q * count])
            self.prior = np.clip(w.sum(1) / w.sum(), 1e-4, 1)
            self.chances = np.einsum("cp,pvk->cvk", w, one_hot) + 0.5
            self.chances /= self.chances.sum(axis=2, keepdims=True)
            if step >= rounds // 2:
                self.weights = self._independent((votes == TOXIC).astype(float), w)
            q = np.where(truth >= 0, truth, self.posterior(votes))
        return self

    @staticmethod
    def _independent(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        """One over the number of voters that a voter moves with inside a class."""
        total = np.zeros((N_VOTERS, N_VOTERS))
        for own in w:
            n = max(own.sum(), 1e-9)
            mean = own @ x / n
            cov = (x - mean).T @ ((x - mean) * own[:, None]) / n
            dev = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            total = np.maximum(total, np.abs(cov / np.outer(dev, dev)) * (np.outer(dev, dev) > 1e-6))
        np.fill_diagonal(total, 1.0)
        return 1.0 / total.sum(axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        each = np.log(self.chances[:, np.arange(N_VOTERS), votes])  # class, pattern, voter
        odds = (each[1] - each[0]) @ self.weights + np.log(self.prior[1] / self.prior[0])
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


@dataclass
class Model:
    """Linear classifier over features of lexicon stems, hit words and their share of the text."""

    lexicon: list[str]
    weights: np.ndarray
    bias: float

    @staticmethod
    def extra(words: int, length: int) -> tuple[float, float]:
        return np.log1p(words), words / length if length else 0.0

    def score(self, hit: tuple[list[int], int, int]) -> float:
        numbers, words, length = hit
        z = self.bias + self.weights[numbers].sum() + self.weights[-2:] @ self.extra(words, length)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft targets by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(penalty),
                               x.T @ (target - p) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def learnt_from(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled ids that are not held out; an id with several labels takes the greater one."""
    return labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def sample(labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, toxic) of at most ``rows`` labelled ids that are not held out, for a broadcast."""
    return learnt_from(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of all labelled documents that are not held out, each distinct text once.

    A text whose copies have several labels takes the greater one. Only ids and digests of texts are joined and grouped; the
    texts themselves are then read for one row per digest, whose ids go to the documents if they are few.
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    usable = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(~held_out(F.col("doc_id")))
    named = usable.select("doc_id", digest.alias("digest")).join(learnt_from(labels), "doc_id") \
        .groupBy("digest", "doc_id").agg(F.max("toxic").alias("toxic"), F.count("*").alias("copies"))
    chosen = written(named.groupBy("digest").agg(
        F.max("toxic").alias("toxic"), F.min(F.struct("doc_id", "copies")).alias("first")).select(
        "digest", "toxic", "first.doc_id", "first.copies"), "distinct-texts")
    texts = usable.withColumn("digest", digest).join(chosen, ["doc_id", "digest"])
    if chosen.where("copies > 1").isEmpty():
        return texts.select("text", "toxic")
    # rows that repeat an id with its text
    return texts.where("copies = 1").select("text", "toxic").unionByName(
        texts.where("copies > 1").dropDuplicates(["digest"]).select("text", "toxic"))


def mine_lexicon(labelled: DataFrame) -> list[str]:
    """All stems that speak for toxic texts, those with the greatest likelihood ratio by texts that hold them first.

    Near copies are no evidence of their own: the ratio is scaled down to the number of texts that differ,
    estimated from the share of 64 bits that the toxic texts with the stem set.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen, kinds = BoundedCache(stems, CACHED_WORDS), (Counter(), Counter()), {}

        def counted() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()),
                 pa.array([seen[0][k] for k in keys], pa.int64()),
                 pa.array(np.array([kinds.get(k, 0) for k in keys], np.uint64).view(np.int64))],
                ["stem", "bad", "good", "kinds"])
            seen[0].clear(), seen[1].clear(), kinds.clear()
            return out

        for batch in batches:
            for part in slices(batch, 64):
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = (text or "").split()
                    own = set().union(*map(cache.__getitem__, set(words)))
                    if toxic > 0:
                        bit = kin(words)
                        for stem in own:
                            kinds[stem] = kinds.get(stem, 0) | bit
                    seen[toxic > 0].update(own)
                    seen[toxic > 0][None] += 1  # the texts themselves
                if len(seen[0]) + len(seen[1]) >= COUNTED_STEMS:
                    yield counted()
        yield counted()

    counted = written(labelled.select("text", "toxic").mapInArrow(count, "stem string, bad long, good long, kinds long")
                      .groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"),
                                           F.bit_or("kinds").alias("kinds"))
                      .filter("bad > 0 or stem is null"), "toxic-stems")
    total = counted.filter("stem is null").first()
    if not total or not total.bad or not total.good:
        return []
    share = total.bad / (total.bad + total.good)
    held = F.col("bad") + F.col("good")
    ratio = lambda k, p: F.when(k > 0, k * F.log(k / (held * p))).otherwise(0.0)
    free = 64 - F.bit_count("kinds")
    differ = F.when(free > 0, F.least(-64 * F.log(free / 64) / F.col("bad"), F.lit(1.0))).otherwise(1.0)
    evidence = 2 * differ * (ratio(F.col("bad"), share) + ratio(F.col("good"), 1 - share))
    return [r.stem for r in counted.filter("stem is not null").withColumn("evidence", evidence)
            .filter((F.col("bad") * (1 - share) > ODDS * share * F.col("good")) & (F.col("evidence") >= EVIDENCE))
            .orderBy(F.desc("evidence"), "stem").select("stem").collect()]


_HIT = "stems array<int>, words int, length int"


def lexicon_hits(docs: DataFrame, lexicon: list[str]) -> DataFrame:
    """(doc_id, stems, words, length): what each whole text holds of the lexicon, a few numbers per row, written once."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(lexicon)
        for batch in batches:
            for part in slices(batch, 1024):
                hits = [voters.hits(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([h[0] for h in hits], pa.list_(pa.int32())),
                     pa.array([h[1] for h in hits], pa.int32()), pa.array([h[2] for h in hits], pa.int32())],
                    ["doc_id", "stems", "words", "length"])

    return written(docs.select("doc_id", "text").mapInArrow(look, f"doc_id {id_type}, {_HIT}"), "lexicon-hits")


def _hits(batch: pa.RecordBatch, first: int) -> Iterator[tuple[list[int], int, int]]:
    return zip(*(batch.column(first + k).to_pylist() for k in range(3)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Lexicon, label model and classifier."""
    return fit_and_hits(docs, labels, rows)[0]


def fit_and_hits(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[Model, DataFrame | None]:
    """Lexicon, label model and classifier, and the lexicon hits of all documents (None without a lexicon).

    The lexicon comes from all labelled texts that are not held out, the labels of the label model
    and the classifier from at most ``rows`` of these documents; the vote patterns that the label
    model weighs are counted over all documents. Texts are read once for the hits, from which patterns, sampled rows and
    scores are made. The driver sees the lexicon, the pattern counts (at most 2 to the number of lexicon voters, times
    the few states of the pattern voters) and the hits of the sampled rows.
    """
    chosen = written(sample(labels, rows), "toxic-sample")
    lexicon = mine_lexicon(labelled_texts(docs, labels))
    if not lexicon:
        share = docs.select("doc_id").join(F.broadcast(chosen), "doc_id").agg(F.avg("toxic")).first()[0] or 0.0
        return Model([], np.zeros(2), float(np.log(share / (1 - share))) if 0 < share < 1 else -40.0), None
    found = lexicon_hits(docs, lexicon)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            total.update(encode(Voters.votes(h)) for h in _hits(batch, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total.keys()), pa.int64()), pa.array(list(total.values()), pa.int64())], ["pattern", "n"])

    free = {r.pattern: float(r.n) for r in found.select("stems", "words", "length").mapInArrow(count, "pattern long, n long")
            .groupBy("pattern").agg(F.sum("n").alias("n")).collect()}
    seen = [((r.stems, r.words, r.length), r.toxic > 0) for r in found.join(F.broadcast(chosen), "doc_id").collect()]
    patterns = [encode(Voters.votes(h)) for h, _ in seen]
    known = {k: float(v) for k, v in Counter(zip(patterns, (int(y) for _, y in seen))).items()}
    for (pattern, _), n in known.items():
        free[pattern] = max(free.get(pattern, 0.0) - n, 0.0)
    model = LabelModel().fit(free, known)
    target = model.posterior(np.array([decode(p) for p in patterns]).reshape(-1, N_VOTERS))
    x = np.zeros((len(seen), features(lexicon) + 2))
    for row, (hit, _) in enumerate(seen):
        x[row, hit[0]] = 1
        x[row, -2:] = Model.extra(hit[1], hit[2])
    return Model(lexicon, *logistic(x, target)), found


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every whole text; predicted is 1 from a score of 0.5.

    Labels, lang, source and doc_id are no input of a score. A null text counts as empty and an
    empty one scores like any text without a hit. Without both kinds of labels every score is next to
    0; if both are there but no stem parts them, it is the toxic share of the labels. Rows that repeat
    give repeated rows, a null id is held out, and an empty table gives no rows.
    """
    model, found = fit_and_hits(docs, labels, rows)
    if found is None:
        found = docs.select("doc_id", F.array().cast("array<int>").alias("stems"), F.lit(0).alias("words"), F.lit(0).alias("length"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(h) for h in _hits(batch, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return found.mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, with all columns; rows are scored where they are read."""
    model = fit(docs, labels, rows)
    kept = docs.schema.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(model.lexicon)
        for batch in batches:
            for part in slices(batch, 1024):
                scores = np.array([model.score(voters.hits(t)) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0)], ["row"]).filter(pa.array(scores < 0.5))

    packed = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return packed.mapInArrow(run, f"row {kept}").select("row.*")
