"""Quality classifier from weak labels.

Several heuristic labellers look at each text and vote good (+), bad (-) or abstain
(0); texts too short for a labeller are not put to it (.).  Expectation-maximisation estimates, without
any true label, how often each labeller votes what on good and on bad documents; the posterior of a vote
pattern is its probability of being good, so a - of a labeller that is often wrong weighs little.  A hashed linear scorer learns these posteriors as soft
targets, and its score decides: it sees words and word shapes that no labeller asks for.

Scale: votes and scores are narrow maps over whole texts.  EM works on the counts of vote
patterns (partial aggregation, at most 3 ** 8 + 3 ** 2 + 1 rows, whatever the input).  The scorer is
fitted on a bounded sample, `TRAIN_ROWS` rows chosen by hash, in `PARTS` parts in
parallel, whose weights are averaged.  Weights (2 ** 16 floats) travel with the tasks.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import map_texts, pick
from .html_text import STOP_WORDS
from .quality_rules import SEPARATORS, repeated_words

#: Rows that the scorer is fitted on, about; parts that are fitted side by side.
TRAIN_ROWS, PARTS = 12_000, 8
BUCKETS = 1 << 16
EPOCHS, RATE, DECAY = 12, 0.5, 1e-6
EM_ROUNDS = 200
#: Imagined documents of each class and votes of each sort, beside all documents.
PRIOR = 0.5
THRESHOLD = 0.5
#: Weight of a repeated word beside that of any word.
REPEAT_SCALE = 4
SEED = 42

_STOP = frozenset(w.encode() for w in STOP_WORDS)
_SYMBOLS = b"#*$%&|<>{}[]\\^~_=+"
#: Marks that end a sentence, each with the blank after it.
_ENDS = tuple(f"{mark} ".encode() for mark in ".!?:。！？؟।…")
#: Bytes as shape classes: upper and lower case, digits, above ASCII as lower case; others stand for themselves.
_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))

_RUN = re.compile(rb"(.)\1+", re.DOTALL)

_UPPERS, _LOWERS = bytes(range(65, 91)), bytes(range(97, 123))
_MARKS_TO_BLANKS = bytes.maketrans(b".,;:!?", b"      ")

LABELLERS = ("symbols", "shouting", "stutter", "stop words", "menu", "sentences", "windows", "variety")


def votes(text: str | None) -> str:
    """One of `+-0` for each labeller; texts of under ten words are put to symbols and shouting alone, the rest is `.`."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return "." * len(LABELLERS)
    chars = sum(map(len, words))

    def vote(bad: bool, good: bool) -> str:
        return "-" if bad else "+" if good else "0"

    litter = chars - len(raw.translate(None, _SYMBOLS)) + len(raw) - chars
    upper, lower = len(raw) - len(raw.translate(None, _UPPERS)), len(raw) - len(raw.translate(None, _LOWERS))
    found = [vote(litter * 10 > chars, litter * 50 <= chars), vote(2 * upper > upper + lower, 5 * upper <= upper + lower)]
    if n < 10:
        return "".join(found) + "." * (len(LABELLERS) - 2)
    again = sum(map(eq, words, words[1:]))
    stop = sum(map(_STOP.__contains__, raw.lower().translate(_MARKS_TO_BLANKS).split()))
    parted = sum(map(words.count, SEPARATORS))
    spaced = b" ".join(words) + b" "
    ends = sum(map(spaced.count, _ENDS))
    window = repeated_words(words)
    kinds = len(set(words))
    return "".join([
        *found,
        vote(4 * again > n, 20 * again <= n),
        vote(50 * stop < n, 10 * stop >= n),
        vote(8 * parted > n, parted == 0),
        vote(ends == 0 and n >= 40 or 3 * ends > n, 60 * ends >= n),
        vote(100 * window > 30 * n, 100 * window <= 5 * n),
        vote(n >= 50 and 5 * kinds < n, n >= 50 and kinds * math.log(n + 1) > n),
    ])


def fit_labellers(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> tuple[float, np.ndarray, dict[str, float]]:
    """Share of documents more likely good than bad, P(+ | class, + or -) [labeller, 0 bad and 1 good], P(good | pattern).

    Two classes; given the class, votes are independent, and abstaining is a vote like any other (junk often leaves
    a labeller undecided); `.` tells nothing.  The start is the majority: a pattern is as good as its share of +
    among + and -, so a lone - does not condemn by itself, and the rounds tell whose - may be overruled.
    """
    names = sorted(patterns)
    if not names:
        return 0.5, np.full((len(LABELLERS), 2), 0.5), {}
    counts = np.array([patterns[p] for p in names], dtype=float)
    said = np.array([[[v == kind for v in p] for p in names] for kind in "+-0"], dtype=float)
    plus, minus = said[0].sum(axis=1), said[1].sum(axis=1)
    good = (plus + 0.5) / (plus + minus + 1)
    belongs = np.stack([1 - good, good])
    for _ in range(rounds):
        weight = belongs * counts
        share = weight.sum(axis=1) + PRIOR
        votes_of = np.stack([weight @ one for one in said]) + PRIOR
        rate = votes_of / votes_of.sum(axis=0)
        log = np.log(share / share.sum())[:, None] + sum(np.log(r) @ one.T for r, one in zip(rate, said))
        belongs = np.exp(log - log.max(axis=0))
        belongs /= belongs.sum(axis=0)
    likely = counts @ (belongs[1] > 0.5) / counts.sum()
    return float(likely), (rate[0] / (rate[0] + rate[1])).T, dict(zip(names, map(float, belongs[1])))


def shape(word: bytes) -> bytes:
    """Runs of upper case, lower case, digits and each other character, one byte for each run of the whole word."""
    return _RUN.sub(rb"\1", word.translate(_SHAPE))


def bucket(feature: bytes) -> int:
    return zlib.crc32(feature) % BUCKETS


def features(text: str | None) -> dict[int, float]:
    """Hashed words, shapes and repeats, as shares of the words."""
    words = (text or "").encode("utf-8", "replace").split()
    found: Counter = Counter()
    for w, n in Counter(words).items():
        found[bucket(b"w" + w.lower())] += n
        found[bucket(b"s" + shape(w))] += n
    found[bucket(b"again")] += REPEAT_SCALE * sum(map(eq, words, words[1:]))
    return {k: v / len(words) for k, v in found.items()} if words else {}


def fit_scorer(rows: list[dict[int, float]], goals: list[float]) -> np.ndarray:
    """Logistic regression on soft targets by AdaGrad; weights of the buckets, then the intercept."""
    weights, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-6)
    packed = [(np.fromiter(r, dtype=np.int64), np.fromiter(r.values(), dtype=float)) for r in rows]
    order = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in order.permutation(len(packed)):
            at, x = packed[i]
            slope = 1 / (1 + math.exp(-max(-30.0, min(30.0, weights[at] @ x + weights[-1])))) - goals[i]
            step = slope * x + DECAY * weights[at]
            squares[at] += step * step
            weights[at] -= RATE * step / np.sqrt(squares[at])
            squares[-1] += slope * slope
            weights[-1] -= RATE * slope / math.sqrt(squares[-1])
    return weights


class Scorer:
    """Scores whole texts; keeps the summed weights of words it has met."""

    def __init__(self, weights: np.ndarray, most: int = 400_000):
        self.weights, self.most, self.seen = weights, most, {}
        self.again, self.base = float(weights[bucket(b"again")]), float(weights[-1])

    def word(self, word: bytes) -> float:
        found = float(self.weights[bucket(b"w" + word.lower())] + self.weights[bucket(b"s" + shape(word))])
        if len(word) <= 64:
            if len(self.seen) >= self.most:
                self.seen.clear()
            self.seen[word] = found
        return found

    def score(self, text: str | None) -> float:
        """P(good); 0 for texts without words."""
        words = (text or "").encode("utf-8", "replace").split()
        if not words:
            return 0.0
        get, total = self.seen.get, 0.0
        for w in words:
            x = get(w)
            total += self.word(w) if x is None else x
        total = (total + REPEAT_SCALE * self.again * sum(map(eq, words, words[1:]))) / len(words) + self.base
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def fit(docs: DataFrame, total: int, posteriors: dict[str, float], key: str, text: str, rows: int) -> np.ndarray:
    """Average weights of the parts' scorers over about `rows` rows, chosen by a hash of text and key.

    Equal rows are chosen together, so repeated rows may take the sample over `rows`, no
    more than in proportion to their share.
    """
    share = min(1.0, rows / max(1, total))
    limit = int(share * (1 << 31))
    hashed = F.xxhash64(F.lit(SEED), F.col(key), F.col(text))
    sample = (pick(docs, key, text).withColumn("h", hashed).where(F.pmod("h", F.lit(1 << 31)) < limit)
              .withColumn("part", F.pmod(F.shiftright("h", 33), F.lit(PARTS)).cast("int")).select("part", "h", text))

    def learn(key_: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["h", text], na_position="first")
        found = [(f, posteriors[v]) for t in part[text] if (f := features(t)) and (v := votes(t)) in posteriors]
        return pd.DataFrame({"weights": [fit_scorer([f for f, _ in found], [g for _, g in found]).tolist()], "n": [len(found)]})

    fitted = sample.groupBy("part").applyInPandas(learn, "weights array<double>, n long").where("n > 0").collect()  # PARTS rows
    if not fitted:
        return np.zeros(BUCKETS + 1)
    return np.average([r["weights"] for r in fitted], axis=0, weights=[r["n"] for r in fitted])


def classify(docs: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, votes, posterior (of the votes), score (of the scorer), kept (score >= threshold).

    Null and empty texts, and those of white space alone, get no vote and score 0.
    Whole texts are read.  Repeated rows and null keys are kept; an empty table gives an empty result; other
    columns are not looked at.  Equal texts get equal scores.
    """
    spark = docs.sparkSession
    rows = pick(docs, key, text)
    cast = (map_texts(rows.select(text), (), text, "votes string", lambda: lambda texts: [[votes(t) for t in texts]])
            .groupBy("votes").count())
    counts = {r["votes"]: r["count"] for r in cast.collect()}  # as many rows as there are patterns
    _, _, posteriors = fit_labellers({v: n for v, n in counts.items() if v.strip("0.")})
    shipped = spark.sparkContext.broadcast(fit(docs, sum(counts.values()), posteriors, key, text, train_rows).astype(np.float32))

    def make():
        scorer = Scorer(shipped.value)

        def run(texts: list[str | None]) -> list[list]:
            cast_ = [votes(t) for t in texts]
            return [cast_, [posteriors.get(v) for v in cast_], [scorer.score(t) for t in texts]]
        return run

    return (map_texts(rows, (key,), text, "votes string, posterior double, score double", make)
            .withColumn("kept", F.col("score") >= threshold))
