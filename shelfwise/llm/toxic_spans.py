"""Toxicity by a linear-chain conditional random field over words.

Each word is clean (0) or offending (1); a sentence is a chain between clean ends. The labels name whole
documents, so the learner first labels the words: in documents marked toxic a word counts as offending
if it, its beginning or its ending is far more frequent there than in clean ones; everything in
clean documents is clean. The field learns these labels, relabels the toxic documents by its own
marginals, and learns again. Scoring runs forward and backward over every sentence of the whole text;
the marginals give the offending spans, and a logistic curve of their aggregates the document's score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import drop_work_table, map_slices, table, work_table

#: Most code points of labelled text that the learner takes of either class, and most of one text.
SAMPLE_CHARS = 4_000_000
SAMPLE_TEXT_CHARS = 100_000
#: Counted for every text besides its code points, so that the number of texts is bounded too.
LEAST_CHARS = 100
#: A word, a word's ending or beginning that teaches: documents at least, and how unevenly spread.
SEED_G2, SEED_RATIO = 30.0, 6.0
#: The learner cuts its sentences here; scoring never does.
TRAIN_WORDS = 96
STEPS, RATE, RIDGE = 60, 0.25, 2e-3
#: Words remembered by a scoring task.
MEMO = 300_000
OFFENDING = 0.5

_TOKEN = re.compile(r"\w+|[.!?\n]")
_ENDS = frozenset(".!?\n")
_LIMIT = 30.0


def features(word: str) -> list[str]:
    """What the field sees of a word: itself, its beginnings and endings, its length."""
    w = word.lower()
    return [
        "b", f"l{min(len(w), 16)}", f"w{w}", *(f"p{w[:k]}" for k in range(2, min(len(w), 8))),
        *(f"s{w[-k:]}" for k in range(2, min(len(w), 5))),
    ]


def sentences(text: str) -> Iterator[list[str]]:
    """Words between sentence ends; sentences without words are skipped."""
    held: list[str] = []
    for t in _TOKEN.findall(text):
        if t in _ENDS:
            if held:
                yield held
                held = []
        else:
            held.append(t)
    if held:
        yield held


class Chains:
    """Chains laid side by side, the longest first, so that step t touches those with over t words."""

    def __init__(self, lengths: np.ndarray):
        self.starts = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
        self.by = np.argsort(-lengths, kind="stable")
        ordered = lengths[self.by]
        longest = int(ordered[0]) if len(ordered) else 0
        self.active = np.searchsorted(-ordered, -np.arange(longest), side="left")
        self.at = self.starts[self.by]
        self.last = self.at + ordered - 1

    def run(self, e: np.ndarray, c: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
        """(r, s) per word: odds of 1 seen from the left with the word itself, and from the right.

        ``e`` are the words' odds, ``c`` the odds of the steps 0-1, 1-0 and 1-1 against 0-0.
        Before and after a chain stands a clean word. The marginal odds are r * s.
        """
        c01, c10, c11 = c
        r, s = np.empty_like(e), np.empty_like(e)
        for t, n in enumerate(self.active):
            here = self.at[:n] + t
            if t == 0:
                r[here] = e[here] * c01
            else:
                before = r[here - 1]
                r[here] = np.clip(e[here] * (c01 + c11 * before) / (1 + c10 * before), 1e-30, 1e30)
        s[self.last] = c10
        for t in range(len(self.active) - 2, -1, -1):
            here = self.at[: self.active[t + 1]] + t
            after = e[here + 1] * s[here + 1]
            s[here] = (c10 + c11 * after) / (1 + c01 * after)
        return r, s


def marginals(r: np.ndarray, s: np.ndarray) -> np.ndarray:
    odds = r * s
    return odds / (1 + odds)


@dataclass
class Field:
    """Weights of the features, of the steps 0-1, 1-0 and 1-1, and of the document curve."""

    weights: dict[str, float]
    steps: tuple[float, float, float]
    curve: tuple[float, ...]

    def odds(self, word: str) -> float:
        get = self.weights.get
        return float(np.exp(np.clip(sum(get(f, 0.0) for f in features(word)), -_LIMIT, _LIMIT)))


def aggregate(p: np.ndarray, n: int) -> list[float]:
    """What the curve sees of a document: expected offending words, their share, the two highest marginals."""
    if not n:
        return [0.0, 0.0, 0.0, 0.0]
    top = np.sort(p)[-2:]
    return [float(np.log1p(p.sum())), float(np.log1p(100 * p.sum() / n)), float(top[-1]), float(top[0]) if n > 1 else 0.0]


def curve_score(curve: tuple[float, ...], x: list[float]) -> float:
    z = curve[0] + sum(w * v for w, v in zip(curve[1:], x, strict=True))
    return float(1 / (1 + np.exp(-np.clip(z, -_LIMIT, _LIMIT))))


# ------------------------------------------------------------------ learning


class Corpus:
    """The sample as arrays: word numbers of all sentences, their documents, the words' features."""

    def __init__(self, texts: Iterable[str]):
        number: dict[str, int] = defaultdict(lambda: len(number))
        words, lengths, of = [], [], []
        self.n_docs = 0
        for text in texts:
            for s in sentences(text):
                ids = [number[w.lower()] for w in s]
                words += ids
                for a in range(0, len(ids), TRAIN_WORDS):
                    lengths.append(min(TRAIN_WORDS, len(ids) - a))
                of += [self.n_docs] * len(ids)
            self.n_docs += 1
        self.words, self.doc = np.array(words, np.int64), np.array(of, np.int64)
        self.lengths = np.array(lengths, np.int64)
        self.vocabulary = list(number)
        names: dict[str, int] = defaultdict(lambda: len(names))
        lists = [[names[f] for f in features(w)] for w in self.vocabulary]
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.flat = np.array([f for x in lists for f in x], np.int64)
        self.names = list(names)

    def emissions(self, theta: np.ndarray) -> np.ndarray:
        """Log-odds of every distinct word."""
        if not len(self.flat):
            return np.zeros(0)
        ends = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        return np.add.reduceat(theta[self.flat], ends)

    def per_feature(self, per_word: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, np.repeat(per_word, self.sizes), minlength=len(self.names))


def seeds(c: Corpus, toxic: np.ndarray) -> np.ndarray:
    """First labels of the words: 1 in toxic documents where a feature of the word gives it away.

    A feature counts at most three times in a document, so one document that repeats a word does not
    decide. It gives away if it prefers toxic documents SEED_RATIO times and by a likelihood ratio
    of SEED_G2 at least.
    """
    seen = Counter(zip(c.doc.tolist(), c.words.tolist(), strict=True))
    pairs = np.array(list(seen), np.int64).reshape(-1, 2)
    times = np.minimum(np.array(list(seen.values()), float), 3)
    label = toxic[pairs[:, 0]]
    v = len(c.vocabulary)
    bad = c.per_feature(np.bincount(pairs[label, 1], times[label], minlength=v))
    good = c.per_feature(np.bincount(pairs[~label, 1], times[~label], minlength=v))
    share = max(times[label].sum(), 1) / max(times.sum(), 1)
    n, rate = bad + good, (bad + 0.5) / (good + 0.5) * (1 - share) / share
    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * (np.where(bad > 0, bad * np.log(bad / (n * share)), 0) + np.where(good > 0, good * np.log(good / (n * (1 - share))), 0))
    gives_away = (g2 >= SEED_G2) & (rate >= SEED_RATIO)
    known = c.emissions(gives_away.astype(float)) > 0
    return (known[c.words] & toxic[c.doc]).astype(float)


def learn_field(c: Corpus, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature and step weights by gradient ascent on the labels' conditional likelihood."""
    chains = Chains(c.lengths)
    starts = np.zeros(len(c.words), bool)
    starts[chains.starts] = True
    inner = np.flatnonzero(~starts)
    y_before = y[inner - 1]
    theta, step = np.zeros(len(c.names)), np.zeros(3)
    theta[c.names.index("b")] = -3.0
    want = c.per_feature(np.bincount(c.words, y, minlength=len(c.vocabulary)))
    ends = y[chains.starts].sum(), y[chains.last].sum()
    want_steps = np.array([ends[0] + ((1 - y_before) * y[inner]).sum(), ends[1] + (y_before * (1 - y[inner])).sum(), (y_before * y[inner]).sum()])
    seen_theta, seen_step = np.zeros_like(theta), np.zeros(3)
    scale = 1 / max(1.0, y.sum())
    for _ in range(STEPS):
        e = np.exp(np.clip(c.emissions(theta), -_LIMIT, _LIMIT))[c.words]
        c01, c10, c11 = np.exp(np.clip(step, -_LIMIT, _LIMIT))
        r, s = chains.run(e, (c01, c10, c11))
        p = marginals(r, s)
        right, left = e[inner] * s[inner], r[inner - 1]
        both = 1 + c01 * right + left * c10 + left * c11 * right
        have_steps = np.array([
            p[chains.starts].sum() + (c01 * right / both).sum(), p[chains.last].sum() + (left * c10 / both).sum(),
            (left * c11 * right / both).sum(),
        ])
        g = (want - c.per_feature(np.bincount(c.words, p, minlength=len(c.vocabulary)))) * scale - RIDGE * theta
        g_step = (want_steps - have_steps) * scale
        seen_theta += g * g
        seen_step += g_step * g_step
        theta += RATE * g / np.sqrt(seen_theta + 1e-12)
        step += RATE * g_step / np.sqrt(seen_step + 1e-12)
    return theta, step


def document_marginals(c: Corpus, theta: np.ndarray, step: np.ndarray) -> np.ndarray:
    e = np.exp(np.clip(c.emissions(theta), -_LIMIT, _LIMIT))[c.words]
    return marginals(*Chains(c.lengths).run(e, tuple(np.exp(np.clip(step, -_LIMIT, _LIMIT)))))


def learn_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-6] + [0.05] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -_LIMIT, _LIMIT)))
        h = (a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + ridge
        w += np.linalg.solve(h, a.T @ (weight * (y - p)) - ridge @ w)
    return tuple(float(v) for v in w)


def learn(texts: list[str], toxic: list[bool], weight: list[float]) -> Field:
    """The field from three quarters of the texts, the document curve from the rest, which it has not seen.

    ``weight`` is how many documents a text stands for. Without both classes there is nothing to
    tell apart: the curve is then the share of toxic ones.
    """
    y, w = np.array(toxic, bool), np.array(weight, float)
    base = float(np.clip((w * y).sum() / max(w.sum(), 1e-9), 1e-4, 1 - 1e-4)) if len(y) else 0.0
    flat = Field({}, (0.0, 0.0, 0.0), (float(np.log(base / (1 - base))) if base else -_LIMIT, 0.0, 0.0, 0.0, 0.0))
    mine = np.arange(len(y)) % 4 != 3
    if not (y & mine).any() or not (~y & mine).any():
        return flat
    c = Corpus(t for t, m in zip(texts, mine, strict=True) if m)
    labels = seeds(c, y[mine])
    if not labels.any():
        return flat
    for _ in range(2):
        theta, step = learn_field(c, labels)
        p = document_marginals(c, theta, step)
        labels = ((p >= OFFENDING) & y[mine][c.doc]).astype(float)
        if not labels.any():
            return flat
    kept = {n: float(v) for n, v in zip(c.names, theta, strict=True) if abs(v) > 1e-3}
    field = Field(kept, tuple(float(v) for v in step), flat.curve)
    rest = np.flatnonzero(~mine) if (y & ~mine).any() and (~y & ~mine).any() else np.arange(len(y))
    scorer = Scorer(field)
    x = np.array([aggregate(p, len(p)) for p in scorer.marginals([texts[i] for i in rest])])
    field.curve = learn_curve(x, y[rest].astype(float), w[rest] * (len(rest) / max(w[rest].sum(), 1e-9)))
    return field


# ------------------------------------------------------------------- scoring


class Scorer:
    """Marginals of whole texts; remembers the odds of the words it met."""

    def __init__(self, field: Field):
        self.field, self.memo = field, {}
        self.steps = tuple(np.exp(np.clip(field.steps, -_LIMIT, _LIMIT)))

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the marginals of its words, in order."""
        odds, lengths, counts = [], [], []
        memo, compute = self.memo, self.field.odds
        for text in texts:
            before = len(odds)
            for words in sentences(text):
                for w in words:
                    o = memo.get(w)
                    if o is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        o = memo[w] = compute(w)
                    odds.append(o)
                lengths.append(len(words))
            counts.append(len(odds) - before)
        if not odds:
            return [np.zeros(0) for _ in texts]
        p = marginals(*Chains(np.array(lengths, np.int64)).run(np.array(odds), self.steps))
        return np.split(p, np.cumsum(counts)[:-1])

    def score(self, texts: list[str]) -> list[tuple[float, list[dict]]]:
        """(score, offending spans) of each text; a span is a run of offending words of one sentence,
        with its start and end in code points and its highest marginal."""
        out = []
        for text, p in zip(texts, self.marginals(texts), strict=True):
            out.append((curve_score(self.field.curve, aggregate(p, len(p))), spans(text, p) if (p >= OFFENDING).any() else []))
        return out


def spans(text: str, p: np.ndarray) -> list[dict]:
    found, at, open_ = [], 0, False
    for m in _TOKEN.finditer(text):
        if m[0] in _ENDS:
            open_ = False
            continue
        if p[at] >= OFFENDING:
            if open_:
                found[-1]["end"], found[-1]["marginal"] = m.end(), max(found[-1]["marginal"], float(p[at]))
            else:
                found.append({"start": m.start(), "end": m.end(), "marginal": float(p[at])})
        open_ = bool(p[at] >= OFFENDING)
        at += 1
    return found


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 when divided by 4 (null: as empty)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample_within(df: DataFrame, key: str, weight: str, bound: int) -> DataFrame:
    """Rows of ``df`` (a written table) in the order of the hashes of ``key``, as many as weigh ``bound`` at most.

    The cut comes from sums in 1024 classes of the hash. The class that overflows is cut again by
    finer classes, so a heavy key costs only itself and what shares its finest class.
    """
    hashed = df.withColumn("__hash", F.shiftrightunsigned(F.xxhash64(key), 1))
    chosen, left, low, shift = F.lit(False), bound, 0, 53
    while shift >= 3:
        at = F.shiftright("__hash", shift) - low
        part = hashed.where((at >= 0) & (at < 1024)).groupBy(at.alias("k")).agg(F.sum(weight).alias("w"))
        sums = {r["k"]: r["w"] for r in part.collect()}
        cut = 0
        while cut < 1024 and sums.get(cut, 0) <= left:
            left -= sums.get(cut, 0)
            cut += 1
        chosen = chosen | ((at >= 0) & (at < cut))
        if cut == 1024:
            break
        low, shift = (low + cut) << 10, shift - 10
    return hashed.where(chosen).drop("__hash")


def fit(docs: DataFrame, labels: DataFrame, chars: int = SAMPLE_CHARS) -> Field:
    """Learn from labelled documents that are not held out: at most ``chars`` code points of either class.

    Only ``labels.toxic`` is read, and only where it is 0 or 1. Ids whose texts have over SAMPLE_TEXT_CHARS
    code points teach nothing (they are scored like all others). A document labelled both ways teaches
    both, a repeated label nothing more. The choice reads ids and lengths; only chosen texts travel.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out())
    known = known.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    size = F.length(F.coalesce("text", F.lit(""))) + LEAST_CHARS
    sizes = docs.where(~held_out()).groupBy("doc_id").agg(F.sum(size).alias("chars"), F.count("*").alias("n"))
    rows = work_table(sizes.join(known, "doc_id").where(F.col("chars") <= SAMPLE_TEXT_CHARS))
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    chosen = [sample_within(rows.where(F.col("toxic") == t), "doc_id", "chars", chars) for t in totals]
    if not chosen:
        return learn([], [], [])
    ids = reduce(DataFrame.unionByName, chosen).select("doc_id", "toxic")  # 2 * chars / LEAST_CHARS rows at most
    got = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").collect()
    drop_work_table(rows)
    got.sort(key=lambda r: (zlib.crc32(f"order {r['doc_id']}".encode()), r["text"] or "", r["toxic"]))
    each = Counter(r["toxic"] for r in got)
    stands_for = [totals[r["toxic"]] / each[r["toxic"]] for r in got]
    return learn([r["text"] or "" for r in got], [r["toxic"] == 1 for r in got], stands_for)


SPANS = "array<struct<start: int, end: int, marginal: double>>"


def tag(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, score, spans: one row per input row, judged by the whole text alone.

    Null, empty and wordless texts have no spans and the score of a text without offending words.
    Repeated rows are judged one by one; other columns are ignored. Offsets are code points.
    """
    held = []

    def judge(part: dict[str, list]) -> dict[str, list]:
        if not held:
            held.append(Scorer(field))
        found = held[0].score([t or "" for t in part["text"]])
        return {"doc_id": part["doc_id"], "score": [s for s, _ in found], "spans": [x for _, x in found]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(docs.select("doc_id", "text"), judge, f"doc_id {kind}, score double, spans {SPANS}")


def op12_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, verdict at 0.3 and number of offending spans of every document."""
    docs = table(spark, sf_dir, "documents")
    found = tag(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )
