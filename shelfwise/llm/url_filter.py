"""URL filter: explicit rules first, then naive Bayes over segmented host and path words."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import bounded_sample, drop_work_table, expand_slices, map_slices, skewed_lookup, table, work_table

#: (rule, verdict): a host with its subdomains, and the start of the path.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Most different urls with a rule's verdict that the classifier is fitted on (those with the smallest
#: hashes), each with the number of its rows.
SAMPLE_ROWS = 20_000
LONGEST_WORD = 24
#: Counts of words of up to so many letters, 18,278 at most, go to all tasks; longer words are joined.
SHORT_WORD = 3
#: Letters of a name whose substrings a task puts out at once.
PORTION = 2_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null or without ``://``."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def matching_rule(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (of equal ones the first by name) and its verdict; null where none fits.

    The rules are literals of the expression, longest first, so nothing is joined.
    """
    rule = verdict = None
    for text, decision in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        cut = text.index("/")
        name, start = text[:cut], text[cut:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, decision) if verdict is None else verdict.when(fits, decision)
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if rule is None else (rule, verdict)


_TAG = re.compile(r"<[^>]*>")
_WORD = re.compile(r"[a-z]+")
_TOKEN = re.compile(r"[a-z]+|[0-9]+")


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) over the text of all pages, lower case a-z; combined in each task before the shuffle."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        seen: Counter[str] = Counter()
        for html in cols["html"]:
            seen.update(_WORD.findall(_TAG.sub(" ", html or "").lower()))
        return {"word": list(seen), "n": list(seen.values())}

    return map_slices(pages.select("html"), run, "word string, n long", rows=5000).groupBy("word").agg(F.sum("n").alias("n"))


class Segmenter:
    """Best split of concatenated words under a unigram model (Viterbi).

    An unknown piece of k characters has probability 1 / (total * 10**k), so known words win where
    they fit. Of equally good splits the one with the longest last word is taken. ``counts`` may hold
    only the words within the texts to split, if ``total`` is that of all words and one.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None) -> None:
        total = total or sum(counts.values()) + 1
        self.log = {w: math.log(n / total) for w, n in counts.items() if len(w) <= LONGEST_WORD}
        self.unknown = -math.log(total)

    def split(self, name: str) -> tuple[str, ...]:
        best, back, log = [0.0], [0], self.log
        for end in range(1, len(name) + 1):
            top, where = -math.inf, 0
            for start in range(max(0, end - LONGEST_WORD), end):
                own = log.get(name[start:end])
                score = best[start] + (own if own is not None else self.unknown - 2.302585 * (end - start))
                if score > top:
                    top, where = score, start
            best.append(top)
            back.append(where)
        out, end = [], len(name)
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return tuple(reversed(out))


_PLACES = ("h:", "p:")


def numbers(host: str, path: str) -> list[str]:
    """Tokens of the numbers in the host (h:) and the path (p:): the digits' count, and with it the first digit."""
    found = [(place, t) for place, text in zip(_PLACES, (host, path.lower()), strict=True) for t in _TOKEN.findall(text)]
    return [x for place, t in found if t.isdigit() for x in (f"{place}#{len(t)}", f"{place}#{t[0]}x{len(t)}")]


def names(host: str, path: str) -> list[tuple[str, str]]:
    """(place, letters) of each piece to be split into words."""
    pieces = zip(_PLACES, (host, path.lower()), strict=True)
    return [(place, t) for place, text in pieces for t in _TOKEN.findall(text) if not t.isdigit()]


def tokens(host: str, path: str, split: Callable[[str], Iterable[str]]) -> list[str]:
    """Words of the host (h:) and of the path (p:), and those of the numbers."""
    return numbers(host, path) + [place + w for place, name in names(host, path) for w in split(name)]


class NaiveBayes:
    """Multinomial, add-one smoothing; ``score`` above 0 speaks for block. Rows: tokens, blocked, how often."""

    def __init__(self, rows: list[tuple[list[str], bool, int]]) -> None:
        n: Counter[bool] = Counter()
        seen: dict[bool, Counter[str]] = {True: Counter(), False: Counter()}
        for tokens, blocked, times in rows:
            n[blocked] += times
            for t in tokens:
                seen[blocked][t] += times
        vocabulary = set(seen[True]) | set(seen[False])
        size = {b: sum(seen[b].values()) + len(vocabulary) for b in (True, False)}
        self.prior = math.log((n[True] + 1) / (n[False] + 1))
        self.weight = {
            t: math.log((seen[True][t] + 1) / size[True]) - math.log((seen[False][t] + 1) / size[False]) for t in vocabulary
        }

    def score(self, tokens: list[str], weights: Iterable[float] = ()) -> float:
        """Log odds by the tokens and by the weights of tokens looked up before; their order changes nothing."""
        return self.prior + math.fsum([*(self.weight.get(t, 0.0) for t in tokens), *weights])


def named(rows: DataFrame) -> DataFrame:
    """(row, place, name) of each piece of each url."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        out = [(r, *n) for r, h, p in zip(cols["row"], cols["host"], cols["path"], strict=True) for n in names(h, p)]
        return {c: [x[i] for x in out] for i, c in enumerate(("row", "place", "name"))}

    return map_slices(rows.select("row", "host", "path"), run, "row long, place string, name string", rows=256)


def substrings(name: str) -> Iterator[set[str]]:
    """The different substrings of SHORT_WORD + 1 to LONGEST_WORD letters, by portions of their starts."""
    for at in range(0, len(name) - SHORT_WORD, PORTION):
        starts = range(at, min(at + PORTION, len(name) - SHORT_WORD))
        yield {name[a:b] for a in starts for b in range(a + SHORT_WORD + 1, min(len(name), a + LONGEST_WORD) + 1)}


def segments(counts: DataFrame, each: DataFrame) -> DataFrame:
    """(name, words): the best split of each different name, by the counts of all words.

    A name meets only the counts of the words within it, by a join, so no task holds the vocabulary; a
    name travels once, its substrings carry a number for it. Only counts of words of at most
    SHORT_WORD letters, a bounded number, are known to all tasks.
    """
    total = (counts.agg(F.sum("n")).first()[0] or 0) + 1
    length = F.length("word")
    short = {r["word"]: r["n"] for r in counts.where(length <= SHORT_WORD).collect()}
    different = work_table(each.select("name").distinct().withColumn("id", F.monotonically_increasing_id()))

    def within(cols: dict[str, list]) -> Iterator[dict[str, list]]:
        for number, name in zip(cols["id"], cols["name"], strict=True):
            for found in substrings(name):
                yield {"id": [number] * len(found), "word": list(found)}

    def best(cols: dict[str, list]) -> dict[str, list]:
        words = []
        for name, joined in zip(cols["name"], cols["known"], strict=True):
            starts = range(len(name))
            known = {w: short[w] for k in range(1, SHORT_WORD + 1) for w in {name[a : a + k] for a in starts} if w in short}
            words.append(Segmenter(known | {r["word"]: r["n"] for r in joined or ()}, total).split(name))
        return {"name": cols["name"], "words": words}

    pieces = work_table(expand_slices(different, within, "id long, word string", rows=64))
    long = counts.where((length > SHORT_WORD) & (length <= LONGEST_WORD))
    met = skewed_lookup(pieces, long, "word", F.xxhash64("id"))
    known = met.groupBy("id").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    split = work_table(map_slices(different.join(known, "id", "left"), best, "name string, words array<string>"))
    drop_work_table(pieces)
    drop_work_table(different)
    return split


def fit(split: DataFrame, rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> NaiveBayes:
    """The classifier, on different urls that a rule decides and how often each occurs."""
    decided = rows.where("decided is not null").groupBy("host", "path", "decided").agg(F.count("*").alias("n"))
    known = work_table(bounded_sample(decided, ["host", "path"], sample_rows).withColumn("row", F.monotonically_increasing_id()))
    needed = split.join(named(known).select("name").distinct(), "name")
    words = {r["name"]: r["words"] for r in needed.collect()}
    found = [(tokens(r["host"], r["path"], words.__getitem__), r["decided"] == "block", r["n"]) for r in known.collect()]
    drop_work_table(known)
    return NaiveBayes(found)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; html is read once and not shuffled.

    A rule's verdict stands; otherwise the classifier decides, allow at a score of 0 or less, and
    ``score`` is its log odds for block. Null and malformed urls have empty parts, no tokens and so
    the prior's verdict. Without any url that a rule decides the prior is even and all are allowed.
    """
    host, path = parts(F.col("url"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    plain = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = work_table(plain.withColumns({"rule": rule, "decided": verdict, "row": F.monotonically_increasing_id()}))
    kind = rows.schema["page_id"].dataType.simpleString()
    each = work_table(named(rows).withColumn("key", F.concat("place", "name")))
    counts = work_table(word_counts(pages))
    split = segments(counts, each)
    drop_work_table(counts)
    model = pages.sparkSession.sparkContext.broadcast(fit(split, rows))

    def weigh(cols: dict[str, list]) -> dict[str, list]:
        known = model.value.weight
        out: dict[str, list] = {"key": [], "weights": []}
        for name, words in zip(cols["name"], cols["words"], strict=True):
            for place in _PLACES:
                if found := [known[place + w] for w in words if place + w in known]:
                    out["key"].append(place + name)
                    out["weights"].append(found)
        return out

    weights = work_table(map_slices(split, weigh, "key string, weights array<double>"))
    met = skewed_lookup(each, weights, "key", F.xxhash64("row"))
    per_row = met.groupBy("row").agg(F.flatten(F.collect_list("weights")).alias("weights"))

    def run(cols: dict[str, list]) -> dict[str, list]:
        bayes = model.value
        out = {c: cols[c] for c in ("page_id", "host", "path", "rule")} | {"verdict": [], "score": []}
        for h, p, decided, found in zip(cols["host"], cols["path"], cols["decided"], cols["weights"], strict=True):
            score = bayes.score(numbers(h, p), found or ())
            out["score"].append(score)
            out["verdict"].append(decided or ("block" if score > 0 else "allow"))
        return out

    scored = rows.join(per_row, "row", "left").drop("row")
    return map_slices(scored, run, f"page_id {kind}, host string, path string, rule string, verdict string, score double")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages"))
