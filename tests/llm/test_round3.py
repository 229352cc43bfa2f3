"""Fill-in-middle, toxic spans and hard negatives against brute force and on edge cases."""

from __future__ import annotations

import functools
import gzip
import hashlib
import math
import re
import time
from collections import Counter, defaultdict
from itertools import combinations, product

import numpy as np
import pytest

from shelfwise.llm import fill_middle as fim
from shelfwise.llm import html_tree, main_text, near_dup, url_filter, warc
from shelfwise.llm import hard_negatives as hard
from shelfwise.llm import toxic_spans as tox

# ------------------------------------------------------------- fill-in-middle
TEXTS = [None, "", "x", "ab<P>cd", "<S", "<M>", "plain <text> with <P and S> <", "é\U0001f600ü" * 7, "<" * 50, "<S<P<M" * 9,
         " ".join(f"w{i}" for i in range(30_000)), "twin", "twin"]
FIM_SCHEMA = "doc_id long, text string, n long, form string, place int, piece string"


def fim_expected(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, a, b - a, sha(out), sha(text)


@pytest.fixture(scope="module")
def fim_docs(spark):
    rows = [(i if i % 11 else None, t, 5, "x", 1, "y") for i, t in enumerate(TEXTS * 5)]
    rows += [(3, "again and again", 1, "x", 1, "y")] * 9
    return spark.createDataFrame(rows, FIM_SCHEMA).repartition(3)


@pytest.mark.parametrize("length", [1, 7, 16_384])
def test_fill_middle_digests(spark, fim_docs, length):
    if length < 7:  # a piece for each code point: short texts suffice
        fim_docs = fim_docs.where("text is null or length(text) < 200")
    got = Counter(tuple(r) for r in fim.digests(fim_docs, length, 5).collect())
    assert got == Counter(fim_expected(r["doc_id"], r["text"]) for r in fim_docs.collect())
    assert len({k[2] for k in got}) == 3


def test_fill_middle_outputs_join_to_the_texts(fim_docs):
    by_row = defaultdict(list)
    for r in fim.outputs(fim_docs, 1000, 4).collect():
        assert len(r["piece"]) <= 1000
        by_row[r["row"]].append(r)
    got = Counter()
    for rows in by_row.values():
        rows.sort(key=lambda r: r["place"])
        out = "".join(r["piece"] for r in rows)
        got[rows[0]["doc_id"], rows[0]["form"], hashlib.sha256(out.encode()).hexdigest()] += 1
    want = [fim_expected(r["doc_id"], r["text"]) for r in fim_docs.collect()]
    assert got == Counter((w[0], w[2], w[5]) for w in want)


def test_markers_cut_anywhere_are_found():
    for form, (a, b, c) in product((fim.PSM, fim.SPM), [("<", "S>", "<S"), ("", "<", ""), ("<P", "><", "M>"), ("x", "", "<")]):
        text = a + b + c
        p = fim.Plan(len(text), form, len(a), len(a) + len(b))
        out = "".join(fim.pieces(text, p))
        for step in (1, 2, 3, 50):
            got = sorted(enumerate(fim.parts(form, (out[i : i + step] for i in range(0, len(out), step)))), key=lambda x: (x[1][0], x[0]))
            assert "".join(t for _, (_, t) in got) == text


def test_fill_middle_of_nothing(spark):
    assert fim.digests(spark.createDataFrame([], FIM_SCHEMA)).count() == 0
    assert fim.outputs(spark.createDataFrame([], FIM_SCHEMA)).count() == 0


# ------------------------------------------------------------- hard negatives
VEC = "vec_id long, embedding array<float>, label int, score long, dim int, block int"


def hard_expected(rows, every=50):
    best = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        item = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        best[i] = min(best.get(i, item), item)
    out = []
    for a, (la, va) in best.items():
        if a % every:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, lab) for i, (lab, v) in best.items() if i != a and len(v) == len(va)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scored if s[2] == la][:5]:
            fits = [s for s in scored if s[2] != la and 50 * ps <= 100 * s[0] <= 95 * ps][:3]
            out += [(a, p, r, i, ps, s) for r, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def vectors(n, dim, seed, distinct=10_000):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.round(rng.normal(size=dim) * distinct) / distinct], int(rng.integers(0, 10))) for i in range(n)]


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 7, 7, 7) for r in rows], VEC)
    return sorted(tuple(r) for r in hard.mine(df, **kw).collect())


def test_hard_negatives_equal_brute_force_with_ties_and_odd_rows(spark):
    rows = vectors(1500, 6, 1) + vectors(600, 3, 2, distinct=2)  # the second: few distinct values, many ties, ids again
    rows += [(None, [1.0] * 6, 1), (50, None, 1), (100, [], 1), (5000, [0.5] * 6, None), (5050, [None] + [1.0] * 5, 2)]
    rows += [(5100, [float("nan")] + [1.0] * 5, 2), (5150, [float("inf")] + [1.0] * 5, 2), (5200, [0.0] * 6, 3), (5250, [1.5], 3)]
    rows += [(5300, [0.25] * 6, 4)] * 20 + [(5301 + i, [0.25] * 6, 4 + i % 2) for i in range(40)]
    want = hard_expected(rows)
    assert len(want) > 100 and mined(spark, rows) == want


def test_hard_negatives_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard, "BLOCK_ROWS", 150)
    monkeypatch.setattr(hard, "FIRST_DEPTH", 2)
    rows = vectors(1200, 8, 3)
    assert mined(spark, rows) == hard_expected(rows)
    assert mined(spark, []) == []


def test_threshold_stops_early_and_is_exact():
    rng = np.random.default_rng(5)
    v = (np.abs(rng.standard_cauchy((5000, 4))) * 100).astype(np.int64) + 1  # a few rows stand out
    ids = np.arange(5000) * 3 + 1
    lists = hard.Lists(ids, ids % 7, v)
    met = 0
    for rows, _, bound in lists.depths(v[7]):
        met += len(rows)
        if bound is not None and bound < np.sort(v @ v[7])[-5]:
            break
    assert met < 2500
    found, scores = hard.nearest(lists, int(ids[7]), v[7], 5)
    order = sorted((-int(s), int(i)) for s, i in zip(v @ v[7], ids) if i != ids[7])[:5]
    assert list(zip((-scores).tolist(), found.tolist())) == order
    huge = hard.Lists(ids[:50], ids[:50] % 2, v[:50] * 2**40)
    assert hard.nearest(huge, -1, v[3] * 2**5, 1)[1][0] == max(sum(int(a) * int(b) for a, b in zip(x * 2**40, v[3] * 2**5)) for x in v[:50])


# ------------------------------------------------------------- toxicity
def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 3, 1, 4])
    e, c = np.exp(rng.normal(size=lengths.sum())), tuple(np.exp(rng.normal(size=3)))
    p = tox.marginals(*tox.Chains(lengths).run(e, c))
    step = {(0, 0): 1.0, (0, 1): c[0], (1, 0): c[1], (1, 1): c[2]}
    at = 0
    for n in lengths:
        total, ones = 0.0, np.zeros(n)
        for tags in product((0, 1), repeat=int(n)):
            w = np.prod([step[a, b] for a, b in zip((0, *tags), (*tags, 0))]) * np.prod([e[at + i] for i, y in enumerate(tags) if y])
            total += w
            ones += w * np.array(tags)
        assert np.allclose(p[at : at + n], ones / total)
        at += n


def test_gradient_makes_expectations_meet_labels():
    words = ["good day here", "you grobbit fool", "fine grobbit now and then", "calm words only"] * 30
    c = tox.Corpus(words)
    y = np.array([w == "grobbit" for w in (c.vocabulary[i] for i in c.words)], float)
    theta, step = tox.learn_field(c, y)
    p = tox.document_marginals(c, theta, step)
    assert p[y == 1].min() > 0.8 and p[y == 0].max() < 0.2


LEX = ["grobbit", "fnarl", "squonk", "zibber"]


def synthetic(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdeilmnorst"), size=rng.integers(2, 7))) for _ in range(rng.integers(5, 60))]
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(LEX)))
        out.append((i, " ".join(words) + ".", int(toxic)))
    return out


@pytest.fixture(scope="module")
def toxic_tables(spark):
    rows = synthetic(1200, 7)
    docs = spark.createDataFrame([(i, t, 1.0, "s", "x") for i, t, _ in rows], "doc_id long, text string, score double, spans string, label string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows if i % 2 or i % 5 == 0] + [(None, 1, 0), (3, None, 0), (99_999, 1, 0)], "doc_id long, toxic int, quality int")
    return docs, labels, rows


def test_toxicity_on_held_out_documents(spark, toxic_tables):
    docs, labels, rows = toxic_tables
    field = tox.fit(docs, labels)
    got = {r["doc_id"]: r for r in tox.tag(docs, field).collect()}
    import zlib

    out = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    flags = {r["doc_id"]: r["h"] for r in docs.select("doc_id", tox.held_out().alias("h")).collect()}
    assert {i for i, h in flags.items() if h} == set(out)
    right = np.mean([(got[i]["score"] >= 0.3) == (rows[i][2] == 1) for i in out])
    assert right > 0.97
    for i in out[:100]:
        text = rows[i][1]
        for s in got[i]["spans"]:
            assert any(w in text[s["start"] : s["end"]] for w in LEX)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_of_odd_rows(spark, toxic_tables):
    docs, labels, _ = toxic_tables
    field = tox.fit(docs, labels)
    long = "calm word " * 40_000 + "İ grobbit fnarl"
    odd = spark.createDataFrame([(1, None), (1, None), (2, ""), (3, " \n!? "), (None, "grobbit fnarl squonk"), (5, long)], "doc_id long, text string")
    got = tox.tag(odd, field).collect()
    assert len(got) == 6
    by = {r["doc_id"]: r for r in got}
    assert by[1]["score"] == by[2]["score"] == by[3]["score"] < 0.3 <= by[None]["score"]
    assert by[5]["spans"] and long[by[5]["spans"][-1]["start"] :] == "grobbit fnarl"
    assert tox.tag(odd.limit(0), field).count() == 0
    none = tox.fit(docs, labels.limit(0))
    assert {r["score"] for r in tox.tag(odd, none).collect()} == {tox.curve_score(none.curve, [0.0] * 4)}
    assert tox.fit(docs.limit(0), labels).weights == {}
    assert tox.fit(docs, labels.where("toxic = 0")).weights == {}


def test_sample_stays_within_its_bound(spark):
    rows = spark.range(20_000).selectExpr("if(id < 9000, 0, id) as k", "if(id < 9000, 1, 1 + id % 3) as w")
    rows = rows.groupBy("k").agg({"w": "sum"}).withColumnRenamed("sum(w)", "w")
    for bound in (50, 1000, 5000, 100_000):
        got = sum(r["w"] for r in tox.sample_within(rows, "k", "w", bound).collect())
        total = 9000 + sum(1 + i % 3 for i in range(9000, 20_000))
        assert got <= bound and (got >= 0.95 * bound - 3 or got >= total or bound < 9000)


# ------------------------------------------------------------- url filter
def best_split(name, counts, total):
    """All splits: the likeliest, of equal ones the one with the longest last word, then the next to last."""
    unknown = -math.log(total)
    splits = []
    for cuts in product((0, 1), repeat=len(name) - 1):
        words, start = [], 0
        for i, cut in enumerate((*cuts, 1), 1):
            if cut:
                words.append(name[start:i])
                start = i
        if max(map(len, words)) <= url_filter.LONGEST_WORD:
            score = sum(math.log(counts[w] / total) if w in counts else unknown - 2.302585 * len(w) for w in words)
            splits.append((round(score, 9), [len(w) for w in reversed(words)], words))
    return max(splits)[2]


def test_url_verdicts_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["news", "shop", "the", "best", "of", "sport", "casino", "a", "in", "go", "golf", "cat", "online"]
    hosts = ["".join(rng.choice(vocabulary, size=rng.integers(1, 4))) for _ in range(60)]
    html = ["<p class=x>" + " ".join(rng.choice(vocabulary, size=30, p=None)) + "</p>" for _ in range(300)]
    ends = ["com/de/", "com/fr/", "org/", "net/", "com/", "net/shop"]
    urls = [f"http://{hosts[int(rng.integers(0, 60))]}.{ends[int(rng.integers(0, 6))]}{rng.choice(vocabulary)}{i % 7}?q" for i in range(298)]
    urls += [None, "nothing"]
    rows = [(i, u, h, "x", 1, "y") for i, (u, h) in enumerate(zip(urls, html, strict=True))] + [(0, urls[0], "", "x", 1, "y")] * 50
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, row long, verdict string")
    got = Counter(tuple(r) for r in url_filter.judge(df).select("page_id", "host", "path", "rule", "verdict").collect())

    counts = Counter(w for r in rows for w in re.findall("[a-z]+", re.sub("<[^>]*>", " ", r[2]).lower()))
    total = sum(counts.values()) + 1
    split = functools.lru_cache(None)(lambda name: best_split(name, counts, total))

    def parts(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        return (m[1].lower(), m[2]) if m else ("", "")

    def rule(host, path):
        fits = [(len(t), t, v) for t, v in url_filter.RULES
                if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/"):])]
        return max(fits)[1:] if fits else (None, None)

    def features(host, path):
        out = []
        for place, text in (("h:", host), ("p:", path.lower())):
            for t in re.findall("[a-z]+|[0-9]+", text):
                out += [f"{place}#{len(t)}", f"{place}#{t[0]}x{len(t)}"] if t.isdigit() else [place + w for w in split(t)]
        return out

    judged = [(r[0], *parts(r[1]), *rule(*parts(r[1]))) for r in rows]
    taught = [(features(h, p), v) for _, h, p, _, v in judged if v]
    tokens = {v: Counter(t for f, w in taught if w == v for t in f) for v in ("allow", "block")}
    n = Counter(v for _, v in taught)
    vocab = set(tokens["allow"]) | set(tokens["block"])
    size = {v: sum(tokens[v].values()) + len(vocab) for v in tokens}
    want = Counter()
    for i, h, p, name, verdict in judged:
        score = math.log((n["block"] + 1) / (n["allow"] + 1)) + math.fsum(
            math.log((tokens["block"][t] + 1) / size["block"]) - math.log((tokens["allow"][t] + 1) / size["allow"]) for t in features(h, p) if t in vocab
        )
        want[i, h, p, name, verdict or ("block" if score > 0 else "allow")] += 1
    assert got == want and len({k[4] for k in got if k[3] is None}) == 2
    assert all(split(x) == list(url_filter.Segmenter(counts).split(x)) for x in ("newsshop", "goinacat", "xnewsx", "ofgolfofthe"))


def test_long_urls_and_hot_urls(spark):
    letters = "".join(chr(97 + i * i % 26) for i in range(4000))
    rows = [(i, f"http://a{letters[i:] + letters[:i]}.com/x", "news shop") for i in range(300)]
    rows += [(1000, "http://b.net/" + letters * 20, "the news"), (1001, "http://c.com/de/news", "news"), (1002, "http://c.org/shop", "shop")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert url_filter.judge(df).count() == len(rows)
    pieces = set().union(*url_filter.substrings(letters[:70]))
    assert pieces == {letters[a:b] for a in range(70) for b in range(a + 4, min(70, a + 24) + 1)}


# ------------------------------------------------------------- html
def shown(e):
    return "".join(x if isinstance(x, str) else shown(x) for x in e.items)


@pytest.mark.parametrize(("source", "text"), [
    ("<p title=don't>Eins zwei</p><p>it's drei</p>", "Eins zweiit's drei"), ("a < b <i>c</i> <", "a < b c <"),
    ("&am<b>p;</b>T &amp;lt; &lt;x", "&amp;T &lt; <x"), ("<a href='x>y'>z</a>", "z"), ("x<!-- c > d -->y<!d>z<?q?>w", "xyzw"),
    ("<script>a<b</script>c<SCRIPT>d</script >e", "ce"), ("<p =x a = 'b' c>t</p>", "t"), ("one <p title='never closed", "one <p title='never closed"),
    ("<i", "<i"), ("</", "</"), ("a<!-- open <p>x", "a"), ("<img src=a.png/>q", "q"),
])
def test_odd_markup(source, text):
    assert shown(html_tree.parse(source)) == text


@pytest.mark.parametrize("unit", ["<a ", "<p title='x ", "<", "<a b='c", "<div>", "<!", "<p>", "<script>", "</a", "<b></x>", "<li><ul><b>", "<p><b><hr>", "<script>x</style>"])
def test_a_megabyte_of_odd_markup_is_read_in_linear_time(unit):
    source = unit * (1_000_000 // len(unit))
    began = time.process_time()
    html_tree.parse(source)
    assert time.process_time() - began < 6


def test_attribute_tokens_and_split_references(spark):
    e, = html_tree.parse("<div class=\"Menu bar\" id=nav data-x='class' role = banner>t</div>").elements()
    assert e.tokens == {"menu", "bar", "nav", "banner"}
    page = "<html><body><article><p>One sentence, here it's.</p><p title=don't>Fish &amp; chips &am<b>p;</b> more text.</p></article></body></html>"
    rows = [(i, "u", page, 1, "z") for i in range(3)] + [(9, None, None, 1, "z"), (9, None, "", 1, "z"), (None, "u", "<a " * 10_000, 1, "z")]
    got = main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")).collect()
    assert len(got) == 6 and {r["text"] for r in got if r["page_id"] == 9} == {""}
    assert {r["text"] for r in got if r["page_id"] in (0, 1, 2)} == {"One sentence, here it's. Fish & chips &amp; more text."}


# ------------------------------------------------------------- near duplicates
def near_expected(texts, size, percent=80):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and sets[b]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(len(texts))]


def edited(rng, words, edits):
    out = list(words)
    for at in rng.choice(len(out), size=edits, replace=False):
        out[at] = f"x{rng.integers(0, 10**9)}"
    return out


def test_near_duplicates_of_one_text_with_far_copies_and_common_edits(spark):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    common = edited(rng, words, 9)  # an edit that many copies share
    texts = [" ".join(words)]
    texts += [" ".join(edited(rng, words, int(rng.integers(1, 4)))) for _ in range(120)]
    texts += [" ".join(edited(rng, words, int(rng.integers(4, 14)))) for _ in range(90)]  # mostly below 0.8
    texts += [" ".join(edited(rng, common, int(rng.integers(0, 4)))) for _ in range(60)]
    texts += [" ".join(words[: len(words) - int(k)]) for k in rng.integers(5, 70, 60)]  # chains of ever shorter copies
    texts += [" ".join(words[int(k) :] + [f"end{i}" for i in range(int(k) // 3)]) for k in rng.integers(5, 60, 40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for size in (4, 5):
        got = {r["doc_id"]: r["component_id"] for r in near_dup.groups(spark.createDataFrame(rows, "doc_id long, text string"), size).collect()}
        assert [got[i] for i in range(len(texts))] == near_expected(texts, size)
    assert len(set(near_expected(texts, 4))) > 20


def test_far_copies_with_edits_of_their_own_meet_no_other(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(200)]
    made = []
    real = near_dup._cross_pairs

    def counted(told, percent):
        out = real(told, percent)
        made.append((told.count(), out.count()))
        return out

    monkeypatch.setattr(near_dup, "_cross_pairs", counted)
    for n in (200, 400):
        texts = [" ".join(words)] + [" ".join(edited(rng, words, 3 if i % 3 else 11)) for i in range(n)]
        near_dup.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4).count()
    assert all(pairs <= nodes for nodes, pairs in made), made


# ------------------------------------------------------------- warc
def test_one_damaged_byte_loses_one_record(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"page {i} " + "é<p>" * (i % 90)) for i in range(1200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.plan_records(df), str(tmp_path / "w"))
    files = sorted(f for f in (tmp_path / "w").rglob("part-*") if f.stat().st_size)
    assert len(files) >= 3
    data = files[0].read_bytes()
    whole = [r for r in warc.salvage(data) if r[2] is None]
    assert len(whole) > 300 and gzip.decompress(data).count(b"WARC/1.1") == len(whole)
    for at in (len(data) // 10, len(data) // 2, 40):
        bad = data[:at] + bytes([data[at] ^ 0x5A]) + data[at + 1 :]
        found = list(warc.salvage(bad))
        kept = [r for r in found if r[2] is None]
        assert len(kept) >= len(whole) - 2 and any(r[2] is not None for r in found) or len(kept) == len(whole)
        assert {r[4] for r in kept} <= {r[4] for r in whole}
    got = warc.described(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    assert sorted(r["page_id"] for r in got) == list(range(1200))


def test_large_records_get_files_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LARGE_BYTES", 1000)
    rows = [(i, "u", "z" * (2000 if i < 3 else 10) + str(i), 1) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes int").coalesce(1)
    for compression in ("gzip", "none"):
        path = tmp_path / compression
        warc.write_archives(warc.plan_records(df), str(path), compression)
        assert len([f for f in (path / "large").glob("part-*") if f.stat().st_size]) == 3
        assert warc.described(warc.read_archives(spark, str(path))).count() == 20
