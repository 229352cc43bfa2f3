"""Operators of shelfwise.llm against brute force, on hand-made edge cases and the small tables."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import public_tokenizers as tokens
import pytest

from shelfwise.llm import (
    bpe, bwt, components, html_tree, main_text, near_dup, neighbours, packing, quality_rules, suffix_dedup,
    token_counts, url_filter, warc,
)

RANKS = tokens.path("byte_bpe_50k.tiktoken")
JSON = tokens.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, spans string"
LONG = " ".join(f"w{i * 7919 % 4001}" for i in range(9000))
PASSAGE = "The quick brown fox jumps over the lazy dog again and again, ééé öö. " * 5
ROWS = [
    (1, None, None, None, None, 5, "x"),
    (2, "", "en", "a", 0, 5, None),
    (3, " \n\t ", "en", "a", 4, 5, None),
    (4, PASSAGE + "one ending", "en", "a", 1, 5, None),
    (5, "other start " + PASSAGE, "en", "a", 1, 5, None),
    (6, LONG, "en", "a", 1, 5, None),
    (6, LONG, "en", "a", 1, 5, None),
    (None, LONG + " more", "en", "a", 1, 5, None),
    (8, "a" * 700, "en", "a", 1, 5, None),
    (9, "short text it's 12 don't  \u00a0 x <|endoftext|>", "en", "a", 1, 5, None),
    (10, "\U0001f600 \u0558\u1234  z\n\n q", "en", "a", 1, 5, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return [(r[0], r[1] or "") for r in ROWS]


def test_encoding_equals_both_libraries_and_decodes(docs):
    enc, library = bpe.encoder(RANKS), packing.library_encoder(JSON, RANKS)
    for t in [t for _, t in texts()] + ["aaaaaaaaaaab" * 30, "\x85 \x1c\u2028x", "ﬁ Ⅷ½ \u0301a"]:
        ids = enc.encode(t)
        assert ids == library.fast.encode_ordinary(t) == library.exact.encode(t, add_special_tokens=False).ids
    rows = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
    assert sorted(bytes(r["data"]) for r in rows) == sorted(t.encode() for _, t in texts())


def test_code_points_split_alike_in_all_libraries():
    library = packing.library_encoder(JSON, RANKS)
    for c in range(1, 0x3000, 3):
        t = f"a{chr(c)}1 {chr(c)}{chr(c)}b  {chr(c)}'s.{chr(c)}"
        ids = library.fast.encode_ordinary(t)
        assert bpe.encoder(RANKS).encode(t) == ids == library.exact.encode(t, add_special_tokens=False).ids


def test_digest_rows(docs, empty):
    rows = bpe.digests(docs, RANKS).collect()
    assert len(rows) == len(ROWS)
    got = Counter((r["doc_id"], r["decoded_sha256"]) for r in rows)
    assert got == Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in texts())
    assert bpe.digests(empty, RANKS).count() == 0


def test_url_parts_rules_and_segments(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/es/1?x#y", "http://x.com/de/?q", "http://xcom/fr/", "a://b.org",
            "a://example.org/en/12", "a://shop.net/en/5"]
    pages = spark.createDataFrame([(i, u, "<p>shop the news</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    assert (got[3]["host"], got[3]["path"], got[3]["rule"], got[3]["verdict"]) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert [got[i]["rule"] for i in (0, 1, 2, 4, 5, 6, 7, 8)] == [None, None, None, "com/de/", None, None, "example.org/en/1", None]
    assert all(got[i]["host"] == got[i]["path"] == "" for i in (0, 1, 2))
    assert {r["verdict"] for r in got.values()} <= {"allow", "block"}
    s = url_filter.Segmenter({"the": 50, "news": 20, "shop": 10, "then": 5})
    assert s.split("thenewsshop") == ("the", "news", "shop")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_rare_words_of_a_large_vocabulary_split_urls(spark):
    rare = ["z" + "".join(x) for x in product("bcdfghjklm", repeat=5)][:60_000]
    html = [" ".join(rare[a : a + 1000]) + " news shop" * 90 for a in range(0, len(rare), 1000)] + ["newsqqqqshop"]
    urls = ["http://a.com/de/newsqqqqshop", "http://x.net/news", "http://x.net/newsqqqqshop", "http://x.net/", "http://b.org/"]
    rows = [(i, urls[i] if i < len(urls) else None, h) for i, h in enumerate(html)]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert got[1]["score"] == got[3]["score"] < got[2]["score"]


def pages_of(spark):
    return spark.createDataFrame(
        [(1, "http://a", "x"), (2, "http://b\r\nX: y", "x"), (3, None, "x"), (4, "u", None), (5, "u", "é WARC/1.1\r\n\r\n"), (5, "u", "twin"), (5, "u", "twin")],
        "page_id long, url string, html string",
    )


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_round_trip(spark, tmp_path, compression):
    path = str(tmp_path / "w")
    warc.write_archives(warc.plan_records(pages_of(spark)), path, compression)
    got = [tuple(r) for r in warc.described(warc.read_archives(spark, path)).collect()]
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    e = "é WARC/1.1\r\n\r\n"
    assert Counter(got) == Counter(
        [(1, 1, sha("x"), "revisit", 3), (2, 1, sha("x"), "revisit", 3), (3, 1, sha("x"), "response", None),
         (4, 0, sha(""), "response", None), (5, len(e.encode()), sha(e), "response", None),
         (5, 4, sha("twin"), "response", None), (5, 4, sha("twin"), "response", None)]
    )
    assert Counter(r[3] for r in got) == {"response": 5, "revisit": 2}
    warc.write_archives(warc.plan_records(pages_of(spark).limit(0)), str(tmp_path / "e"), compression)
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


def archive(n=4):
    one = lambda i: (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\n"  # noqa: E731
                     f"Content-Length: {100 + i}\r\n\r\n" + "p" * (100 + i) + "\r\n\r\n").encode()  # fmt: skip
    return [one(i) for i in range(n)]


def test_salvage_recovers_later_records():
    parts = archive()
    whole = b"".join(parts)
    assert [r[2] for r in warc.salvage(whole)] == [None] * 4
    bad = parts[0] + parts[1].replace(b"Content-Length: 101", b"Content-Length: 999") + parts[2] + parts[3]
    rows = list(warc.salvage(bad))
    assert [r[2] for r in rows] == [None, "length", None, None]
    assert rows[1][:2] == (len(parts[0]), len(parts[0]) + len(parts[1]))
    torn = parts[0] + parts[1][:40] + b"noise" + parts[2] + parts[3][:-30]
    assert [r[2] is None for r in warc.salvage(torn)].count(True) == 2
    members = [gzip.compress(p) for p in parts]
    broken = bytearray(members[1])
    broken[30:40] = b"\0" * 10
    rows = list(warc.salvage(members[0] + bytes(broken) + members[2] + members[3]))
    assert [len(r[4]) for r in rows if r[2] is None] == [100, 102, 103] and any(r[2] == "member" for r in rows)
    assert list(warc.salvage(b"")) == []


def brute_repeats(datas, length):
    count = Counter(d[i : i + length] for d in datas for i in range(len(d) - length + 1))
    out = []
    for d in datas:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                hit[i : i + length] = True
        runs = int((np.diff(np.r_[0, hit.astype(int)]) == 1).sum())
        out.append((len(d), int(hit.sum()), runs, np.frombuffer(d, np.uint8)[~hit].tobytes()))
    return out


@pytest.mark.parametrize("anchor_runs", [4096, 0])
def test_suffix_dedup_against_brute_force(docs, anchor_runs):
    spans = suffix_dedup.repeated_spans(docs, anchor_runs=anchor_runs, shard_bytes=2000, bucket_bytes=20_000)
    rows = suffix_dedup.cut_repeats(docs, spans, {"doc_id": "doc_id"}).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows)
    want = brute_repeats([t.encode() for _, t in texts()], 200)
    assert got == Counter((i, *w) for (i, _), w in zip(texts(), want, strict=True))


def test_suffix_dedup_stage_keeps_rows_and_columns(docs, empty):
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_stage_keeps_replacement_characters(spark):
    shared = "\u00a9" + "shared passage " * 20 + "\u00e9"  # c2 a9 ... c3 a9
    rows = [(1, "a\ufffdb \u00e9" + shared[1:] + " end\ufffd"), (2, "c\ufffd \u00e9" + shared[1:-1] + "\u00c9 \ufffdz")]
    got = {r["doc_id"]: r["text"] for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].count("\ufffd") for i in (1, 2)] == [2, 2]
    assert "shared" not in got[1] + got[2]
    data = "x\u00e9y\u00e9z".encode()
    assert suffix_dedup._without(data, suffix_dedup._whole_characters(data, [{"a": 2, "b": 5}]))[0] == b"xz"


def test_merged_classes_against_brute_force():
    import random

    rnd = random.Random(3)
    for _ in range(25):
        depth = rnd.choice([1, 3, 4, 7, 12, 33])
        base = bytes(rnd.choice(b"ab\x00\xff") for _ in range(90))
        strings = [base[a : a + depth + rnd.randint(0, 30)].ljust(depth, b"q") for a in (rnd.randint(0, 60) for _ in range(12))]
        wanted = [rnd.randint(1, len(s) - depth + 1) for s in strings]
        weight = [rnd.choice([1, 1, 2]) for _ in strings]
        count = Counter()
        for s, w, n in zip(strings, weight, wanted, strict=True):
            for k in range(n):
                count[s[k : k + depth]] += w
        got = bwt.repeated_starts(strings, weight, wanted, depth, rnd.choice([1, 60, 10_000]))
        assert [list(g) for g in got] == [[count[s[k : k + depth]] > 1 for k in range(n)] for s, n in zip(strings, wanted, strict=True)]


PAGE = """<html><head><title>t</title><script>var x='<p>no</p>'</script></head><body><div class="menu"><a href=/>Home</a></div>
<article><h1>A &amp; B</h1><p>First  <b>bold text,<br>line.<p>Second&nbsp;para.</article><footer>foot</footer></body>"""


def test_main_text(spark):
    rows = [(i, None, PAGE.replace("First", f"First {i}")) for i in range(30)] + [(40, "u", None), (40, "u", ""), (41, "u", "<p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in main_text.extract(pages).collect()}
    assert got[3]["text"] == "A & B First 3 bold text, line. Second para."
    assert got[40]["text"] == "" and got[3]["n_chars"] == len(got[3]["text"])
    assert main_text.extract(pages.limit(0)).count() == 0
    found = main_text.nodes(html_tree.parse(PAGE))
    log_p = np.log(np.random.default_rng(0).dirichlet([1, 1, 1], len(found)))
    states = main_text.decode(found, log_p)
    for n, s in zip(found[1:], states[1:], strict=True):
        up = states[n.parent]
        assert not (up == main_text.DROP and s != main_text.DROP) and not (up == main_text.MAIN and s == main_text.WRAP)


def test_main_text_learns_from_rare_and_nested_marks(spark, monkeypatch):
    monkeypatch.setattr(main_text, "LOOK_PAGES", 8)
    bare = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    nested = PAGE.replace("<article>", "<MAIN id=m><article>").replace("</article>", "</article></MAIN>")
    two = PAGE.replace("</article>", "</article><article>x</article>")
    rows = [(i, None, bare.replace("First", f"First {i}")) for i in range(400)]
    rows += [(1000 + i, None, two.replace("First", f"First {i}")) for i in range(400)]
    rows += [(2000 + i, None, nested) for i in (1, 2, 3)] + [(2003, None, nested), (3000, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert main_text.labelled(pages, 2) == [nested] * 2
    assert main_text.labelled(pages, 300) == [nested] * 3
    assert main_text.labelled(pages.where("page_id < 2000"), 2) == []
    assert main_text.fit(pages, 2) is not None


def test_main_text_on_held_out_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    trees = main_text.fit(pages, sample=60)
    for r in pages.orderBy("page_id").limit(80).collect():
        found = main_text.nodes(html_tree.parse(r["html"]))
        text = main_text.text_of(found, main_text.decode(found, trees.log_probability(main_text.features(found))))
        inside = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        assert text == " ".join(html_tree.clean(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inside))).split())


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 16)) * rng.uniform(0.5, 2, (400, 1))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows[7] = (7, rows[6][1])
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0]), (None, rows[0][1])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = neighbours.search(table, table.where("vec_id % 20 = 0"), 20).collect()
    v = np.array([r[1] for r in rows])
    hit = 0
    for q in range(0, 400, 20):
        s = v @ v[q]
        s[q] = -np.inf
        near = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in near] == list(range(1, 21))
        assert near == sorted(near, key=lambda r: (-r["score"], r["vec_id"]))
        assert np.allclose([r["score"] for r in near], s[[r["vec_id"] for r in near]])
        hit += len({r["vec_id"] for r in near} & set(np.argsort(-s)[:20]))
    assert hit >= 0.9 * 20 * 20
    assert neighbours.search(table.limit(0), table.limit(0)).count() == 0


def norms_of(kind, n, rng):
    return {"mixed": np.exp(rng.normal(size=n)), "outlier": np.where(np.arange(n) == 1, 100.0, 1.0), "unit": np.ones(n)}[kind]


@pytest.mark.parametrize("kind", ["mixed", "outlier", "unit"])
@pytest.mark.parametrize("n", [15, 300, 6000])
def test_neighbours_are_whole_at_any_norms(kind, n):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 64))
    x *= (norms_of(kind, n, rng) / np.linalg.norm(x, axis=1))[:, None]
    asked = np.arange(min(n, 100))
    hit = want = 0
    for q, (near, score) in zip(asked, neighbours.BlockIndex(np.arange(n), x).search(asked, x[asked], 20), strict=True):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.argsort(-s)[: min(20, n - 1)]
        assert len(set(near)) == len(best) and q not in near
        assert np.allclose(score, s[near])
        hit, want = hit + len(set(near) & set(best)), want + len(best)
    assert hit >= 0.9 * want, hit / want


def test_neighbours_take_queries_a_batch_at_a_time():
    x = np.random.default_rng(4).normal(size=(900, 8))
    pulled = []

    def batches():
        for asks, at in [(False, 0), (False, 450)] + [(True, a) for a in range(0, 900, 100)]:
            ids = np.arange(at, at + (100 if asks else 450))
            pulled.append(asks)
            yield pa.RecordBatch.from_pydict({"asks": [asks] * len(ids), "vec_id": ids, "v": list(x[ids])})

    got = Counter()
    for part in neighbours.near_rows(batches(), 5):
        got.update(part.column("query_id").to_pylist())
        assert len(got) > 100 * (sum(pulled) - 1)  # earlier queries are answered before the next come
    assert got == Counter({i: 5 for i in range(900)})
    with pytest.raises(RuntimeError):
        list(neighbours.near_rows(reversed(list(batches())), 5))


def brute_groups(rows, size):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()

    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            up[find(a)] = find(b)
    members = {}
    for i, r in enumerate(rows):
        members.setdefault(find(i), []).append(r[0])
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return Counter((r[0], len(sets[i]), smallest[find(i)]) for i, r in enumerate(rows))


def copies():
    rnd = np.random.default_rng(5)
    base = [f"word{i}" for i in range(120)]
    out = []
    for i in range(60):
        w = list(base)
        for j in rnd.integers(0, 120, rnd.integers(0, 9)):
            w[j] = f"new{i}x{j}"
        out.append((100 + i, " ".join(w[: 120 - rnd.integers(0, 30)]), None, None, None, 1, None))
    return out


def test_near_duplicates_against_brute_force(spark, docs, empty):
    rows = ROWS + copies()
    many = spark.createDataFrame(rows, SCHEMA)
    got = near_dup.groups(many, 4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_groups(rows, 4)
    assert near_dup.groups(empty, 4).count() == 0


def test_keep_one_leaves_one_row_a_group(spark, empty):
    rows = ROWS + copies()
    out = near_dup.keep_one(spark.createDataFrame(rows, SCHEMA), 5)
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    kept = out.collect()
    groups = brute_groups(rows, 5)
    no_words = 3
    assert len(kept) == len({g for _, n, g in groups if n}) + no_words
    assert [r["doc_id"] for r in kept if r["text"] and r["text"].startswith("w0 ")] == [6]
    assert near_dup.keep_one(empty).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}


def test_token_counts_against_viterbi(docs, empty):
    scores = token_counts.unigram_scores(bpe.read_ranks(RANKS))

    def count(piece):
        best = [(0.0, 0)]
        for end in range(1, len(piece) + 1):
            best.append(max((best[s][0] + scores[piece[s:end]], best[s][1] - 1) for s in range(max(0, end - 128), end) if piece[s:end] in scores))
        return -best[-1][1]

    from shelfwise.llm.pretokens import pretokens

    want = Counter((i, sum(count(w.encode()) for w in pretokens(t)), len(t)) for i, t in texts())
    assert Counter(map(tuple, token_counts.count_tokens(docs, RANKS).collect())) == want
    assert token_counts.count_tokens(empty, RANKS).count() == 0


def test_packing_is_gapless_and_restores_all_ids(docs, empty):
    rows = packing.pack(docs, JSON, RANKS, length=64).collect()
    by_place = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    at = 0
    for r in by_place:
        assert r["sequence_id"] * 64 + r["offset"] == at and r["length"] <= 64 - r["offset"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["length"]
    encode = packing.library_encoder(JSON, RANKS).exact.encode
    stream, docs_ = [], []
    for r in by_place:
        if r["start"] == 0:
            docs_.append((r["doc_id"], []))
        docs_[-1][1].extend(r["ids"])
    assert Counter((i, tuple(x)) for i, x in docs_) == Counter((i, (*encode(t, add_special_tokens=False).ids, 0)) for i, t in texts())
    last = by_place[-1]
    assert last["filled"] == at - last["sequence_id"] * 64
    assert packing.pack(empty, JSON, RANKS).count() == 0


def brute_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, places = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            places |= set(range(i, i + 5))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(places)


def test_quality_counts_and_learned_list(spark, docs, empty):
    extra = [(20, "a b c d e f a b c d e g\nx y\nx y\n \n#$ <>", "en", "s", 1, 1, None), (21, "a a a a a a a a a a a a", "en", "s", 1, 1, None)]
    table = docs.unionByName(spark.createDataFrame(extra, SCHEMA))
    rows = quality_rules.judge(table, []).collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows)
    assert got == Counter((i, *brute_counts(t)) for i, t in texts() + [(r[0], r[1]) for r in extra])
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])
    assert quality_rules.judge(empty, []).count() == 0


def test_learning(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 1, (600, len(quality_rules.FEATURES)))
    bad = (x[:, 1] > 0.7) & (x[:, 3] <= 0.5)
    rules = quality_rules.learn(x, bad)
    hit = np.any([r.mask(x) for r in rules], axis=0)
    assert (hit == bad).mean() > 0.97
    assert quality_rules.learn(x, np.zeros(600, bool)) == [] and quality_rules.learn(x, np.ones(600, bool)) == []
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    assert quality_rules.fit(spark.createDataFrame([], SCHEMA), labels) == []


def test_pipeline_stages(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "packing"]
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.agg({"length": "sum"}).first()[0] > 0
