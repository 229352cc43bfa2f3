"""MinHash near-duplicates by an inverted join over signature coordinates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import broadcast_if_small, drop_work_table, map_slices, salted_lookup, skewed_lookup, table, work_table
from shelfwise.llm.components import components

#: Coordinates of a signature, and how many must agree. A pair at similarity 0.8 has 51 agreeing
#: coordinates on average with deviation 3.2, so 35 lie five deviations below.
COORDINATES = 64
MATCHES = 35
#: Two signatures with MATCHES agreeing coordinates share one of any ordering's first PREFIX.
PREFIX = COORDINATES - MATCHES + 1
#: Counters of the frequency table that orders coordinates; each is one long.
COUNTERS = 1 << 18
SALTS = 16
#: Longs of a bitmap of difference elements.
BITMAP = 16
#: Classes from which a group's elements are counted, to tell which a class has alone.
LARGE_GROUP = 64
_MEMO_WORDS = 500_000

_rng = np.random.default_rng(20240607)
_FACTORS = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_PLACES = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles: words are what lies between ASCII white
    space, A-Z lower-cased; a text with fewer words than ``size`` is one shingle, one without words none.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(size, len(words))
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += h[j : j + n] * _PLACES[j]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 4096):
        np.minimum(low, (hashes[at : at + 4096, None] * _FACTORS + _SHIFTS).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def text_key(text: str = "text") -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def described(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_id, signature) of each row; set_id is null without words."""
    rows = docs.select("doc_id", text_key().alias("text_key"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(cols: dict[str, list]) -> dict[str, list]:
        sets = [shingle_hashes(t, size) for t in cols["text"]]
        return {
            "doc_id": cols["doc_id"],
            "text_key": cols["text_key"],
            "n_shingles": [len(s) for s in sets],
            "set_id": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "signature": [signature(s).tobytes() if len(s) else None for s in sets],
        }

    return map_slices(
        rows, run, f"doc_id {kind}, text_key string, n_shingles long, set_id binary, signature binary"
    )


def _frequency(classes: DataFrame) -> np.ndarray:
    """How often coordinate-value pairs fall into each of COUNTERS cells, over all classes."""

    def cells(cols: dict[str, list]) -> dict[str, list]:
        seen = np.concatenate([_cells(np.frombuffer(s, "<u4")) for s in cols["signature"]])
        cell, n = np.unique(seen, return_counts=True)
        return {"cell": cell, "n": n}

    found = map_slices(classes.select("signature"), cells, "cell int, n long", rows=5000)
    counts = np.zeros(COUNTERS, np.int64)
    for r in found.groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["cell"]] = r["n"]
    return counts


def _elements(sig: np.ndarray) -> np.ndarray:
    """One 64-bit number for each coordinate-value pair."""
    return np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32) | sig.astype(np.uint64)


def _cells(sig: np.ndarray) -> np.ndarray:
    return (_mixed(_elements(sig)) % np.uint64(COUNTERS)).astype(np.int32)


def possible(classes: DataFrame) -> DataFrame:
    """The classes of which at least MATCHES coordinate-value pairs occur in another class too.

    Only they can agree with another class in so many; counted over all classes, none is lost.
    Counts go by a short key of the class; the rare classes that share a short key all stay.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        elements = [_elements(np.frombuffer(s, "<u4")).view(np.int64) for s in cols["signature"]]
        return {"element": np.concatenate(elements), "short": np.repeat(cols["short"], COORDINATES)}

    keyed = classes.withColumn("short", F.xxhash64("set_id"))
    each = map_slices(keyed.select("short", "signature"), run, "element long, short long", rows=1024)
    own = each.groupBy("element").agg(F.count("*").alias("k"), F.min("short").alias("short")).where("k = 1")
    own = own.groupBy("short").agg(F.count("*").alias("own")).where(F.col("own") > COORDINATES - MATCHES)
    known = keyed.groupBy("short").agg(F.count("*").alias("k")).where("k = 1")
    return keyed.join(own.join(known, "short"), "short", "left_anti").drop("short")


def postings(classes: DataFrame) -> DataFrame:
    """(element, set_id, weight): each class under the PREFIX rarest of its coordinate-value pairs.

    All classes order the pairs alike, by the frequency table, so common values are posted only by
    classes that have little else, and no pair of classes with MATCHES agreements is lost. ``weight``
    sums how common all of a class's values are: among near copies the text they come from has most.
    """
    counts = classes.sparkSession.sparkContext.broadcast(_frequency(classes))

    def run(cols: dict[str, list]) -> dict[str, list]:
        elements, sets, weights = [], [], []
        for set_id, sig in zip(cols["set_id"], cols["signature"], strict=True):
            values = np.frombuffer(sig, "<u4")
            e = _elements(values)
            common = counts.value[_cells(values)]
            rare = np.lexsort((_mixed(e), common))[:PREFIX]
            elements.append(e[rare].view(np.int64))
            sets += [set_id] * PREFIX
            weights += [int(1000 * np.log2(1 + common).sum())] * PREFIX
        return {"element": np.concatenate(elements), "set_id": sets, "weight": weights}

    return map_slices(classes.select("set_id", "signature"), run, "element long, set_id binary, weight long")


def _star_pairs(posted: DataFrame) -> DataFrame:
    """Each class with the class of most weight on every list it is on."""
    lists = posted.groupBy("element").agg(F.max(F.struct("weight", "set_id")).alias("o"), F.count("*").alias("__n"))
    lists = lists.where("__n > 1").select("element", F.col("o.set_id").alias("a"))
    met = salted_lookup(posted, lists, "element", SALTS, F.xxhash64("set_id")).where("a != set_id")
    return met.select("a", F.col("set_id").alias("b")).distinct()


def _split_groups(posted: DataFrame, roots: DataFrame) -> DataFrame:
    """(main, node, root, weight): classes on lists that the first round left in several components.

    ``main`` is the largest component of such a list; lists of one group of copies mostly agree in
    it, so a class stands here a few times, not once for each of its lists.
    """
    shared = posted.groupBy("element").agg(F.count("*").alias("__n")).where("__n > 2").drop("__n")
    rows = posted.select("element", F.col("set_id").alias("node"), "weight").join(shared, "element", "left_semi")
    rooted = rows.join(roots, "node", "left").select("element", "node", F.coalesce("root", "node").alias("root"), "weight")
    rooted = work_table(rooted)
    sizes = rooted.groupBy("element", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("element").agg(F.count("*").alias("roots"), F.max(F.struct("n", "root"))["root"].alias("main"))
    main = main.where("roots > 1").drop("roots")
    met = salted_lookup(rooted, main, "element", SALTS, F.xxhash64("node")).where("main is not null")
    split = work_table(met.select("main", "node", "root", "weight").distinct())
    drop_work_table(rooted)
    return split


def _differences(split: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(main, node, root, n, size, bits, s, u): how each class differs from its group's representative R.

    R is the group's main-component class of most weight. With d(x) the symmetric difference of x and R, x
    and y differ in |d(x)| + |d(y)| - 2 |d(x) & d(y)| shingles, and are linked if that is at most
    (100 - percent) / (100 + percent) of the sum of their sizes. So with s(x) = (100 + percent) |d(x)| -
    (100 - percent) n(x) they are linked exactly if s(x) + s(y) <= 2 (100 + percent) |d(x) & d(y)|. Of d(x)
    only what other classes of the group have in theirs can be common: u(x) is the largest s that a
    partner of x can have. ``size`` is |d(x)|; ``bits`` has a bit for each element's hash, so a bit that only one
    of two classes has stands for an element at least that they do not share.
    """
    reps = split.where("root = main").groupBy("main").agg(F.max(F.struct("weight", "node"))["node"].alias("rep"))
    values = sets.select(F.col("set_id").alias("rep"), F.col("value").alias("center"))
    centers = reps.join(values, "rep").select("main", "center")
    mine = sets.select(F.col("set_id").alias("node"), "value", F.col("n_shingles").alias("n"))
    # classes of a large group are dealt over tasks before their sets are joined
    large = split.groupBy("main").agg(F.count("*").alias("__n")).where(f"__n > {LARGE_GROUP}").select("main", F.lit(True).alias("large"))
    placed = salted_lookup(split.select("main", "node", "root"), large, "main", SALTS, F.xxhash64("node"))
    spot = F.when(F.col("large"), F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).otherwise(0)
    spots = F.when(F.col("large"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    centers = centers.join(large, "main", "left").select("main", "center", F.explode(spots).alias("spot"))

    def differ(cols: dict[str, list]) -> dict[str, list]:
        pairs = zip(cols["value"], cols["center"], strict=True)
        d = [np.setxor1d(np.frombuffer(v, "<i8"), np.frombuffer(c, "<i8"), assume_unique=True) for v, c in pairs]
        bits = np.zeros((len(d), BITMAP), np.uint64)
        for row, x in zip(bits, d, strict=True):
            np.bitwise_or.at(row, (x >> 6) % BITMAP, np.uint64(1) << (x & 63).astype(np.uint64))
        out = {c: cols[c] for c in ("main", "node", "root", "n", "large")} | {"size": [len(x) for x in d]}
        return out | {"d": [x if big else [] for x, big in zip(d, cols["large"], strict=True)], "bits": bits.view(np.int64).tolist()}

    met = placed.withColumn("spot", spot).join(mine, "node").join(centers, ["main", "spot"])
    schema = "main binary, node binary, root binary, n long, large boolean, size long, d array<long>, bits array<long>"
    met = met.select("main", "node", "root", "n", "large", "value", "center")
    apart = work_table(map_slices(met, differ, schema, rows=64))
    # in a small group all of d(x) may count as common
    each = apart.where("large").select("main", "node", F.explode("d").alias("h"))
    own = each.groupBy("main", "h").agg(F.count("*").alias("k"), F.min("node").alias("node")).where("k = 1")
    own = own.groupBy("main", "node").agg(F.count("*").alias("own"))
    whole, part = 100 + percent, 100 - percent
    told = apart.drop("d", "large").join(own, ["main", "node"], "left")
    told = told.withColumn("s", whole * F.col("size") - part * F.col("n"))
    told = work_table(told.withColumn("u", 2 * whole * (F.col("size") - F.coalesce("own", F.lit(0))) - F.col("s")).drop("own"))
    drop_work_table(apart)
    return told


def _cross_pairs(told: DataFrame, percent: int) -> DataFrame:
    """Pairs around one main component that the first round left apart and that can be linked (see ``_differences``).

    The class of least s is linked with every class whose s it outweighs, and so is any pair that are linked
    by their s alone: one pair for each of them. In any other pair one class is far, that is not linked so,
    and each must be able to have the other's s. Far copies whose
    edits are their own can have no partner's, so they are compared with nothing, however many they
    are. What is left meets by size bins within one group, and stays a pair only if enough elements can be
    common by the bitmaps.
    """

    def bin_(n: Column) -> Column:
        return F.floor(F.log(F.greatest(n, F.lit(1))) / float(np.log(1.01))).cast("int")

    least = F.min(F.struct("s", "node", "root")).alias("m")
    whole = told.groupBy("main").agg(least, F.max("u").alias("max_u"))
    told = salted_lookup(told, whole, "main", SALTS, F.xxhash64("node")).withColumn("far", F.col("s") + F.col("m.s") > 0)
    stars = told.where("not far and root != m.root").select("node", F.col("m.node").alias("x"))
    far = told.where("far").groupBy("main").agg(F.min("s").alias("far_s"), F.max("u").alias("far_u"))
    # a far class needs any partner, any other class a far one
    able = salted_lookup(told, far, "main", SALTS, F.xxhash64("node")).where(
        "if(far, s <= max_u and u >= m.s, s <= far_u and u >= far_s)"
    )
    rows = work_table(able.select("main", "node", "root", "n", "size", "bits", "far", "s", "u", bin_(F.col("n")).alias("bin")))
    lo, hi = F.ceil(F.col("n") * percent / 100), F.floor(F.col("n") * 100 / percent)
    strays = rows.where("root != main").select(
        "main", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"), F.col("far").alias("fx"),
        F.col("s").alias("sx"), F.col("u").alias("ux"), F.col("size").alias("sizex"), F.col("bits").alias("bitsx"), F.explode(F.sequence(bin_(lo), bin_(hi))).alias("bin"),
    )
    possible = strays.join(rows.select("main", "bin").distinct(), ["main", "bin"], "left_semi")
    apart, apartx = (
        " + ".join(f"bit_count({a}[{i}] & ~{b}[{i}])" for i in range(BITMAP)) for a, b in (("bits", "bitsx"), ("bitsx", "bits"))
    )
    met = rows.join(work_table(possible), ["main", "bin"]).where(
        f"root != rx and (root = main or node < x) and (far or fx) and s <= ux and sx <= u "
        f"and s + sx <= {2 * (100 + percent)} * least(size - ({apart}), sizex - ({apartx})) and 100 * least(n, nx) >= {percent} * greatest(n, nx)"
    )
    pairs = met.select("node", "x").unionByName(stars)
    return pairs.select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct()


def _checked(pairs: DataFrame, columns: DataFrame, test: Callable[[bytes, bytes, int, int], bool]) -> DataFrame:
    """The pairs (a, b) for which ``test`` holds on the ``value`` and ``n_shingles`` of both."""
    mine = columns.select(F.col("set_id").alias("b"), F.col("value").alias("vb"), F.col("n_shingles").alias("nb"))
    theirs = columns.select(F.col("set_id").alias("a"), F.col("value").alias("va"), F.col("n_shingles").alias("na"))
    first = skewed_lookup(pairs, theirs, "a", F.xxhash64("b"))
    both = first.join(mine, "b").select("a", "b", "va", "vb", "na", "nb")

    def run(cols: dict[str, list]) -> dict[str, list]:
        ok = [test(*x) for x in zip(cols["va"], cols["vb"], cols["na"], cols["nb"], strict=True)]
        return {c: [x for x, k in zip(cols[c], ok, strict=True) if k] for c in ("a", "b")}

    return map_slices(both, run, "a binary, b binary")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(set_id, value, n_shingles): the whole shingle sets of the wanted classes, from one text each.

    ``wanted`` is a written table. Where it is small by count its keys are broadcast and only the
    texts asked for move; else both sides are shuffled.
    Texts cross the network compressed, and copies are combined before it.
    """

    def packed(cols: dict[str, list]) -> dict[str, list]:
        pack = zstandard.ZstdCompressor(level=1).compress
        return {"text_key": cols["text_key"], "packed": [pack((t or "").encode("utf-8")) for t in cols["text"]]}

    few = broadcast_if_small(wanted, 64)
    keyed = docs.select(text_key().alias("text_key"), "text")
    if few is not wanted:
        keyed = keyed.join(few, "text_key", "left_semi")
    texts = map_slices(keyed, packed, "text_key string, packed binary")

    def run(cols: dict[str, list]) -> dict[str, list]:
        unpack = zstandard.ZstdDecompressor().decompress
        sets = [shingle_hashes(unpack(t).decode("utf-8"), size) for t in cols["packed"]]
        return {
            "set_id": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
            "value": [s.tobytes() for s in sets],
            "n_shingles": [len(s) for s in sets],
        }

    met = texts if few is not wanted else texts.join(wanted, "text_key", "left_semi")
    one = met.groupBy("text_key").agg(F.first("packed").alias("packed"))
    return map_slices(one, run, "set_id binary, value binary, n_shingles long")


def near_duplicates(docs: DataFrame, size: int, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): ``described`` rows of ``docs``, and (set_id, root) of classes with links.

    Rows with one shingle set form a class at once. Classes meet on the lists of the signature
    join; each pair that agrees in MATCHES coordinates is confirmed on the whole sets:
    100 * intersection >= percent * union. Lists are never expanded into all their pairs: the first
    round links each class with its list's most typical one, the second compares what is still apart
    and can be linked by its size and by what it has in common with others beyond a representative.
    """
    rows = work_table(described(docs, size))
    classes = work_table(
        rows.where("set_id is not null")
        .groupBy("set_id")
        .agg(F.max("signature").alias("signature"), F.max("n_shingles").alias("n_shingles"), F.min("text_key").alias("text_key"))
    )
    alone = classes
    classes = work_table(possible(alone))
    drop_work_table(alone)
    posted = work_table(postings(classes))

    def alike(a: bytes, b: bytes, na: int, nb: int) -> bool:
        if 100 * min(na, nb) < percent * max(na, nb):
            return False
        return int((np.frombuffer(a, "<u4") == np.frombuffer(b, "<u4")).sum()) >= MATCHES

    def linked(a: bytes, b: bytes, na: int, nb: int) -> bool:
        common = len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), assume_unique=True))
        return 100 * common >= percent * (na + nb - common)

    signatures = classes.select("set_id", F.col("signature").alias("value"), "n_shingles")

    def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        met = work_table(pairs)
        found = work_table(_checked(met, signatures, alike))
        drop_work_table(met)
        confirmed = work_table(_checked(found, sets, linked))
        drop_work_table(found)
        return confirmed

    # whole sets of the classes that share a list with another one
    lists = posted.groupBy("element").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    met = posted.join(lists, "element", "left_semi").select("set_id").distinct()
    sets = work_table(_sets(docs, work_table(classes.join(met, "set_id", "left_semi").select("text_key")), size))
    first = links(_star_pairs(posted), sets)
    roots = work_table(components(first))
    split = _split_groups(posted, roots)
    drop_work_table(posted)
    told = _differences(split, sets, percent)
    drop_work_table(split)
    second = links(_cross_pairs(told, percent), sets)
    drop_work_table(told)
    drop_work_table(sets)
    if not second.isEmpty():
        roots = work_table(components(first.unionByName(second)))
    drop_work_table(classes)
    return rows, roots.withColumnRenamed("node", "set_id")


def groups(docs: DataFrame, size: int, percent: int = 80) -> DataFrame:
    """(doc_id, text_key, n_shingles, root, component_id, n_rows) of each row of ``docs``.

    ``root`` names the group (null for a text without words, which is linked with nothing),
    component_id is the group's smallest doc_id, n_rows its rows. Null ids take part but name no
    group unless all of its ids are null; rows with one doc_id are told apart by their texts.
    """
    rows, roots = near_duplicates(docs, size, percent)
    named = salted_lookup(rows.drop("signature"), roots, "set_id", SALTS, F.xxhash64("doc_id", "text_key"))
    named = work_table(named.withColumn("root", F.coalesce("root", "set_id")).drop("set_id"))
    shared = (
        named.where("root is not null")
        .groupBy("root")
        .agg(F.min("doc_id").alias("smallest"), F.count("*").alias("n_rows"))
        .where("n_rows > 1")
    )
    found = salted_lookup(named, shared, "root", SALTS, F.xxhash64("doc_id", "text_key"))
    return found.select(
        "doc_id", "text_key", "n_shingles", "root",
        F.when(F.col("n_rows").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        F.coalesce("n_rows", F.lit(1)).alias("n_rows"),
    )


def keep_one(docs: DataFrame, size: int = 5) -> DataFrame:
    """Pipeline stage: one row of each group, all columns; texts without words stay.

    The row with the smallest doc_id stays (nulls last, then the smallest text hash); among rows
    equal in both any one stays.
    """
    found = work_table(groups(docs, size))
    several = found.where("n_rows > 1")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    best = several.groupBy("root").agg(F.min(order).alias("o")).select("root", "o.doc_id", "o.text_key")
    key = F.concat_ws(":", "text_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    # a row's key decides: not in a group, the one that stays, or one that goes
    keeps = best.select(key.alias("__key"), F.lit(True).alias("stays"))
    gone = several.select(key.alias("__key")).groupBy("__key").agg(F.count("*").alias("n")).join(keeps, "__key", "left")
    columns = docs.columns
    boxed = docs.toDF(*[f"__c{i}" for i in range(len(columns))])
    place = {c: F.col(f"__c{i}") for i, c in enumerate(columns)}
    own = F.concat_ws(
        ":", F.md5(F.coalesce(place["text"], F.lit("")).cast("binary")), F.coalesce(place["doc_id"].cast("string"), F.lit("null"))
    )
    met = boxed.withColumn("__key", own).join(gone, "__key", "left")
    stay = met.where("n is null or (n = 1 and stays)")
    twins = met.where("n > 1 and stays").dropDuplicates(["__key"])
    return stay.unionByName(twins).select(*boxed.columns).toDF(*columns)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every document under four-word shingles."""
    found = groups(table(spark, sf_dir, "documents"), 4)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


ORACLE = """
    with recursive words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') as w
        from documents
    ), shingles as (
        select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
            else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end) as s
        from words
    ), sizes as (select doc_id, count(*) as n from shingles group by doc_id
    ), common as (
        select a.doc_id as a, b.doc_id as b, count(*) as c
        from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
    ), links as (
        select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
    ), steps as (select a, b from links union all select b, a from links
    ), reached as (
        select doc_id as a, doc_id as b from documents
        union select r.a, s.b from reached r join steps s on r.b = s.a
    ), least as (select a as doc_id, min(b) as component_id from reached group by a)
    select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
    from least left join sizes using (doc_id)
"""
