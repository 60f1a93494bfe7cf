"""Entity resolution: companies to registered entities, by identifiers, exact names and similar names."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType

from .. import fixed
from ..functions import numbers, text

POOL = 300
NEAREST = 20
#: The most entities of a rare word, and the words of a name up to which its subsets are formed.
RARE = 32
FEW = 6
#: Names are compared for so many companies at once, in tables of about so many cells.
SLICE = 128
CELLS = 2_000_000
#: The length from which difflib leaves out frequent letters.
LONG = 200


def ratios(lefts: list[str], rights: list[str], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """difflib's ratio of the pairs lefts[one], rights[two]: all pairs at once, by tables of common endings.

    Like difflib it takes the longest common block, the first in the left string and then in the right one, and goes on
    before and behind it. Strings of LONG characters or more, where difflib leaves out frequent letters, go to difflib.
    """
    n1, n2 = np.array([len(x) for x in lefts], np.int64), np.array([len(x) for x in rights], np.int64)
    out = np.zeros(len(one))
    la, lb = n1[one], n2[two]
    far = (la >= LONG) | (lb >= LONG)
    by_right: dict[int, list[int]] = {}
    for i in np.flatnonzero(far):
        by_right.setdefault(int(two[i]), []).append(i)
    for y, rows in by_right.items():
        matcher = difflib.SequenceMatcher(None, "", rights[y])  # what it learns about its second string serves all first ones
        for i in rows:
            matcher.set_seq1(lefts[one[i]])
            out[i] = matcher.ratio()
    letters: dict[str, int] = {}
    for x in (*lefts, *rights):
        if len(x) < LONG:
            for c in x:
                letters.setdefault(c, len(letters) + 2)
    kind = np.uint8 if len(letters) < 250 else np.uint32

    def codes(strings: list[str], pad: int) -> np.ndarray:
        rows = np.full((len(strings), max([1, *(len(x) for x in strings if len(x) < LONG)])), pad, kind)
        for i, x in enumerate(strings):
            if len(x) < LONG:
                rows[i, : len(x)] = [letters[c] for c in x]
        return rows

    a, b = codes(lefts, 0), codes(rights, 1)
    matched = np.zeros(len(one), np.int64)
    row = np.flatnonzero(~far & (la > 0) & (lb > 0))
    parts = row, np.zeros(len(row), np.int64), la[row], np.zeros(len(row), np.int64), lb[row]  # pair, and where its part begins and ends
    while len(parts[0]):
        order = np.argsort(np.maximum(parts[2] - parts[1], parts[4] - parts[3]), kind="stable")
        parts, more, at = tuple(x[order] for x in parts), [], 0
        while at < len(order):
            size = CELLS // 400
            while True:
                pair, a0, a1, b0, b1 = (x[at : at + size] for x in parts)
                w1, w2 = int((a1 - a0).max()), int((b1 - b0).max())
                if len(pair) * w1 * (w2 + 1) <= 4 * CELLS or size == 1:
                    break
                size = max(1, size // 2)
            at += len(pair)
            across, down = np.arange(w1)[:, None] + a0, np.arange(w2)[:, None] + b0
            x = np.where(across < a1, a[one[pair], np.minimum(across, a.shape[1] - 1)], 0).astype(kind)
            y = np.where(down < b1, b[two[pair], np.minimum(down, b.shape[1] - 1)], 1).astype(kind)
            ends = np.zeros((w1, w2 + 1, len(pair)), np.uint8)  # the length of the common block that ends at both places
            for i in range(w1):
                same = y == x[i]
                ends[i, 1:] = (ends[i - 1, :-1] + np.uint8(1)) * same if i else same
            most = ends.max(axis=1)
            i = most.argmax(axis=0)
            k = np.arange(len(pair))
            length = most[i, k].astype(np.int64)
            j = (ends[i, :, k] == length[:, None].astype(np.uint8)).argmax(axis=1) - 1
            good = length > 0
            pair, a0, a1, b0, b1, i, j, length = (v[good] for v in (pair, a0, a1, b0, b1, i, j, length))
            matched += np.bincount(pair, length, len(one)).astype(np.int64)
            i, j = a0 + i + 1, b0 + j + 1  # behind the block
            before, behind = (i - length > a0) & (j - length > b0), (i < a1) & (j < b1)
            more.append((pair[before], a0[before], (i - length)[before], b0[before], (j - length)[before]))
            more.append((pair[behind], i[behind], a1[behind], j[behind], b1[behind]))
        parts = tuple(np.concatenate(v) for v in zip(*more, strict=True))
    out[~far] = np.where(la + lb > 0, 2.0 * matched / np.maximum(la + lb, 1), 1.0)[~far]
    return out


def coded(values: list) -> tuple[list, np.ndarray]:
    """The distinct values, and the place of each value among them."""
    places: dict = {}
    at = np.fromiter((places.setdefault(v, len(places)) for v in values), np.int64, len(values))
    return list(places), at


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series, floor: pd.Series) -> pd.Series:
    """Similarity of two strings by their longest common blocks; 0 where lengths rule out `floor`."""
    out = np.zeros(len(a))
    (lefts, one), (rights, two) = coded([x or "" for x in a]), coded([x or "" for x in b])
    n1, n2 = (np.array([len(x) for x in v], np.int64)[at] if len(at) else np.zeros(0, np.int64) for v, at in ((lefts, one), (rights, two)))
    asked = np.flatnonzero((n1 > 0) & (n2 > 0) & (2 * np.minimum(n1, n2) >= floor.to_numpy(float, na_value=0.0) * (n1 + n2)))
    out[asked] = ratios(lefts, rights, one[asked], two[asked])
    return pd.Series(out)


def alike_words(lefts: list[str], rights: list[str], one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs lefts[one], rights[two]: their share of words in common, and the bonus if one begins the other."""
    words: dict[str, int] = {}

    def places(strings: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
        sets = [dict.fromkeys(x.split(" ")) for x in strings]
        rows = np.full((len(sets), max([1, *map(len, sets)])), pad, np.int32)
        for i, s in enumerate(sets):
            rows[i, : len(s)] = [words.setdefault(w, len(words)) for w in s]
        return rows, np.array([len(s) for s in sets], np.int64)

    (w1, c1), (w2, c2) = places(lefts, -1), places(rights, -2)
    there, common = w2[two], np.zeros(len(one), np.int64)
    for k in range(w1.shape[1]):
        common += (there == w1[one, k][:, None]).any(axis=1)
    overlap = common / np.maximum(1, np.minimum(c1[one], c2[two]))
    n1, n2 = (np.array([len(x) for x in v], np.int64)[at] for v, at in ((lefts, one), (rights, two)))
    # one begins the other only if they agree in the last character of the shorter
    a, b = (np.array(v, f"U{max([1, *map(len, v)])}").view(np.uint32).reshape(len(v), -1) for v in (lefts, rights))
    last = np.maximum(np.minimum(n1, n2) - 1, 0)
    starts = a[one, last] == b[two, last]
    for i in np.flatnonzero(starts):
        x, y = lefts[one[i]], rights[two[i]]
        starts[i] = x.startswith(y) or y.startswith(x)
    return overlap, np.where(starts, 0.08, 0.0)


def similarities(lefts: list[str], rights: list[str], one: np.ndarray, two: np.ndarray, least: float, known: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """What `similarity` gives for the pairs lefts[one], rights[two]; 0 for those that can't reach `least`. known: their alike_words."""
    overlap, bonus = known or alike_words(lefts, rights, one, two)
    n1, n2 = (np.array([len(x) for x in v], np.int64)[at] for v, at in ((lefts, one), (rights, two)))
    floor = np.minimum(least - bonus, (least - bonus - 0.40 * overlap) / 0.60) - 1e-9 if least else np.zeros(len(one))
    asked = np.flatnonzero((n1 > 0) & (n2 > 0) & (2 * np.minimum(n1, n2) >= floor * (n1 + n2)))
    seq = np.zeros(len(one))
    seq[asked] = ratios(lefts, rights, one[asked], two[asked])
    near = np.minimum(1.0, np.maximum(seq, 0.60 * seq + 0.40 * overlap) + bonus)
    place = {x: i for i, x in enumerate(lefts)}
    near[np.array([place.get(x, -1) for x in rights], np.int64)[two] == one] = 1.0
    near[(n1 == 0) | (n2 == 0)] = 0.0
    return near


def foremost(values: np.ndarray, owner: np.ndarray, most: int) -> np.ndarray:
    """The places of the `most` greatest values of each owner (0, 1, ...; sorted)."""
    order = np.lexsort((-values, owner))
    own = owner[order]
    return order[np.arange(len(order)) - np.searchsorted(own, own) < most]


def best_similarities(lefts: list[str], rights: list[str], one: np.ndarray, two: np.ndarray, slot: np.ndarray, owner: np.ndarray, nearest: int, least: float) -> np.ndarray:
    """The greatest similarity of each candidate's pairs lefts[one], rights[two]. slot: the pair's candidate; owner: the candidate's company.

    0 for candidates that can't be among the `nearest` of their company: letters in common, in any order, bound a ratio,
    so those whose bound is below the `nearest` best of the others, compared first, are left out.
    """
    best, bound = np.zeros(len(owner)), np.zeros(len(owner))
    if not len(one):
        return best
    counts = []
    for strings in (lefts, rights):
        n = np.zeros((len(strings), 64), np.uint16)
        for i, x in enumerate(strings):
            n[i] = np.bincount(np.frombuffer(x.encode("utf-32-le"), np.uint32) % 64, minlength=64)
        counts.append(n)
    n1, n2 = (np.array([len(x) for x in v], np.int64)[at] for v, at in ((lefts, one), (rights, two)))
    overlap, bonus = alike_words(lefts, rights, one, two)
    most = 2.0 * np.minimum(counts[0][one], counts[1][two]).sum(axis=1) / np.maximum(1, n1 + n2)
    np.maximum.at(bound, slot, np.minimum(1.0, np.maximum(most, 0.60 * most + 0.40 * overlap) + bonus) + 1e-9)

    def compare(chosen: np.ndarray) -> None:
        at = np.flatnonzero(chosen[slot])
        np.maximum.at(best, slot[at], similarities(lefts, rights, one[at], two[at], least, (overlap[at], bonus[at])))

    first = np.zeros(len(owner), bool)
    first[foremost(bound, owner, nearest)] = True
    compare(first)
    last = np.full(int(owner.max()) + 1, np.inf)
    np.minimum.at(last, owner[first], best[first])
    compare(~first & (bound >= np.maximum(last[owner], least)))
    return best


@F.pandas_udf(DoubleType())
def best_similarity(names: pd.Series, others: pd.Series) -> pd.Series:
    """The greatest similarity of any of the names with any of the others; 0 without one."""
    one, two, row = [], [], []
    lefts: dict[str, int] = {}
    rights: dict[str, int] = {}
    for i, (xs, ys) in enumerate(zip(names, others, strict=True)):
        for x in () if xs is None else xs:
            for y in () if ys is None else ys:
                if x and y:
                    one.append(lefts.setdefault(x, len(lefts)))
                    two.append(rights.setdefault(y, len(rights)))
                    row.append(i)
    out, one, two, row = np.zeros(len(names)), np.array(one, np.int64), np.array(two, np.int64), np.array(row, np.int64)
    if len(one):
        np.maximum.at(out, row, similarities(list(lefts), list(rights), one, two, 0.0))
    return pd.Series(out)


def similarity(a: Column, b: Column, least: float = 0.0) -> Column:
    """Similarity of two normalised names: sequence, words in common, and a bonus if one begins the other.

    Pairs that can't reach `least` may get a lower value than theirs, which saves comparing them.
    """
    one, two = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    overlap = F.size(F.array_intersect(one, two)) / F.greatest(F.lit(1), F.least(F.size(one), F.size(two)))
    bonus = F.when(a.startswith(b) | b.startswith(a), 0.08).otherwise(0.0)
    # a little below, so that rounding never costs a pair
    floor = F.least(least - bonus, (least - bonus - 0.40 * overlap) / 0.60) - 1e-9 if least else F.lit(0.0)
    seq = sequence_ratio(a, b, floor)
    near = F.least(F.lit(1.0), F.greatest(seq, 0.60 * seq + 0.40 * overlap) + bonus)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(near)


def token_index(entities: DataFrame) -> DataFrame:
    """token, cik of every word of every entity's normalised name. entities: cik, norm."""
    return entities.select("cik", F.explode(F.array_distinct(F.split("norm", " "))).alias("token")).where("token <> ''").distinct()


def name_forms(companies: DataFrame) -> DataFrame:
    """company_id, forms (norm and the variants of `name`, if there is one), words (of the forms and of `hinted`, if given).

    A company of several rows has the forms and words of all of them; both are sorted.
    """
    c = companies.columns
    forms = F.concat(F.array("norm"), text.recall_variants(F.col("name"))) if "name" in c else F.array("norm")
    asked = F.concat(F.col("forms"), F.coalesce("hinted", F.array().cast("array<string>"))) if "hinted" in c else F.col("forms")
    words = F.filter(F.flatten(F.transform(asked, lambda x: F.split(x, " "))), lambda w: w != "")
    rows = companies.where("norm <> ''").withColumn("forms", forms).select("company_id", "forms", words.alias("words"))
    whole = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return rows.groupBy("company_id").agg(whole("forms"), whole("words"))


def cut(df: DataFrame) -> DataFrame:
    """The table written once, so that what is used several times is computed once: to Spark's checkpoint folder, or without one to the executors.

    Its size is unknown to Spark's planner, which otherwise takes it from the input's compressed files and broadcasts
    millions of rows by way of the driver. Joins start with a shuffle, and only a side measured as small is broadcast.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext._jsc.sc()
    if folder and context.getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    done = df.localCheckpoint() if context.getCheckpointDir().isEmpty() else df.checkpoint()
    rows = done._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, done._jdf.schema(), False), spark)


def subsets(words: Column) -> Column:
    """All subsets of an array of words but the empty one, as texts (part), and their sizes (hits)."""
    empty = F.array(F.array().cast("array<string>"))
    made = F.aggregate(words, empty, lambda done, w: F.concat(done, F.transform(done, lambda s: F.concat(s, F.array(w)))))
    return F.transform(F.filter(made, lambda s: F.size(s) > 0), lambda s: F.struct(F.array_join(s, " ").alias("part"), F.size(s).cast("long").alias("hits")))


def frequent_pools(sets: DataFrame, index: DataFrame, pool: int) -> DataFrame:
    """set, cik, hits: the first `pool` entities by hits and cik of each set of words. sets: set, often (a sorted array); index: token, cik.

    An entity that shares exactly the words T with a set stands behind all entities before it that have T, so it's
    enough to know the first `pool` entities of every subset; and those of larger subsets only, where `pool` entities
    have one of these. Sets and entities of more than FEW words are counted word by word.
    """
    entities = cut(index.groupBy("cik").agg(F.array_sort(F.collect_list("token")).alias("has")))
    few = lambda c: F.size(c) <= FEW
    asked = sets.where(few("often")).select("set", F.explode(subsets(F.col("often"))).alias("x")).select("set", "x.part", "x.hits")
    own = Window.partitionBy("part").orderBy("cik")
    listed = entities.where(few("has")).select("cik", F.explode(subsets(F.col("has"))).alias("x")).select("cik", "x.part")
    listed = listed.withColumn("place", F.row_number().over(own)).where(F.col("place") <= pool)
    lists = cut(listed.groupBy("part").agg(F.collect_list("cik").alias("ciks")))
    wanted = asked.join(lists, "part")
    full = F.max(F.when(F.size("ciks") >= pool, F.col("hits"))).over(Window.partitionBy("set"))
    wanted = wanted.withColumn("full", F.coalesce(full, F.lit(0))).where(F.col("hits") >= F.col("full"))
    found = wanted.select("set", F.explode("ciks").alias("cik"), "hits")
    each = lambda df: df.select("set", F.explode("often").alias("token"))
    counted = each(sets.where(few("often"))).join(entities.where(~few("has")).select("cik", F.explode("has").alias("token")), "token")
    counted = counted.unionByName(each(sets.where(~few("often"))).join(index, "token"))
    found = found.unionByName(counted.groupBy("set", "cik").agg(F.count("*").alias("hits")))
    best = Window.partitionBy("set").orderBy(F.col("hits").desc(), F.col("cik"))
    found = found.groupBy("set", "cik").agg(F.max("hits").alias("hits"))
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= pool).drop("place")


def pool_parts(asked: DataFrame, entities: DataFrame, pool: int, named: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the pools of distinct sets of words are made of: often (words, set, n, the number of words with that set),
    lists (set, shared), own (words, own). shared and own are sorted arrays of: behind, minus the hits; cik; its names, if
    asked for. asked: words (a sorted array). The `pool` first of both, an entity's place in own before that in shared, are
    the entities that share words.

    Entities that share a rare word (of at most RARE entities) are counted one by one. Those that share frequent words
    only come from the pool of the frequent words, which all names with the same ones have in common: without the
    rare words, entities that have them rank no higher, so none of the others is lost.
    """
    index = token_index(entities)
    counts = index.groupBy("token").agg((F.count("*") > RARE).alias("frequent"))
    index = cut(index.join(counts, "token"))
    counts = index.select("token", "frequent").distinct()
    each = cut(asked.select("words", F.explode("words").alias("token")).join(counts, "token"))
    frequent = index.where("frequent").select("token", "cik")
    often = cut(each.where("frequent").groupBy("words").agg(F.array_sort(F.collect_list("token")).alias("often")))
    sets = cut(often.groupBy("often").agg(F.count("*").alias("n")).withColumn("set", F.monotonically_increasing_id()))
    often = often.join(sets, "often").select("words", "set", "n")
    pools = frequent_pools(sets.select("set", "often"), frequent, pool)
    rare = each.where("NOT frequent").select("words", "token").join(index.where("NOT frequent").select("token", "cik"), "token").groupBy("words", "cik").agg(F.count("*").alias("hits"))
    rare = cut(rare)
    has = frequent.join(rare.select("cik").distinct(), "cik", "left_semi").groupBy("cik").agg(F.collect_list("token").alias("has"))
    rare = rare.join(has, "cik", "left").withColumn("hits", F.col("hits") + F.coalesce(F.size(F.array_intersect("words", "has")), F.lit(0)).cast("long")).drop("has")
    row = [(-F.col("hits")).alias("behind"), F.col("cik")]
    if named:
        names = entities.groupBy("cik").agg(F.collect_set("norm").alias("names"))
        pools, rare = pools.join(names, "cik"), rare.join(names, "cik")
        row.append(F.col("names"))
    lists = pools.groupBy("set").agg(F.sort_array(F.collect_list(F.struct(*row))).alias("shared"))
    own = rare.groupBy("words").agg(F.sort_array(F.collect_list(F.struct(*row))).alias("own"))
    return often, lists, own


def word_pools(asked: DataFrame, entities: DataFrame, pool: int) -> DataFrame:
    """words, near (array of: behind, minus the hits; cik) of distinct sets of words: at most `pool` entities that share some.
    asked: words (a sorted array)."""
    often, lists, own = pool_parts(asked, entities, pool)
    both = asked.join(often, "words", "left").join(lists, "set", "left").join(own, "words", "left")
    known = F.transform("own", lambda x: x["cik"])
    rest = F.filter("shared", lambda x: ~F.array_contains(known, x["cik"]))
    near = F.when(F.col("own").isNull(), F.col("shared")).when(F.col("shared").isNull(), F.slice("own", 1, pool)).otherwise(F.slice(F.sort_array(F.concat("own", rest)), 1, pool))
    return both.select("words", near.alias("near")).where("near IS NOT NULL")


def token_candidates(companies: DataFrame, entities: DataFrame, pool: int = POOL) -> DataFrame:
    """company_id, cik, hits: entities that share words with a company's name, at most `pool` per company,
    most shared words first. companies: as for name_forms. The pool is what the operator is: a top-k."""
    forms = cut(name_forms(companies).select("company_id", "words"))
    pools = word_pools(forms.select("words").distinct(), entities, pool)
    return forms.join(pools, "words").select("company_id", F.explode("near").alias("x")).select("company_id", "x.cik", (-F.col("x.behind")).alias("hits"))


def nearest_names(bundles: DataFrame, pool: int, nearest: int, least: float) -> DataFrame:
    """forms, words, best (array of cik, similarity): the nearest of the entities in own and shared, the first `pool` of both.
    bundles: rows (array of forms, words, own), shared."""

    def compare(bundles: list) -> pa.RecordBatch:
        lefts: dict[str, int] = {}
        rights: dict[str, int] = {}
        ciks, rows, cand, owner, one, two, slot, slots = [], [], [], [], [], [], [], 0
        for members, shared in bundles:
            shared, base = shared or [], len(ciks)
            ciks += [x["cik"] for x in shared]
            places, keys = {x["cik"]: i for i, x in enumerate(shared)}, [(x["behind"], x["cik"]) for x in shared]
            named = np.repeat(np.arange(len(shared)), np.array([len(x["names"]) for x in shared], np.int64))
            names = np.array([rights.setdefault(n, len(rights)) for x in shared for n in x["names"]], np.int64)
            for m in members:
                own, keep = m["own"] or [], np.ones(len(shared), bool)
                keep[[places[x["cik"]] for x in own if x["cik"] in places]] = False
                rest = np.flatnonzero(keep)
                i, j = len(own), len(rest)
                while i + j > pool:
                    if i and (not j or (own[i - 1]["behind"], own[i - 1]["cik"]) > keys[rest[j - 1]]):
                        i -= 1
                    else:
                        j -= 1
                keep[rest[j:]] = False
                chosen = keep[named]
                right = np.r_[names[chosen], np.array([rights.setdefault(n, len(rights)) for x in own[:i] for n in x["names"]], np.int64)]
                whose = np.r_[(np.cumsum(keep) - 1)[named[chosen]], np.repeat(np.arange(j, j + i), np.array([len(x["names"]) for x in own[:i]], np.int64))]
                cand.append(np.r_[base + rest[:j], np.arange(len(ciks), len(ciks) + i)])
                ciks += [x["cik"] for x in own[:i]]
                owner.append(np.full(i + j, len(rows)))
                for x in m["forms"]:
                    one.append(np.full(len(right), lefts.setdefault(x, len(lefts))))
                    two.append(right)
                    slot.append(slots + whose)
                slots += i + j
                rows.append(m)
        cand, owner, one, two, slot = (np.concatenate(v).astype(np.int64) for v in (cand, owner, one, two, slot))
        best = best_similarities(list(lefts), list(rights), one, two, slot, owner, nearest, least)
        place = np.empty(len(ciks), np.int64)
        place[sorted(range(len(ciks)), key=ciks.__getitem__)] = np.arange(len(ciks))
        order = np.lexsort((place[cand], -best, owner))
        order = order[(best[order] > 0) & (best[order] >= least)]
        order = order[np.arange(len(order)) - np.searchsorted(owner[order], owner[order]) < nearest]
        ends = np.r_[0, np.cumsum(np.bincount(owner[order], minlength=len(rows)))].astype(np.int32)
        found = pa.StructArray.from_arrays([pa.array([ciks[i] for i in cand[order]], kind), pa.array(best[order])], names=["cik", "similarity"])
        texts = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays([pa.array([m["forms"] for m in rows], texts), pa.array([m["words"] for m in rows], texts), pa.ListArray.from_arrays(pa.array(ends), found)], names=["forms", "words", "best"])

    def run(batches):
        for batch in batches:
            waiting, size = [], 0
            for members, shared in zip(batch.column("rows"), batch.column("shared"), strict=True):
                members, shared = members.as_py(), shared.as_py()
                for at in range(0, len(members), SLICE):
                    waiting.append((members[at : at + SLICE], shared))
                    size += len(waiting[-1][0])
                    if size >= SLICE:
                        yield compare(waiting)
                        waiting, size = [], 0
            if waiting:
                yield compare(waiting)

    cik = bundles.schema["shared"].dataType.elementType["cik"].dataType
    kind = to_arrow_type(cik)
    return bundles.select("rows", "shared").mapInArrow(run, f"forms array<string>, words array<string>, best array<struct<cik:{cik.simpleString()},similarity:double>>")


def fuzzy_candidates(companies: DataFrame, entities: DataFrame, pool: int = POOL, nearest: int = NEAREST, least: float = 0.0) -> DataFrame:
    """company_id, cik, similarity: the most similar names among the token candidates, by the best of a company's forms,
    of those that are similar at all, or by `least` where given.

    Companies of the same forms and words are compared once, those with the same frequent words in bundles that hold their
    common pool once. A company none of whose words is found is compared with all entities (those that are `current`, if
    that is given).
    """
    forms, entities = cut(name_forms(companies)), cut(entities)
    alike = cut(forms.select("forms", "words").distinct())
    often, lists, own = pool_parts(alike.select("words").distinct(), entities, pool, named=True)
    members = alike.join(often, "words", "left").join(own, "words", "left").where("set IS NOT NULL OR own IS NOT NULL")
    slices = F.coalesce(F.ceil(F.col("n") / SLICE), F.lit(1 << 40))  # without frequent words there is nothing in common
    bundles = members.groupBy("set", F.pmod(F.xxhash64("forms", "words"), slices).alias("slice")).agg(F.collect_list(F.struct("forms", "words", "own")).alias("rows"))
    # few bytes, but long work: dealt to as many tasks as shuffles have, which isn't coalesced by size
    bundles = bundles.join(lists, "set", "left").repartition(int(forms.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = nearest_names(bundles, pool, nearest, least)
    found = forms.join(found, ["forms", "words"]).select("company_id", F.explode("best").alias("x")).select("company_id", "x.cik", "x.similarity")
    known = token_index(entities).select("token").distinct()
    met = alike.select("words", F.explode("words").alias("token")).join(known, "token", "left_semi").select("words").distinct()
    lost = cut(alike.join(met, "words", "left_anti"))
    if lost.isEmpty():  # else all entities are read once for each part of the others
        return found
    every = entities.where("current") if "current" in entities.columns else entities
    rows = lost.select("forms", "words", F.explode("forms").alias("left")).crossJoin(every.select("cik").distinct()).join(entities.select("cik", F.col("norm").alias("right")), "cik")
    best = rows.withColumn("similarity", similarity(F.col("left"), F.col("right"), least)).groupBy("forms", "words", "cik").agg(F.max("similarity").alias("similarity"))
    own = Window.partitionBy("forms", "words").orderBy(F.col("similarity").desc(), F.col("cik"))
    best = best.where((F.col("similarity") > 0) & (F.col("similarity") >= least)).withColumn("place", F.row_number().over(own)).where(F.col("place") <= nearest).drop("place")
    return found.unionByName(forms.join(best, ["forms", "words"]).select("company_id", "cik", "similarity"))


def hint_scores(hints: DataFrame) -> DataFrame:
    """The best five identifier hints of a company. hints: company_id, ticker, hint_name, norm, company_norm,
    market_sector, security_type, exchange, id_type."""
    kind = F.upper(F.coalesce("security_type", F.lit("")))
    score = (
        F.when(F.upper("market_sector") == "EQUITY", 0.25).otherwise(0.0)
        + F.when(kind.rlike("COMMON|ADR|PREF|REIT"), 0.20).otherwise(0.0)
        + F.when(F.coalesce("ticker", F.lit("")) != "", 0.20).otherwise(0.0)
        + F.when(F.col("exchange").isin(*fixed.US_EXCHANGES), 0.10).otherwise(0.0)
        + 0.35 * similarity(F.col("company_norm"), F.col("norm"))
        + F.when(F.col("id_type") == "CUSIP", 0.08).when(F.col("id_type") == "ISIN", 0.05).otherwise(0.0)
    )
    best = hints.withColumn("score", score).groupBy("company_id", "ticker", "norm").agg(F.max("score").alias("score"))
    own = Window.partitionBy("company_id").orderBy(F.col("score").desc(), "ticker", "norm")
    return best.withColumn("place", F.row_number().over(own)).where("place <= 5").drop("place")


def gather_candidates(companies: DataFrame, entities: DataFrame, hints: DataFrame) -> DataFrame:
    """company_id, cik, score, id_backed, exact, evidence: all candidate searches with their scores added up.

    companies: company_id, norm, ticker; entities: cik, norm, ticker, current; hints: company_id, ticker, norm, score.
    A company's `name`, if given, is also searched by its variants.
    """
    bit = {how: 1 << i for i, how in enumerate(("figi_fuzzy", "figi_name", "figi_ticker", "fuzzy", "name", "ticker"))}
    # joined by shuffles: the planner takes the tables' sizes from compressed files
    e = entities.select("cik", "norm", F.col("ticker").alias("__ticker"), "current").hint("merge")
    found = lambda df, score, how, backed, exact: df.select("company_id", "cik", F.lit(score).alias("score") if not isinstance(score, Column) else score.alias("score"), F.lit(bit[how]).alias("how"), F.lit(backed).alias("id_backed"), F.lit(exact).alias("exact"))
    own = companies.where("ticker <> ''").join(e, F.col("ticker") == F.col("__ticker")).drop(companies["norm"])
    by_hint = hints.where("ticker <> ''").drop("norm").join(e, F.col("ticker") == F.col("__ticker"))
    hint_name = hints.drop("ticker", "score").distinct().join(e, "norm")
    name = companies.drop("ticker").join(e, "norm")
    hinted = hints.where("norm <> ''").groupBy("company_id").agg(F.collect_set("norm").alias("hinted"))
    names = entities.select("cik", "norm", "current")
    # companies and their hints' names are searched at once: a hint is told apart by its name
    none = F.lit(None).cast("string")
    own_names = companies.join(hinted.hint("merge"), "company_id", "left").select(
        F.struct("company_id", F.lit("").alias("hint")).alias("company_id"), "norm", F.col("name") if "name" in companies.columns else none.alias("name"), "hinted"
    )
    hint_names = hints.where("norm <> ''").select(F.struct("company_id", F.col("norm").alias("hint")).alias("company_id"), "norm", F.col("norm").alias("name"), F.lit(None).cast("array<string>").alias("hinted")).distinct()
    near = fuzzy_candidates(own_names.unionByName(hint_names), names, least=0.78).select("company_id.company_id", "company_id.hint", "cik", "similarity")
    # both kinds in one pass: a company's own candidates for each of its rows, a hint's once
    norms = companies.groupBy("company_id").agg(F.collect_list("norm").alias("norms"))
    hint, s = F.col("hint") != "", F.col("similarity")
    near = near.where(~hint | (s >= 0.85)).join(norms.hint("merge"), "company_id", "left")
    near = near.withColumn("norm", F.explode(F.when(hint, F.array(none)).otherwise(F.col("norms"))))
    near = near.where(hint | (s >= F.greatest(F.lit(0.78), numbers.name_threshold(F.col("norm")) - 0.12)))
    rows = found(own, 0.95, "ticker", False, False)
    for more in (
        found(by_hint, 0.98, "figi_ticker", True, False),
        found(hint_name, 0.82, "figi_name", True, True),
        found(name, F.when(F.col("current"), 0.92).otherwise(0.84), "name", False, True),
        near.select("company_id", "cik", F.when(hint, 0.40 + 0.30 * s).otherwise(0.42 + 0.28 * s).alias("score"), F.when(hint, bit["figi_fuzzy"]).otherwise(bit["fuzzy"]).alias("how"), hint.alias("id_backed"), F.lit(False).alias("exact")),
    ):
        rows = rows.unionByName(more)
    done = rows.groupBy("company_id", "cik").agg(F.sum("score").alias("score"), F.bool_or("id_backed").alias("id_backed"), F.bool_or("exact").alias("exact"), F.bit_or("how").alias("how"))
    evidence = F.filter(F.array(*(F.when(F.col("how").bitwiseAND(F.lit(b)) != 0, F.lit(k)) for k, b in bit.items())), lambda x: x.isNotNull())
    return done.select("company_id", "cik", "score", "id_backed", "exact", evidence.alias("evidence"))


def validate(candidates: DataFrame, companies: DataFrame, profiles: DataFrame, hints: DataFrame) -> DataFrame:
    """Candidates that pass the gate, with their total. profiles: cik, names (normalised), tickers.

    A ticker matches if the company's own or one of its (at most five) hints' stands in the profile. A company or profile of
    several rows is as similar as the best of them.
    """
    own = companies.select("company_id", "ticker").unionByName(hints.select("company_id", "ticker")).where("ticker <> ''")
    wanted = own.groupBy("company_id").agg(F.collect_set("ticker").alias("wanted"))
    asked = companies.groupBy("company_id").agg(F.collect_list("norm").alias("norms")).join(wanted.hint("merge"), "company_id", "left")
    known = profiles.groupBy("cik").agg(F.collect_list(F.struct("names", "tickers")).alias("profiles"))
    rows = candidates.join(asked.hint("merge"), "company_id").join(known.hint("merge"), "cik")
    rows = rows.withColumn("best", best_similarity("norms", F.flatten(F.filter("profiles.names", lambda x: x.isNotNull()))))
    rows = rows.withColumn("norm", F.explode("norms")).withColumn("profile", F.explode("profiles")).select("*", "profile.names", "profile.tickers")
    ticker = F.coalesce(F.arrays_overlap("wanted", "tickers"), F.lit(False))
    same = F.coalesce(F.get("names", F.lit(0)) == F.col("norm"), F.lit(False))
    threshold = numbers.name_threshold(F.col("norm"))
    gate = F.when(F.col("id_backed"), F.col("best") >= F.greatest(F.lit(0.72), threshold - 0.18)).otherwise(F.col("best") >= F.greatest(F.lit(0.84), threshold - 0.06))
    total = F.col("score") + 0.40 * F.col("best") + F.when(ticker, 0.22).otherwise(0.0) + F.when(same, 0.10).otherwise(0.0)
    return rows.where(gate | ticker).select("company_id", "cik", "id_backed", "exact", "evidence", total.alias("total"))


def accept(validated: DataFrame) -> DataFrame:
    """The accepted entity of each company: best total, far enough before the second. company_id, cik, total, gap, confidence, accepted."""
    from .topk import best_and_gap

    best = best_and_gap(validated, "company_id", "total", "cik")
    t, gap = F.col("total"), F.col("gap")
    ok = (
        F.when(F.col("id_backed"), (t >= 0.95) & ((gap >= 0.06) | (t >= 1.10)))
        .when(F.col("exact"), (t >= 1.00) & ((gap >= 0.07) | (t >= 1.15)))
        .otherwise((t >= 1.05) & ((gap >= 0.08) | (t >= 1.20)))
    )
    return best.select("company_id", "cik", "total", "gap", F.round(F.least(F.lit(1.0), t / 1.35), 4).alias("confidence"), ok.alias("accepted"), "evidence")


def keep_existing(companies: DataFrame, profiles: DataFrame) -> DataFrame:
    """Companies whose given CIK stands: its profile's names are similar enough."""
    rows = companies.join(profiles, "cik").select("company_id", "cik", "norm", F.explode("names").alias("__name"))
    best = rows.withColumn("s", similarity(F.col("norm"), F.col("__name"))).groupBy("company_id", "cik", "norm").agg(F.max("s").alias("similarity"))
    return best.where(F.col("similarity") >= F.greatest(F.lit(0.86), numbers.name_threshold(F.col("norm")) - 0.04)).drop("norm")


def best_name_scores(companies: DataFrame, names: DataFrame) -> DataFrame:
    """company_id, cik, score: the greatest similarity of a company's name or any of its recall variants to an entity's names.

    companies: company_id, name; names: company_id, cik, name (normalised), the pairs to be scored.
    """
    own = companies.select("company_id", F.explode(F.concat(F.array(text.company_name(F.col("name"))), text.recall_variants(F.col("name")))).alias("left"))
    both = own.join(names.withColumnRenamed("name", "right"), "company_id")
    return both.withColumn("score", similarity(F.col("left"), F.col("right"))).groupBy("company_id", "cik").agg(F.max("score").alias("score"))


def normalised(df: DataFrame, name: str = "name") -> DataFrame:
    return df.withColumn("norm", text.company_name(F.col(name)))
