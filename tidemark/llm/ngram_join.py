"""N-gram Jaccard join: a grouped prefix join, and the components of its links.

Words (A-Z lower-cased, separated by ASCII white space) give sets of four-word shingles as 64-bit hashes.
Documents of one set are one node, so exact copies cost nothing further. In a fixed order of all
shingles, two sets that are similar enough share `SHARED` of their first n - ceil(threshold n) + SHARED
shingles (fewer where the sets are smaller). Frequent shingles, found by counts over all documents, come
last in the order.

1. Nodes with the same prefix and size form one group, whichever blocks they come from: the group's name
   is a hash of both. Groups post each shingle of their prefix. Postings of the most frequent shingles
   (`HOT` documents or more) go straight to the long lists, so that no task gathers them; the others are
   gathered by shingle.
2. Short lists give all their pairs of groups that size and position allow, if they stand in enough short
   lists, or in any if both groups post to long ones too. Long lists give star pairs: each group with the
   group of its list and size band that stands in most long lists.
3. Each group has a head, its least node. The heads of group pairs, and each member with the head of its
   group, are the first pairs of nodes: at most SHORT / 2 for each posting. One for each node, with the
   partner of the most lists, is verified first; of the rest, only those between different components go on.
   Pairs whose counts per hash range rule out enough common shingles are dropped (an upper bound, so exact).
4. Then groups are expanded: a group's members are split by component, and only parts in different
   components are paired, within a group, between the groups of a pair, and along the long lists. There,
   the smaller of two sets must leave room for the larger one behind their first common shingle; a set
   whose own position leaves room for smaller partners only isn't joined as the smaller one, so unlike
   documents that share a frequent passage form no pairs. The pairs are filtered and verified as before.

The first shingle that two similar nodes share stands either in a long list, and leaves room, or in a
short one; then the first `SHARED` of them do, or both nodes post to long lists. So each pair of similar
nodes is verified or already in one component, and neither a list nor a group is expanded into all its
pairs unless its members are all unlike though sizes, rare shingles and positions agree.

Defined results: null, empty and white-space texts have 0 shingles and link with nothing, not even each
other; fewer than four words give one shingle of the whole; repeated rows are one node; ids of any type
that has an order; null ids join components but don't name them; an empty table gives an empty result.
Nodes are told apart by 64-bit fingerprints of their sets (for 10^9 different texts, a chance of 3 % that
any two are confused).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, cut, forget, small
from .components import components, joined

WORDS = 4
THRESHOLD = 85
#: Shingles that two prefixes must share.
SHARED = 3
#: The longest list whose pairs are formed directly.
SHORT = 128
#: Documents of a shingle from which its postings go straight to the long lists.
HOT = 5000
#: A shingle is frequent if it stands in so many documents by the counts below.
FREQUENT = 32
LOCAL = 4
HELD = 6_000_000
#: The most frequent shingles that are sent to all workers.
MOST_FREQUENT = 500_000
RANGES = 64


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted set of shingle hashes of a text."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens))], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    mix = np.uint64(0x9E3779B97F4A7C15)
    n = len(h) - words + 1
    x = h[:n].copy()
    for i in range(1, words):
        x = (x ^ (x >> np.uint64(29))) * mix + h[i : n + i]
    x = (x ^ (x >> np.uint64(32))) * mix
    return np.unique(x ^ (x >> np.uint64(29)))


def fingerprint(s: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def shared(n, threshold: int = THRESHOLD):
    """Shingles that the prefix of a set of n shares with that of any similar set, at least."""
    return np.minimum(SHARED, -(-threshold * n // 100))


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    return int(n - -(-threshold * n // 100) + shared(n, threshold))


def range_counts(s: np.ndarray) -> bytes:
    """Shingles per range of hashes; the sum of two sets' minima bounds their common shingles."""
    return np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=RANGES).clip(max=65535).astype("<u2").tobytes()


def needed(n1, n2, threshold: int):
    """The least number of common shingles of two similar sets."""
    return -(-threshold * (n1 + n2) // (100 + threshold))


def repeats(held: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that stand `least` times or more in the arrays, and how often. The list is emptied, so that memory holds little more than its values."""
    x = np.concatenate([np.empty(0, np.uint64), *held])
    held.clear()
    x.sort()
    values = np.unique(x[least - 1 :][x[least - 1 :] == x[: len(x) - least + 1]])
    return values, np.searchsorted(x, values, "right") - np.searchsorted(x, values, "left")


def survey(docs: DataFrame, words: int) -> DataFrame:
    """One sweep over all texts (id, row, text): rows (0, id, row, n, node, ranges) per document and
    (1, null, 0, count, shingle, null) for shingles that repeat within a block of documents."""
    kind = dict(docs.dtypes)["id"]

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        held: list[np.ndarray] = []
        size = 0

        def repeated() -> pd.DataFrame:
            values, counts = repeats(held, LOCAL)
            return pd.DataFrame({"kind": np.int8(1), "id": None, "row": np.int64(0), "n": counts, "key": values.view(np.int64), "ranges": None})

        seen: set[int] = set()
        for batch in batches:
            ns, keys, ranges = [], [], []
            for text in batch["text"]:
                s = shingles(text, words)
                ns.append(len(s))
                keys.append(fingerprint(s) if len(s) else 0)
                ranges.append(range_counts(s))
                if len(s) and keys[-1] not in seen:
                    seen.add(keys[-1])
                    held.append(s)
                    size += len(s)
            yield pd.DataFrame({"kind": np.int8(0), "id": batch["id"], "row": batch["row"], "n": ns, "key": keys, "ranges": ranges})
            if size > HELD:
                yield repeated()
                size = 0
                seen.clear()
        yield repeated()

    # ids travel as text: whole numbers with nulls would become floating point
    rows = docs.select(F.col("id").cast("string").alias("id"), "row", "text").mapInPandas(sweep, "kind byte, id string, row long, n long, key long, ranges binary")
    return rows.withColumn("id", F.col("id").cast(kind))


def frequent_shingles(counts: DataFrame, work: Work) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles with their counts, sorted; at most MOST_FREQUENT, by a threshold that grows."""
    summed = work.keep(counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT))
    level = FREQUENT
    while summed.where(F.col("n") >= level).count() > MOST_FREQUENT:
        level *= 2
    rows = summed.where(F.col("n") >= level).toPandas()
    work.drop(summed)
    tokens = rows["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["n"].to_numpy(np.int64)[order]


def ordered_prefix(s: np.ndarray, p: int, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first p shingles in the order: others by hash, then frequent ones by count and hash."""
    if not len(tokens):
        return s[:p]
    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
    often = tokens[at] == s
    if not often[: min(len(s), p)].any():
        return s[:p]
    rare = s[~often]
    if len(rare) >= p:
        return rare[:p]
    late = s[often]
    return np.concatenate([rare, late[np.lexsort((late, counts[at[often]]))]])[:p]


def postings(docs: DataFrame, frequent, words: int, threshold: int, hot: int = HOT) -> DataFrame:
    """Nodes grouped by prefix and size.

    Rows (0, token, group, place) for each shingle of a group's prefix (place: size and position), (1, group,
    token, place) for those of hot shingles, and (3, node, group, 0) for members; the rows of a group
    repeat in other blocks of documents.
    """
    import xxhash

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        tokens, counts = frequent.value
        often = tokens[counts >= hot]
        seen: set[int] = set()
        posted: set[int] = set()
        for batch in batches:
            parts, nodes, names = [], [], []
            for text in batch["text"]:
                s = shingles(text, words)
                if not len(s) or (node := fingerprint(s)) in seen:
                    continue
                seen.add(node)
                first = ordered_prefix(s, prefix_length(len(s), threshold), tokens, counts)
                group = int(np.uint64(xxhash.xxh3_64_intdigest(first.tobytes(), len(s))).astype(np.int64))
                nodes.append(node)
                names.append(group)
                if group in posted:
                    continue
                posted.add(group)
                prefix, place = first.view(np.int64), np.arange(len(first), dtype=np.int64) + (len(s) << 32)
                at = np.minimum(np.searchsorted(often, first), len(often) - 1) if len(often) else None
                warm = often[at] == first if at is not None else np.zeros(len(first), bool)
                parts.append(rows_of(0, prefix[~warm], group, place[~warm]))
                if warm.any():
                    n = int(warm.sum())
                    parts.append((np.ones(n, np.int8), np.full(n, group, np.int64), prefix[warm], place[warm]))
            if nodes:
                parts.append((np.full(len(nodes), 3, np.int8), np.array(nodes, np.int64), np.array(names, np.int64), np.zeros(len(nodes), np.int64)))
                kind, token, node, place = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pd.DataFrame({"kind": kind, "token": token, "node": node, "place": place})

    return docs.select("text").mapInPandas(post, "kind byte, token long, node long, place long")


def rows_of(kind: int, token, node: int, place) -> tuple[np.ndarray, ...]:
    n = len(token)
    return np.full(n, kind, np.int8), np.asarray(token, np.int64), np.full(n, node, np.int64), np.broadcast_to(np.asarray(place, np.int64), n)


def allowed(place1, place2, threshold: int):
    """Whether sizes and positions leave room for enough common shingles, if this is one of the first SHARED."""
    n1, n2 = place1 >> 32, place2 >> 32
    rest = np.minimum(n1 - (place1 & 0xFFFFFFFF), n2 - (place2 & 0xFFFFFFFF)) + SHARED - 1
    return (100 * np.minimum(n1, n2) >= threshold * np.maximum(n1, n2)) & (rest >= needed(n1, n2, threshold))


def list_pairs(posted: DataFrame, threshold: int, short: int = SHORT) -> DataFrame:
    """Pairs of groups from short lists (0, a, b, 8 times the number of lists + the number needed), the rows of long lists (1, group, token, place), and what isn't a posting as it is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry: pd.DataFrame | None = None
        long_token: int | None = None  # the list that is long already

        def work(rows: pd.DataFrame) -> pd.DataFrame:
            token, node, place = (rows[c].to_numpy() for c in ("token", "node", "place"))
            new = np.r_[True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])] if len(rows) else np.zeros(0, bool)
            token, node, place = token[new], node[new], place[new]
            start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, int)
            length = np.diff(np.r_[start, len(token)])
            long = np.repeat((length > short) | (token[start] == long_token if long_token is not None else False), length)
            parts = [pd.DataFrame({"kind": np.int8(1), "a": node[long], "b": token[long], "place": place[long]})]
            token, node, place = token[~long], node[~long], place[~long]
            us, vs, needs = [], [], []
            for d in range(1, short):
                same = np.flatnonzero(token[d:] == token[:-d]) if d < len(token) else np.zeros(0, int)
                if not len(same):
                    break
                ok = same[allowed(place[same], place[same + d], threshold)]
                us.append(np.minimum(node[ok], node[ok + d]))
                vs.append(np.maximum(node[ok], node[ok + d]))
                needs.append(shared(np.minimum(place[ok], place[ok + d]) >> 32, threshold))
            if us:
                pairs = pd.DataFrame({"a": np.concatenate(us), "b": np.concatenate(vs), "need": np.concatenate(needs)})
                lists = pairs.groupby(["a", "b", "need"], as_index=False).size()
                parts.append(pd.DataFrame({"kind": np.int8(0), "a": lists["a"], "b": lists["b"], "place": 8 * lists["size"] + lists["need"]}))
            return pd.concat(parts)

        for batch in batches:
            other = (batch["kind"] != 0).to_numpy()
            if other.any():
                yield pd.DataFrame({"kind": batch["kind"][other], "a": batch["token"][other], "b": batch["node"][other], "place": batch["place"][other]})
                batch = batch[~other]
            if not len(batch):
                continue
            rows = batch if carry is None else pd.concat([carry, batch], ignore_index=True)
            last = rows["token"].iat[-1]
            whole = (rows["token"] != last).to_numpy()
            if (~whole).sum() > short:  # the last list is long: pass on what there is
                tail = rows[~whole].drop_duplicates("node")
                if len(tail) > short or last == long_token:
                    yield work(rows[whole])
                    long_token = last
                    yield pd.DataFrame({"kind": np.int8(1), "a": tail["node"], "b": tail["token"], "place": tail["place"]})
                    carry = None
                    continue
                rows, whole = pd.concat([rows[whole], tail], ignore_index=True), np.r_[np.ones(int(whole.sum()), bool), np.zeros(len(tail), bool)]
            yield work(rows[whole])
            carry = rows[~whole]
        if carry is not None and len(carry):
            yield work(carry)

    dealt = posted.repartition("token").sortWithinPartitions("kind", "token", "node")
    return dealt.mapInPandas(run, "kind byte, a long, b long, place long")


def sets_of(docs: DataFrame, nodes: DataFrame, words: int, rows: int) -> DataFrame:
    """node, shingles (bytes) of the nodes asked for (node, id: its least document; `rows` of them).

    Only the documents that stand for a node are read again. Copies under the least id give equal rows,
    which is harmless where pairs are verified.
    """

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for node, text in zip(batch["node"], batch["text"], strict=True):
                s = shingles(text, words)
                if len(s) and (node is None or fingerprint(s) == int(node)):
                    out.append((fingerprint(s), s.tobytes()))
            yield pd.DataFrame(out, columns=["node", "shingles"])

    kind = "node long, shingles binary"
    named, bare = nodes.where("id IS NOT NULL").select("id", F.col("node").cast("string").alias("node")), nodes.where("id IS NULL")
    found = docs.join(small(named, rows), "id").select("node", "text").mapInPandas(collect, kind)
    if bare.isEmpty():
        return found
    # nodes that no id stands for: all texts without an id, then those asked for
    rest = docs.where("id IS NULL").select(F.lit(None).cast("string").alias("node"), "text").mapInPandas(collect, kind)
    return found.unionByName(rest.join(bare.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def possible(pairs: DataFrame, info: DataFrame, threshold: int) -> DataFrame:
    """Pairs u, v that the counts per hash range don't rule out. info: node, n, ranges."""

    @F.pandas_udf("boolean")
    def enough(n1: pd.Series, n2: pd.Series, r1: pd.Series, r2: pd.Series) -> pd.Series:
        if not len(n1):
            return pd.Series([], dtype=bool)
        a, b = (np.frombuffer(b"".join(r), "<u2").reshape(len(r), RANGES).astype(np.int64) for r in (r1, r2))
        common = np.where(np.minimum(a, b) == 65535, 1 << 40, np.minimum(a, b)).sum(1)
        return pd.Series(common >= needed(n1.to_numpy(), n2.to_numpy(), threshold))

    one = info.select(F.col("node").alias("u"), F.col("n").alias("n1"), F.col("ranges").alias("r1"))
    two = info.select(F.col("node").alias("v"), F.col("n").alias("n2"), F.col("ranges").alias("r2"))
    return pairs.join(one, "u").join(two, "v").where(enough("n1", "n2", "r1", "r2")).select("u", "v")


def verified(pairs: DataFrame, n: int, sets: DataFrame, threshold: int, work: Work) -> tuple[DataFrame, int]:
    """Of the n pairs u, v those whose sets are similar enough, by their exact common shingles, and their number."""

    @F.pandas_udf("boolean")
    def similar(s1: pd.Series, s2: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(s1, s2, strict=True):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * common >= threshold * (len(a) + len(b) - common))
        return pd.Series(out, dtype=bool)

    sets = sets.join(small(ends(pairs), 2 * n), "node", "left_semi")  # few of them are needed after the first round
    one = sets.select(F.col("node").alias("u"), F.col("shingles").alias("s1"))
    two = sets.select(F.col("node").alias("v"), F.col("shingles").alias("s2"))
    found = pairs.join(one, "u").join(two, "v").where(similar("s1", "s2")).select("u", "v")
    return work.sized(found.distinct())


def ends(pairs: DataFrame) -> DataFrame:
    """The nodes that stand in pairs: each side's, once, so that rows are as many as nodes and not as pairs."""
    return pairs.select(F.col("u").alias("node")).distinct().unionByName(pairs.select(F.col("v").alias("node")).distinct()).distinct()


def ordered(pairs: DataFrame) -> DataFrame:
    """Pairs u < v, each once."""
    return pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components."""
    one, two = roots.select(F.col("node").alias("u"), F.col("root").alias("r1")), roots.select(F.col("node").alias("v"), F.col("root").alias("r2"))
    both = pairs.join(one, "u", "left").join(two, "v", "left")
    return both.where(F.coalesce("r1", "u") != F.coalesce("r2", "v")).select("u", "v")


def likely(pairs: DataFrame, nodes: DataFrame, threshold: int, work: Work) -> tuple[DataFrame, int, DataFrame, int]:
    """Of the pairs those that aren't ruled out, their number, the nodes in them (node, id) and their number."""
    pairs, n = work.sized(ordered(pairs))
    info, _ = work.sized(nodes.join(small(ends(pairs), 2 * n), "node", "left_semi"))
    good, left = work.sized(possible(pairs, info, threshold))
    named, there = work.sized(info.select("node", "id").join(small(ends(good), 2 * left), "node", "left_semi"))
    work.drop(pairs, info)
    return good, left, named, there


def star_pairs(long: DataFrame, threshold: int, work: Work) -> DataFrame:
    """Pairs of groups a, b: the head of a list's size band with the rest of the band and of the next."""
    weights = long.groupBy("group").agg(F.count("*").alias("weight"))
    banded = work.keep(long.join(weights, "group").withColumn("band", band(F.shiftright("place", 32), threshold)))
    heads = banded.groupBy("token", "band").agg(F.max_by("group", F.struct("weight", "group")).alias("head"))
    near = banded.select("token", "group", F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    return near.join(heads, ["token", "band"]).where("group <> head").select(F.col("group").alias("a"), F.col("head").alias("b"))


def band(size, threshold: int):
    """Size bands; sets that can be similar are in the same or in neighbouring ones (a little wider, against rounding)."""
    return F.floor(F.log(size) / (float(np.log(100 / threshold)) * 1.0001)).cast("int")


def list_parts(long: DataFrame, parts: DataFrame, threshold: int, work: Work) -> DataFrame:
    """Parts of groups a, ca, b, cb that a long list holds, in different components, sizes and positions leaving room.

    parts: group, comp. Both parts in the list's largest component are never paired.
    """
    n, position = F.shiftright("place", 32), F.col("place").bitwiseAND(0xFFFFFFFF)
    # by its own position, a set's partner has at most `most` shingles
    most = F.floor((n - position) * (100 + threshold) / threshold).cast("long") - n
    rows = work.keep(long.join(parts, "group").select("token", "group", "comp", n.alias("n"), most.alias("most"), band(n, threshold).alias("band")))
    main = rows.groupBy("token", "comp").count().groupBy("token").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"))
    rows = work.keep(rows.join(main, "token").withColumn("out", F.col("comp") != F.col("main")).drop("main"))
    names = lambda df, g, c, n, most: df.select("token", F.col("band"), F.col("group").alias(g), F.col("comp").alias(c), F.col("n").alias(n), F.col("most").alias(most))
    smaller = rows.where("most >= n")
    larger = rows.withColumn("band", F.explode(F.array("band", F.col("band") - 1)))
    fits = (F.col("ca") != F.col("cb")) & (F.col("n1") <= F.col("n2")) & (100 * F.col("n1") >= threshold * F.col("n2")) & (F.col("n2") <= F.col("m1")) & (F.col("n1") <= F.col("m2"))
    fits = fits & ((F.col("n1") < F.col("n2")) | (F.col("a") < F.col("b")))
    join = lambda one, two: names(one, "a", "ca", "n1", "m1").join(names(two, "b", "cb", "n2", "m2"), ["token", "band"]).where(fits).select("a", "ca", "b", "cb")
    return join(smaller.where("out"), larger).unionByName(join(smaller.where("NOT out"), larger.where("out")))


def link(docs: DataFrame, nodes: DataFrame, counts: DataFrame, words: int, threshold: int, short: int, hot: int, work: Work) -> DataFrame:
    """node, root for each node that has links. docs: id, text; nodes: node, n, ranges, id; counts: key, n."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(counts, work))
    lists = work.keep(list_pairs(postings(docs, frequent, words, threshold, hot), threshold, short))
    members = work.keep(lists.where("kind = 3").select(F.col("a").alias("node"), F.col("b").alias("group")).distinct())
    long = work.keep(lists.where("kind = 1").select(F.col("b").alias("token"), F.col("a").alias("group"), "place").distinct())
    listed = not long.isEmpty()
    counted = lists.where("kind = 0").groupBy("a", "b").agg(F.sum(F.expr("place div 8")).alias("lists"), F.min(F.expr("place % 8")).alias("need"))
    posted_long = long.select(F.col("group").alias("posted")).distinct()
    fewer = counted.where("lists < need")  # the other lists that they share may be long
    for side in ("a", "b"):
        fewer = fewer.join(posted_long, F.col(side) == F.col("posted"), "left_semi")
    enough = counted.where("lists >= need")
    near, _ = work.sized((enough.unionByName(fewer) if listed else enough).select("a", "b", F.col("lists").cast("long").alias("weight")))
    work.drop(lists)
    groups = work.keep(members.groupBy("group").agg(F.min("node").alias("head"), F.count("*").alias("size")))
    many, crowded = work.sized(groups.where("size > 1"))
    several = members.join(small(many, crowded), "group")  # of groups with more than one
    heads = near.unionByName(star_pairs(long, threshold, work).distinct().withColumn("weight", F.lit(0).cast("long"))) if listed else near
    for side, end in (("a", "u"), ("b", "v")):
        heads = heads.join(groups.select(F.col("group").alias(side), F.col("head").alias(end)), side)
    same = several.select(F.col("node").alias("u"), F.col("head").alias("v"), F.lit(1 << 40).alias("weight"))
    pairs = heads.select("u", "v", "weight").unionByName(same).where("u <> v")
    pairs, _ = work.sized(pairs.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.max("weight").alias("weight")))
    # one pair for each node, with the partner of the most lists, joins most of what belongs together
    first = work.keep(pairs.groupBy("v").agg(F.max_by("u", F.struct("weight", -F.col("u"))).alias("u")).select("u", "v"))
    good, n_pairs, named, n = likely(first, nodes, threshold, work)
    sets = work.keep(sets_of(docs, named, words, n))
    links, n = verified(good, n_pairs, sets, threshold, work)
    roots = components(links, work)
    work.drop(sets)
    # of the others only those between components are described further
    good, n_pairs, named, n = likely(across(pairs.select("u", "v").join(first, ["u", "v"], "left_anti"), roots), nodes, threshold, work)
    sets = work.keep(sets_of(docs, named, words, n))
    if n_pairs:
        roots = joined(roots, *verified(good, n_pairs, sets, threshold, work), work)
    work.drop(sets)
    # groups become their members, by components
    placed = work.keep(members.join(roots, "node", "left").select("group", "node", F.coalesce("root", "node").alias("comp")))
    parts = work.keep(placed.select("group", "comp").distinct())
    found = [list_parts(long, parts, threshold, work)] if listed else []
    if crowded:
        one, two = (parts.select(F.col("group").alias(g), F.col("comp").alias(c)) for g, c in (("a", "ca"), ("b", "cb")))
        same = parts.join(small(many, crowded), "group", "left_semi")
        same = same.join(same.withColumnRenamed("comp", "other"), "group").where("comp < other").select(F.col("group").alias("a"), F.col("comp").alias("ca"), F.col("group").alias("b"), F.col("other").alias("cb"))
        sizes = lambda g: small(many.select(F.col("group").alias(g), F.col("size").alias(f"size_{g}")), crowded)
        touched = near.join(sizes("a"), "a", "left").join(sizes("b"), "b", "left").where("size_a > 1 OR size_b > 1").select("a", "b")
        found += [same, touched.join(one, "a").join(two, "b").where("ca <> cb").select("a", "ca", "b", "cb")]
    if not found:
        return roots
    wanted, n = work.sized(reduce(DataFrame.unionByName, found).distinct())
    if not n:
        return roots
    for side, end in (("a", "u"), ("b", "v")):
        wanted = wanted.join(placed.select(F.col("group").alias(side), F.col("comp").alias(f"c{side}"), F.col("node").alias(end)), [side, f"c{side}"])
    pairs, n_pairs, named, n = likely(wanted.select("u", "v"), nodes, threshold, work)
    if not n:
        return roots
    return joined(roots, *verified(pairs, n_pairs, work.keep(sets_of(docs, named, words, n)), threshold, work), work)


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: str | None = None, words: int = WORDS, threshold: int = THRESHOLD, short: int = SHORT, hot: int = HOT) -> DataFrame:
    """Per document: id, row (the key column named, or 0), n (size of its set), root (names its component; null without words)."""
    docs = docs.select(F.col(id_col).alias("id"), (F.col(row) if row else F.lit(0)).cast("long").alias("row"), F.col(text_col).alias("text"))
    with Work(docs.sparkSession, "jaccard") as work:
        rows = work.keep(survey(docs, words))
        own = rows.where("kind = 0").select("id", "row", "n", F.col("key").alias("node"), "ranges")
        nodes = work.keep(own.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("ranges").alias("ranges"), F.min("id").alias("id")))
        roots = link(docs.select("id", "text"), nodes, rows.where("kind = 1").select("key", "n"), words, threshold, short, hot, work)
        out = own.drop("ranges").join(roots, "node", "left")
        return cut(out.select("id", "row", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).alias("root")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD, short: int = SHORT, hot: int = HOT) -> DataFrame:
    """Per document: id, n_shingles, component_id (least id that links reach)."""
    found = jaccard_classes(docs, id_col, text_col, None, words, threshold, short, hot)
    # written, so that Spark can split a root that a third of the documents have when it joins
    names = cut(found.where("n > 0").groupBy("root").agg(F.min("id").alias("component_id")))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return found.join(names, "root", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
