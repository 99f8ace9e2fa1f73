"""Near-duplicate join on word shingles with adaptive multi-match prefixes.

The shingles of all documents have one global order, rare ones first. Two sets
that are similar enough share a shingle among the first n - ceil(t n) + 1 of
each; they share l of them when both prefixes are l - 1 longer. A document whose
prefix meets frequent shingles would have many candidates, so by its estimated
cost it takes a longer prefix and asks for more shared shingles. A pair has to
share the smaller number that its two documents ask for.

Documents of equal sets are one class. Links between classes are found by
bucket, one bucket a shingle. Members of large buckets are first held against
one hub of their bucket, the member with the fewest rarer shingles, which is
nearest to what the others have in common; this is linear in the bucket. Then
every pair of a bucket whose classes are not yet in one component is a candidate
if it shares enough prefix shingles, so no link between components is missed,
and pairs inside a component, which can't change it, are never formed. Candidates
pass a length, a position and a parity-bitmap bound, none of which loses a
link, before their sets are intersected.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected
from .rows import order, whole
from .storage import discard, discard_since, mark, materialise
from .tokens import text_batches
from .words import shingle_sets

WORDS = 5
PERCENT = 80
#: Frequent shingles whose place in the order is known; the others count as rare.
#: At most so many of the most frequent are broadcast, 12 bytes each.
FREQUENT, FREQUENT_FROM = 65_536, 16
#: Shingles that a task counts at once, 8 bytes each.
COUNTED_AT_ONCE = 1_000_000
MOST_MATCHES = 4
#: Cost of intersecting a candidate's sets, against that of one posting.
VERIFY_COST = 8.0
#: Buckets above this go through hubs first.
LARGE_BUCKET = 8
HUB_ROUNDS = 1
#: Bits of a parity bitmap at least; it has as many as its set has shingles, or more.
BITMAP_BITS = 1024
#: Bits of a filter of ids to each id, and the most ids that are broadcast as one, in 16 MB; beyond that rows are picked by a join.
FILTER_RATIO, MOST_FILTERED = 16, 1 << 23


def frequent_shingles(docs: DataFrame, words: int, most: int = FREQUENT, least: int = FREQUENT_FROM) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (sorted) and their number of documents, from all documents.

    Each task counts a bounded number of shingles at a time and passes on those
    that it has seen twice; sums of these are lower bounds. They only order shingles.
    """

    def counted(sets):
        tokens, n = np.unique(np.concatenate(sets), return_counts=True)
        return pa.record_batch([pa.array(tokens[n > 1].view(np.int64)), pa.array(n[n > 1])], ["token", "n"])

    def count(batches):
        held, size = [], 0
        for batch in text_batches(batches, "text"):
            for own in shingle_sets(batch.column("text"), words):
                held.append(own)
                size += len(own)
                if size >= COUNTED_AT_ONCE:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    counts = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "token").limit(most).toArrow()
    tokens, n = found["token"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], n[order]


def matches_asked(frequency: np.ndarray, needed: int, percent: int, most: int = MOST_MATCHES, verify_cost: float = VERIFY_COST) -> int:
    """How many shared prefix shingles a document asks for, from its shingles' frequencies in order.

    A prefix of l matches meets sum(frequency - 1) postings and at most an l-th
    of that many candidates; the l of the least cost is taken. Shingles so far
    back that too few follow them for a link to a document of the same size
    don't count: the position bound takes them out.
    """
    n = len(frequency)
    first = n - needed + 1
    spare = n - -(-2 * percent * n // (100 + percent))
    cost = np.concatenate(([0.0], np.cumsum(frequency[: first + most - 1] - 1.0)))
    levels = range(1, min(most, needed) + 1)
    return min(levels, key=lambda k: (cost[min(first + k - 1, spare + k)] * (1 + verify_cost / k) + 0.01 * k, k))


def parity_bitmap(own: np.ndarray) -> bytes:
    """Of each bit, whether an odd number of the set's shingles fall on it; the size is a power of two."""
    bits = max(BITMAP_BITS, 1 << (len(own) - 1).bit_length())
    return np.packbits((np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool)).tobytes()


def bits_between(x: bytes, y: bytes) -> int:
    """Bits in which two parity bitmaps differ, the larger folded to the size of the smaller."""
    if len(x) < len(y):
        x, y = y, x
    big, size = int.from_bytes(x, "big"), len(x)
    while size > len(y):
        size //= 2
        big = (big >> (8 * size)) ^ (big & ((1 << (8 * size)) - 1))
    return (big ^ int.from_bytes(y, "big")).bit_count()


def _set_name(both: np.ndarray) -> bytes:
    """128 bits of a set, from all 128 of each of its shingles."""
    return hashlib.blake2b(both.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, words: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, digest, n, fp, matches, bitmap, prefix of every row of docs (doc_id, text, digest).

    fp names the set (128 bits; null for the empty set); prefix has the shingles
    of the document's prefix in the global order.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches):
        known, counts = table.value
        for batch in text_batches(batches, "text"):
            rows = []
            for both in shingle_sets(batch.column("text"), words, 2):
                own = both[0]
                n = len(own)
                if not n:
                    rows.append((0, None, 0, None, own))
                    continue
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    hit = known[at] == own
                    order = np.argsort(counts[at[hit]], kind="stable")
                    ordered = np.concatenate((own[~hit], own[hit][order]))
                    frequency = np.concatenate((np.ones(n - len(order)), counts[at[hit]][order]))
                else:
                    ordered, frequency = own, np.ones(n)
                needed = -(-percent * n // 100)
                matches = matches_asked(frequency, needed, percent)
                rows.append((n, _set_name(both), matches, parity_bitmap(own), ordered[: n - needed + matches]))
            values = np.concatenate([r[4] for r in rows]).view(np.int64)
            offsets = np.concatenate(([0], np.cumsum([len(r[4]) for r in rows]))).astype(np.int32)
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.int32(), pa.binary()))]
            prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.record_batch([batch.column("doc_id"), batch.column("digest"), *columns, prefix], ["doc_id", "digest", "n", "fp", "matches", "bitmap", "prefix"])

    return docs.mapInArrow(sign, f"doc_id {kind}, digest long, n int, fp binary, matches int, bitmap binary, prefix array<bigint>")


def _overlap(na: Column, nb: Column, percent: int) -> Column:
    """The shared shingles that a link of these sizes has at least."""
    return F.ceil((percent * (na + nb)) / F.lit(float(100 + percent)) - F.lit(1e-9))


def _positions_allow(percent: int, level: Column) -> Column:
    """Whether a shingle at these places can be one of the first `level` common ones of a link.

    At most level - 1 common ones come before it, and no more than either set
    has before it; what follows has to do for the rest.
    """
    left = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) - 1
    before = F.least(level - 1, "x.pos", "y.pos")
    sizes = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    return sizes & (before + 1 + left >= _overlap(F.col("x.n"), F.col("y.n"), percent))


def _hub_pairs(buckets: DataFrame, labels: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b) of each large bucket's hub with its members of other components.

    First the hub of the whole bucket; in later turns that of the members outside
    the bucket's largest component.
    """
    large = buckets.where(F.col("size") > LARGE_BUCKET).join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    if turn:
        sizes = large.groupBy("token", "label").count().groupBy("token").agg(F.max_by("label", F.struct("count", -F.col("label"))).alias("main"))
        large = large.join(materialise(sizes, "main"), "token").where("label <> main").drop("main")
    large = materialise(large, "large")
    hub = materialise(large.groupBy("token").agg(F.min(F.struct("pos", "cid", "n", "label", "matches")).alias("hub")).select("token", F.col("hub.*")), "hubs")
    level = F.least("x.matches", "y.matches")
    near = hub.alias("x").join(large.alias("y"), F.col("x.token") == F.col("y.token")).where((F.col("x.label") != F.col("y.label")) & _positions_allow(percent, level))
    return near.select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")).distinct()


def _open_pairs(buckets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Every pair (a, b) of different components that shares as many prefix shingles as it has to."""
    own = materialise(buckets.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid")), "labelled")
    main = own.groupBy("token", "label").count().groupBy("token").agg(F.max_by("label", F.struct("count", -F.col("label"))).alias("main"), F.count("*").alias("labels"))
    main = materialise(main.where("labels > 1").drop("labels"), "main")
    # both sides are tables, so that a bucket of very many rows can be split
    rows = materialise(own.join(main, "token"), "open")
    x, y = rows.where("label <> main").alias("x"), rows.alias("y")
    level = F.least("x.matches", "y.matches")
    first = F.greatest(F.col("x.level"), F.col("y.level")) <= level
    once = (F.col("y.label") == F.col("y.main")) | (F.col("x.cid") < F.col("y.cid"))
    near = x.join(y, F.col("x.token") == F.col("y.token")).where((F.col("x.label") != F.col("y.label")) & once & first & _positions_allow(percent, level))
    pairs = near.groupBy(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).agg(F.count("*").alias("shared"), F.first(level).alias("asked"))
    return pairs.where("shared >= asked").select("a", "b")


def _passing_bitmaps(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose bitmaps allow a link: two sets differ in as many shingles as their parity bitmaps in bits, or more."""
    facts = classes.select("cid", "n", "bitmap")
    both = pairs.join(facts.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ba")), "a").join(
        facts.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("bb")), "b"
    )

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
            differ = np.array([bits_between(x, y) for x, y in zip(batch.column("ba").to_pylist(), batch.column("bb").to_pylist(), strict=True)])
            overlap = -(-percent * (na + nb) // (100 + percent))
            yield batch.filter(pa.array(differ <= na + nb - 2 * overlap)).select(["a", "b"])

    return both.mapInArrow(keep, "a long, b long")


def _probes(ids: np.ndarray, log2: int) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    g = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * g) >> np.uint64(64 - log2) for k in range(4)]).astype(np.int64)


class _IdFilter:
    """A Bloom filter of a column of longs, built on the executors, as large as their number asks for."""

    def __init__(self, ids: DataFrame, count: int):
        log2 = self.log2 = max(12, (FILTER_RATIO * count - 1).bit_length())
        name = ids.columns[0]

        def bits(batches):
            for batch in batches:
                at = np.unique(_probes(batch.column(name).to_numpy(), log2))
                yield pa.record_batch([pa.array(at >> 6), pa.array(np.left_shift(np.int64(1), at & 63))], ["word", "mask"])

        words = ids.mapInArrow(bits, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        self._words = np.zeros((1 << log2) // 64, np.int64)
        self._words[words["word"].to_numpy()] = words["mask"].to_numpy()

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        """Which of the ids may be in the column."""
        at = _probes(ids, self.log2)
        return ((self._words[at >> 6] >> (at & 63)) & 1).all(0).astype(bool)


def _postings(classes: DataFrame, sizes: DataFrame) -> DataFrame:
    """cid, n, matches, pos, token of the prefixes, without most of the shingles that are in one document only.

    A filter takes those out before anything is shuffled; what it lets through, or
    all of them where the filter would be too large, goes by the join with the
    bucket sizes.
    """
    count = sizes.count()
    picked = classes.sparkSession.sparkContext.broadcast(_IdFilter(sizes.select("token"), count)) if count <= MOST_FILTERED else None

    def spread(batches):
        for batch in batches:
            prefix = batch.column("prefix")
            tokens = prefix.flatten().to_numpy()
            lengths = np.diff(prefix.offsets.to_numpy())
            of = np.repeat(np.arange(batch.num_rows), lengths)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            keep = picked.value(tokens) if picked else np.ones(len(tokens), bool)
            rows = pa.array(of[keep])
            columns = [batch.column(c).take(rows) for c in ("cid", "n", "matches")]
            yield pa.record_batch([*columns, pa.array(pos[keep].astype(np.int32)), pa.array(tokens[keep])], ["cid", "n", "matches", "pos", "token"])

    return classes.select("cid", "n", "matches", "prefix").mapInArrow(spread, "cid long, n int, matches int, pos int, token long")


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cid, set (bytes of sorted shingles, then of each one's second lane) of the classes wanted (cid, fp, doc_id), from their documents' texts.

    The texts are not shuffled: a filter of the wanted ids' hashes picks them where
    they are read. Where that would be too large, a join picks them.
    """
    keys, count = wanted.select(F.xxhash64("doc_id").alias("key")), wanted.count()
    own = docs.select(F.xxhash64("doc_id").alias("key"), "text")
    picked = docs.sparkSession.sparkContext.broadcast(_IdFilter(keys, count)) if count <= MOST_FILTERED else None
    if picked is None:
        own = own.join(keys.distinct(), "key", "left_semi")

    def read(batches):
        for batch in text_batches(batches, "text"):
            if picked:
                batch = batch.filter(pa.array(picked.value(batch.column("key").to_numpy())))
            sets = [s for s in shingle_sets(batch.column("text"), words, 2) if s.shape[1]]
            if sets:
                yield pa.record_batch([pa.array(list(map(_set_name, sets)), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["fp", "set"])

    found = own.mapInArrow(read, "fp binary, set binary")
    # equal sets met under several ids are one; dealt out by fp once for that and for the join
    return found.groupBy("fp").agg(F.min("set").alias("set")).join(wanted.select("fp", "cid"), "fp").select("cid", "set")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets (2 x n, both lanes) are a link; a shingle is shared if both its lanes are."""
    first = np.concatenate((x[0], y[0]))
    order = np.argsort(first, kind="stable")
    first, second = first[order], np.concatenate((x[1], y[1]))[order]
    shared = int(((first[1:] == first[:-1]) & (second[1:] == second[:-1])).sum())
    return 100 * shared >= percent * (x.shape[1] + y.shape[1] - shared)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, by 128 bits of each shingle."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                keep.append(_similar(*(np.frombuffer(s.as_buffer(), np.uint64).reshape(2, -1) for s in (x, y)), percent))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("cid").alias("b"), F.col("set").alias("y")), "b")
    return both.mapInArrow(check, "a long, b long")


def near_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", id: str = "doc_id") -> DataFrame:
    """doc_id, digest (hash of the text), n_shingles, component_id of every row of docs.

    component_id is the smallest doc_id reachable by links of at least percent %
    Jaccard similarity; equal sets are linked. Texts without words are linked
    with nothing; texts of fewer words than a shingle are one shingle. Null ids
    are never the smallest; a component of null ids alone has a null id. Ids may be
    of any type that has an order. Null texts are empty.
    """
    return labelled_groups(docs, words, percent, text, id).drop("label")


def _bucketed(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of docs (doc_id, text): members (doc_id, digest, n, fp) of every row, classes of equal sets, and their postings by bucket."""
    frequent = frequent_shingles(docs, words)
    signed = materialise(signatures(docs.withColumn("digest", F.xxhash64("text")), words, percent, frequent), "signatures")
    # the same for all of one set but the id
    classes = signed.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("matches").alias("matches"), F.first("bitmap").alias("bitmap"), F.first("prefix").alias("prefix"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = materialise(signed.select("doc_id", "digest", "n", "fp"), "members")
    discard(signed)

    tokens = classes.select(F.explode("prefix").alias("token"))
    sizes = materialise(tokens.groupBy("token").agg(F.count("*").cast("int").alias("size")).where("size > 1"), "bucket-sizes")
    first = F.col("n") - F.ceil(percent * F.col("n") / F.lit(100.0) - F.lit(1e-9)) + 1
    postings = _postings(classes, sizes).withColumn("level", F.greatest(F.lit(1), F.col("pos") - first + 2).cast("int"))
    return members, classes, materialise(postings.join(sizes, "token"), "buckets")


def labelled_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", id: str = "doc_id") -> DataFrame:
    """near_groups with label, the component's own number whatever its ids are; null for texts without words."""
    begun = mark()
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    members, classes, buckets = _bucketed(docs, words, percent)
    facts = classes.select("cid", "n", "bitmap")
    spark = docs.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "cid long, label long")
    sets = None

    def linked(pairs):
        nonlocal sets, links, labels
        pairs = materialise(_passing_bitmaps(pairs, facts, percent), "candidates")
        if pairs.isEmpty():
            return
        wanted = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        if sets is not None:
            wanted = wanted.join(sets, "cid", "left_anti")
        wanted = materialise(classes.select("cid", "fp", "doc_id").join(wanted, "cid"), "wanted")
        if not wanted.isEmpty():
            more = materialise(_sets_of(docs, wanted, words), "sets")
            sets = more if sets is None else sets.unionByName(more)
        found = materialise(_verified(pairs, sets, percent), "links")
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = materialise(connected(links).withColumnRenamed("id", "cid"), "labels")

    for turn in range(HUB_ROUNDS):
        if not buckets.where(F.col("size") > LARGE_BUCKET).isEmpty():
            linked(_hub_pairs(buckets, labels, percent, turn))
    linked(_open_pairs(buckets, labels, percent))

    named = classes.select("cid", "fp", "doc_id").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    smallest = materialise(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    by_set = materialise(materialise(named.select("label", "fp"), "named").join(smallest, "label").select("fp", "component_id", "label"), "by-set")
    discard_since(spark, begun, members, by_set)
    some = members.where("n > 0").join(by_set, "fp").select("doc_id", "digest", F.col("n").cast("long").alias("n_shingles"), "component_id", "label")
    none = members.where("n = 0").select("doc_id", "digest", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("label"))
    return some.unionByName(none)


def near_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Every link, as (links, members): links has class_a < class_b, the classes of equal sets that are linked, and
    members has doc_id, n_shingles, class_id, n_links of every row of docs.

    Rows of one class are linked by being in it and are not given as pairs; n_links
    counts a row's links to other rows, copies included. Texts without words have no
    class and no links. Here every pair of a bucket that shares enough of its prefixes is
    a candidate, so work grows with the links there are, by the square in a
    group of texts that are all alike and all different; near_groups does not.
    """
    begun = mark()
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    members, classes, buckets = _bucketed(docs, words, percent)
    unlabelled = docs.sparkSession.createDataFrame([], "cid long, label long")
    pairs = materialise(_passing_bitmaps(_open_pairs(buckets, unlabelled, percent), classes, percent), "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = materialise(classes.select("cid", "fp", "doc_id").join(wanted, "cid"), "wanted")
    sets = materialise(_sets_of(docs, wanted, words), "sets")
    links = materialise(_verified(pairs, sets, percent).select(F.col("a").alias("class_a"), F.col("b").alias("class_b")), "links")
    sizes = members.where("n > 0").groupBy("fp").agg(F.count("*").alias("rows"))
    sized = materialise(classes.select("cid", "fp").join(sizes, "fp"), "class-sizes")
    both = links.select("class_a", "class_b").unionByName(links.select(F.col("class_b").alias("class_a"), F.col("class_a").alias("class_b")))
    others = both.join(sized.select(F.col("cid").alias("class_b"), "rows"), "class_b").groupBy(F.col("class_a").alias("cid")).agg(F.sum("rows").alias("others"))
    counted = sized.join(others, "cid", "left").select("fp", F.col("cid").alias("class_id"), (F.coalesce("others", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    counted = materialise(counted, "counted")
    discard_since(docs.sparkSession, begun, members, links, counted)
    found = members.join(counted, "fp", "left")
    return links, found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_dedup(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", id: str = "doc_id") -> DataFrame:
    """docs with one row of each group of near duplicates, the one of the smallest doc_id, columns as they were.

    Rows without words all stay. Of several rows of that doc_id in one group, and of
    a group of null ids alone, one stays, the first by its other columns; groups are
    apart even if they share ids. Ids may be of any type that has an order, and
    columns may have any name and type.
    """
    begun = mark()
    found = labelled_groups(docs, words, percent, text, id)
    texts = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("label", "doc_id", "digest").agg(F.count("*").alias("n"))
    # one text of each label; without one, all
    apart = [F.when(F.col("label").isNull(), F.col(c)).alias(f"own_{c}") for c in ("doc_id", "digest")]
    chosen = texts.groupBy("label", *apart).agg(F.min(F.struct("digest", "doc_id", "n")).alias("c"))
    several = F.col("label").isNotNull() & (F.col("c.n") > 1)
    chosen = materialise(chosen.select(F.col("c.doc_id").alias("chosen_id"), F.col("c.digest").alias("chosen_digest"), "label", several.alias("several")), "chosen")
    discard_since(docs.sparkSession, begun, chosen)
    own = docs.select(whole(docs), F.col(id).alias("id"), F.xxhash64(text).alias("digest"))
    out = own.join(chosen, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("digest") == F.col("chosen_digest")))
    if chosen.where("several").isEmpty():
        return out.select("doc.*")
    once = out.where("several").groupBy("label").agg(F.min_by("doc", order(docs)).alias("doc")).select("doc.*")
    return once.unionByName(out.where("not several").select("doc.*"))
