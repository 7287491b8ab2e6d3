"""N-gram Jaccard join with groups of similar documents and their token unions.

A token is a hashed word shingle, a document a set of them. Two documents link if the size of
their sets' intersection is at least ``percent`` of their union; components are what links connect.

1. Chunks ask owners which of their tokens occur elsewhere (``_exchange``). A document of
   which fewer than ceil(percent * n) tokens do links with nothing and leaves here, in general
   most of a corpus. Of the others only shared tokens are kept; the rest count by number.
   Sets with the same shared tokens and the same n are one class: any two of them have just these
   tokens in common, and with any other set each has the same, so they link all or not at all.
   A class is compared once; from here on "document" means a class.
2. Tokens are ordered by how common they are (a table of counts of fixed size) and then by
   hash, those that occur once before all others. Linked sets share a token among the first
   n - ceil(percent * n) + 1 of each (prefix).
3. Documents are partitioned into groups by two min-hashes. The first of a group is compared with all
   others; those that link with it are one cluster.
4. Clusters that share a prefix token are compared by their first members, each with the cluster
   that has most of the token's documents. That joins what belongs together in time linear in the documents; as
   joined clusters have other first members and other tokens in common, it is done a few times.
5. What is still apart but shares a prefix token is searched exactly. Documents are stored
   in groups of bounded size, those of one cluster or of one pair of min-hashes together, each with the
   union of its members' tokens (the row of the token-group matrix). Prefix tokens are joined with
   groups, not with documents; frequent tokens are dealt to several tasks. A query opens a group only
   if its overlap with the union reaches what a link needs, and only then compares with the members.
6. Components come from rounds of stars over the links.

No pair of documents is listed before it links, and no group or token is held by a task as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._exchange import HASHES_PER_OWNER, Met, chunks, give_back, letters, pin_splits, read_bits, row_address, shared_hashes, with_answers
from tidemill.llm._scratch import spool
from tidemill.llm._text import mix, portions, shingle_hashes, utf8

WORDS = 5
PERCENT = 75
#: Counts of token hashes: 2**18 of them, in slices that are summed apart.
_BUCKET_BITS = 18
_SLICES = 64
#: A group with more documents than this is dealt to several tasks.
HOT_GROUP = 50_000
#: Rounds of step 4, at most; a round without a link is the last.
NEAREST_ROUNDS = 4
#: Queries of a group that one task takes; further ones are dealt to further tasks.
QUERIES = 256
#: Documents in a stored group, on average at most.
GROUP_SIZE = 64
#: A prefix token that more documents have is dealt to several tasks.
HOT_TOKEN = 2_000


def _needed(n: int, percent: int) -> int:
    """Of a set of this size, how many tokens any set it links with has to share."""
    return -(-percent * n // 100)


def _links(a: np.ndarray, size_a: int, b: np.ndarray, size_b: int, percent: int) -> bool:
    """Whether sets of these sizes link; the arrays have the tokens that other sets have too."""
    if percent * max(size_a, size_b) > 100 * min(size_a, size_b):
        return False
    shared = _shared(a, b)
    return 100 * shared >= percent * (size_a + size_b - shared)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) < len(b):
        a, b = b, a
    if not len(b):
        return 0
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int(np.count_nonzero(a[at] == b))


def _sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """Ascending distinct tokens of each text."""
    for a, b in portions(texts):
        for hashes in shingle_hashes(texts[a:b], words):
            yield np.unique(hashes)


def _commonness(sets: DataFrame) -> np.ndarray:
    """How common the kept tokens of each hash bucket are, in quarters of a power of two."""
    size = (1 << _BUCKET_BITS) // _SLICES

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _BUCKET_BITS, np.int64)
        for batch in batches:
            for raw in batch["tokens"].to_pylist():
                np.add.at(total, _bucket(np.frombuffer(raw, np.uint64)), 1)
        parts = [p.astype("<i8").tobytes() for p in total.reshape(_SLICES, size)]
        yield pa.record_batch({"slice": pa.array(range(_SLICES), pa.int32()), "counts": pa.array(parts, pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, "<i8") for c in table["counts"].to_pylist())
        return pa.table({"slice": table["slice"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "slice int, counts binary"
    kept = sets.filter("tokens IS NOT NULL").select("tokens")
    rows = kept.mapInArrow(count, schema).groupBy("slice").applyInArrow(add, schema).collect()
    total = np.zeros((_SLICES, size), np.int64)
    for row in rows:
        total[row["slice"]] = np.frombuffer(row["counts"], "<i8")
    return np.floor(4 * np.log2(total.ravel() + 1)).astype(np.uint8)


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)


def _prefix(tokens: np.ndarray, n: int, common: np.ndarray, percent: int) -> np.ndarray:
    """The shared tokens of the prefix of a set of ``n``; those that occur once come before them."""
    length = len(tokens) - _needed(n, percent) + 1
    return tokens[np.argsort(common[_bucket(tokens)], kind="stable")[:length]]


def _group_key(tokens: np.ndarray) -> int:
    other = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).min()
    return int(mix(tokens[:1] * np.uint64(3) + other).view(np.int64)[0])


class _Chunk:
    """The sets of a chunk: one entry per distinct set, and which entry each row has."""

    def __init__(self, table: pa.Table, words: int):
        self.sets: list[np.ndarray] = []
        self.entry: list[int] = []
        known: dict[bytes, int] = {}
        rows: list[int] = []
        for tokens in _sets(utf8(table["text"]), words):
            digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
            at = known.setdefault(digest, len(self.sets))
            if at == len(self.sets):
                self.sets.append(tokens)
                rows.append(0)
            rows[at] += 1
            self.entry.append(at)
        flat = np.concatenate(self.sets)
        self.tokens, self._inverse = np.unique(flat, return_inverse=True)
        # A set that several rows have counts for each, so that copies stay together.
        self._counts = np.bincount(self._inverse, np.repeat(rows, [len(t) for t in self.sets]), len(self.tokens))

    def kept(self, elsewhere: np.ndarray, percent: int) -> list[np.ndarray | None]:
        """Of each entry the tokens that other rows have, here or elsewhere, if they suffice for a link."""
        flags = (elsewhere | (self._counts > 1))[self._inverse]
        found: list[np.ndarray | None] = []
        at = 0
        for tokens in self.sets:
            shared = tokens[flags[at : at + len(tokens)]]
            at += len(tokens)
            found.append(shared if len(tokens) and len(shared) >= _needed(len(tokens), percent) else None)
        return found


def _alike(tokens: np.ndarray, n: int) -> bytes:
    """Digest of a class: its shared tokens and the size of its sets."""
    return hashlib.blake2b(tokens.tobytes() + n.to_bytes(8), digest_size=16).digest()


_SETS = "doc_id long, row long, n long, alike binary, active boolean, key long, tokens binary"


def _described(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A row per row of ``docs``; the tokens once per chunk and class, where there may be links."""
    # A shingle starts at each word; few words are shorter than four bytes and a blank.
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = int(size) // (5 * HASHES_PER_OWNER) + 1

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, table in chunks(batches):
            owner, sender, code = zip(*letters(chunk, _Chunk(table, words).tokens, owners), strict=True)
            yield pa.record_batch({"owner": pa.array(owner, pa.int32()), "chunk": pa.array(sender, pa.int64()), "code": pa.array(code, pa.binary())})

    def describe(met: Iterable[Met]) -> Iterator[pa.RecordBatch]:
        for chunk, table, answers in met:
            own = _Chunk(table, words)
            kept = own.kept(read_bits(own.tokens, owners, answers), percent)
            keys = [None if t is None else _group_key(t) for t in kept]
            alike = [None if t is None else _alike(t, len(s)) for t, s in zip(kept, own.sets, strict=True)]
            written: set[bytes | None] = {None}
            tokens = []
            for entry in own.entry:
                raw = None if alike[entry] in written else kept[entry].tobytes()
                tokens.append(raw)
                written.add(alike[entry])
            yield pa.record_batch(
                {
                    "doc_id": table["doc_id"].combine_chunks().cast(pa.int64()),
                    "row": pa.array(row_address(chunk, np.arange(len(own.entry)))),
                    "n": pa.array([len(own.sets[e]) for e in own.entry], pa.int64()),
                    "alike": pa.array([alike[e] for e in own.entry], pa.binary()),
                    "active": pa.array([kept[e] is not None for e in own.entry]),
                    "key": pa.array([keys[e] for e in own.entry], pa.int64()),
                    "tokens": pa.array(tokens, pa.binary()),
                }
            )

    answers = shared_hashes(docs.mapInArrow(ask, "owner int, chunk long, code binary"))
    return spool(with_answers(docs, answers, describe, _SETS), "sets")


_CLUSTERS = "alike binary, id long, cluster long, n long, k long, key long, joined boolean, prefix binary"


def _clusters(sets: DataFrame, common: Broadcast, percent: int) -> DataFrame:
    """Classes, each with the first of its group if they link: (alike, id, cluster, n, key, joined, prefix).

    ``joined``: whether the sets of the class link with each other. Copies do, as all their tokens are shared.
    """
    rows = sets.filter("tokens IS NOT NULL").select("key", "alike", "row", "n", "tokens")
    # At most one row per HOT_GROUP rows of the table.
    hot = rows.groupBy("key").count().filter(F.col("count") > HOT_GROUP)
    hot = hot.select("key", F.ceil(F.col("count") / HOT_GROUP).alias("deals"))
    deal = F.pmod(F.xxhash64("alike"), F.coalesce("deals", F.lit(1)))
    rows = rows.join(F.broadcast(hot), "key", "left").select("key", deal.alias("deal"), "alike", "row", "n", "tokens")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, first_id, first, first_n = None, None, 0, np.zeros(0, np.uint64), 0
        for batch in batches:
            out = []
            columns = (batch[c].to_pylist() for c in ("key", "deal", "alike", "row", "n", "tokens"))
            for key, deal, alike, row, n, raw in zip(*columns, strict=True):
                if alike == last:
                    continue  # the same class from another chunk
                last, tokens = alike, np.frombuffer(raw, np.uint64)
                if (key, deal) != group:
                    group, first_id, first, first_n = (key, deal), row, tokens, n
                cluster = first_id if _links(first, first_n, tokens, n, percent) else row
                joined = 100 * len(tokens) >= percent * (2 * n - len(tokens))
                out.append((alike, row, cluster, n, len(tokens), key, joined, _prefix(tokens, n, common.value, percent).tobytes()))
            if out:
                kinds = (pa.binary(), *[pa.int64()] * 5, pa.bool_(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.record_batch(arrays, ["alike", "id", "cluster", "n", "k", "key", "joined", "prefix"])
        give_back()

    ordered = rows.repartition("key", "deal").sortWithinPartitions("key", "deal", "alike", "row")
    return spool(ordered.mapInArrow(compare, _CLUSTERS), "clusters")


def _by_token(clusters: DataFrame) -> DataFrame:
    """The rows of ``clusters`` with every token of their prefix instead of the prefix."""
    names = [c for c in clusters.columns if c != "prefix"]
    schema = ", ".join(["token long", *(f"{c} {clusters.schema[c].dataType.simpleString()}" for c in names)])

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                prefixes = [np.frombuffer(p, np.int64) for p in part["prefix"].to_pylist()]
                index = pa.array(np.repeat(np.arange(len(part)), [len(p) for p in prefixes]))
                arrays = [pa.array(np.concatenate(prefixes)), *(part[c].take(index) for c in names)]
                yield pa.record_batch(arrays, ["token", *names])

    return clusters.select(*names, "prefix").mapInArrow(explode, schema)


def _at_tokens(clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token, cluster, size), and of tokens with several clusters (token, top, deals).

    ``top`` is the cluster with most documents at the token, ``deals`` the number of tasks for it.
    """
    counts = _by_token(clusters.select("cluster", "prefix")).groupBy("token", "cluster").agg(F.count(F.lit(1)).alias("size"))
    top = F.max_by("cluster", F.struct("size", -F.col("cluster"))).alias("top")
    tokens = counts.groupBy("token").agg(top, F.count(F.lit(1)).alias("clusters"), F.sum("size").alias("documents"))
    tokens = tokens.filter("clusters > 1").select("token", "top", F.ceil(F.col("documents") / HOT_TOKEN).alias("deals"))
    return counts, spool(tokens, "tokens")


def _met(rows: DataFrame, by: str, tokens: DataFrame) -> DataFrame:
    """``rows`` at ``tokens``, with top, deals and deal; rows of frequent tokens are dealt by ``by``."""
    hot = F.broadcast(tokens.filter("deals > 1").select("token", F.col("deals").alias("hot")))  # one per HOT_TOKEN rows at most
    dealt = rows.join(hot, "token", "left").withColumn("deal", F.pmod(F.xxhash64(by), F.coalesce("hot", F.lit(1)))).drop("hot")
    return dealt.join(_each_deal(tokens), ["token", "deal"])


def _each_deal(rows: DataFrame) -> DataFrame:
    return rows.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)))


def _pairs_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    left, right = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.record_batch({"center": pa.array(left, pa.int64()), "query": pa.array(right, pa.int64())})


_PAIR = "center long, query long"


def _nearest_clusters(clusters: DataFrame) -> DataFrame:
    """(center, query): first members of clusters, with that of the cluster most common at a token of both."""
    counts, tokens = _at_tokens(clusters)
    met = _met(counts.select("token", "cluster"), "cluster", tokens).filter("cluster <> top")
    return met.select(F.col("top").alias("center"), F.col("cluster").alias("query")).distinct()


def _grouped(clusters: DataFrame) -> DataFrame:
    """``clusters`` with a stored group (grp): parts of a cluster, and of what has no cluster by its key.

    ``mixed`` groups have members of several clusters.
    """
    named = clusters.groupBy("cluster").agg((F.count(F.lit(1)) == 1).alias("mixed"))
    rows = clusters.join(named, "cluster").withColumn("unit", F.when(F.col("mixed"), F.col("key")).otherwise(F.col("cluster")))
    sizes = rows.groupBy("mixed", "unit").agg(F.ceil(F.count(F.lit(1)) / GROUP_SIZE).alias("parts"))
    grp = F.xxhash64("mixed", "unit", F.pmod(F.xxhash64("id"), F.col("parts")))
    return rows.join(sizes, ["mixed", "unit"]).select("id", "cluster", "n", "k", "prefix", "mixed", grp.alias("grp"))


def _open_candidates(grouped: DataFrame, percent: int) -> DataFrame:
    """(grp, id, cluster) for documents and groups with documents of other clusters that share a prefix
    token with it, and whose sizes and numbers of kept tokens allow a link.

    Of two documents at a token, one is outside of its most common cluster; that one is the query.
    """
    _, tokens = _at_tokens(grouped)
    rows = _by_token(grouped)
    queries = _met(rows.select("token", "id", "cluster", "n", "k"), "id", tokens).filter("cluster <> top")
    queries = queries.select("token", "deal", "id", "cluster", "n", "k")
    # Two groups that got the same number are one, which is mixed.
    stored = rows.groupBy("token", "grp").agg(
        F.min("cluster").alias("only"), (F.max("mixed") | (F.min("cluster") != F.max("cluster"))).alias("mixed"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("k").alias("most_kept")
    )
    stored = _each_deal(stored.join(tokens.select("token", "deals"), "token")).drop("deals")
    fits = (F.col("most") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("least") * percent)
    # Two sets share at most what each has in common with others; a link takes so much of both sizes.
    may_share = F.least("k", "most_kept") * (100 + percent) >= (F.col("n") + F.col("least")) * percent
    other = F.col("mixed") | (F.col("only") != F.col("cluster"))
    return queries.join(stored, ["token", "deal"]).filter(fits & may_share & other).select("grp", "id", "cluster").distinct()


def _verified(groups: DataFrame, queries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (center, query) between stored groups (grp, id, cluster) and queries (grp, id, cluster).

    A group's members come first and are held, with the union of their tokens; queries stream past.
    The members of a cluster are connected, and clusters that links have connected before need no further one, so
    a task finds fewer links of a group than it has clusters there, however many of its documents are alike.
    """
    tokens = sets.filter("tokens IS NOT NULL").select(F.col("row").alias("id"), "n", "tokens")
    counted = queries.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("deals"))
    dealt = queries.join(counted, "grp").select("grp", F.pmod(F.xxhash64("id"), F.col("deals")).alias("deal"), F.lit(1).alias("side"), "id", "cluster")
    stored = groups.join(counted, "grp").select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"), F.lit(0).alias("side"), "id", "cluster")
    rows = stored.unionByName(dealt).join(tokens, "id")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members, union, least = None, [], None, 0
        forest: dict[int, int] = {}

        def root(cluster: int) -> int:
            while (above := forest.get(cluster, cluster)) != cluster:
                forest[cluster] = cluster = forest.get(above, above)
            return cluster

        for batch in batches:
            found: set[tuple[int, int]] = set()
            columns = (batch[c].to_pylist() for c in ("grp", "deal", "side", "id", "cluster", "n", "tokens"))
            for grp, deal, side, own, cluster, n, raw in zip(*columns, strict=True):
                mine = np.frombuffer(raw, np.uint64)
                if (grp, deal) != group:
                    group, members, union, forest = (grp, deal), [], None, {}
                if not side:
                    members.append((own, cluster, n, mine))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([m for *_, m in members]))
                    least = min(size for _, _, size, _ in members)
                if (100 + percent) * _shared(union, mine) < percent * (n + least):
                    continue  # no member can share enough: the group stays closed
                for other, theirs_in, size, theirs in members:
                    if root(theirs_in) != root(cluster) and _links(theirs, size, mine, n, percent):
                        found.add((other, own))
                        forest[root(theirs_in)] = root(cluster)
            yield _pairs_batch(found)
        give_back()

    ordered = rows.repartition("grp", "deal").sortWithinPartitions("grp", "deal", "side", "id")
    return ordered.select("grp", "deal", "side", "id", "cluster", "n", "tokens").mapInArrow(search, _PAIR)


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of ``links`` (a, b): the smallest id that links reach.

    Rounds of large and small stars: every node passes the smallest of its neighbours on.
    """
    edges = spool(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = spool(small.select("e.a", "e.b").filter("a <> b").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if state == before:
            break
        before = state
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")


def _relabelled(clusters: DataFrame, links: DataFrame) -> DataFrame:
    """Clusters after links between their ids: cluster becomes the smallest connected id."""
    own = clusters.filter("id <> cluster").select(F.col("id").alias("a"), F.col("cluster").alias("b"))
    named = components(own.unionByName(links.select(F.col("center").alias("a"), F.col("query").alias("b"))))
    return clusters.join(named, "id", "left").withColumn("cluster", F.coalesce("component", "id")).drop("component")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, row, kept for every row of ``docs`` (doc_id, text).

    Links are exact: 100 * shared >= percent * union over sets of ``words``-word shingles (see
    ``_text.shingle_hashes``; 64-bit hashes stand for shingles). ``component_id`` is the smallest doc_id
    that links reach, a null one only if there is no other. A null, empty or wordless text has an empty set
    and links with nothing. Rows with the same doc_id are documents of their own. ``row`` is
    the row's address in the input, ``kept`` marks the first row of each component by doc_id, then by row.
    An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    pin_splits(docs)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = _described(docs, words, percent)
    common = spark.sparkContext.broadcast(_commonness(sets))
    clusters = _clusters(sets, common, percent)

    for _ in range(NEAREST_ROUNDS):
        near = spool(_nearest_clusters(clusters), "near")
        # The first member of a cluster has its number.
        centers = near.select(F.col("center").alias("grp"), F.col("center").alias("id"), F.col("center").alias("cluster")).distinct()
        others = near.select(F.col("center").alias("grp"), F.col("query").alias("id"), F.col("query").alias("cluster"))
        links = spool(_verified(centers, others, sets, percent), "near-links")
        if links.isEmpty():
            break
        clusters = spool(_relabelled(clusters, links), "clusters")

    grouped = spool(_grouped(clusters), "groups")
    queries = spool(_open_candidates(grouped, percent), "candidates")
    clusters = _relabelled(clusters, _verified(grouped.select("grp", "id", "cluster"), queries, sets, percent))

    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    light = sets.select("doc_id", "row", "n", "alike", "active")
    inside = light.filter("active").join(clusters.select("alike", "cluster", F.col("id").alias("class"), "joined"), "alike")
    # A class that links neither with itself nor with another one leaves its documents apart.
    apart = (F.min("class") == F.max("class")) & ~F.max("joined")
    best = inside.groupBy("cluster").agg(F.min(rank).alias("least"), apart.alias("apart"))
    inside = inside.join(best, "cluster").select("doc_id", "row", "n", F.when(F.col("apart"), rank).otherwise(F.col("least")).alias("best"))
    alone = light.filter("NOT active").select("doc_id", "row", "n", rank.alias("best"))
    return inside.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("best.id").alias("component_id"),
        "row",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )
