"""Near duplicates by exact Jaccard similarity of word shingles: a prefix-tree join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Scratch,
    bitmap_of,
    hash_windows,
    in_bitmap,
    key_halves,
    mix,
    powers,
    signed,
    small_batches,
    word_groups,
)

SHINGLE = 5
#: Two sets are linked when 100 * intersection >= 80 * union; the bounds below follow from it.
SIMILARITY = 80
#: Share of a set, in percent, that the first filter asks for beyond one common n-gram.
EXTRA = 6
#: Cells (a power of two) of the bitmap of sets that pass the first filter: 2^25 bits are 4 MB.
BITMAP_BITS = 25
#: N-grams of one prefix tree; larger clusters are split over several.
TREE_TOKENS = 1_000_000
_TOKEN_BITS = 58


def needed(size: np.ndarray | int) -> np.ndarray | int:
    """N-grams that a set of this size shares at least with any set it is linked with."""
    return (SIMILARITY * size + 99) // 100


def extra(size: np.ndarray | int) -> np.ndarray | int:
    return np.maximum(1, EXTRA * size // 100)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, bounds, hashes in word_groups(texts, lower=True):
        windows = hash_windows(hashes, SHINGLE)
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end - begin >= SHINGLE:
                yield np.unique(windows[begin : end - SHINGLE + 1])
            elif end > begin:
                short = hashes[begin:end]
                yield mix((short * powers(len(short) + 1)[1:]).sum(keepdims=True) + np.uint64(len(short)))
            else:
                yield np.empty(0, np.uint64)


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _document_sets(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_shingles, key) and the columns ``keep``: the key stands for the set; null where it is empty."""
    kinds = dict(documents.dtypes)
    kept = "".join(f", `{name}` {kinds[name]}" for name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "key": pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                **{name: batch.column(name) for name in keep},
            })

    return documents.select("doc_id", "text", *keep).mapInArrow(
        run, f"doc_id {kinds['doc_id']}, n_shingles bigint, key binary{kept}"
    )


def _distinct_sets(batches: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[tuple[bytes, np.ndarray]]:
    """Non-empty sets of a task's texts; equal ones within a bounded stretch come once."""
    seen: set[bytes] = set()
    for batch in batches:
        for tokens in shingle_sets(batch.column("text").to_pylist()):
            if not len(tokens):
                continue
            key = set_key(tokens)
            if key not in seen:
                if len(seen) >= most:
                    seen.clear()
                seen.add(key)
                yield key, tokens


def _prefixes(documents: DataFrame, chunk_tokens: int = 2_000_000) -> DataFrame:
    """(token, half, need, shared) for the least n-grams, by hash, of every set.

    Of two linked sets, the prefixes of size - needed(size) + extra n-grams share ``extra`` at least, so a
    set with fewer shared n-grams in its prefix has no link. ``need`` is that number for the smallest
    partner. Within a chunk of a task's sets an n-gram is sent once: with its set (``half`` of the key) if
    only one has it, else without one, and its sets are credited right here (``shared`` > 0).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, keys, needs, size = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            half = key_halves(keys)
            need = np.array(needs, np.int32)
            flat = np.concatenate(tokens)
            owner = np.repeat(np.arange(len(tokens)), [len(part) for part in tokens])
            # copies of a set in this chunk have been met already, so an owner has a token once
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            first = np.concatenate(([True], flat[1:] != flat[:-1]))
            single = first & np.concatenate((first[1:], [True]))
            credit = np.bincount(owner[~single], minlength=len(tokens))
            some = np.flatnonzero(credit)
            many = first & ~single
            for rows in ((flat[single], half[owner[single]], need[owner[single]], None),
                         (flat[many], None, None, None), (half[some], half[some], need[some], credit[some])):
                count = len(rows[0])
                yield pa.RecordBatch.from_pydict({
                    "token": signed(rows[0]),
                    "half": pa.nulls(count, pa.int64()) if rows[1] is None else signed(rows[1]),
                    "need": pa.nulls(count, pa.int32()) if rows[2] is None else pa.array(rows[2], pa.int32()),
                    "shared": pa.nulls(count, pa.int32()) if rows[3] is None else pa.array(rows[3], pa.int32()),
                })

        for key, own in _distinct_sets(batches):
            n = len(own)
            prefix = own[: n - needed(n) + extra(n)]
            tokens.append(prefix)
            keys.append(key)
            needs.append(int(extra(needed(n))))
            size += len(prefix)
            if size >= chunk_tokens:
                yield from flush()
                tokens, keys, needs, size = [], [], [], 0
        if tokens:
            yield from flush()

    return documents.select("text").mapInArrow(run, "token bigint, half bigint, need int, shared int")


def _suspects(documents: DataFrame) -> DataFrame:
    """``half`` of the keys of all sets that can have a link."""
    rows = _prefixes(documents)
    met = F.count(F.lit(1)).over(Window.partitionBy("token"))
    return (
        rows.withColumn("met", met)
        .filter("half IS NOT NULL AND (shared IS NOT NULL OR met > 1)")
        .groupBy("half", "need")
        .agg(F.sum(F.coalesce("shared", F.lit(1))).alias("found"))
        .filter("found >= need")
        .select("half")
    )


def _candidate_sets(documents: DataFrame, suspects: np.ndarray) -> DataFrame:
    """(key, tokens) of the sets in the bitmap; one row for each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, size = [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "tokens": pa.array(held, pa.binary())})

        for key, tokens in _distinct_sets(batches):
            if in_bitmap(suspects, key_halves([key]))[0]:
                keys.append(key)
                held.append(tokens.tobytes())
                size += 8 * len(tokens)
            if size >= 8_000_000:
                yield flush()
                keys, held, size = [], [], 0
        if keys:
            yield flush()

    rows = documents.select("text").mapInArrow(run, "key binary, tokens binary")
    return rows.groupBy("key").agg(F.first("tokens").alias("tokens"))


def _token_rows(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = batch.column("sid").to_numpy()
            parts = [np.frombuffer(data, np.uint64) for data in batch.column("tokens").to_pylist()]
            begin = 0
            while begin < len(parts):
                end, size = begin, 0
                while end < len(parts) and (size == 0 or size + len(parts[end]) <= 500_000):
                    size += len(parts[end])
                    end += 1
                sizes = [len(part) for part in parts[begin:end]]
                yield pa.RecordBatch.from_pydict({
                    "token": signed(np.concatenate(parts[begin:end]) & np.uint64((1 << _TOKEN_BITS) - 1)),
                    "sid": pa.array(np.repeat(sids[begin:end], sizes), pa.int64()),
                    "n": pa.array(np.repeat(sizes, sizes), pa.int32()),
                })
                begin = end

    return sets.select("sid", "tokens").mapInArrow(run, "token bigint, sid bigint, n int")


def _ordered_sets(sets: DataFrame) -> DataFrame:
    """(sid, n, tokens, prefix): shared n-grams of each set in the global order, rarest first.

    The global order is by the octave of the document frequency, then by hash. N-grams that only one
    set has come first and link nothing, so they are only counted. Sets whose prefix has no shared
    n-gram have no link and are dropped.
    """
    rows = _token_rows(sets).withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("df > 1")
    octave = F.floor(F.log2("df")).cast("int")
    ranked = rows.select("sid", "n", (F.shiftleft(octave.cast("long"), _TOKEN_BITS).bitwiseOR(F.col("token"))).alias("token"))
    ordered = ranked.repartition("sid").sortWithinPartitions("sid", "token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def emit(parts: list, last: bool) -> tuple[pa.RecordBatch | None, list]:
            sid, n, token = (np.concatenate([part[place] for part in parts]) for place in range(3))
            edges = np.flatnonzero(np.concatenate(([True], sid[1:] != sid[:-1])))
            stops = np.append(edges[1:], len(sid))
            keep = [] if last else [(sid[edges[-1] :], n[edges[-1] :], token[edges[-1] :])]
            if not last:
                edges, stops = edges[:-1], stops[:-1]
            out: list[list] = [[], [], [], []]
            for begin, end in zip(edges, stops, strict=True):
                size = int(n[begin])
                lead = size - needed(size) + 1 - (size - (end - begin))
                if lead > 0:
                    out[0].append(int(sid[begin]))
                    out[1].append(size)
                    out[2].append(token[begin:end].tobytes())
                    out[3].append(token[begin : begin + lead].tolist())
            if not out[0]:
                return None, keep
            return pa.RecordBatch.from_pydict({
                "sid": pa.array(out[0], pa.int64()), "n": pa.array(out[1], pa.int32()),
                "tokens": pa.array(out[2], pa.binary()), "prefix": pa.array(out[3], pa.list_(pa.int64())),
            }), keep

        rows_held = 0
        for batch in batches:
            held.append(tuple(batch.column(name).to_numpy() for name in ("sid", "n", "token")))
            rows_held += len(batch)
            if rows_held >= 500_000:
                done, held = emit(held, False)
                rows_held = len(held[0][0])
                if done is not None:
                    yield done
        if held:
            done, _ = emit(held, True)
            if done is not None:
                yield done

    return ordered.mapInArrow(run, "sid bigint, n int, tokens binary, prefix array<bigint>")


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, for all nodes of ``edges`` (a, b).

    Large-star and small-star steps until all are stars: each joins a node's neighbours to the least one. The table
    of a step is written, so a lost executor repeats one step. A star whose centre has very many neighbours meets
    only as a join of two exchanged sides, which is split where it is skewed. Each stage and each scan costs the
    driver memory, whatever its rows, so a step has few of them and no step runs once all are stars.
    """

    def least_of(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy(F.col("a").alias("centre")).agg(F.min("b").alias("least"))

    now = scratch.write(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    while not _all_stars(now):
        # the least neighbour of a centre is among those below it, or the centre itself
        large = now.join(least_of(scratch.again(now)), F.col("b") == F.col("centre"), "left")
        large = scratch.write(large.select("a", F.coalesce("least", "b").alias("b")))
        small = large.join(least_of(scratch.again(large)), F.col("a") == F.col("centre"))
        lifted = F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))
        after = scratch.write(small.select(F.explode(lifted).alias("pair")).select("pair.*").filter("a <> b").distinct())
        scratch.drop(now, large)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _all_stars(pairs: DataFrame) -> bool:
    """Whether no node that is the ``a`` of one of the distinct pairs (a, b), a above b, stands in another one."""
    nodes = pairs.selectExpr("stack(2, a, 1, b, 0) AS (node, above)")
    seen = nodes.groupBy("node").agg(F.sum("above").alias("above"), F.count(F.lit(1)).alias("n"))
    return not seen.agg(F.max((F.col("above") > 0) & (F.col("n") > 1))).first()[0]


class PrefixTree:
    """Sets as paths in a tree, the most frequent n-grams first, so that alike sets share their way.

    A node holds the stretch of n-grams that its sets have in common after the parent's, and the range
    of its sets in the order of their paths.
    """

    def __init__(self, paths: list[np.ndarray], sizes: np.ndarray):
        big = [path.astype(">u4").tobytes() for path in paths]
        self.order = np.array(sorted(range(len(paths)), key=big.__getitem__), np.int64)
        self.paths = [paths[at] for at in self.order]
        self.sizes = sizes[self.order]
        shared = [0]
        for left, right in zip(self.paths[:-1], self.paths[1:], strict=True):
            span = min(len(left), len(right))
            differ = np.flatnonzero(left[:span] != right[:span])
            shared.append(int(differ[0]) if len(differ) else span)
        self.shared = np.array(shared, np.int64)

    def children(self, begin: int, end: int, depth: int) -> tuple[int, list[tuple[int, int]]]:
        """Depth to which the sets of a range agree, and the ranges that part there."""
        if end - begin == 1:
            return len(self.paths[begin]), []
        inner = self.shared[begin + 1 : end]
        common = int(inner.min())
        cuts = [begin, *(np.flatnonzero(inner == common) + begin + 1).tolist(), end]
        return common, list(zip(cuts[:-1], cuts[1:], strict=True))

    def join(self, labels: np.ndarray) -> np.ndarray:
        """Labels after joining all linked sets; sets with equal labels on entry count as joined.

        Each set walks down the tree. What it shares with a node's stretch is counted once for all sets
        below. A subtree is left when the rest of its paths, or of the set, is too short for a link, or
        when all its sets are joined with this one already.
        """
        labels = labels[self.order].copy()
        count = len(self.paths)
        low = np.concatenate([path for path in self.paths]).max(initial=0) + 1
        present = np.zeros(int(low), bool)
        shape: dict[tuple[int, int], tuple] = {}
        for at in range(count - 1):
            own, size = self.paths[at], int(self.sizes[at])
            present[own] = True
            lead = size - len(own)  # n-grams that no other set has
            stack = [(0, count, 0, 0)]
            while stack:
                begin, end, depth, common = stack.pop()
                if end <= at + 1 or (labels[max(begin, at + 1) : end] == labels[at]).all():
                    continue
                found = shape.get((begin, end))
                if found is None:
                    deep, below = self.children(begin, end, depth)
                    span = self.sizes[begin:end]
                    found = shape[(begin, end)] = deep, below, int(span.min()), int(span.max())
                deep, below, least, most = found
                if deep > depth:
                    stretch = self.paths[begin][depth:deep]
                    common += int(present[stretch].sum())
                    passed = int(np.searchsorted(own, stretch[-1], side="right"))
                    missed = passed - common + lead  # of this set, for good
                    if 9 * (size - missed) < 4 * (size + least) or 5 * most < 9 * (deep - common) + 4 * size:
                        continue
                if below:
                    # a path that ends where others go on is a range of its own, as its shared part ends there
                    stack.extend((a, b, deep, common) for a, b in reversed(below))
                else:
                    for other in range(max(begin, at + 1), end):
                        union = size + int(self.sizes[other]) - common
                        if labels[other] != labels[at] and 100 * common >= SIMILARITY * union:
                            a, b = sorted((labels[at], labels[other]))
                            labels[labels == b] = a
            present[own] = False
        out = np.empty(count, labels.dtype)
        out[self.order] = labels
        return out


def _join_group(group: pa.Table) -> pa.Table:
    """Links among the sets of one tree, as rows (sid, root) that span its components."""
    sids = group.column("sid").to_numpy()
    order = np.argsort(sids, kind="stable")
    sids = sids[order]
    labels = group.column("label").to_numpy()[order]
    sizes = group.column("n").to_numpy()[order].astype(np.int64)
    data = group.column("tokens").to_pylist()
    tokens = [np.frombuffer(data[at], np.int64) for at in order]
    ranks = np.unique(np.concatenate(tokens))[::-1]  # most frequent first
    paths = [np.searchsorted(-ranks, -part[::-1]).astype(np.int64) for part in tokens]
    start = np.searchsorted(np.unique(labels), labels)
    joined = PrefixTree(paths, sizes).join(start)
    roots = np.full(len(sids), np.iinfo(np.int64).max)
    np.minimum.at(roots, joined, sids)
    return pa.table({"sid": pa.array(sids, pa.int64()), "root": pa.array(roots[joined], pa.int64())})


_EDGE = "sid bigint, root bigint"


def _links(scratch: Scratch, sets: DataFrame, tree_tokens: int) -> DataFrame:
    """Edges (a, b) that span the components of all links; ``sets`` has sid, n, tokens, cluster.

    A cluster within ``tree_tokens`` is one tree. A larger one is dealt over several, each joined on its
    own. Then one set of every component so far stands for it in further trees, as long as that joins
    many. At last each pair of trees whose sets are not all of one component is joined as a whole, so no
    link is lost, however large the cluster is.
    """
    cost = (F.octet_length("tokens") / 8).cast("long") + 16

    def dealt(rows: DataFrame) -> DataFrame:
        """``block`` by a hash, as many for each cluster as its n-grams need."""
        totals = rows.groupBy("cluster").agg(F.sum(cost).alias("total"))
        blocks = F.ceil(F.col("total") / tree_tokens).cast("long")
        return rows.join(totals.select("cluster", blocks.alias("blocks")), "cluster").withColumn(
            "block", F.pmod(F.xxhash64("sid", F.lit(scratch.count)), F.col("blocks"))
        )

    def joined(rows: DataFrame, *keys: str) -> DataFrame:
        return scratch.write(
            rows.select(*keys, "sid", "n", "tokens", "label").groupBy(*keys).applyInArrow(_join_group, _EDGE)
        )

    start = scratch.write(dealt(sets).withColumn("label", F.col("sid")))
    found = joined(start, "cluster", "block")
    edges = found
    large = start.filter("blocks > 1").select("cluster", "block", "sid", "n", "tokens")
    left = large.count()
    if not left:
        return edges.select(F.col("sid").alias("a"), F.col("root").alias("b"))
    pivots = large
    while True:
        pivots = scratch.write(
            pivots.join(found.filter("sid = root").select("sid"), "sid").select("cluster", "sid", "n", "tokens")
        )
        count = pivots.count()
        if count > 0.9 * left or count <= 1:
            break
        left = count
        found = joined(dealt(pivots).withColumn("label", F.col("sid")), "cluster", "block")
        edges = edges.unionByName(found)
    known = scratch.write(components(scratch, edges.select(F.col("sid").alias("a"), F.col("root").alias("b"))))
    parts = scratch.write(
        large.join(known.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("root", "sid")).drop("root")
    )
    blocks = parts.groupBy("cluster", "block").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    others = blocks.select("cluster", *[F.col(name).alias(f"{name}_2") for name in ("block", "least", "most")])
    pairs = blocks.join(others, "cluster").filter(
        "block < block_2 AND NOT (least = most AND least = least_2 AND least = most_2)"
    )
    pairs = scratch.write(pairs.select("cluster", F.col("block").alias("one"), F.col("block_2").alias("two")))
    both = parts.join(pairs, "cluster").filter("block = one OR block = two")
    rest = joined(both, "cluster", "one", "two")
    return edges.unionByName(rest).select(F.col("sid").alias("a"), F.col("root").alias("b"))


def near_duplicates(
    spark: SparkSession,
    documents: DataFrame,
    tree_tokens: int = TREE_TOKENS,
    bitmap_bits: int = BITMAP_BITS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """doc_id, n_shingles, component_id, set_key, component_key and the columns ``keep`` for each document.

    Words are lower-cased in A-Z. A set has the distinct 5-word shingles, or the whole sequence of fewer
    words; texts without words, null ones too, have none and are linked with nothing. Documents are
    linked when 100 * intersection >= 80 * union; ``component_id`` is the least doc_id reachable by links.
    Rows with equal ids are joined by their texts alone. A null id takes the least id of its component,
    null if there is none. Components with the same least id differ in ``component_key``, the least
    ``set_key``; it is null with ``set_key``. Shingles are compared by 64-bit hashes (58 bits in the tree).

    Equal sets are one from the start. Sets that can have no link are left out by their n-grams of least
    hash. For the others document frequencies give the global order. Sets that share an n-gram of their
    rare prefix are of one cluster, and a cluster is joined in prefix trees.
    """
    small_batches(spark)
    scratch = Scratch(spark, "ngram-join")
    found = scratch.write(_document_sets(documents, keep))
    suspects = bitmap_of(_suspects(documents), "half", bitmap_bits)
    sets = scratch.write(_candidate_sets(documents, suspects).withColumn("sid", F.monotonically_increasing_id()))
    ordered = scratch.write(_ordered_sets(sets))
    prefix = ordered.select("sid", F.explode("prefix").alias("token"))
    centres = prefix.groupBy("token").agg(F.min("sid").alias("centre"))
    stars = prefix.join(centres, "token").filter("sid <> centre").select(F.col("sid").alias("a"), F.col("centre").alias("b"))
    clusters = scratch.write(components(scratch, stars))
    clustered = ordered.select("sid", "n", "tokens").join(
        clusters.select(F.col("node").alias("sid"), F.col("root").alias("cluster")), "sid"
    )
    roots = scratch.write(components(scratch, _links(scratch, clustered, tree_tokens)))
    named = roots.join(sets.select(F.col("sid").alias("node"), "key"), "node").select("key", "root")
    first = found.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    members = named.join(first, "key")
    least = members.groupBy("root").agg(F.min("least").alias("component"), F.min("key").alias("component_key"))
    joined = scratch.write(members.join(least, "root").select("key", "component", "component_key"))
    by_key = scratch.write(
        first.join(joined, "key", "left").select(
            "key", F.coalesce("component", "least").alias("component"), F.coalesce("component_key", "key").alias("component_key")
        )
    )
    scratch.drop(sets, ordered, clusters, roots, joined)
    return found.join(by_key, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.col("key").alias("set_key"),
        "component_key",
        *keep,
    )
