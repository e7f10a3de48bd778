"""Near-duplicate classes by an exact Jaccard join over word shingles.

Two documents link when the Jaccard similarity of their sets of five-word
shingles is at least ``threshold`` (0.8); classes are the connected components
of the links. The join is a T-occurrence search: a partner of a set of ``n``
shingles must occur in at least ``T = ceil(threshold * n)`` of its inverted lists.

1. *Sets.* Equal sets are one class representative from here on.
2. *Occurrence filter.* Every set posts a prefix of its shingles in a fixed
   order, long enough that a partner shares ``T'`` of them (T-occurrence on the
   prefixes). A set with fewer shared prefix shingles has no partner. Postings
   are packed by task; a shingle that several sets of a task have is counted there and
   sent once, so a shingle that a third of all documents share costs one posting per task.
3. *Rare first.* Among the sets left, exact list lengths order each set's
   shingles from rare to frequent. A set whose shingles with a list of two or
   more are fewer than ``T`` drops out; for the others, two partners share one of the
   rarest ``n - T + 1``. These (short) lists connect candidates into groups.
4. *Search.* Each group is searched by DivideSkip: the longest lists of a query
   are set aside, the short ones are merged and counted, and sets that reach
   ``T - L`` are looked up in the ``L`` long lists by binary search. A pair that an
   earlier link already connects is not looked at again. Groups too large for a task are cut into
   blocks; see ``_search_groups``.

No pair is lost at any step, and no step collects a list, group or component
that has no bound: lists are only ever aggregated, groups have a bounded number of shingles per
task.

Defined results: null, empty and wordless texts have an empty set and link with
nothing; rows without an identifier keep their set size and get no class; rows
that share an identifier are each judged by their own text; a very long text is one
set of all its shingles; of sets in one class the smallest identifier names it, and of
equal identifiers the smaller set; an empty table gives an empty result; other columns
are ignored by ``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import (
    broadcast_if_small,
    column_of,
    components,
    drop_stages,
    shingle_hashes,
    shuffle_partitions,
    stage,
    text_buffers,
    whole_row,
)
from quarry.llm.tokens import give_back

NUMERATOR, DENOMINATOR = 80, 100  # the threshold, exactly
# Shingles that one search task holds at once.
BLOCK_SHINGLES = 1_000_000
# Documents whose sets, or whose postings, are made at once.
POSTED_ROWS = 1_000
PIVOTS = 32
_MERGE_COST = 0.0085  # relative cost of a binary search step, for the number of long lists


def required(n):
    """T: the least overlap of a set of ``n`` with any partner."""
    return -(-n * NUMERATOR // DENOMINATOR)


def links(overlap, n, m):
    return DENOMINATOR * overlap >= NUMERATOR * (n + m - overlap)


def _extra(n: int) -> int:
    """Prefix shingles beyond the shortest possible prefix: a tenth of the set."""
    return max(1, -(-n // 10))


def prefix_length(n: int) -> int:
    return min(n, n - required(n) + _extra(n))


def prefix_overlap(n: int) -> int:
    """T': prefix shingles that a set of ``n`` shares with any partner's prefix."""
    return _extra(required(n))


def _sets(batch: pa.RecordBatch, name: str = "text") -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, data, offsets in text_buffers(column_of(batch, name)):
        out += shingle_hashes(data, offsets)
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, POSTED_ROWS) for b in batches for at in range(0, len(b), POSTED_ROWS))


def _set_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


# ---------------------------------------------------------------- 1 and 2: sets, filter


def _set_table(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = _sets(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_id(s) for s in sets], pa.binary()),
                ],
                ["doc_id", "n", "sid"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, sid binary")


_POSTED = "bucket int, task bigint, hashes binary, owners binary, sids binary, sizes binary, counts binary"


def _post_prefixes(buckets: int):
    """Postings of the prefixes, packed by task and bucket. ``owners`` are
    places in the batch's table of sets, which one more row carries together
    with each set's number of prefix shingles that another set of the batch has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        for batch in _slices(batches):
            table: dict[bytes, np.ndarray] = {}
            sizes = []
            for s in _sets(batch):
                sid = _set_id(s)
                if len(s) and sid not in table:
                    table[sid] = s[: prefix_length(len(s))].copy()
                    sizes.append(len(s))
            if not table:
                continue
            number, serial = (part << 24) + serial, serial + 1
            prefixes = list(table.values())
            flat = np.concatenate(prefixes)
            owner = np.repeat(np.arange(len(prefixes), dtype=np.uint32), [len(p) for p in prefixes])
            order = np.argsort(flat)
            flat, owner = flat[order], owner[order]
            first = np.ones(len(flat), dtype=bool)
            np.not_equal(flat[1:], flat[:-1], out=first[1:])
            alone = first.copy()
            alone[:-1] &= first[1:]
            counts = np.bincount(owner[~alone], minlength=len(prefixes)).astype(np.uint32)
            # one posting without an owner stands for all of a shared shingle
            shared = first & ~alone
            hashes = np.concatenate([flat[alone], flat[shared]])
            owners = np.concatenate([owner[alone], np.full(int(shared.sum()), 0xFFFFFFFF, np.uint32)])
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            hashes, owners, bucket = hashes[order], owners[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            starts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]
            k = len(starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*(int(bucket[a]) for a in starts), number % buckets], pa.int32()),
                    pa.array([number] * (k + 1), pa.int64()),
                    pa.array([*(hashes[a:b].tobytes() for a, b in zip(starts, ends, strict=True)), None], pa.binary()),
                    pa.array([*(owners[a:b].tobytes() for a, b in zip(starts, ends, strict=True)), None], pa.binary()),
                    pa.array([None] * k + [b"".join(table)], pa.binary()),
                    pa.array([None] * k + [np.array(sizes, np.int64).tobytes()], pa.binary()),
                    pa.array([None] * k + [counts.tobytes()], pa.binary()),
                ],
                [f.split()[0] for f in _POSTED.split(", ")],
            )

    return run


_COUNTED = "task bigint, owners binary, sids binary, sizes binary, counts binary"


def _count_shared(group: pa.Table) -> pa.Table:
    """Per task of the bucket: the sets whose shingles another task has too, and
    how many. The tables of sets pass through."""
    group = group.combine_chunks()
    tasks = group.column("task").to_pylist()
    blobs = group.column("hashes").to_pylist()
    at = [i for i, b in enumerate(blobs) if b is not None]
    rows: list[tuple] = [
        (t, None, s, z, c)
        for t, s, z, c in zip(
            tasks, *(group.column(x).to_pylist() for x in ("sids", "sizes", "counts")), strict=True
        )
        if s is not None
    ]
    if at:
        parts = [np.frombuffer(blobs[i], np.uint64) for i in at]
        owners = group.column("owners").to_pylist()
        owner = np.concatenate([np.frombuffer(owners[i], np.uint32) for i in at])
        flat = np.concatenate(parts)
        origin = np.repeat(np.arange(len(at)), [len(p) for p in parts])
        order = np.argsort(flat, kind="stable")
        sorted_ = flat[order]
        equal = sorted_[1:] == sorted_[:-1]
        shared = np.zeros(len(flat), dtype=bool)
        shared[1:] = equal
        shared[:-1] |= equal
        # a task that counted the shingle already has no owner here
        hit = order[shared]
        hit = hit[owner[hit] != 0xFFFFFFFF]
        by_task = hit[np.argsort(origin[hit], kind="stable")]
        cuts = np.searchsorted(origin[by_task], np.arange(len(at) + 1))
        for k, i in enumerate(at):
            if cuts[k] < cuts[k + 1]:
                rows.append((tasks[i], owner[by_task[cuts[k] : cuts[k + 1]]].tobytes(), None, None, None))
    names = [f.split()[0] for f in _COUNTED.split(", ")]
    kinds = [pa.int64()] + [pa.binary()] * 4
    return pa.table([pa.array([r[j] for r in rows], kinds[j]) for j in range(5)], names=names)


def _survivors(group: pa.Table) -> pa.Table:
    """Of one task's table: the sets with enough shared prefix shingles."""
    group = group.combine_chunks()
    owners = [np.frombuffer(b, np.uint32) for b in group.column("owners").to_pylist() if b is not None]
    out: list[bytes] = []
    for sids, sizes, counts in zip(
        *(group.column(x).to_pylist() for x in ("sids", "sizes", "counts")), strict=True
    ):
        if sids is None:
            continue
        n = np.frombuffer(sizes, np.int64)
        total = np.frombuffer(counts, np.uint32).astype(np.int64)
        if owners:
            total = total + np.bincount(np.concatenate(owners), minlength=len(n))
        need = np.array([prefix_overlap(int(x)) for x in n])
        out += [sids[16 * i : 16 * i + 16] for i in np.flatnonzero(total >= need).tolist()]
    return pa.table([pa.array(out, pa.binary())], names=["sid"])


def _occurrence_filter(docs: DataFrame) -> DataFrame:
    """``sid`` of the sets that can have a partner of another set."""
    buckets = 2 * shuffle_partitions(docs.sparkSession)
    posted = docs.select("text").mapInArrow(_post_prefixes(buckets), _POSTED)
    counted = posted.groupBy("bucket").applyInArrow(_count_shared, _COUNTED)
    return counted.groupBy("task").applyInArrow(_survivors, "sid binary").distinct()


# --------------------------------------------------------------- 3: sets left, rare first


def _left_sets(docs: DataFrame, left: DataFrame) -> DataFrame:
    """``node, n, hashes`` of the sets left. ``left``: ``sid, low, node``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = _sets(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "doc_id"),
                    pa.array([_set_id(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["low", "sid", "n", "hashes"],
            )

    small = broadcast_if_small(left)
    found = docs.select("doc_id", "text").join(small, F.col("doc_id") == F.col("low"), "left_semi")
    made = found.mapInArrow(run, "low bigint, sid binary, n bigint, hashes binary")
    # the rows of an identifier may have several sets, and a set several rows
    return made.join(small, ["low", "sid"]).select("node", "n", "hashes").dropDuplicates(["node"])


def _postings(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.array(column_of(batch, "n").to_pylist(), dtype=np.int64)
            nodes = np.array(column_of(batch, "node").to_pylist(), dtype=np.int64)
            blobs = column_of(batch, "hashes").to_pylist()
            for a in range(0, len(n), 256):
                part = slice(a, a + 256)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(b"".join(blobs[part]), np.int64)),
                        pa.array(np.repeat(nodes[part], n[part])),
                        pa.array(np.repeat(n[part], n[part]).astype(np.int32)),
                    ],
                    ["hash", "node", "n"],
                )

    return sets.mapInArrow(run, "hash bigint, node bigint, n int")


def _candidate_groups(sets: DataFrame) -> DataFrame:
    """``node, cand``: sets connected through the short lists of their rarest shingles."""
    posted, p1 = stage(_postings(sets), "postings")
    lengths = posted.groupBy("hash").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    # a set's shingles are at most its words: the list per set is as long as its text
    shared = (
        posted.join(lengths, "hash")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("length", "hash"))).alias("lists"))
    )
    need = F.ceil(F.col("n") * F.lit(NUMERATOR) / F.lit(DENOMINATOR)).cast("int")
    rare = (
        shared.where(F.size("lists") >= need)
        .select("node", F.explode(F.slice("lists", F.lit(1), F.size("lists") - need + 1)).alias("s"))
        .select("node", F.col("s.hash").alias("hash"))
    )
    rare, p2 = stage(rare, "rare")
    low = rare.groupBy("hash").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("k")).where("k > 1")
    stars = rare.join(low, "hash").where("node <> low").select("node", "low").distinct()
    groups = components(stars, "node", "low").withColumnRenamed("component", "cand")
    groups, _ = stage(groups, "groups")
    drop_stages(sets.sparkSession, [p1, p2])
    return groups


# ------------------------------------------------------------------------- 4: the search


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def roots(self, of: np.ndarray) -> np.ndarray:
        """Roots of some places, whose ways there are shortened."""
        up, found = self.up, of
        while True:
            higher = up[found]
            if (higher == found).all():
                up[of] = found
                return found
            found = higher


def _merged(lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct members of ascending lists that follow one another, and in how
    many lists each is. The stable sort merges the ascending runs it finds."""
    members = np.sort(lists, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], members[1:] != members[:-1]])) if len(members) else members
    return members[first], np.diff(np.append(first, len(members)))


def divide_skip(sets: list[np.ndarray], queries: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links among ``sets`` (sorted distinct hashes) that connect what all links
    connect. With ``queries``, only pairs with at least one of those places count."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if count else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(count, dtype=np.int32), sizes)
    order = np.argsort(flat, kind="stable")
    docs = owner[order]  # the inverted lists one after the other, each ascending
    sorted_ = flat[order]
    begins = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(flat) else order
    ends = np.append(begins[1:], len(flat))
    list_of = np.empty(len(flat), dtype=np.int64)
    list_of[order] = np.repeat(np.arange(len(begins)), ends - begins)
    lengths = ends - begins
    at = np.concatenate([[0], np.cumsum(sizes)])
    forest, found = _Forest(count), []
    asked = range(count) if queries is None else queries.tolist()
    is_query = None
    if queries is not None:
        is_query = np.zeros(count, dtype=bool)
        is_query[queries] = True
    for q in asked:
        n = int(sizes[q])
        mine = list_of[at[q] : at[q + 1]]
        mine = mine[lengths[mine] > 1]
        least = required(n)
        if len(mine) < least or n == 0:
            continue
        mine = mine[np.argsort(lengths[mine], kind="stable")]
        longest = int(lengths[mine[-1]])
        far = min(int(least / (_MERGE_COST * np.log2(longest) + 1)), least - 1)
        short, long_ = mine[: len(mine) - far], mine[len(mine) - far :]
        # merge the short lists: the cost is theirs, however many sets there are
        width = lengths[short]
        shift = np.concatenate([[0], np.cumsum(width)[:-1]])
        places = np.arange(int(width.sum())) + np.repeat(begins[short] - shift, width)
        cands, times = _merged(docs[places])
        able = (times >= least - far) & (cands != q)
        able &= (sizes[cands] * DENOMINATOR >= n * NUMERATOR) & (n * DENOMINATOR >= sizes[cands] * NUMERATOR)
        # earlier sets that ask have asked for this one
        able &= (cands > q) if is_query is None else (cands > q) | ~is_query[cands]
        cands, times = cands[able].astype(np.int64), times[able]
        if len(cands):
            apart = forest.roots(cands) != forest.root(q)
            cands, times = cands[apart], times[apart]
        if not len(cands):
            continue
        overlap = times.astype(np.int64)
        for k in long_.tolist():
            members = docs[begins[k] : ends[k]]
            place = np.searchsorted(members, cands)
            overlap += members[np.minimum(place, len(members) - 1)] == cands
        for c in cands[links(overlap, n, sizes[cands])].tolist():
            a, b = forest.root(q), forest.root(c)
            if a != b:
                forest.up[max(a, b)] = min(a, b)
                found.append((q, c))
    return found


_EDGES = "a bigint, b bigint"


def _search_shard(group: pa.Table) -> pa.Table:
    """All groups or blocks of one bucket, one after the other."""
    group = group.combine_chunks()
    shards = group.column("shard").to_pylist()
    nodes = group.column("node").to_pylist()
    asks = group.column("ask").to_pylist()
    blobs = group.column("hashes")
    by_shard: dict[str, list[int]] = {}
    for i, s in enumerate(shards):
        by_shard.setdefault(s, []).append(i)
    out: list[tuple[int, int]] = []
    for members in by_shard.values():
        members.sort(key=lambda i: nodes[i])
        sets = [np.frombuffer(blobs[i].as_py(), np.uint64) for i in members]
        queries = np.flatnonzero([asks[i] for i in members])
        found = divide_skip(sets, None if len(queries) == len(members) else queries)
        out += [(nodes[members[a]], nodes[members[b]]) for a, b in found]
    give_back()
    return pa.table(
        [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"]
    )


def _run_search(rows: DataFrame, shingles: int) -> DataFrame:
    """``rows``: ``shard, node, ask, hashes``; ``shingles``: their total number."""
    buckets = max(shuffle_partitions(rows.sparkSession), -(-shingles // BLOCK_SHINGLES))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("shard"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(_search_shard, _EDGES)


def _search_groups(sets: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """Links that connect every class, as ``a, b``.

    A group with more than ``block`` shingles is cut into blocks by hash. First
    each block is searched together with a few sets of the whole group, which
    joins what most blocks have in common. Of the classes found so far the
    group's largest is settled within itself; then the sets outside it are
    searched against every block. Every pair of the group is thus either in
    one class already or in one task together.
    """
    spark = sets.sparkSession
    members, _ = stage(sets.join(groups, "node"), "members")
    sums = members.groupBy("cand").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("sets"))
    sums, _ = stage(sums.withColumn("blocks", F.ceil(F.col("all") / F.lit(block)).cast("int")), "sums")
    total = sums.agg(F.sum("all")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], _EDGES)
    placed = members.join(sums.select("cand", "blocks"), "cand").withColumn(
        "block", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("blocks"))
    )
    own = placed.select(
        F.concat_ws("/", "cand", "block").alias("shard"), "node", F.lit(True).alias("ask"), "hashes"
    )
    large = sums.where("blocks > 1").select("cand", F.col("blocks").alias("__blocks"), "sets")
    if large.isEmpty():
        found, _ = stage(_run_search(own, total), "links")
        return found

    # a few sets per group, chosen by hash without ordering the group
    picked = placed.join(large, "cand").where(
        F.pmod(F.xxhash64(F.lit(11), "node"), F.greatest(F.lit(1), (F.col("sets") / PIVOTS).cast("long"))) == 0
    )
    shared = picked.select(
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"), "cand", "block", "node", "hashes"
    ).where("to <> block")
    pivots = shared.select(F.concat_ws("/", "cand", "to").alias("shard"), "node", F.lit(True).alias("ask"), "hashes")
    first, _ = stage(_run_search(own.union(pivots), 2 * total), "links")

    so_far = components(first, "a", "b").withColumnRenamed("component", "class")
    classed, _ = stage(
        placed.join(large, "cand")
        .select("cand", "node", "n", "block", "blocks")
        .join(so_far, "node", "left")
        .select("cand", "node", "n", "block", "blocks", F.coalesce("class", "node").alias("class")),
        "classed",
    )
    largest = (
        classed.groupBy("cand", "class")
        .agg(F.count(F.lit(1)).alias("k"))
        .groupBy("cand")
        .agg(F.max_by("class", F.struct("k", "class")).alias("main"))
    )
    outside, _ = stage(classed.join(largest, "cand").where("class <> main").select("cand", "node", "n"), "outside")
    loose = outside.groupBy("cand").agg(F.sum("n").alias("loose"))
    loose = loose.withColumn("parts", F.ceil(F.col("loose") / F.lit(block)).cast("int"))
    whole = classed.join(loose, "cand").join(sets.select("node", "hashes"), "node")
    targets = whole.select(
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "cand", "block", "node", "hashes"
    ).select("cand", "part", "block", "node", F.lit(False).alias("ask"), "hashes")
    part_of = F.pmod(F.xxhash64(F.lit(13), "node"), F.col("parts"))
    asking = (
        whole.join(outside.select("node"), "node", "left_semi")
        .withColumn("part", part_of)
        .select(
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"), "cand", "part", "node", "hashes"
        )
        .select("cand", "part", F.col("to").alias("block"), "node", F.lit(True).alias("ask"), "hashes")
    )
    # a set that asks in its own block is there once, asking
    rows = (
        targets.union(asking)
        .groupBy("cand", "part", "block", "node")
        .agg(F.max("ask").alias("ask"), F.first("hashes").alias("hashes"))
        .select(F.concat_ws("/", "cand", "part", "block").alias("shard"), "node", "ask", "hashes")
    )
    second, _ = stage(_run_search(rows, 2 * total), "links")
    return first.union(second)


def _classes(docs: DataFrame, block: int) -> DataFrame:
    """``doc_id, n, sid`` of each row, and ``first``: the smallest identifier of
    its set's class and the set that has it; null for rows without a class."""
    table, _ = stage(_set_table(docs), "sets")
    nodes = (
        table.where("n > 0 and doc_id is not null").groupBy("sid").agg(F.min("doc_id").alias("low"))
    )
    # a number for each set, as an identifier may have several
    nodes, _ = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    left, p1 = stage(nodes.join(_occurrence_filter(docs), "sid"), "left")
    sets, p2 = stage(_left_sets(docs, left), "left-sets")
    found = _search_groups(sets, _candidate_groups(sets), block)
    classes, _ = stage(components(found, "a", "b"), "classes")
    drop_stages(docs.sparkSession, [p1, p2])
    own = F.struct("low", "sid")
    firsts, _ = stage(
        classes.join(nodes, "node").groupBy("component").agg(F.min(own).alias("first")), "firsts"
    )
    linked = classes.join(broadcast_if_small(firsts), "component").select("node", "first")
    labelled = nodes.join(linked, "node", "left").select("sid", F.coalesce("first", own).alias("first"))
    return table.join(labelled, "sid", "left").select(
        "doc_id", "n", "sid", F.when(F.col("doc_id").isNotNull(), F.col("first")).alias("first")
    )


def near_duplicates(docs: DataFrame, block: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``,
    the smallest identifier that links reach."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _classes(docs, block).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first.low")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _with_set_id(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sids = pa.array([_set_id(s) for s in _sets(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, sids], [*batch.schema.names, "sid"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", whole_row(docs).alias("row"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("sid", T.BinaryType())]))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, that with the smallest identifier, all
    columns. Of an identifier with several texts only the rows go whose own text
    has a near copy that stays."""
    rows = _classes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), BLOCK_SHINGLES)
    is_lost = (F.col("doc_id") != F.col("first.low")) | (F.col("sid") != F.col("first.sid"))
    judged, _ = stage(rows.select("doc_id", "sid", F.coalesce(is_lost, F.lit(False)).alias("lost")), "judged")
    lost, _ = stage(judged.where("lost").select("doc_id", "sid").distinct(), "lost")
    ids, _ = stage(lost.select("doc_id").distinct(), "lost-ids")
    all_columns = [F.col(f"`{c}`") for c in docs.columns]
    left = docs.join(broadcast_if_small(ids), "doc_id", "left_anti").select(*all_columns)
    # identifiers that lose some of their rows
    partly, _ = stage(
        judged.where("not lost").join(broadcast_if_small(ids), "doc_id", "left_semi").select("doc_id").distinct(),
        "partly-lost",
    )
    if partly.isEmpty():
        return left
    some = _with_set_id(docs.join(broadcast_if_small(partly), "doc_id", "left_semi").select(*all_columns))
    kept = some.join(broadcast_if_small(lost), ["doc_id", "sid"], "left_anti")
    return left.union(kept.select("row.*"))
