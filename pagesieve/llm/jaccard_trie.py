"""N-gram Jaccard join with prefix trees, and its groups.

Every text is the set of its word n-grams, as 64-bit numbers in ascending order.

1. Texts with the same set are folded into one.
2. Candidates, without a pair being emitted: sets that can be linked differ in at
   most ``k`` members, which follows from their sizes. If the range of numbers is
   cut into more than ``k`` parts, two such sets have a part with equal members. So a
   set is known by the hash of its members in each part, and sets with an equal part
   are tied to the smallest of them. A part holds several n-grams, so sharing a line
   or a passage ties nobody. Sizes are classed so that linked sets are in the same
   class or in neighbouring ones. The most frequent n-grams (a common line in short
   texts) are left out of the parts: without them two sets differ in no more members.
   Parts that are empty in both sets say nothing. Some more parts than ``k + 1`` are
   made, and a set with more empty parts than that is known by parts with all its
   n-grams as well, and if those are empty, by their being so. Equal parts are tied
   within tasks first, so a part that a third of all sets share is one entry per task.
   As at most ``k`` parts differ, a set that is linked has as many equal parts as there
   are parts beyond ``k``, less its empty ones. A set that meets fewer, with whomever,
   is linked with nothing and goes. It may have held a group together, so what is left
   of large groups is tied once more.
3. Each candidate set is sent whole, once, to the task of its candidate group. There
   the sets are stored in a prefix tree and each walks it: members shared by
   many sets are compared once, and a subtree is left when what remains of either
   side is too short for the similarity, or when all its sets are linked with the
   set already.
4. A candidate group of more than ``BLOCK`` sets is cut into blocks, each joined by a
   few sets common to all. Mostly these are one linked group afterwards; what is
   not in its largest part is then compared, block by block, with all of it.
   No task holds more than two blocks, and no link is missed.

Cases: null or empty text, or one without words: empty set, linked with nothing, its
component is its own id. Rows with equal ids are judged by their texts; a null id
takes part, and is the component only if no other id is in it. Repeated rows share
a set. Columns besides id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import wide_join
from ..session import work_path
from . import words as W
from .components import components

HASH_BITS = 58
CHUNK_PARTS = 500_000
CHUNK_MEMBERS = 500_000
COMMON_SLOTS = 1 << 22
COMMON_MEMBERS = 1 << 18
COMMON_IN_CHUNK = 2
BUCKET_PARTS = 250_000
BLOCK = 128
LEADERS = 8
GROUP_SETS = 128
_NO_ID = -(1 << 63)


class Sets:
    """Texts to n-gram sets; one per task."""

    def __init__(self, width: int):
        self.width, self._words = width, W.word_hashes()

    def of(self, text: str | None) -> np.ndarray:
        """Ascending numbers below 2^58."""
        return np.unique(W.shingles(self._words.of(text), self.width) >> np.uint64(64 - HASH_BITS))


def least_overlap(n: int, m: int, percent: int) -> int:
    """Common members that sets of ``n`` and ``m`` members need."""
    return -(-percent * (n + m) // (100 + percent))


class Parts:
    """Hashes of a set's parts; one per task."""

    def __init__(self, percent: int, common: bytes):
        self.percent = percent
        self._common = np.unpackbits(np.frombuffer(common, np.uint8)).astype(bool)
        self._starts = [1]  # of size classes
        self._edges: dict[int, tuple[np.ndarray, int]] = {}

    def size_class(self, n: int) -> int:
        while self._starts[-1] <= n:
            self._starts.append(self._starts[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self._starts, n, side="right")) - 1

    def _cut(self, c: int) -> tuple[np.ndarray, int]:
        """Where parts begin when a set of class ``c`` meets one that is not smaller, and how many may be empty."""
        if c not in self._edges:
            self.size_class(self._starts[-1] if c + 1 >= len(self._starts) else 1)
            n = self._starts[c + 1] - 1
            k = (100 - self.percent) * (n + n * 100 // self.percent) // (100 + self.percent)
            spare = 3 + (k + 1) // 10
            m = k + 1 + spare
            edges = np.array([i * (1 << HASH_BITS) // m for i in range(m)], np.uint64)
            self._edges[c] = (edges, spare)
        return self._edges[c]

    def of(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
        """All part hashes of a set that is not empty: as the smaller and as the larger side.

        Also the view each belongs to, and how many equal parts a link needs in a view.
        """
        own, out, views, needs = self.size_class(len(members)), [], [], {}
        rare = members[~self._common[members & np.uint64(COMMON_SLOTS - 1)]]
        for larger, c in enumerate((own, own - 1) if own else (own,)):
            edges, spare = self._cut(c)
            for turn, used in enumerate((rare, members)):
                at = np.searchsorted(used, edges)
                filled = np.diff(at, append=len(used)) > 0
                salt = W.mix((np.arange(len(edges), dtype=np.uint64) << np.uint64(8)) ^ np.uint64(c << 40 | turn))
                empty = len(edges) - int(filled.sum())
                if filled.any():
                    out.append(W.mix(np.add.reduceat(W.mix(used), at[filled]) ^ salt[filled]))
                    views.append(np.full(len(out[-1]), 2 * larger + turn, np.uint8))
                    needs[2 * larger + turn] = max(1, 1 + spare - empty)
                if empty <= spare:
                    break
            else:
                out.append(W.mix(~salt[~filled]))
                views.append(np.full(len(out[-1]), 2 * larger + 1, np.uint8))
                needs[2 * larger + 1] = 1
        return np.concatenate(out), np.concatenate(views), needs


class _Node:
    __slots__ = ("run", "children", "leaves", "least", "most", "one", "uniform")

    def __init__(self, run: np.ndarray, size: int, member: int):
        self.run, self.children, self.leaves = run, {}, []
        self.least = self.most = size
        self.one, self.uniform = member, True  # any set below; whether all below are linked


class Forest:
    """Union-find over sets in a unit."""

    def __init__(self, n: int):
        self._up = list(range(n))

    def find(self, i: int) -> int:
        while self._up[i] != i:
            self._up[i] = i = self._up[self._up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self._up[max(i, j)] = min(i, j)
        return i != j


def tree_links(sets: Sequence[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all linked sets, as pairs of indexes. Empty sets have none.

    Walking a set down the tree, ``used`` of the set's members are passed,
    ``depth`` is the length of the path and ``common`` what both share so far.
    """
    root, forest, links = _Node(np.zeros(0, np.uint64), 0, 0), Forest(len(sets)), []
    root.least, root.most = 1 << 60, 0

    def walk(me: int, mine: np.ndarray) -> None:
        n = len(mine)
        todo = [(root, 0, 0, 0)]
        while todo:
            node, used, depth, common = todo.pop()
            if node is not root and node.uniform and forest.find(node.one) == forest.find(me):
                continue
            if len(node.run):
                place = np.searchsorted(mine[used:], node.run)
                inside = place < n - used
                common += int((mine[used:][place[inside]] == node.run[inside]).sum())
                last = int(place[-1])
                used += last + int(last < n - used and mine[used + last] == node.run[-1])
                depth += len(node.run)
            if common + node.most - depth < least_overlap(n, node.most, percent) or \
                    common + n - used < least_overlap(n, node.least, percent):
                continue
            for other in node.leaves:
                if common >= least_overlap(n, len(sets[other]), percent) and forest.join(me, other):
                    links.append((other, me))
            own = node.children.get(int(mine[used])) if used < n else None
            todo.extend((c, used, depth, common) for c in node.children.values() if c is not own)
            if own is not None:  # likeliest, so first
                todo.append((own, used, depth, common))

    def insert(me: int, mine: np.ndarray) -> None:
        node, at = root, 0
        while True:
            node.uniform = node.uniform and (node is root or forest.find(node.one) == forest.find(me))
            node.least, node.most = min(node.least, len(mine)), max(node.most, len(mine))
            if at == len(mine):
                node.leaves.append(me)
                return
            child = node.children.get(int(mine[at]))
            if child is None:
                new = _Node(mine[at:], len(mine), me)
                new.leaves.append(me)
                node.children[int(mine[at])] = new
                return
            k = min(len(child.run), len(mine) - at)
            differs = np.flatnonzero(child.run[:k] != mine[at:at + k])
            k = int(differs[0]) if len(differs) else k
            if k < len(child.run):  # part of the run is shared: cut it in two
                upper = _Node(child.run[:k], len(mine), child.one)
                upper.least, upper.most, upper.uniform = child.least, child.most, child.uniform
                upper.children[int(child.run[k])] = child
                node.children[int(mine[at])] = upper
                child.run = child.run[k:]
                child = upper
            node, at = child, at + k

    for me in sorted((i for i in range(len(sets)) if len(sets[i])), key=lambda i: (len(sets[i]), i)):
        walk(me, sets[me])
        insert(me, sets[me])
    return links


def stored_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> tuple[DataFrame, DataFrame]:
    """``key, n, sid`` of every text's set, and ``member, n``: how many sets have a member.

    Counts cover all texts; a member met once in a chunk of texts is left out
    of the chunk's counts.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["key", "n", "sid", "member"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held, size = Sets(width), [], 0

        def counts(id_kind: pa.DataType) -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= COMMON_IN_CHUNK
            k = int(many.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(k, id_kind), pa.array(n[many]), pa.nulls(k, pa.int64()),
                 pa.array(W.as_signed(values[many]))], names=names)

        for batch in batches:
            sizes, ids = [], []
            for text in batch.column(1).to_pylist():
                s = sets.of(text)
                sizes.append(len(s))
                ids.append(identity(s))
                held.append(s)
                size += len(s)
                if size >= CHUNK_MEMBERS:
                    yield counts(batch.column(0).type)
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()),
                 pa.nulls(batch.num_rows, pa.int64())], names=names)
        if held:
            yield counts(batch.column(0).type)

    path = work_path(docs.sparkSession, "sets")
    docs.select(id_col, text_col).mapInArrow(
        made, f"key {id_type}, n bigint, sid bigint, member bigint").write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    return rows.where("member is null").drop("member"), rows.where("member is not null").groupBy("member").agg(
        F.sum("n").alias("n"))


def common_members(counts: DataFrame) -> bytes:
    """A bit table of fixed size: the most frequent members, at most ``COMMON_MEMBERS``.

    Which ones are in it decides how much work is done, not what is found.
    """
    path = work_path(counts.sparkSession, "common")
    counts.withColumn("rank", F.floor(F.log2("n")).cast("int")).write.parquet(path)
    counts = counts.sparkSession.read.parquet(path)
    least, total = 64, 0
    for row in sorted(counts.groupBy("rank").count().collect(), reverse=True):  # at most 64 rows
        total += row["count"]
        if total > COMMON_MEMBERS:
            break
        least = row["rank"]
    slots = counts.where(F.col("rank") >= least).select(
        F.expr(f"member & {COMMON_SLOTS - 1}").alias("slot")).distinct().toArrow()  # at most COMMON_MEMBERS rows
    table = np.zeros(COMMON_SLOTS, bool)
    table[slots.column("slot").to_numpy()] = True
    return np.packbits(table).tobytes()


def identity(members: np.ndarray) -> int:
    """One 64-bit number for a set: the sum of its members' hashes, and their number."""
    h = W.mix(members ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) if len(members) else np.uint64(0)
    return int(W.as_signed(W.mix(np.array([h], np.uint64) ^ np.uint64(len(members))))[0])


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(a, b)`` and how often each is there."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return a[at], b[at], np.diff(at, append=len(a))


def ties(parts: np.ndarray, sids: np.ndarray, views: np.ndarray) -> tuple[tuple, tuple, tuple]:
    """Distinct parts with their smallest set and its view; ``(set, smallest set)`` where the two
    differ; ``(set, view, parts that another set has too)``."""
    order = np.lexsort((sids, parts))
    parts, sids, views = parts[order], sids[order], views[order]
    new = np.ones(len(parts), bool)  # copies have the same set
    new[1:] = (parts[1:] != parts[:-1]) | (sids[1:] != sids[:-1])
    parts, sids, views = parts[new], sids[new], views[new]
    first = np.ones(len(parts), bool)
    first[1:] = parts[1:] != parts[:-1]
    group = np.cumsum(first) - 1
    low = sids[first][group]
    tied = low != sids
    met = np.bincount(group, minlength=1)[group] > 1
    return ((parts[first], sids[first], views[first]), distinct_pairs(sids[tied], low[tied])[:2],
            distinct_pairs(sids[met], views[met]))


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the pairs ``(a, b)``, ascending, and the smallest one each is connected with."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    forest = Forest(len(names))
    for i, j in zip(at[:len(a)].tolist(), at[len(a):].tolist(), strict=True):
        forest.join(i, j)
    return names, names[[forest.find(i) for i in range(len(names))]]


def renamed(values: np.ndarray, names: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``values`` with those in ``names`` (ascending) replaced by their ``new`` ones."""
    if not len(names):
        return values
    at = np.minimum(np.searchsorted(names, values), len(names) - 1)
    return np.where(names[at] == values, new[at], values)


def packed(keys: np.ndarray, owners: np.ndarray, views: np.ndarray, tops: np.ndarray) -> bytes:
    """Parts with their sets and views, 17 bytes each, and ``tops`` of the sets where it is another one."""
    other = np.flatnonzero(tops != owners)
    return b"".join(x.tobytes() for x in (
        np.array([len(keys)]), keys, owners, views, tops[other], other.astype(np.uint32)))


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    m = (len(data) - 8 - 17 * n) // 12
    keys, owners = np.frombuffer(data, np.uint64, n, 8), np.frombuffer(data, np.int64, n, 8 + 8 * n)
    tops = owners.copy()
    tops[np.frombuffer(data, np.uint32, m, 8 + 17 * n + 8 * m)] = np.frombuffer(data, np.int64, m, 8 + 17 * n)
    return keys, owners, np.frombuffer(data, np.uint8, n, 8 + 16 * n), tops


def candidate_edges(docs: DataFrame, text_col: str, width: int, percent: int,
                    common: bytes) -> tuple[DataFrame, DataFrame]:
    """``a, b``: edges that connect the sets that have an equal part; ``sid``: sets that may have links.

    Sets tied within a task are connected there, each with the smallest it is connected
    with, and stand for one another between tasks, where again only edges that connect
    are kept: a group has no more edges than sets in a task or bucket, however many
    parts its sets have in common. Parts go from task to task alone and are not stored.

    Equal parts of a set are counted where they are tied. One tied within a task and
    again between tasks counts twice, which keeps a set too many, never drops one.
    """
    rows = docs.count()
    shared = docs.sparkSession.sparkContext.broadcast(common)
    buckets = rows * 256 // BUCKET_PARTS + 16
    schema = pa.schema([("bucket", pa.int64()), ("data", pa.binary()), ("a", pa.int64()), ("b", pa.int64()),
                        ("view", pa.int64()), ("hits", pa.int64()), ("need", pa.int64())])

    def filled(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema],
            schema=schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, parts, held, size = Sets(width), Parts(percent, shared.value), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            needs = {(sid, view): need for sid, (_, _, own) in held for view, need in own.items()}
            yield filled(bucket=[sid % buckets for sid, _ in needs], a=[sid for sid, _ in needs],
                         view=[view for _, view in needs], hits=[0] * len(needs), need=list(needs.values()))
            (keys, owners, views), (a, b), (sids, seen, n) = ties(
                np.concatenate([p[0] for _, p in held]),
                np.repeat(np.array([s for s, _ in held], np.int64), [len(p[0]) for _, p in held]),
                np.concatenate([p[1] for _, p in held]))
            names, tops = roots(a, b)
            below = names != tops
            yield filled(bucket=names[below] % buckets, a=names[below], b=tops[below])
            yield filled(bucket=sids % buckets, a=sids, view=seen, hits=n)
            bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(cuts))
            top = renamed(owners, names, tops)
            blobs = [packed(keys[o], owners[o], views[o], top[o])
                     for o in (order[cuts[k]:cuts[k + 1]] for k in used)]
            yield filled(bucket=used, data=blobs)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                members = sets.of(text)
                if len(members):
                    held.append((identity(members), parts.of(members)))
                    size += len(held[-1][1][0])
                if size >= CHUNK_PARTS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def reduced(table: pa.Table) -> pa.Table:
        parts = table.column("data").is_valid()
        out = [table.filter(pc.invert(parts)).select(kept)]  # what is settled within tasks
        blobs = [unpacked(data) for data in table.column("data").filter(parts).to_pylist()]
        if blobs:
            keys, owners, views, tops = (np.concatenate(x) for x in zip(*blobs, strict=True))
            _, (a, b), (sids, seen, n) = ties(keys, owners, views)
            owners, first = np.unique(owners, return_index=True)
            names, low = roots(renamed(a, owners, tops[first]), renamed(b, owners, tops[first]))
            below = names != low
            out += [pa.Table.from_batches([filled(**x)]).select(kept) for x in (
                {"a": names[below], "b": low[below]}, {"a": sids, "view": seen, "hits": n})]
        return pa.concat_tables(out)

    spark, path = docs.sparkSession, work_path(docs.sparkSession, "parts")
    kept = ["a", "b", "view", "hits", "need"]
    docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(
        mapped, "bucket bigint, data binary, a bigint, b bigint, view bigint, hits bigint, need bigint",
    ).groupBy("bucket").applyInArrow(
        reduced, "a bigint, b bigint, view bigint, hits bigint, need bigint").write.parquet(path)
    rows = spark.read.parquet(path)
    able = rows.where("view is not null").groupBy("a", "view").agg(
        F.sum("hits").alias("hits"), F.max("need").alias("need")).where("hits >= need")
    return rows.where("b is not null").select("a", "b"), able.select(F.col("a").alias("sid")).distinct()


def fetched_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``wanted`` (stored, with ``key``) with the texts that have its ids."""
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("key"), F.col(text_col).alias("text"))
    return wide_join(texts, wanted, ["key"])


def verified_links(docs: DataFrame, wanted: DataFrame, units: Column, id_col: str, text_col: str, width: int,
                   percent: int) -> DataFrame:
    """``a, b``: links found in the units of ``wanted`` (stored: ``key, sid`` and what ``units`` is made of).

    A set of a large group is in as many units as the group has blocks, so they are
    listed where the set is, and only the few numbers they follow from are sent there.
    """
    rows = wanted.agg(F.sum(F.size(units))).first()[0] or 0
    groups = rows // GROUP_SETS + 1
    kept_columns = [c for c in wanted.columns if c != "key"]

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(width)
        for batch in batches:
            made = [sets.of(t) for t in batch.column("text").to_pylist()]
            right = [identity(s) == sid for s, sid in zip(made, batch.column("sid").to_pylist(), strict=True)]
            kept = batch.filter(pa.array(right, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(c) for c in kept_columns),
                 pa.array([s.tobytes() for s, ok in zip(made, right, strict=True) if ok], pa.binary())],
                names=[*kept_columns, "members"])

    def links(table: pa.Table) -> pa.Table:
        by_unit: dict[int, dict[int, np.ndarray]] = {}
        for unit, sid, data in zip(*(table.column(c).to_pylist() for c in ("unit", "sid", "members")), strict=True):
            by_unit.setdefault(unit, {})[sid] = np.frombuffer(data, np.uint64)
        found = []
        for _, sets in sorted(by_unit.items()):
            names = sorted(sets)
            found += [(names[i], names[j]) for i, j in tree_links([sets[s] for s in names], percent)]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})

    fetched = fetched_texts(docs, wanted, id_col, text_col).select(*kept_columns, "text").mapInArrow(
        members, wanted.select(*kept_columns).schema.add("members", "binary"))
    # copies with one id would come twice: a unit keeps a set once
    return fetched.select("sid", "members", F.explode(units).alias("unit")).withColumn(
        "task", F.pmod(F.xxhash64("unit"), F.lit(groups))).groupBy("task").applyInArrow(links, "a bigint, b bigint")


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                      percent: int = 80, block: int = BLOCK) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row of ``docs``.

    Two texts are linked if ``100 * common >= percent * united`` n-grams.
    """
    spark, root = docs.sparkSession, work_path(docs.sparkSession, "jaccard")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    rows, counts = stored_sets(docs, id_col, text_col, width)
    key = F.coalesce(F.col("key").cast("bigint"), F.lit(_NO_ID))
    holders = rows.where("n > 0").groupBy("sid").agg(F.min(key).alias("key"))
    common = common_members(counts)

    def grouped(texts: DataFrame, column: str, name: str) -> DataFrame:
        edges, able = candidate_edges(texts, column, width, percent, common)
        tied = components(edges).withColumnRenamed("id", "sid")
        return stored(tied.join(able, "sid", "left_semi").join(holders, "sid").select("sid", "key", "component"), name)

    members = grouped(docs, text_col, "members")
    sizes = stored(members.groupBy("component").count().where(F.col("count") > block), "sizes")
    if not sizes.isEmpty():
        again = stored(members.join(sizes, "component", "left_semi"), "again")
        once_more = grouped(fetched_texts(docs, again.select("key").distinct(), id_col, text_col), "text", "members-2")
        members = stored(members.join(sizes, "component", "left_anti").unionByName(
            once_more.join(again, "sid", "left_semi")), "members-3")

    # large candidate groups are cut into blocks that share a few leaders
    large = stored(members.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.min_by(
        "sid", F.xxhash64("sid")).alias("leader")).where(F.col("m") > block), "large")
    blocks = F.ceil(F.col("m") / block).cast("bigint")
    own = F.pmod(F.xxhash64("sid"), blocks)
    all_blocks = F.sequence(F.lit(0).cast("bigint"), blocks - 1)
    unit = lambda *parts: F.xxhash64(F.col("component"), *parts)
    placed = members.join(large, "component", "left")
    leads = F.col("m").isNotNull() & (
        (F.col("sid") == F.col("leader")) | (F.pmod(F.xxhash64("sid", F.lit("lead")), F.col("m")) < LEADERS))
    first = F.when(F.col("m").isNull(), F.array(unit())).when(
        leads, F.transform(all_blocks, lambda b: unit(b))).otherwise(F.array(unit(own)))
    wanted = stored(placed.select("key", "sid", "component", "m", "leader"), "units-1")
    links = stored(verified_links(docs, wanted, first, id_col, text_col, width, percent), "links-1")
    if not large.isEmpty():
        labels = components(links).select(F.col("id").alias("sid"), F.col("component").alias("label"))
        judged = stored(placed.where("m is not null").join(labels, "sid", "left").select(
            "component", "sid", "key", "m", F.coalesce("label", "sid").alias("label")), "judged")
        parts = judged.groupBy("component", "label").agg(F.count(F.lit(1)).alias("c"))
        main = parts.groupBy("component").agg(
            F.max_by("label", F.struct("c", "label")).alias("main"),
            (F.sum("c") - F.max("c")).cast("bigint").alias("others")).where("others > 0")
        # sets outside the largest part, in blocks of their own, meet every block
        other_blocks = F.ceil(F.col("others") / block).cast("bigint")
        mine = F.pmod(F.xxhash64("sid", F.lit("other")), other_blocks)
        with_others = F.transform(F.sequence(F.lit(0).cast("bigint"), other_blocks - 1), lambda j: unit(j, own))
        as_other = F.when(F.col("other"), F.transform(all_blocks, lambda i: unit(mine, i))).otherwise(
            F.array().cast("array<bigint>"))
        second = stored(judged.join(main, "component").select(
            "key", "sid", "component", "m", "others", (F.col("label") != F.col("main")).alias("other")), "units-2")
        if not second.isEmpty():
            units = F.array_distinct(F.concat(with_others, as_other))
            links = links.unionByName(stored(
                verified_links(docs, second, units, id_col, text_col, width, percent), "links-2"))
    linked = components(links)
    smallest = linked.join(holders, linked["id"] == holders["sid"]).groupBy("component").agg(
        F.min(F.when(F.col("key") != _NO_ID, F.col("key"))).alias("component_id"))
    of_set = linked.join(smallest, "component").select(F.col("id").alias("sid"), "component_id")
    alone = holders.join(of_set, "sid", "left").select(
        "sid", F.coalesce("component_id", F.when(F.col("key") != _NO_ID, F.col("key"))).alias("component_id"))
    return rows.join(alone, "sid", "left").select(
        F.col("key").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))
