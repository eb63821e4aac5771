"""Conversation prefix trie: balanced parentheses per shard, shared spines merged.

Every distinct sequence of first turns is a node.  Conversations are rows of
16-byte turn digests (texts never leave the scan); the distinct rows, sorted
as bytes, are the trie in depth-first order, and a range of that order is a
shard.  A shard writes its part of the trie as a sequence of parentheses.
Blocks of the sequence keep the least excess, so ``findclose`` skips whole
blocks to the end of a subtree; between a node and its end the rank of the
pairs ``()`` counts the leaves, and differences of cumulative arrays give
members and savings.

The nodes on a shard's first and last path (its spines) may go on in its
neighbours.  All others are final.  The two spines of every shard, with what
their finished branches add up to, form a far smaller table of the same
kind, which is encoded again, level by level, until one shard holds it.
Each level has at most an eighth of the rows of the one before.

Members that end in one node are listed by a SHA-256 of their ids: ids are
sorted over all tasks, joined to chunks of text there, and only the chunks
of a node meet in one task, which streams them.

Bounds: a task holds one shard (``SHARD_BYTES`` of digests, or one
conversation if that is longer); nothing goes to the driver but counts.

Defined results: a null turn sorts first, turns with equal numbers by role
and digest; a repeated row is a turn of its own; null roles and texts are
empty; rows without a conv_id take no part; remainders of negative ids are
those of the least id of their five; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from casaframe.llm.common import join_small, written

DIGEST = 16                  # bytes of a turn's digest
FAMILY = 5                   # conversations that share the turns of their first one
SHARED = 9                   # modulus of the number of shared turns
BLOCK = 64                   # parentheses of one excess block
SHARD_BYTES = 8 << 20        # digests and sizes of one shard
SPINES_PER_SHARD = 16        # least rows of a shard of spines, so that levels shrink
CHUNK_IDS = 4096             # ids of one chunk of text
NO_MEMBER = np.iinfo(np.int64).max
EMPTY_SHA = hashlib.sha256(b"").digest()
VALUES = ("ends", "convs", "least", "kids", "leaves", "saved")


class Parentheses:
    """A balanced sequence (1 opens, 0 closes) under blocks of least excess."""

    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.bits, self.block = bits, block
        self.opens = np.flatnonzero(bits)
        excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        high = np.int64(len(bits) + 1)
        pad = -len(bits) % block
        self.excess = np.concatenate((excess, np.full(pad, high)))
        level = self.excess.reshape(-1, block).min(axis=1)
        tree, self.offset, at = [], [], 0
        while True:  # the least excess of blocks, of pairs of blocks, and so on
            if len(level) > 1 and len(level) % 2:
                level = np.append(level, high)
            tree.append(level)
            self.offset.append(at)
            at += len(level)
            if len(level) == 1:
                break
            level = level.reshape(-1, 2).min(axis=1)
        self.tree, self.offset = np.concatenate(tree), np.array(self.offset)

    def _scan(self, at: np.ndarray, target: np.ndarray, found: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Walks from ``at`` to the end of its block; returns those still without a match."""
        while len(who):
            hit = self.excess[at] == target
            found[who[hit]] = at[hit]
            at, target, who = at[~hit] + 1, target[~hit], who[~hit]
            inside = at % self.block != 0
            if not inside.all():
                self.left.append(who[~inside])
                at, target, who = at[inside], target[inside], who[inside]
        return np.concatenate(self.left) if self.left else who

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        found = np.full(len(at), -1, dtype=np.int64)
        target = self.excess[at] - 1
        edge = (at + 1) % self.block == 0
        self.left = [np.flatnonzero(edge)]
        who = self._scan(at[~edge] + 1, target[~edge], found, np.flatnonzero(~edge))
        if not len(who):
            return found
        idx, k, goal = at[who] // self.block + 1, np.zeros(len(who), dtype=np.int64), target[who]
        up = np.arange(len(who))
        while len(up):  # up and right to the first range of blocks that goes down to the goal
            up = up[self.tree[self.offset[k[up]] + idx[up]] > goal[up]]
            idx[up] += 1
            rise = up[idx[up] % 2 == 0]
            idx[rise] //= 2
            k[rise] += 1
        down = np.flatnonzero(k > 0)
        while len(down):
            k[down] -= 1
            idx[down] *= 2
            idx[down] += self.tree[self.offset[k[down]] + idx[down]] > goal[down]
            down = down[k[down] > 0]
        self.left = []
        self._scan(idx * self.block, goal, found, who)
        return found


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    x = np.frombuffer(a, dtype=np.uint8, count=n) != np.frombuffer(b, dtype=np.uint8, count=n)
    return int(x.argmax()) // DIGEST


class Shard:
    """The part of the trie under sorted paths, each with values from depth ``first`` on."""

    def __init__(self, paths: list[bytes], sizes: list[bytes], first: list[int],
                 values: list[bytes], shas: list[bytes]):
        self.paths = paths
        counts, start, self.depth, self.parent = [], [], [], []
        at = np.zeros(1, dtype=np.int64)         # nodes of the current path
        own = {v: [] for v in VALUES}
        nodes, self.bytes, self.sha = 0, [], {}
        hit, keys, self.keys, before = [], [b""], [], b""
        for r, path in enumerate(paths):
            d = len(path) // DIGEST
            shared = -1 if r == 0 else _common(before, path)
            counts += [len(before) // DIGEST - shared if r else 0, d - shared]
            if len(at) <= d:
                at = np.concatenate((at, np.zeros(d + 1, dtype=np.int64)))
            new = np.arange(nodes, nodes + d - shared)
            size = np.frombuffer(sizes[r], dtype="<i8")
            self.depth.append(np.arange(shared + 1, d + 1))
            if len(new):
                self.parent.append(np.concatenate(([at[shared] if shared >= 0 else -1], new[:-1])))
                self.bytes.append(size[shared:d] if shared >= 0 else np.concatenate(([0], size)))
            at[shared + 1:d + 1] = new
            start.append(nodes)
            nodes += len(new)
            del keys[max(shared, 0) + 1:]
            for k in range(len(keys), d + 1):   # a path's key is chained from turn to turn
                keys.append(hashlib.blake2b(keys[-1] + path[(k - 1) * DIGEST:k * DIGEST],
                                            digest_size=16).digest())
            self.keys += keys[shared + 1:d + 1]
            on = at[first[r]:d + 1].copy()
            hit.append(on)
            table = np.frombuffer(values[r], dtype="<i8").reshape(len(VALUES), len(on))
            for v, row in zip(VALUES, table):
                own[v].append(row)
            for k in np.flatnonzero(table[0]):
                self.sha[int(on[k])] = shas[r][32 * k:32 * k + 32]
            before = path
        counts += [len(before) // DIGEST + 1, 0]
        self.last = at[:len(before) // DIGEST + 1].copy()
        self.n = nodes
        self.depth = np.concatenate(self.depth)
        self.parent, self.bytes = np.concatenate(self.parent), np.concatenate(self.bytes)
        on = np.concatenate(hit)
        self.own = {}
        for v in VALUES:
            got = np.concatenate(own[v])
            if v == "least":
                self.own[v] = np.full(nodes, NO_MEMBER)
                np.minimum.at(self.own[v], on, got)
            else:
                self.own[v] = np.zeros(nodes, dtype=np.int64)
                np.add.at(self.own[v], on, got)
        bits = np.repeat(np.tile(np.array([0, 1], dtype=np.int8), len(counts) // 2), counts)
        self.bp = Parentheses(bits)

    def solve(self, whole: bool) -> None:
        """Totals of every subtree; without ``whole``, those of spines leave out what is open."""
        self.spine = np.zeros(self.n, dtype=bool)
        if not whole:
            self.spine[:len(self.paths[0]) // DIGEST + 1] = True
            self.spine[self.last] = True
        opens = self.bp.opens
        close = self.bp.findclose(opens)
        end = np.arange(self.n) + (close - opens + 1) // 2   # preorder number after the subtree
        total = lambda own: (c := np.concatenate(([0], np.cumsum(own))))[end] - c[:-1]
        inner = np.flatnonzero(~self.spine & (self.parent >= 0))
        self.kids = self.own["kids"] + np.bincount(self.parent[inner], minlength=self.n)
        # pairs "()" are leaves unless finished branches hang there
        pair = np.zeros(len(self.bp.bits), dtype=np.int64)
        pair[opens] = (close == opens + 1) & (self.own["kids"] == 0) & ~self.spine
        rank = np.concatenate(([0], np.cumsum(pair)))
        self.leaves = rank[close + 1] - rank[opens] + total(self.own["leaves"])
        self.convs = total(self.own["convs"])
        saving = np.where(self.spine, 0, (self.convs - 1) * self.bytes)
        self.saved = total(saving + self.own["saved"])
        least, up, spine = self.own["least"].tolist(), self.parent.tolist(), self.spine.tolist()
        for v in range(self.n - 1, 0, -1):
            if not spine[v] and least[v] < least[up[v]]:
                least[up[v]] = least[v]
        self.least = np.array(least, dtype=np.int64)
        if not whole:  # a spine keeps what is its own: less the spines below it
            below = np.flatnonzero(self.spine)[1:]
            for a in (self.leaves, self.convs, self.saved):
                whole_of = a.copy()
                np.subtract.at(a, self.parent[below], whole_of[below])

    def final(self, level: int) -> dict[str, list]:
        v = np.flatnonzero(~self.spine)
        up = self.parent[v]
        open_up = (up >= 0) & self.spine[up]
        known = (up >= 0) & ~open_up
        return {"conv_id": self.least[v], "depth": self.depth[v],
                "parent_conv_id": pa.array(np.where(known, self.least[up], 0), mask=~known),
                "n_convs": self.convs[v], "n_children": self.kids[v], "n_leaves": self.leaves[v],
                "saved_tokens": self.saved[v],
                "sha": [self.sha.get(x, EMPTY_SHA) for x in v.tolist()],
                "key": [self.keys[x] if level else None for x in v.tolist()],
                "parent_key": [self.keys[x] if o else None
                               for x, o in zip(up.tolist(), open_up.tolist())]}

    def spines(self) -> dict[str, list]:
        """The first and the last path with their open nodes; a node is in one of them."""
        out = {c: [] for c in ("path", "sizes", "first", "vals", "shas")}
        a, b = self.paths[0], self.paths[-1]
        got = {"ends": self.own["ends"], "convs": self.convs, "least": self.least,
               "kids": self.kids, "leaves": self.leaves, "saved": self.saved}
        left = np.arange(len(a) // DIGEST + 1)
        for path, ids, first in ((a, left, 0), (b, self.last, _common(a, b) + 1)):
            if first < len(ids):
                on = ids[first:]
                out["path"].append(path)
                out["sizes"].append(self.bytes[ids[1:]].astype("<i8").tobytes())
                out["first"].append(first)
                out["vals"].append(np.stack([got[v][on] for v in VALUES]).astype("<i8").tobytes())
                out["shas"].append(b"".join(self.sha.get(x, EMPTY_SHA) for x in on.tolist()))
        return out


NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, sha binary, key binary, parent_key binary")
RECORD = "path binary, sizes binary, first int, vals binary, shas binary"


def encode(records: DataFrame, level: int, whole: bool) -> DataFrame:
    """Final nodes (``first`` null) and spines (``depth`` null) of every shard.

    ``records`` are dealt by ranges of ``path`` and sorted within them.
    """
    schema = StructType.fromDDL(f"{NODE}, {RECORD}")
    arrow = to_arrow_schema(schema)

    def table(cols: dict) -> Iterator[pa.RecordBatch]:
        n = len(next(iter(cols.values())))
        for lo in range(0, n, 8192):
            hi = min(n, lo + 8192)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[f.name][lo:hi], type=f.type) if f.name in cols
                 else pa.nulls(hi - lo, f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list] = [[], [], [], [], []]
        for batch in batches:
            for c, name in zip(cols, ("path", "sizes", "first", "vals", "shas")):
                c += batch.column(name).to_pylist()
        if cols[0]:
            shard = Shard(*cols)
            shard.solve(whole)
            yield from table(shard.final(level))
            if not whole:
                yield from table(shard.spines())

    return records.select("path", "sizes", "first", "vals", "shas").mapInArrow(run, schema)


def turns(conversations: DataFrame) -> DataFrame:
    """(family, member, conv_id, shared, turn, role, digest, size): a row per turn, no text."""
    c = F.col("conv_id")
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rest = F.pmod(c, F.lit(FAMILY))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return (conversations.withColumn("conv_id", F.col("conv_id").cast("long")).where("conv_id IS NOT NULL")
            .select(F.expr(f"conv_id div {FAMILY} - if(conv_id % {FAMILY} < 0, 1, 0)").alias("family"),
                    rest.alias("member"), "conv_id",
                    (F.crc32(c.cast("string").cast("binary")) % SHARED).cast("int").alias("shared"),
                    "turn", role.alias("role"),
                    F.unhex(F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * DIGEST)).alias("digest"),
                    F.octet_length(text).cast("long").alias("size")))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, path, sizes): every conversation behind the first turns of its family's first."""
    t = turns(conversations)
    parts = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (t.repartition(parts, "family")
             .sortWithinPartitions("family", "conv_id", F.col("turn").asc_nulls_first(), "role", "digest"))
    schema = StructType.fromDDL("conv_id long, key binary, path binary, sizes binary")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        family, head, conv = None, ([], []), None
        digests: list[bytes] = []
        sizes: list[int] = []
        member = shared = held = 0

        def close() -> None:
            if conv is None:
                return
            if member == 0:
                head[0][:], head[1][:] = digests[:SHARED], sizes[:SHARED]
                a, b = digests, sizes
            else:
                a, b = head[0][:shared] + digests[shared:], head[1][:shared] + sizes[shared:]
            path = b"".join(a)
            out.append((conv, hashlib.blake2b(path, digest_size=16).digest(), path,
                        np.array(b, dtype="<i8").tobytes()))

        for batch in batches:
            cols = batch.to_pydict()
            for f, m, c, s, d, n in zip(*(cols[k] for k in ("family", "member", "conv_id", "shared",
                                                            "digest", "size"))):
                if c != conv:
                    close()
                    held += 24 * len(digests) + 64
                    if f != family:
                        family, head = f, ([], [])
                    conv, member, shared, digests, sizes = c, m, s, [], []
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, type=k.type) for x, k in zip(zip(*out), arrow)], schema=arrow)
                        out, held = [], 0
                digests.append(d)
                sizes.append(n)
        close()
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=k.type) for x, k in zip(zip(*out), arrow)], schema=arrow)

    return dealt.select("family", "member", "conv_id", "shared", "digest", "size").mapInArrow(run, schema)


def _runs(keys: list[bytes]) -> Iterator[tuple[int, int]]:
    lo = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[lo] or i - lo >= CHUNK_IDS:
            yield lo, i
            lo = i


def members(convs: DataFrame) -> DataFrame:
    """(key, ends, least, sha): conversations that end in a node, listed by SHA-256 of their ids."""
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = (convs.select("key", "conv_id").repartitionByRange(parts, "key", "conv_id")
           .sortWithinPartitions("key", "conv_id"))
    chunk = StructType.fromDDL("key binary, low long, n long, text binary")
    sums = StructType.fromDDL("key binary, ends long, least long, sha binary")
    chunk_arrow, sums_arrow = to_arrow_schema(chunk), to_arrow_schema(sums)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            rows = [(keys[lo], at[lo], hi - lo, ",".join(map(str, at[lo:hi])).encode())
                    for lo, hi in _runs(keys)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=f.type) for x, f in zip(zip(*rows), chunk_arrow)],
                    schema=chunk_arrow)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, least, sha, rows = None, 0, 0, None, []
        for batch in batches:
            for k, low, m, text in zip(*batch.to_pydict().values()):
                if k == key:
                    sha.update(b",")
                    sha.update(text)
                    n += m
                    continue
                if key is not None:
                    rows.append((key, n, least, sha.digest()))
                key, n, least, sha = k, m, low, hashlib.sha256(text)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=f.type) for x, f in zip(zip(*rows), sums_arrow)], schema=sums_arrow)
                rows = []
        if key is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], type=f.type) for x, f in zip((key, n, least, sha.digest()), sums_arrow)],
                schema=sums_arrow)

    chunks = ids.mapInArrow(join, chunk).repartition(parts, "key").sortWithinPartitions("key", "low")
    return chunks.mapInArrow(digest, sums)


def _little(*longs: Column) -> Column:
    """Longs as little-endian bytes, one after the other."""
    return F.concat(*[F.unhex(F.concat(*[F.substring(F.lpad(F.hex(x), 16, "0"), 2 * k + 1, 2)
                                         for k in range(7, -1, -1)])) for x in longs])


def prefix_trie(conversations: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    convs = written(rebuilt(conversations), "trie_conversations")
    paths = convs.groupBy("key").agg(F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    # a path's own values stand at its end: its members, no branches yet
    zero = F.lit(0).cast("long")
    records = written(
        paths.join(members(convs), "key").select(
            "path", "sizes", F.expr(f"int(octet_length(path) / {DIGEST})").alias("first"),
            _little(F.col("ends"), F.col("ends"), F.col("least"), zero, zero, zero).alias("vals"),
            F.col("sha").alias("shas")), "trie_paths")
    done: list[DataFrame] = []
    level = 0
    while True:
        size = F.octet_length("path") + F.octet_length("sizes") + F.octet_length("vals")
        n, held = records.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
        if level == 0:
            shards = max(-(-held // shard_bytes), min(parts, n // 1024))
        else:
            shards = min(-(-held // shard_bytes), n // SPINES_PER_SHARD)
        whole = shards <= 1
        dealt = records.coalesce(1) if whole else records.repartitionByRange(shards, "path")
        out = written(encode(dealt.sortWithinPartitions("path"), level, whole), f"trie_level{level}")
        done.append(out.where("depth IS NOT NULL").select(*[f.name for f in StructType.fromDDL(NODE)]))
        if whole:
            break
        records = out.where("depth IS NULL").select("path", "sizes", "first", "vals", "shas")
        level += 1
    nodes = done[0]
    for more in done[1:]:
        nodes = nodes.unionByName(more)
    if level:  # parents on a spine were finished on a later level
        upper = done[1]
        for more in done[2:]:
            upper = upper.unionByName(more)
        upper = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
        nodes = join_small(nodes, upper, "parent_key", "left").withColumn(
            "parent_conv_id", F.coalesce("parent_conv_id", "found"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.lower(F.hex("sha")).alias("ends_sha256"))
