"""N-gram Jaccard join with a prefix tree.

A document is the set of its word shingles. Shingles are ordered globally:
rare ones first, by counts of all documents kept in a table of hashed slots,
then by hash. Two similar sets share a shingle of their prefixes, so the
prefix rows (hash, set, nothing else) are grouped by shingle; the first set
of a group leads it, and the sets led by one leader are a cluster. Any two
sets that share a prefix shingle are in a cluster together.

Sets of a cluster are first compared by size and by a bitmap of two to four
bits a shingle: each shingle flips one bit, so two bitmaps differ in at most
as many bits as the sets differ in shingles. Pairs that this bound excludes
cannot be similar. What is left joins clusters to families, whose sets are fetched
once.

In a family the sets are kept in a prefix tree in the family's own order,
frequent shingles first, so that similar sets share paths. A probe walks the
tree with the overlap gathered so far. A subtree is left out if its longest
remaining path cannot bring the overlap up to what its smallest set needs,
if its sizes cannot fit, or if all its sets are in the probe's component
already. Families above ``block_sets`` are split; sets that are not linked
to the family's first set then meet every block.

Equal sets are one set throughout. Only the sets of families are ever moved;
the texts never are.

Defined results: words are split at ASCII white space, A-Z in lower case;
null and empty texts have no shingles and are linked with nothing; repeated
rows have equal sets and are linked; a null id is replaced by a hash of the
text and linked like others; texts of any length are compared whole; empty
tables give no rows; further columns are ignored, or kept by
:func:`first_of_groups`.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lossgrain.llm.common import attach, fresh, hand_back, pin
from lossgrain.llm.components import components


LEAST_BITS = 1024


class _WordHashes(dict):
    """Word to 64-bit hash, of bounded size."""

    def __missing__(self, word):
        import xxhash

        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(raw: bytes, words: int, memory: dict) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    found = raw.lower().split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memory.__getitem__, found), np.uint64, n)
    k = min(n, words)
    total = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i:n - k + 1 + i]
    total += np.uint64(k)
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(total ^ (total >> np.uint64(29)))


def set_id(members: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(a: int, b: int, percent: int) -> int:
    """Least intersection of two sets that are similar: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def bit_count(n: int) -> int:
    """Bits of the bitmap of a set of ``n`` shingles, a power of two."""
    return max(LEAST_BITS, 1 << (2 * n - 1).bit_length())


def folded(members: np.ndarray) -> np.ndarray:
    """Bitmap of a set as 64-bit words: each member flips one bit."""
    bits = bit_count(len(members))
    flips = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def _sets(batches, words, memory):
    """Batches of ``(k, raw)`` as (row, key, shingles)."""
    for batch in batches:
        keys = batch.column(0).to_pylist()
        for key, raw in zip(keys, batch.column(1)):
            yield key, shingles(raw.as_buffer().to_pybytes() if raw.is_valid else b"", words, memory)


def _facts(rows: DataFrame, words: int, slot_bits: int) -> DataFrame:
    """Per row ``k, n, sid, bits``; and, told by a filled ``slot``, counts of shingles by slot."""
    schema = "k bigint, n bigint, sid bigint, slot int, amount bigint, bits binary"
    names = ["k", "n", "sid", "slot", "amount", "bits"]

    def measured(batches):
        memory, seen = _WordHashes(), set()
        amounts = np.zeros(1 << slot_bits, np.int64)
        out = []

        def batch_of(columns):
            kinds = [pa.int64()] * 3 + [pa.int32(), pa.int64(), pa.binary()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for key, members in _sets(batches, words, memory):
            sid = set_id(members) if len(members) else None
            out.append((key, len(members), sid, None, None, folded(members).tobytes() if sid is not None else None))
            if sid is not None and sid not in seen:
                seen.add(sid)
                np.add.at(amounts, (members >> np.uint64(64 - slot_bits)).astype(np.int64), 1)
            if len(out) >= 20_000:
                yield batch_of(zip(*out))
                out = []
        if out:
            yield batch_of(zip(*out))
        used = np.flatnonzero(amounts)
        for at in range(0, len(used), 100_000):
            slots = used[at:at + 100_000]
            none = [None] * len(slots)
            yield batch_of((none, none, none, slots.astype(np.int32), amounts[slots], none))
        del memory, seen, amounts, used
        hand_back()

    return pin(rows.mapInArrow(measured, schema))


def _prefix_rows(rows: DataFrame, words: int, percent: int, amounts, slot_bits: int) -> DataFrame:
    schema = "shingle bigint, sid bigint"

    def prefixes(batches):
        memory, seen, table = _WordHashes(), set(), amounts.value
        tokens, owners, held = [], [], 0

        def batch_of():
            return pa.record_batch([pa.array(np.concatenate(tokens).view(np.int64)),
                                    pa.array(np.concatenate(owners))], ["shingle", "sid"])

        for _, members in _sets(batches, words, memory):
            n = len(members)
            if not n:
                continue
            sid = set_id(members)
            if sid in seen:
                continue
            seen.add(sid)
            first = n - -(-percent * n // 100) + 1
            rank = np.argsort(table[(members >> np.uint64(64 - slot_bits)).astype(np.int64)], kind="stable")
            tokens.append(members[rank[:first]])
            owners.append(np.full(first, sid, np.int64))
            held += first
            if held > 200_000:
                yield batch_of()
                tokens, owners, held = [], [], 0
        if held:
            yield batch_of()
        hand_back()

    return rows.mapInArrow(prefixes, schema)


def _leaders(prefix_rows: DataFrame) -> DataFrame:
    """``leader, sid``: each group's members with its smallest set, the leader itself left out.

    Groups stream through a task in order, so a group of any size takes no memory.
    """

    def led(batches):
        shingle, leader = None, None
        for batch in batches:
            tokens, sids = (batch.column(i).to_numpy() for i in range(2))
            if not len(tokens):
                continue
            starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            lead = np.repeat(sids[starts], np.diff(np.append(starts, len(tokens))))
            if tokens[0] == shingle:
                lead[:starts[1] if len(starts) > 1 else len(tokens)] = leader
            shingle, leader = tokens[-1], lead[-1]
            other = sids != lead
            if other.any():
                pairs = np.unique(np.stack([lead[other], sids[other]], 1), axis=0)
                yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())],
                                      ["leader", "sid"])

    ordered = prefix_rows.repartition("shingle").sortWithinPartitions("shingle", "sid")
    return pin(ordered.mapInArrow(led, "leader bigint, sid bigint").distinct())


def may_link(sizes: np.ndarray, bitmaps: list[np.ndarray], percent: int) -> np.ndarray:
    """For sets in order of size: number of the first set each is joined to by pairs that may be similar."""
    count = len(sizes)
    root = np.arange(count)
    upto = np.searchsorted(sizes * percent, sizes * 100, side="right")
    table, width, first = None, 0, 0
    for i in range(count - 1):
        if len(bitmaps[i]) != width:
            # Larger sets have longer bitmaps; folding in halves brings them to the width of this one.
            width, first = len(bitmaps[i]), i
            rows = []
            for b in bitmaps[i:]:
                while len(b) > width:
                    b = b[:len(b) // 2] ^ b[len(b) // 2:]
                rows.append(b)
            table = np.stack(rows)
        j = np.arange(i + 1, upto[i])
        j = j[root[j] != root[i]]
        if not len(j):
            continue
        differ = np.bitwise_count(table[j - first] ^ bitmaps[i]).sum(axis=1, dtype=np.int64)
        both = sizes[j] + sizes[i]
        close = j[differ <= both - 2 * -(-percent * both // (100 + percent))]
        if len(close):
            joined = np.unique(np.append(root[close], root[i]))
            root[np.isin(root, joined)] = joined[0]
    return root


def _families(leaders: DataFrame, per_set: DataFrame, percent: int, largest: int = 2000) -> DataFrame:
    """``node, root``: the sets that may be similar to another one, by family.

    Clusters stream through a task; one of more than ``largest`` sets is kept
    whole as soon as it has grown so far.
    """

    def joined(batches):
        leader, whole, held = None, False, []  # held: (sid, n, bits) of the cluster

        def edges():
            nonlocal held, whole
            sids = np.array([h[0] for h in held], np.int64)
            whole = whole or len(held) > largest
            if whole:
                roots = np.full(len(sids), leader, np.int64)
            else:
                roots = sids[may_link(np.array([h[1] for h in held], np.int64),
                                      [np.frombuffer(h[2], np.uint64) for h in held], percent)]
            held = []
            apart = roots != sids
            if apart.any():
                yield pa.record_batch([pa.array(roots[apart]), pa.array(sids[apart])], ["a", "b"])

        for batch in batches:
            for head, *row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if head != leader:
                    if held:
                        yield from edges()
                    leader, whole = head, False
                held.append(row)
                if len(held) > largest:
                    yield from edges()
        if held:
            yield from edges()

    members = leaders.unionByName(leaders.select("leader", F.col("leader").alias("sid")).distinct())
    rows = members.join(per_set.select("sid", "n", "bits"), "sid").select("leader", "sid", "n", "bits")
    ordered = rows.repartition("leader").sortWithinPartitions("leader", "n", "sid")
    return components(pin(ordered.mapInArrow(joined, "a bigint, b bigint")))


class _Node:
    __slots__ = ("depth", "segment", "children", "ends", "least", "most", "longest", "first", "uniform", "one")

    def __init__(self, depth, segment):
        self.depth, self.segment, self.children, self.ends = depth, segment, [], []


class PrefixTree:
    """Sets over local numbers, each a path; a node holds a stretch that all its sets share."""

    def __init__(self, paths: list[np.ndarray], sizes: list[int]):
        self.root = _Node(0, np.zeros(0, np.int64))
        order = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u4").tobytes())
        spine, last = [self.root], None
        for i in order:
            path = paths[i]
            shared = 0
            if last is not None:
                m = min(len(path), len(last))
                differ = np.flatnonzero(path[:m] != last[:m])
                shared = int(differ[0]) if len(differ) else m
            while len(spine) > 1 and spine[-1].depth >= shared:
                spine.pop()
            top = spine[-1]
            end = top.depth + len(top.segment)
            if end > shared:  # split the node where the paths part
                lower = _Node(shared, top.segment[shared - top.depth:])
                lower.children, lower.ends = top.children, top.ends
                top.segment = top.segment[:shared - top.depth]
                top.children, top.ends = [lower], []
            if len(path) > shared:
                node = _Node(shared, path[shared:])
                top.children.append(node)
                spine.append(node)
                top = node
            top.ends.append(i)
            last = path
        self._summarise(paths, sizes)

    def _summarise(self, paths, sizes):
        todo, done = [self.root], []
        while todo:
            node = todo.pop()
            done.append(node)
            todo += node.children
        for node in reversed(done):
            below = [(sizes[i], sizes[i], len(paths[i]), i, i) for i in node.ends]
            below += [(c.least, c.most, c.longest, c.first, c.one) for c in node.children]
            node.least, node.most = min(x[0] for x in below), max(x[1] for x in below)
            node.longest, node.first, node.one = max(x[2] for x in below), min(x[3] for x in below), below[0][4]
            node.uniform = len(below) == 1 and (bool(node.ends) or node.children[0].uniform)


def link_sets(members: list[np.ndarray], percent: int, probes: int | None = None) -> list[int]:
    """For each set the number of its component's first set, links being exact.

    With ``probes`` the last so many sets are compared with the others and
    among themselves, but the others are not compared with each other.
    """
    count = len(members)
    parent = list(range(count))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if count < 2:
        return parent
    sizes = [len(m) for m in members]
    everything = np.concatenate(members)
    _, inverse, frequency = np.unique(everything, return_inverse=True, return_counts=True)
    # Frequent first; what only one set has cannot be shared and leaves the paths.
    local = np.empty(len(frequency), np.int64)
    local[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency))
    shared = int((frequency > 1).sum())
    paths, at = [], 0
    for n in sizes:
        own = local[inverse[at:at + n]]
        paths.append(np.sort(own[own < shared]))
        at += n
    tree = PrefixTree(paths, sizes)
    inside = np.zeros(shared + 1, bool)
    begin = 1 if probes is None else count - probes
    for i in range(begin, count):
        path, a = paths[i], sizes[i]
        if 100 * len(path) < percent * a:  # too little of it is in any other set
            continue
        inside[path] = True
        ids = path.tolist()
        stack = [(tree.root, 0)]
        while stack:
            node, overlap = stack.pop()
            if node.first >= i or 100 * node.most < percent * a or 100 * a < percent * node.least:
                continue
            if not node.uniform and not node.ends and all(c.uniform for c in node.children):
                roots = {find(c.one) for c in node.children}
                node.uniform = len(roots) == 1
            if node.uniform and find(node.one) == find(i):
                continue
            if len(node.segment):
                overlap += int(np.count_nonzero(inside[node.segment]))
                left = len(ids) - bisect_right(ids, int(node.segment[-1]))
            else:
                left = len(ids)
            end = node.depth + len(node.segment)
            if overlap + min(left, node.longest - end) < needed(a, node.least, percent):
                continue
            for j in node.ends:
                if j < i and 100 * overlap >= percent * (a + sizes[j] - overlap):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
            for child in node.children:
                stack.append((child, overlap))
        inside[path] = False
    return [find(i) for i in range(count)]


def _cluster_sets(frame):
    frame = frame.drop_duplicates("sid").sort_values("sid", ignore_index=True)
    return frame["sid"].to_numpy(), [np.frombuffer(x, np.uint64) for x in frame["members"]]


def _links(families: DataFrame, sets: DataFrame, percent: int, block_sets: int) -> DataFrame:
    """Links ``a, b`` that span the components of every family."""
    sizes = families.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    blocks = pin(sizes.select(F.col("root").alias("leader"), "n", F.ceil(F.col("n") / block_sets).cast("int").alias("blocks")))
    members = pin(families.select(F.col("root").alias("leader"), F.col("node").alias("sid")))
    dealt = attach(members, blocks, "leader", "n").select(
        "leader", "blocks", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int").alias("block"), "sid")
    heads = blocks.where("blocks > 1").select(
        "leader", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("leader").alias("sid"))
    filled = dealt.unionByName(heads).join(sets, "sid")

    def inner(key, frame):
        import pandas as pd

        sids, members = _cluster_sets(frame)
        roots = sids[np.array(link_sets(members, percent), np.int64)] if len(sids) else sids
        head = roots[np.flatnonzero(sids == key[0])]
        return pd.DataFrame({"leader": key[0], "blocks": frame["blocks"].iloc[0], "block": key[1], "a": roots,
                             "b": sids, "apart": roots != (head[0] if len(head) else 0)})

    schema = "leader bigint, blocks int, block int, a bigint, b bigint, apart boolean"
    found = pin(filled.groupBy("leader", "block").applyInPandas(inner, schema))
    links = found.where("a <> b").select("a", "b")

    # Sets of split families that their first set does not link meet the blocks of all others.
    apart = found.where(F.col("apart") & (F.col("blocks") > 1)).select(
        "leader", "blocks", F.col("b").alias("sid"))
    if apart.isEmpty():
        return links
    counts = apart.groupBy("leader").agg(F.count(F.lit(1)).alias("n_apart"))
    part = pin(apart.join(counts, "leader").withColumn(
        "part", F.pmod(F.xxhash64("sid", F.lit(1)), F.ceil(F.col("n_apart") / block_sets)).cast("int")))
    parts = part.select("leader", "part").distinct()
    probes = part.select("leader", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                         "sid", F.lit(True).alias("probe"))
    others = dealt.join(parts, "leader").select("leader", "part", "block", "sid", F.lit(False).alias("probe"))
    meeting = probes.unionByName(others).join(sets, "sid")

    def across(key, frame):
        import pandas as pd

        frame = frame.sort_values("probe").drop_duplicates("sid", keep="last")
        kept = [_cluster_sets(frame[frame["probe"] == flag]) for flag in (False, True)]
        sids = np.concatenate([k[0] for k in kept])
        members = kept[0][1] + kept[1][1]
        roots = np.array(link_sets(members, percent, probes=len(kept[1][0])), np.int64)
        return pd.DataFrame({"a": sids[roots], "b": sids})

    more = pin(meeting.groupBy("leader", "part", "block").applyInPandas(across, "a bigint, b bigint").where("a <> b"))
    return links.unionByName(more)


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4,
           percent: int = 85, slot_bits: int = 20, block_sets: int = 1000) -> DataFrame:
    """``k, n_shingles, keeper`` per row of ``docs``.

    ``k`` is the id, or a hash of the text where that is null; ``keeper`` is
    the ``k`` of the row that stands for the component. What the driver and
    the tasks hold of the order is a table of ``2**slot_bits`` counts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.xxhash64(text)).alias("k"),
                       F.encode(F.col(text), "UTF-8").alias("raw"))
    facts = _facts(rows, words, slot_bits)
    table = facts.where(F.col("slot").isNotNull()).groupBy("slot").agg(F.sum("amount").alias("amount")).toArrow()
    amounts = np.zeros(1 << slot_bits, np.int64)
    amounts[table.column("slot").to_numpy()] = table.column("amount").to_numpy()
    order = spark.sparkContext.broadcast(amounts)
    leaders = _leaders(_prefix_rows(rows, words, percent, order, slot_bits))

    # One row of each set in a family brings the set; a table of bits says which rows to read again.
    per_set = pin(facts.where(F.col("sid").isNotNull()).groupBy("sid").agg(
        F.min("k").alias("k"), F.count(F.lit(1)).alias("n_rows"), F.max("n").alias("n"),
        F.max("bits").alias("bits")))
    families = pin(_families(leaders, per_set, percent))
    wanted = families.select(F.col("node").alias("sid"))
    bit_count = 1 << 22
    bit = F.pmod(F.xxhash64("k"), F.lit(bit_count)).cast("int")
    bits = np.zeros(bit_count, bool)
    bits[per_set.join(wanted, "sid").select(bit.alias("bit")).distinct().toArrow().column(0).to_numpy()] = True
    marked = spark.sparkContext.broadcast(np.packbits(bits))

    def fetched(batches):
        memory, seen, chosen = _WordHashes(), set(), np.unpackbits(marked.value).astype(bool)

        def selected():
            for batch in batches:
                mine = pa.array(chosen[batch.column(2).to_numpy()])
                yield batch.filter(mine)

        for _, members in _sets(selected(), words, memory):
            if not len(members):
                continue
            sid = set_id(members)
            if sid not in seen:
                seen.add(sid)
                yield pa.record_batch([pa.array([sid], pa.int64()), pa.array([members.tobytes()], pa.binary())],
                                      ["sid", "members"])

    sets = pin(rows.withColumn("bit", bit).mapInArrow(fetched, "sid bigint, members binary"))
    roots = components(_links(families, sets, percent, block_sets))

    joined = per_set.select("sid", "k", "n_rows").join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "root", F.coalesce("root", "sid"))
    keepers = joined.groupBy("root").agg(F.min("k").alias("keeper"))
    named = pin(joined.join(keepers, "root").select("sid", "n_rows", "keeper"))
    ids = attach(facts.where(F.col("slot").isNull()), named, "sid", "n_rows")
    return ids.select("k", F.col("n").alias("n_shingles"), F.coalesce("keeper", "k").alias("keeper"))


def _slot(key: str | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << 20))


def _told_apart(docs: DataFrame, doc_id: str, text: str, key: str, slot: str) -> DataFrame:
    """``docs`` with ``key``: the id, but a hash of id and text where an id has several texts, and its ``slot``."""
    own = docs.withColumn(key, F.coalesce(F.col(doc_id).cast("bigint"), F.xxhash64(text)))
    several = pin(own.groupBy(key).agg(F.min(F.xxhash64(text)).alias("low"), F.max(F.xxhash64(text)).alias("high")).where(
        "low <> high").select(key))
    out = own.withColumn(slot, _slot(key))
    if several.isEmpty():
        return out
    slots = F.broadcast(several.select(_slot(key).alias(slot)).distinct())
    near = out.join(slots, slot, "left_semi")
    apart = near.join(several, key, "left_semi").withColumn(key, F.xxhash64(key, text)).withColumn(slot, _slot(key))
    return out.join(slots, slot, "left_anti").unionByName(near.join(several, key, "left_anti")).unionByName(apart)


def first_of_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component: the one with the smallest id; all rows without shingles stay.

    Rows are told by id and text: rows with one id and several texts are
    different rows, ordered by a hash of both. Only rows that share one of
    2**20 hash slots with a removed row are shuffled; the table of these slots
    is the proven bound of what is broadcast.
    """
    key, slot = fresh(docs, "row_key", "row_slot")
    keyed = _told_apart(docs, doc_id, text, key, slot)
    found = groups(keyed, key, text, **options)
    by_key = pin(found.groupBy(F.col("k").alias(key)).agg(
        F.count_if(F.col("k") == F.col("keeper")).alias("n"), F.max("n_shingles").alias("n_shingles")))
    removed = by_key.where("n = 0").select(key)
    slots = F.broadcast(removed.select(_slot(key).alias(slot)).distinct())
    kept = keyed.join(slots, slot, "left_anti").unionByName(
        keyed.join(slots, slot, "left_semi").join(removed, key, "left_anti").select(keyed.columns))
    repeated = by_key.where("n > 1 and n_shingles > 0").select(key)
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    again = kept.join(repeated, key, "left_semi").dropDuplicates([key])
    return kept.join(repeated, key, "left_anti").unionByName(again).select(*docs.columns)
