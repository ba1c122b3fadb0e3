"""Prefix trie of conversations as a z-fast trie, built and searched by Spark joins.

A prefix of a conversation is told by a chained digest of its turns. The trie
is compacted: a node stands for the edge from its parent to its *extent*, the
longest prefix that all its conversations share. Nodes are hashed by their
*handle*, the prefix of the extent whose depth is the two-fattest number
(most trailing zero bits) between the depths of parent and extent. Where a
conversation leaves the trie is found by fat binary search: each step probes
one handle, so depth ``d`` takes ``log2 d`` joins.

Distinct conversations are inserted in batches. All that are waiting are
searched at once; at every point where some leave the trie, one of them for
each next turn, chosen by hash, becomes a new leaf, and edges left half-way
are split. The others wait and go on from there: the number still together
with a given one halves, or better, with every second batch, whatever the
shape of the trie. Sums over subtrees come from pointer doubling, in a
number of rounds that is the logarithm of the height.

Rows of a common prefix or parent are probes of one key against a table with
one row for it: such joins are broadcast when that table is small, and else
split by the optimizer's handling of skew. Sums are formed before the shuffle.

Defined results: turns are ordered by ``turn`` (null first), equal ones by
their digest; a null role or text is empty; rows without ``conv_id`` belong to
no conversation and are left out; an empty table has no nodes; texts are
hashed whole; a conversation is one row of 24 bytes a turn; further columns
are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrain.llm.common import pin

#: Digest of the prefix without turns.
ROOT = hashlib.sha256(b"").digest()[:16]
#: Width of the runs of ids that are joined before they are hashed in order.
ENDS = 1 << 12


def numbered_turns(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """``conv, at, turn_digest, chars``: the turns of each conversation from 0, without their texts."""
    said, by = (F.coalesce(F.col(c), F.lit("")) for c in (text, role))
    turn_digest = F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256)
    rows = chats.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), turn_digest.alias("turn_digest"),
        F.length(said).cast("long").alias("chars"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "turn_digest")
    return rows.select("conv", (F.row_number().over(order) - 1).alias("at"), "turn_digest", "chars")


def with_shared_start(turns: DataFrame, host: Column, n_shared: Column) -> DataFrame:
    """Rebuilt conversations: the first ``n_shared`` turns of ``host``, then the own turns after as many.

    Both are expressions over ``conv``. Returns ``conv, pos, turn_digest,
    chars``; a conversation without a turn has one row with null ``pos``.
    """
    numbered = pin(turns)
    wanted = pin(numbered.where("at = 0").select("conv", host.alias("host"), n_shared.cast("int").alias("h")))
    hosts = numbered.where(F.col("at") < (wanted.agg(F.max("h")).first()[0] or 0)).select(
        F.col("conv").alias("host"), "at", "turn_digest", "chars")
    first = wanted.join(hosts, "host").where("at < h").select("conv", F.col("at").alias("pos"), "turn_digest", "chars")
    counts = hosts.groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    plan = wanted.join(counts, "host", "left").select(
        "conv", "h", F.least("h", F.coalesce("n_host", F.lit(0))).cast("int").alias("taken"))
    own = numbered.join(plan, "conv").where("at >= h").select(
        "conv", (F.col("at") - F.col("h") + F.col("taken")).alias("pos"), "turn_digest", "chars")
    none = wanted.select("conv", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("turn_digest"),
                         F.lit(None).cast("long").alias("chars"))
    return first.unionByName(own).unionByName(none)


def paths(rebuilt: DataFrame) -> DataFrame:
    """``conv, length, path, cum``: digests of the prefixes of depth 1 on, and their code points from depth 0."""
    def chain(batches):
        conv, path, cum, out = None, [], [], []

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in
                 enumerate((pa.int64(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64())))],
                ["conv", "length", "path", "cum"])

        for batch in batches:
            for c, pos, turn, chars in zip(*(x.to_pylist() for x in batch.columns)):
                if c != conv:
                    if conv is not None:
                        out.append((conv, len(path), path, cum))
                    conv, path, cum = c, [], [0]
                if pos is not None:
                    before = path[-1] if path else ROOT
                    path.append(hashlib.sha256(before + bytes.fromhex(turn)).digest()[:16])
                    cum.append(cum[-1] + chars)
            if len(out) > 1000:
                yield done()
                out.clear()
        if conv is not None:
            out.append((conv, len(path), path, cum))
        yield done()

    ordered = rebuilt.select("conv", "pos", "turn_digest", "chars").repartition("conv").sortWithinPartitions("conv", "pos")
    return ordered.mapInArrow(chain, "conv bigint, length int, path array<binary>, cum array<bigint>")


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with most trailing zero bits."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1), bits))


def _node(path: Column, cum: Column, low: Column, high: Column) -> list[Column]:
    """Columns of the node of the edge (low, high] on a path."""
    root = F.lit(ROOT)
    at = lambda d: F.when(d > 0, F.element_at(path, F.greatest(d, F.lit(1)))).otherwise(root)
    fat = two_fattest(low, high)
    return [at(high).alias("node"), at(low).alias("up"), low.alias("low"), high.alias("high"),
            F.element_at(path, low + 1).alias("first"), F.element_at(path, fat).alias("handle"),
            F.slice(path, low + 1, high - low).alias("edge"), F.slice(cum, low + 1, high - low + 1).alias("edge_cum")]


def search(waiting: DataFrame, trie: DataFrame, longest: int) -> DataFrame:
    """Fat binary search of ``waiting(seq, length, path, cum, low)``: moves ``low`` to the deepest extent.

    ``low`` must be the depth of an extent on the path.
    """
    handles = trie.select(F.col("handle").alias("_handle"), F.col("high").alias("_high"),
                          F.col("low").alias("_low"), F.col("node").alias("_node"))
    state = waiting.withColumn("right", F.col("length"))
    for _ in range(max(longest, 1).bit_length()):
        going = F.col("right") > F.col("low")
        fat = F.when(going, two_fattest(F.col("low"), F.col("right")))
        # Searches that have ended probe their own id, so that they do not meet in one task.
        probed = state.withColumn("_fat", fat).withColumn(
            "_probe", F.coalesce(F.element_at("path", F.col("_fat")), F.col("seq")))
        found = probed.join(handles, (F.col("_probe") == F.col("_handle")) & F.col("_fat").isNotNull(), "left")
        met = F.col("_handle").isNotNull()
        whole = met & (F.col("_high") <= F.col("length")) & (
            F.element_at("path", F.least("_high", "length")) == F.col("_node"))
        # A handle that matches while the extent does not: the search leaves inside that edge.
        low = F.when(whole, F.col("_high")).when(met, F.col("_low")).otherwise(F.col("low"))
        right = F.when(whole, F.col("right")).when(met, F.col("_low")).when(
            F.col("_fat").isNotNull(), F.col("_fat") - 1).otherwise(F.col("right"))
        state = found.withColumns({"low": low, "right": right}).select("seq", "length", "path", "cum", "low", "right")
    return state.drop("right")


def exits(waiting: DataFrame, trie: DataFrame, longest: int) -> DataFrame:
    """Adds ``at`` (depth at which the conversation leaves the trie) and ``inside`` (the node whose edge it leaves, or null)."""
    edges = trie.select(F.col("first").alias("_first"), F.col("edge").alias("_edge"), F.col("node").alias("_node"),
                        F.col("high").alias("_high"))
    deep = search(waiting, trie, longest).withColumn(
        "_next", F.coalesce(F.get("path", F.col("low")), F.col("seq")))
    below = deep.join(edges, (F.col("_next") == F.col("_first")) & (F.col("low") < F.col("length")), "left")
    equal = F.size(F.filter(F.zip_with(
        F.col("_edge"), F.slice("path", F.col("low") + 1, F.greatest(F.least(F.size("_edge"), F.col("length") - F.col("low")), F.lit(0))),
        lambda a, b: a == b), lambda x: x))
    at = F.col("low") + F.when(F.col("_edge").isNull(), 0).otherwise(equal)
    return below.withColumn("at", at).withColumn("inside", F.when(F.col("at") < F.col("_high"), F.col("_node"))).select(
        "seq", "length", "path", "cum", "at", F.when(F.col("at") > F.col("low"), F.col("inside")).alias("inside"))


def build(sequences: DataFrame) -> DataFrame:
    """The z-fast trie of ``sequences(seq, length, path, cum)``, one row per distinct path.

    Returns ``node, up, low, high, first, handle, edge, edge_cum``, the root
    excepted. Every sequence is the extent of a node.
    """
    longest = sequences.agg(F.max("length")).first()[0] or 0
    waiting = pin(sequences.where("length > 0").withColumn("low", F.lit(0)))
    trie = None
    while trie is None or not waiting.isEmpty():
        if trie is None:
            left = waiting.select("seq", "length", "path", "cum", F.lit(0).alias("at"), F.lit(None).cast("binary").alias("inside"))
        else:
            left = exits(waiting, trie, longest)
        left = pin(left)
        going = left.where("at < length").withColumn("_next", F.element_at("path", F.col("at") + 1))
        chosen = going.groupBy("_next").agg(F.min(F.struct(F.xxhash64("seq").alias("by"), "seq")).alias("c")).select(
            F.col("c.seq").alias("seq"), F.lit(True).alias("chosen"))
        told = pin(going.drop("_next", "inside").join(chosen, "seq", "left"))
        leaves = told.where("chosen").select(*_node(F.col("path"), F.col("cum"), F.col("at"), F.col("length")))
        if trie is None:
            trie = pin(leaves)
        else:
            # Depths at which an edge is split: at most its own length of them.
            cuts = left.where("inside is not null").groupBy(F.col("inside").alias("node")).agg(
                F.array_sort(F.collect_set("at")).alias("cuts"))
            old = trie.join(cuts, "node", "left")
            bounds = F.concat(F.array("low"), F.coalesce("cuts", F.array().cast("array<int>")), F.array("high"))
            parts = old.select("*", F.posexplode(F.slice(bounds, 2, F.size(bounds) - 1)).alias("_i", "_to")).withColumn(
                "_from", F.element_at(bounds, F.col("_i") + 1))
            offset = F.col("low")
            low, high = F.col("_from") - offset, F.col("_to") - offset
            whole = [F.col(c) for c in trie.columns]
            kept = parts.where("cuts is null").select(*whole)
            pieces = parts.where("cuts is not null").select(
                F.element_at("edge", high).alias("node"),
                F.when(low > 0, F.element_at("edge", F.greatest(low, F.lit(1)))).otherwise(F.col("up")).alias("up"),
                F.col("_from").alias("low"), F.col("_to").alias("high"),
                F.element_at("edge", low + 1).alias("first"),
                F.element_at("edge", two_fattest(F.col("_from"), F.col("_to")) - offset).alias("handle"),
                F.slice("edge", low + 1, high - low).alias("edge"),
                F.slice("edge_cum", low + 1, high - low + 1).alias("edge_cum"))
            trie = pin(kept.unionByName(pieces).unionByName(leaves))
        waiting = pin(told.where("chosen is null").select("seq", "length", "path", "cum", F.col("at").alias("low")))
    return trie


def subtree_sums(nodes: DataFrame, sums: list[str], least: str) -> DataFrame:
    """``nodes(node, up, ...)`` with the columns summed (and the least taken) over each subtree, by pointer doubling."""
    state = pin(nodes.withColumn("jump", F.col("up")))
    while not state.where("jump is not null").isEmpty():
        below = state.where("jump is not null").groupBy(F.col("jump").alias("node")).agg(
            *[F.sum(c).alias(f"_{c}") for c in sums], F.min(least).alias(f"_{least}"))
        farther = state.where("jump is not null").select(F.col("node").alias("_at"), F.col("jump").alias("_jump"))
        # Nodes whose jump has ended probe their own id, so that they do not meet in one task.
        probe = F.coalesce(F.col("jump"), F.col("node"))
        moved = state.join(below, "node", "left").withColumn("_probe", probe).join(
            farther, (F.col("_probe") == F.col("_at")) & F.col("jump").isNotNull(), "left")
        state = pin(moved.withColumns(
            {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in sums}
            | {least: F.least(least, f"_{least}"), "jump": F.col("_jump")}).select(*state.columns))
    return state.drop("jump")


def ends(conversations: DataFrame) -> DataFrame:
    """``seq, ends_sha256``: digest of the ascending, comma-joined ids of the conversations that are ``seq``.

    Ids are joined in runs of ``ENDS`` first; the runs of a terminal stream
    through one task in order, as the digest asks for.
    """
    run = F.shiftright("conv", ENDS.bit_length() - 1)
    runs = conversations.groupBy("seq", run.alias("run")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def hashed(batches):
        seq, state, out = None, None, []
        for batch in batches:
            for s, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s != seq:
                    if seq is not None:
                        out.append((seq, state.hexdigest()))
                    seq, state = s, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(out) > 10_000:
                yield made(out)
                out.clear()
        if seq is not None:
            out.append((seq, state.hexdigest()))
        yield made(out)

    def made(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())],
            ["seq", "ends_sha256"])

    streamed = runs.repartition("seq").sortWithinPartitions("seq", "run").select("seq", "ids")
    return streamed.mapInArrow(hashed, "seq binary, ends_sha256 string")


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """Every distinct prefix of ``conversations(conv, length, path, cum)``, one row per depth of each edge.

    ``conv_id`` is the smallest member, ``n_convs`` counts members,
    ``n_children`` and ``n_leaves`` are those of the uncompacted trie, and
    ``saved_tokens`` sums, over the subtree, what members beyond the first
    repeat of each node's last text.
    """
    known = pin(conversations.withColumn(
        "seq", F.when(F.col("length") > 0, F.element_at("path", F.greatest("length", F.lit(1)))).otherwise(F.lit(ROOT))))
    told = known.groupBy("seq").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv_id"), F.min(F.struct("conv", "length", "path", "cum")).alias("one"))
    told = pin(told.select("seq", "n", "conv_id", "one.length", "one.path", "one.cum"))
    trie = build(told.select("seq", "length", "path", "cum"))
    root = told.agg(F.count(F.lit(1)).alias("c")).where("c > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("up"), F.lit(0).alias("low"), F.lit(0).alias("high"),
        F.array().cast("array<binary>").alias("edge"), F.array(F.lit(0).cast("long")).alias("edge_cum"))
    nodes = trie.select("node", "up", "low", "high", "edge", "edge_cum").unionByName(root)
    children = nodes.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n_below"))
    here = told.select(F.col("seq").alias("node"), "n", "conv_id",
                       (F.col("n") * F.element_at("cum", -1)).alias("said"))
    edge_chars = F.element_at("edge_cum", -1) - F.element_at("edge_cum", 1)
    start = pin(nodes.join(children, "node", "left").join(here, "node", "left").withColumns({
        "n_below": F.coalesce("n_below", F.lit(0)).cast("long"), "n": F.coalesce("n", F.lit(0)).cast("long"),
        "said": F.coalesce("said", F.lit(0)).cast("long"), "once": edge_chars,
        "leaves": F.when(F.col("n_below").isNull(), 1).otherwise(0).cast("long")}))
    summed = subtree_sums(start.select("node", "up", "n", "said", "once", "leaves", "conv_id"),
                          ["n", "said", "once", "leaves"], "conv_id")
    full = pin(start.drop("n", "said", "once", "leaves", "conv_id", "up").join(summed, "node"))
    parent = full.select(F.col("node").alias("up"), F.col("conv_id").alias("_above"))
    ended = ends(known.select("conv", "seq")).withColumnRenamed("seq", "node")
    nodes = full.where("up is not null").join(parent, "up", "left").unionByName(
        full.where("up is null").withColumn("_above", F.lit(None).cast("long")), allowMissingColumns=True)
    nodes = nodes.join(ended, "node", "left")
    steps = F.when(F.col("high") > 0, F.sequence(F.col("low") + 1, F.greatest("high", F.col("low") + 1))).otherwise(F.array(F.lit(0)))
    # Edges are expanded: a node for each depth, all with the members of the edge's end.
    rows = nodes.withColumn("depth", F.explode(steps))
    before = F.element_at("edge_cum", F.greatest(F.col("depth") - F.col("low"), F.lit(1)))
    skipped = before - F.element_at("edge_cum", 1)
    last = F.col("depth") == F.col("high")
    empty = hashlib.sha256(b"").hexdigest()
    return rows.select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > F.col("low") + 1, F.col("conv_id")).otherwise(F.col("_above")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("n_below")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("said") - F.col("n") * before - (F.col("once") - skipped)).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(empty))).otherwise(F.lit(empty)).alias("ends_sha256"))
