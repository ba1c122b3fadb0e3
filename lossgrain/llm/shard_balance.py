"""Balanced label propagation of linked documents over shards.

Links are group memberships: all rows of a group are neighbours of each
other (a pair link is a group of two), so a group costs one row per member
and never its pairs. Each round counts the members of every group by shard
and lets rows ask for the shard where most of their neighbours are; a group
that is larger than a shard asks for as many shards as it needs. Requests are
admitted under quotas: opposite requests of two shards are exchanged one for
one, then requests for unlinked rows of the target, which go the other way,
and further ones while the target has room. A last step moves rows until the
sizes are exact: at most one row apart.

Defined results: null groups link nothing; ties between shards are broken by
the group's hash, so all members break them alike; repeated rows are rows of
their own; empty tables give no rows; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lossgrain.llm.common import attach, fresh, pin, ranked


def _exchange(wanted: dict[tuple[int, int], int], room: list[int], loose: list[int]) -> tuple[dict, dict]:
    """How many requests of each (from, to) are admitted, and how many unlinked rows each (from, to) gives."""
    admitted = {k: min(n, wanted.get((k[1], k[0]), 0)) for k, n in wanted.items()}
    given: dict[tuple[int, int], int] = {}
    for (a, b), n in sorted(wanted.items(), key=lambda kv: (-kv[1], kv[0])):
        swap = min(n - admitted[a, b], loose[b])
        if swap:
            given[b, a] = swap
            loose[b] -= swap
            admitted[a, b] += swap
        more = max(0, min(n - admitted[a, b], room[b]))
        admitted[a, b] += more
        room[b] -= more
        room[a] += more
    return admitted, given


def balance(rows: DataFrame, group: str, shards: int = 16, rounds: int = 6, slack: float = 0.02,
            spread: int = 64) -> DataFrame:
    """``rows`` with a column ``shard`` in [0, shards); sizes differ by one row at most.

    ``slack`` is the share by which a shard may exceed its quota between
    rounds. Per round the driver sees shards x shards numbers.
    """
    rid, key, shard, target, size, prefs, rank = fresh(
        rows, "rid", "link", "shard", "target", "link_size", "link_prefs", "rank")
    base = pin(rows.withColumn(rid, F.monotonically_increasing_id())
               .withColumn(key, F.col(group)))
    total = base.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    groups = base.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(size)).where(F.col(size) > 1)
    first = attach(base.select(rid, key), pin(groups), key, size)
    state = pin(first.withColumn(shard, F.pmod(F.xxhash64(rid), F.lit(shards)).cast("int")))
    linked = F.col(size).isNotNull()

    def by_shard() -> tuple[list[int], list[int]]:
        sizes, loose = [0] * shards, [0] * shards
        for r in state.groupBy(shard).agg(F.count(F.lit(1)), F.count(F.when(~linked, 1))).collect():
            sizes[r[0]], loose[r[0]] = r[1], r[2]
        return sizes, loose

    for number in range(rounds):
        sizes, loose = by_shard()
        room = [int(q * (1 + slack)) - n for q, n in zip(quota, sizes)]
        # Shards with neither room nor unlinked rows can be left or kept, but not asked for.
        open_ = F.array(*[F.lit(int(r > 0 or u > 0)) for r, u in zip(room, loose)])
        counts = F.array(*[F.count(F.when(F.col(shard) == s, 1)) for s in range(shards)])
        tally = state.where(linked).groupBy(key).agg(F.first(size).alias("n"), counts.alias(prefs))
        liked = tally.select(key, "n", F.transform(F.array_sort(F.transform(
            F.col(prefs), lambda n, s: F.struct(
                (-n).alias("n"), F.pmod(F.xxhash64(F.col(key)) + s, F.lit(shards)).alias("turn"), s.alias("s")))),
            lambda x: x["s"]).alias(prefs))
        asked = pin(attach(state, pin(liked), key, "n").drop("n"))
        choices = F.slice(F.filter(F.col(prefs), lambda s: F.get(open_, s) == 1), 1,
                          F.ceil(F.col(size) / max(quota[-1], 1)).cast("int"))
        choice = F.get(choices, F.pmod(F.xxhash64(rid, F.lit(number)), F.greatest(F.size(choices), F.lit(1))).cast("int"))
        moves = asked.where(linked).withColumn(target, choice).where(
            (F.array_position(prefs, F.col(shard)) > F.array_position(prefs, F.col(target)))
            & ~F.array_contains(choices, F.col(shard))).select(rid, shard, size, target)
        moves = pin(moves)
        wanted = {(r[0], r[1]): r[2] for r in moves.groupBy(shard, target).count().collect()}
        admitted, given = _exchange(wanted, room, loose)
        moved = sum(admitted.values())
        if not moved:
            break
        pair, = fresh(moves, "pair")
        limits = F.create_map(*[F.lit(x) for (a, b), n in sorted(admitted.items()) for x in (a * shards + b, n)])
        # Members of large groups go first.
        level = F.least(F.floor(F.log2(F.col(size))), F.lit(40)).cast("int")
        order_no = ranked(
            moves.withColumn(pair, F.col(shard) * shards + F.col(target)), pair, [F.col(rid)], rank,
            (40 - level) * spread + F.pmod(F.xxhash64(rid), F.lit(spread)).cast("int"), 41 * spread)
        passed = order_no.where(F.col(rank) < F.element_at(limits, F.col(pair))).select(rid, target)
        if given:
            loose_rows = ranked(
                asked.where(~linked & F.col(shard).isin(sorted({b for b, _ in given}))).select(rid, shard),
                shard, [F.col(rid)], rank, F.pmod(F.xxhash64(rid), F.lit(16 * spread)).cast("int"), 16 * spread)
            going, upto = None, [0] * shards
            for (b, a), n in sorted(given.items()):
                upto[b] += n
                fits = (F.col(shard) == b) & (F.col(rank) < upto[b])
                going = F.when(fits, F.lit(a)) if going is None else going.when(fits, F.lit(a))
            passed = passed.unionByName(loose_rows.select(rid, going.cast("int").alias(target)).where(
                F.col(target).isNotNull()))
        state = pin(asked.drop(prefs).join(passed, rid, "left").withColumn(
            shard, F.coalesce(F.col(target), F.col(shard)).cast("int")).drop(target))
        if moved * 1000 < total:
            break

    sizes, _ = by_shard()
    surplus = [max(0, n - q) for n, q in zip(sizes, quota)]
    if any(surplus):
        # Unlinked rows leave first, then rows of small groups; deficits are filled in shard order.
        starts, at = [], 0
        for n in surplus:
            starts.append(at)
            at += n
        level = F.when(linked, F.least(F.floor(F.log2(F.col(size))), F.lit(40)) + 1).otherwise(0).cast("int")
        order_no = ranked(
            state.where(F.element_at(F.array(*[F.lit(n) for n in surplus]), F.col(shard) + 1) > 0),
            shard, [F.col(rid)], rank,
            level * spread + F.pmod(F.xxhash64(rid), F.lit(spread)).cast("int"), 42 * spread)
        leaving = order_no.where(
            F.col(rank) < F.element_at(F.array(*[F.lit(n) for n in surplus]), F.col(shard) + 1))
        place = F.element_at(F.array(*[F.lit(n) for n in starts]), F.col(shard) + 1) + F.col(rank)
        to, filled = F.lit(None).cast("int"), 0
        choice = None
        for s in range(shards):
            gap = max(0, quota[s] - sizes[s])
            if gap:
                filled += gap
                choice = (F.when(place < filled, F.lit(s)) if choice is None
                          else choice.when(place < filled, F.lit(s)))
        to = choice if choice is not None else to
        state = state.join(leaving.select(rid, to.alias(target)), rid, "left").withColumn(
            shard, F.coalesce(F.col(target), F.col(shard)).cast("int")).drop(target)
    return base.drop(key).join(state.select(rid, shard), rid).drop(rid).withColumnRenamed(shard, "shard")
