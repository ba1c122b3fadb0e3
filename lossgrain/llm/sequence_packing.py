"""Best-fit packing with swap-based local search.

Documents are cut into pieces by a public byte-level tokenizer. Only the
lengths travel on: pieces are dealt by hash into groups of bounded size, and
each group is packed by itself. A group starts from best fit in descending
order. Then pieces of the emptiest bins are moved, exchanged one for one,
two for one or one for two with pieces of other underfull bins, each step
increasing the sum of squared fills, until no step is left or no fewer bins
could hold the pieces. Ties go to the first bin or piece in the group's order.

Defined results: a null text is empty and gives one piece with the end mark;
repeated rows are packed once each; a very long text gives as many pieces as
it needs, the first one being the shorter; an empty table gives no rows;
further columns are not carried.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossgrain.llm.common import hand_back, pin

PIECE_SCHEMA = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")

#: Fixed value: the tokenizer's split pattern, letters first because they are the most frequent.
SPLIT = r" ?\p{L}++|'(?:[sdmt]|ll|ve|re)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_SPECIAL = "<|endoftext|>"


def token_ids(vocabulary: str | None = None):
    """A function from text to its ids.

    ``vocabulary`` is the path of the tokenizer's ranks; by default that of
    the public byte-level tokenizer with 50 000 ids.
    """
    import base64

    import tiktoken

    # Kept on an installed module, so a reused worker loads the vocabulary once.
    kept = tiktoken.__dict__.setdefault("_kept_for_packing", {})
    if vocabulary not in kept:
        path = vocabulary
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        kept[vocabulary] = tiktoken.Encoding(
            "packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={_SPECIAL: len(ranks)})
    coder = kept[vocabulary]

    def ids(text: str) -> list[int]:
        if _SPECIAL in text:  # the tokenizer reads its own mark as one id
            return coder.encode(text, allowed_special="all")
        return coder.encode_ordinary(text)

    return ids


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", longest: int = 1024,
           end_id: int = 2, vocabulary: str | None = None) -> DataFrame:
    """One row per piece of every document; ``start`` counts its document's ids before it."""
    names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches):
        ids_of = token_ids(vocabulary)
        for batch in batches:
            rows = []
            for one, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(words.as_py() or "")
                ids.append(end_id)
                n, ids = len(ids), np.array(ids, "<u4").tobytes()
                start, stop = 0, n % longest or longest
                piece = 0
                while start < n:
                    rows.append((one, piece, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
                    start, stop, piece = stop, stop + longest, piece + 1
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        hand_back()

    return docs.select(F.col(doc_id).cast("bigint"), F.col(text)).mapInArrow(cut, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that has room."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, []
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        open_rooms = rooms >> n
        if open_rooms:
            room = n + (open_rooms & -open_rooms).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        left = room - n
        if left:
            by_room[left].append(at)
            rooms |= 1 << left
    return bins


def _pairs(inside: list[int], size: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Every different sum of two pieces of a bin, and two pieces that have it."""
    by_size: dict[int, list[int]] = {}
    for k in inside:
        by_size.setdefault(int(size[k]), []).append(k)
    found: dict[int, tuple[int, int]] = {}
    sizes = sorted(by_size)
    for i, a in enumerate(sizes):
        if len(by_size[a]) > 1:
            found.setdefault(2 * a, (by_size[a][0], by_size[a][1]))
        for b in sizes[i + 1:]:
            found.setdefault(a + b, (by_size[a][0], by_size[b][0]))
    sums = sorted(found)
    return sums, [found[s][0] for s in sums], [found[s][1] for s in sums]


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search between underfull bins; every step increases the sum of squared fills.

    Donors are taken from the emptiest bin upwards. A step gives a receiver
    ``gain`` more tokens out of its room: a piece is moved; one piece goes
    for a shorter one; two pieces go for one; one piece goes for two. With
    fills a (receiver) and b (donor) the sum grows if a + gain > b. All
    pieces and all sums of two pieces of all underfull bins are looked at,
    and the donors are gone through again until a whole pass makes no step,
    or no fewer bins could hold the pieces.
    """
    fills = [int(lengths[b].sum()) for b in bins]
    order = sorted((i for i, f in enumerate(fills) if f < capacity), key=lambda i: fills[i])
    if len(order) < 2:
        return bins
    # All pieces of underfull bins, as arrays that a step updates in two places.
    where = np.concatenate([np.full(len(bins[i]), i) for i in order])
    item = np.concatenate([np.array(bins[i]) for i in order])
    size = lengths[item].astype(np.int64)
    fill = np.array(fills, dtype=np.int64)
    contents: dict[int, list[int]] = {i: [] for i in order}
    for k, w in enumerate(where.tolist()):
        contents[w].append(k)
    # Sums of two pieces: bin, sum, the pieces.
    twos = np.zeros((4, 0), np.int64)

    def with_pairs(changed: list[int]) -> np.ndarray:
        kept, added = twos[:, ~np.isin(twos[0], changed)], []
        for b in changed:
            if 0 < fill[b] < capacity:
                sums, first, second = _pairs(contents[b], size)
                added.append(np.array([[b] * len(sums), sums, first, second], np.int64))
        return np.concatenate([kept, *added], axis=1)

    twos = with_pairs(order)

    def shift(give: list[int], take: list[int], donor: int, to: int) -> None:
        nonlocal twos
        moved = int(size[give].sum() - size[take].sum())
        for k in give:
            contents[donor].remove(k)
            contents[to].append(k)
            where[k] = to
        for k in take:
            contents[to].remove(k)
            contents[donor].append(k)
            where[k] = donor
        fill[donor] -= moved
        fill[to] += moved
        twos = with_pairs([donor, to])

    def best(given: np.ndarray, taken: np.ndarray, bin_of: np.ndarray, donor: int) -> tuple[int, int] | None:
        """The places of the given (ascending) and the taken size with the largest allowed gain."""
        if not len(given) or not len(taken):
            return None
        at = np.searchsorted(given, taken + capacity - fill[bin_of], "right") - 1
        gain = given[np.maximum(at, 0)] - taken
        good = np.flatnonzero((at >= 0) & (gain > 0) & (fill[bin_of] + gain > fill[donor]) & (bin_of != donor))
        if not len(good):
            return None
        top = int(good[np.argmax(gain[good])])
        return int(at[top]), top

    def step(donor: int) -> bool:
        own = sorted(contents[donor], key=lambda k: size[k])
        ones = size[own]
        open_bins = np.array([b for b in order if 0 < fill[b] < capacity], np.int64)
        found = best(ones, np.zeros(len(open_bins), np.int64), open_bins, donor)
        if found:  # move
            shift([own[found[0]]], [], donor, int(open_bins[found[1]]))
            return True
        others = np.flatnonzero(fill[where] < capacity)
        found = best(ones, size[others], where[others], donor)
        if found:  # one for one
            k = int(others[found[1]])
            shift([own[found[0]]], [k], donor, int(where[k]))
            return True
        sums, first, second = _pairs(own, size)
        found = best(np.array(sums, np.int64), size[others], where[others], donor)
        if found:  # two for one
            k = int(others[found[1]])
            shift([first[found[0]], second[found[0]]], [k], donor, int(where[k]))
            return True
        found = best(ones, twos[1], twos[0], donor)
        if found:  # one for two
            to, _, a, b = twos[:, found[1]].tolist()
            shift([own[found[0]]], [a, b], donor, to)
            return True
        return False

    least = -(-int(size.sum()) // capacity)
    stepped = True
    while stepped:
        stepped = False
        for donor in sorted(order, key=lambda i: fill[i]):
            while 0 < fill[donor] < capacity and np.count_nonzero(fill[order]) > least and step(donor):
                stepped = True
    touched = set(order)
    return ([b for i, b in enumerate(bins) if i not in touched]
            + [[int(item[k]) for k in contents[i]] for i in order if contents[i]])


def pack(parts: DataFrame, capacity: int = 1024, group_rows: int = 20_000) -> DataFrame:
    """``parts`` (a stored table of pieces) with ``sequence_id`` and a gapless ``offset``.

    ``group_rows`` pieces are packed together; a group wastes about one
    sequence, so larger groups pack closer and take more memory per task.
    """
    groups = parts.count() // group_rows + 1
    schema = PIECE_SCHEMA + ", sequence_id bigint, offset bigint"

    def one_group(key, frame):
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                                  kind="stable", ignore_index=True)
        lengths = frame["length"].to_numpy()
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        sequence = np.empty(len(frame), np.int64)
        offset = np.empty(len(frame), np.int64)
        for number, inside in enumerate(bins):
            sequence[inside] = (int(key[0]) << 32) + number
            offset[inside] = np.concatenate([[0], np.cumsum(lengths[inside])[:-1]])
        frame["sequence_id"], frame["offset"] = sequence, offset
        return frame.drop(columns="pack_group")

    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    return parts.withColumn("pack_group", spread).groupBy("pack_group").applyInPandas(one_group, schema)


def pack_documents(docs: DataFrame, capacity: int = 1024, **options) -> DataFrame:
    """Pieces of every document with their places."""
    return pack(pin(pieces(docs, longest=capacity, **options)), capacity)
