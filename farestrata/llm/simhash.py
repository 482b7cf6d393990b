"""Near-duplicates by SimHash: fingerprints, a binary trie self-join, connected components.

**Fingerprints.** Words of the lower-cased (A-Z) text, shingles of ``size`` words with repeats, XXH64 with seed 42 per
shingle; a bit is 1 if more than half of the hashes have it. Without words the fingerprint is zero and is linked like
any other.

**Join.** Copies collapse first: the join sees distinct fingerprints. Two fingerprints that differ in at most ``k``
bits agree in one of ``k + 1`` blocks of bits, so each fingerprint is rotated to bring one block after the other to
the front, and the nodes at the depth of a block need only be paired with themselves. Below them pairs of trie nodes are traversed
together: the bits in which the prefixes differ add up, a pair is left as soon as the sum exceeds ``k``, and else the node whose
members part first is split there. A pair of nodes with more than ``CROWD`` members is divided over tasks by the same
step on tables: nodes some bits deeper are counted and joined with the nodes within the budget, again until no pair is crowded.

**Components.** A task reports a spanning forest of the links it finds (a fingerprint and the smallest one reachable in that
group), so links grow with fingerprints, not with pairs. Large-star and small-star rounds on stored tables turn links into components.

NULL and empty texts have the zero fingerprint. Repeated rows share fingerprint and component. NULL ids get a
component like others; a component of NULL ids alone has the id NULL. Other columns are ignored. :func:`keep_first` tells
rows by id and text digest, so what it drops never depends on an id that other texts have too.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farestrata.llm.common import WORD, drop_losers, map_rows, stored
from farestrata.llm.exact_dedup import digest

BITS = 64
SEED = 42
#: Members of a pair of nodes above which it is divided over tasks.
CROWD = 1 << 16
#: Trie levels of one division.
DIVIDE = 8
#: Node pairs expanded at a time; bounds memory.
CHUNK = 1 << 15
_LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text: str | None, size: int = 3) -> int:
    words = WORD.findall((text or "").translate(_LOWER)) if text else []
    if not words:
        return 0
    if len(words) < size:
        shingles = [" ".join(words)]
    else:
        shingles = map(" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], ">u8")
    total = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start:start + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """``id, fp``: the fingerprint as a signed long; with ``digests`` also ``text_sha256``."""
    more = [digest(text_col).alias("text_sha256")] if digests else []

    def run(batches) -> Iterator:
        for keys, texts, *rest in batches:
            found = np.array([fingerprint(text, size) for text in texts], np.uint64)
            yield keys, found.view(np.int64).tolist(), *rest

    kind = dict(docs.dtypes)[id_col]
    return map_rows(
        docs.select(id_col, text_col, *more), run, f"`{id_col}` {kind}, fp bigint" + ", text_sha256 string" * digests
    )


# --- the trie, inside one task ------------------------------------------------------------------------------

#: The first 0 to 64 bits.
_FIRST = np.array([((1 << n) - 1) << (BITS - n) for n in range(BITS + 1)], np.uint64)


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many first bits two keys agree."""
    parted = a ^ b
    for by in (1, 2, 4, 8, 16, 32):
        parted = parted | (parted >> np.uint64(by))
    return BITS - np.bitwise_count(parted).astype(np.int64)


def node_ranges(keys: np.ndarray, nodes: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the members of nodes, named by their first bits, begin and end in the sorted ``keys``."""
    first = nodes.view(np.uint64) << (BITS - depths).astype(np.uint64)
    return np.searchsorted(keys, first), np.searchsorted(keys, first | ~_FIRST[depths], "right")


def trie_links(
    keys: np.ndarray, roots: np.ndarray, k: int, settled: Callable[[np.ndarray], np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``keys`` (sorted, distinct, unsigned) within ``k`` bits, in bounded portions.

    A node is a range of ``keys`` whose members agree in their first bits; ``roots`` are pairs of ranges
    (low, high, low, high) to start from. A node paired with itself yields its two halves with themselves and with
    each other. ``settled`` tells which pairs need no visit any more; pairs inside a node come before those across.
    """
    stack = [roots]
    while stack:
        pairs = stack.pop()
        if len(pairs) > CHUNK:
            stack.append(pairs[CHUNK:])
            pairs = pairs[:CHUNK]
        if settled is not None:
            pairs = pairs[~settled(pairs)]
        one, two = keys[pairs[:, 0]], keys[pairs[:, 2]]
        depth_one, depth_two = _agreeing(one, keys[pairs[:, 1] - 1]), _agreeing(two, keys[pairs[:, 3] - 1])
        level = np.minimum(depth_one, depth_two)
        near = np.bitwise_count((one ^ two) & _FIRST[level]) <= k
        leaves = near & (level == BITS) & (pairs[:, 0] != pairs[:, 2])
        if leaves.any():
            yield pairs[leaves, 0], pairs[leaves, 2]
        near &= level < BITS
        if not near.any():
            continue
        pairs, level = pairs[near], level[near]
        halves_one = _halves(keys, pairs[:, 0:2], level, depth_one[near] == level)
        halves_two = _halves(keys, pairs[:, 2:4], level, depth_two[near] == level)
        inside = pairs[:, 0] == pairs[:, 2]
        within, across = [], []
        for i, a in enumerate(halves_one):
            for j, b in enumerate(halves_two):
                grown = np.concatenate([a, b], axis=1)
                there = (a[:, 1] > a[:, 0]) & (b[:, 1] > b[:, 0])
                (within if i == j else across).append(grown[there & ~inside if i > j else there])
        stack.append(np.concatenate(within + across))


def _halves(keys: np.ndarray, nodes: np.ndarray, level: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two children of each node at the bit after ``level``; a node that does not part there stays whole."""
    first_set = (keys[nodes[:, 0]] & _FIRST[level]) | (_FIRST[level + 1] ^ _FIRST[level])
    cut = np.where(parts, np.searchsorted(keys, first_set), nodes[:, 1])
    return np.stack([nodes[:, 0], cut], axis=1), np.stack([cut, nodes[:, 1]], axis=1)


def spanning(keys: np.ndarray, roots: np.ndarray, k: int) -> np.ndarray:
    """The smallest index that each index reaches over links below ``roots``.

    Pairs of nodes whose members are all connected already are not traversed, so a dense group costs no visit per link.
    """
    root = np.arange(len(keys))

    def settled(pairs: np.ndarray) -> np.ndarray:
        changes = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])
        lo1, hi1, lo2, hi2 = pairs.T
        return (root[lo1] == root[lo2]) & (changes[lo1] == changes[hi1 - 1]) & (changes[lo2] == changes[hi2 - 1])

    for a, b in trie_links(keys, roots, k, settled):
        a, b = root[a], root[b]
        while True:
            low, high = np.minimum(a, b), np.maximum(a, b)
            apart = low < high
            low, high = low[apart], high[apart]
            if not len(low):
                break
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
            a, b = root[low], root[high]
    return root


# --- the join over the cluster ------------------------------------------------------------------------------


def _rotated(column: str, by: int):
    fp = F.col(column)
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def _top(column: str, bits: int):
    return F.shiftrightunsigned(F.col(column), BITS - bits)


PAIR = ("turn", "node", "other")


def _divided(rows: DataFrame, depth: int, step: int, k: int) -> DataFrame:
    """Crowded pairs of nodes (``rows`` with one row per pair and member) as pairs of nodes ``step`` bits deeper.

    The pairs come from a join of the deeper nodes, which are few; a member is copied only to pairs whose nodes both exist.
    """
    inner = rows.withColumn("own", _top("key", depth + step))
    nodes = stored(inner.groupBy(*PAIR, "spent", "own").agg(F.count("*").alias("members")), "simhash-nodes")
    flips = F.array(*[F.lit(f) for f in range(1 << step) if f.bit_count() <= k])
    mask = F.lit((1 << step) - 1).cast("bigint")
    partner = F.shiftleft("other", step).bitwiseOR(F.col("own").bitwiseAND(mask)).bitwiseXOR(F.col("flip").cast("bigint"))
    mates = (
        nodes.where(F.shiftrightunsigned("own", step) == F.col("node"))
        .withColumn("flip", F.explode(F.filter(flips, lambda f: F.bit_count(f) + F.col("spent") <= k)))
        .select(*PAIR, "own", partner.alias("mate"), (F.col("spent") + F.bit_count("flip")).cast("int").alias("spent"), "members")
        .where("node <> other OR mate >= own")
    )
    right = nodes.select(*PAIR, F.col("own").alias("mate"), F.col("members").alias("more"))
    members = F.when(F.col("own") == F.col("mate"), F.col("members")).otherwise(F.col("members") + F.col("more"))
    pairs = stored(
        mates.join(right, [*PAIR, "mate"]).select(*PAIR, "own", "mate", "spent", members.alias("members")).where("members > 1"),
        "simhash-pairs",
    )
    sides = pairs.withColumn("at", F.explode(F.array_distinct(F.array("own", "mate"))))
    target = sides.select(
        *PAIR, F.col("at").alias("own"), F.col("own").alias("first"), F.col("mate").alias("second"),
        F.col("spent").alias("sum"), "members",
    )
    return stored(
        inner.drop("spent", "members").join(target, [*PAIR, "own"])
        .select("turn", "key", F.col("first").alias("node"), F.col("second").alias("other"), F.col("sum").alias("spent"), "members"),
        "simhash-divided",
    )


def links(distinct: DataFrame, k: int = 3, crowd: int | None = None) -> DataFrame:
    """``a, b``: fingerprints joined to the smallest one of their group; no link between distinct texts is lost.

    ``distinct`` has one row per fingerprint, ``fp``.
    """
    crowd = max(crowd or CROWD, 2)
    depth = width = BITS // (k + 1)
    turns = F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), _rotated("fp", i * width).alias("key"))
                                for i in range(k + 1)])).alias("t")
    block = _top("t.key", width)
    rows = stored(
        distinct.select(turns).select("t.turn", "t.key", block.alias("node"), block.alias("other"), F.lit(0).alias("spent")),
        "simhash-turns",
    )
    sizes = rows.groupBy(*PAIR).agg(F.count("*").alias("members"))
    crowded = stored(sizes.where(F.col("members") > crowd), "simhash-crowded")

    def gathered(members: DataFrame) -> DataFrame:
        return (
            members.groupBy(*PAIR).agg(F.collect_list("key").alias("keys")).where(F.size("keys") > 1)
            .select(*PAIR, F.lit(depth).alias("depth"), "keys")
        )

    groups = gathered(rows.join(crowded, [*PAIR], "left_anti"))
    rows = rows.join(crowded, [*PAIR])
    left = not crowded.isEmpty()
    while left:
        step = min(DIVIDE, BITS - depth)
        rows, depth = _divided(rows, depth, step, k), depth + step
        groups = groups.union(gathered(rows.where(F.col("members") <= crowd)))
        rows = rows.where(F.col("members") > crowd)
        left = not rows.isEmpty()  # at full depth a pair has two members

    def forests(batches) -> Iterator:
        for turns, nodes, others, depths, lists in batches:
            turns, depths = np.array(turns), np.array(depths, np.int64)
            nodes, others = np.array(nodes, np.int64), np.array(others, np.int64)
            for turn in np.unique(turns):
                own = np.flatnonzero(turns == turn)
                # all members of a node are there, whichever pair brought them
                keys = np.unique(np.concatenate([np.array(lists[i], np.int64) for i in own]).view(np.uint64))
                roots = np.stack(
                    [*node_ranges(keys, nodes[own], depths[own]), *node_ranges(keys, others[own], depths[own])], axis=1
                )
                root = spanning(keys, roots, k)
                moved = np.flatnonzero(root != np.arange(len(keys)))
                yield [_unturned(found, int(turn) * width).tolist() for found in (keys[moved], keys[root[moved]])]

    return map_rows(groups, forests, "a bigint, b bigint")


def _unturned(keys: np.ndarray, by: int) -> np.ndarray:
    if by:
        keys = (keys >> np.uint64(by)) | (keys << np.uint64(BITS - by))
    return keys.view(np.int64)


# --- components ---------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``edges`` (``a``, ``b``).

    Large-star joins the larger neighbours of a node to its smallest one, small-star the smaller ones; both keep
    what is connected, and rounds end when nothing changes. Every round is a stored table.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        mins = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return pairs.join(stored(mins, "simhash-smallest").withColumnRenamed("u", "w"), F.col("u") == F.col("w")).drop("w")

    def tidy(pairs: DataFrame) -> DataFrame:
        return stored(pairs.where("u <> v").distinct(), "simhash-star")

    now = tidy(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = tidy(smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        reached = smallest(large)
        now = tidy(
            reached.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(reached.select("u", F.col("m").alias("v")))
        )
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen


def _least_of_components(printed: DataFrame, value: Column, k: int) -> DataFrame:
    """``own_fp, least``: for every fingerprint of ``printed`` the least ``value`` in its component."""
    smallest = stored(printed.groupBy("fp").agg(F.min(value).alias("first")), "simhash-distinct")
    found = components(links(smallest.select("fp"), k))
    rooted = smallest.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return stored(rooted.join(least, "root").select(F.col("fp").alias("own_fp"), "least"), "simhash-components")


def near_duplicates(
    docs: DataFrame, size: int = 3, k: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, fp, component_id``: the smallest id of all documents linked directly or through others."""
    printed = stored(fingerprints(docs, size, id_col, text_col), "simhash-fingerprints")
    labelled = _least_of_components(printed, F.col(id_col), k)
    return printed.join(labelled, F.col("fp") == F.col("own_fp")).select(id_col, "fp", F.col("least").alias("component_id"))


def keep_first(docs: DataFrame, size: int = 3, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component.

    It is the one with the smallest id, NULL last, and of rows that share this id the one with the smallest text digest; of rows
    that repeat both, one stays.
    """
    printed = stored(fingerprints(docs, size, id_col, text_col, digests=True), "simhash-fingerprints")
    # a text has one fingerprint, so id and digest tell the component; it is never told by an id, which may be NULL
    place = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), "text_sha256")
    labelled = _least_of_components(printed, place, k)
    kept = F.col(id_col).eqNullSafe(F.col("least.id")) & (F.col("text_sha256") == F.col("least.text_sha256"))
    entries = stored(
        printed.join(labelled, F.col("fp") == F.col("own_fp")).select(id_col, "text_sha256", kept.alias("kept")),
        "simhash-entries",
    )
    losers = stored(entries.where(~F.col("kept")).select(id_col, "text_sha256").distinct(), "simhash-losers")
    left = drop_losers(docs, losers, {id_col: F.col(id_col), "text_sha256": digest(text_col)})
    if entries.where("kept").groupBy(id_col, "text_sha256").count().where("count > 1").isEmpty():
        return left
    hidden = f"_digest_{uuid.uuid4().hex[:8]}"
    return left.withColumn(hidden, digest(text_col)).dropDuplicates([id_col, hidden]).drop(hidden)
