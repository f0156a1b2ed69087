"""Prefix trie of conversations, summed up along its Euler tour.

A node is a distinct sequence of first turns; a 128-bit sum of the hashes of
(place, turn), taken as running sums over the sorted turns, names it. Its
smallest conversation and depth name it as well, and these are its id.

Each node has an enter and an exit arc, and each arc a successor: entering
leads to the first child or to the node's own exit, leaving leads to the next
sibling or to the parent's exit. To rank this list, it is cut into ranges of
node ids, neighbouring in conversation and depth, and the stretches that stay
inside a range are shortened to one link each, all ranges at once; the links
that are left are a shorter list, ranked in the same way. Where a list doesn't
get much shorter, pointer jumping, a join a round, ranks it. Running sums
of leaves and savings in order of position, taken at a node's exit and before
its enter arc, differ by the sum over its subtree.

No join has a key that many rows share: where many turns, children or arcs ask
one row for something, they are numbered, and that row is repeated for each
CHUNK of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpoint, key128, shuffle_partitions
from clickweave.llm.scan import running_sums

CHUNK = 10_000
# Arcs of a range whose stretches one task shortens.
BLOCK_ARCS = 1_000_000
# Characters of joined ids in one row.
ID_CHARS = 4096
LANES = 4


def chunks(last: Column) -> Column:
    """One row for each CHUNK of 0..last."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / CHUNK)))


def chunk(number: Column) -> Column:
    return F.floor(number / CHUNK)


# --- turns -------------------------------------------------------------------

def turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, turn_hash, chars): the turns of each conversation, numbered
    from 0 by turn, nulls first; equal ones by turn_hash. Rows without a conv_id
    belong to no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    t = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256).alias("turn_hash"),
        F.char_length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("one"))
    t = running_sums(t, ["conv"], [F.col("turn").asc_nulls_first(), F.col("turn_hash")], {"n": "one"})
    return t.select("conv", (F.col("n") - 1).alias("pos"), "turn_hash", "chars")


def rebuilt(placed: DataFrame, convs: DataFrame, lead: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, turn_hash, chars, last): the first ``lead`` turns (``most`` or
    fewer) of the conversation ``base`` and each conversation's own turns after
    as many; depth counts from 1. ``last`` marks the last turn. And (conv): the
    conversations without turns."""
    c = convs.select("conv", "n", lead.alias("lead"), base.alias("base"))
    lengths = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    c = c.join(lengths, "base", "left").withColumn("met", F.least("lead", F.coalesce("base_n", F.lit(0))))
    c = checkpoint(c)
    own = placed.withColumn("chunk", chunk(F.col("pos"))).join(
        c.where("n > lead").select("conv", "n", "lead", "met", chunks(F.col("n")).alias("chunk")), ["conv", "chunk"])
    own = own.where("pos >= lead").select("conv", (F.col("pos") - F.col("lead") + F.col("met") + 1).alias("depth"), "turn_hash", "chars",
                                          (F.col("pos") == F.col("n") - 1).alias("last"))
    first = placed.where(F.col("pos") < most).select(F.col("conv").alias("base"), "pos", "turn_hash", "chars")
    taken = c.where("met > 0").join(first, "base").where("pos < met").select(
        "conv", (F.col("pos") + 1).alias("depth"), "turn_hash", "chars", ((F.col("pos") + 1 == F.col("met")) & (F.col("n") <= F.col("lead"))).alias("last"))
    return own.union(taken), c.where("met = 0 and n <= lead").select("conv")


def prefixes(sequences: DataFrame) -> DataFrame:
    """(conv, depth, chars, last, key, parent): the node of each conversation at
    each depth and the one above, as structs of two hashes."""
    h = [F.xxhash64(F.lit(i), "depth", "turn_hash") for i in range(LANES // 2)]
    # halves of the hashes, so that sums of 2**31 of them fit a long
    low, high = (lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))), (lambda x: F.shiftrightunsigned(x, 32))
    s = sequences.select("conv", "depth", "chars", "last", *[f(x).alias(f"v{2 * i + j}") for i, x in enumerate(h) for j, f in enumerate((low, high))])
    s = running_sums(s, ["conv"], [F.col("depth")], {f"s{i}": f"v{i}" for i in range(LANES)})
    return s.select("conv", "depth", "chars", "last", key128("depth", *[F.col(f"s{i}") for i in range(LANES)]).alias("key"),
                    key128(F.col("depth") - 1, *[F.col(f"s{i}") - F.col(f"v{i}") for i in range(LANES)]).alias("parent"))


def root_key() -> Column:
    zero = F.lit(0).cast("long")
    return key128(zero, *[zero] * LANES)


# --- nodes -------------------------------------------------------------------

def nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, conv, depth, n_convs, chars, n_children, first_child, parent_conv,
    next_sibling): the distinct prefixes. conv is the smallest member; children
    are ordered by it."""
    found = paths.groupBy("key").agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("depth").alias("depth"),
                                     F.min("chars").alias("chars"), F.min("parent").alias("parent"))
    found = found.withColumn("one", F.lit(1).cast("long")).select("*", F.col("parent.a").alias("pa"), F.col("parent.b").alias("pb"))
    found = running_sums(found, ["pa", "pb"], [F.col("conv")], {"nth": "one"})
    below = found.groupBy("parent").agg(F.count("*").alias("n_children"), F.min("conv").alias("first_child"))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        root_key().alias("key"), "conv", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("chars"),
        F.lit(None).cast(found.schema["parent"].dataType).alias("parent"), F.lit(None).cast("long").alias("nth"))
    cols = root.columns
    every = found.select(cols).union(root)
    every = every.join(below.withColumnRenamed("parent", "key"), "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    every = checkpoint(every)
    up = every.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"), chunks(F.col("n_children")).alias("chunk"))
    side = every.where("nth > 1").select("parent", (F.col("nth") - 1).alias("nth"), F.col("conv").alias("next_sibling"))
    met = every.withColumn("chunk", chunk(F.col("nth"))).join(up, ["parent", "chunk"], "left").join(side, ["parent", "nth"], "left")
    return met.select("key", "conv", "depth", "n_convs", "chars", "n_children", "first_child", "parent_conv", "next_sibling")


# --- the tour ----------------------------------------------------------------

def arcs(tree: DataFrame) -> DataFrame:
    """(conv, k, next_conv, next_k, leaves, saved): the arcs of the tour, each with
    the one behind it. k is 2 * depth of the enter arc and 2 * depth + 1 of the
    exit arc; the root's exit is the last. Values stand at the enter arcs."""
    enter, exit_ = 2 * F.col("depth"), 2 * F.col("depth") + 1
    leaf = F.col("n_children") == 0
    into = F.struct(F.col("conv"), enter.alias("k"), F.when(leaf, F.col("conv")).otherwise(F.col("first_child")).alias("next_conv"),
                    F.when(leaf, exit_).otherwise(enter + 2).alias("next_k"), leaf.cast("long").alias("leaves"),
                    ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    out = F.struct(F.col("conv"), exit_.alias("k"), F.coalesce("next_sibling", "parent_conv").alias("next_conv"),
                   F.when(F.col("next_sibling").isNotNull(), enter).when(F.col("depth") > 0, exit_ - 2).alias("next_k"),
                   F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    return tree.select(F.explode(F.array(into, out)).alias("a")).select("a.*")


def _shorten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One range of links -> each link (length ``own``) with the head of its stretch
    and its place in it, and for each head (is_head) the stretch's length and successor."""
    parts = list(batches)
    b = pd.concat(parts, ignore_index=True) if parts else None
    if b is None or not len(b):
        return
    n = len(b)
    conv, k, own_length = (b[c].to_numpy(np.int64) for c in ("conv", "k", "length"))
    next_conv, next_k = b["next_conv"].to_numpy(np.int64), b["next_k"].to_numpy(np.int64)
    ends = next_k < 0  # the last link of all
    known, code = np.unique(conv, return_inverse=True)
    width = max(int(k.max()), int(next_k.max())) + 1
    own = code * width + k
    order = np.argsort(own)
    place = np.minimum(np.searchsorted(known, next_conv), len(known) - 1)
    wanted = place * width + next_k
    at = order[np.minimum(np.searchsorted(own[order], wanted), n - 1)]
    inside = ~ends & (known[place] == next_conv) & (own[at] == wanted)
    head, offset = np.arange(n), np.zeros(n, np.int64)
    head[at[inside]] = np.flatnonzero(inside)  # the link before, for now
    offset[at[inside]] = own_length[inside]
    while True:
        further = head[head]
        if (further == head).all():
            break
        offset += offset[head]
        head = further
    tail = np.flatnonzero(~inside)  # one for each stretch
    length, after = np.zeros(n, np.int64), np.full((2, n), -1, np.int64)
    length[head[tail]] = offset[tail] + own_length[tail]
    after[0, head[tail]] = next_conv[tail]
    after[1, head[tail]] = next_k[tail]
    yield b[["conv", "k"]].assign(own=own_length, head_conv=conv[head], head_k=k[head], place=offset, is_head=length > 0, length=length,
                                  next_conv=after[0], next_k=after[1])


def shorten(links: DataFrame, ranges: int) -> DataFrame:
    """Links (conv, k, next_conv, next_k, length) in so many ranges of their ids,
    the stretches inside of each shortened."""
    ranged = links.coalesce(1) if ranges == 1 else links.repartitionByRange(ranges, "conv", "k")
    return checkpoint(ranged.mapInPandas(
        _shorten, "conv long, k long, own long, head_conv long, head_k long, place long, is_head boolean, length long, next_conv long, next_k long"))


def jumped(links: DataFrame) -> DataFrame:
    """Pointer jumping: (conv, k, next_conv, next_k, length) -> (conv, k, togo),
    the sum of lengths from each link to the end of the list (next_k < 0)."""
    state = checkpoint(links.select("conv", "k", "next_conv", "next_k", F.col("length").alias("togo")))
    while state.where("next_k >= 0").limit(1).count():
        done, open_ = state.where("next_k < 0"), state.where("next_k >= 0")
        ahead = state.select(F.col("conv").alias("next_conv"), F.col("k").alias("next_k"), F.col("next_conv").alias("n2"),
                             F.col("next_k").alias("k2"), F.col("togo").alias("more"))
        moved = open_.join(ahead, ["next_conv", "next_k"]).select(
            "conv", "k", F.col("n2").alias("next_conv"), F.col("k2").alias("next_k"), (F.col("togo") + F.col("more")).alias("togo"))
        state = checkpoint(done.union(moved))
    return state.select("conv", "k", "togo")


def positions(tour: DataFrame, n: int, block: int = BLOCK_ARCS) -> DataFrame:
    """(conv, k, pos): the place of each of the tour's ``n`` arcs, from 0.

    The list is shortened level by level, in ranges of at most about ``block``
    links, until all of it fits one range, which ranks it. Where a level doesn't
    halve the list, since successors lie far apart, pointer jumping ranks the rest."""
    links = tour.select("conv", "k", F.coalesce("next_conv", F.lit(0)).alias("next_conv"), F.coalesce("next_k", F.lit(-1)).alias("next_k"),
                        F.lit(1).cast("long").alias("length"))
    levels, left, ranges = [], n, max(shuffle_partitions(tour.sparkSession), -(-n // block))
    while True:
        levels.append(shorten(links, ranges))
        links = levels[-1].where("is_head").select("conv", "k", "next_conv", "next_k", "length")
        before, left = left, links.count()
        if left <= 1:
            found = links.withColumn("pos", F.lit(0).cast("long"))
            break
        if 2 * left > before and left > block:  # too long for one range, too spread for many
            found = links.join(jumped(links), ["conv", "k"]).withColumn("pos", F.lit(n) - F.col("togo"))
            break
        ranges = -(-left // block)
    for level in reversed(levels):
        heads = found.select(F.col("conv").alias("head_conv"), F.col("k").alias("head_k"), "pos", chunks(F.col("length")).alias("chunk"))
        met = level.withColumn("chunk", chunk(F.col("place"))).join(heads, ["head_conv", "head_k", "chunk"])
        found = met.select("conv", "k", F.col("own").alias("length"), (F.col("pos") + F.col("place")).alias("pos"))
    return found.select("conv", "k", "pos")


def subtree_sums(tree: DataFrame, block: int = BLOCK_ARCS) -> DataFrame:
    """(conv, depth, n_leaves, saved_tokens) from the running sums at the arcs."""
    tour = arcs(tree)
    placed = tour.select("conv", "k", "leaves", "saved").join(positions(tour, 2 * tree.count(), block), ["conv", "k"])
    placed = running_sums(placed, [], [F.col("pos")], {"l": "leaves", "s": "saved"})
    leaving = F.col("k") % 2 == 1
    at = lambda total, own: F.sum(F.when(leaving, F.col(total)).otherwise(F.col(own) - F.col(total)))
    return placed.groupBy("conv", F.floor(F.col("k") / 2).alias("depth")).agg(at("l", "leaves").alias("n_leaves"), at("s", "saved").alias("saved_tokens"))


# --- conversations that end at a node ----------------------------------------

def _join_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (a, b, conv) -> rows (a, b, first, ids) of some ids each, joined."""
    key, ids, size, rows = None, [], 0, []
    for b in batches:
        for a, c, conv in zip(b["a"].tolist(), b["b"].tolist(), b["conv"].tolist()):
            if key != (a, c) or size > ID_CHARS:
                if ids:
                    rows.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids, size = (a, c), [], 0
            ids.append(conv)
            size += 21
        if len(rows) >= 1000:
            yield pd.DataFrame(rows, columns=["a", "b", "first", "ids"])
            rows = []
    if ids:
        rows.append((*key, ids[0], ",".join(map(str, ids))))
    if rows:
        yield pd.DataFrame(rows, columns=["a", "b", "first", "ids"])


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, sha, rows = None, None, []
    for b in batches:
        for a, c, ids in zip(b["a"].tolist(), b["b"].tolist(), b["ids"].tolist()):
            if key != (a, c):
                if sha is not None:
                    rows.append((*key, sha.hexdigest()))
                key, sha = (a, c), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if len(rows) >= 10_000:
            yield pd.DataFrame(rows, columns=["a", "b", "ends_sha256"])
            rows = []
    if sha is not None:
        rows.append((*key, sha.hexdigest()))
    if rows:
        yield pd.DataFrame(rows, columns=["a", "b", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, conv) -> (key, ends_sha256) of the ids in ascending order, joined by
    commas. Up to CHUNK ids of a node are gathered as one list. The ids of a node
    that more conversations end at are joined in pieces wherever a sort leaves
    them; only the pieces of one node meet in a task, which streams them."""
    parts = shuffle_partitions(ends.sparkSession)
    counts = checkpoint(ends.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK))
    many = counts.count()
    few = ends.join(counts, "key", "left_anti") if many else ends
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    done = few.groupBy("key").agg(F.sha2(text, 256).alias("ends_sha256"))
    if not many:
        return done
    flat = ends.join(counts, "key", "left_semi").select(F.col("key.a").alias("a"), F.col("key.b").alias("b"), "conv")
    pieces = flat.repartitionByRange(parts, "a", "b", "conv").sortWithinPartitions("a", "b", "conv").mapInPandas(
        _join_ids, "a long, b long, first long, ids string")
    rest = pieces.repartition(parts, "a", "b").sortWithinPartitions("a", "b", "first").mapInPandas(_digest, "a long, b long, ends_sha256 string")
    return done.union(rest.select(F.struct("a", "b").alias("key"), "ends_sha256"))


# --- the operator ------------------------------------------------------------

def shared_lead(most: int = 6) -> Column:
    """How many turns a conversation takes from its base: a hash of its id."""
    return F.crc32(F.col("conv").cast("string").cast("binary")) % most


def trie(conversations: DataFrame, lead: Column | None = None, base: Column | None = None, most: int = 6,
         block: int = BLOCK_ARCS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), one row for each distinct sequence of first
    turns, the root of no turns included.

    Conversations are rebuilt first: ``lead`` turns (below ``most``; columns may
    use ``conv``) come from the conversation ``base``, the rest is their own.
    ``most=0`` leaves them as they are. Null roles and texts are empty ones.
    Turns are ordered by ``turn``, nulls first, and among equal ones by a hash
    of role and text; repeated rows are turns of their own. Rows with a null
    conv_id are no part of any conversation. Other columns are ignored. An empty
    table gives an empty result.
    """
    placed = turns(conversations)
    convs = checkpoint(placed.groupBy("conv").agg(F.count("*").alias("n")))
    lead = F.lit(0) if not most else shared_lead(most) if lead is None else lead
    base = F.col("conv") - F.col("conv") % 100 if base is None else base
    sequences, silent = rebuilt(placed, convs, lead.cast("long"), base, most)
    paths = prefixes(sequences)
    tree = checkpoint(nodes(paths, convs))
    sums = subtree_sums(tree, block)
    ends = end_digests(checkpoint(paths.where("last").select("key", "conv").union(silent.select(root_key().alias("key"), "conv"))))
    out = tree.join(sums, ["conv", "depth"]).join(ends, "key", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
