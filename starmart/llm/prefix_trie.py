"""A trie of the prefixes that conversations share, with what sharing them saves.

Conversations are sorted by their turns and cut into shards.  A shard is a trie in balanced
parentheses (``parens``): ``find_close`` delimits subtrees, the rank of leaf pairs counts
leaves, cumulative arrays give members and savings.  Only the shard's spines, the paths of its
first and last conversation, may go on in another shard; their nodes are merged by a digest of
their turns afterwards.  All others are whole.

Turns travel as a 128-bit digest of role and text and the text's length; texts are read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.exprs import col
from starmart.llm.parens import Parens
from starmart.scratch import Scratch

#: Turns of a shard; one conversation is never cut.
SHARD_TURNS = 1 << 18
_DIGEST = 16
_NONE = hashlib.sha256().hexdigest()
_IDS = 4096  # ids in one segment of a list of ends


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: per conversation the array of (digest, bytes) in the order of turns.

    NULL roles and texts become empty.  Rows of equal turn are ordered by their digests; rows
    without ``conv_id`` belong to no conversation.  The conversation is one record: its digests,
    20 bytes a turn, must fit into a task.
    """
    role = F.coalesce(col(conversations, "role").cast("string"), F.lit(""))
    text = F.coalesce(col(conversations, "text").cast("string"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = conversations.select(
        col(conversations, "conv_id").cast("long").alias("conv_id"),
        F.struct(
            col(conversations, "turn").alias("turn"),
            F.unhex(F.substring(F.sha2(named, 256), 1, 2 * _DIGEST)).alias("digest"),
            F.octet_length(text).alias("bytes"),
        ).alias("line"),
    ).where("conv_id IS NOT NULL")
    lines = F.sort_array(F.collect_list("line"))
    kept = F.transform(lines, lambda x: F.struct(x["digest"].alias("digest"), x["bytes"].alias("bytes")))
    return rows.groupBy("conv_id").agg(kept.alias("turns"))


def rebuild(convs: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """Conversations of a group of ids share the head of the group's first one.

    Of conversation c the first h = crc32(c) % (most + 1) turns are those of conversation
    c - c % group (as many as it has), the further ones its own after its first h.  ``%`` has
    the sign of c.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = convs.where(c % group == 0).select(c.alias("first"), F.slice("turns", 1, most).alias("head"))
    own = convs.withColumn("first", c - c % group).join(heads, "first", "left")
    empty = F.array().cast(convs.schema["turns"].dataType)
    head = F.when(h > 0, F.slice(F.coalesce("head", empty), F.lit(1), F.greatest(h, F.lit(1)))).otherwise(empty)
    tail = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.select("conv_id", F.concat(head, tail).alias("turns"))


_PIECES = (
    "shard long, kind string, slot long, up long, id binary, up_id binary, conv_id long, depth long, parent_conv_id long,"
    "bytes long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, part long, ids string"
)


def _shard(number: int, ids: np.ndarray, sizes: np.ndarray, keys: np.ndarray, lengths: np.ndarray) -> Iterator[pd.DataFrame]:
    """All nodes of sorted conversations: ``keys`` are their turns' digests, end to end."""
    n = len(ids)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # Turns each conversation shares with the one before.
    low = np.minimum(sizes[1:], sizes[:-1])
    of = np.repeat(np.arange(1, n), low)
    j = np.arange(len(of)) - np.repeat(np.cumsum(low) - low, low)
    differ = keys[starts[of] + j] != keys[starts[of - 1] + j]
    shared = np.zeros(n, np.int64)
    shared[1:] = low
    np.minimum.at(shared, of[differ], j[differ])
    closed = np.concatenate([[0], sizes[:-1] - shared[1:]])
    opened = sizes - shared
    opened[0] += 1  # the root
    runs = np.append(np.stack([closed, opened], axis=1).ravel(), sizes[-1] + 1)
    kinds = np.append(np.tile([0, 1], n), 0)
    bits = np.repeat(kinds, runs).astype(np.uint8)
    tree = Parens(bits)

    opens = np.flatnonzero(bits)
    closes = tree.find_close(opens)
    m = len(opens)
    span = (closes - opens + 1) // 2  # nodes of the subtree
    excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
    depth = excess[opens] - 1
    seen = np.cumsum(closed + opened)  # parentheses up to a conversation's own place
    first = np.searchsorted(seen, opens, side="right")
    behind = np.searchsorted(seen, closes, side="right")
    n_convs = behind - first
    bounds = np.stack([first, behind], axis=1).ravel()
    least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), bounds)[::2]
    turn = starts[first] + depth - 1  # of the node's last turn; none for the root
    turn[0] = 0
    size = lengths[turn] if len(lengths) else np.zeros(m, np.int64)
    size[0] = 0
    # The parent: the node opened last whose subtree is not over, one level higher.
    order = np.lexsort((np.arange(m), depth))
    parent = np.full(m, -1)
    level = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    for d in range(1, depth.max() + 1):
        above, here = order[level[d - 1] : level[d]], order[level[d] : level[d + 1]]
        parent[here] = above[np.searchsorted(above, here) - 1]
    ends_at = np.cumsum(opened) - 1  # node at which a conversation ends

    spine = np.zeros(m, bool)
    spine[: sizes[0] + 1] = True
    spine |= closes >= len(bits) - (sizes[-1] + 1)
    inner = ~spine
    leaf = span == 1
    # What spine nodes add themselves is known after the merge only.
    gain = np.concatenate([[0], np.cumsum(np.where(inner, (n_convs - 1) * size, 0))])
    saved = gain[np.arange(m) + span] - gain[:-1]
    outer_leaves = np.concatenate([[0], np.cumsum(leaf & spine)])
    leaves = tree.leaves(opens, closes) - (outer_leaves[np.arange(m) + span] - outer_leaves[:-1])
    kids = np.bincount(parent[1:][inner[1:]], minlength=m)

    digests, segments = np.full(m, _NONE, object), []
    cuts = np.flatnonzero(np.diff(ends_at, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], n), strict=True):
        node = ends_at[a]
        if inner[node]:
            digests[node] = hashlib.sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest()
        else:
            segments += [(node, k // _IDS, ",".join(map(str, ids[k : min(k + _IDS, b)].tolist()))) for k in range(a, b, _IDS)]

    names = {0: hashlib.sha256(b"").digest()[:_DIGEST]}
    outer = np.flatnonzero(spine)
    for k in outer[1:].tolist():
        names[k] = hashlib.sha256(names[parent[k]] + keys[turn[k]].item()).digest()[:_DIGEST]

    nodes = np.flatnonzero(inner)
    under = spine[parent[nodes]] if len(nodes) else np.zeros(0, bool)
    whole = {
        "kind": "node", "up": pd.array(np.where(under, parent[nodes], -1)), "conv_id": least[nodes], "depth": depth[nodes],
        "parent_conv_id": least[parent[nodes]], "n_convs": n_convs[nodes], "n_children": kids[nodes], "n_leaves": leaves[nodes],
        "saved_tokens": saved[nodes], "ends_sha256": digests[nodes],
    }
    yield pd.DataFrame(whole)
    yield pd.DataFrame({
        "kind": "spine", "slot": outer, "up": parent[outer], "id": [names[k] for k in outer.tolist()],
        "up_id": [names.get(k) for k in parent[outer].tolist()], "conv_id": least[outer], "depth": depth[outer], "bytes": size[outer],
        "n_convs": n_convs[outer], "n_children": kids[outer], "n_leaves": leaves[outer], "saved_tokens": saved[outer],
    })
    if segments:
        node, part, text = zip(*segments, strict=True)
        yield pd.DataFrame({"kind": "ends", "id": [names[k] for k in node], "part": part, "ids": text})


def _shards(limit: int):
    """Tries of consecutive sorted rows (conv_id, path, bytes) of ``limit`` turns each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([
            (f.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]) for f in _PIECES.split(",")
        ])
        number = TaskContext.get().partitionId() << 32

        def trie(held: list) -> Iterator[pa.RecordBatch]:
            ids, sizes, keys, lengths = (np.concatenate(x) for x in zip(*held, strict=True))
            for frame in _shard(number, ids, sizes, keys, lengths):
                if len(frame):
                    frame["shard"] = number
                    frame = frame.reindex(columns=schema.names)
                    yield from pa.Table.from_pandas(frame, schema, preserve_index=False).to_batches(1 << 14)

        held, n = [], 0
        for batch in batches:
            at = 0
            path, lengths = batch.column(1), batch.column(2)
            sizes = np.array([len(x.as_buffer()) // _DIGEST for x in path], np.int64)
            while at < len(sizes):
                # As many rows as fit, one at least.
                room = np.searchsorted(np.cumsum(sizes[at:]), limit - n, side="right")
                end = at + max(int(room), 0 if held else 1)
                if end > at:
                    rows = slice(at, end)
                    text = b"".join(x.as_py() for x in path[rows])
                    held.append((
                        batch.column(0)[rows].to_numpy(zero_copy_only=False), sizes[rows], np.frombuffer(text, f"V{_DIGEST}"),
                        lengths[rows].flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                    ))
                    n += int(sizes[rows].sum())
                if end < len(sizes):
                    yield from trie(held)
                    number += 1
                    held, n = [], 0
                at = end
        if held:
            yield from trie(held)

    return run


def _own_spines(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over the spine nodes below each one of a shard, itself included; a shard owns a node once."""
    rows = rows.sort_values("slot").reset_index(drop=True)
    place = {s: i for i, s in enumerate(rows["slot"].tolist())}
    leaves, saved = rows["own_leaf"].tolist(), rows["own_saved"].tolist()
    for i in range(len(rows) - 1, 0, -1):
        above = place[rows["up"][i]]
        leaves[above] += leaves[i]
        saved[above] += saved[i]
    return pd.DataFrame({"id": rows["id"], "leaves": leaves, "saved": saved})


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 per id of its segments as they come; one segment at a time is in memory."""
    last, hashed, done = None, None, ([], [])
    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != last:
                if last is not None:
                    done[0].append(last)
                    done[1].append(hashed.hexdigest())
                last, hashed = name, hashlib.sha256(text.encode())
            else:
                hashed.update(b"," + text.encode())
    if last is not None:
        done[0].append(last)
        done[1].append(hashed.hexdigest())
    yield pa.record_batch([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], names=["id", "ends_sha256"])


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of ``convs`` (``conv_id, turns`` as ``turns`` gives them).

    ``conv_id`` is the smallest member, a conversation that starts with the prefix; ``n_leaves``
    and ``saved_tokens``, (n_convs - 1) * bytes of the last text of each node, are over the
    subtree.  No conversations give no rows; conversations without turns are members of the root.
    """
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    with Scratch(convs.sparkSession) as scratch:
        path = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
        flat = convs.select("conv_id", F.unhex(path).alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"))
        flat = scratch.table(flat, "paths")
        # The id is a key too: equal conversations, however many, are cut into several ranges.
        ordered = flat.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
        pieces = scratch.table(ordered.mapInArrow(_shards(shard_turns), _PIECES), "tries")

        spines = pieces.where("kind = 'spine'")
        merged = spines.groupBy("id").agg(
            F.first("up_id").alias("up_id"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.first("bytes").alias("bytes"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.min("shard").alias("owner"),
        )
        merged = scratch.table(merged, "spines")
        kids = merged.groupBy(F.col("up_id").alias("id")).agg(F.count("*").alias("more"))
        digests = pieces.where("kind = 'ends'").select("id", "ids", "shard", "part").repartition("id")
        digests = digests.sortWithinPartitions("id", "shard", "part").select("id", "ids").mapInArrow(_digest, "id binary, ends_sha256 string")
        ups = merged.select(F.col("id").alias("up_id"), F.col("conv_id").alias("parent_conv_id"))
        merged = merged.join(kids, "id", "left").join(digests, "id", "left").join(ups, "up_id", "left")
        merged = merged.withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
        merged = scratch.table(merged.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE))), "merged")

        own = F.col("owner") == F.col("shard")
        mine = spines.select("shard", "slot", "up", "id").join(merged.select("id", "owner", "conv_id", "n_children", "n_convs", "bytes"), "id")
        mine = mine.select(
            "shard", "slot", "up", "id", "conv_id",
            F.when(own & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("own_leaf"),
            F.when(own, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0).cast("long").alias("own_saved"),
        )
        mine = scratch.table(mine, "shared")
        below = mine.groupBy("shard").applyInPandas(_own_spines, "id binary, leaves long, saved long")
        below = below.groupBy("id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        outer = merged.join(below, "id").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaves")).alias("n_leaves"),
            (F.col("saved_tokens") + F.col("saved")).alias("saved_tokens"), "ends_sha256",
        )
        # A parent on a spine has its smallest member perhaps in another shard.
        ups = mine.select("shard", F.col("slot").alias("up"), F.col("conv_id").alias("merged_parent"))
        inner = pieces.where("kind = 'node'")
        hung = inner.where("up >= 0").join(ups, ["shard", "up"]).withColumn("parent_conv_id", F.col("merged_parent"))
        out = inner.where("up < 0").select(*names).unionByName(hung.select(*names)).unionByName(outer.select(*names))
        return scratch.result(out, "trie")


def report(conversations: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """The trie of the rebuilt conversations."""
    with Scratch(conversations.sparkSession) as scratch:
        return scratch.result(trie(rebuild(scratch.table(turns(conversations), "turns"), group, most)), "trie")
