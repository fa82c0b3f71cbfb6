"""Trie of conversation prefixes: minimal-perfect-hash node tables with flat arrays, accumulated in depth order.

A node is a distinct sequence of first turns. Its digest is the sum, modulo 2^64 in two halves, of hashes of
(turn, depth), so the digests along a conversation are running sums. Conversations are dealt to shards of bounded
size by a hash; a conversation of more than ``BAND`` turns is cut into bands of so many, and what the bands before
one add up to is its start. A shard enumerates the distinct digests of its rows and gives each a slot by a
minimal perfect hash whose slots keep the whole digest, so that every look-up is verified. Counts are scattered
into flat numpy arrays by slot. Sums over shards give the nodes, each owned by its smallest member. In a second
pass every node's own weight is scattered into the shard of its owner and accumulated through the array of parent
slots, deepest level first; what an owner holds in later bands is added at the end of each earlier one. Sums over
shards again give each node's subtree.

A shared first turn, however hot, is one slot in every shard. No task holds a whole conversation, node or level.
Two sequences with one digest would show by different parents or last turns; the table is then made anew with
other hashes.

Cases: rows without ``conv_id`` take no part. A null turn comes first; rows of one turn go by role and text, and
repeated rows are turns each. A null role or text counts as empty. A conversation may have no turn at all and then
ends at the root. An empty table has no node. Very long texts only lend their hash and length. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import Run, join_hot, read
from gridspark.llm.words import mix

#: Rows (a turn of a conversation) of a shard, about; turns of a conversation that stay together.
SHARD_ROWS, BAND = 1 << 15, 4096
#: Ids of a node's list that are joined at a time: those that agree above so many bits.
CHUNK_BITS = 16

_NODE = ["depth", "lo", "hi"]


class Slots:
    """A minimal perfect hash of distinct (lo, hi, depth): levels of bitmaps in which a key that is alone on its
    place takes it, and the others go on to the next level. A slot is a place's rank."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels, self.ranks, n = levels, [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits) + (n - 1))
            n += int(bits.sum())

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        lo, hi, depth = keys
        return (mix(lo ^ mix(hi + mix(depth + np.uint64(level << 40)))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> Slots:
        levels = []
        while keys.shape[1]:
            size = max(16, keys.shape[1] * 3 // 2)
            places = cls._places(keys, len(levels), size)
            bits = np.bincount(places, minlength=size) == 1
            levels.append(bits)
            keys = keys[:, ~bits[places]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """A slot for every key; for one that is not in the table any slot, or -1."""
        slots, left = np.full(keys.shape[1], -1), np.arange(keys.shape[1])
        for level, bits in enumerate(self.levels):
            places = self._places(keys[:, left], level, len(bits))
            slots[left[bits[places]]] = self.ranks[level][places[bits[places]]]
            left = left[~bits[places]]
        return slots


_ARRAYS = {"lo": np.uint64, "hi": np.uint64, "depth": np.int64, "parent": np.int64, "last": np.int64, "size": np.int64,
           "members": np.int64, "ends": np.int64, "conv_id": np.int64}
_TABLE = pa.schema([("shard", pa.int32()), ("clash", pa.bool_()), ("levels", pa.list_(pa.binary())), ("places", pa.list_(pa.int64())),
                    *((name, pa.binary()) for name in _ARRAYS), ("end_slots", pa.binary()), ("end_convs", pa.binary())])
_TABLE_DDL = ("shard int, clash boolean, levels array<binary>, places array<long>, "
              + ", ".join(f"{name} binary" for name in [*_ARRAYS, "end_slots", "end_convs"]))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _node_table(band: int):
    """Rows (conv_id, depth, half hashes, last, size) of a shard and the starts of later bands -> one row of arrays."""

    def run(rows: pa.Table, starts: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _TABLE.empty_table()
        conv, depth = _column(rows, "conv_id"), _column(rows, "depth").astype(np.int64)
        by = np.lexsort((depth, conv))
        conv, depth = conv[by], depth[by]
        part = np.maximum(depth - 1, 0) // band
        first = np.flatnonzero(np.concatenate(([True], (conv[1:] != conv[:-1]) | (part[1:] != part[:-1]))))
        unit = np.repeat(np.arange(len(first)), np.diff(np.concatenate((first, [len(conv)]))))
        ended = np.concatenate((first[1:], [len(conv)])) - 1
        # Of a conversation in one band nothing is said: it starts at the root and ends here.
        told = {(c, b): (low, high, last) for c, b, low, high, last in zip(*(starts.column(n).to_pylist() for n in (
            "conv_id", "band", "start_lo", "start_hi", "final")), strict=True)}
        said = [told.get(key, (0, 0, True)) for key in zip(conv[first].tolist(), part[first].tolist(), strict=True)]
        begin = np.array([s[:2] for s in said], np.int64).view(np.uint64).reshape(-1, 2)
        digests = []
        for half, name in enumerate(("half_lo", "half_hi")):
            sums = np.cumsum(_column(rows, name)[by].view(np.uint64), dtype=np.uint64)
            before = np.concatenate((np.zeros(1, np.uint64), sums))[first]
            digests.append(sums - (before - begin[:, half])[unit])
        ghosts = np.flatnonzero(part[first] > 0)  # parents of first turns in a later band: nodes without members here
        lo, hi = (np.concatenate((d, begin[ghosts, half])) for half, d in enumerate(digests))
        depth = np.concatenate((depth, part[first[ghosts]] * band))
        order = np.lexsort((hi, lo, depth))
        new = np.concatenate(([True], (np.diff(depth[order]) != 0) | (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0)))
        node = np.empty(len(order), np.int64)
        node[order] = np.cumsum(new) - 1
        n, real = int(new.sum()), len(conv)
        above = np.concatenate(([-1], node[: real - 1]))  # the node one turn before
        above[first] = -1
        above[first[ghosts]] = node[real:]
        spread = lambda values: _scattered(n, node[:real], values)
        parent, last = spread(above), spread(_column(rows, "last")[by])
        clash = bool((parent[node[:real]] != above).any() or (last[node[:real]] != _column(rows, "last")[by]).any())
        smallest = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(smallest, node[:real], conv)
        final = ended[np.array([s[2] for s in said])]
        keys = np.stack((lo[order][new], hi[order][new], depth[order][new].astype(np.uint64)))
        slots = Slots.build(keys)
        slot = slots.find(keys)
        arrays = {"lo": keys[0], "hi": keys[1], "depth": keys[2], "parent": np.where(parent < 0, -1, slot[parent]), "last": last,
                  "size": spread(_column(rows, "size")[by]), "members": np.bincount(node[:real], minlength=n),
                  "ends": np.bincount(node[final], minlength=n), "conv_id": smallest}
        placed = {name: np.empty(n, kind) for name, kind in _ARRAYS.items()}
        for name, values in arrays.items():
            placed[name][slot] = values
        cells = {"shard": rows.column("shard")[0].as_py(), "clash": clash, "levels": [np.packbits(b).tobytes() for b in slots.levels],
                 "places": [len(b) for b in slots.levels], **{k: v.tobytes() for k, v in placed.items()},
                 "end_slots": slot[node[final]].tobytes(), "end_convs": conv[final].tobytes()}
        return pa.Table.from_pylist([cells], _TABLE)

    return run


def _scattered(n: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.full(n, -1, np.int64)
    out[at] = values
    return out


def _arrays(row: dict) -> dict[str, np.ndarray]:
    return {name: np.frombuffer(row[name], kind) for name, kind in _ARRAYS.items()}


def _rows(what: str):
    """Decode node tables into rows: their nodes with members, or the conversations that end in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            a = _arrays(row)
            signed = lambda name, at: a[name][at].view(np.int64)  # noqa: B023, E731
            if what == "ends":
                at = np.frombuffer(row["end_slots"], np.int64)
                more = {"conv_id": np.frombuffer(row["end_convs"], np.int64)}
            else:
                at = np.flatnonzero(a["members"])
                up = a["parent"][at]
                more = {name: a[name][at] for name in ("last", "size", "members", "ends", "conv_id")}
                more |= {f"up_{name}": np.where(up < 0, 0, signed(name, up)) for name in ("lo", "hi")}
            yield pa.RecordBatch.from_pydict({"depth": a["depth"][at], "lo": signed("lo", at), "hi": signed("hi", at), **more})

    return run


def _accumulated(band: int):
    """Weights of nodes (by their owners) and the node table of a shard -> sums over the shard's subtrees."""
    schema = pa.schema([(name, pa.int64()) for name in (*_NODE, "children", "leaves", "saved")])

    def run(weights: pa.Table, tables: pa.Table) -> pa.Table:
        if not tables.num_rows:
            return schema.empty_table()
        row = tables.slice(0, 1).to_pylist()[0]
        a = _arrays(row)
        levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(row["levels"], row["places"], strict=True)]
        keys = np.stack([_column(weights, name).astype(np.int64).view(np.uint64) for name in ("lo", "hi", "depth")])
        slot = Slots(levels).find(keys)
        if len(slot) and not (slot >= 0).all() or any((a[name][slot] != key).any() for name, key in (("lo", keys[0]), ("hi", keys[1]))):
            raise AssertionError("a node is not in the table of its owner's shard")
        sums = {name: np.zeros(len(a["lo"]), np.int64) for name in ("children", "leaves", "saved")}
        for name in ("leaves", "saved"):
            np.add.at(sums[name], slot, _column(weights, name))
        own = slot[_column(weights, "own").astype(bool) & (_column(weights, "depth") > 0)]
        np.add.at(sums["children"], a["parent"][own], 1)
        depth = a["depth"]
        # A band's first turn hands nothing up: the end of the band before has the owner's later weights already.
        up = np.flatnonzero((depth > 0) & ((depth % band != 1 % band) | (depth == 1)))
        up = up[np.argsort(-depth[up], kind="stable")]
        for level in np.split(up, np.flatnonzero(np.diff(depth[up])) + 1):
            for name in ("leaves", "saved"):
                np.add.at(sums[name], a["parent"][level], sums[name][level])
        return pa.table({"depth": depth, "lo": a["lo"].view(np.int64), "hi": a["hi"].view(np.int64), **sums}, schema=schema)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks (node, ids as text), in order, to one SHA-256 per node, however many chunks it has."""
    schema = pa.schema([*((name, pa.int64()) for name in _NODE), ("ends_sha256", pa.string())])
    node, state, done = None, None, []
    out = lambda: pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema)
    for batch in batches:
        for *key, ids in zip(*(batch.column(name).to_pylist() for name in (*_NODE, "ids")), strict=True):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
        yield out()
        done = []
    if node is not None:
        done = [(*node, state.hexdigest())]
        yield out()


def turn_key(role: Column, text: Column) -> Column:
    """What tells turns apart: a digest of role and text; null counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def numbered(turns: DataFrame, run: Run) -> DataFrame:
    """(conv_id, at, key, size): every turn's place in its conversation, from 0, its key and its code points.

    Rows are sorted over all partitions, so a conversation may span several; each partition's count of its rows
    gives the places in the next.
    """
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", empty("role").alias("role"), empty("text").alias("text"),
        F.monotonically_increasing_id().alias("tie"))  # so that repeated rows spread
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.monotonically_increasing_id().alias("n"), turn_key(F.col("role"), F.col("text")).alias("key"),
        F.length("text").cast("long").alias("size"))
    placed = run.write(placed, "placed").withColumn("part", F.shiftright("n", 33))
    parts = placed.groupBy("conv_id", "part").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0)))
    return run.write(placed.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("n") - F.col("first") + F.col("before")).alias("at"), "key", "size"), "numbered")


def _starts(rows: DataFrame) -> DataFrame:
    """(conv_id, band, start_lo, start_hi, final): digests before each band of conversations that have several."""
    long_ = rows.where(F.col("band") > 0).groupBy("conv_id").agg(F.max("band").alias("bands"))
    wide = lambda name: F.sum(F.col(name).cast("decimal(20,0)")).cast("decimal(38,0)").alias(name)
    sums = rows.join(long_, "conv_id").groupBy("conv_id", "band", "bands").agg(wide("half_lo"), wide("half_hi"))
    whole = lambda value: F.lit(str(value)).cast("decimal(38,0)")
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)

    def wrapped(name: str) -> Column:
        total = F.pmod(F.coalesce(F.sum(name).over(before), whole(0)), whole(1 << 64))
        return F.when(total >= whole(1 << 63), total - whole(1 << 64)).otherwise(total).cast("long")

    return sums.select("conv_id", "band", wrapped("half_lo").alias("start_lo"), wrapped("half_hi").alias("start_hi"),
                       (F.col("band") == F.col("bands")).alias("final"))


def prefix_trie(turns: DataFrame, roster: DataFrame, run: Run) -> DataFrame:
    """The nodes of all prefixes of ``turns`` (conv_id, depth from 1, key, size) of the conversations in ``roster``
    (conv_id, each once): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256; and lo, hi, the node's digest. Conversations without a turn are members of the root.
    """
    shards = None
    for seed in range(64):  # a clash of 128-bit digests is not to be expected; the next seed has other ones
        half = lambda n: F.xxhash64("key", "depth", F.lit(2 * seed + n))  # noqa: B023, E731
        deep = turns.select("conv_id", "depth", half(0).alias("half_lo"), half(1).alias("half_hi"),
                            F.xxhash64("key").alias("last"), "size")
        top = roster.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in deep.columns[1:]))
        rows = run.write(deep.unionByName(top).withColumn("band", F.floor((F.greatest("depth", F.lit(1)) - 1) / BAND)), f"rows-{seed}")
        shards = shards or max(1, -(-rows.count() // SHARD_ROWS))
        shard_of = lambda band: F.pmod(F.xxhash64("conv_id", band), F.lit(shards)).cast("int")
        starts = run.write(_starts(rows), f"starts-{seed}")
        tables = run.write(
            rows.withColumn("shard", shard_of(F.col("band"))).groupBy("shard").cogroup(
                starts.withColumn("shard", shard_of(F.col("band"))).groupBy("shard")).applyInArrow(_node_table(BAND), _TABLE_DDL),
            f"tables-{seed}")
        found = tables.mapInArrow(_rows("nodes"), "depth long, lo long, hi long, last long, size long, members long, ends long, "
                                  "conv_id long, up_lo long, up_hi long")
        same = lambda name: F.min(name) != F.max(name)
        nodes = run.write(found.groupBy(_NODE).agg(
            F.min("conv_id").alias("conv_id"), F.sum("members").alias("n_convs"), F.sum("ends").alias("ends"), F.max("size").alias("size"),
            F.max("up_lo").alias("up_lo"), F.max("up_hi").alias("up_hi"),
            (same("last") | same("up_lo") | same("up_hi")).alias("clash")), f"nodes-{seed}")
        if nodes.where("clash").isEmpty() and tables.where("clash").isEmpty():
            break
    band = F.floor((F.greatest("depth", F.lit(1)) - 1) / BAND)
    weights = nodes.select("conv_id", *_NODE, ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
                           (F.col("n_convs") == F.col("ends")).cast("long").alias("leaves"), band.alias("band"), F.lit(1).alias("own"))
    # What an owner holds in its later bands, at the last turn of each earlier one.
    later = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    held = starts.join(weights.groupBy("conv_id", "band").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")),
                       ["conv_id", "band"], "left")
    carried = held.select(
        "conv_id", (F.col("band") * BAND).alias("depth"), F.col("start_lo").alias("lo"), F.col("start_hi").alias("hi"),
        *(F.coalesce(F.sum(name).over(later), F.lit(0)).alias(name) for name in ("saved", "leaves")),
        (F.col("band") - 1).alias("band"), F.lit(0).alias("own")).where("band >= 0")
    sums = weights.unionByName(carried).withColumn("shard", shard_of(F.col("band"))).groupBy("shard").cogroup(
        tables.groupBy("shard")).applyInArrow(_accumulated(BAND), "depth long, lo long, hi long, children long, leaves long, saved long")
    totals = sums.groupBy(_NODE).agg(F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    chunk = F.shiftright("conv_id", CHUNK_BITS)
    ends = tables.mapInArrow(_rows("ends"), "depth long, lo long, hi long, conv_id long").groupBy(*_NODE, chunk.alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    digests = ends.repartition(*_NODE).sortWithinPartitions(*_NODE, "chunk").mapInArrow(_digests, "depth long, lo long, hi long, ends_sha256 string")
    full = run.write(nodes.join(totals, _NODE).join(digests, _NODE, "left").select(
        "conv_id", *_NODE, "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        F.struct((F.col("depth") - 1).alias("depth"), F.col("up_lo").alias("lo"), F.col("up_hi").alias("hi")).alias("up")), "full")
    parents = full.where("n_children > 0").select(F.struct(_NODE).alias("up"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("size"))
    below = join_hot(full.where("depth > 0"), parents, "up", "size", full.count()).drop("up", "size")
    return below.unionByName(full.where("depth = 0").drop("up").withColumn("parent_conv_id", F.lit(None).cast("long")))


def rebuilt(own: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns and roster of conversations that begin like the first of their group: the first h turns of
    conversation c - c % ``group`` (a remainder has the sign of c), then c's own turns after its first h, where
    h = crc32(c) % ``most``."""
    heads = own.where((F.col("conv_id") % group == 0) & (F.col("at") < most - 1)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("at", "key", "size"))).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"h": h.cast("int"), "base": F.col("conv_id") - F.col("conv_id") % group})
    convs = convs.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("h")))
    begun = convs.select("conv_id", F.posexplode("head").alias("i", "t")).select(
        "conv_id", (F.col("i") + 1).cast("long").alias("depth"), "t.key", "t.size")
    facts = convs.select("conv_id", "rows", "h", F.size("head").alias("taken"))
    rest = join_hot(own, facts, "conv_id", "rows", own.count()).where(F.col("at") >= F.col("h")).select(
        "conv_id", (F.col("at") - F.col("h") + F.col("taken") + 1).alias("depth"), "key", "size")
    return begun.unionByName(rest), convs.select("conv_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``conversations``, rebuilt to share beginnings within groups of 100 ids: a row per prefix."""
    run = Run(spark, "op11")
    trie = prefix_trie(*rebuilt(numbered(read(spark, sf_dir, "conversations"), run)), run)
    return trie.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# SQL has no CRC-32 here: every character is one step and eight shifts of the usual reversed polynomial.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""
OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list([role, text] ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id
), c AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base, ({_CRC} % 6)::BIGINT AS h FROM own
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:len(c.turns)]) AS turns
  FROM c LEFT JOIN own AS b ON b.conv_id = c.base
), p AS (
  SELECT conv_id, d, turns[1:d] AS path, d = len(turns) AS ends FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r)
), n AS (
  SELECT d AS depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf,
         (count(*) - 1) * coalesce(len(path[d][2]), 0) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY d, path
), up AS (
  SELECT a AS depth, path[1:a] AS path, sum(leaf::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT path, leaf, saved, unnest(range(0, depth + 1)) AS a FROM n) GROUP BY 1, 2
), kids AS (
  SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2
)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN up ON up.depth = n.depth AND up.path = n.path
LEFT JOIN kids ON kids.depth = n.depth AND kids.path = n.path
LEFT JOIN n AS o ON o.depth = n.depth - 1 AND o.path = n.path[1:n.depth - 1]
"""
