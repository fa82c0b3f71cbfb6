"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Documents with equal sets are one class. Every tree
sends each class down a path: at each level to the child named by its least shingle under that level's
hash, so that two similar sets stay together with a probability of their similarity. A node that is small
is a leaf and is compared exhaustively, first by byte sketches and then, for what is likely similar, on
full sets; a large node branches on. Independent trees are repeated to reach the target recall. Links
are joined to components.

A node that is still large after the last level holds documents that are mostly alike. It is cut into
blocks; each block also gets the node's pivots, which tie the blocks together. The sets of nodes that are
not one component by then go through an exact prefix-filter join: each is sent to its rarest shingles, so many
that sets of that similarity must meet in one, and what meets in another component is compared. So no pair is
left out, and sets that merely share frequent shingles do not meet. What many sets share is cut into pairs of
blocks, so a leaf stays bounded.

With similarity s, a pair in leaves of depth d is missed by all trees with probability (1 - s^d)^trees:
below 1e-8 for s = 0.85 and d = 1, where nearly all pairs end.

Cases: null and empty texts have an empty set, are linked with nothing and stay. Fewer words than a
shingle make one shingle. Rows with equal sets, also rows that repeat a ``doc_id``, are one class; a
component is named by its smallest ``doc_id``, null if it has none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import Run, join_hot, read
from gridspark.llm.components import components
from gridspark.llm.words import mix, slices, split_words, windows

SHINGLE = 5
TREES, DEPTH = 12, 4
#: Rows and shingles of a leaf at most.
LEAF_ROWS, LEAF_SHINGLES = 256, 4_000_000
PIVOTS = 16
#: Shingles with at least this share of all are ordered by their number, so there are at most half a million.
COMMON_SHARE = 1 / 500_000
#: Sketch bytes that must agree for a full comparison; 0.85 is 5.5 standard deviations above.
SKETCH_SLACK = 5.5


def _shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    words = split_words(column, lower=True)
    hashes = words.hashes()
    grams = windows(hashes, width)
    for low, high in zip(words.first[:-1], words.first[1:], strict=True):
        if high - low >= width:
            yield np.unique(grams[low : high - width + 1])
        elif high > low:
            yield windows(hashes[low:high], int(high - low))
        else:
            yield np.zeros(0, np.uint64)


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:n], numbers[n:] | np.uint64(1)


def _sign(width: int, trees: int, depth: int):
    """Per text: size and 128-bit digest of its set, the tokens of its paths, and a byte sketch."""
    xors, factors = _seeds(trees * depth)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = list(_shingle_sets(part.column("text"), width))
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                digests, least = np.zeros((len(sets), 2), np.uint64), np.zeros((len(sets), trees * depth), np.uint64)
                if len(full):
                    every, first = np.concatenate(sets), (np.cumsum(sizes) - sizes)[full]
                    digests[full, 0] = np.add.reduceat(mix(every), first)
                    digests[full, 1] = np.add.reduceat(mix(every ^ np.uint64(0x5851F42D4C957F2D)), first)
                    for k in range(trees * depth):
                        least[full, k] = np.minimum.reduceat((every ^ xors[k]) * factors[k], first)
                tokens = mix(least).view(np.uint32)[:, ::2]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("mark"), pa.array(sizes, pa.int64()),
                     pa.array([bytes(d) for d in digests], pa.binary()),
                     pa.array([t.tobytes() for t in np.ascontiguousarray(tokens)], pa.binary()),
                     pa.array([s.tobytes() for s in tokens.astype(np.uint8)], pa.binary())],
                    ["doc_id", "mark", "n_shingles", "set_id", "tokens", "sketch"],
                )

    return run


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Groups of consecutive rows with an equal key, over batch borders."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        keys = table.column(key).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        low = 0
        for high in cuts:
            yield table.slice(low, high - low)
            low = high
        held = table.slice(low).combine_chunks() if table.num_rows else held
    if held is not None and held.num_rows:
        yield held


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _alike(sketches: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows whose sketches agree in at least ``need`` bytes, the closest first."""
    found = []
    for i in range(len(sketches) - 1):
        same = (sketches[i + 1 :] == sketches[i]).sum(1)
        j = np.flatnonzero(same >= need)
        found.append((np.full(len(j), i), j + i + 1, same[j]))
    a, b, same = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, int) for k in range(3))
    order = np.argsort(-same, kind="stable")
    return a[order], b[order], same[order]


def _sketches(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _clusters(need: int):
    """Leaves to clusters: members that likely similar pairs tie together; single ones go."""

    def run(batches):
        for leaf in _runs(batches, "leaf"):
            sketches = _sketches(leaf.column("sketch"))
            forest = _Forest(len(sketches))
            for a, b in zip(*_alike(sketches, need)[:2], strict=True):
                forest.join(int(a), int(b))
            roots = np.array([forest.root(i) for i in range(len(sketches))])
            sets = np.array(leaf.column("set_id").to_pylist(), object)
            for root, n in zip(*np.unique(roots, return_counts=True), strict=True):
                if n > 1:
                    members = sorted(set(sets[roots == root]))
                    if len(members) > 1:
                        code = np.frombuffer(b"".join(members), np.uint64)
                        name = int(windows(mix(code), len(code)).view(np.int64)[0])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(members), pa.int64()), pa.array(members, pa.binary())],
                            ["cluster", "set_id"],
                        )

    return run


def _links(width: int, percent: int, need: int):
    """Clusters to links that full sets confirm, without those inside what is joined already."""

    def run(batches):
        for cluster in _runs(batches, "cluster"):
            ids, sketches = cluster.column("set_id").to_pylist(), _sketches(cluster.column("sketch"))
            sets = []
            for batch in cluster.select(["text"]).to_batches():
                for part in slices(batch):
                    sets.extend(_shingle_sets(part.column("text"), width))
            forest = _Forest(len(ids))
            for a, b in zip(*_alike(sketches, need)[:2], strict=True):
                a, b = int(a), int(b)
                if forest.root(a) != forest.root(b):
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and both:
                        forest.join(a, b)
            # Stars, not chains: few rounds join them to components.
            found = [(ids[forest.root(i)], ids[i]) for i in range(len(ids)) if forest.root(i) != i]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], ["a", "b"]
                )

    return run


def _leaves(sets: DataFrame, run: Run, trees: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """(leaf, set_id, sketch) of the leaves, one DataFrame per level; and the nodes still large."""
    rows = sets.select("set_id", "n_shingles", "sketch", "tokens", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    rows = rows.withColumn("tokens", F.expr(f"substring(tokens, tree * {depth * 4} + 1, {depth * 4})"))
    rows = rows.withColumn("node", F.xxhash64("tree", F.substring("tokens", 1, 4)))
    leaves = []
    for level in range(depth):
        nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("shingles"))
        nodes = run.write(nodes.where("rows > 1"), f"nodes-{level}")
        kept = run.write(join_hot(rows, nodes, "node", "rows", rows.count()), f"kept-{level}")
        small = (F.col("rows") <= LEAF_ROWS) & (F.col("shingles") <= LEAF_SHINGLES)
        leaves.append(kept.where(small).select(F.col("node").alias("leaf"), "set_id", "sketch"))
        rows = kept.where(~small)
        if level == depth - 1 or rows.isEmpty():
            break
        token = F.substring("tokens", level * 4 + 5, 4)
        rows = rows.drop("rows", "shingles").withColumn("node", F.xxhash64("node", token))
    return leaves, rows


def _blocks(large: DataFrame, pivots: DataFrame) -> DataFrame:
    """Large nodes as leaves: blocks of some rows, each joined by the pivots of its node."""
    n = F.greatest(F.ceil(F.col("rows") / (LEAF_ROWS // 2)), F.ceil(F.col("shingles") / (LEAF_SHINGLES // 2))).cast("int")
    own = large.select("node", F.pmod(F.xxhash64("set_id", "tree"), n).cast("int").alias("block"), "set_id", "sketch")
    came = pivots.select("node", F.explode(F.sequence(F.lit(0), n - 1)).alias("block"), "set_id", "sketch")
    return own.unionByName(came).select(F.xxhash64("node", "block").alias("leaf"), "set_id", "sketch")


def _shingles(width: int):
    """All shingles of the texts, for counting."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                for found in _shingle_sets(part.column("text"), width):
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["token"])

    return run


def _prefixes(width: int, percent: int, common: np.ndarray, counts: np.ndarray):
    """Per set its rarest shingles, as many as a similar set that is not smaller (``first``) or not larger must
    meet one of. Any fixed order of shingles is exact; by the counts of the ``common`` ones few sets meet."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                for k, found in enumerate(_shingle_sets(part.column("text"), width)):
                    n = len(found)
                    ranks = np.zeros(n, np.int64)
                    if len(common):
                        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
                        ranks = np.where(common[at] == found, counts[at], 0)
                    # The least overlap with a set of n or more, and with one of n or fewer shingles.
                    larger, smaller = n + 1 + (-2 * percent * n) // (100 + percent), n + 1 + (-percent * n) // 100
                    tokens = found[np.lexsort((found, ranks))[:smaller]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tokens.view(np.int64)), pa.array(np.arange(len(tokens)) < larger), pa.array([n] * len(tokens), pa.int64()),
                         *(pa.array([part.column(c)[k].as_py()] * len(tokens), pa.binary()) for c in ("set_id", "root"))],
                        ["token", "first", "n_shingles", "set_id", "root"],
                    )

    return run


def _met(percent: int, need: int):
    """Leaves to clusters: what pairs of different components tie together that are likely similar."""

    def run(batches):
        for leaf in _runs(batches, "leaf"):
            sketches, sizes = _sketches(leaf.column("sketch")), leaf.column("n_shingles").to_numpy()
            ids = leaf.column("set_id").to_pylist()
            roots = np.unique(np.array(leaf.column("root").to_pylist(), object), return_inverse=True)[1]
            forest, tied = _Forest(len(ids)), np.zeros(len(ids), bool)
            for i in range(len(ids) - 1):
                j = np.flatnonzero(roots[i + 1 :] != roots[i]) + i + 1
                j = j[100 * np.minimum(sizes[j], sizes[i]) >= percent * np.maximum(sizes[j], sizes[i])]
                for j in j[(sketches[j] == sketches[i]).sum(1) >= need]:
                    forest.join(i, int(j))
                    tied[[i, j]] = True
            groups = {}
            for i in np.flatnonzero(tied):
                groups.setdefault(forest.root(int(i)), set()).add(ids[i])
            for members in map(sorted, groups.values()):
                code = np.frombuffer(b"".join(members), np.uint64)
                name = int(windows(mix(code), len(code)).view(np.int64)[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(members), pa.int64()), pa.array(members, pa.binary())], ["cluster", "set_id"]
                )

    return run


def _meetings(pool: DataFrame, texts: DataFrame, run: Run, width: int, percent: int) -> DataFrame:
    """(leaf, set_id, root, sketch, n_shingles): the sets of the pool (set_id, root, sketch, n_shingles) that meet in a
    shingle, in leaves of bounded size, every pair of different components in one leaf or more."""
    held = run.write(texts.select("set_id", "text").join(pool.select("set_id", "root"), "set_id"), "pool-texts")
    total = pool.agg(F.sum("n_shingles")).first()[0]
    common = held.mapInArrow(_shingles(width), "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    common = common.where(F.col("n") >= max(2.0, total * COMMON_SHARE)).toArrow()
    tokens = common.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    prefixes = run.write(
        held.mapInArrow(_prefixes(width, percent, tokens[order], common.column("n").to_numpy()[order]),
                        "token long, first boolean, n_shingles long, set_id binary, root binary"),
        "prefixes",
    )
    # The heaviest component of a shingle is tied: its rows need not meet each other there.
    # A side of a shingle is as many blocks as its rows and their sets ask for.
    blocks = lambda rows, sizes: F.ceil(F.greatest(rows / (LEAF_ROWS // 2), sizes / (LEAF_SHINGLES // 2))).cast("int")
    weights = prefixes.groupBy("token", "root").agg(
        F.count(F.lit(1)).alias("weight"), F.count_if("first").alias("firsts"), F.sum("n_shingles").alias("size"),
        F.sum(F.when(F.col("first"), F.col("n_shingles")).otherwise(0)).alias("first_size"))
    groups = weights.groupBy("token").agg(
        F.sum("weight").alias("rows"), F.sum("firsts").alias("all_firsts"), F.sum("size").alias("shingles"),
        F.sum("first_size").alias("all_first_size"), F.count(F.lit(1)).alias("roots"),
        F.max(F.struct("weight", "root", "firsts", "size", "first_size")).alias("tied"))
    groups = run.write(groups.where("roots > 1 and all_firsts > 0").drop("roots"), "meeting")
    met = join_hot(prefixes.drop("n_shingles"), groups, "token", "rows", prefixes.count())
    met = run.write(met.join(pool.drop("root").hint("merge"), "set_id"), "met")
    small = (F.col("rows") <= LEAF_ROWS) & (F.col("shingles") <= LEAF_SHINGLES)
    whole = met.where(small).withColumn("leaf", F.xxhash64("token"))
    # Large ones: blocks of rows that come first against blocks of all rows, but for tied against tied.
    many = met.where(~small).withColumn("is_tied", F.col("root") == F.col("tied.root"))
    n = {("first", True): blocks(F.col("tied.firsts"), F.col("tied.first_size")),
         ("first", False): blocks(F.col("all_firsts") - F.col("tied.firsts"), F.col("all_first_size") - F.col("tied.first_size")),
         ("any", True): blocks(F.col("tied.weight"), F.col("tied.size")),
         ("any", False): blocks(F.col("rows") - F.col("tied.weight"), F.col("shingles") - F.col("tied.size"))}
    leaves = whole
    for side, other in (("first", "any"), ("any", "first")):
        for tied in (True, False):
            rows = many.where(F.col("is_tied") if tied else ~F.col("is_tied"))
            rows = rows.where("first") if side == "first" else rows
            mine = F.pmod(F.xxhash64("set_id", "token"), n[side, tied]).cast("int")
            for against in (False,) if tied else (True, False):
                pairs = rows.where(n[other, against] > 0).withColumn("block", mine).withColumn(
                    "with", F.explode(F.sequence(F.lit(0), n[other, against] - 1)))
                key = ["block", "with"] if side == "first" else ["with", "block"]
                flags = [tied, against] if side == "first" else [against, tied]
                leaves = leaves.unionByName(
                    pairs.withColumn("leaf", F.xxhash64("token", *map(F.lit, flags), *key)).drop("is_tied", "block", "with"))
    return leaves.select("leaf", "set_id", "root", "sketch", "n_shingles")


def near_duplicates(
    docs: DataFrame, run: Run, *, percent: int = 85, shingle: int = SHINGLE, trees: int = TREES, depth: int = DEPTH
) -> DataFrame:
    """Per row of ``docs``: doc_id, mark (a hash of the text), n_shingles, component_id, kept.

    Two documents are linked when 100 * intersection >= percent * union of their shingle sets.
    """
    share, drawn = percent / 100, trees * depth
    need = int(drawn * share - SKETCH_SLACK * (drawn * share * (1 - share)) ** 0.5)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("mark"))
    signed = run.write(
        docs.mapInArrow(
            _sign(shingle, trees, depth),
            "doc_id long, mark long, n_shingles long, set_id binary, tokens binary, sketch binary",
        ),
        "signed",
    )
    sized = signed.where("n_shingles > 0")
    sets = run.write(
        sized.groupBy("set_id").agg(
            F.min(F.struct("doc_id", "mark")).alias("first"), F.min("doc_id").alias("least"),
            F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
            F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"),
        ),
        "sets",
    )

    def clusters(leaves: DataFrame, of, name: str) -> DataFrame:
        """What is likely alike within a leaf."""
        return run.write(
            leaves.repartition(parts, "leaf").sortWithinPartitions("leaf")
            .mapInArrow(of, "cluster long, set_id binary").distinct(),
            f"{name}-clusters",
        )

    def confirm(found: DataFrame, name: str) -> DataFrame:
        """The links within clusters, as a table."""
        return run.write(
            found.join(texts, "set_id").repartition(parts, "cluster").sortWithinPartitions("cluster")
            .mapInArrow(_links(shingle, percent, need), "a binary, b binary"),
            f"{name}-links",
        )

    levels, large = _leaves(sets, run, trees, depth)
    cut = not large.isEmpty()
    if cut:
        order = Window.partitionBy("node").orderBy(F.xxhash64("tree", "set_id"), "set_id")
        pivots = run.write(large.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIVOTS), "pivots")
        levels.append(_blocks(large, pivots))
    leaves = levels[0]
    for level in levels[1:]:
        leaves = leaves.unionByName(level)
    found = clusters(leaves, _clusters(need), "leaves")
    # The texts that may have to be compared, read and shuffled once; their number is not bounded.
    members = sets.join(found.select("set_id").unionByName(large.select("set_id")).distinct(), "set_id", "left_semi")
    members = members.select("set_id", "sketch", "first.*").withColumnRenamed("doc_id", "least")
    texts = run.write(
        docs.join(members.hint("merge"), F.col("doc_id").eqNullSafe(F.col("least")) & (docs["mark"] == members["mark"]))
        .select("set_id", "sketch", "text").dropDuplicates(["set_id"]),
        "texts",
    )
    links = confirm(found, "leaves")
    roots = components(links, run).withColumnRenamed("node", "set_id")
    if cut:
        rooted = lambda df: df.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
        held = run.write(rooted(large.select("node", "set_id", "sketch", "n_shingles")), "held")
        mixed = held.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("root").alias("a"), F.max("root").alias("b"))
        mixed = run.write(mixed.where("a <> b").select("node", "rows"), "mixed")
        if not mixed.isEmpty():
            pool = join_hot(held, mixed, "node", "rows", held.count()).select("set_id", "root", "sketch", "n_shingles")
            pool = run.write(pool.dropDuplicates(["set_id"]), "pool")
            more = confirm(clusters(_meetings(pool, texts, run, shingle, percent), _met(percent, need), "met"), "met")
            if not more.isEmpty():
                stars = roots.select(F.col("set_id").alias("a"), F.col("root").alias("b"))
                roots = components(stars.unionByName(more), run, "all-components").withColumnRenamed("node", "set_id")
    rooted = run.write(
        sets.select("set_id", "least", "copies").join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id")),
        "rooted",
    )
    named = run.write(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members")), "named")
    facts = run.write(join_hot(rooted, named, "root", "members", rooted.count()).select("set_id", "copies", "component_id"), "facts")
    columns = ["doc_id", "mark", "n_shingles", "component_id"]
    report = join_hot(sized, facts, "set_id", "copies", sized.count()).select(columns).unionByName(
        signed.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")).select(columns)
    )
    return report.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def survivors(docs: DataFrame, report: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the report keeps, with all their columns; repeated rows stay repeated."""
    keys = report.where("kept").select(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"))
    return docs.join(
        keys, docs["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(docs["text"]) == F.col("_mark")), "left_semi"
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: the component of each at a similarity of 0.85 on five-word shingles."""
    return near_duplicates(read(spark, sf_dir, "documents"), Run(spark, "op10")).drop("mark")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), t AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d
), w AS (
  SELECT doc_id, i, n, sha256(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) AS s FROM t
), g AS (
  SELECT DISTINCT doc_id, s FROM w WHERE i = 1 OR i + 4 <= n
), c AS (
  SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM g AS a JOIN g AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN c AS p ON p.doc_id = x JOIN c AS q ON q.doc_id = y WHERE 100 * common >= 85 * (p.size + q.size - common)
), reach AS (
  SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), low AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(size, 0) AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low.y, d.doc_id) AS kept
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN low ON low.x = d.doc_id
"""
