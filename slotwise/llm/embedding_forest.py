"""Near-duplicate embeddings: a forest of random-projection trees with overlap, cosines within leaves, components."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.components import connected_components
from slotwise.llm.staging import staged

MIN_COSINE = 0.95
TREES = 6
#: Vectors of a leaf, and of a block of a leaf that cannot be split further.
LEAF, BLOCK = 1024, 2048
#: Levels that a round adds to a node, and rows of it (on average) that they are fitted on.
LEVELS, SAMPLE = 8, 4096
#: Half the overlap of two halves, in standard deviations of the distance along a random direction of two vectors at the bound.
SPILL = 0.5
#: Rows of a node that a task routes, behind one copy of its subtree.
ROUTED = 20_000
#: Directions tried for a split, and the part of the rows that one half may have at most.
TRIES, MOST = 8, 0.8
SEED = 42
#: Cosines that are this near the bound are summed exactly.
DOUBTFUL = 1e-9

_TREE = "struct<ids:array<int>,cuts:array<double>,directions:binary,dense:array<int>>"


def _unit(vectors: pd.Series) -> np.ndarray:
    """Rows of unit length from the bytes of doubles."""
    flat = np.frombuffer(b"".join(map(bytes, vectors)), "<f8").reshape(len(vectors), -1)
    scaled = flat / np.abs(flat).max(1, keepdims=True)  # no square overflows or vanishes
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def margin(dimensions: int, min_cosine: float, spill: float = SPILL) -> float:
    return spill * math.sqrt(max(0.0, 2 - 2 * min_cosine) / dimensions)


def fit(rows: np.ndarray, scale: float, leaf: int, levels: int, overlap: float, seed: list[int]):
    """(ids, cuts, directions, dense) of a subtree over a sample that stands for ``scale`` times as many rows.

    ``ids`` number the split nodes as in a heap from 1; a row goes to 2 * id if its
    projection is at most the cut + ``overlap``, and to 2 * id + 1 if it is at least
    the cut - ``overlap``. Nodes estimated at ``leaf`` rows or fewer are not split,
    nor those in ``dense``, which no direction tried divides well.
    """
    random, todo = np.random.default_rng(seed), [(1, rows, 0)]
    ids, cuts, directions, dense = [], [], [], []
    while todo:
        node, part, level = todo.pop()
        if len(part) * scale <= leaf or level == levels:
            continue
        for _ in range(TRIES):
            direction = random.standard_normal(rows.shape[1])
            direction /= np.linalg.norm(direction)
            at = part @ direction
            cut = float(np.median(at))
            left, right = at <= cut + overlap, at >= cut - overlap
            if max(left.sum(), right.sum()) <= MOST * len(part):
                ids.append(node)
                cuts.append(cut)
                directions.append(direction)
                todo += [(2 * node, part[left], level + 1), (2 * node + 1, part[right], level + 1)]
                break
        else:
            dense.append(node)
    return ids, cuts, np.array(directions, np.float64).tobytes(), dense


def route(rows: np.ndarray, ids, cuts, directions: bytes, dense, overlap: float) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(heap node, places of rows, whether dense) for the ends of a subtree that rows fall into."""
    splits = dict(zip(ids, zip(cuts, np.frombuffer(directions).reshape(len(ids), rows.shape[1]), strict=True), strict=True))
    dense, todo = set(dense), [(1, np.arange(len(rows)))]
    while todo:
        node, places = todo.pop()
        if node not in splits:
            yield node, places, node in dense
            continue
        cut, direction = splits[node]
        at = rows[places] @ direction
        for child, held in ((2 * node, at <= cut + overlap), (2 * node + 1, at >= cut - overlap)):
            if held.any():
                todo.append((child, places[held]))


def _below(node: int, heap: int) -> int:
    """The number, in the whole tree, of a node that is ``heap`` in the subtree below ``node``."""
    depth = heap.bit_length() - 1
    return (node << depth) | (heap - (1 << depth))


def leaves(nodes: DataFrame, min_cosine: float, trees: int, leaf: int, spill: float) -> DataFrame:
    """(id, dim, vector, tree, node) for every leaf that each of ``nodes`` (id, dim, vector) is in.

    Trees grow in rounds of up to ``LEVELS`` levels. Every node of more than
    ``leaf`` rows is fitted on a sample of its rows, about ``SAMPLE`` whatever
    its size, and all its rows are then routed. Rounds end when all nodes are
    small, or dense. A node is named as in a heap over the whole tree.
    """
    schema = "id bigint, dim int, vector binary, tree int, node bigint, closed boolean"
    keys = ["dim", "tree", "node"]

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        dim, tree, node = (int(first[k]) for k in keys)
        rows, scale = _unit(group["vector"]), float(first["n"]) / len(group)
        found = fit(rows, scale, leaf, LEVELS, margin(dim, min_cosine, spill), [SEED, dim, tree, node])
        return pd.DataFrame([[dim, tree, node, *found]], columns=[*keys, "ids", "cuts", "directions", "dense"])

    def routed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        below = {}  # the subtree of the node whose rows follow
        for batch in batches:
            for (dim, tree, node), group in batch.groupby(keys):
                for subtree in group["below"].dropna():
                    below = {(dim, tree, node): subtree}
                group = group[group["id"].notna()]
                if len(group):
                    parts = [below[dim, tree, node][k] for k in ("ids", "cuts", "directions", "dense")]
                    for heap, places, dense in route(_unit(group["vector"]), *parts, margin(int(dim), min_cosine, spill)):
                        out = group.iloc[places][["id", "dim", "vector", "tree"]]
                        yield out.assign(id=out["id"].astype("int64"), node=_below(int(node), heap), closed=dense)

    roots = nodes.withColumn("tree", F.explode(F.expr(f"sequence(0, {trees - 1})")))
    state = roots.withColumns({"node": F.lit(1).cast("bigint"), "closed": F.lit(False)})
    ended = []
    while True:
        sizes = state.where("not closed").groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > leaf)
        sizes = staged(sizes)
        if sizes.isEmpty():
            break
        large = state.where("not closed").join(sizes, keys)
        drawn = large.where(F.pmod(F.xxhash64("id", "tree", "node"), F.col("n")) < SAMPLE)
        kinds = ", ".join(f"{k} {t}" for k, t in zip(keys, ("int", "int", "bigint"), strict=True))
        subtrees = drawn.groupBy(*keys).applyInPandas(fitted, f"{kinds}, ids array<int>, cuts array<double>, directions binary, dense array<int>")
        subtrees = staged(subtrees.select(*keys, F.struct("ids", "cuts", "directions", "dense").cast(_TREE).alias("below")))
        ended.append(state.where("closed").unionByName(state.where("not closed").join(sizes, keys, "left_anti")))
        # rows and, before them, a copy of their node's subtree meet by node and share
        shares = F.expr(f"cast(n div {ROUTED} as int)")
        rows = large.withColumns({"share": F.pmod(F.xxhash64("id"), shares + 1).cast("int"), "below": F.lit(None).cast(_TREE)})
        heads = subtrees.join(sizes, keys).withColumn("share", F.explode(F.sequence(F.lit(0), shares)))
        both = rows.select("id", *keys, "vector", "share", "below").unionByName(heads.select(*keys, "share", "below"), allowMissingColumns=True)
        met = both.repartition(*keys, "share").sortWithinPartitions(*keys, "share", F.asc_nulls_first("id"))
        state = staged(met.mapInPandas(routed, schema))
    out = state
    for part in ended:
        out = out.unionByName(part)
    return out.select("id", "dim", "vector", "tree", "node")


def compare(group: pd.DataFrame, min_cosine: float) -> pd.DataFrame:
    """(id, n, root) for the vectors of a tile that have links in it which belong to it.

    ``n`` counts the linked vectors with their copies, ``root`` is the smallest id
    of those that its links lead to within the tile. A pair that shares several
    leaves belongs to the first of these alone.
    """
    group = group.sort_values("id", kind="stable").reset_index(drop=True)
    here, tile = int(group["leaf"].iloc[0]), (int(group["i"].iloc[0]), int(group["j"].iloc[0]))
    x, block = _unit(group["vector"]), group["block"].to_numpy()
    near = _linked(x, min_cosine)
    if tile[0] != tile[1]:
        near &= block[:, None] != block[None, :]
    a, b = np.nonzero(np.triu(near, 1))
    if not len(a):
        return pd.DataFrame({"id": [], "n": [], "root": []})
    members = np.unique(np.concatenate([a, b]))
    # leaves before this one that two members share own the pair
    before = [[k for k in group["leaves"].iloc[m] if k < here] for m in members]
    codes = {k: i for i, k in enumerate(sorted({k for ks in before for k in ks}))}
    if codes:
        held = np.zeros((len(members), len(codes)), np.float32)
        for row, ks in enumerate(before):
            held[row, [codes[k] for k in ks]] = 1
        shared = held @ held.T > 0
        own = ~shared[np.searchsorted(members, a), np.searchsorted(members, b)]
        a, b = a[own], b[own]
    copies = group["copies"].to_numpy(np.int64)
    n = np.zeros(len(group), np.int64)
    np.add.at(n, a, copies[b])
    np.add.at(n, b, copies[a])
    root = np.arange(len(group))
    while True:  # smallest member reached, halving the way each time
        before_ = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before_).all():
            break
    with_links = np.flatnonzero(n)
    ids = group["id"].to_numpy(np.int64)
    return pd.DataFrame({"id": ids[with_links], "n": n[with_links], "root": ids[root[with_links]]})


def _linked(x: np.ndarray, min_cosine: float) -> np.ndarray:
    cosines = x @ x.T
    near = cosines >= min_cosine
    for i, j in zip(*np.nonzero(np.abs(cosines - min_cosine) < DOUBTFUL), strict=True):
        near[i, j] = math.fsum(x[i] * x[j]) >= min_cosine * math.sqrt(math.fsum(x[i] * x[i]) * math.fsum(x[j] * x[j]))
    return near


def near_duplicates(
    rows: DataFrame, min_cosine: float = MIN_COSINE, trees: int = TREES, leaf: int = LEAF, block: int = BLOCK, spill: float = SPILL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``rows`` (vec_id, embedding).

    Vectors link where their cosine is ``min_cosine`` or more. Candidates share a
    leaf of one of the ``trees``, and all pairs of a leaf are held against the
    bound, so no link found is false; a pair is missed if it is parted in every
    tree. Equal vectors are one node of the trees and link for certain.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest vec_id that links lead to, itself included, and a row is kept if that is
    its own. Vectors that are null or zero, or that hold a null or a non-finite
    number, link with nothing; vectors of different length do not either. Rows
    that repeat a vec_id are vectors of their own; a null vec_id is never the
    smallest, and a class of null ids alone has a null component. An empty
    table gives an empty one. Other columns are not read.

    No pair leaves a leaf: a vector has one row for each leaf it has links in, with
    their number and the root of its part. Leaves that no cut divides, as of
    near copies by the thousand, are compared in tiles of two blocks.
    """
    vector = F.col("embedding").cast("array<double>")
    size = F.aggregate("v", F.lit(0.0).cast("double"), lambda s, x: F.greatest(s, F.abs(x)))
    usable = F.coalesce(F.expr("forall(v, x -> x is not null and not isnan(x))") & (size > 0) & (size < float("inf")), F.lit(False))
    typed = rows.select("vec_id", vector.alias("v")).withColumn("v", F.when(usable, F.col("v")))
    typed = staged(typed)
    packed = _packed(typed.where("v is not null").groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id")))
    nodes = staged(packed.withColumn("id", F.monotonically_increasing_id()))
    found = staged(leaves(nodes.select("id", "dim", "vector"), min_cosine, trees, leaf, spill))

    names = staged(found.groupBy("dim", "tree", "node").agg(F.count("*").alias("rows")))
    names = staged(names.withColumn("leaf", F.monotonically_increasing_id()))
    placed = staged(found.join(names, ["dim", "tree", "node"]).select("id", "vector", "leaf", "rows"))
    of_each = placed.groupBy("id").agg(F.collect_list("leaf").alias("leaves"))
    known = nodes.select("id", "copies").join(of_each, "id")
    blocks = F.expr(f"cast(ceil(rows / {block}) as int)")
    members = placed.where("rows > 1").join(known, "id").withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    tiles = members.select("id", "vector", "copies", "leaves", "leaf", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    links = staged(tiles.groupBy("leaf", "i", "j").applyInPandas(lambda group: compare(group, min_cosine), "id bigint, n bigint, root bigint"))

    classes = connected_components(links.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct())
    classes = classes.withColumnsRenamed({"node": "id", "component": "root"})
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    rooted = nodes.select("id", "dim", "vector", "copies", "first_id").join(classes, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = staged(rooted.join(counts, "id", "left"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    n_links = (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
    judged = rooted.join(smallest, "root").select("vector", n_links, "component_id")
    linked = _packed(typed.where("v is not null")).join(judged, "vector").select("vec_id", "n_links", "component_id")
    alone = typed.where("v is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _packed(rows: DataFrame) -> DataFrame:
    """``rows`` with dim and vector, the bytes of its doubles, for ``v``."""

    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        return pd.Series([(np.asarray(v, "<f8") + 0.0).tobytes() for v in vectors])

    return rows.withColumns({"dim": F.size("v"), "vector": pack("v")}).drop("v")
