"""Exact top-k inner products by best-first search of M-trees.

Inner products are turned into a metric: with M at least every vector's norm, x
becomes (x, sqrt(M^2 - |x|^2)) and a query (q, 0); then the squared distance is
|q|^2 + M^2 - 2 q.x, so the nearest vectors have the greatest products. Vectors
are dealt evenly into chunks of bounded size; each chunk's tree is a set of
pages, one row each: a routing vector, the covering radius, the distance to the
parent's routing vector, and for leaves the members with their distances.

A search visits pages by their best possible product and leaves off when none
can reach the k-th found. Members are skipped without a product where the
triangle inequality over the stored distances rules them out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import NULL_ID

CHUNK_ROWS = 8192  # vectors of one tree
BLOCK_ROWS = 2048  # queries that search a tree together
PAGE = 512  # members of a leaf
FANOUT = 16  # children of an inner page
TOGETHER = 1024  # queries that go through a tree side by side

_PAGE_SCHEMA = (
    "chunk long, page int, parent int, radius double, to_parent double, bound double, routing binary, "
    "rows binary, ids binary, vectors binary, distances binary"
)


def grow(points: np.ndarray) -> list[tuple[int, np.ndarray, float, float, np.ndarray]]:
    """Pages of a tree over ``points``: parent, routing vector, radius, distance to the parent's, members (leaves)."""
    pages: list = []
    todo = [(np.arange(len(points)), -1)]
    while todo:
        members, parent = todo.pop()
        own = points[members]
        routing = own[((own - own.mean(axis=0)) ** 2).sum(axis=1).argmin()]
        away = np.sqrt(((own - routing) ** 2).sum(axis=1))
        to_parent = float(np.sqrt(((routing - pages[parent][1]) ** 2).sum())) if parent >= 0 else 0.0
        leaf = len(members) <= PAGE
        page = len(pages)
        pages.append((parent, routing, float(away.max()), to_parent, members if leaf else members[:0]))
        if leaf:
            continue
        # routing vectors of the children: each the farthest from those before it
        nearest, owner = np.full(len(members), np.inf), np.zeros(len(members), np.int64)
        at = int(away.argmax())
        for n in range(FANOUT):
            d = ((own - own[at]) ** 2).sum(axis=1)
            owner[d < nearest] = n
            nearest = np.minimum(nearest, d)
            at = int(nearest.argmax())
            if nearest[at] == 0:
                break
        parts = [members[owner == n] for n in np.unique(owner)]
        if len(parts) == 1:  # equal vectors
            parts = np.array_split(members, -(-len(members) // PAGE))
        todo += [(p, page) for p in parts]
    return pages


def _plant(frame: pd.DataFrame) -> pd.DataFrame:
    """The pages of one chunk's tree."""
    vectors = np.stack([np.frombuffer(v, np.int64) for v in frame["vector"]]).astype(np.float64)
    norms = (vectors**2).sum(axis=1)
    bound = float(norms.max())
    points = np.column_stack([vectors, np.sqrt(bound - norms)])
    known = frame["vec_id"].to_numpy(np.int64)
    rows = frame["_row"].to_numpy(np.int64)
    out = []
    for n, (parent, routing, radius, to_parent, members) in enumerate(grow(points)):
        away = np.sqrt(((points[members] - routing) ** 2).sum(axis=1))
        parts = (routing, rows[members], known[members], vectors[members], away)
        out.append((frame["chunk"].iloc[0], n, parent, radius, to_parent, bound, *(p.tobytes() for p in parts)))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _PAGE_SCHEMA.split(", ")])


class Tree:
    """The pages of one chunk, ready to be searched."""

    def __init__(self, pages: pd.DataFrame):
        pages = pages.sort_values("page")
        self.bound = float(pages["bound"].iloc[0])
        self.radius = pages["radius"].to_numpy()
        self.to_parent = pages["to_parent"].to_numpy()
        self.routing = np.stack([np.frombuffer(r) for r in pages["routing"]])
        self.rows = [np.frombuffer(r, np.int64) for r in pages["rows"]]
        self.ids = [np.frombuffer(r, np.int64) for r in pages["ids"]]
        size = self.routing.shape[1] - 1
        self.vectors = [np.frombuffer(v).reshape(-1, size) for v in pages["vectors"]]
        self.distances = [np.frombuffer(d) for d in pages["distances"]]
        parents = pages["parent"].to_numpy()
        self.children = [np.flatnonzero(parents == n) for n in range(len(pages))]

    def _away(self, points: np.ndarray, pages: np.ndarray) -> np.ndarray:
        """Distances of some queries to the routing vectors of some pages."""
        return np.sqrt(((points[:, None, :] - self.routing[None, pages, :]) ** 2).sum(axis=2))

    def top(self, queries: np.ndarray, own_rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, id and product of every query's ``k`` greatest products, ties to smaller ids, without its own row.

        Every query first visits the page that promises most to it. Pages then come
        in the order of their best possible product, each for those queries together
        that could still find something in it.
        """
        search = _Search(self, queries, own_rows, k)
        # the page at the end of the most promising path gives each query a first k-th product
        page, away = np.zeros(len(queries), np.int64), self._away(search.points, np.zeros(1, np.int64))[:, 0]
        inner = np.array([len(c) > 0 for c in self.children])
        while inner[page].any():
            for p in np.unique(page[inner[page]]):
                here, children = np.flatnonzero(page == p), self.children[p]
                d = self._away(search.points[here], children)
                chosen = (d - self.radius[children]).argmin(axis=1)
                page[here], away[here] = children[chosen], d[np.arange(len(here)), chosen]
        for p in np.unique(page):
            here = np.flatnonzero(page == p)
            search.visit(p, here, away[here])
        bounds, distances = self._leaves(search)
        bounds[np.arange(len(queries)), page] = -np.inf
        # then the pages by the best that any query may find there
        for p in np.argsort(-bounds.max(axis=0)):
            here = np.flatnonzero(bounds[:, p] >= search.least)
            here = here[np.isfinite(bounds[here, p])]
            if len(here):
                search.visit(p, here, distances[here, p])
        return search.of, search.ids, search.scores.astype(np.int64)

    def _leaves(self, search: _Search) -> tuple[np.ndarray, np.ndarray]:
        """Each query's best possible product in every leaf, -inf where a bound above rules it out, and its distance."""
        shape = (len(search.points), len(self.children))
        bounds, away = np.full(shape, -np.inf), np.full(shape, np.inf)
        away[:, 0] = self._away(search.points, np.zeros(1, np.int64))[:, 0]
        every = np.arange(shape[0])
        for p, children in enumerate(self.children):  # parents stand before their children
            best = search.best(every, away[:, p] - self.radius[p])
            alive = np.flatnonzero((best >= search.least) & np.isfinite(away[:, p]))
            if not len(children):
                bounds[alive, p] = best[alive]
                continue
            # a child is measured only where its stored distance to the parent leaves it a chance
            reach = np.abs(away[alive, p][:, None] - self.to_parent[children]) - self.radius[children]
            chance = search.best(alive[:, None], reach) >= search.least[alive][:, None]
            some, wanted = chance.any(axis=1), chance.any(axis=0)
            if some.any():
                d = self._away(search.points[alive[some]], children[wanted])
                d[~chance[some][:, wanted]] = np.inf
                away[np.ix_(alive[some], children[wanted])] = d
        return bounds, away


class _Search:
    """What a block of queries has found so far."""

    def __init__(self, tree: Tree, queries: np.ndarray, own_rows: np.ndarray, k: int):
        self.tree, self.queries, self.own_rows, self.k = tree, queries, own_rows, k
        self.points = np.column_stack([queries, np.zeros(len(queries))])
        self.total = (queries**2).sum(axis=1) + tree.bound
        # products are whole numbers; distances are rounded
        self.slack = 1e-3 + 1e-9 * self.total
        self.least = np.full(len(queries), -np.inf)
        self.of, self.ids, self.rows = (np.zeros(0, np.int64) for _ in range(3))
        self.scores = np.zeros(0)

    def best(self, at: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """The greatest product at ``distance`` or farther, for queries ``at``."""
        return (self.total[at] - np.maximum(distance, 0.0) ** 2) / 2 + self.slack[at]

    def visit(self, page: int, here: np.ndarray, away: np.ndarray) -> None:
        tree = self.tree
        near = self.best(here[:, None], np.abs(away[:, None] - tree.distances[page])) >= self.least[here][:, None]
        members = np.flatnonzero(near.any(axis=0))
        scores = self.queries[here] @ tree.vectors[page][members].T
        found = near[:, members] & (scores >= self.least[here][:, None])
        found &= tree.rows[page][members][None, :] != self.own_rows[here][:, None]
        q, m = np.nonzero(found)
        of = np.concatenate([self.of, here[q]])
        ids = np.concatenate([self.ids, tree.ids[page][members[m]]])
        rows = np.concatenate([self.rows, tree.rows[page][members[m]]])
        scores = np.concatenate([self.scores, scores[q, m]])
        order = np.lexsort((rows, ids, -scores, of))
        of = of[order]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        nth = np.arange(len(of)) - np.repeat(first, np.diff(first, append=len(of)))
        kept = nth < self.k
        order = order[kept]
        self.of, self.ids, self.rows, self.scores = of[kept], ids[order], rows[order], scores[order]
        last = nth[kept] == self.k - 1
        self.least[self.of[last]] = self.scores[last]


def whole_vectors(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """``_row, vec_id, values``: ``floor(scale * x)`` of each component; rows with null or non-finite parts are left out.

    A null id becomes the largest one.
    """
    values = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    sound = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return embeddings.where(F.col("embedding").isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("vec_id"),
        values.alias("values"),
    )


def _binary(batches):
    import pyarrow as pa

    for batch in batches:
        vectors = [np.array(v, np.int64).tobytes() for v in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(vectors, pa.binary())], ["_row", "vec_id", "vector"])


def index(vectors: DataFrame) -> DataFrame:
    """The pages of all trees, written once. ``vectors``: ``_row, vec_id, vector`` (packed 64-bit integers), stored."""
    chunks = max(1, -(-vectors.count() // CHUNK_ROWS))
    dealt = vectors.withColumn("chunk", F.length("vector") * F.lit(1 << 32) + F.pmod("_row", F.lit(chunks)))
    return materialize(dealt.groupBy("chunk").applyInPandas(_plant, _PAGE_SCHEMA), "mtree")


def search(pages: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_row, query_id, rank, vec_id, score``: the ``k`` greatest products of every query (``_row, vec_id, vector``).

    Every block of queries searches every chunk of vectors of its length; each
    search returns at most ``k`` rows, of which the best are kept.
    """
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    chunks = pages.where("parent = -1").select((F.col("chunk") + 0).alias("chunk"))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("_row"), F.lit(blocks))).withColumn("size", F.length("vector"))
    asked = asked.join(
        chunks.withColumn("size", F.call_function("div", F.col("chunk"), F.lit(1 << 32)).cast("int")), "size"
    ).drop("size")
    spread = pages.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def run(asked: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(pages):
            tree = Tree(pages)
            queries = np.stack([np.frombuffer(v, np.int64) for v in asked["vector"]]).astype(np.float64)
            rows, ids = asked["_row"].to_numpy(np.int64), asked["vec_id"].to_numpy(np.int64)
            for start in range(0, len(rows), TOGETHER):
                part = slice(start, start + TOGETHER)
                of, found, scores = tree.top(queries[part], rows[part], k)
                frame = {"query_row": rows[part][of], "query_id": ids[part][of], "vec_id": found, "score": scores}
                out.append(pd.DataFrame(frame))
        if not out:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_row", "query_id", "vec_id", "score")})
        return pd.concat(out)

    found = (
        asked.groupBy("chunk", "block")
        .cogroup(spread.groupBy("chunk", "block"))
        .applyInPandas(run, "query_row long, query_id long, vec_id long, score long")
    )
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .withColumn("vec_id", F.nullif("vec_id", F.lit(NULL_ID)))
        .select("query_row", "query_id", "rank", "vec_id", "score")
    )


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row whose vec_id is divisible by ``every``, over all other rows.

    Repeated rows count each; a query leaves out its own row only. Null ids are no
    queries and come last among ties. Vectors of another length are no candidates.
    """
    vectors = materialize(
        whole_vectors(embeddings, scale).mapInArrow(_binary, "_row long, vec_id long, vector binary"), "vectors"
    )
    found = search(index(vectors), vectors.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != NULL_ID)), k)
    return found.select("query_id", "rank", "vec_id", "score")
