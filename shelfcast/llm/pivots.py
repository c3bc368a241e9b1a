"""Exact top-k search by inner product over a pivot-distance index.

With M the largest length of a vector, the extra component sqrt(M^2 - |v|^2) puts all vectors
on one sphere, where a larger inner product with a query (extra component 0) is a smaller
distance: |q - v|^2 = |q|^2 + M^2 - 2 q.v. The index keys every vector by its nearest pivot
and the distance to it, cut into rings and, where a ring holds many rows, into salted blocks.

A query first reads the rings nearest to it, which gives it a k-th score and with it a radius
r. A vector at distance d from its pivot can only be better if |d - d(query, pivot)| <= r, so
afterwards the query goes only to the blocks whose ring reaches into that annulus, and within
a block only to the slice of the sorted distances inside it.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.arrow import batch_of
from shelfcast.session import cut_lineage

SCALE = 256
#: Vectors, about, from which pivots are chosen, and rings per pivot at most.
SAMPLE, MOST_RINGS = 2000, 64
_INDEX = "pivot int, ring int, salt int, dist double, vec_id long, ints array<long>"
_ASKED = "block string, chunk int, query_id long, dist double, radius double, ints array<long>"
_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors, vec_id="vec_id", vector="embedding"):
    """One row (vec_id, ints) per id: floor(256 x) of each component.

    Rows whose id or vector is null, or whose vector holds a null or non-finite component,
    take no part. Of several vectors under one id the smallest (component by component)
    stands for the id. Vectors may differ in length: what is missing counts as 0.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    usable = vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & finite)
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    return usable.groupBy(F.col(vec_id).cast("long").alias("vec_id")).agg(F.min(ints).alias("ints"))


def _matrix(column, dim, kind=np.int64):
    """Rows of a list column as a matrix, shorter rows filled with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths().fill_null(0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(len(sizes), dim).astype(kind, copy=False)
    filled = np.zeros((len(sizes), dim), dtype=kind)
    filled[np.arange(dim) < sizes[:, None]] = flat
    return filled


@dataclass(frozen=True)
class Space:
    """Pivots and the bounds of the rings; at most pivots x MOST_RINGS numbers."""

    dim: int
    longest: float
    pivots: np.ndarray
    cuts: dict

    def lifted(self, ints):
        """Vectors with the component that puts them on the sphere."""
        v = ints.astype(np.float64)
        rest = np.sqrt(np.maximum(self.longest - (v * v).sum(axis=1), 0))
        return np.hstack([v, rest[:, None]])

    def distances(self, points):
        square = (points**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    @property
    def exact_in_floats(self):
        return self.longest < 2.0**52


def _space(table, pivots, block_rows):
    """Length bound, pivots (farthest first within a sample), and ring cuts by quantiles."""
    length = F.aggregate("ints", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, dim, longest = table.agg(F.count(F.lit(1)), F.max(F.size("ints")), F.max(length)).first()
    if not n:
        return None, 0
    dim, longest = max(dim, 1), float(longest)
    # one row in n / SAMPLE by hash: about SAMPLE rows, whatever the size
    sample = table.where(F.pmod(F.xxhash64("vec_id"), F.lit(-(-n // SAMPLE))) == 0).limit(2 * SAMPLE).collect()
    sample = sorted(sample, key=lambda r: r.vec_id) or [table.first()]
    bare = Space(dim, longest, np.zeros((0, dim + 1)), {})
    points = bare.lifted(_matrix(pa.array([r.ints for r in sample], pa.list_(pa.int64())), dim))
    chosen = [int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))]
    gaps = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < pivots and gaps.max() > 0:
        chosen.append(int(gaps.argmax()))
        gaps = np.minimum(gaps, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return Space(dim, longest, points[chosen], {}), n


def _keyed(table, space):
    """The table with nearest pivot and distance to it."""
    schema = pa.schema([("pivot", pa.int32()), ("dist", pa.float64())])

    def key(batches):
        for batch in batches:
            gaps = space.distances(space.lifted(_matrix(batch.column("ints"), space.dim)))
            nearest = gaps.argmin(axis=1) if len(gaps) else np.zeros(0, dtype=np.int64)
            found = batch_of(schema, nearest.astype(np.int32), gaps[np.arange(len(gaps)), nearest])
            yield pa.RecordBatch.from_arrays(
                [*found.columns, *batch.columns], names=[*schema.names, *batch.schema.names]
            )

    return table.mapInArrow(key, "pivot int, dist double, vec_id long, ints array<long>")


def build_index(table, pivots=32, block_rows=2048):
    """(index, space, blocks): every row with pivot, ring, salt and distance, written once.

    `blocks` has (pivot, ring, rows, salts, lowest, highest) of each ring, at most
    pivots x MOST_RINGS of them. An empty table gives (None, None, []).
    """
    space, n = _space(table, pivots, block_rows)
    if space is None:
        return None, None, []
    keyed = cut_lineage(_keyed(table, space))
    rings = int(min(MOST_RINGS, max(1, -(-n // (len(space.pivots) * block_rows)))))
    if rings > 1:
        parts = [i / rings for i in range(1, rings)]
        cuts = {
            r.pivot: list(dict.fromkeys(r.cuts))
            for r in keyed.groupBy("pivot").agg(F.percentile_approx("dist", parts, 1000).alias("cuts")).collect()
        }
    else:
        cuts = {}
    table_of = F.create_map(*[x for p, c in cuts.items() for x in (F.lit(p), F.array(*map(F.lit, c)))]) if cuts else None
    ring = F.size(F.filter(table_of[F.col("pivot")], lambda c: c < F.col("dist"))) if cuts else F.lit(0)
    ringed = keyed.withColumn("ring", ring.cast("int"))
    blocks = ringed.groupBy("pivot", "ring").agg(
        F.count(F.lit(1)).alias("rows"), F.min("dist").alias("lowest"), F.max("dist").alias("highest")
    ).withColumn("salts", F.ceil(F.col("rows") / block_rows).cast("int")).collect()
    salts = F.create_map(*[
        x for b in blocks for x in (F.lit(b.pivot * MOST_RINGS + b.ring), F.lit(b.salts))
    ])
    salt = F.pmod(F.xxhash64("vec_id"), salts[F.col("pivot") * MOST_RINGS + F.col("ring")])
    index = ringed.withColumn("salt", salt.cast("int"))
    return index.select("pivot", "ring", "salt", "dist", "vec_id", "ints"), space, blocks


def _route(queries, space, blocks, query_rows, n_chunks, first_rows, k):
    """Queries with the blocks they go to.

    A first visit (no `radius` column) takes the nearest rings, in the order of their lower
    bounds, until they hold `first_rows` rows, and only the first block of each ring. A later
    visit takes every other block that its radius reaches.
    """
    pivot = np.array([b.pivot for b in blocks])
    low, high = np.array([b.lowest for b in blocks]), np.array([b.highest for b in blocks])
    size = np.array([min(b.rows, b.rows / b.salts * 1.0) for b in blocks])
    schema = pa.schema([
        ("block", pa.string()), ("chunk", pa.int32()), ("query_id", pa.int64()), ("dist", pa.float64()),
        ("radius", pa.float64()), ("ints", pa.list_(pa.int64())),
    ])
    later = "radius" in queries.columns

    def route(batches):
        for batch in batches:
            ids, ints = batch.column("vec_id").to_pylist(), batch.column("ints")
            if not ids:
                continue
            own = _matrix(ints, space.dim).astype(np.float64)
            gaps = space.distances(np.hstack([own, np.zeros((len(ids), 1))]))[:, pivot]
            bound = np.maximum(0, np.maximum(gaps - high, low - gaps))
            radii = batch.column("radius").to_numpy(zero_copy_only=False) if later else np.full(len(ids), np.inf)
            vectors = ints.to_pylist()
            rows = []
            for i, query in enumerate(ids):
                order = np.argsort(bound[i], kind="stable")
                first = order[: int(np.searchsorted(np.cumsum(size[order]), first_rows)) + 1]
                for b in order if later else first:
                    if bound[i, b] > radii[i]:
                        break
                    skip = 1 if later and b in first else 0
                    for salt in range(skip, blocks[b].salts if later else 1):
                        name = f"{blocks[b].pivot}/{blocks[b].ring}/{salt}"
                        rows.append((name, query % n_chunks, query, gaps[i, b], radii[i], vectors[i]))
            if rows:
                yield batch_of(schema, *map(list, zip(*rows)))

    return queries.mapInArrow(route, _ASKED)


def _search(asked, index, space, k):
    """The k best rows of each block for each query that was sent to it."""
    pairs = asked.select(F.col("block").alias("to_block"), F.col("chunk").alias("to_chunk")).distinct()
    blocks = index.withColumn("in_block", F.concat_ws("/", "pivot", "ring", "salt"))
    sent = blocks.join(pairs, F.col("in_block") == F.col("to_block"))
    sent = sent.select("to_block", "to_chunk", "dist", "vec_id", "ints")
    kind = np.float64 if space.exact_in_floats else np.int64

    def search(wanted, rows):
        if not wanted.num_rows or not rows.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in _HITS}, schema=_HITS)
        order = np.argsort(rows.column("dist").to_numpy(), kind="stable")
        dist = rows.column("dist").to_numpy()[order]
        ids = rows.column("vec_id").to_numpy()[order]
        matrix = _matrix(rows.column("ints"), space.dim, kind)[order]
        asked_of = _matrix(wanted.column("ints"), space.dim, kind)
        found = []
        for i, query in enumerate(wanted.column("query_id").to_pylist()):
            middle, radius = wanted.column("dist")[i].as_py(), wanted.column("radius")[i].as_py()
            a, b = np.searchsorted(dist, middle - radius, "left"), np.searchsorted(dist, middle + radius, "right")
            scores = (matrix[a:b] @ asked_of[i]).astype(np.int64)
            near = ids[a:b]
            other = near != query
            scores, near = scores[other], near[other]
            if len(scores) > k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= least
                scores, near = scores[keep], near[keep]
            best = np.lexsort((near, -scores))[:k]
            found += [(query, int(near[j]), int(scores[j])) for j in best]
        if not found:
            return pa.table({f.name: pa.array([], f.type) for f in _HITS}, schema=_HITS)
        return pa.Table.from_batches([batch_of(_HITS, *map(list, zip(*found)))])

    both = asked.groupBy("block", "chunk").cogroup(sent.groupBy("to_block", "to_chunk"))
    return both.applyInArrow(search, "query_id long, vec_id long, score long")


def top_k(table, is_query, k=5, pivots=32, block_rows=2048, query_rows=4096, first_rows=1500):
    """(query_id, rank, vec_id, score): the k highest inner products of each query, exactly.

    `table` has (vec_id, ints) as `quantised` gives it; `is_query` is a boolean column of it.
    Candidates are all rows but the query's own; a query with fewer than k gets all. Equal
    scores go to the smaller vec_id. Queries are dealt into chunks of about `query_rows`, so
    a task holds one block and one chunk; every row is indexed, none is left out.
    """
    shape = "query_id long, rank int, vec_id long, score long"
    index, space, blocks = build_index(table, pivots, block_rows)
    if index is None:
        return table.sparkSession.createDataFrame([], shape)
    queries = index.where(is_query).select("vec_id", "ints")
    n_chunks = int(max(1, -(-queries.count() // query_rows)))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    asked = _route(queries, space, blocks, query_rows, n_chunks, first_rows, k)
    early = cut_lineage(_search(asked, index, space, k))
    floors = early.withColumn("n", F.row_number().over(ranked)).where(F.col("n") == k)
    floors = floors.select(F.col("query_id").alias("of"), F.col("score").alias("floor"))
    length = F.aggregate("ints", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    square = length + F.lit(space.longest) - 2 * F.col("floor")
    # a hair more than the exact radius, as distances are rounded
    radius = F.sqrt(F.greatest(square, F.lit(0.0))) * (1 + 1e-9) + 1e-3
    reached = queries.join(floors, F.col("vec_id") == F.col("of"), "left").select(
        "vec_id", "ints", F.when(F.col("floor").isNull(), float("inf")).otherwise(radius).alias("radius")
    )
    late = _search(_route(reached, space, blocks, query_rows, n_chunks, first_rows, k), index, space, k)
    return (
        early.unionByName(late).withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
