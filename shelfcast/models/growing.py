"""Gradient-boosted trees on all rows of all models at once.

Rows are binned once and kept as blocks: for each model the codes of its features, the target
and the estimate so far of every head. A pass over the blocks gives each open node of each tree
its histograms (rows and gradient by feature and bin); Spark adds them up over tasks, and only
the sums reach the driver, which chooses the splits. A tree of depth d takes d passes, whatever
the number of models and heads. Leaves of a mean head follow from the histograms; leaves of a
quantile head take one more pass, in which tasks summarise the residuals of each leaf.

A pass costs a Spark job, so it only pays for models with many rows. Models of at most
`TASK_ROWS` rows are grown whole where their blocks meet, one task for each model and head, by
the same loop. No model loses a row either way, and both ways give the same trees: targets,
gradients and leaf steps are whole multiples of a grain (2^-24 of the largest target), so sums do
not depend on how rows are dealt out.

A residual summary keeps `SKETCH` values of equal weight: a leaf of up to that many rows is
exact, and each time summaries are cut a rank moves by at most 1 / (2 SKETCH) of the leaf's
rows; a value passes one cut per merge (a task, then one or two levels of adding), so ranks are
off by less than 0.2 % of the leaf.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import cut_lineage

MAX_BINS = 64
#: Rows of a block, and rows that a task holds before it closes all its blocks.
BLOCK_ROWS, HELD_ROWS = 65_536, 524_288
#: Trees that passes apply on the fly before the estimates are written anew.
STATE_ROUNDS = 8
#: Values of a residual summary.
SKETCH = 1024
#: Gradients are multiples of the largest target's power of two times this.
GRAIN = 2.0**-24
#: Accuracy of bin edges and starting quantiles: their ranks are off by at most one in this many.
EDGE_ACCURACY = 10_000
#: Models of at most so many rows are grown by one task for each head.
TASK_ROWS = 131_072
#: Tables of sums that the driver adds by itself; more are added by Spark, in groups of `FAN_IN`.
DIRECT, FAN_IN = 16, 32


#: Columns of a block.
BLOCK = ("owner", "n", "codes", "target", "state")


@dataclass(frozen=True)
class Head:
    """One model to grow: its number, that of the rows' owner, its place there and its loss.

    Gradients are multiples of `grain`, estimates of `unit`.
    """

    number: int
    owner: int
    place: int
    quantile: float | None
    grain: float
    unit: float
    start: float


class Tree:
    """A complete tree in heap order on bin codes; a leaf sends all rows to the left."""

    def __init__(self, depth):
        self.depth, nodes = depth, 2 ** (depth + 1) - 1
        self.feature = np.full(nodes, -1, dtype=np.int32)
        self.bin = np.full(nodes, MAX_BINS, dtype=np.int64)
        self.value = np.zeros(nodes)
        self.open = {0: True}

    def split(self, node, feature, bin_):
        self.feature[node], self.bin[node] = feature, bin_

    def descend(self, codes, levels):
        """Node of every row after that many levels; `codes` has one row a feature."""
        rows, node = np.arange(codes.shape[1]), np.zeros(codes.shape[1], dtype=np.int64)
        feature = np.maximum(self.feature, 0)
        for _ in range(levels):
            node = 2 * node + 2 - (codes[feature[node], rows] <= self.bin[node])
        return node

    def leaf_of(self):
        """For every node of the last level, the leaf above it (or itself)."""
        last = np.arange(2**self.depth - 1, len(self.feature))
        leaf = last.copy()
        for _ in range(self.depth):
            last = (last - 1) // 2
            leaf = np.where(self.feature[last] < 0, last, leaf)
        return leaf

    def scores(self, codes):
        at = self.descend(codes, self.depth) - (2**self.depth - 1)
        return self.value[self.leaf_of()][at]


def feature_array(frame, features):
    """The features as one array; what the frame lacks, and nulls, count as 0."""
    return F.array(*[
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in frame.columns else F.lit(0.0) for c in features
    ])


def matrix(column, width):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _facts(rows, keys, features, heads):
    """One row per model: rows, largest target, mean and starting quantiles, bin edges of each feature."""
    shares = F.array(*[F.lit((i + 1) / MAX_BINS) for i in range(MAX_BINS - 1)])
    asked = [q for q in heads.values() if q is not None]
    found = [
        F.count(F.lit(1)).alias("n"), F.max(F.abs("target")).alias("largest"), F.avg("target").alias("mean"),
        *[F.percentile_approx("target", F.lit(q), EDGE_ACCURACY).alias(f"q{i}") for i, q in enumerate(asked)],
        *[F.percentile_approx(F.get("_x", F.lit(i)), shares, EDGE_ACCURACY).alias(f"e{i}") for i in range(len(features))],
    ]
    grouped = rows.groupBy(*keys).agg(*found) if keys else rows.agg(*found)
    return sorted(grouped.where("n > 0").collect(), key=lambda r: repr([r[k] for k in keys]))


def _blocks(rows, keys, width, numbers, edges, units, starts):
    """Rows of each model as blocks: owner, n, codes, target, state (estimates, one head after another).

    Targets are multiples of the model's unit.
    """
    schema = T.StructType().add("owner", "integer").add("n", "integer")
    for name in BLOCK[2:]:
        schema = schema.add(name, "binary")

    def close(held):
        for owner, parts in held.items():
            x, y = (np.concatenate(p) for p in zip(*parts))
            for at in range(0, len(y), BLOCK_ROWS):
                own, target = x[at:at + BLOCK_ROWS], np.rint(y[at:at + BLOCK_ROWS] / units[owner]) * units[owner]
                codes = np.stack([np.searchsorted(e, own[:, f], "left") for f, e in enumerate(edges[owner])])
                state = np.repeat(starts[owner], len(target))
                yield pa.RecordBatch.from_arrays([
                    pa.array([owner], pa.int32()), pa.array([len(target)], pa.int32()),
                    *[pa.array([a.tobytes()], pa.binary()) for a in (codes.astype(np.uint8), target, state)],
                ], names=list(BLOCK))

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            x, y = matrix(batch.column("_x"), width), batch.column("target").to_numpy().astype(float)
            names = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * len(y)
            owners = np.array([numbers.get(name, -1) for name in names])
            for owner in np.unique(owners[owners >= 0]).tolist():
                mine = owners == owner
                held.setdefault(owner, []).append((x[mine], y[mine]))
            size += len(y)
            if size >= HELD_ROWS:
                yield from close(held)
                held, size = {}, 0
        yield from close(held)

    return rows.mapInArrow(run, schema)


def _unpacked(batches, width):
    """(owner, codes, target, state) of every block."""
    for batch in batches:
        for owner, n, codes, target, state in zip(*(batch.column(c).to_pylist() for c in BLOCK)):
            yield (owner, np.frombuffer(codes, np.uint8).reshape(width, n), np.frombuffer(target, np.float64),
                   np.frombuffer(state, np.float64).reshape(-1, n))


def _of_owner(heads):
    own = {}
    for head in heads:
        own.setdefault(head.owner, []).append(head)
    return own


def _estimate(head, codes, state, recent):
    """Estimate of a head; the values of recent trees are steps already."""
    return state[head.place] + sum((trees[head.number].scores(codes) for trees in recent), np.zeros(codes.shape[1]))


def _gradient(head, residual):
    slope = residual if head.quantile is None else head.quantile - (residual < 0)
    return np.rint(slope / head.grain)


def _histograms(blocks, heads, recent, trees, level):
    """{head: int64 array of rows and gradient by feature, node of the level and bin} of some blocks."""
    own, first, nodes = _of_owner(h for h in heads if trees[h.number].open), 2**level - 1, 2**level
    cells, total = nodes * MAX_BINS, {}
    for owner, codes, target, state in blocks:
        for head in own.get(owner, ()):
            tree = trees[head.number]
            at = tree.descend(codes, level) - first
            opened = np.zeros(nodes, dtype=bool)
            opened[[n - first for n in tree.open]] = True
            inside = opened[at]
            gradient, used = _gradient(head, target - _estimate(head, codes, state, recent)), codes
            if not inside.all():
                at, gradient, used = at[inside], gradient[inside], codes[:, inside]
            sums = total.setdefault(head.number, np.zeros((2, len(codes), cells), dtype=np.int64))
            for f, code in enumerate(used):
                cell = at * MAX_BINS + code
                sums[0, f] += np.bincount(cell, minlength=cells)
                sums[1, f] += np.bincount(cell, gradient, cells).astype(np.int64)
    return total


def _by_node(total, trees, level):
    """((head, node), rows and gradient by feature and bin) of the open nodes that have rows."""
    first = 2**level - 1
    for number, sums in total.items():
        for node in sorted(trees[number].open):
            part = sums[:, :, (node - first) * MAX_BINS:(node - first + 1) * MAX_BINS]
            if part[0, 0].any():
                yield (number, node), np.ascontiguousarray(part)


def compressed(sample, size=None):
    """A weighted sample (values, weights) as at most `size` values of equal weight, in order."""
    values, weights = sample[:, np.argsort(sample[0], kind="stable")]
    size = size or SKETCH
    if len(values) <= size:
        return np.stack([values, weights])
    ends = np.cumsum(weights)
    asked = (np.arange(size) + 0.5) * (ends[-1] / size)
    return np.stack([values[np.searchsorted(ends, asked)], np.full(size, ends[-1] / size)])


def lower_quantile(sample, quantile):
    """The smallest value at which at least that share of the weight is reached."""
    values, weights = sample[:, np.argsort(sample[0], kind="stable")]
    ends = np.cumsum(weights)
    return float(values[min(np.searchsorted(ends, (quantile - 1e-9) * ends[-1]), len(values) - 1)])


def _residuals(blocks, heads, recent, trees):
    """{(head, leaf): weighted sample of its residuals} of some blocks."""
    own, held = _of_owner(heads), {}
    for owner, codes, target, state in blocks:
        for head in own.get(owner, ()):
            tree = trees[head.number]
            leaf = tree.leaf_of()[tree.descend(codes, tree.depth) - (2**tree.depth - 1)]
            residual = target - _estimate(head, codes, state, recent)
            order, ends = np.argsort(leaf, kind="stable"), np.cumsum(np.bincount(leaf))
            for node in np.unique(leaf).tolist():
                mine = residual[order[ends[node - 1] if node else 0:ends[node]]]
                parts = held.setdefault((head.number, node), [])
                parts.append(np.stack([mine, np.ones(len(mine))]))
                if len(parts) >= DIRECT:
                    held[head.number, node] = [compressed(np.concatenate(parts, axis=1))]
    return {key: compressed(np.concatenate(parts, axis=1)) for key, parts in held.items()}


class _Held:
    """Blocks of one model in a task's memory."""

    def __init__(self, blocks):
        self.blocks = blocks

    def sums(self, heads, trees, level):
        return dict(_by_node(_histograms(self.blocks, heads, [], trees, level), trees, level))

    def residuals(self, heads, trees):
        return _residuals(self.blocks, heads, [], trees)

    def move(self, heads, trees, last):
        own = _of_owner(heads)
        for owner, codes, _, state in self.blocks:
            for head in own[owner]:
                state[head.place] += trees[head.number].scores(codes)


class _Passes:
    """Blocks of many models on the cluster; each question is a job."""

    def __init__(self, blocks, width):
        self.width, self.recent = width, []
        self._take(blocks)

    def _take(self, blocks):
        self.blocks = cut_lineage(blocks).persist()
        self.tasks = self.blocks.rdd.getNumPartitions()

    def sums(self, heads, trees, level):
        width, recent = self.width, self.recent

        def run(batches):
            total = _histograms(_unpacked(batches, width), heads, recent, trees, level)
            for (number, node), part in _by_node(total, trees, level):
                yield _line(number, node, part)

        return _met(self.blocks, self.tasks, run, np.int64, (2, width, MAX_BINS), lambda parts: np.sum(parts, axis=0))

    def residuals(self, heads, trees):
        width, recent = self.width, self.recent

        def run(batches):
            for (number, node), sample in _residuals(_unpacked(batches, width), heads, recent, trees).items():
                yield _line(number, node, sample)

        return _met(self.blocks, self.tasks, run, np.float64, (2, -1), lambda parts: compressed(np.concatenate(parts, axis=1)))

    def move(self, heads, trees, last):
        """Remembers the trees; every few rounds the blocks are written with new estimates."""
        self.recent = [*self.recent, trees]
        if len(self.recent) < STATE_ROUNDS or last:
            return
        own, width, recent, before = _of_owner(heads), self.width, self.recent, self.blocks

        def run(batches):
            for batch in batches:
                states = [
                    np.concatenate([_estimate(h, codes, state, recent) for h in sorted(own[owner], key=lambda h: h.place)])
                    for owner, codes, _, state in _unpacked([batch], width)
                ]
                made = pa.array([s.tobytes() for s in states], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=batch.schema.names)

        self._take(before.mapInArrow(run, before.schema))
        self.recent = []
        before.unpersist()


LINE = T.StructType().add("head", "integer").add("node", "integer").add("data", "binary")


def _line(number, node, array):
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([node], pa.int32()), pa.array([array.tobytes()], pa.binary())],
        names=LINE.names,
    )


def _met(blocks, tasks, run, kind, shape, add):
    """{(head, node): array}, what tasks sent added up: in levels by Spark where there are many tasks."""
    lines = blocks.mapInArrow(run, LINE)

    def arrays(table):
        for number, node, data in zip(*(table.column(c).to_pylist() for c in LINE.names)):
            yield (number, node), np.frombuffer(data, kind).reshape(shape)

    def gather(found):
        held = {}
        for key, array in found:
            parts = held.setdefault(key, [])
            parts.append(array)
            if len(parts) >= DIRECT:
                held[key] = [add(parts)]
        return {key: add(parts) for key, parts in held.items()}

    def merge(batches):
        for (number, node), array in gather(x for batch in batches for x in arrays(batch)).items():
            yield _line(number, node, array)

    while tasks > DIRECT:
        tasks = -(-tasks // FAN_IN)
        salt = F.pmod(F.spark_partition_id(), F.lit(tasks))
        lines = lines.withColumn("salt", salt).repartition("salt", "head", "node").drop("salt").mapInArrow(merge, LINE)
    return gather(arrays(lines.toArrow()))


def best_split(sums, grain, min_leaf):
    """(feature, bin) of the largest drop in squared error, or None; ties go to the first."""
    n, g = sums[0].cumsum(axis=1), sums[1].cumsum(axis=1) * grain
    all_n, all_g = n[:, -1:], g[:, -1:]
    right_n, right_g = all_n - n, all_g - g
    usable = (n >= max(min_leaf, 1)) & (right_n >= max(min_leaf, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(usable, g * g / n + right_g * right_g / right_n - all_g * all_g / all_n, -1.0)
    at = int(gain.argmax())
    return divmod(at, MAX_BINS) if gain.flat[at] > 1e-12 else None


def _grown(source, heads, settings):
    """({head: trees, one a round}, {head: rows}) of the heads; leaf values are steps (rate included)."""
    rounds, depth, rate, min_leaf = settings
    finished, fitted = {h.number: [] for h in heads}, {}
    numbered, quantiles = {h.number: h for h in heads}, [h for h in heads if h.quantile is not None]
    for turn in range(rounds):
        trees = {h.number: Tree(depth) for h in heads}
        for level in range(depth):
            if not any(t.open for t in trees.values()):
                break
            found = source.sums(heads, trees, level)
            for tree in trees.values():
                tree.open = {}
            for (number, node), sums in found.items():
                head, tree = numbered[number], trees[number]
                n, g = sums[:, 0].sum(axis=1).tolist()
                if level == 0:
                    fitted[number], tree.value[0] = n, g * head.grain / n
                chosen = best_split(sums, head.grain, min_leaf)
                if chosen is None:
                    continue
                tree.split(node, *chosen)
                n_left, g_left = sums[:, chosen[0], :chosen[1] + 1].sum(axis=1).tolist()
                for child, own, slope in ((2 * node + 1, n_left, g_left), (2 * node + 2, n - n_left, g - g_left)):
                    tree.value[child] = slope * head.grain / own
                    if level + 1 < depth and own >= 2 * min_leaf:
                        tree.open[child] = True
        if quantiles:
            for head in quantiles:
                trees[head.number].value[:] = 0.0
            for (number, node), sample in source.residuals(quantiles, trees).items():
                trees[number].value[node] = lower_quantile(sample, numbered[number].quantile)
        for number, tree in trees.items():
            unit = numbered[number].unit
            tree.value, tree.open = np.rint(rate * tree.value / unit) * unit, {}
            finished[number].append(tree)
        source.move(heads, trees, turn + 1 == rounds)
    return finished, fitted


TREES = T.StructType().add("number", "integer").add("rows", "long").add("feature", "binary").add("bin", "binary").add("value", "binary")


def _grown_by_tasks(blocks, heads, width, settings):
    """The same as _grown for models of few rows: their blocks meet in one task for each head."""
    depth, own = settings[1], _of_owner(heads)
    numbers = F.create_map(*[x for o, hs in own.items() for x in (F.lit(o), F.array(*[F.lit(h.number) for h in hs]))])
    dealt = blocks.select("*", F.explode(numbers[F.col("owner")]).alias("number"))
    numbered = {h.number: h for h in heads}

    def run(group):
        head = numbered[group.column("number")[0].as_py()]
        held = [(o, codes, target, state.copy()) for o, codes, target, state in _unpacked([group], width)]
        finished, fitted = _grown(_Held(held), [head], settings)
        trees = finished[head.number]
        data = [np.stack([getattr(t, part) for t in trees]).tobytes() for part in ("feature", "bin", "value")]
        return pa.table([[head.number], [fitted[head.number]], *[pa.array([d], pa.binary()) for d in data]],
                        schema=pa.schema([("number", pa.int32()), ("rows", pa.int64()), *[(c, pa.binary()) for c in TREES.names[2:]]]))

    finished, fitted = {}, {}
    for row in dealt.groupBy("number").applyInArrow(run, TREES).collect():
        fitted[row["number"]], finished[row["number"]] = row["rows"], []
        parts = [np.frombuffer(row[c], k).reshape(-1, 2 ** (depth + 1) - 1)
                 for c, k in (("feature", np.int32), ("bin", np.int64), ("value", np.float64))]
        for feature, bin_, value in zip(*parts):
            tree = Tree(depth)
            tree.feature, tree.bin, tree.value = feature, bin_, value
            finished[row["number"]].append(tree)
    return finished, fitted


def grow(rows, keys, features, heads, rounds, depth, rate, min_leaf, task_rows=TASK_ROWS):
    """[(key values, head name, Head, trees, edges, rows fitted)] over `rows` (keys, target, _x).

    `heads` maps names to quantiles, None for the mean. A round fits a tree to the loss gradient
    of every head and sets each leaf to the mean, or the quantile, of its residuals. The leaf
    values of the trees are steps: `rate` is in them.
    """
    keys, names, width = list(keys), list(heads), len(features)
    facts = _facts(rows, keys, features, heads)
    quantile_names = [n for n in names if heads[n] is not None]
    numbers, edges, units, starts, grown = {}, {}, {}, {}, []
    for owner, fact in enumerate(facts):
        unit = units[owner] = float(GRAIN * 2.0 ** np.ceil(np.log2(max(fact["largest"], 2.0**-60))))
        edges[owner] = [np.unique(np.array(fact[f"e{i}"], dtype=float)) for i in range(width)]
        numbers[tuple(fact[k] for k in keys)] = owner
        for place, name in enumerate(names):
            q = heads[name]
            start = fact["mean"] if q is None else fact[f"q{quantile_names.index(name)}"]
            grown.append(Head(len(grown), owner, place, q, unit if q is None else GRAIN, unit, float(np.rint(start / unit) * unit)))
        starts[owner] = np.array([h.start for h in grown[-len(names):]])
    if not grown:
        return []
    blocks, settings = _blocks(rows, keys, width, numbers, edges, units, starts), (rounds, depth, rate, min_leaf)
    small = {o for o, fact in enumerate(facts) if fact["n"] <= task_rows}
    few, many = [h for h in grown if h.owner in small], [h for h in grown if h.owner not in small]
    finished, fitted = {}, {}
    if few:
        asked = blocks if not many else (blocks := cut_lineage(blocks)).where(F.col("owner").isin(list(small)))
        finished, fitted = _grown_by_tasks(asked, few, width, settings)
    if many:
        asked = blocks if not few else blocks.where(~F.col("owner").isin(list(small)))
        source = _Passes(asked, width)
        more, more_fitted = _grown(source, many, settings)
        source.blocks.unpersist()
        finished, fitted = finished | more, fitted | more_fitted
    return [
        (tuple(facts[h.owner][k] for k in keys), names[h.place], h, finished[h.number], edges[h.owner], fitted[h.number])
        for h in grown
    ]
