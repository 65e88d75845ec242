"""Exact top-k search by inner product with two cover trees, one over queries and one over data.

A cover tree has levels; level l has the scale ``BASE ** l``. Its centres, the net of the level, are points that lie more
than the scale apart (separation), every point lies within the scale of one of them (covering), and a centre is a centre of
all lower levels too (nesting). Points are picked one after the other, each the farthest from those before: the distance at
which a point is picked tells the highest level it is a centre of. The parent of a centre is the nearest centre of the level
above. The nets end where they would hold more than one point in ``LEAF`` (``QUERY_LEAF``); the rest of the points hang below the nearest
centre of the lowest level. For a query node and a data node, with centres a and b and the largest distances r and s to
points below them, no inner product can exceed

    a.b + |a| s + |b| r + r s

A pair of nodes is left out when that is below the worst k-th score found so far for any query of the query node. The
search starts with the pairs of the largest bound, so that good scores come early.

The upper levels are shared by all tasks: the net of a bounded sample gives at most ``MOST_CELLS`` cells, every vector goes
to the nearest, and a cell with many rows is cut into parts by a hash of the id. A task builds the tree of a part once and
its rows are stored in the order of the tree. Each query first meets one part of the cell whose centre has the largest
product with it. The k-th score it finds there rules out the cells that cannot reach it, and goes on as the query's worst
score to the trees of the others. The sample decides only what is pruned, never the result. The k best of both rounds are
taken by a window with a limit, which Spark applies before and after the shuffle.

Components are read as double; a component x counts as floor(scale * x), so scores are whole numbers, ties are real, and
they go to the smaller id. Vectors that are NULL or empty or hold a NULL, NaN or infinity take no part, neither do rows
without an id. Vectors meet only vectors of their own length; a length that the sample lacks is one cell around zero.
Repeated rows are repeated candidates; a query id counts once, with its smallest vector, and rows with the query's own id are
not its candidates. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.sources.scratch import materialize

# Ratio of the scales of neighbouring levels.
BASE = 1.3
# Points per centre of the lowest level, on average, in trees over data and over queries.
LEAF, QUERY_LEAF = 32, 16
# Rows of a part, and components of a part and of a slice of queries: what a task holds.
PART_ROWS, PART_VALUES, SLICE_VALUES = 8192, 1 << 22, 1 << 22
# Rows per cell aimed at, and bounds of the cells and of the sample that they are picked from, which the driver holds.
CELL_ROWS, MOST_CELLS, SAMPLE_ROWS, SAMPLE_VALUES = 512, 1024, 4096, 1 << 22
LOWEST = np.iinfo(np.int64).min
# Sums of products below this are exact in double.
EXACT = 2.0**53


class Net:
    """Points picked farthest first, down to a level of at most ``most`` centres."""

    def __init__(self, points: np.ndarray, most: int):
        squares = (points * points).sum(axis=1)
        nearest, pick = np.full(len(points), np.inf), 0
        self.centres, picked_at = [], []
        while len(self.centres) < most:
            picked_at.append(math.inf if not self.centres else math.sqrt(nearest[pick]))
            self.centres.append(pick)
            nearest = np.minimum(nearest, np.maximum(squares + squares[pick] - 2.0 * (points @ points[pick]), 0.0))
            nearest[self.centres] = 0.0
            pick = int(nearest.argmax())
            if nearest[pick] == 0:
                break
        # A centre belongs to the levels whose scale is below the distance it was picked at.
        self.levels = [math.inf if math.isinf(d) else math.ceil(math.log(d, BASE)) - 1 for d in picked_at]
        if nearest[pick] > 0:
            lowest = math.ceil(math.log(math.sqrt(nearest[pick]), BASE))
            kept = sum(level >= lowest for level in self.levels)
            self.centres, self.levels = self.centres[:kept], self.levels[:kept]


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2.0 * (points @ centres.T)).argmin(axis=1)


class CoverTree:
    """Nodes as parallel lists; node i covers the points ``order[first[i]:last[i]]``, of which the first is its centre."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        net = Net(points, max(1, len(points) // leaf))
        centres = points[net.centres]
        owner = _nearest(points, centres)
        owner[net.centres] = np.arange(len(net.centres))
        self._start()
        below: list[dict[float, list[int]]] = [{} for _ in net.centres]
        for i in range(1, len(net.centres)):
            above = sum(level > net.levels[i] for level in net.levels[:i])
            below[int(_nearest(centres[i : i + 1], centres[:above])[0])].setdefault(net.levels[i], []).append(i)
        members = np.split(np.argsort(owner, kind="stable"), np.cumsum(np.bincount(owner, minlength=len(centres)))[:-1])
        order: list[np.ndarray] = []
        self._place(points, net, below, members, order, 0, 0)
        self.order = np.concatenate(order)
        # The root was made last; it becomes node 0.
        for values in (self.centre, self.norm, self.radius, self.first, self.last, self.children):
            values.reverse()
        self.children = [[len(self.first) - 1 - child for child in children] for children in self.children]

    def _start(self) -> None:
        self.centre: list[np.ndarray] = []
        self.norm: list[float] = []
        self.radius: list[float] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.children: list[list[int]] = []

    def _node(self, centre: np.ndarray, radius: float, first: int, last: int, children: list[int]) -> int:
        self.centre.append(centre)
        self.norm.append(float(np.sqrt(centre @ centre)))
        self.radius.append(radius)
        self.first.append(first)
        self.last.append(last)
        self.children.append(children)
        return len(self.centre) - 1

    def _place(self, points: np.ndarray, net: Net, below: list, members: list, order: list, at: int, i: int) -> int:
        """Nodes of one centre from the lowest level up; a level where it is alone makes no node of its own."""
        centre, own = points[net.centres[i]], members[i]
        order.append(np.concatenate(([net.centres[i]], own[own != net.centres[i]])))
        far = ((points[own] - centre) ** 2).sum(axis=1).max()
        last = at + len(own)
        top = self._node(centre, float(np.sqrt(far)), at, last, [])
        for level in sorted(below[i]):
            children = [top]
            for j in below[i][level]:
                begun = len(order)
                children.append(self._place(points, net, below, members, order, last, j))
                inside = np.concatenate(order[begun:])
                far = max(far, ((points[inside] - centre) ** 2).sum(axis=1).max())
                last += len(inside)
            top = self._node(centre, float(np.sqrt(far)), at, last, children)
        return top

    def written(self) -> tuple[list[list[int]], list[list[float]]]:
        """For each place in the order, the ends and radii of the nodes that begin there, outermost first."""
        lasts: list[list[int]] = [[] for _ in self.order]
        radii: list[list[float]] = [[] for _ in self.order]
        for node in sorted(range(len(self.first)), key=lambda i: (-self.last[i], -i)):
            lasts[self.first[node]].append(self.last[node])
            radii[self.first[node]].append(self.radius[node])
        return lasts, radii

    @classmethod
    def read(cls, points: np.ndarray, lasts: list[list[int]], radii: list[list[float]]) -> CoverTree:
        """The tree over points that come in its order."""
        tree = cls.__new__(cls)
        tree._start()
        tree.order = np.arange(len(points))
        open_: list[int] = []
        for place, (ends, distances) in enumerate(zip(lasts, radii)):
            while open_ and tree.last[open_[-1]] <= place:
                open_.pop()
            for last, radius in zip(ends, distances):
                node = tree._node(points[place], radius, place, last, [])
                if open_:
                    tree.children[open_[-1]].append(node)
                open_.append(node)
        return tree

    def points_below(self, node: int) -> np.ndarray:
        return self.order[self.first[node] : self.last[node]]


class _Search:
    """The k best data rows of each query, by descending score, then ascending id; none below a query's ``floor``."""

    def __init__(
        self,
        query_ids: np.ndarray,
        queries: np.ndarray,
        data_ids: np.ndarray,
        data: np.ndarray,
        k: int,
        floor: np.ndarray | None = None,
        data_tree: CoverTree | None = None,
    ):
        self.query_ids, self.data_ids, self.k = query_ids, data_ids, k
        largest = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, queries.shape[1])
        self.exact = largest < EXACT
        self.queries = queries.astype(np.float64) if self.exact else queries
        self.data = data.astype(np.float64) if self.exact else data
        self.query_tree = CoverTree(queries.astype(np.float64), QUERY_LEAF)
        self.data_tree = data_tree or CoverTree(data.astype(np.float64))
        self.scores = np.full((len(queries), k), LOWEST, dtype=np.int64)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max, dtype=np.int64)
        self.floor = np.full(len(queries), LOWEST, dtype=np.int64) if floor is None else floor
        self.scored = 0
        self.points = queries.astype(np.float64)
        self.norms = np.sqrt((self.points**2).sum(axis=1))
        self.least = np.where(self.floor > LOWEST, self.floor, -np.inf)
        self.worst = [float(self.least[self.query_tree.points_below(node)].min()) for node in range(len(self.query_tree.centre))]
        self.above = [-1] * len(self.worst)
        for node, children in enumerate(self.query_tree.children):
            for child in children:
                self.above[child] = node
        self._visit(0, 0)

    def _bound(self, a: int, b: int) -> float:
        q, d = self.query_tree, self.data_tree
        r, s = q.radius[a], d.radius[b]
        rest = q.norm[a] * s + d.norm[b] * r + r * s
        return float(q.centre[a] @ d.centre[b]) + rest + 1e-9 * (q.norm[a] * d.norm[b] + rest) + 1e-6

    def _visit(self, a: int, b: int) -> None:
        """Pairs from the largest bound on; the worst k-th score of a query node and of all above it is taken anew where a
        leaf changes."""
        q, d = self.query_tree, self.data_tree
        open_ = [(self._bound(a, b), a, b)]
        while open_:
            bound, a, b = open_.pop()
            if bound < self.worst[a]:
                continue
            mine, theirs = q.children[a], d.children[b]
            if not mine and not theirs:
                self._leaves(a, b)
            elif not mine or (theirs and d.radius[b] >= q.radius[a]):
                open_ += sorted((self._bound(a, child), a, child) for child in theirs)
            else:
                open_ += sorted((self._bound(child, b), child, b) for child in mine)

    def _leaves(self, a: int, b: int) -> None:
        """Scores of the points below two leaves, without the queries that the data leaf cannot serve."""
        below, columns = self.query_tree.points_below(a), self.data_tree.points_below(b)
        rest = self.norms[below] * self.data_tree.radius[b]
        bound = self.points[below] @ self.data_tree.centre[b] + rest + 1e-9 * (self.norms[below] * self.data_tree.norm[b] + rest) + 1e-6
        rows = below[bound >= self.least[below]]
        if not len(rows):
            return
        self.scored += len(rows) * len(columns)
        for at in range(0, len(columns), 1024):
            part = columns[at : at + 1024]
            scores = (self.queries[rows] @ self.data[part].T).astype(np.int64)
            scores[self.data_ids[part] == self.query_ids[rows][:, None]] = LOWEST
            k = min(self.k, len(part))
            least = np.maximum(self._known(rows), np.partition(scores, -k, axis=1)[:, -k])
            hit_row, hit_column = np.nonzero((scores >= least[:, None]) & (scores > LOWEST))
            if len(hit_row):
                self._merge(rows[hit_row], self.data_ids[part[hit_column]], scores[hit_row, hit_column])
        known = self._known(rows)
        self.least[rows] = np.where(known > LOWEST, known, -np.inf)
        self.worst[a] = float(self.least[below].min())
        while (a := self.above[a]) >= 0:
            least = min(self.worst[child] for child in self.query_tree.children[a])
            if least == self.worst[a]:
                break
            self.worst[a] = least

    def _known(self, rows: np.ndarray) -> np.ndarray:
        """A score that the k-th one of each query reaches at least."""
        return np.maximum(self.scores[rows, -1], self.floor[rows])

    def _merge(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Put new results among the best k of their queries."""
        touched = np.unique(rows)
        rows = np.concatenate((np.repeat(touched, self.k), rows))
        ids = np.concatenate((self.found[touched].ravel(), ids))
        scores = np.concatenate((self.scores[touched].ravel(), scores))
        order = np.lexsort((ids, -(scores + 1), rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < self.k
        self.found[rows[kept], place[kept]] = ids[kept]
        self.scores[rows[kept], place[kept]] = scores[kept]


class Cells:
    """The cells of each vector length: centres, and once they are measured, radii and numbers of parts."""

    def __init__(self, centres: dict[int, np.ndarray]):
        self.centres = centres
        self.radii: dict[int, np.ndarray] = {}
        self.parts: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, sample: list[list[int]], wanted: int) -> Cells:
        """Nets of the vectors of each length in a sample, with the length's share of the wanted cells."""
        by_length: dict[int, list[list[int]]] = {}
        for vector in sample:
            by_length.setdefault(len(vector), []).append(vector)
        centres = {}
        for length, vectors in by_length.items():
            points = np.array(vectors, dtype=np.float64)
            centres[length] = points[Net(points, max(1, wanted * len(points) // len(sample))).centres]
        return cls(centres)

    def around(self, length: int) -> np.ndarray:
        return self.centres.get(length, np.zeros((1, length)))

    def measured(self, sizes: DataFrame, part_rows: int) -> Cells:
        """With the rows (length, cell, n, radius) of the cells that hold vectors."""
        done = Cells(self.centres)
        for r in sizes.collect():
            count = len(self.around(r.length))
            done.radii.setdefault(r.length, np.full(count, -np.inf))[r.cell] = r.radius
            done.parts.setdefault(r.length, np.zeros(count, dtype=np.int64))[r.cell] = -(-r.n // part_rows)
        return done


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors) for each length in a batch."""
    lists = batch.column("vector")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    starts, values = np.cumsum(sizes) - sizes, lists.flatten().to_numpy(zero_copy_only=False)
    for length in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == length)
        yield length, rows, values[starts[rows][:, None] + np.arange(length)].astype(np.float64)


def _sizes(cells: Cells) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(length, cell, n, radius) of the vectors of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, points in _by_length(batch):
                centres = cells.around(length)
                cell = _nearest(points, centres)
                away = np.sqrt(((points - centres[cell]) ** 2).sum(axis=1))
                radius = np.zeros(len(centres))
                np.maximum.at(radius, cell, away)
                n = np.bincount(cell, minlength=len(centres))
                held = np.flatnonzero(n)
                columns = [np.full(len(held), length, dtype=np.int32), held.astype(np.int32), n[held], radius[held]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["length", "cell", "n", "radius"])

    return run


def _dealt(cells: Cells, choose: Callable[[int, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]):
    """Vectors with the cells that ``choose`` (length, vectors, floors) gives as (row, cell), and the cells' numbers of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = batch.column("floor").to_numpy(zero_copy_only=False)
            for length, rows, points in _by_length(batch):
                row, cell = choose(length, points, floors[rows])
                for at in range(0, len(row), 4096):
                    some, where = row[at : at + 4096], cell[at : at + 4096]
                    taken = batch.take(pa.array(rows[some]))
                    columns = [np.full(len(some), length, dtype=np.int32), where.astype(np.int32), cells.parts[length][where].astype(np.int32)]
                    names = [*batch.schema.names, "length", "cell", "parts"]
                    yield pa.RecordBatch.from_arrays([*taken.columns, *(pa.array(c) for c in columns)], names)

    return run


def _own_cell(cells: Cells):
    def choose(length: int, points: np.ndarray, _: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(points)), _nearest(points, cells.around(length))

    return choose


def _homes(cells: Cells, length: int, points: np.ndarray) -> np.ndarray:
    """The cell with the largest product of its centre with each vector, of those that hold rows."""
    products = points @ cells.around(length).T
    products[:, cells.parts[length] == 0] = -np.inf
    return products.argmax(axis=1)


def _home_cell(cells: Cells):
    def choose(length: int, points: np.ndarray, _: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(points)), _homes(cells, length, points)

    return choose


def _cells_in_reach(cells: Cells):
    """Cells whose bound reaches a query's floor; a cell of more than one part stays for its other parts."""

    def choose(length: int, points: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centres = cells.around(length)
        held = cells.parts[length] > 0
        norms, away = np.sqrt((points * points).sum(axis=1)), np.where(held, cells.radii[length], 0.0)
        rest = norms[:, None] * away
        bound = points @ centres.T + rest + 1e-9 * (norms[:, None] * np.sqrt((centres * centres).sum(axis=1)) + rest) + 1e-6
        reach = held & (bound >= np.where(floors == LOWEST, -np.inf, floors.astype(np.float64))[:, None])
        reach[np.arange(len(points)), _homes(cells, length, points)] &= (cells.parts[length] > 1)[_homes(cells, length, points)]
        return np.nonzero(reach)

    return choose


def _plant(table: pa.Table) -> pa.Table:
    """The rows of a part in the order of its tree, with the tree."""
    points = np.stack(table["vector"].to_numpy()).astype(np.float64)
    tree = CoverTree(points)
    lasts, radii = tree.written()
    rows = table.take(pa.array(tree.order))
    columns = [pa.array(range(len(rows)), pa.int32()), pa.array(lasts, pa.list_(pa.int32())), pa.array(radii, pa.list_(pa.float64()))]
    names = ["length", "cell", "part", "id", "vector"]
    return pa.table([*(rows[n] for n in names), *columns], [*names, "place", "lasts", "radii"])


def _pair(k: int) -> Callable[[pa.Table], pa.Table]:
    """The best k of a part for a slice of queries."""

    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        columns = [np.zeros(0, dtype=np.int64)] * 3
        if asks.any() and not asks.all():
            queries, data = table.filter(pa.array(asks)), table.filter(pa.array(~asks)).sort_by("place")
            ids, vectors = data["id"].to_numpy(), np.stack(data["vector"].to_numpy())
            tree = CoverTree.read(vectors.astype(np.float64), data["lasts"].to_pylist(), data["radii"].to_pylist())
            query_ids, floor = queries["id"].to_numpy(), queries["floor"].to_numpy()
            found = _Search(query_ids, np.stack(queries["vector"].to_numpy()), ids, vectors, k, floor, tree)
            kept = found.found < np.iinfo(np.int64).max
            columns = [np.repeat(query_ids, kept.sum(axis=1)), found.found[kept], found.scores[kept]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return run


def _searched(trees: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best k of each part for the queries that are sent to it; a part goes to each slice with queries for it once."""
    keys = ["length", "cell", "part"]
    data = trees.join(queries.select(*keys, "slice").distinct(), keys)
    data = data.select(*keys, "slice", F.lit(False).alias("asks"), "id", "vector", F.lit(None).cast("long").alias("floor"), "place", "lasts", "radii")
    empty = (F.lit(None).cast(kind).alias(name) for name, kind in (("place", "int"), ("lasts", "array<int>"), ("radii", "array<double>")))
    asking = queries.select(*keys, "slice", F.lit(True).alias("asks"), "id", "vector", "floor", *empty)
    return data.unionByName(asking).groupBy(*keys, "slice").applyInArrow(_pair(k), "query_id long, vec_id long, score long")


def whole_numbers(vectors: DataFrame, vector: str, scale: float) -> DataFrame:
    """(id, vector array<bigint>) of the vectors that take part."""
    doubles = F.col(vector).cast("array<double>")
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.col("vec_id").isNotNull() & (F.size(vector) > 0) & usable)
    return kept.select(F.col("vec_id").cast("long").alias("id"), F.transform(doubles, lambda x: F.floor(x * scale)).alias("vector"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row of ``vectors`` for which ``is_query`` holds.

    ``is_query`` is a condition on the column ``id``. Parts and slices follow from the number of rows, so a task's memory
    does not.
    """
    rows = whole_numbers(vectors, vector, scale)
    counts = rows.agg(F.count(F.lit(1)).alias("data"), F.count(F.when(is_query, 1)).alias("queries"), F.max(F.size("vector")).alias("longest")).first()
    longest = counts.longest or 1
    slices = -(-counts.queries * longest // SLICE_VALUES) or 1
    sample = rows.orderBy(F.xxhash64("id"), "id", "vector").limit(max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // longest)))
    cells = Cells.of([r.vector for r in sample.select("vector").collect()], min(MOST_CELLS, -(-counts.data // CELL_ROWS)))
    sizes = rows.select("vector").mapInArrow(_sizes(cells), "length int, cell int, n long, radius double")
    sizes = sizes.groupBy("length", "cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"))
    cells = cells.measured(sizes, max(1, min(PART_ROWS, PART_VALUES // longest)))

    with_floor = rows.withColumn("floor", F.lit(int(LOWEST)))
    schema = "id long, vector array<long>, floor long, length int, cell int, parts int"
    part = F.pmod(F.xxhash64("id"), "parts").cast("int")
    slice_ = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(slices)).cast("int")
    data = with_floor.mapInArrow(_dealt(cells, _own_cell(cells)), schema).withColumn("part", part)
    tree_schema = "length int, cell int, part int, id long, vector array<long>, place int, lasts array<int>, radii array<double>"
    trees = data.select("length", "cell", "part", "id", "vector").groupBy("length", "cell", "part").applyInArrow(_plant, tree_schema)
    trees = materialize(trees, "vector_trees")

    asking = with_floor.where(is_query).groupBy("id").agg(F.min("vector").alias("vector"), F.first("floor").alias("floor"))
    home = asking.mapInArrow(_dealt(cells, _home_cell(cells)), schema).withColumn("part", part).withColumn("slice", slice_)
    home = materialize(home, "vector_homes")
    first = materialize(_searched(trees, home, k), "vector_scores")
    reached = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("reached"))
    known = home.join(reached, "id", "left").select("id", "vector", F.coalesce("reached", "floor").alias("floor"), F.struct("cell", "part").alias("home"))
    further = known.mapInArrow(_dealt(cells, _cells_in_reach(cells)), "id long, vector array<long>, floor long, home struct<cell:int,part:int>, length int, cell int, parts int")
    further = further.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    further = further.where((F.col("cell") != F.col("home.cell")) | (F.col("part") != F.col("home.part"))).withColumn("slice", slice_)
    second = _searched(trees, materialize(further.drop("home"), "vector_queries"), k)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(second).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
