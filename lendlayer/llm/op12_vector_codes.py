"""Vector code compression: product codes fitted with anchors-hierarchy metric trees.

Vectors become integers, floor(``scale`` * x), and are cut into 16 equal parts. Each part position has
a codebook of up to 64 entries, fitted by rounds of exact nearest-entry assignment and
floored means. What makes a round cheap is a metric tree over the parts of every block of
vectors, built once and written:

* middle-out: about sqrt(n) anchors are grown, each new one at the point furthest from its
  anchor, stealing only points that the triangle inequality does not rule out. Anchors with
  many points get a hierarchy of their own below; above, the two balls whose union is
  smallest are joined until one is left. Every ball keeps its points' sum and count.
* A round walks each tree from the top with a list of candidate entries. A ball inherits its
  parent's list and strikes an entry when no point of the ball can be as near to it as to the entry nearest
  the centre. A ball with one candidate left is wholly owned: its cached sum and count are
  added without looking at a point. Only leaves with several candidates compare points, in integers.

The trees hold all a round reads. A round sends ``parts x entries x width`` sums a task, and the
driver holds the codebooks (at most 64 vectors).

Vectors that are null or hold null or non-finite components are dropped. The codebooks start
from the rows with the smallest ids (null ids last, equal ids by vector). Equal distances go to the lower
entry; entries nothing is nearest to stay. Rows that share an id are encoded one by one. Null
labels count as one label. With fewer than 64 vectors the codebooks are shorter; an empty table gives an
empty one. Other columns are not looked at. Vectors of different lengths, lengths that 16 does not divide and
scaled components of 2**26 or more, whose distances would not be exact, are refused with an error.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlayer.llm.frames import keep, ready

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors whose trees are kept in one row, and points of a ball that is not divided further.
BLOCK, LEAF = 4096, 64
LIMIT = 1 << 26

_NODES = ("center", "radius", "total", "count", "low", "high", "left", "right")


class _Builder:
    """A metric tree over weighted integer points; ``order`` puts the points of every ball side by side."""

    def __init__(self, points: np.ndarray, weight: np.ndarray):
        self.points, self.weight = points, weight
        self.place = points.astype(np.float64)
        self.nodes: list[tuple] = []
        self.order: list[np.ndarray] = []
        self.filled = 0
        self._lay(self._hierarchy(np.arange(len(points))))

    def _ball(self, at: np.ndarray):
        """A ball as (centre, radius, points or none, children or none)."""
        centre = np.average(self.place[at], axis=0, weights=self.weight[at])
        return centre, float(np.sqrt(((self.place[at] - centre) ** 2).sum(axis=1).max())), at, None

    def _hierarchy(self, at: np.ndarray):
        if len(at) <= LEAF:
            return self._ball(at)
        place = self.place[at]
        owner = np.zeros(len(at), dtype=np.int64)
        anchors = [0]
        away = np.sqrt(((place - place[0]) ** 2).sum(axis=1))
        for _ in range(int(np.ceil(np.sqrt(len(at)))) - 1):
            far = int(away.argmax())  # the furthest point of the widest anchor
            if away[far] == 0:
                break
            # a point nearer to its anchor than half the way to the new one can't be stolen
            half = np.sqrt(((place[anchors] - place[far]) ** 2).sum(axis=1)) / 2
            near = np.flatnonzero(away > half[owner])
            there = np.sqrt(((place[near] - place[far]) ** 2).sum(axis=1))
            stolen = there < away[near]
            owner[near[stolen]], away[near[stolen]] = len(anchors), there[stolen]
            anchors.append(far)
        by = np.argsort(owner, kind="stable")
        groups = np.split(at[by], np.cumsum(np.bincount(owner, minlength=len(anchors)))[:-1])
        return self._join([self._hierarchy(g) for g in groups if len(g)])

    @staticmethod
    def _join(balls: list):
        """The two balls with the smallest union become one, until one is left."""
        n = len(balls)
        centre, radius = np.array([b[0] for b in balls]), np.array([b[1] for b in balls])
        gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
        union = (gap + radius[:, None] + radius[None]) / 2
        union = np.maximum(union, np.maximum(radius[:, None], radius[None]))
        np.fill_diagonal(union, np.inf)
        for _ in range(n - 1):
            i, j = divmod(int(union.argmin()), n)
            r, between = union[i, j], np.sqrt(((centre[i] - centre[j]) ** 2).sum())
            move = min(max((r - radius[i]) / between, 0.0), 1.0) if between else 0.0
            middle = centre[i] + (centre[j] - centre[i]) * move
            # measured again, so rounding can't leave a point outside
            r = max(np.sqrt(((centre[k] - middle) ** 2).sum()) + radius[k] for k in (i, j))
            balls[i] = (middle, r, None, (balls[i], balls[j]))
            centre[i], radius[i] = middle, r
            row = np.maximum((np.sqrt(((centre - middle) ** 2).sum(axis=1)) + radius + r) / 2, np.maximum(radius, r))
            row[np.isinf(union[i])] = np.inf
            union[i], union[:, i] = row, row
            union[j], union[:, j] = np.inf, np.inf
            union[i, i] = np.inf
        return balls[i] if n > 1 else balls[0]

    def _lay(self, top) -> None:
        """Number the balls, parents first, and put their points in order."""
        stack = [(top, None, 0)]
        while stack:
            (centre, radius, at, children), parent, side = stack.pop()
            me = len(self.nodes)
            self.nodes.append([centre, radius, None, 0, 0, 0, -1, -1])
            if parent is not None:
                self.nodes[parent][6 + side] = me
            if children is None:
                self.order.append(at)
                self.nodes[me][4:6] = [self.filled, self.filled + len(at)]
                self.filled += len(at)
            else:
                stack += [(children[1], me, 1), (children[0], me, 0)]
        order = np.concatenate(self.order)
        points, weight = self.points[order], self.weight[order]
        sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points * weight[:, None], axis=0)])
        counts = np.concatenate([[0], np.cumsum(weight)])
        for node in reversed(self.nodes):
            if node[6] >= 0:
                node[4], node[5] = self.nodes[node[6]][4], self.nodes[node[7]][5]
            node[2], node[3] = sums[node[5]] - sums[node[4]], counts[node[5]] - counts[node[4]]
        self.ordered = order

    def arrays(self) -> dict[str, np.ndarray]:
        found = {name: np.array([node[i] for node in self.nodes]) for i, name in enumerate(_NODES)}
        return found | {"points": self.points[self.ordered], "order": self.ordered}


def build_tree(part: np.ndarray) -> dict[str, np.ndarray]:
    """The tree over the rows of ``part``; equal rows are one point with a weight."""
    points, inverse, weight = np.unique(part, axis=0, return_inverse=True, return_counts=True)
    return _Builder(points, weight).arrays() | {"inverse": inverse.ravel()}


def own(tree: dict[str, np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of every point, counts by entry, sums by entry); points as the tree orders them."""
    entries = len(book)
    apart = np.sqrt(((book[:, None] - book[None]).astype(np.float64) ** 2).sum(axis=2))
    lowest = np.argmax(apart == 0, axis=1) == np.arange(entries)  # of equal entries the first gets all
    entry = np.empty(len(tree["points"]), dtype=np.int64)
    count, total = np.zeros(entries, np.int64), np.zeros(book.shape, np.int64)
    weight = np.bincount(tree["inverse"])[tree["order"]]
    at, listed = np.array([0]), lowest[None]
    while len(at):
        centre, r = tree["center"][at], tree["radius"][at]
        square = ((centre[:, None] - book[None]) ** 2).sum(axis=2)
        square[~listed] = np.inf
        best = square.argmin(axis=1)
        nearest = square[np.arange(len(at)), best][:, None]
        slack = 1e-9 * (1 + nearest + (centre**2).sum(axis=1)[:, None] + r[:, None] ** 2)
        listed = listed & (square - nearest <= 2 * r[:, None] * apart[best] * (1 + 1e-9) + slack)
        owned = listed.sum(axis=1) == 1
        for node, e in zip(at[owned], best[owned]):
            entry[tree["low"][node] : tree["high"][node]] = e
            count[e] += tree["count"][node]
            total[e] += tree["total"][node]
        leaf = ~owned & (tree["left"][at] < 0)
        for node, those in zip(at[leaf], listed[leaf]):
            low, high = tree["low"][node], tree["high"][node]
            some, points = np.flatnonzero(those), tree["points"][low:high]
            e = some[((points[:, None] - book[some][None]) ** 2).sum(axis=2).argmin(axis=1)]
            entry[low:high] = e
            np.add.at(count, e, weight[low:high])
            np.add.at(total, e, points * weight[low:high, None])
        go = ~owned & ~leaf
        at, listed = np.concatenate([tree["left"][at[go]], tree["right"][at[go]]]), np.concatenate([listed[go], listed[go]])
    return entry, count, total


def _integers(column: pa.ListArray, length: int) -> np.ndarray:
    """Scaled, floored components, a row a vector."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if length % PARTS or not length or (sizes != length).any():
        raise ValueError(f"vectors must all have one length that {PARTS} divides; found {sorted({length, *sizes.tolist()})[:5]}")
    scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
    if len(scaled) and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"components of {LIMIT // SCALE} or more are too large for exact distances")
    return scaled.astype(np.int64).reshape(len(column), length)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Integers in the fewest bytes that hold them, so a block's trees stay near the size of its vectors."""
    if x.dtype.kind != "i" or not x.size:
        return x
    fits = (t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max)
    return x.astype(next(fits))


def _plant(length: int):
    """Arrow map (vec_id, label, vector) -> blocks of ids, labels and trees."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                block = batch.slice(i, BLOCK)
                numbers = _integers(block.column("vector"), length)
                saved = io.BytesIO()
                width = length // PARTS
                trees = (build_tree(numbers[:, p * width : (p + 1) * width]) for p in range(PARTS))
                np.savez(saved, **{f"{p}_{name}": _narrow(x) for p, tree in enumerate(trees) for name, x in tree.items()})
                ends = pa.array([0, block.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, block.column(c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([saved.getvalue()], pa.binary())], names=["vec_ids", "labels", "trees"])

    return work


def _trees(raw: bytes) -> list[dict[str, np.ndarray]]:
    loaded = np.load(io.BytesIO(raw), allow_pickle=False)
    out: list[dict[str, np.ndarray]] = [{} for _ in range(PARTS)]
    for key in loaded.files:
        p, name = key.split("_", 1)
        out[int(p)][name] = loaded[key]
    return out


def _round(books: list[np.ndarray]):
    """Arrow map over trees -> counts and sums of what each entry owns, added up per task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = [np.zeros(len(b), np.int64) for b in books], [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for raw in batch.column("trees"):
                for p, tree in enumerate(_trees(raw.as_py())):
                    _, count, total = own(tree, books[p])
                    counts[p] += count
                    totals[p] += total
        entries, width = books[0].shape
        at = np.indices((len(books), entries, width)).reshape(3, -1)
        arrays = [pa.array(x.astype(np.int32)) for x in at] + [pa.array(np.stack(totals).ravel()), pa.array(np.repeat(np.stack(counts).ravel(), width))]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "pos", "total", "n"])

    return work


def _encode(books: list[np.ndarray]):
    """Arrow map over blocks -> vec_id, label, code, error."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(row, 1).flatten() for c in ("vec_ids", "labels"))
                codes, error = np.empty((len(ids), PARTS), np.uint8), np.zeros(len(ids), np.int64)
                for p, tree in enumerate(_trees(batch.column("trees")[row].as_py())):
                    entry, _, _ = own(tree, books[p])
                    off = ((tree["points"] - books[p][entry]) ** 2).sum(axis=1)
                    at = np.empty(len(entry), np.int64)
                    at[tree["order"]] = np.arange(len(entry))
                    at = at[tree["inverse"]]
                    codes[:, p] = entry[at]
                    error += off[at]
                digits = codes.tobytes().hex()
                words = [digits[i : i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(words, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return work


def compress_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every usable vector, and the fitted codebooks (one array a part)."""
    ready(vectors.sparkSession)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    named = named.filter(F.col("vector").isNotNull() & finite)
    kinds = dict(named.dtypes)
    first = [r["vector"] for r in named.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(ENTRIES).collect()]
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    if not first:
        return named.sparkSession.createDataFrame([], schema), []
    length = len(first[0])
    start = _integers(pa.array(first, pa.list_(pa.float64())), length)
    books = np.split(start, PARTS, axis=1)
    trees = keep(
        named.mapInArrow(_plant(length), f"vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, trees binary"), "trees"
    )
    for _ in range(rounds):
        sums = trees.select("trees").mapInArrow(_round(books), "part int, entry int, pos int, total long, n long")
        sums = sums.groupBy("part", "entry", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        books = [b.copy() for b in books]
        for part, entry, pos, total, n in sums.filter("n > 0").collect():
            books[part][entry, pos] = total // n
    return trees.mapInArrow(_encode(books), schema), books


def code_digest(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The codes with each label's error and a hash of the codebooks."""
    written = ",".join(str(x) for book in books for x in book.ravel().tolist())
    coded = keep(coded, "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(written.encode()).hexdigest()).alias("codebooks_sha256"))
