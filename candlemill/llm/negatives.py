"""Hard negatives by angular triangle filtering.

Vectors are quantised to integers, and each keeps its angles to a few reference directions. The
angle between two vectors lies between the difference and the sum of their angles to a direction,
so stored angles give an interval of cosines, and times the norms bounds of the score, widened by
more than rounding can take. Rows are stored by label, nearest direction and angle to it and are
cut into small windows with ranges of angles and norms. A window is scored, by integer products,
only for anchors whose wanted scores its bounds overlap.

Anchors are a stated query set, searched against all rows in blocks: groups of rows meet chunks of
anchors, both bounded, so that neither has to fit anywhere whole. Each block keeps the best rows of
every anchor, which are ranked over all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.sources.staging import stage

REFERENCES = 16
# Rows that reference directions are chosen from.
SAMPLE_ROWS = 1_024
# Rows in a window, and the least and most of a group; as many groups as GROUPS in between.
WINDOW_ROWS = 128
LEAST_GROUP, MOST_GROUP, GROUPS = 1_024, 131_072, 64
CHUNK_ANCHORS = 8_192
# Scores that a task holds at once.
HELD_SCORES = 4_000_000
# Angles are stored as 32 bits and computed to about 1e-7.
ANGLE_SLACK = 1e-5
# Quantised components from here on take no part: products of such rows could leave a long.
TOO_LARGE = 1 << 27

SCALE = 256
ANCHOR_STEP = 50
POSITIVES = 5
NEGATIVES = 3
# Negative scores are between these percentages of a positive's.
LEAST_PERCENT, MOST_PERCENT = 50, 95

PREPARED = "vec_id long, label int, vector binary, norm double, angles binary, cell int, near float"
BEST = "anchor_id long, positive_id long, positive_score long, other_id long, score long"


def quantise(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row takes part, and the integer vectors (rows, width) of those that do.

    Shorter vectors are filled up with zeros.
    """
    out = np.zeros((len(column), width))
    valid = np.ones(len(column), bool)
    for i, vector in enumerate(column):
        if not vector.is_valid:
            valid[i] = False
            continue
        own = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
        out[i, : len(own)] = own
    with np.errstate(invalid="ignore", over="ignore"):
        out = np.floor(SCALE * out)
    valid &= (np.abs(out) < TOO_LARGE).all(axis=1)  # not so for NaN and infinity
    return valid, out[valid].astype(np.int64)


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def angles_to(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles (vectors, directions), 0 for vectors without length."""
    length = norms(vectors)[:, None]
    cosines = (vectors @ directions.T) / np.where(length > 0, length, 1)
    return np.where(length > 0, np.arccos(np.clip(cosines, -1, 1)), 0).astype(np.float32)


def choose_directions(vectors: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Unit directions of the sample, each the farthest from those before it."""
    length = norms(vectors)
    unit = vectors[length > 0] / length[length > 0][:, None]
    if not len(unit):
        return np.eye(1, vectors.shape[1])
    chosen = [unit[0]]
    nearest = unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        far = int(np.argmin(nearest))
        chosen.append(unit[far])
        nearest = np.maximum(nearest, unit @ unit[far])
    return np.array(chosen)


@dataclass
class Rows:
    """Rows of a block: ids, labels, vectors, norms and angles."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, width: int) -> Rows:
        def matrix(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        n = table.num_rows
        return cls(
            table.column("vec_id").to_numpy(),
            table.column("label").to_numpy(),
            matrix("vector", np.int32).reshape(n, width),
            table.column("norm").to_numpy(),
            matrix("angles", np.float32).reshape(n, -1 if n else 0).astype(np.float64),
        )

    def part(self, rows) -> Rows:
        return Rows(self.ids[rows], self.labels[rows], self.vectors[rows], self.norms[rows], self.angles[rows])


def score_bounds(anchors: Rows, rows: Rows, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores (anchors, windows) that the rows of each window can have."""
    lowest, highest = np.minimum.reduceat(rows.angles, starts), np.maximum.reduceat(rows.angles, starts)
    apart = np.zeros((len(anchors.ids), len(starts)))
    within = np.full(apart.shape, np.pi)
    for own, low, high in zip(anchors.angles.T, lowest.T, highest.T):
        own = own[:, None]
        apart = np.maximum(apart, np.maximum(low[None, :] - own, own - high[None, :]))
        within = np.minimum(within, np.minimum(own + high[None, :], 2 * np.pi - own - low[None, :]))
    greatest = np.cos(np.clip(apart - ANGLE_SLACK, 0, np.pi))
    least = np.cos(np.clip(within + ANGLE_SLACK, 0, np.pi))
    short, long = np.minimum.reduceat(rows.norms, starts)[None, :], np.maximum.reduceat(rows.norms, starts)[None, :]
    length = anchors.norms[:, None]
    # A row or anchor without length has no angle and scores 0.
    slack = 1 + 1e-9 * length * long
    upper = length * np.where(greatest >= 0, long, short) * greatest + slack
    lower = length * np.where(least >= 0, short, long) * least - slack
    empty = (short == 0) | (length == 0)
    return np.where(empty, np.minimum(lower, -slack), lower), np.where(empty, np.maximum(upper, slack), upper)


class Block:
    """Scores of some anchors against a group of rows, computed window by window as needed."""

    def __init__(self, anchors: Rows, rows: Rows):
        self.anchors, self.rows = anchors, rows
        self.starts = np.arange(0, len(rows.ids), WINDOW_ROWS)
        self.lower, self.upper = score_bounds(anchors, rows, self.starts)
        bound = float(anchors.norms.max()) * float(rows.norms.max())
        # Doubles hold the products exactly below 2 ** 53.
        kind = np.float64 if bound * 4 < 2**53 else np.int64
        self.none = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
        self.left, self.right = anchors.vectors.astype(kind), rows.vectors.astype(kind)
        self.scores = np.full((len(anchors.ids), len(rows.ids)), self.none, kind)
        self.done = np.zeros(self.lower.shape, bool)
        self.low_label = np.minimum.reduceat(rows.labels, self.starts)[None, :]
        self.high_label = np.maximum.reduceat(rows.labels, self.starts)[None, :]

    def fill(self, wanted: np.ndarray, same_label: bool) -> None:
        """Score the wanted windows (anchors, windows); other labels, or the same, stay without."""
        for w in np.flatnonzero((wanted & ~self.done).any(axis=0)):
            own = np.flatnonzero(wanted[:, w] & ~self.done[:, w])
            part = slice(self.starts[w], self.starts[w] + WINDOW_ROWS)
            score = self.left[own] @ self.right[part].T
            same = self.anchors.labels[own][:, None] == self.rows.labels[part][None, :]
            itself = self.anchors.ids[own][:, None] == self.rows.ids[part][None, :]
            self.scores[own, part] = np.where((same == same_label) & ~itself, score, self.none)
            self.done[own, w] = True

    def best_window(self, fits: np.ndarray) -> np.ndarray:
        """The window of the greatest upper bound of each anchor, among those that fit."""
        bound = np.where(fits, self.upper, -np.inf)
        first = np.zeros(fits.shape, bool)
        first[np.arange(len(fits)), bound.argmax(axis=1)] = True
        return first & fits

    def kth(self, scores: np.ndarray, k: int) -> np.ndarray:
        """The k-th greatest score of each anchor, ``none`` where there are fewer."""
        if scores.shape[1] < k:
            return np.full(len(scores), self.none, scores.dtype)
        return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]

    def top(self, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) of the k greatest scores of each anchor; ties go to the smaller id."""
        a, r = np.nonzero((scores >= self.kth(scores, k)[:, None]) & (scores != self.none))
        order = np.lexsort((self.rows.ids[r], -scores[a, r], a))
        a, r = a[order], r[order]
        first = np.searchsorted(a, np.arange(len(scores)))
        near = np.arange(len(a)) - first[a] < k
        return a[near], r[near]

    def positives(self) -> tuple[np.ndarray, np.ndarray]:
        own = self.anchors.labels[:, None]
        fits = (self.low_label <= own) & (own <= self.high_label)
        self.fill(self.best_window(fits), True)
        self.fill(fits & (self.upper >= self.kth(self.scores, POSITIVES)[:, None]), True)
        return self.top(self.scores, POSITIVES)

    def within(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = (self.scores >= low[:, None]) & (self.scores <= high[:, None])
        return np.where(keep, self.scores, self.none)

    def negatives(self, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(positive, anchor, row) of the best rows in each anchor's score ranges (anchors, positives)."""
        own = self.anchors.labels[:, None]
        other = ~((self.low_label == own) & (self.high_label == own))

        def overlap(least: np.ndarray) -> np.ndarray:
            hit = np.zeros(other.shape, bool)
            for j in range(low.shape[1]):
                hit |= (self.upper >= least[:, j, None]) & (self.lower <= high[:, j, None]) & (least <= high)[:, j, None]
            return other & hit

        self.fill(self.best_window(overlap(low)), False)
        # Rows below the worst that is kept so far need no score.
        kept = [self.kth(self.within(low[:, j], high[:, j]), NEGATIVES) for j in range(low.shape[1])]
        self.fill(overlap(np.maximum(low, np.stack(kept, axis=1))), False)
        for j in range(low.shape[1]):
            yield j, *self.top(self.within(low[:, j], high[:, j]), NEGATIVES)


def _blocks(rows: pa.Table, anchors: pa.Table, width: int) -> Iterator[tuple[slice, Block]]:
    group, chunk = Rows.of(rows, width), Rows.of(anchors, width)
    step = max(1, HELD_SCORES // max(1, rows.num_rows))
    for at in range(0, anchors.num_rows if rows.num_rows else 0, step):
        part = slice(at, min(at + step, anchors.num_rows))
        yield part, Block(chunk.part(part), group)


def _table(columns: list[np.ndarray]) -> pa.Table:
    names = [f.split()[0] for f in BEST.split(", ")]
    return pa.table({n: pa.array(np.asarray(c).astype(np.int64)) for n, c in zip(names, columns)})


def _join(parts: list[list[np.ndarray]]) -> pa.Table:
    return _table([np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in range(5)])


def _find_positives(rows: pa.Table, anchors: pa.Table, width: int) -> pa.Table:
    out = []
    for _, block in _blocks(rows, anchors, width):
        a, r = block.positives()
        none = np.zeros(len(a))
        out.append([block.anchors.ids[a], none, none, block.rows.ids[r], block.scores[a, r]])
    return _join(out)


def _find_negatives(rows: pa.Table, anchors: pa.Table, width: int) -> pa.Table:
    ids, scores = anchors.column("positive_ids").to_pylist(), anchors.column("positive_scores").to_pylist()
    out = []
    for part, block in _blocks(rows, anchors, width):
        own_ids, own_scores = ids[part], scores[part]
        count = max((len(x) for x in own_ids), default=0)
        # Absent positives have an empty range.
        low, high = np.ones((len(own_ids), count)), np.zeros((len(own_ids), count))
        of_id, of_score = np.zeros(low.shape, np.int64), np.zeros(low.shape, np.int64)
        for i, (x, s) in enumerate(zip(own_ids, own_scores)):
            of_id[i, : len(x)], of_score[i, : len(x)] = x, s
            low[i, : len(x)] = [-(-LEAST_PERCENT * v // 100) for v in s]
            high[i, : len(x)] = [MOST_PERCENT * v // 100 for v in s]
        if block.scores.dtype == np.int64:
            low, high = low.astype(np.int64), high.astype(np.int64)
        for j, a, r in block.negatives(low, high) if count else ():
            out.append([block.anchors.ids[a], of_id[a, j], of_score[a, j], block.rows.ids[r], block.scores[a, r]])
    return _join(out)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of
    ``vectors (vec_id, label, embedding)``.

    Components count as ``floor(256 x)`` and scores are inner products of these integers. Anchors
    are rows whose vec_id is divisible by 50. An anchor's positives are its five best rows of the
    same label, its hard negatives for each the three best rows of other labels with 50 to 95
    percent of the positive's score; higher scores come first, ties by the smaller vec_id. All of
    them where there are fewer; a positive without a hard negative gives no row.

    Rows with a null vec_id, label or vector, or with a component that is null, not finite, or 2 **
    19 and more in size, take no part. Of rows that repeat a vec_id the one with the smallest
    label, then vector (as bytes), takes part. A shorter vector counts as filled up with zeros, an
    empty one scores 0 with all. Other columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    width = max(1, rows.agg(F.max(F.size("embedding"))).first()[0] or 0)
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("embedding").toArrow()
    sample = quantise(few.column("embedding").combine_chunks(), width)[1]
    directions = choose_directions(sample) if len(sample) else np.eye(1, width)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, own = quantise(batch.column("embedding"), width)
            angles = angles_to(own, directions)
            cell = angles.argmin(axis=1) if len(own) else np.zeros(0, np.int64)
            kept = pa.array(valid)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").filter(kept),
                    batch.column("label").filter(kept),
                    pa.array([v.tobytes() for v in own.astype(np.int32)], pa.binary()),
                    pa.array(norms(own)),
                    pa.array([a.tobytes() for a in angles], pa.binary()),
                    pa.array(cell.astype(np.int32)),
                    pa.array(angles.min(axis=1) if len(own) else np.zeros(0, np.float32)),
                ],
                names=[f.split()[0] for f in PREPARED.split(", ")],
            )

    same_id = Window.partitionBy("vec_id").orderBy("label", "vector")
    prepared = stage(
        rows.mapInArrow(prepare, PREPARED).withColumn("at", F.row_number().over(same_id)).where("at = 1").drop("at"),
        "vectors",
    )
    count = prepared.count()
    size = min(max(count // GROUPS, LEAST_GROUP), MOST_GROUP)
    groups = -(-count // size) or 1
    order = ["label", "cell", "near", "vec_id"]
    placed = stage(
        prepared.repartitionByRange(groups, *order)
        .sortWithinPartitions(*order)
        .withColumn("block", F.spark_partition_id()),
        "blocks",
    )
    # Columns of their own, so that both sides of a block can be told apart.
    asking = placed.where(f"vec_id % {ANCHOR_STEP} = 0")
    anchors = asking.select(*[F.col(c).alias(c) for c in placed.columns if c != "block"])
    chunks = -(-anchors.count() // CHUNK_ANCHORS) or 1
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))
    spread = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    grouped = spread.groupBy("block", "chunk")

    # Positives: only blocks that have rows of the anchor's label.
    labels = placed.select("block", "label").distinct()
    asked = anchors.join(labels, "label").groupBy("block", "chunk")
    found = grouped.cogroup(asked).applyInArrow(lambda r, a: _find_positives(r, a, width), BEST)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    positives = stage(
        found.withColumn("at", F.row_number().over(best))
        .where(F.col("at") <= POSITIVES)
        .groupBy("anchor_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "other_id", "score"))).alias("all"))
        .select("anchor_id", F.col("all.other_id").alias("positive_ids"), F.col("all.score").alias("positive_scores")),
        "positives",
    )

    asked = anchors.join(positives, anchors["vec_id"] == positives["anchor_id"]).drop("anchor_id")
    blocks = [r[0] for r in placed.select("block").distinct().collect()]  # a number per block
    asked = asked.withColumn("block", F.explode(F.lit(blocks).cast("array<int>"))).groupBy("block", "chunk")
    found = grouped.cogroup(asked).applyInArrow(lambda r, a: _find_negatives(r, a, width), BEST)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "other_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= NEGATIVES)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("other_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
