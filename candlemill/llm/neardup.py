"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes keeps its minimum and its maximum, so 128 evaluations give
a signature of 256 values. Bands of eight values (four permutations) are the join keys, and two
bits of each value form a sketch that estimates the similarity of two documents.

Links are found without listing the pairs of a group:

1. Documents with equal shingle sets are one class.
2. In each bucket every member is compared with one hub, the member that shares buckets with most
   others, so a group of copies costs one comparison each.
3. In buckets that this leaves in several components, members are put in some orders, each by a
   part of their sketches, and in each a member is compared with the next one of another
   component: near copies of a family that its hub does not reach are neighbours in some order.
4. Only members of a bucket that are in different components still are compared with each other,
   each pair in the first bucket it shares and only if sizes and sketches allow a link.

Members of buckets in several components get wide sketches, of four times as many permutations, so
that documents of one template below the similarity are told apart before their texts are joined.

Every comparison is confirmed on the full shingle sets. A pair at similarity 0.85 shares no bucket
with probability 4e-5, and either of its sketches is below the limit with probability 2e-5.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.graph import components
from candlemill.llm.memory import lean
from candlemill.llm.sorting import ordered
from candlemill.llm.text import free_prefix, mix, pieces, set_similarity, shingles, words
from candlemill.sources.staging import stage

PERMUTATIONS = 128
BANDS = 32
PER_BAND = PERMUTATIONS // BANDS
SKETCH_LONGS = 2 * PERMUTATIONS * 2 // 64
# Of 256 two-bit values, so many agree at least; at similarity 0.85 the mean is 227, deviation 5.
SKETCH_AGREE = 206
# The same of wide sketches: of 1024 values the mean is 909, the deviation 10.
WIDE = 512
WIDE_LONGS = 2 * WIDE * 2 // 64
WIDE_AGREE = 866
# Orders of neighbours, each by another two longs of the sketches.
ORDERS = 4
# So many ids, of 16 bytes each in a broadcast; a longer list is joined by a shuffle.
BROADCAST_IDS = 8_000_000

_SEEDS = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_SCALE = _SEEDS[:PERMUTATIONS] | np.uint64(1)
_SHIFT = _SEEDS[PERMUTATIONS:]
_WIDE_SEEDS = mix(np.arange(1, 2 * WIDE + 1, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))
_PLACE = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)

SIGNATURES = "doc_id long, n_shingles long, set_hi long, set_lo long, keys array<long>, sketch array<long>"


def min_max(
    values: np.ndarray, begins: np.ndarray, scale: np.ndarray = _SCALE, shift: np.ndarray = _SHIFT
) -> np.ndarray:
    """Signatures (documents, 2 * permutations): minimum and maximum under each permutation.

    ``begins`` holds the first value of each document, none of them empty.
    """
    out = np.empty((len(begins) - 1, 2 * len(scale)), np.uint64)
    at = begins[:-1]
    for p in range(len(scale)):
        permuted = values * scale[p]
        permuted += shift[p]
        out[:, 2 * p] = np.minimum.reduceat(permuted, at)
        out[:, 2 * p + 1] = np.maximum.reduceat(permuted, at)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key per band, different for equal values in different bands."""
    placed = mix(signature * _PLACE)
    return mix(placed.reshape(len(signature), BANDS, 2 * PER_BAND).sum(axis=2, dtype=np.uint64))


def sketches(signature: np.ndarray) -> np.ndarray:
    """Two bits of every value, 32 values to a long."""
    bits = (mix(signature) & np.uint64(3)).reshape(len(signature), -1, 32)
    return (bits << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=2, dtype=np.uint64)


def _lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, rows * width + 1, width), pa.int32()), pa.array(values.view(np.int64).reshape(-1))
    )


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for row, texts in pieces(batch.column("text")):
            w = words(texts)
            values, begins = shingles(w.hashes(), w.first)
            size = np.zeros(len(w), np.int64)
            hi, lo = np.zeros(len(w), np.uint64), np.zeros(len(w), np.uint64)
            for doc in range(len(w)):
                own = np.unique(values[begins[doc] : begins[doc + 1]])
                size[doc] = len(own)
                hi[doc] = own.sum(dtype=np.uint64)
                lo[doc] = mix(own).sum(dtype=np.uint64)
            full = np.flatnonzero(size)
            keys, sketch = np.zeros((len(w), BANDS), np.uint64), np.zeros((len(w), SKETCH_LONGS), np.uint64)
            if len(full):
                signature = min_max(values, np.append(begins[full], begins[-1]))
                keys[full], sketch[full] = band_keys(signature), sketches(signature)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(row, len(w)),
                    pa.array(size),
                    pa.array(hi.view(np.int64)),
                    pa.array(lo.view(np.int64)),
                    _lists(keys),
                    _lists(sketch),
                ],
                names=["doc_id", "n_shingles", "set_hi", "set_lo", "keys", "sketch"],
            )


def _wide_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, wide) of documents with shingles, some at a time."""
    for batch in batches:
        for row, texts in pieces(batch.column("text"), 200_000):
            w = words(texts)
            values, begins = shingles(w.hashes(), w.first)
            wide = sketches(min_max(values, begins, _WIDE_SEEDS[:WIDE] | np.uint64(1), _WIDE_SEEDS[WIDE:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(row, len(w)), _lists(wide)], names=["rep", "wide"]
            )


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, text_a, text_b) those whose full shingle sets are similar enough."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for _, texts in pieces(column):
            w = words(texts)
            values, begins = shingles(w.hashes(), w.first)
            out += [np.unique(values[begins[i] : begins[i + 1]]) for i in range(len(w))]
        return out

    for batch in batches:
        # A few rows at a time: sets take some times the room of their texts.
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            # Rows of one hub come together, so its set is made once.
            right = part.column("text_b").dictionary_encode()
            hubs = sets(right.dictionary)
            keep = []
            for own, hub in zip(sets(part.column("text_a")), right.indices.to_pylist()):
                both, union = set_similarity(own, hubs[hub])
                keep.append(union > 0 and 100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays(
                [part.column("a").filter(pa.array(keep)), part.column("b").filter(pa.array(keep))], names=["a", "b"]
            )


def _sketches_agree(a: str, b: str, name: str = "sketch") -> Column:
    """Whether enough two-bit values of the sketches, or of the wide ones, agree."""
    longs, most = (WIDE_LONGS, 2 * WIDE - WIDE_AGREE) if name == "wide" else (SKETCH_LONGS, 2 * PERMUTATIONS - SKETCH_AGREE)
    differ = F.lit(0)
    for i in range(longs):
        x = F.col(f"{a}.{name}")[i].bitwiseXOR(F.col(f"{b}.{name}")[i])
        one = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(one)
    return differ <= most


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    x, y = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose documents are similar enough, staged."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b")
    return stage(rows.mapInArrow(lean(lambda it: _linked(it, percent)), "a long, b long"), "linked")


def _with_ids(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents with these ids. A list of checked size is broadcast, so no text is shuffled."""
    wanted = stage(wanted.distinct(), "wanted")
    small = wanted.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(wanted) if small else wanted, "doc_id", "left_semi")


def _texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Texts of the documents that occur in pairs, staged."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id")))
    return stage(_with_ids(docs.select("doc_id", "text"), wanted), "texts")


def _open_buckets(members: DataFrame, clusters: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (rep, key, root, top) of buckets in several components, and all clusters with their root.

    The top of a bucket is the component that most of its members are in.
    """
    roots = components(links)
    placed = stage(
        clusters.join(roots, clusters["rep"] == roots["node"], "left")
        .withColumn("root", F.coalesce("root", "rep"))
        .drop("node"),
        "placed",
    )
    in_bucket = members.select("rep", "key").join(placed.select("rep", "root"), "rep")
    largest = (
        in_bucket.groupBy("key", "root")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select("key", F.col("top.root").alias("top"))
    )
    return stage(in_bucket.join(largest, "key").select("rep", "key", "root", "top"), "open"), placed


_NEIGHBOUR = ["key", "rep", "root", "n_shingles", "sketch"]
_LOW_BITS = int.from_bytes(b"\x55" * (8 * SKETCH_LONGS), "little")


def _neighbours(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of neighbours in their bucket, of different components, that may be linked.

    Neighbours are those in the order of the sketch from its long ``2 * turn`` on. A member of a
    small component is taken with the last one before and the first one after it of another. The
    members at the ends of a task's rows have fewer neighbours; the last step looks at what is
    still apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row of a bucket, and the last one of another component before it
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in _NEIGHBOUR[:-1]]
            sketch_rows = batch.column("sketch").flatten().to_numpy().reshape(batch.num_rows, -1)
            pairs = set()
            for key, rep, root, size, sketch in zip(*columns, sketch_rows):
                own = (key, rep, root, size, int.from_bytes(sketch.tobytes(), "little"))
                if held is None or held[0][0] != key:
                    held = (own, None)
                    continue
                last, other = held
                partner = last if last[2] != root else other
                if partner is not None and _may_link(partner, own, percent):
                    pairs.add((max(rep, partner[1]), min(rep, partner[1])))
                held = (own, last if last[2] != root else other)
            listed = np.array(sorted(pairs), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(listed[:, 0]), pa.array(listed[:, 1])], names=["a", "b"])

    order = ["key", "x", "y", "rep"]
    keyed = rows.withColumns({"x": F.col("sketch")[2 * turn], "y": F.col("sketch")[2 * turn + 1]})
    dealt = ordered(keyed, order).select(*_NEIGHBOUR)
    return dealt.mapInArrow(lean(run), "a long, b long")


def _may_link(x: tuple, y: tuple, percent: int) -> bool:
    """Whether sizes and sketches (at 3 and 4 of both) allow a link."""
    if 100 * min(x[3], y[3]) < percent * max(x[3], y[3]):
        return False
    bits = x[4] ^ y[4]
    return ((bits | (bits >> 1)) & _LOW_BITS).bit_count() <= 2 * PERMUTATIONS - SKETCH_AGREE


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id, and one of its rows.

    Of rows that repeat an id the one with the least hash of its text stays; rows without an id all
    stay. All columns are kept.
    """
    gone = near_duplicates(docs, percent).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    rank = f"{free_prefix(docs)}rank"
    same = Window.partitionBy(F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    rows = docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
    rows = rows.withColumn(rank, F.row_number().over(same.orderBy(F.xxhash64("text"))))
    return rows.where((F.col(rank) == 1) | F.col("doc_id").isNull()).drop(rank)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents link if ``100 * intersection >= percent * union`` of their sets of five-word
    shingles (``percent`` 85 or more: bands and sketches are set for that). component_id is the
    smallest doc_id reachable by links, the document itself included; kept marks that document.

    A null or blank text has an empty set and links with nothing. Rows that repeat a doc_id are
    one node and share its component; each row is returned. A row without doc_id is no node: its
    component_id is null and it is kept. Other columns are not read.
    """
    if percent < 85:
        raise ValueError("bands and sketches are made for similarities of 0.85 or more")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage(docs.mapInArrow(lean(_signatures), SIGNATURES), "signatures")

    # Equal sets are one class, represented by its smallest document.
    filled = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "set_hi", "set_lo"]
    classes = stage(
        filled.groupBy(*same).agg(
            F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    members = classes.select("rep", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = stage(members.join(shared, "key"), "members")

    # The hub of a bucket is the member with the largest buckets.
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    hubs = (
        members.join(weight, "rep")
        .groupBy("key")
        .agg(F.min(F.struct((-F.col("weight")).alias("w"), "rep")).alias("hub"))
        .select("key", F.col("hub.rep").alias("hub"))
    )
    sizes = classes.select("rep", "n_shingles", "sketch")
    stars = (
        members.join(hubs, "key")
        .where("rep <> hub")
        .select("rep", "hub")
        .distinct()
        .join(sizes.alias("x"), "rep")
        .join(sizes.withColumnRenamed("rep", "hub").alias("y"), "hub")
        .where(_sizes_allow("x", "y", percent) & _sketches_agree("x", "y"))
        .select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    )
    stars = stage(stars, "stars")

    # What a hub leaves apart: members outside the largest component of their bucket.
    clusters = stage(members.select("rep").distinct().join(classes, "rep"), "clusters")
    links = _confirm(stars, _texts_of(stars, docs), percent)
    open_buckets, placed = _open_buckets(members, clusters, links)
    beside = open_buckets.join(placed.select("rep", "n_shingles", "sketch"), "rep")
    near = functools.reduce(DataFrame.union, [_neighbours(beside, turn, percent) for turn in range(ORDERS)])
    near = stage(near.distinct(), "near")
    links = links.union(_confirm(near, _texts_of(near, docs), percent))
    open_buckets, placed = _open_buckets(members, clusters, links)
    asked = open_buckets.select(F.col("rep").alias("doc_id"))
    # An id whose rows have several texts has no wide sketch, and is held back by none.
    wide = _with_ids(docs, asked).mapInArrow(lean(_wide_sketches), "rep long, wide array<long>")
    wide = stage(wide.groupBy("rep").agg(F.collect_list("wide").alias("wide")), "wide")
    wide = wide.where("size(wide) = 1").select("rep", F.col("wide")[0].alias("wide"))
    full = placed.select("rep", "n_shingles", "keys", "sketch")
    rest = open_buckets.join(full, "rep").join(wide, "rep", "left")
    outer = rest.where("root <> top").alias("x")
    inner = rest.alias("y")
    earlier = F.array_position(F.col("x.keys"), F.col("x.key")) - 1
    pairs = (
        outer.join(inner, F.col("x.key") == F.col("y.key"))
        .where(F.col("x.root") != F.col("y.root"))
        .where((F.col("y.root") == F.col("y.top")) | (F.col("x.rep") < F.col("y.rep")))
        .where(_sizes_allow("x", "y", percent))
        .where(_sketches_agree("x", "y"))
        .where(F.coalesce(_sketches_agree("x", "y", "wide"), F.lit(True)))
        .where(
            (earlier == 0)
            | ~F.arrays_overlap(
                F.slice(F.col("x.keys"), F.lit(1), earlier.cast("int")),
                F.slice(F.col("y.keys"), F.lit(1), earlier.cast("int")),
            )
        )
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    )
    pairs = stage(pairs, "pairs")
    links = links.union(_confirm(pairs, _texts_of(pairs, docs), percent))
    # Members follow their class. A doc_id whose rows are in several classes links these.
    mapped = filled.join(classes.select(*same, "rep"), same).select("doc_id", "rep")
    several = mapped.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    shared_ids = mapped.join(several, "doc_id").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    roots = components(links.union(shared_ids))
    of_doc = (
        mapped.join(roots, mapped["rep"] == roots["node"], "left")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("root", "rep")).alias("root"))
        .select(F.col("doc_id").alias("node"), "root")
    )
    rows = signed.select("doc_id", "n_shingles")
    return rows.join(of_doc, rows["doc_id"] == of_doc["node"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("root", "doc_id").alias("component_id"),
        F.coalesce(F.col("root").isNull() | (F.col("root") == F.col("doc_id")), F.lit(True)).alias("kept"),
    )
