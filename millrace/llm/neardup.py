"""MinHash near-duplicates with odd sketches.

Texts with equal shingle sets form a class, and one member stands for it. Classes that
share a band of MinHash samples meet in a bucket. Inside a bucket odd sketches, parity
bitmaps of the samples, rule out pairs by the population count of an XOR, and what they
leave is confirmed on the full sets. A bucket returns links that connect its confirmed
pairs, never the pairs themselves, and buckets with the same members are tested once. A
large bucket is cut into blocks, and each two blocks are tested by a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import minhash
from millrace.llm.arrow import extended, slices, text_bytes
from millrace.llm.components import components
from millrace.llm.words import LOWER, U, numbers_by_text, shingle_set
from millrace.session import stage

#: Shingles of the members of one block, and rows and shingles of a product of sets.
BLOCK_SHINGLES, SIDE, COLUMNS = 250_000, 512, 8192


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``df``.

    A document's set holds the distinct shingles of ``words`` words, A to Z lowered; fewer
    words are one shingle. Documents are linked where 100 * shared >= percent * united; shingles
    are compared as 64-bit hashes. ``component_id`` is the smallest key reachable by links,
    ``kept`` tells whether that is the row's own. Pairs of at least 80 percent are missed by
    all bands with a chance of 5e-8 and by the sketches with 1e-9; for another percentage
    these chances are different.

    Null and empty texts, and texts without words, have 0 shingles and their own key as
    component. Rows with a null key are kept with a null component. Repeated rows get the
    same answer each; rows of one key with different texts count as linked. Other columns are not
    returned. An empty table gives an empty one.
    """
    rows = df.select(F.col(f"`{key}`").alias("id"), text_bytes(f"`{text}`").alias("text"))
    signed = stage(_signatures(rows, words), "signatures")
    usable = signed.filter("n_shingles > 0 and id is not null")
    classes = stage(
        usable.groupBy("class").agg(
            F.min("id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    links = _class_links(rows, classes, words, percent).union(_same_key_links(usable, classes))
    roots = components(links)
    member_of = stage(
        classes.join(roots, classes["rep"] == roots["node"], "left").select(
            F.col("class").alias("of"), F.coalesce("root", "rep").alias("root")
        ),
        "roots",
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    answered = signed.drop("bands", "sketch").join(member_of, signed["class"] == F.col("of"), "left")
    return answered.select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _signatures(rows: DataFrame, words: int) -> DataFrame:
    schema = extended(rows.select("id"), "n_shingles bigint, class binary, bands array<bigint>, sketch binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for found in _shingle_sets(batch, words):
                if not len(found):
                    out.append((0, None, None, None))
                    continue
                low = minhash.samples(found)
                bands = minhash.band_keys(low).astype(np.int64).tolist()
                out.append((len(found), _class(found), bands, minhash.odd_sketch(low).tobytes()))
            types = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            columns = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def _shingle_sets(batch: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    texts = [text.translate(LOWER) for text in batch.column("text").to_pylist()]
    return (shingle_set(numbers, words) for numbers in numbers_by_text(texts))


def _class(found: np.ndarray) -> bytes:
    """Equal for equal shingle sets; 128 bits, so that it tells any number of sets apart."""
    return xxhash.xxh3_128_digest(found.tobytes())


def _same_key_links(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of a key that has several."""
    several = usable.groupBy("id").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    several = several.filter("low <> high").select("id")
    return (
        several.join(usable.select("id", "class").distinct(), "id")
        .join(classes.select("class", "rep"), "class")
        .select(F.col("id").alias("a"), F.col("rep").alias("b"))
    )


def _class_links(rows: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between representatives that connect all classes similar enough."""
    banded = classes.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    buckets = (
        banded.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("n_shingles").alias("shingles"),
            F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who"),
        )
        .filter("members > 1")
        # Buckets of the same members, told by two numbers over them, are tested once.
        .groupBy("members", "shingles", "who")
        .agg(F.min("bucket").alias("bucket"))
        .withColumn("blocks", F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int"))
        .select(F.col("bucket").alias("of"), "blocks")
    )
    members = stage(
        banded.join(buckets, banded["bucket"] == buckets["of"]).select("bucket", "blocks", "rep"),
        "members",
    )
    wanted = members.select("rep").distinct().join(classes.select("rep", "class", "sketch"), "rep")
    sets = stage(_sets(rows, wanted, words), "sets")
    # Block i meets blocks j >= i; a member of block x takes part in each pair that names x.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.select("bucket", "rep", "block", other).select(
        "bucket",
        "rep",
        "block",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
    )
    groups = dealt.join(sets, "rep").repartition("bucket", "i", "j")
    groups = groups.sortWithinPartitions("bucket", "i", "j", "rep")
    kind = classes.schema["rep"].dataType.simpleString()
    return groups.mapInArrow(_tested(percent), f"a {kind}, b {kind}").distinct()


def _sets(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, sketch, set) of the wanted classes, computed anew from their texts."""
    texts = rows.join(wanted, rows["id"] == wanted["rep"]).select("rep", "class", "sketch", "text")
    schema = extended(texts.select("rep", "sketch"), "set binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            marks = batch.column("class").to_pylist()
            at, sets = [], []
            for k, (mark, found) in enumerate(zip(marks, _shingle_sets(batch, words), strict=True)):
                if _class(found) == mark:  # a key may have other texts
                    at.append(k)
                    sets.append(found.tobytes())
            taken = pa.array(at, pa.int64())
            columns = [batch.column(c).take(taken) for c in ("rep", "sketch")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], names=schema.names)

    return texts.mapInArrow(run, schema)


def _tested(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, rows, kind in _groups(batches):
            reps, links = _links(rows, of[1] == of[2], percent)
            if links:
                ends = [pa.array([reps[k] for k in side], kind) for side in zip(*links, strict=True)]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """((bucket, i, j), rows, type of rep) of each sorted group."""
    of, rows, kind = None, [], None
    for batch in slices(batches, "set"):
        kind = batch.schema.field("rep").type
        columns = (batch.column(c).to_pylist() for c in ("bucket", "i", "j", "rep", "block", "sketch", "set"))
        for bucket, i, j, *row in zip(*columns, strict=True):
            if (bucket, i, j) != of:
                if len(rows) > 1:
                    yield of, rows, kind
                of, rows = (bucket, i, j), []
            rows.append(row)
    if len(rows) > 1:
        yield of, rows, kind


def _links(rows: list[list], one_block: bool, percent: int) -> tuple[list, list[tuple[int, int]]]:
    """Links by position that connect all similar pairs of a group.

    Of two blocks only pairs across them are tested, since each block is a group as well.
    """
    reps = [r[0] for r in rows]
    block = np.array([r[1] for r in rows])
    sketches = np.array([np.frombuffer(r[2], U) for r in rows])
    sets = [np.frombuffer(r[3], U) for r in rows]
    sizes = np.array([len(s) for s in sets])
    most = minhash.most_differing_bits(percent / 100)
    root = np.arange(len(rows))
    links: list[tuple[int, int]] = []
    for left in range(0, len(rows), SIDE):
        for right in range(left, len(rows), SIDE):
            x, y = np.arange(left, min(left + SIDE, len(rows))), np.arange(right, min(right + SIDE, len(rows)))
            small = np.minimum(sizes[x][:, None], sizes[y])
            open_pairs = 100 * small >= percent * np.maximum(sizes[x][:, None], sizes[y])
            open_pairs &= root[x][:, None] != root[y]
            if not one_block:
                open_pairs &= block[x][:, None] != block[y]
            at_x, at_y = np.nonzero(open_pairs)
            differing = np.bitwise_count(sketches[x[at_x]] ^ sketches[y[at_y]]).sum(axis=1)
            open_pairs[at_x, at_y] = differing <= most
            x, y = x[open_pairs.any(axis=1)], y[open_pairs.any(axis=0)]
            if not len(x):
                continue
            open_pairs = open_pairs[np.ix_(x - left, y - right)]
            shared = _shared([sets[k] for k in x], [sets[k] for k in y])
            united = sizes[x][:, None] + sizes[y] - shared
            similar = open_pairs & (100 * shared >= percent * united)
            for row, k in enumerate(x):
                partners = y[similar[row]]
                while len(partners := partners[root[partners] != root[k]]):
                    links.append((int(k), int(partners[0])))
                    root[root == root[partners[0]]] = root[k]
    return reps, links


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set, as a product of 0/1 matrices."""
    columns = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), True)
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(columns), COLUMNS):
        part = columns[at : at + COLUMNS]
        out += _marks(left, part) @ _marks(right, part).T
    return out.astype(np.int64)


def _marks(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    values = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.searchsorted(columns, values)
    hit = columns[np.minimum(at, len(columns) - 1)] == values
    marks = np.zeros((len(sets), len(columns)), np.float32)
    marks[row[hit], at[hit]] = 1
    return marks
