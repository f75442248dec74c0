"""MinHash near-duplicates with circulant signatures and exact confirmation.

A document's set holds the distinct word shingles of its whole text. Two permutations,
one shifted circularly, give all signature coordinates; bands of them are bucket keys.
Documents with the same set form a class, and one of them stands for it. Then

1. in each bucket every class is compared with the bucket's *centre*, the class whose id
   has the least hash, and the confirmed links make first components. The hash does not
   depend on the bucket, so the many buckets of one large group have few centres between them;
2. in buckets whose classes are still in several components, those outside the bucket's
   largest component are compared with another centre, of that component, and the
   components grow. This is repeated ``CENTRES - 1`` times, each time by another hash and for the classes that are left;
3. in buckets that are still mixed, the classes outside the largest component are compared
   with all classes of the bucket, block by block. A pair that meets in several buckets is
   compared in the first.

So each pair that shares a bucket is confirmed or refuted on the full sets unless other
links already join it: no link is lost to a cap, and no list of pairs is ever made. Links
are rows of classes; components come from alternating large-star and small-star steps.

With 40 bands of 6 coordinates, a pair of similarity 0.8 shares no bucket with probability
5e-6.

Null or wordless texts have empty sets and are linked with nothing. Rows with a null id
are linked with nothing either and keep a null component. Rows that share an id are one
document to this operator. An empty table gives an empty one. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlayer.llm import minhash
from lendlayer.llm.frames import keep, plain_documents, ready
from lendlayer.llm.textkit import column_texts

BANDS, ROWS = 40, 6
#: Rounds of comparing classes with one centre of their bucket.
CENTRES = 3
#: Classes that are compared with one copy of a centre.
COMPARED_TOGETHER = 512
#: Classes in a block of the second comparison.
BLOCK = 512


def sketches(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the set (k1, k2) and the band keys."""
    ready(docs.sparkSession)
    plain = plain_documents(docs, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in column_texts(batch.column(1)):
                size, first, second, bands = [], [], [], []
                for s in minhash.shingle_sets(texts, k):
                    a, b = minhash.set_key(s)
                    size.append(len(s))
                    first.append(a)
                    second.append(b)
                    bands.append(minhash.band_keys(minhash.signature(s, BANDS * ROWS), ROWS) if len(s) else np.empty(0, np.uint64))
                ends = np.cumsum([0, *map(len, bands)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(texts)), pa.array(size, pa.int64()),
                        pa.array(np.array(first, np.uint64).view(np.int64)), pa.array(np.array(second, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bands).view(np.int64))),
                    ],
                    ["doc_id", "n_shingles", "k1", "k2", "bands"],
                )

    return plain.mapInArrow(sketch, f"doc_id {id_type}, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>")


def shingle_table(docs: DataFrame, k: int) -> DataFrame:
    """cid, shingles (little-endian sorted 64-bit hashes) of plain documents."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in column_texts(batch.column(1)):
                made = [s.astype("<u8").tobytes() for s in minhash.shingle_sets(texts, k)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, len(texts)), pa.array(made, pa.binary())], ["cid", "shingles"])

    return docs.mapInArrow(sets, f"cid {id_type}, shingles binary")


def similar(shared: np.ndarray, a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (a + b - shared)


def _confirm_centres(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (centre, cid) pairs whose sets are similar enough.

    A centre's set goes once to each group of :data:`COMPARED_TOGETHER` of its pairs.
    """
    id_type = sets.schema["cid"].dataType.simpleString()
    counts = keep(pairs.groupBy("centre").agg(F.ceil(F.count("*") / COMPARED_TOGETHER).cast("bigint").alias("salts")), "centres")
    one = counts.withColumnRenamed("centre", "cid")
    heads = sets.join(one, "cid").select(
        F.col("cid").alias("centre"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"),
        F.lit(True).alias("head"), "cid", "shingles",
    )
    rest = pairs.join(counts, "centre").select("centre", F.pmod(F.xxhash64("cid"), "salts").alias("salt"), "cid")
    rest = rest.join(sets, "cid").select("centre", "salt", F.lit(False).alias("head"), "cid", "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in batches:
            found = []
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for row, (key, head, raw) in enumerate(zip(keys, batch.column(2).to_pylist(), batch.column(4).to_pylist())):
                mine = np.frombuffer(raw, dtype="<u8")
                if head:
                    at, own = key, mine
                elif key == at:
                    where = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                    if similar(int((own[where] == mine).sum()), len(own), len(mine), percent):
                        found.append(row)
            picked = pa.array(found, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(picked), batch.column(3).take(picked)], ["a", "b"])

    dealt = heads.unionByName(rest).repartition("centre", "salt").sortWithinPartitions("centre", "salt", F.desc("head"))
    return dealt.mapInArrow(compare, f"a {id_type}, b {id_type}")


def _mixed(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their component, and the buckets that hold several: bucket, main (its largest), blocks, outer."""
    labelled = members.join(labels, "cid", "left").select("bucket", "band", "cid", F.coalesce("comp", "cid").alias("comp"))
    parts = labelled.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    mixed = (
        parts.groupBy("bucket")
        .agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"), F.count("*").alias("kinds"))
        .filter("kinds > 1 and all > 2")
        .select("bucket", "main", F.ceil(F.col("all") / BLOCK).cast("bigint").alias("blocks"), F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("bigint").alias("outer"))
    )
    return labelled, mixed


def _least_hash(seed: int) -> Column:
    return F.min(F.struct(F.xxhash64("cid", F.lit(seed)).alias("h"), "cid"))["cid"].alias("centre")


def _centre_pairs(members: DataFrame, labels: DataFrame | None, seed: int) -> DataFrame:
    """(cid, centre): each class with its buckets' centres; once there are labels, those outside a bucket's main component."""
    if labels is None:
        asking, centres = members, members.groupBy("bucket").agg(_least_hash(seed))
    else:
        labelled, mixed = _mixed(members, labels)
        rows = keep(labelled.join(mixed.select("bucket", "main"), "bucket"), "mixed_rows")
        asking, centres = rows.filter("comp <> main"), rows.filter("comp = main").groupBy("bucket").agg(_least_hash(seed))
    return asking.join(centres, "bucket").filter("cid <> centre").select("cid", "centre").distinct()


def _confirm_rest(members: DataFrame, labels: DataFrame, sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Links inside buckets whose classes are still in several components."""
    id_type = sets.schema["cid"].dataType.simpleString()
    labelled, mixed = _mixed(members, labels)
    mixed = keep(mixed, "mixed")
    rows = labelled.join(mixed, "bucket").withColumn("outside", F.col("comp") != F.col("main"))
    span = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    own = lambda n, seed: F.array(F.pmod(F.xxhash64("cid", F.lit(seed)), n))
    # Tile (i, j): the i-th block of all classes against the j-th block of those outside.
    every = rows.select("bucket", "band", "cid", "comp", "outer", F.pmod(F.xxhash64("cid", F.lit(1)), "blocks").alias("i")).select(
        "bucket", "band", "cid", "comp", "i", F.explode(span("outer")).alias("j"), F.lit(False).alias("asks")
    )
    asking = rows.filter("outside").select("bucket", "band", "cid", "comp", "blocks", F.pmod(F.xxhash64("cid", F.lit(2)), "outer").alias("j")).select(
        "bucket", "band", "cid", "comp", F.explode(span("blocks")).alias("i"), "j", F.lit(True).alias("asks")
    )
    tiles = every.unionByName(asking).join(sets, "cid").join(reps, "cid")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        band = int(rows["band"].iloc[0])
        every, asking = rows[~rows["asks"]], rows[rows["asks"]]
        none = pd.DataFrame({"a": rows["cid"].iloc[:0], "b": rows["cid"].iloc[:0]})
        if not len(every) or not len(asking):
            return none
        members = [np.frombuffer(x, dtype="<u8") for x in every["shingles"]]
        sizes = np.array([len(m) for m in members])
        shingles, owner = np.concatenate(members), np.repeat(np.arange(len(members)), sizes)
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        bands = np.stack(every["bands"].to_list())[:, :band]
        ids, comps = every["cid"].to_numpy(), every["comp"].to_numpy()
        out_a, out_b = [], []
        for cid, comp, raw, keys in zip(asking["cid"], asking["comp"], asking["shingles"], asking["bands"]):
            mine = np.frombuffer(raw, dtype="<u8")
            lo, hi = np.searchsorted(shingles, mine, "left"), np.searchsorted(shingles, mine, "right")
            n = hi - lo
            total = int(n.sum())
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(total)
            shared = np.bincount(owner[at], minlength=len(members))
            new = (comps != comp) & ~(bands == np.asarray(keys)[:band]).any(axis=1)  # earlier bands had the pair already
            for x in ids[new & similar(shared, sizes, len(mine), percent)]:
                out_a.append(cid)
                out_b.append(x)
        return pd.DataFrame({"a": out_a, "b": out_b}) if out_a else none

    return tiles.groupBy("bucket", "i", "j").applyInPandas(compare, f"a {id_type}, b {id_type}")


def components(links: DataFrame) -> DataFrame:
    """(cid, comp): the least id that the links (a, b) reach, for every id in a link.

    Alternates large-star and small-star until every id hangs on its least one.
    """
    edges = keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges"
    )
    while True:
        # large star: neighbours above u go to the least of u and its neighbours
        both = edges.union(edges.select("v", "u"))
        least = keep(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")), "least")
        above = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, F.col("u") == F.col("k")).select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = keep(above.distinct(), "large")
        # small star: u and its neighbours below go to the least of them
        least = keep(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k"), "least")
        below = large.join(least, F.col("u") == F.col("k"))
        small = below.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("k", "m")).distinct()
        after = keep(small, "edges")
        # finished when the edges are a star forest: no id is both a root and a leaf
        if after.select("u").join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty() and after.groupBy("u").count().filter("count > 1").isEmpty():
            return after.select(F.col("u").alias("cid"), F.col("v").alias("comp"))
        edges = after


def _as_links(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("cid").alias("a"), F.col("comp").alias("b"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable over links), kept."""
    sketched = keep(sketches(docs, k, id_col, text_col), "sketches")
    real = sketched.filter("n_shingles > 0 and doc_id is not null")
    key = ["k1", "k2", "n_shingles"]
    classes = keep(real.groupBy(*key).agg(F.min("doc_id").alias("cid")), "classes")
    of_class = real.join(classes, key)
    owners = keep(of_class.select("doc_id", "n_shingles", "cid"), "owners")
    reps = of_class.filter("doc_id = cid").select("cid", "bands").dropDuplicates(["cid"])
    reps = keep(reps, "reps")
    placed = reps.select("cid", F.posexplode("bands").alias("band", "bucket"))
    buckets = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = keep(placed.join(buckets, "bucket").select("bucket", "band", "cid"), "members")
    active = members.select(F.col("cid").alias("w_id")).distinct()
    plain = plain_documents(docs, id_col, text_col)
    wanted = plain.join(active.hint("shuffle_hash"), F.col("doc_id") == F.col("w_id")).select("doc_id", "text")
    sets = keep(shingle_table(wanted, k).dropDuplicates(["cid"]), "sets")
    labels = None
    for seed in range(CENTRES):
        pairs = keep(_centre_pairs(members, labels, seed), "pairs")
        if labels is not None and pairs.isEmpty():
            break
        links = keep(_confirm_centres(pairs, sets, percent), "links")
        if labels is None:
            labels = components(links)
        elif not links.isEmpty():
            labels = components(_as_links(labels).union(links))
    more = keep(_confirm_rest(members, labels, sets, reps, percent), "more")
    if not more.isEmpty():
        labels = components(_as_links(labels).union(more))
    labels = labels.withColumnRenamed("cid", "l_id")
    linked = owners.join(labels, F.col("cid") == F.col("l_id"), "left").select("doc_id", "n_shingles", F.coalesce("comp", "cid").alias("component_id"))
    alone = sketched.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that another document of their component stands for."""
    found = near_duplicates(docs, k, percent, id_col, text_col)
    gone = keep(found.filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
