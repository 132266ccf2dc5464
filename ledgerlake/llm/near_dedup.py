"""Near-duplicate groups by fast similarity sketching (operator 10).

A document is the set of its distinct word shingles.  Its sketch has
``BANDS * ROWS`` coordinates, filled in rounds: in each round every shingle is
hashed to one coordinate, a coordinate keeps its smallest value of the first
round that reaches it, and the later half of the rounds visits the coordinates
one by one, so all are filled after ``2 t`` rounds and the share of equal
coordinates of two sketches estimates the Jaccard similarity as sharply as
independent minima do.

Bands of coordinates give candidates, and every link is confirmed on the whole
sets.  With 52 bands of 5 rows a pair at similarity 0.8 shares no band with
probability (1 - 0.8^5)^52 = 1e-9, and fewer than ``SHARED`` = 3 bands with
4e-7; more similar pairs are missed less often still.

Only components are wanted, so candidates are tested in rounds and a
pair whose documents are already connected is never built:

1. texts with equal sets are one node;
2. each node with the head of most of its buckets (one pair a node);
3. each node with the first and last members of its other buckets;
4. all pairs of a bucket that are in different components yet: members outside
   the bucket's largest component against the others.

A node of fewer than ``SHARED`` buckets with several components is in no pair
of the last round and left out of it.
The last round would meet every outlier of a large group with the whole group.
Two exact steps avoid that in clusters (nodes connected by buckets) of more
than ``2 * RARE`` nodes.

First, by a reference: the node R that shares most buckets.  A set A is kept as
its difference to R, D(A); the difference of two sets is that of their D.
Sets within the threshold of R are linked through it.  Where A is not, a link
A, B needs |D(A) & D(B)| > (|D(B)| + h (|R| - |B|)) / 2, h = (1 - t) / (1 + t)
for the threshold t: more than about half of D(B) must be in D(A).  So B
enters with only the rarest half of D(B), A with all of D(A), and near copies
of one text, whose D are mostly words of their own, rarely meet.  This settles
all pairs of a node at similarity ``NEAR`` or more with R; by the triangle
inequality such a node has no link below NEAR - (1 - t).  The others go on to
a second reference, then to the second step.

Second, a shingle is rare if at most ``RARE`` nodes of the cluster hold it.
Two sets that share a rare shingle meet by that shingle.  Two that share none
share at most m = min(n1 - r1, n2 - r2) shingles (r: rare ones of a set), so
their similarity is at most m / (n1 + n2 - m), and a pair is built only where
this reaches the threshold.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import GRAPH_WORD, Bloom, bloom_of, keep, keep_last, load, mix, text_slices, word_hashes, words_in_rows
from ledgerlake.llm.graph import components

BANDS, ROWS, SHARED = 52, 5, 3
RARE = 64
#: Reference rounds, and the similarity to the reference that settles a node.
REFERENCES, NEAR = 2, 0.4
SALTS = 16
BLOOM_BITS = 26


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row; a row of fewer
    words than ``size``, but not none, is one shingle."""
    starts, ends, first = words_in_rows(raw, offsets, GRAPH_WORD)
    words = word_hashes(raw, starts, ends)
    n = len(words) - size + 1
    grams = np.zeros(max(n, 0), np.uint64)
    for i in range(size if n > 0 else 0):
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n]
    grams = mix(grams)
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= size:
            own = np.sort(grams[low : high - size + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif high > low:
            value = np.array([high - low], np.uint64)
            for i in range(low, high):
                value = value * np.uint64(0xC2B2AE3D27D4EB4F) + words[i]
            out.append(mix(value))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, as rows of t values."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(len(sets) * t, none)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not len(sets):
        return out.reshape(0, t)
    items = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    for turn in range(2 * t):
        value = mix(items ^ np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        if turn < t:
            place = ((value >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.full(len(items), turn - t)
        rank = (np.uint64(turn) << np.uint64(48)) | (value & np.uint64((1 << 48) - 1))
        np.minimum.at(out, row * t + place, rank)
        left = (out.reshape(-1, t) == none).any(axis=1)
        if not left.any():
            break
        open_ = left[row]
        items, row = items[open_], row[open_]
    return out.reshape(-1, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for each band."""
    parts = sketch.reshape(len(sketch), bands, rows)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), 1))
    for i in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, i])
    return keys.view(np.int64)


def _class_and_key(own: np.ndarray, doc_id) -> tuple[bytes, int]:
    """Digest of the set, and a key of this document within its class."""
    cls = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
    key = hashlib.blake2b(cls + repr(doc_id).encode(), digest_size=8).digest()
    return cls, int.from_bytes(key, "little", signed=True)


def _sketch_pass(size: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).field("id").to_pylist()
            for low, high, raw, offsets in text_slices(batch.column(1)):
                sets = shingle_sets(raw, offsets, size)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = band_keys(sketches([sets[i] for i in full], bands * rows), bands, rows)
                cls, key = [None] * len(sets), [None] * len(sets)
                counts = np.zeros(len(sets) + 1, np.int32)
                for i in full:
                    cls[i], key[i] = _class_and_key(sets[i], ids[low + i])
                    counts[i + 1] = bands
                listed = pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()),
                     pa.array(key, pa.int64()), listed],
                    names=["row", "n", "cls", "own", "bands"],
                )

    return run


def _key_pass(stand, wanted, bits: int):
    """The buckets (those in ``wanted``, if given) of the rows whose key
    within their class is in ``stand``."""

    def run(batches):
        rows, keys = Bloom(bits, stand.value), wanted and Bloom(bits, wanted.value)
        for batch in (b.slice(low, 2000) for b in batches for low in range(0, b.num_rows, 2000)):
            column = batch.column(2)
            own = batch.column(3).fill_null(0).to_numpy().view(np.uint64)
            ok = column.is_valid().to_numpy(zero_copy_only=False) & rows.has(own)
            at = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy())
            key = column.flatten().to_numpy().view(np.uint64)
            key, at = key[ok[at]], at[ok[at]]
            if keys is not None:
                hit = keys.has(key)
                key, at = key[hit], at[hit]
            took = [batch.column(i).take(pa.array(at)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*took, pa.array(key.view(np.int64))], names=["nid", "n", "key"])

    return run


def _is_member(bloom, bits: int):
    """Whether a hash is in the filter; other columns do not leave the JVM."""

    @F.arrow_udf("boolean")
    def known(hashes: pa.Array) -> pa.Array:
        return pa.array(Bloom(bits, bloom.value).has(hashes.to_numpy().view(np.uint64)))

    return known


def _set_pass(size: int, bloom, bits: int):
    """The whole sets of the documents that stand for a candidate class."""

    def run(batches):
        known, seen = Bloom(bits, bloom.value), set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, _high, raw, offsets in text_slices(batch.column(1)):
                cls, own, full = [], [], []
                sets = shingle_sets(raw, offsets, size)
                made = [_class_and_key(s, ids[low + i]) if len(s) else (b"", 0) for i, s in enumerate(sets)]
                ok = known.has(np.array([k for _, k in made], np.int64).view(np.uint64))
                for i in np.flatnonzero(ok):
                    if len(sets[i]) and made[i] not in seen:
                        seen = seen if len(seen) < 100_000 else set()
                        seen.add(made[i])
                        cls.append(made[i][0])
                        own.append(made[i][1])
                        full.append(sets[i].view(np.int64))
                listed = pa.array(full, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(own, pa.int64()), listed], names=["cls", "own", "items"])

    return run


def _lists(column) -> list[np.ndarray]:
    at, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _confirm(percent: int):
    """Keep the pairs whose sets reach the similarity."""

    def run(batches):
        for batch in batches:
            linked = []
            for x, y in zip(_lists(batch.column("one")), _lists(batch.column("two"))):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS,
    rows: int = ROWS, shared: int = SHARED, bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id
    reachable over links), kept (id equals component_id).

    Words are runs between ASCII white space, A-Z lower-cased.  Null texts and
    texts without words have no shingles and are linked with nothing.  Rows
    with equal sets are always linked.  Null ids come after all others; a
    group of null ids only has a null component and is kept.  Rows that share
    an id are kept together.  An empty table gives no rows.
    """
    ids = docs.schema[id_col].dataType.simpleString()
    row = F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid")).alias("row")
    sketched = docs.select(row, F.col(text_col).alias("text")).mapInArrow(
        _sketch_pass(size, bands, rows), f"row struct<id:{ids},rid:bigint>, n bigint, cls binary, own bigint, bands array<bigint>"
    )
    sketched = keep(sketched.select("row.id", "row.rid", "n", "cls", "own", "bands"), "sketches")
    low = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "rid", "own"))
    classes = sketched.where("cls is not null").groupBy("cls").agg(low.alias("low"), F.first("n").alias("n"))
    classes = keep(classes.select("cls", "n", F.col("low.id").alias("low"), F.col("low.rid").alias("nid"), F.col("low.own").alias("own")), "classes")

    # Buckets with two nodes or more, and their heads.  Most buckets have one
    # node: filters of fixed size leave these out before rows are shuffled, and
    # the few others that they let pass go by exact joins and counts.
    nodes = sketched.select(F.col("rid").alias("nid"), "n", "bands", "own")
    shape = "nid bigint, n bigint, key bigint"
    stand = bloom_of(classes, "own", bloom_bits)
    filled = nodes.mapInArrow(_key_pass(stand, None, bloom_bits), shape).groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    wanted = bloom_of(filled, "key", bloom_bits)
    placed = nodes.mapInArrow(_key_pass(stand, wanted, bloom_bits), shape).join(classes.select("nid"), "nid", "left_semi")
    placed = keep(placed, "placed")
    heads = placed.groupBy("key").agg(F.min("nid").alias("head"), F.max("nid").alias("tail"), F.count("*").alias("c"))
    heads = heads.where("c > 1").drop("c")
    members = keep(placed.join(heads, "key"), "buckets")
    if members.isEmpty():
        linked = None
    else:
        linked = _linked(docs, classes, members, size, percent, id_col, text_col, shared, bloom_bits)
    comps = classes.withColumn("comp", F.col("nid"))
    if linked is not None:
        comps = classes.join(linked, F.col("nid") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "nid"))
    smallest = comps.groupBy("comp").agg(F.min("low").alias("component_id"))
    by_class = comps.select("cls", "comp").join(smallest, "comp").select("cls", "component_id", F.lit(True).alias("known"))
    out = sketched.select("id", "n", "cls").join(by_class, "cls", "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def _linked(docs, classes, members, size, percent, id_col, text_col, shared, bloom_bits) -> DataFrame:
    """(node, comp) of all nodes that have a confirmed link."""
    wanted = classes.join(members.select("nid").distinct(), "nid", "left_semi")
    bloom = bloom_of(wanted, "own", bloom_bits)
    sets = docs.select(id_col, text_col).mapInArrow(_set_pass(size, bloom, bloom_bits), "cls binary, own bigint, items array<bigint>")
    # The filter lets a few others pass; the join with the document that stands
    # for the class keeps the right ones.  Rows that repeat this document pass
    # in every task that meets them; the counts below need one row a node.
    sets = sets.join(classes.select("cls", "own", "nid"), ["cls", "own"]).dropDuplicates(["cls", "own"])
    sets = keep(sets.select("nid", "items"), "sets")
    sizes = classes.select("nid", "n")

    def some(sets: DataFrame, nodes: DataFrame) -> DataFrame:
        """The sets of ``nodes`` (nid), and a few others, without a join: a
        join with few nodes would shuffle the sets of all."""
        bits = max(6, bloom_bits - 4)  # these are far fewer than all nodes
        bloom = bloom_of(nodes.select(F.xxhash64("nid").alias("hash")), "hash", bits)
        return sets.where(_is_member(bloom, bits)(F.xxhash64("nid")))

    def confirm(pairs: DataFrame, all_nodes: bool = False) -> DataFrame:
        pairs = keep(pairs, "pairs")
        held = sets if all_nodes else keep(some(sets, pairs.select(F.col("a").alias("nid")).unionAll(pairs.select("b")).distinct()), "pair-sets")
        return confirmed(pairs, held)

    def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        found = pairs.join(sets.select(F.col("nid").alias("a"), F.col("items").alias("one")), "a")
        found = found.join(sets.select(F.col("nid").alias("b"), F.col("items").alias("two")), "b").select("a", "b", "one", "two")
        return keep(found.mapInArrow(_confirm(percent), "a bigint, b bigint").distinct(), "links")

    def alike(n: str, m: str) -> Column:
        return (F.least(n, m) * 100 >= F.greatest(n, m) * percent)

    head_n = sizes.select(F.col("nid").alias("head"), F.col("n").alias("head_n"))
    votes = members.where("nid <> head").groupBy("nid", "n", "head").agg(F.count("*").alias("votes")).join(head_n, "head")
    votes = keep(votes.where(alike("n", "head_n")), "votes")
    best = votes.groupBy("nid").agg(F.max(F.struct("votes", "head")).alias("best"))
    links = confirm(best.select(F.col("best.head").alias("a"), F.col("nid").alias("b")), all_nodes=True)
    comps = components(links)

    def with_comp(df: DataFrame, node: str, comp: str) -> DataFrame:
        named = comps.select(F.col("node").alias(node), F.col("comp").alias("_c"))
        return df.join(named, node, "left").withColumn(comp, F.coalesce("_c", node)).drop("_c")

    # First and last members of the other buckets.
    ends = votes.select("nid", "head").unionAll(members.where("nid <> tail").select("nid", F.col("tail").alias("head"))).distinct()
    open_ = with_comp(with_comp(ends, "nid", "x"), "head", "y").where("x <> y")
    open_ = open_.join(best.select("nid", F.col("best.head").alias("head")), ["nid", "head"], "left_anti")
    links = keep(links.unionAll(confirm(open_.select(F.col("head").alias("a"), F.col("nid").alias("b")))), "links")
    comps = components(links)

    # What is left: pairs of different components in one bucket.
    def apart_still(members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Buckets with several components, and the nodes of wide clusters of
        them.  A pair shares ``shared`` such buckets, so a node in fewer is in none."""

        def several(inside: DataFrame) -> DataFrame:
            groups = inside.groupBy("key", "comp").agg(F.count("*").alias("c"))
            largest = groups.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("comps"))
            largest = largest.where("comps > 1").select("key", F.col("top.comp").alias("top"))
            return inside.join(largest, "key").withColumn("main", F.col("comp") == F.col("top")).drop("top")

        inside = keep(with_comp(members.select("key", "nid", "n"), "nid", "comp"), "bucket-components")
        mixed = keep(several(inside), "several-components")
        often = mixed.groupBy("nid").agg(F.count("*").alias("c")).where(F.col("c") >= shared).select("nid")
        mixed = keep(several(mixed.join(often, "nid", "left_semi").drop("main")), "mixed-buckets")
        stars = mixed.join(mixed.groupBy("key").agg(F.min("nid").alias("b")), "key").select(F.col("nid").alias("a"), "b")
        clusters = components(stars.distinct()).select(F.col("node").alias("nid"), F.col("comp").alias("cluster"))
        wide = clusters.groupBy("cluster").agg(F.count("*").alias("nodes")).where(F.col("nodes") > 2 * RARE).select("cluster")
        return mixed, keep(mixed.select("nid", "n", "comp").distinct().join(clusters, "nid").join(wide, "cluster"), "wide-clusters")

    mixed, crowd = apart_still(members)
    for _ in range(REFERENCES):
        if crowd.isEmpty():
            break
        near = _near_reference(mixed, crowd, some(sets, crowd), percent)
        to_reference = near.where(F.col("linked") & (F.col("nid") != F.col("ref"))).select(F.col("ref").alias("a"), F.col("nid").alias("b"))
        links = keep(links.unionAll(to_reference).unionAll(confirm(_reference_pairs(near, percent, alike))), "links")
        comps = components(links)
        members = keep(members.join(near.where("settled").select("nid"), "nid", "left_anti"), "open-buckets")
        mixed, crowd = apart_still(members)
    items = some(sets, crowd).join(crowd, "nid").select("cluster", "nid", "n", "comp", F.explode("items").alias("item"))
    counts = keep(
        items.groupBy("cluster", "item").agg(F.count("*").alias("c"), F.min("nid").alias("nid")).where(F.col("c") <= RARE), "rare-counts"
    )
    # A shingle of one set needs no join; those of two to RARE sets do.
    held = keep(items.join(counts.where("c > 1").select("cluster", "item"), ["cluster", "item"]), "rare-shingles")
    few_shared = held.select("nid").unionAll(counts.where("c = 1").select("nid")).groupBy("nid").agg(F.count("*").alias("r"))
    # "most": shingles that a set can share without sharing a rare one.
    mixed = mixed.join(few_shared, "nid", "left").withColumn("most", F.col("n") - F.coalesce("r", F.lit(0)))
    mixed = keep(mixed.where(F.col("most") * 100 >= F.col("n") * percent), "mixed-buckets")
    held = held.select("cluster", "item", *[F.col(c).alias("a_" + c) for c in ("nid", "n", "comp")]).join(
        held.select("cluster", "item", *[F.col(c).alias("b_" + c) for c in ("nid", "n", "comp")]), ["cluster", "item"]
    )
    held = held.where((F.col("a_nid") < F.col("b_nid")) & (F.col("a_comp") != F.col("b_comp")) & alike("a_n", "b_n"))
    held = held.select(F.col("a_nid").alias("a"), F.col("b_nid").alias("b"))

    def named(side: str) -> list[Column]:
        return [F.col(c).alias(side + c) for c in ("nid", "n", "most", "comp", "main")]

    few = mixed.where("not main").select("key", *named("a_"))
    every = mixed.select("key", *named("b_"))
    most = F.least("a_most", "b_most")
    apart = (F.col("a_comp") != F.col("b_comp")) & (F.col("b_main") | (F.col("a_nid") < F.col("b_nid")))
    apart = apart & (most * 100 >= (F.col("a_n") + F.col("b_n") - most) * percent)
    pairs = few.join(every, "key").where(apart).select(F.least("a_nid", "b_nid").alias("a"), F.greatest("a_nid", "b_nid").alias("b"))
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("c")).where(F.col("c") >= shared).select("a", "b")
    last = confirm(pairs.unionAll(held).distinct())
    if last.isEmpty():
        return comps
    return components(links.unionAll(last))


def _near_reference(mixed: DataFrame, crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The nodes of each wide cluster that are near its reference, the node
    that shares most buckets: cluster, nid, n, comp, ref, ref_n, sim, linked,
    settled, and the differences to the reference's set."""
    # All nodes of a bucket are in one cluster, so the bucket's first tells it.
    weight = mixed.groupBy("key").agg(F.count("*").alias("c"), F.min("nid").alias("nid")).join(crowd.select("nid", "cluster"), "nid").drop("nid")
    score = mixed.select("key", "nid").join(weight, "key").groupBy("cluster", "nid").agg(F.sum("c").alias("score"))
    refs = score.groupBy("cluster").agg(F.max(F.struct("score", "nid")).alias("top")).select("cluster", F.col("top.nid").alias("ref"))
    refs = refs.join(sets.select(F.col("nid").alias("ref"), F.col("items").alias("base")), "ref")
    # A cluster may hold many nodes: its reference is dealt to several keys.
    refs = refs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = crowd.withColumn("salt", F.pmod(F.xxhash64("nid"), F.lit(SALTS)).cast("int")).join(refs, ["cluster", "salt"])
    rows = rows.join(sets, "nid").withColumn("shared", F.size(F.array_intersect("items", "base")))
    union = F.col("n") + F.size("base") - F.col("shared")
    rows = rows.select(
        "cluster", "nid", "n", "comp", "ref", F.size("base").alias("ref_n"), (F.col("shared") / union).alias("sim"),
        (F.col("shared") * 100 >= union * percent).alias("linked"),
        F.concat(F.array_except("items", "base"), F.array_except("base", "items")).alias("diff"),
    )
    rows = rows.withColumn("settled", F.col("sim") >= NEAR)
    return keep(rows.where(F.col("sim") >= NEAR - (1 - percent / 100) - 1e-9), "near-references")


def _reference_pairs(near: DataFrame, percent: int, alike) -> DataFrame:
    """Pairs that may be linked, one of them settled, one not linked with the
    reference: they share one of the rarest differences of the settled one."""
    # More than (d + h (|R| - n)) / 2 differences are shared: in whole numbers.
    needed = f"((100 + {percent}) * d + (100 - {percent}) * (ref_n - n)) div (2 * (100 + {percent})) + 1"
    parts = near.withColumn("d", F.size("diff")).withColumn("item", F.explode("diff")).drop("diff", "ref")
    parts = keep(parts, "differences")
    often = parts.groupBy("cluster", "item").agg(F.count("*").alias("f"))
    rank = F.row_number().over(Window.partitionBy("nid").orderBy("f", "item"))
    short = parts.where("settled").join(often, ["cluster", "item"]).withColumn("rank", rank).where(F.col("rank") <= F.col("d") - F.expr(needed) + 1)

    def named(rows: DataFrame, side: str) -> DataFrame:
        return rows.select("cluster", "item", *[F.col(c).alias(side + c) for c in ("nid", "n", "comp", "sim")])

    pairs = named(parts.where(~F.col("linked")), "a_").join(named(short, "b_"), ["cluster", "item"])
    pairs = pairs.where((F.col("a_comp") != F.col("b_comp")) & alike("a_n", "b_n"))
    pairs = pairs.where(F.abs(F.col("a_sim") - F.col("b_sim")) <= 1 - percent / 100 + 1e-9)
    return pairs.select(F.least("a_nid", "b_nid").alias("a"), F.greatest("a_nid", "b_nid").alias("b")).distinct()


def deduplicated(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each group, with their own columns.  The
    ids that go (all of whose rows go) are written first, so their size is
    known and texts are shuffled only where they are too many to broadcast;
    sketches, sets and the like are dropped then."""
    def ids_that_go() -> DataFrame:
        found = near_duplicates(docs, id_col=id_col, **options)
        return found.groupBy(F.col(id_col).alias("_gone")).agg(F.max("kept").alias("stays")).where(~F.col("stays")).select("_gone")

    gone = keep_last(docs.sparkSession, ids_that_go, "near-duplicates")
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]), "left_anti")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), size=2)


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 1), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), sets AS (SELECT doc_id, md5(string_agg(g, chr(1) ORDER BY g)) AS h FROM s GROUP BY doc_id
), rep AS (SELECT h, min(doc_id) AS r FROM sets GROUP BY h
), rs AS (SELECT s.doc_id, s.g, n.n FROM s JOIN n USING (doc_id) WHERE doc_id IN (SELECT r FROM rep)
), rare AS (  -- a pair at 0.8 shares a shingle among the rarest fifth of either set
  SELECT doc_id, g, n FROM (
    SELECT rs.doc_id, rs.g, rs.n, row_number() OVER (PARTITION BY rs.doc_id ORDER BY f.c, rs.g) AS k
    FROM rs JOIN (SELECT g, count(*) AS c FROM rs GROUP BY g) f USING (g)
  ) WHERE k <= n - CAST(ceil(0.8 * n) AS BIGINT) + 1
), cand AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM rare a JOIN rare b ON a.g = b.g AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), link AS (
  SELECT a, b FROM (
    SELECT c.a, c.b, count(*) AS i FROM cand c JOIN rs x ON x.doc_id = c.a JOIN rs y ON y.doc_id = c.b AND y.g = x.g GROUP BY c.a, c.b
  ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)
), edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link
), reach(node, seen) AS (
  SELECT r, r FROM rep UNION SELECT edge.b, reach.seen FROM reach JOIN edge ON edge.a = reach.node WHERE reach.seen < edge.b
), comp AS (SELECT node, min(seen) AS c FROM (SELECT node, seen FROM reach UNION ALL SELECT a, a FROM edge) GROUP BY node
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.c, w.doc_id) AS component_id, w.doc_id = coalesce(comp.c, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN rep USING (h) LEFT JOIN comp ON comp.node = rep.r
"""
