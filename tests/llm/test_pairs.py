"""Exact dedup, near-dedup, decontamination: edge rows, hot groups, brute force."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import common, dedup_exact, graph, near_dedup, winnowing


def test_exact_groups_and_edge_rows(spark, docs):
    rows = dedup_exact.exact_duplicates(docs, ranges=5).collect()
    assert len(rows) == 7
    same = [r for r in rows if r.group_size == 4]
    assert len(same) == 4 and {r.keep_id for r in same} == {6} and [r.doc_id for r in same if r.kept] == [6]
    empty = [r for r in rows if r.group_size == 2]
    assert {(r.doc_id, r.keep_id, r.kept) for r in empty} == {(1, 2, False), (2, 2, True)}
    assert dedup_exact.exact_duplicates(docs.limit(0)).count() == 0


def test_exact_smallest_stays_and_hot_group_is_spread(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("t"), F.col("id") % 40)).alias("text"))
    out = dedup_exact.exact_duplicates(df, stays="min", ranges=12)
    hot = out.where("group_size = 1000")
    assert hot.count() == 1000 and {r.keep_id for r in hot.collect()} == {0}
    assert out.where("kept").count() == 41


def test_components_of_chain_and_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, j) for j in range(101, 120)]
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(31)) and all(got[j] == 100 for j in range(100, 120))


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    a, b = np.unique(base[:900]), np.unique(base[100:])
    s = near_dedup.sketches([a, b, a[:1]], 260)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.12 and (s != np.uint64(2**64 - 1)).all()


def test_near_duplicates_against_brute_force(spark):
    random.seed(4)
    vocab = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = random.choices(vocab, k=random.randint(20, 80))
        for _ in range(random.randint(1, 6)):
            words = list(base)
            for _ in range(random.randint(0, 4)):
                words[random.randrange(len(words))] = random.choice(vocab)
            texts.append(" ".join(words))
    sets = [{tuple(w[i : i + 2]) for i in range(len(w) - 1)} for w in (t.split() for t in texts)]
    comp = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), size=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), comp[i]) for i in range(len(texts))}


def test_near_duplicates_of_a_wide_cluster_with_repeated_rows(spark):
    """Pairs of the last round that share no rare word, with rows that repeat
    an id and text, copies under other ids, and a filter that lets all pass."""
    random.seed(6)
    pool = [f"c{i}" for i in range(105)]
    sets = [set(random.sample(pool, 90)) | {f"p{i}_{j}" for j in range(10)} for i in range(400)]
    for i in range(190, 202, 2):  # twins: the same common words, other private ones
        sets[i + 1] = {w for w in sets[i] if w[0] == "c"} | {f"p{i + 1}_{j}" for j in range(10)}
    comp = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j in range(i):
            if 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    assert all(comp[i + 1] == i for i in range(190, 202, 2))
    rows = [(i, " ".join(sorted(s))) for i, s in enumerate(sets)]
    copies = [(1000 + i, t) for i, t in rows[190:196]]
    # Slices of one table, so repeated rows stand in other tasks than their first.
    df = spark.createDataFrame(spark.sparkContext.parallelize([*rows, *rows[196:202], *rows[196:202], *copies], 4), "doc_id bigint, text string")
    assert df.rdd.getNumPartitions() == 4
    got = near_dedup.near_duplicates(df, size=1, bloom_bits=6).collect()
    assert len(got) == 418
    assert {(r.doc_id, r.component_id) for r in got} == {(i, comp[i % 1000 if i >= 1000 else i]) for i in [*range(400), *range(1190, 1196)]}


def test_near_duplicates_edge_rows(spark, docs):
    rows = near_dedup.near_duplicates(docs, size=2).collect()
    by = {(r.doc_id, r.n_shingles): r for r in rows}
    assert len(rows) == 7 and by[(1, 0)].component_id == 1 and by[(2, 0)].kept
    assert by[(3, 2)].kept and by[(None, 2)].component_id == 3 and by[(6, 2)].component_id == 3
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in near_dedup.deduplicated(docs, size=2).collect()) == ["1", "2", "3", "3", "5"]


def test_winnowing_keeps_every_window():
    """Equal windows have equal fingerprints wherever they stand."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 200).astype(np.uint64)
    other = np.concatenate([rng.integers(0, 2**63, 7).astype(np.uint64), words[50:80]])
    a, b = winnowing.fingerprints(words, 10, 10, 5), winnowing.fingerprints(other, 10, 10, 5)
    assert (a[50:71] == b[7:28]).all()


def test_contamination_edge_rows(spark, docs):
    items = spark.createDataFrame([(1, "alpha Beta"), (2, None), (3, "alpha beta gamma"), (3, "none of these")], "item_id bigint, text string")
    got = {(r.doc_id, r.n_words): r for r in winnowing.contamination(docs, items).collect()}
    assert got[(1, 0)].n_hit == 0 and not got[(2, 0)].contaminated
    assert (got[(3, 3)].n_hit, got[(3, 3)].n_items) == (3, 2) and got[(None, 3)].contaminated
    assert winnowing.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    assert winnowing.contamination(docs.limit(0), items).count() == 0
    assert sorted(str(r.doc_id) for r in winnowing.clean_documents(docs, items).collect()) == ["1", "2", "5"]


def _copies(n, seed):
    """Five-word shingles of near copies of one text, single words replaced."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{j}" for j in range(104)]
        for _ in range(draw.choice((1, 1, 2, 2, 3, 4, 9)) if i else 0):
            words[draw.randrange(104)] = f"p{i}"
        out.append({zlib.crc32(" ".join(words[j : j + 5]).encode()) for j in range(100)})
    return out


def _round(spark, sets):
    rows = [(i, len(s), i) for i, s in enumerate(sets)]
    crowd = spark.createDataFrame([(*r, 0) for r in rows], "nid bigint, n bigint, comp bigint, cluster bigint")
    # The whole text shares most buckets.
    keys = [(7, i) for i in range(len(sets))] + [(8 + k, 0) for k in range(3)]
    mixed = spark.createDataFrame(keys, "key bigint, nid bigint")
    held = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "nid bigint, items array<bigint>")
    near = near_dedup._near_reference(mixed, crowd, held, 80)
    pairs = near_dedup._reference_pairs(near, 80, lambda n, m: F.least(n, m) * 100 >= F.greatest(n, m) * 80)
    return {r.nid: r for r in near.collect()}, {(r.a, r.b) for r in pairs.collect()}


def test_reference_round_loses_no_link(spark):
    sets = [*_copies(120, 3), *[{5000 + i, *range(40), *range(6000, 6060)} for i in range(8)]]
    near, pairs = _round(spark, sets)
    assert {r.ref for r in near.values()} == {0} and any(r.settled and not r.linked for r in near.values())
    done, linked = ({i for i, r in near.items() if r[c]} for c in ("settled", "linked"))
    links = 0
    for j, y in enumerate(sets):
        for i in range(j):
            if 100 * len(sets[i] & y) >= 80 * len(sets[i] | y):
                assert (i, j) in pairs or {i, j} <= linked or not {i, j} & done
                links += bool({i, j} & done)
    assert links > 100


def test_reference_round_builds_few_pairs(spark):
    few, many = (len(_round(spark, _copies(n, 5))[1]) for n in (300, 1200))
    assert many <= 4.5 * max(few, 300) and many < 0.005 * 1200 * 1199 / 2, (few, many)


def test_near_copies_of_one_text_against_brute_force(spark):
    draw = random.Random(8)
    text = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(300):
        words = list(text)
        for _ in range(draw.choice((0, 1, 1, 2, 3, 4)) if i else 0):
            words[draw.randrange(100)] = f"p{i}_{draw.randrange(3)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    comp = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j in range(i):
            if comp[i] != comp[j] and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(comp)) and len(set(comp)) > 50


def test_components_join_few_rows(spark, monkeypatch):
    """Links that have become loops are not met again, whatever the number of rounds."""
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(400)] + [(draw.randrange(1000, 1200), draw.randrange(1000, 1200)) for _ in range(4000)]
    links += [(5000, j) for j in range(2000, 2100)]
    kept, real = [], graph.keep
    monkeypatch.setattr(graph, "keep", lambda d, name: kept.append((name, real(d, name))) or kept[-1][1])
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(401)) and all(got[i] == 2000 for i in [*range(2000, 2100), 5000])
    assert {got[i] for i in got if 1000 <= i < 1200} == {1000} and len(got) == 401 + 200 + 101
    edges = [d.count() for name, d in kept if name == "edges"]
    assert edges[-1] == 0 and sum(edges[1:]) <= 0.2 * edges[0], edges
    assert graph.components(spark.createDataFrame([(3, 3)], "a bigint, b bigint")).count() == 0


def _hub_rows(n):
    """Texts that share a passage of less than half of their words, too little
    to be linked, but enough that many share a bucket or two."""
    hub = " ".join(f"h{j}" for j in range(40))
    return [(i, hub + " " + " ".join(f"p{i}_{j}" for j in range(45))) for i in range(n)]


def test_nodes_of_few_shared_buckets_are_not_compared(spark, monkeypatch):
    """Texts with a passage in common, but few buckets, are not cut into shingles
    again; the rows that are grow as the number of texts, not with its square."""
    kept, real = [], near_dedup.keep
    monkeypatch.setattr(near_dedup, "keep", lambda d, name: kept.append((name, real(d, name))) or kept[-1][1])

    def rows_made(n):
        kept.clear()
        twins = [(n, f"{_hub_rows(1)[0][1]} more"), (n + 1, None)]
        out = near_dedup.near_duplicates(spark.createDataFrame([*_hub_rows(n), *twins], "doc_id bigint, text string"), size=2).collect()
        assert {r.doc_id: r.component_id for r in out} == {i: i if i != n else 0 for i in range(n + 2)}
        nodes = max(d.select("nid").distinct().count() for name, d in kept if name == "several-components")
        return nodes, sum(d.count() for name, d in kept if name in ("differences", "rare-shingles", "rare-counts"))

    (few, small), (many, large) = rows_made(600), rows_made(1800)
    assert few > 150 and many > 900  # nodes that share a bucket with another component
    assert small <= 0.25 * 84 * few and large <= 0.25 * 84 * many, (few, small, many, large)


def test_single_buckets_are_not_shuffled(spark, monkeypatch):
    """Of the buckets, those of one text are left out by the filters, whoever repeats it."""
    kept, real = [], near_dedup.keep
    monkeypatch.setattr(near_dedup, "keep", lambda d, name: kept.append((name, real(d, name))) or kept[-1][1])
    rows = [(i, " ".join(f"p{i // 2 if i < 4 else i}_{j}" for j in range(50))) for i in range(200)] + [(500, "w " * 9), (501, None)]
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), bloom_bits=16).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: {1: 0, 3: 2}.get(i, i) for i in [*range(200), 500, 501]}
    assert dict((name, d.count()) for name, d in kept if name in ("placed", "buckets"))["placed"] < 0.2 * 52 * 199


def test_deduplicated_drops_its_tables(spark, docs):
    folder = os.path.join(common.shared_dir(spark).removeprefix("file:"), "llm")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = near_dedup.deduplicated(docs, size=2)
    assert [p.split("-")[:2] for p in set(os.listdir(folder)) - before] == [["near", "duplicates"]]
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "3", "3", "5"]
    left = set(os.listdir(folder))
    with pytest.raises(ZeroDivisionError):
        common.keep_last(spark, lambda: common.keep(docs, "part") and 1 / 0, "whole")
    assert set(os.listdir(folder)) == left and common.keep(docs, "after").count() == 7
