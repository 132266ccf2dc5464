"""Ranked search, quality rules, spelling variants: brute force on small fixtures."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import common, lexical, rules, spelling
from ledgerlake.llm.registry import QUERIES
from tests.llm.conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans(common.UPPER, common.LOWER)


# --- ranked search ------------------------------------------------------------

def ranked(docs, items, top):
    """Plain scores of every document for every item."""
    bags = [(i, Counter(TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, total = len(bags), sum(s for _, _, s in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        want, scores = Counter(TERM.findall((text or "").translate(LOW))), []
        for i, bag, size in bags:
            m = 75 + 25 * size * n // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t, c in want.items() if t in bag)
            if s > 0:
                scores.append((-s, i is None, i, i))
        scores.sort(key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(scores[:top])]
    return sorted(out, key=str)


def searched(spark, docs, items, top=5, block_bytes=200, **options):
    d = spark.createDataFrame([(t, i, "x", 1) for i, t in docs], "text string, doc_id bigint, rid string, score int")
    q = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id string, text string, rank int")
    got = lexical.search(lexical.build_index(d, block_bytes=block_bytes), q, top, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def some_texts(seed, count):
    draw = random.Random(seed)
    words = ["Alpha", "beta", "ß2", "日本", "delta-7", "eps", "zeta", "eta", "theta", "iota", "kappa", "the", "the", "the"]
    return [" ".join(draw.choice(words[: draw.randint(2, 14)]) for _ in range(draw.randint(0, 40))) for _ in range(count)]


def test_search_equals_brute_force(spark):
    docs = [(i // 2 if i % 9 else None, t) for i, t in enumerate(some_texts(1, 150))] + [(7, None), (8, ""), (9, "!? ;")]
    items = [(f"q{i % 6}", t) for i, t in enumerate(some_texts(2, 9))] + [("none", None), (None, "alpha kappa"), ("far", "unheard of")]
    for top, at_once in ((5, 4), (20, 512)):
        assert searched(spark, docs, items, top, items_at_once=at_once) == ranked(docs, items, top)


def test_equal_scores_go_by_id(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000, "other text"), (1001, "same")]
    got = searched(spark, docs, [("q", "same words")], 7)
    assert [g[2] for g in sorted(got, key=lambda g: g[1])] == list(range(1, 8)) and got == ranked(docs, [("q", "same words")], 7)


def test_search_long_text_and_empty_tables(spark):
    long = "alpha " * 300_000 + "x" * 400_000
    docs = [(1, long), (2, "alpha"), (3, None)]
    assert searched(spark, docs, [("q", "alpha alpha"), ("x", "x" * 400_000)]) == ranked(docs, [("q", "alpha alpha"), ("x", "x" * 400_000)], 5)
    assert searched(spark, [], [("q", "alpha")]) == [] == searched(spark, docs, []) == searched(spark, [(1, None)], [("q", "a")])


def test_pair_bounds_are_tighter_and_safe():
    """Never below a document's share, never above the sum of the two maxima,
    and below it for words that do not meet."""
    work = lexical.Workload([([1, 2, 3, 4], [1, 2, 1, 1])])
    work.weigh(np.array([3, 4, 5, 6]), 50, 900)
    first = np.array([0, 3, 6, 8, 10])
    docs, impact = np.array([0, 1, 2, 3, 4, 5, 0, 6, 0, 6]), np.arange(10, 110, 10)
    (low, high), = [(int(a), int(b)) for a, b in zip(work.a[:1], work.b[:1])]
    assert len(work.pairs) == 2 and {low, high} == {0, 1}  # rare with rare
    joint = np.array([0, 180])
    block = lexical.Block(work, np.arange(4), first, docs, impact, np.array([30, 60, 80, 100]), np.array([0, 2]), np.array([0, 6]), np.array([160, 180]), joint, 7)
    plain = block.of_a + block.of_b
    assert (block.bound <= plain).all() and block.bound[0] < plain[0] and block.totals(block.bound)[0] < block.totals(plain)[0]


# --- quality rules --------------------------------------------------------------

def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    spans = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if spans[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(hit)


ODD_TEXTS = [
    None, "", " \n\t", "a", "one line\none line\n one line\none line\r\n\n\n", "# é 日本 $5 <b> & | * %\x00\x1f\x7f\x85\xa0",
    "a b c d e f g h " * 3, "a b c d e f g h\n" * 2 + "i", ("w " * 9).strip(), "x" * 300_000, "long " * 60_000, "A a A a A a A a A a a A",
]


def test_counts_equal_brute_force(spark):
    draw = random.Random(5)
    texts = ODD_TEXTS + ["".join(draw.choice("ab \n#é") for _ in range(draw.randint(0, 200))) for _ in range(200)]
    rows = [(i % 190 if i % 50 else None, t, 1.0) for i, t in enumerate(texts)]
    got = rules.statistics(spark.createDataFrame(rows, "doc_id int, text string, n_words double")).collect()
    assert sorted((str(r["doc_id"]), *(r[c] for c in rules.COUNTS)) for r in got) == sorted((str(i), *base_counts(t)) for i, t, _ in rows)


def test_query_equals_brute_force(spark):
    fn, sql = QUERIES["op12_quality_rules"]
    got = {r["doc_id"]: r for r in fn(spark, SF).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sql is None and len(got) == len(docs)
    for i, text in docs:
        n, *rest = base_counts(text)
        r = got[i]
        assert (r["n_words"], *(r[c] for c in rules.COUNTS[1:])) == (n, *rest)
        assert r["base_failed"] == (n < 20 or 100 * rest[-1] > 30 * n)
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_rules_hold_on_rows_that_taught_nothing(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out, learned = rules.rule_quality(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    held = [r for r in out.join(labels, "doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and not r["base_failed"]]
    right = sum(r["kept"] == (r["quality"] == 1) for r in held)
    assert learned and right >= 0.95 * len(held)
    assert sum(not r["kept"] for r in held if r["quality"] == 1) <= 0.02 * len(held)


def table_of(**columns):
    n = len(next(iter(columns.values())))
    return {c: np.asarray(columns.get(c, np.zeros(n)), float) for c in rules.STATISTICS}


def test_rules_find_a_conjunction_and_nothing_in_noise():
    rng = np.random.default_rng(3)
    a, b = rng.random(3000), rng.random(3000)
    poor = (a > 0.7) & (b <= 0.4)
    learned = rules.learn(table_of(symbol_share=a, upper_share=b), poor)
    got = np.any([r.covers(table_of(symbol_share=a, upper_share=b)) for r in learned], axis=0)
    assert (got == poor).mean() > 0.97 and "symbol_share >" in str(learned[0])
    assert rules.learn(table_of(symbol_share=a), rng.random(3000) < 0.3) == []


def test_expression_equals_the_rules(spark):
    learned = [rules.Rule([("symbol_share", "gt", 0.5), ("n_words", "le", 30.0)]), rules.Rule([("upper_share", "gt", 0.9)])]
    rows = [(0.6, 20, 0.0), (0.6, 40, 0.95), (0.1, 1, 0.1)]
    got = spark.createDataFrame(rows, "symbol_share double, n_words bigint, upper_share double").select(rules.verdict(learned).alias("r")).collect()
    assert [r["r"] for r in got] == [1, 2, None]


def test_rules_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([(None, None), (1, None), (None, 0)], "doc_id bigint, quality int")
    out, learned = rules.rule_quality(docs, none)
    assert learned == [] and out.count() == docs.count()
    assert rules.rule_quality(docs.limit(0), none)[0].count() == 0


# --- spelling -------------------------------------------------------------------

def apart_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def many_words(seed):
    draw = random.Random(seed)
    words = {"".join(draw.choice("abÿ") for _ in range(draw.randint(6, 9))) for _ in range(250)}
    words |= {"commonbeginning" + "".join(draw.choice("abcde") for _ in range(3)) for _ in range(80)}
    words |= {"".join(draw.choice("abcde") for _ in range(3)) + "commonending" for _ in range(80)}
    words |= {"aaaaaa" + "a" * i for i in range(12)} | {"z" * 5000, "z" * 5001, "z" * 4999 + "y"}
    return sorted(words)


@pytest.mark.parametrize("frequent,most_listed", [(2, 1), (8, 4), (64, 24), (10_000, 10_000)])
def test_near_words_equal_brute_force(spark, frequent, most_listed):
    words = many_words(frequent)
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if abs(len(a) - len(b)) < 2 and apart_by_one(a, b)}
    got = spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string"), frequent, most_listed).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_one_edit_changes_no_more_grams_than_the_bound():
    draw = random.Random(9)
    words = many_words(4)[:200]
    grams = Counter(w[p : p + q] for w in words for q in (2, 3) for p in range(len(w) - q + 1))
    extended = frozenset(g for g, n in grams.items() if n > 6)
    for w in words:
        own, seen = spelling.decompose(w, extended)
        bound = spelling.affected_bound(seen)
        assert bound < len(own)
        for i in range(len(w) + 1):
            c = draw.choice("abcÿ")
            for other in (w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]):
                changed = Counter(own) - Counter(spelling.decompose(other, extended)[0])
                assert sum(changed.values()) <= bound


def test_words_and_groups(spark):
    text = "Receive " * 200 + "recieve receve receeve recei\nve x" * 1
    rows = [(1, text, "a"), (1, text, "b"), (None, "receve " * 5 + "receev " * 5, "c"), (2, None, "d"), (3, "", "e"), (4, "receeve " * 25, "f"), (5, "y" * 200_000, "g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, word string")
    got = {r["word"]: r for r in spelling.spelling_variants(docs).collect()}
    assert {w: r["n"] for w, r in got.items()} == {"receive": 400, "receeve": 27, "receve": 7, "receev": 5}
    assert [got[w]["form"] for w in ("receive", "receeve", "receve", "receev")] == [None, "receive", "receive", "receeve"]
    assert got["receev"]["root"] == "receive" and got["receev"]["n_near"] == 1 and got["receeve"]["form_n"] == 400
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_noise_follows_the_checksum(spark):
    rows = [(i, f"Äbcdef{chr(97 + i % 26)}") for i in range(2000)]
    want = Counter()
    for i, run in rows:
        run = run.translate(LOW)
        h = zlib.crc32(f"{i}:{run}".encode())
        want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run] += 1
    got = spelling.word_counts(spark.createDataFrame(rows, "doc_id int, text string"), noise=7, least_count=1).collect()
    assert {r["word"]: r["n"] for r in got} == {w: n for w, n in want.items() if len(w) >= 6}


# --- hashing ------------------------------------------------------------------------

def test_a_very_long_word_stays_small():
    import tracemalloc

    raw = np.full(20_000_000, 97, np.uint8)
    starts, ends = common.words_of(raw, common.GRAPH_WORD)
    tracemalloc.start()
    one = common.word_hashes(raw, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and len(one) == 1


def test_hashes_do_not_depend_on_the_place():
    words = [b"ab", b"Long" * 100_000, b"ab", b"long" * 100_000, b"longer" * 50_000 + b"x"]
    raw = np.frombuffer(b" ".join(words), np.uint8)
    h = common.word_hashes(raw, *common.words_of(raw, common.GRAPH_WORD))
    assert h[0] == h[2] and h[1] == h[3] and len(set(h.tolist())) == 3
    exact = common.word_hashes(raw, *common.words_of(raw, common.GRAPH_WORD), common.AS_IS)
    assert exact[1] != exact[3] and exact[0] == exact[2]
