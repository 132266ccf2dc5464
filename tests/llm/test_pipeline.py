"""The corpus pipeline against plain versions of its stages, and odd rows."""

from __future__ import annotations

import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerlake.llm import common, pii, quality, secrets, tokens
from tests.llm.conftest import SF
from tests.llm.test_scans import secret_spans

LOW = str.maketrans(common.UPPER, common.LOWER)


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents, then of each stage's output (as the next one reads it)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out.append(corpus_pipeline.keep(stage(spark, out[-1], SF), f"check-{name}"))
    last = corpus_pipeline.STAGES[-1][1](spark, out[-1], SF)
    return [[r.asDict() for r in df.collect()] for df in [*out, last]]


def test_quality_keeps_what_the_model_scores_well(spark, stages):
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r["doc_id"] for r in stages[1]}
    for r in stages[0]:
        raw = np.frombuffer((r["text"] or "").encode(), np.uint8)
        score = model.score(*quality.features(raw, np.array([0, len(raw)])))[0]
        assert abs(score - 0.7) < 1e-6 or (r["doc_id"] in kept) == (score >= 0.7)


def test_near_dedup_keeps_the_smallest_of_each_group(stages):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    docs = sorted(stages[1], key=lambda r: r["doc_id"])
    sets, comp, holds = [shingles(r["text"]) for r in docs], list(range(len(docs))), {}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, s in enumerate(sets):
        for j, shared in Counter(j for x in s for j in holds.get(x, ())).items():
            if 100 * shared >= 80 * (len(s) + len(sets[j]) - shared):
                a, b = sorted((root(i), root(j)))
                comp[b] = a
        for x in s:
            holds.setdefault(x, []).append(i)
    assert {r["doc_id"] for r in stages[2]} == {docs[i]["doc_id"] for i in range(len(docs)) if root(i) == i}


def test_decontamination_drops_what_shares_a_window(spark, stages):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    known: dict[int, set] = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = word.findall((r["text"] or "").translate(LOW))
        n = min(10, len(w))
        if n:
            known.setdefault(n, set()).update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    stay = set()
    for r in stages[2]:
        w = word.findall((r["text"] or "").translate(LOW))
        if not any(tuple(w[i : i + n]) in spans for n, spans in known.items() for i in range(len(w) - n + 1)):
            stay.add(r["doc_id"])
    assert stay == {r["doc_id"] for r in stages[3]}


def test_mixing_meets_its_targets(stages):
    def size(text):
        return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))

    have = Counter()
    for r in stages[3]:
        have[r["source"]] += size(r["text"])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(have, key=lambda s: (s is None, s)))}
    target, open_, rest = {}, set(have), sum(have.values())
    while True:
        share = {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * have[s]}
        if not over:
            break
        for s in over:
            target[s] = 3 * have[s]
            rest -= target[s]
        open_ -= over
    target |= share
    got, copies = Counter(), Counter(r["doc_id"] for r in stages[4])
    for r in stages[4]:
        got[r["source"]] += size(r["text"])
    largest = {s: max((size(r["text"]) for r in stages[3] if r["source"] == s), default=0) for s in have}
    assert all(abs(got[s] - target[s]) <= largest[s] for s in have) and max(copies.values()) <= 3


def test_token_rows_equal_whole_texts(stages):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_tokenizer())
    want = Counter()
    for r in stages[4]:
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, tokens.END_ID]
        want[r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    got = sorted(stages[5], key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:])) and [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)


def test_run_with_odd_rows(spark, tmp_path):
    """Null, empty, very long and repeated texts, null ids and sources, and columns with clashing names."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows += [(None, rows[0][1], None), (10**6, None, None), (10**6 + 1, "", "s"), (10**6 + 2, "x" * 300_000, "s"), rows[1], rows[1]]
    rows = [(*r, "a", 1.0, 2, None) for r in rows]
    kind = "doc_id bigint, text string, source string, cls string, score double, rid bigint, _gone string"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert 0 < out.count() and set(out.columns) >= {"doc_id", "start", "n_tokens", "ids_crc32"}


def test_run_over_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def _seconds(work, *sizes):
    work(sizes[0])  # compiled code
    out = []
    for n in sizes:
        began = time.perf_counter()
        work(n)
        out.append(time.perf_counter() - began)
    return out


def test_secrets_of_one_text_take_linear_time(spark):
    ratios = secrets.train_models(secrets.labelled_samples(spark.read.parquet(f"{SF}/documents.parquet")))

    def work(n):
        text = "é password=abcdef12 and then " * n
        r = secrets.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), ratios).first()
        assert r.n_assign == n and r.spans == secret_spans(text)

    few, many = _seconds(work, 5_000, 20_000)
    assert many < 6 * max(few, 0.5)


def test_personal_data_of_one_text_takes_linear_time():
    import pyarrow as pa

    def work(n):
        text = "é write to someone@example.org or " * n
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["row", "text"])
        (out,) = list(pii._extract([batch]))
        assert len(out.column(1)[0]) == n

    few, many = _seconds(work, 5_000, 20_000)
    assert many < 6 * max(few, 0.1)
