"""Mixing, sharding, quality, token files, pipeline."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerlake.llm import mixing, quality, sharding, tokens
from ledgerlake.llm.common import text_slices
from tests.llm.conftest import SF


def test_targets_reshare_the_excess():
    assert mixing.targets([100, 100], [5, 2]) == pytest.approx([1000 / 7, 400 / 7])
    assert mixing.targets([10, 1000], [5, 2]) == pytest.approx([30, 980])
    assert mixing.targets([], []) == [] and mixing.targets([0, 5], [5, 2]) == [0, 5]


def test_mix_meets_targets(spark, duck):
    out = mixing.op2_mixing(spark, SF).collect()
    info = {d: (s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, s, t in duck.sql("SELECT doc_id, source, text FROM documents").fetchall()}
    assert len(out) == len(info)
    taken, target = defaultdict(int), {}
    for r in out:
        source, size = info[r.doc_id]
        assert r.size == size and r.taken <= 3 * size
        taken[source] += r.taken
        target[source] = r.target
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= 0.1 * goal
    assert sorted(map(tuple, mixing.op2_mixing(spark, SF).collect())) == sorted(map(tuple, out))


def test_mix_edge_rows(spark, docs):
    out = mixing.mix(docs).collect()
    assert len(out) == 7 and all(r.taken <= 3 * r.size for r in out)
    assert mixing.mix(docs.limit(0)).count() == 0
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    assert rows.count() == sum(r.copies for r in out)


def test_quality_learns_one_row_of_each_id(spark):
    rows = [(i, f"text number {i} of some words" + " again" * (i % 5)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    hot = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2)

    def fitted(more):
        return quality.train(spark.createDataFrame(rows + more, "doc_id bigint, text string"), labels)

    once, often = fitted([]), fitted([rows[hot]] * 40)
    assert once.bias == often.bias and (once.linear == often.linear).all() and (once.pairs == often.pairs).all()
    others = [(hot, f"other text {i}") for i in range(9)]
    assert (fitted(others).linear == fitted(others[::-1] * 3).linear).all()


def test_shards_split_a_hot_id(spark, monkeypatch):
    """Equal rows that make up a third are ranked in many groups; shards do not
    depend on how the rows are dealt over tasks."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "if(id % 3 = 0, 'same', concat('t', id)) as text")
    ranked, real = [], sharding.keep
    monkeypatch.setattr(sharding, "keep", lambda d, name: ranked.append(real(d, name)) or ranked[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        one, two = (sharding.shard_rows(d, shards=5, vnodes=8).collect() for d in (df, df.repartition(7, "text")))
        groups = ranked[0].groupBy(*[c for c in ("arc", "block", "range") if c in ranked[0].columns]).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(r["count"] for r in groups) <= 300
    assert Counter((r.doc_id, r.text_crc32, r.shard) for r in one) == Counter((r.doc_id, r.text_crc32, r.shard) for r in two)
    for shard in range(5):
        assert sorted(r.slot for r in one if r.shard == shard) == list(range(600))


def test_shards_differ_by_one_row(spark, docs):
    out = sharding.op4_sharding(spark, SF).collect()
    count = Counter(r.shard for r in out)
    assert len(count) == 16 and max(count.values()) - min(count.values()) <= 1
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(n)) for s, n in count.items())
    few = sharding.shard_rows(docs, shards=2, vnodes=4).collect()
    assert len(few) == 7 and {r["size"] for r in few if r.doc_id in (1, 2)} == {1}
    assert sharding.shard_rows(docs.limit(0)).count() == 0


def test_bounded_loads_move_little():
    points = sharding.ring(16, 64)
    random.seed(0)
    keys = [random.getrandbits(64) - 2**63 for _ in range(8000)]
    owners = [s for _, s in points]
    first = sharding.shard_of_keys(keys, 16)
    spots = Counter((sharding.bisect_right([p for p, _ in points], k) % len(points), 0) for k in keys)
    moved = sharding.bounded_loads(spots, owners, sharding.capacities(8000, 16, 0.25))
    load = Counter()
    for *_, low, high, shard, slot in moved:
        assert load[shard] == slot
        load[shard] += high - low
    assert sum(load.values()) == 8000 and max(load.values()) <= 8000 * 1.25 / 16 + 2
    assert sum(max(0, load[s] - n) for s, n in Counter(first).items()) < 800


def test_quality_on_held_out_rows(spark, docs):
    table = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.op5_quality(spark, SF).join(table, "doc_id").where("held_out and quality is not null").collect()
    right = sum(r.predicted == r.quality for r in out)
    assert len(out) > 5 and right >= 0.85 * len(out)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    assert quality.scored(docs, model).where("score between 0 and 1").count() == 7
    assert quality.scored(docs.limit(0), model).count() == 0
    assert quality.good_documents(docs, labels).columns == docs.columns


def test_machine_identity():
    """The sum-of-squares form equals the sum over pairs."""
    m = quality.Machine(6, 3)
    index, value = np.array([0, 2, 5]), np.array([0.5, 1.5, -1.0])
    pairs = sum(m.pairs[:, index[i]] @ m.pairs[:, index[j]] * value[i] * value[j] for i in range(3) for j in range(i))
    assert m.raw(np.array([0, 3]), index, value)[0][0] == pytest.approx(pairs)


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 50257, 4096), np.full(1024, 7), rng.zipf(1.3, 2048).clip(0, 2**32 - 1)):
        ids = ids.astype(np.uint32)
        assert (tokens.decode_blocks(tokens.encode_blocks(ids)) == ids).all()


def test_pieces_equal_whole_texts():
    from tokenizers import Tokenizer

    path = tokens.default_tokenizer()
    whole, own = Tokenizer.from_file(path), tokens.Encoder(path)
    texts = ["", " ", "  ", " a", "a ", "a  b", "\n", "a\nb", "a\n\nb", "a \n b", "x\ty", "it's I'LL", "naïve ÉLAN", "日本 語", "a b", "\x1c a", "aʼs ǅ", "a" * 3000]
    random.seed(3)
    parts = [" ", "  ", "\n", "\t", "a", "Be", "é", "1", ".", ",", "!", "'s", "'", "$", "日", " ", "_", "ß"]
    texts += ["".join(random.choice(parts) for _ in range(random.randint(1, 14))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_words_with_punctuation_are_not_encoded_again():
    own = tokens.Encoder(tokens.default_tokenizer())
    words = ["alpha", "beta", "élan"]
    text = " ".join(w + m for m in ("", ",", ".", "!?", ")") for w in words)
    calls, real = [], own.modelled
    own.modelled = lambda letters: calls.append(letters) or real(letters)
    assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(calls) == 3 + 1 + 4  # words behind a space, the first word, marks
    assert set(own.tail) == set(words) and own.encode(text) and len(calls) == 8


def _ids_of_rows(own, texts):
    out = []
    for _, _, raw, offsets in text_slices(pa.array(texts, pa.string()), 1 << 12):
        lengths, coded = own.encode_rows(raw, offsets, 2)
        ids, ends = np.concatenate(list(coded)), np.cumsum(lengths)
        out += [ids[a:b].tolist() for a, b in zip(ends - lengths, ends)]
    return out


def test_rows_equal_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "TOGETHER", 7)  # pieces of one text in several parts
    path = tokens.default_tokenizer()
    whole, own = Tokenizer.from_file(path), tokens.Encoder(path)
    texts = ["", " ", "\n", "word, ", "word,", ",", "x, y", "it's,", "dogs' s", ".", ".a", "a.", "a \u3000", "\u3000 a", "\u0085", "é,", "日本。 語", "", ""]
    random.seed(11)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "Be", "ing", "é", "ß", "日", "1", ".", ",", "!", "'s", "'", "_", "’", "\u00a0", "\u2009", "\u3000", "\x1d", "\U0001F600"]
    texts += ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(4000)]
    for t, ids in zip(texts, _ids_of_rows(own, texts), strict=True):
        assert ids == [*whole.encode(t, add_special_tokens=False).ids, 2], repr(t)
    assert _ids_of_rows(own, [None, "", None]) == [[2]] * 3


def test_pieces_of_many_rows_are_looked_up_once(tmp_path):
    """A word that rows repeat costs one look-up a slice, punctuation behind it or not."""
    met = []

    class Met(tokens.Pieces):
        def __getitem__(self, piece):
            met.append(piece)
            return super().__getitem__(piece)

        def get(self, piece, default=None):
            met.append(piece)
            return super().get(piece, default)

    path = tokens.default_tokenizer()
    own = tokens.encoder(path)
    before = own.head, own.tail, own.pieces
    own.head, own.tail, own.pieces = Met(own.encode_head), Met(own.encode_tail), Met(own.encode_piece)
    try:
        rows = pa.RecordBatch.from_arrays([pa.array([0] * 500, pa.int32()), pa.array(range(500)), pa.array(["alpha beta, gamma. beta! " * 9] * 500)], names=["part", "id", "text"])
        got = list(tokens._writing(str(tmp_path), path, 2)([rows]))
    finally:
        own.head, own.tail, own.pieces = before
    assert got[0].column(2).to_pylist() == [500 * (1 + len(own.tokenizer.encode("alpha beta, gamma. beta! " * 9, add_special_tokens=False).ids))]
    assert len(met) <= 40, len(met)


def test_new_words_of_a_slice_go_to_the_model_at_once():
    """Words not met before cost one call of the model each, not a look-up and a turn of the encoder each."""
    own, met = tokens.Encoder(tokens.default_tokenizer()), []
    own.encode_piece = own.pieces.make = lambda piece, real=own.encode_piece: met.append(piece) or real(piece)
    random.seed(5)
    words = list(dict.fromkeys("".join(random.choices("abcdefghijklmÄößéɏ", k=9)) for _ in range(2000)))
    text = " ".join(words) + " 5. ×÷ É,"
    assert _ids_of_rows(own, [text]) == [[*own.tokenizer.encode(text, add_special_tokens=False).ids, 2]]
    assert len(met) <= 10, len(met)


def test_known_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_KNOWN", 30)
    own = tokens.Encoder(tokens.default_tokenizer())
    random.seed(6)
    words = ["".join(random.choices("abcÉ1.", k=4)) for _ in range(200)]
    for i in range(60):
        text = " ".join(["often", *random.choices(words, k=15), "x" * 100, "y" * 70 + "!"])
        assert _ids_of_rows(own, [text]) == [[*own.tokenizer.encode(text, add_special_tokens=False).ids, 2]], text
        held = own.known.pieces.to_pylist()
        assert len(held) == len(set(held)) == len(own.known.size) <= 30 and own.known.size.sum() == len(own.known.ids)
        assert i < 3 or b" often" in held or text.startswith("often")
    assert max(map(len, held)) <= tokens.LONGEST_PIECE


def test_added_tokens_in_rows():
    """A special token spelled out in a text is one token, as the library reads it; not across two texts."""
    own = tokens.Encoder(tokens.default_tokenizer())
    end = "<|endoftext|>"
    texts = [end, f"a{end}", f"a{end}. b", f"x {end} y", f"x\n{end}\n{end}{end}", f"word,{end}, {end[:-1]}", end[:5], end[5:], f"é{end}|>", f"{end} {end}\n"]
    random.seed(7)
    parts = [end, end[:-2], "|>", "<|", " ", "\n", "  ", "a", "Wörd", ".", ","]
    texts += ["".join(random.choices(parts, k=random.randint(1, 8))) for _ in range(2000)]
    for t, ids in zip(texts, _ids_of_rows(own, texts), strict=True):
        assert ids == [*own.tokenizer.encode(t, add_special_tokens=False).ids, 2], repr(t)


def test_token_files(spark, duck, docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.default_tokenizer())
    got, at = {r.doc_id: r for r in tokens.op7_token_output(spark, SF).collect()}, 0
    for doc, text in duck.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY 1").fetchall():
        ids = whole.encode(text, add_special_tokens=False).ids + [2]
        r = got[doc]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    rows = sorted(tokens.token_output(docs, tokens.default_tokenizer(), files=3).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 5, 6]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert tokens.token_output(docs.limit(0), tokens.default_tokenizer()).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.keep(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= seen
        if name != "mixing":
            assert len(ids) == out.count()
        docs, seen = out, ids
    want = docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == want
