"""Token-ID output in patched frame-of-reference files (operator 7).

Documents are cut into ranges of ascending id by sampled splitters, one task
encodes each range and writes one file, and the files are read back.

A file holds blocks of ``BLOCK`` ids.  A block stores its minimum, the
differences packed at the width that fits the ``PERCENTILE`` smallest of them,
and the outliers as a list of positions and values.  Behind the blocks come
the start of every block and an Arrow index of the documents.  Files are
written under a name of their own and moved in place when complete, so a
repeated or speculative task leaves one whole file.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import sys
import types
import uuid
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import fresh_path, load, partitions, range_of, text_or_empty, text_slices

BLOCK, PERCENTILE = 1024, 90
MAGIC = b"PFORIDS1"
END_ID = 2
#: Pieces of text that one generation of a worker's memory holds at most, and
#: the longest one it keeps (some 200 bytes each).
MOST_PIECES, LONGEST_PIECE = 150_000, 64
#: Pieces that a worker knows, as columns, between two slices (some 50 bytes each),
#: and the slices that a piece stays longer for each slice that it was in (up to 8).
MOST_KNOWN, STAY = 200_000, 4
#: Bytes of text whose pieces are told apart at once, and pieces put together at once.
SLICE, TOGETHER = 1 << 22, 1 << 17


# --- text to ids --------------------------------------------------------------

#: White space beside white space: such texts are cut with more care.
ODD = re.compile(r"\s\s")
PLAIN_GAP = re.compile(r"(?<=\S) (?=\S)")
#: Letters of the oldest Unicode blocks and ASCII punctuation: the pre-tokenizer
#: always cuts between a run of the one and a run of the other, nowhere else.
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+")
MARKS = string.punctuation


_BYTES = np.arange(256)
_BLANK = np.isin(_BYTES, [*range(0x09, 0x0E), *range(0x1C, 0x21)])
_MARK = np.isin(_BYTES, list(MARKS.encode()))
_LETTER = np.isin(_BYTES, list(string.ascii_letters.encode()))
#: White space beyond ASCII, as UTF-8.
WIDE_BLANKS = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def piece_starts(raw: np.ndarray, offsets: np.ndarray, added: tuple[bytes, ...] = ()) -> np.ndarray:
    """Where the pieces of the texts begin, as byte offsets: at each text, each
    single space and each side of a single line break that have no white space
    beside them, and at punctuation between an ASCII letter and a piece's end,
    but not inside one of the tokens ``added`` to the model."""
    blank = _BLANK[raw]
    for lead in {w[0] for w in WIDE_BLANKS}:
        at = np.flatnonzero(raw == lead)
        for wide in (w for w in WIDE_BLANKS if w[0] == lead) if len(at) else ():
            hit = at[at + len(wide) <= len(raw)]
            for i, byte in enumerate(wide[1:], 1):
                hit = hit[raw[hit + i] == byte]
            for i in range(len(wide)):
                blank[hit + i] = True
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    gap = np.flatnonzero((raw == 0x20) | (raw == 0x0A))
    before = blank[np.maximum(gap - 1, 0)] & ~first[gap]
    behind = blank[np.minimum(gap + 1, len(raw) - 1)] & ~first[gap + 1]
    gap = gap[~before & ~behind]
    first[gap] = True
    first[gap[raw[gap] == 0x0A] + 1] = True
    starts = np.flatnonzero(first)
    turn = np.flatnonzero(np.diff(_MARK[raw], prepend=False, append=False))
    low, high = turn[0::2], turn[1::2]
    inside = ~first[low] & _LETTER[raw[np.maximum(low - 1, 0)]]
    low, high = low[inside], high[inside]
    first[low[starts[np.searchsorted(starts, low, side="right")] <= high]] = True
    first[len(raw)] = False
    starts = np.flatnonzero(first)
    for token in added:
        at = np.array([m.start() for m in re.finditer(re.escape(token), raw)] if token in raw.tobytes() else [], np.int64)
        at = at[np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, at + len(token) - 1, side="right")]
        if len(at):
            last = at[np.maximum(np.searchsorted(at, starts) - 1, 0)]
            starts = starts[(starts <= last) | (starts >= last + len(token))]
    return starts


def plain_bytes(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to ``LETTERS``."""
    out = _LETTER[raw]
    lead = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC9))
    code = ((raw[lead].astype(np.int32) & 0x1F) << 6) | (raw[np.minimum(lead + 1, len(raw) - 1)] & 0x3F)
    lead = lead[(code <= 0x24F) & (code != 0xD7) & (code != 0xF7)]
    out[lead] = out[lead + 1] = True
    return out


def plain(word: str) -> bool:
    return word.isalpha() if word.isascii() else LETTERS.fullmatch(word) is not None


class Pieces(dict):
    """Ids (uint32 bytes) of text pieces, encoded when first met.

    A plain word with punctuation behind it is put together from the two, so
    only the word is kept.  Two generations: a full one becomes the old one,
    and what is used again comes back from there, so frequent pieces stay and
    memory is bounded."""

    def __init__(self, make, marks: Pieces | None = None):
        self.make, self.marks, self.old = make, marks, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            if self.marks is not None:
                word = piece.rstrip(MARKS)
                if len(word) < len(piece) and plain(word):
                    return self[word] + self.marks[piece[len(word) :]]
            found = self.make(piece)
        if len(piece) <= LONGEST_PIECE:
            if len(self) >= MOST_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


class Known:
    """Ids of pieces as columns, for many pieces at once: the pieces, all their
    ids, the number of each one's, the turn that last used it and how many did.
    What was used long ago and seldom goes first, so memory is bounded."""

    def __init__(self, make):
        import pyarrow as pa

        self.make, self.turn, self.pieces = make, 0, pa.array([], pa.large_binary())
        self.ids, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.used, self.often = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def look_up(self, pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of the distinct ``pieces`` where its ids begin and how many they are."""
        import pyarrow as pa
        import pyarrow.compute as pc

        self.turn += 1
        at = pc.fill_null(pc.index_in(pieces, value_set=self.pieces.cast(pieces.type)), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            order, ids, size = self.make(pieces.take(pa.array(new)))
            at[new[order]] = len(self.pieces) + np.arange(len(new))
            self.pieces = pa.concat_arrays([self.pieces, pieces.take(pa.array(new[order])).cast(self.pieces.type)])
            self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
            self.used, self.often = (np.concatenate([a, np.zeros(len(new), np.int32)]) for a in (self.used, self.often))
        self.used[at] = self.turn
        self.often[at] += 1
        found = self.ids, (np.cumsum(self.size) - self.size)[at], self.size[at]
        if len(new):
            self._forget()
        return found

    def _forget(self) -> None:
        """Drop long pieces, and a third when there are too many."""
        import pyarrow as pa
        import pyarrow.compute as pc

        keep = pc.binary_length(self.pieces).to_numpy() <= LONGEST_PIECE
        if len(keep) > MOST_KNOWN:
            until = self.used + STAY * np.minimum(self.often, 8)
            keep[np.argsort(until, kind="stable")[: len(keep) - MOST_KNOWN * 2 // 3]] = False
        if not keep.all():
            self.pieces = self.pieces.filter(pa.array(keep))
            self.ids = self.ids[np.repeat(keep, self.size)]
            self.size, self.used, self.often = self.size[keep], self.used[keep], self.often[keep]


class Encoder:
    """A byte-level BPE tokenizer, with a bounded memory of pieces.

    The pre-tokenizer of a byte-level BPE always cuts before a single space
    between two other characters and around a single line break, so texts are
    cut there and each piece is encoded once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(printable)]
        self.letters = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}
        self.space = chr(self.letters[0x20])
        marks = Pieces(self.spelled)
        self.head, self.tail = Pieces(self.encode_head, marks), Pieces(self.encode_tail, marks)
        self.pieces = Pieces(self.encode_piece)
        self.known = Known(self.encode_new)
        self.added = tuple(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.spelling = np.array([self.letters[b] for b in range(256)], "<u2")

    def encode_head(self, piece: str) -> bytes:
        return self.spelled(piece) if plain(piece) else self.whole(piece)

    def encode_tail(self, piece: str) -> bytes:
        """The piece behind a single space."""
        if piece.isalpha() and piece.isascii():
            return self.modelled(self.space + piece)
        return self.spelled(" " + piece) if plain(piece) else self.whole(" " + piece)

    def encode_piece(self, raw: bytes) -> bytes:
        piece = raw.decode()
        if raw[:1] == b" " and raw[1:].isalpha():
            return self.modelled(self.space + piece[1:])
        return self.encode_tail(piece[1:]) if piece[0] == " " else self.encode_head(piece)

    def whole(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def spelled(self, word: str) -> bytes:
        """A word that is not cut goes straight to the model, its bytes as the model's letters."""
        return self.modelled(word.encode().decode("latin-1").translate(self.letters))

    def modelled(self, letters: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        head, tail = self.head, self.tail
        if ODD.search(text):
            first, *more = PLAIN_GAP.split(text)
            return b"".join([head[first], *map(tail.__getitem__, more)])
        out = []
        for i, line in enumerate(text.split("\n")):
            first, *more = line.split(" ")
            if i:
                out.append(head["\n"])
            if first:
                out.append(head[first])
            out.extend(map(tail.__getitem__, more))
        return b"".join(out)

    def encode_new(self, pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the ``pieces`` (Arrow), and in it their ids, one behind
        the other, and the number of each one's ids.  Words, with or without a
        space in front, are spelled all at once and go straight to the model."""
        import pyarrow as pa

        _, edges, data = pieces.cast(pa.large_binary()).buffers()
        edges, raw = np.frombuffer(edges, np.int64, len(pieces) + 1), np.frombuffer(data, np.uint8)
        other = np.concatenate(([0], np.cumsum(~plain_bytes(raw))))[edges]
        words = np.diff(other) == (raw[edges[:-1]] == 0x20)
        spelled, tokenize = self.spelling[raw].tobytes().decode("utf-16-le"), self.model.tokenize
        ids, size = array("I"), []
        for low, high in zip(edges[:-1][words].tolist(), edges[1:][words].tolist()):
            found = [t.id for t in tokenize(spelled[low:high])]
            ids.extend(found)
            size.append(len(found))
        rest = [self.pieces[p] for p in pieces.filter(pa.array(~words)).to_pylist()]
        size += [len(r) // 4 for r in rest]
        order = np.argsort(~words, kind="stable")
        return order, np.concatenate([np.frombuffer(ids, "<u4"), np.frombuffer(b"".join(rest), "<u4")]), np.array(size, np.int64)

    def encode_rows(self, raw: np.ndarray, offsets: np.ndarray, end_id: int):
        """Ids of many texts, each closed by ``end_id``: the number of ids of
        each text, and an iterator over all ids.  Equal pieces are found by
        Arrow, and each is looked up once."""
        import pyarrow as pa

        starts = piece_starts(raw, offsets, self.added)
        edges = np.append(starts, len(raw)).astype(np.int32 if len(raw) < 1 << 31 else np.int64)
        kind = pa.binary() if edges.dtype == np.int32 else pa.large_binary()
        pieces = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        table, place, size = self.known.look_up(pieces.dictionary)
        table, place, size = np.append(table, np.uint32(end_id)), np.append(place, len(table)), np.append(size, 1)
        # The end id is one more piece behind each text's.
        ends = np.searchsorted(starts, offsets[1:])
        code = np.insert(pieces.indices.to_numpy(), ends, len(size) - 1)
        sums = np.concatenate(([0], np.cumsum(size[code])))
        text_sums = sums[ends + np.arange(1, len(ends) + 1)]

        def ids():
            for low in range(0, len(code), TOGETHER):
                part = code[low : low + TOGETHER]
                n, to = size[part], sums[low + 1 : low + 1 + len(part)] - sums[low]
                yield table[np.repeat(place[part] - to + n, n) + np.arange(to[-1])]

        return np.diff(text_sums, prepend=0), ids()


def encoder(path: str) -> Encoder:
    """The worker's encoder; Python workers are reused between tasks."""
    state = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state"))
    if getattr(state, "encoder_path", None) != path:
        state.encoder, state.encoder_path = Encoder(path), path
    return state.encoder


# --- ids to blocks ------------------------------------------------------------

def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of 64-bit words."""
    rows = len(values)
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T.astype(np.uint64))
    out = np.zeros((max(width, 1), lanes.shape[1]), np.uint64)
    for i in range(64 if width else 0):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out[:width].T).reshape(rows, -1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``pack``."""
    rows = len(words)
    out = np.zeros((64, rows * BLOCK // 64), np.uint64)
    if width:
        lanes = np.ascontiguousarray(words.reshape(-1, width).T)
        mask = np.uint64((1 << width) - 1)
        for i in range(64):
            word, shift = divmod(i * width, 64)
            value = lanes[word] >> np.uint64(shift)
            if shift + width > 64:
                value = value | (lanes[word + 1] << np.uint64(64 - shift))
            out[i] = value & mask
    return np.ascontiguousarray(out.T).reshape(rows, BLOCK)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of ``ids`` (uint32, a multiple of BLOCK of them)."""
    rows = ids.reshape(-1, BLOCK)
    base = rows.min(axis=1)
    delta = rows - base[:, None]
    rank = BLOCK * PERCENTILE // 100 - 1
    high = np.partition(delta, rank, axis=1)[:, rank]
    width = np.ceil(np.log2(high.astype(np.float64) + 1)).astype(np.int64)
    fits = (delta.astype(np.uint64) >> width[:, None].astype(np.uint64)) == 0
    packed: dict[int, bytes] = {}
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        low = delta[at] & np.uint32((1 << int(w)) - 1)
        for i, words in zip(at.tolist(), pack(low, int(w))):
            packed[i] = words.astype("<u8").tobytes()
    out = []
    for i in range(len(rows)):
        odd = np.flatnonzero(~fits[i])
        out.append(
            struct.pack("<IHH", int(base[i]), int(width[i]), len(odd)) + packed[i]
            + odd.astype("<u2").tobytes() + delta[i][odd].astype("<u4").tobytes()
        )
    return out


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    """The ids of whole blocks."""
    heads = [struct.unpack_from("<IHH", b) for b in blocks]
    out = np.zeros((len(blocks), BLOCK), np.uint32)
    width = np.array([h[1] for h in heads])
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        words = np.stack([np.frombuffer(blocks[i], "<u8", BLOCK * int(w) // 64, 8) for i in at])
        out[at] = unpack(words, int(w)).astype(np.uint32)
    for i, (base, w, odd) in enumerate(heads):
        at = 8 + BLOCK * w // 8
        if odd:
            out[i, np.frombuffer(blocks[i], "<u2", odd, at)] = np.frombuffer(blocks[i], "<u4", odd, at + 2 * odd)
        out[i] += np.uint32(base)
    return out.reshape(-1)


# --- files --------------------------------------------------------------------

def _filesystem(path: str):
    """File system and path of the shared folder, by its scheme."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith(("file:", "/")) else os.path.abspath(path))


class Writer:
    """Streams ids into one file; holds less than two groups of blocks."""

    GROUP = 256 * BLOCK

    def __init__(self, path: str):
        self.fs, self.path = _filesystem(path)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.part)
        self.out.write(MAGIC)
        self.at, self.ids, self.starts = len(MAGIC), 0, []
        self.pending: list[np.ndarray] = []
        self.waiting = 0

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        if self.waiting >= self.GROUP:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.pending)
        for low in range(0, count, self.GROUP):
            for block in encode_blocks(ids[low : min(count, low + self.GROUP)]):
                self.starts.append(self.at)
                self.out.write(block)
                self.at += len(block)
        self.pending, self.waiting = [ids[count:]], len(ids) - count

    def close(self, index) -> None:
        """``index``: Arrow batch of the documents (id, first id)."""
        import pyarrow as pa

        if self.waiting:
            tail = np.concatenate(self.pending)
            self.pending = [np.pad(tail, (0, -len(tail) % BLOCK), mode="edge")]
            self._flush(len(self.pending[0]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_batch(index)
        documents = sink.getvalue().to_pybytes()
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(documents)
        self.out.write(struct.pack("<QQQQ", self.ids, len(self.starts), self.at, len(documents)) + MAGIC)
        self.out.close()
        self.fs.move(self.part, self.path)


class Reader:
    """Documents of one file, a few blocks at a time."""

    def __init__(self, path: str):
        import pyarrow as pa

        files, inner = _filesystem(path)
        self.file = files.open_input_file(inner)
        size = self.file.size()
        ids, blocks, at, length = struct.unpack("<QQQQ", self.file.read_at(32, size - 40))
        if self.file.read_at(8, size - 8) != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        self.ids, self.end = ids, at
        self.starts = np.frombuffer(self.file.read_at(8 * blocks, at), "<u8").tolist()
        with pa.ipc.open_stream(self.file.read_at(length, at + 8 * blocks)) as stream:
            self.index = stream.read_all()

    def spans(self, group: int = 256):
        """(first id, ids) in order."""
        edges = [*self.starts, self.end]
        for low in range(0, len(self.starts), group):
            high = min(len(self.starts), low + group)
            raw = self.file.read_at(edges[high] - edges[low], edges[low])
            cut = [raw[edges[i] - edges[low] : edges[i + 1] - edges[low]] for i in range(low, high)]
            ids = decode_blocks(cut)
            yield low * BLOCK, ids[: min(len(ids), self.ids - low * BLOCK)]

    def documents(self):
        """(id, first id in the file, number of ids, crc32) of each document."""
        first = self.index.column("start").to_numpy()
        last = np.append(first[1:], self.ids)
        crcs, doc = [0] * len(first), 0
        for at, ids in self.spans():
            raw = np.ascontiguousarray(ids, "<u4")
            while doc < len(first):
                low, high = max(first[doc] - at, 0), min(last[doc] - at, len(raw))
                if high > low:
                    crcs[doc] = zlib.crc32(raw[low:high], crcs[doc])
                if last[doc] > at + len(raw):
                    break
                doc += 1
        return self.index.column("id"), first, last - first, np.array(crcs, np.int64)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
    files: int | None = None, sample_per_file: int = 20,
) -> list[tuple[str, int]]:
    """Write the ids of all texts, each closed by ``end_id``, in ascending
    order of the id (null ids first) into ``folder``; (path, ids before it) of
    each file, in order.

    A null text is the empty one.  Rows that share an id follow each other.
    An empty table writes no file.  ``files`` (default: the shuffle
    partitions) bounds what the driver holds: a few numbers per file.
    """
    spark = docs.sparkSession
    files = files or partitions(spark)
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.monotonically_increasing_id()).alias("tie"))
    keys = docs.select(key.alias("key"))
    total, want = docs.count(), files * sample_per_file
    sample = keys if total <= want else keys.sample(False, want / total, seed=7)
    got = [r["key"] for r in sample.orderBy("key").collect()]
    picks = list(dict.fromkeys(got[len(got) * i // files] for i in range(1, files))) if got else []
    rows = docs.select(key.alias("key"), text_or_empty(text_col).alias("text"))
    cuts = F.from_json(F.lit(json.dumps([r.asDict() for r in picks])), T.ArrayType(rows.schema["key"].dataType))
    part = range_of(F.col("key"), cuts, len(picks)).cast("int") if picks else F.lit(0)
    rows = rows.withColumn("part", part).repartitionById(len(picks) + 1, F.col("part"))
    rows = rows.sortWithinPartitions("key").select("part", F.col("key.id").alias("id"), "text")
    found = rows.mapInArrow(_writing(folder, tokenizer, end_id), "part int, path string, ids bigint").collect()
    out, before = [], 0
    for r in sorted(found, key=lambda r: r["part"]):
        out.append((r["path"], before))
        before += r["ids"]
    return out


def _writing(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        import pyarrow as pa

        writer, part, ids, starts = None, 0, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                part = batch.column(0)[0].as_py()
                path = f"{folder}/ids-{part:06d}.pfor"
                writer, encode = Writer(path), encoder(tokenizer).encode_rows
            ids.append(batch.column(1))
            for _, _, raw, offsets in text_slices(batch.column(2), SLICE):
                lengths, coded = encode(raw, offsets, end_id)
                starts.append(writer.ids + np.cumsum(lengths) - lengths)
                for some in coded:
                    writer.add(some)
        if writer is not None:
            index = pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array(np.concatenate(starts))], names=["id", "start"])
            writer.close(index)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([path]), pa.array([writer.ids], pa.int64())], names=["part", "path", "ids"]
            )

    return run


def read_tokens(spark: SparkSession, files: list[tuple[str, int]], id_type: T.DataType, id_col: str = "doc_id") -> DataFrame:
    """One row per document from the files: id, start, n_tokens, ids_crc32."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, first, count, crc = Reader(path).documents()
                yield pa.RecordBatch.from_arrays(
                    [ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids, pa.array(first + before), pa.array(count), pa.array(crc)],
                    names=[id_col, "start", "n_tokens", "ids_crc32"],
                )

    listed = spark.createDataFrame(files, "path string, before bigint").repartition(max(1, len(files)))
    schema = T.StructType(
        [T.StructField(id_col, id_type), *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32"))]
    )
    return listed.mapInArrow(run, schema)


def token_output(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", **options) -> DataFrame:
    """Write the files, read them back, and give one row per document."""
    spark = docs.sparkSession
    files = write_tokens(docs, folder or fresh_path(spark, "token-ids"), tokenizer, id_col=id_col, **options)
    return read_tokens(spark, files, docs.schema[id_col].dataType, id_col)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(load(spark, sf_dir, "documents"), default_tokenizer())
