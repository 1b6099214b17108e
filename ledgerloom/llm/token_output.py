"""Token-ID output as static range asymmetric numeral systems (rANS) in independent blocks.

One pass tokenises the texts where they lie and counts ids; the counts, at most one per id
of the vocabulary, become one frequency table shared by all blocks. Token rows are then
ordered by doc_id over range partitions and encoded in blocks of a fixed number of tokens.
A block interleaves ``LANES`` coders, so that NumPy steps all of them at once; it holds a
checksum, its documents, and checkpoints (coder states and stream offset) from which its
steps may be decoded apart. A document may span blocks.

The file set is a folder: ``blocks`` (Parquet rows, one for each block, written by Spark so
that any store it knows will do) and ``table`` (id, frequency). Blocks are decoded in
parallel; a document's pieces carry their CRC-32, and CRCs of pieces combine by length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import Scratch, raw_texts, table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SCALE_BITS = 20
LANES = 4096
#: Ids of a written file, on average, beyond which there are more files.
PART_IDS = 1 << 26
BLOCK_TOKENS = 1 << 20
#: Coder steps between checkpoints.
CHECKPOINT_STEPS = 64
CACHE_WORDS = 1_200_000
LOW = np.uint64(1 << 31)


# ---------------------------------------------------------------- tokenising


#: The runs into which the pre-tokenizer splits a word of Latin letters, digits and signs but the apostrophe.
_RUNS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


class WordIds:
    """Ids of texts as little-endian 16-bit bytes, exact for this tokenizer.

    Its pre-tokenizer never joins characters across white space and drops white space, and
    its normalizer lower-cases, so a text's ids are those of its words between ASCII white
    space, in order. Words of a batch of texts are told apart by 128-bit hashes, and the ids
    of known words lie in arrays sorted by hash; only new words are looked at one by one.

    A new word of Latin letters, digits and signs is lower-cased and split as the
    pre-tokenizer would; its new runs are encoded many at once by the same model, and told
    apart by the end-of-word mark of their last token. Any other word goes through the whole
    tokenizer alone. What is known is forgotten when it is too much.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers import pre_tokenizers as pre
        from tokenizers.models import BPE

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end = model["end_of_word_suffix"]
        self.model = Tokenizer(BPE(vocab=model["vocab"], merges=[tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]], cache_capacity=0, end_of_word_suffix=end))
        self.model.pre_tokenizer = pre.Sequence([pre.WhitespaceSplit(), pre.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for token, i in model["vocab"].items() if token.endswith(end)]] = True
        self.runs: dict[str, bytes] = {}
        self.forget()

    def forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.offsets, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, "<u2"), 0

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(got.ids, "<u2").tobytes() for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_words(self, wanted: list[bytes]) -> list[bytes]:
        plain, other = [], []
        for no, word in enumerate(wanted):
            text = word.decode().lower()
            held = _RUNS.findall(text)
            if sum(map(len, held)) == len(text) and "<|" not in text:
                plain.append((no, held))
            else:
                other.append(no)
        if len(self.runs) > CACHE_WORDS:
            self.runs.clear()
        new = list({r for _, held in plain for r in held if r not in self.runs})
        for start in range(0, len(new), 10_000):
            part = new[start : start + 10_000]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u2")
            ends = (2 * np.flatnonzero(self.ends[ids]) + 2).tolist()
            alike = len(ends) == len(part)
            self.runs.update(zip(part, map(ids.tobytes().__getitem__, map(slice, [0, *ends[:-1]], ends)) if alike else self._alone(part)))
        out = [b""] * len(wanted)
        for no, held in plain:
            out[no] = self.runs[held[0]] if len(held) == 1 else b"".join([self.runs[r] for r in held])
        for no, got in zip(other, self._alone([wanted[no].decode() for no in other])):
            out[no] = got
        return out

    def _plainly(self, text: bytes) -> bytes:
        # Special tokens are told apart by case before normalisation; only such texts keep theirs.
        pieces = (text if b"<|" in text else text.lower()).split()
        different = list(set(pieces))
        known = dict(zip(different, self.of_words(different)))
        return b"".join(map(known.__getitem__, pieces))

    def _learn(self, data: bytes, keys: np.ndarray, checks: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> None:
        got = self.of_words([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
        ids = np.frombuffer(b"".join(got), "<u2")
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 2
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.keys, self.checks = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks)
        self.offsets, self.sizes = np.insert(self.offsets, at, self.used + np.cumsum(sizes) - sizes), np.insert(self.sizes, at, sizes)
        self.used += len(ids)

    def _together(self, group: list[bytes]) -> list[bytes] | None:
        """Ids of folded texts, with one look at each different word. None if two words share a hash."""
        data = b" ".join(group)
        starts, ends = words.places(data)
        if not len(starts):
            return [b""] * len(group)
        keys, first, of = np.unique(words.hashes(data, starts, ends), return_index=True, return_inverse=True)
        every = words.hashes(data, starts, ends, 1)
        checks = every[first]
        if (every != checks[of]).any():
            return None
        if len(self.keys) + len(keys) > CACHE_WORDS:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if new.any():
            self._learn(data, keys[new], checks[new], starts[first[new]], ends[first[new]], at[new])
            at = np.searchsorted(self.keys, keys)
        if (self.checks[at] != checks).any():
            return None
        sizes = self.sizes[at][of]
        begins = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.offsets[at][of] - begins[:-1], sizes) + np.arange(begins[-1])]
        bounds = begins[np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in group)]))].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]

    def of(self, texts: list[bytes | None]) -> list[bytes]:
        out: list[bytes] = []
        for group in words.groups([t or b"" for t in texts]):
            alike = len(group[0]) < words.PART_BYTES and not any(b"<|" in t for t in group)
            got = self._together([t.translate(words.FOLD) for t in group]) if alike else None
            out += got if got is not None else map(self._plainly, group)
        return out


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


TOKENS = "kind int, doc_id long, ids binary, id int, n long"


def tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """kind 0: (doc_id, ids) of each document, end id included. kind 1: (id, n) counts of a task's ids."""

    def run(batches):
        known, end = word_ids(path), np.array([end_id], "<u2").tobytes()
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                ids = [x + end for x in known.of(raw_texts(part.column(1)))]
                for at in range(0, len(ids), 200):
                    counts += np.bincount(np.frombuffer(b"".join(ids[at : at + 200]), "<u2"), minlength=1 << 16)
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), part.column(0), pa.array(ids, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names=["kind", "doc_id", "ids", "id", "n"])
        seen = np.flatnonzero(counts)
        n = len(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["kind", "doc_id", "ids", "id", "n"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, TOKENS)


# ---------------------------------------------------------------- the coder


def frequencies(counts: dict[int, int], bits: int = SCALE_BITS) -> dict[int, int]:
    """Counts scaled to sum to ``2 ** bits``, at least 1 for each id that occurs."""
    if not counts:
        return {}
    ids = sorted(counts)
    n = np.array([counts[i] for i in ids], np.float64)
    room = (1 << bits) - len(ids)
    if room < 0:
        raise ValueError("the vocabulary is larger than the frequency scale")
    exact = n / n.sum() * room
    freq = np.floor(exact).astype(np.int64)
    left = room - int(freq.sum())
    order = np.argsort(-(exact - freq), kind="stable")
    freq[order[:left]] += 1
    return dict(zip(ids, (freq + 1).tolist()))


class Coder:
    def __init__(self, freq: dict[int, int], bits: int = SCALE_BITS):
        self.bits = np.uint64(bits)
        ids = np.array(sorted(freq), np.int64)
        self.freq = np.zeros(1 << 16, np.uint64)
        self.freq[ids] = [freq[i] for i in ids.tolist()]
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(ids.astype(np.uint16), self.freq[ids].astype(np.int64))
        self.mask = np.uint64((1 << bits) - 1)

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> dict:
        """Step s codes ids[s * lanes : (s + 1) * lanes]; steps are coded backwards."""
        n = len(ids)
        steps = -(-n // lanes)
        x = np.full(lanes, LOW, np.uint64)
        words: list[np.ndarray] = []
        written = 0
        marks: list[tuple[int, int, bytes]] = []
        limit = np.uint64(63 - int(self.bits))
        for step in range(steps - 1, -1, -1):
            sym = ids[step * lanes : (step + 1) * lanes]
            k = len(sym)
            f, c, y = self.freq[sym], self.start[sym], x[:k]
            full = y >= f << limit
            out = y[full]
            if len(out):
                words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4"))
                written += len(out)
                y = np.where(full, y >> np.uint64(32), y)
            q, r = np.divmod(y, f)
            x[:k] = (q << self.bits) + r + c
            if step and step % every == 0:
                marks.append((step, written, x.astype("<u8").tobytes()))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        return {"states": x.astype("<u8").tobytes(), "stream": stream.tobytes(), "marks": [(s, len(stream) - w, b) for s, w, b in reversed(marks)]}

    def decode(self, n: int, states: bytes, stream: bytes, lanes: int = LANES, first: int = 0, last: int | None = None, at: int = 0) -> np.ndarray:
        """Ids of steps first to last; ``states`` and ``at`` (a stream offset) are those at ``first``."""
        x = np.frombuffer(states, "<u8").astype(np.uint64)
        words = np.frombuffer(stream, "<u4")
        steps = -(-n // lanes)
        last = steps if last is None else min(last, steps)
        out = np.empty(max(0, min(n, last * lanes) - first * lanes), np.uint16)
        low = np.uint64(32)
        for step in range(first, last):
            k = min(lanes, n - step * lanes)
            y = x[:k]
            slot = y & self.mask
            sym = self.symbol[slot]
            out[(step - first) * lanes : (step - first) * lanes + k] = sym
            y = self.freq[sym] * (y >> self.bits) + slot - self.start[sym]
            need = np.flatnonzero(y < LOW)
            if len(need):
                y[need] = y[need] << low | words[at : at + len(need)]
                at += len(need)
            x[:k] = y
        return out


_CODERS: dict[int, Coder] = {}


def _coder(freq: Broadcast) -> Coder:
    key = zlib.crc32(repr(sorted(freq.value.items())).encode())
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(freq.value)
    return _CODERS[key]


# ---------------------------------------------------------------- blocks

#: ``before``: tokens of the part in earlier blocks. ``docs``: for each document in the block its number in the
#: part, doc_id, tokens in this block, and whether the block holds all of it.
DOCS_DDL = "array<struct<no: long, doc_id: long, n: long, whole: boolean>>"
BLOCKS_DDL = f"part int, block int, n long, before long, crc32 long, states binary, stream binary, marks array<struct<step: int, offset: int, states: binary>>, docs {DOCS_DDL}"
BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("n", pa.int64()),
        ("before", pa.int64()),
        ("crc32", pa.int64()),
        ("states", pa.binary()),
        ("stream", pa.binary()),
        ("marks", pa.list_(pa.struct([("step", pa.int32()), ("offset", pa.int32()), ("states", pa.binary())]))),
        ("docs", pa.list_(pa.struct([("no", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("whole", pa.bool_())]))),
    ]
)


def _filled(rows: Iterator[tuple[int | None, bytes]], size: int) -> Iterator[tuple[list[dict], list[bytes]]]:
    """Documents dealt into blocks of ``size`` tokens, split where a block is full."""
    docs, parts, room = [], [], size
    for no, (doc_id, ids) in enumerate(rows):
        at, total = 0, len(ids) // 2
        while at < total:
            take = min(room, total - at)
            docs.append({"no": no, "doc_id": doc_id, "n": take, "whole": take == total})
            parts.append(ids[2 * at : 2 * (at + take)])
            at, room = at + take, room - take
            if not room:
                yield docs, parts
                docs, parts, room = [], [], size
    if docs:
        yield docs, parts


def encoded(tokens: DataFrame, freq: Broadcast, block_tokens: int) -> DataFrame:
    def run(batches):
        part, coder, before = TaskContext.get().partitionId(), _coder(freq), 0
        rows = (x for batch in batches for start in range(0, batch.num_rows, 1000) for x in zip(batch.column(0).slice(start, 1000).to_pylist(), batch.column(1).slice(start, 1000).to_pylist()))
        for block, (docs, parts) in enumerate(_filled(rows, block_tokens)):
            data = b"".join(parts)
            ids = np.frombuffer(data, "<u2")
            got = coder.encode(ids)
            row = {"part": part, "block": block, "n": len(ids), "before": before, "crc32": zlib.crc32(data), "states": got["states"], "stream": got["stream"], "marks": [{"step": s, "offset": o, "states": b} for s, o, b in got["marks"]], "docs": docs}
            before += len(ids)
            yield pa.RecordBatch.from_pylist([row], BLOCKS)

    return tokens.mapInArrow(run, BLOCKS_DDL)


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, partitions: int | None = None) -> None:
    """Writes the ids of ``docs`` (doc_id, text) in ascending doc_id order to the folder ``path``.

    A null text has the end id alone. A null doc_id comes first. Rows with a repeated doc_id
    follow one another in the order of their ids. Other columns are ignored; an empty table
    gives an empty file set.
    """
    scratch = Scratch(spark, "token-output")
    found = scratch.cut(tokenised(docs, tokenizer_path or public_tokenizers.path(TOKENIZER), end_id), "tokens")
    counts = found.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n"))  # at most one row for each id of the vocabulary
    counted = {r.id: r.n for r in counts.collect()}
    freq = frequencies(counted)
    spark.createDataFrame([(i, f) for i, f in sorted(freq.items())], "id int, freq long").coalesce(1).write.mode("overwrite").parquet(f"{path}/table")
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counted.values()) // PART_IDS + 1)
    ordered = found.filter("kind = 0").select("doc_id", "ids").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    encoded(ordered, spark.sparkContext.broadcast(freq), block_tokens).write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")
    scratch.drop(found)


# ---------------------------------------------------------------- reading back


def crc32_combine(left: int, right: int, length: int) -> int:
    """CRC-32 of two joined pieces from theirs and the right one's length in bytes."""
    return _crc_times(_crc_shift(length), left) ^ right


def _crc_times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, both with reflected bits."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def _crc_shift(length: int) -> int:
    """x to the power of 8 * length."""
    out, square, n = 1 << 31, 1 << 30, 8 * length
    while n:
        if n & 1:
            out = _crc_times(square, out)
        square = _crc_times(square, square)
        n >>= 1
    return out


PIECES_DDL = "part int, no long, doc_id long, at long, n long, whole boolean, crc long"


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Each document's tokens in each block, decoded and checked: their number, offset in the part and CRC-32 as 32-bit integers, and the ids on request."""
    rows = spark.read.schema("id int, freq long").parquet(f"{path}/table").collect()  # bounded by the vocabulary
    freq = spark.sparkContext.broadcast({r.id: r.freq for r in rows})

    def run(batches):
        coder = _coder(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                part, n, before, crc, states, stream, docs = (batch.column(c)[i].as_py() for c in ("part", "n", "before", "crc32", "states", "stream", "docs"))
                ids = coder.decode(n, states, stream)
                if zlib.crc32(ids.astype("<u2").tobytes()) != crc:
                    raise ValueError(f"a block of part {part} fails its checksum")
                wide = ids.astype("<u4")
                sizes = np.array([d["n"] for d in docs])
                ends = np.cumsum(sizes)
                parts = [wide[e - k : e] for e, k in zip(ends.tolist(), sizes.tolist())]
                out = {"part": pa.array([part] * len(docs), pa.int32()), "no": pa.array([d["no"] for d in docs], pa.int64()), "doc_id": pa.array([d["doc_id"] for d in docs], pa.int64()), "at": pa.array(ends - sizes + before, pa.int64()), "n": pa.array(sizes, pa.int64()), "whole": pa.array([d["whole"] for d in docs], pa.bool_()), "crc": pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    return spark.read.schema(BLOCKS_DDL).parquet(f"{path}/blocks").drop("marks").mapInArrow(run, PIECES_DDL + ", ids array<int>" * with_ids)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, crcs = [], []
        for pieces in batch.column(3).to_pylist():
            crc = total = 0
            for piece in pieces:
                crc = crc32_combine(crc, piece["crc"], 4 * piece["n"]) if total else piece["crc"]
                total += piece["n"]
            totals.append(total)
            crcs.append(crc)
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(totals, pa.int64()), pa.array(crcs, pa.int64())], names=["part", "doc_id", "at", "n", "crc"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone.

    Only documents that span blocks are grouped; their pieces are small rows. Offsets of
    parts are summed on the driver: one number for each written file.
    """
    sums = spark.read.schema(BLOCKS_DDL).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n").alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(sums):
        offsets.append((row.part, total))
        total += row.n
    parts = spark.createDataFrame(offsets, "part int, part_start long")
    pieces = Scratch(spark, "token-pieces").cut(read_pieces(spark, path), "pieces")
    split = pieces.filter("NOT whole").groupBy("part", "no").agg(F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))
    joined = split.select("part", "doc_id", "at", "pieces").mapInArrow(_joined, "part int, doc_id long, at long, n long, crc long")
    rows = pieces.filter("whole").select("part", "doc_id", "at", "n", "crc").unionByName(joined)
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("at") + F.col("part_start")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "token-files").path("documents")
    write_tokens(spark, table(spark, sf_dir, "documents"), path)
    return read_digests(spark, path)
