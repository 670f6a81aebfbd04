"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

Text is normalised as the model says and cut into marked words: runs of the space mark with
what follows, and signs that no piece holds. No piece crosses such a cut, so words are encoded
on their own. The distinct words of a batch are sorted, which lays them out as a trie in
depth-first order; the walk keeps forward scores and open pieces of the path to the current
word and continues from the prefix it shares with the one before.

A forward score of a unigram model is the best sum of piece scores. A BPE model has no sum to
maximise: its forward state is the last piece, and an arc is admitted if the model's merges
would leave the two pieces apart. That leaves one path per prefix, the model's own
segmentation. Words for which it doesn't are merged directly.

Texts need no shuffle: a task encodes its own batches and keeps a bounded table of words it has
met. The model file is a parameter; its pieces are sent to the tasks (bounded by the model).

Results: NULL text gives NULL ids; empty text gives none. Decoding gives the text back except
where the normalisation changes it (a space mark written in the text reads as a space).
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.llm.shared import named, table

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
KEPT_WORDS, KEPT_PAIRS, LONG_WORD = 300_000, 500_000, 64
UNKNOWN_COST = 10.0


def proto_fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        size = {0: None, 1: 8, 2: -1, 5: 4}[tag & 7]
        if size is None:
            yield tag >> 3, varint()
        else:
            size = varint() if size < 0 else size
            yield tag >> 3, data[at:at + size]
            at += size


@dataclass
class PieceModel:
    """Pieces, scores and kinds of a model, and how it marks spaces."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    method: int = UNIGRAM
    dummy_prefix: bool = True
    tidy_spaces: bool = True
    open_nodes: dict = field(default_factory=dict)

    @classmethod
    def read(cls, data: bytes) -> PieceModel:
        pieces, scores, kinds, method, norm = [], [], [], UNIGRAM, {}
        for number, value in proto_fields(data):
            if number == 1:
                piece = dict(proto_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                method = dict(proto_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                norm = dict(proto_fields(value))
        if norm.get(2) or not norm.get(5, 1):
            raise ValueError("a model with a character map or without space marks is not supported")
        if method not in (UNIGRAM, BPE):
            raise ValueError("the model is neither unigram nor BPE")
        return cls(pieces, scores, kinds, method, bool(norm.get(3, 1)), bool(norm.get(4, 1)))

    def normal(self, text: str) -> str:
        if self.tidy_spaces:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)

    @cached_property
    def usable(self) -> dict[str, int]:
        return {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in (NORMAL, USER_DEFINED)}

    @cached_property
    def byte_ids(self) -> list[int]:
        at = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        return [at[f"<0x{b:02X}>"] for b in range(256)] if len(at) == 256 else []

    @cached_property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    @cached_property
    def words(self) -> re.Pattern:
        """Marked words. Line ends and tabs stand alone if no piece holds them."""
        if any(MARK in p.lstrip(MARK) for p in self.usable):
            return re.compile("(?s).+")
        alone = "".join(c for c in "\n\t" if not any(c in p for p in self.usable))
        return re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+|[{alone}]" if alone else f"{MARK}*[^{MARK}]+|{MARK}+")

    @cached_property
    def trie(self) -> dict:
        """Nodes by sign: ``[piece or -1, children]``."""
        root: dict = {}
        for piece, i in self.usable.items():
            node, last = root, None
            for sign in piece:
                last = node.setdefault(sign, [-1, {}])
                node = last[1]
            if last is not None:
                last[0] = i
        return root

    @cached_property
    def ranks(self) -> dict[str, int]:
        """Merge order of the pieces that merges make: higher scores first, equal scores together."""
        made = {p: self.scores[i] for p, i in self.usable.items() if len(p) > 1}
        order = {s: r for r, s in enumerate(sorted(set(made.values()), reverse=True))}
        return {p: order[s] for p, s in made.items()}

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best pair first, the leftmost among equals."""
        parts, joint = list(text), None
        while len(parts) > 1:
            best = min(((self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ranks), default=None)
            if best is None:
                break
            joint = best[1]
            parts[joint:joint + 2] = [parts[joint] + parts[joint + 1]]
        return parts

    @cached_property
    def halves(self) -> dict[str, tuple[str, str]]:
        """What the last merge of a piece joins; pieces that merges don't reach are left out."""
        out = {}
        for piece in self.ranks:
            parts, last = list(piece), None
            while len(parts) > 1:
                best = min(((self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ranks), default=None)
                if best is None:
                    break
                i = best[1]
                last = (parts[i], parts[i + 1])
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            if len(parts) == 1:
                out[piece] = last
        return out

    def apart(self, a: str, b: str) -> bool:
        """Whether merges of ``a + b`` end in ``a`` and ``b``.

        Their merges are undone from the latest on; at each step a merge across the cut must
        not have come earlier. Among equals the leftmost comes first.
        """
        limit = float("inf")
        while True:
            across = self.ranks.get(a + b)
            if across is not None and across < limit:
                return False
            of_a, of_b = self.ranks.get(a, -1) if len(a) > 1 else -1, self.ranks.get(b, -1) if len(b) > 1 else -1
            if of_a > of_b:
                limit, a = of_a, self.halves[a][1]
            elif of_b >= 0:
                limit, b = of_b + 0.5, self.halves[b][0]
            else:
                return True


class Encoder:
    """Ids of marked words, with a bounded table of those met before."""

    def __init__(self, model: PieceModel):
        self.model, self.kept, self.older, self.pairs = model, {}, {}, {}
        self.reached = {i for p, i in model.usable.items() if len(p) == 1 or p in model.halves} if model.method == BPE else set(model.usable.values())
        self.size = len(model.pieces)
        self.floor = min((model.scores[i] for i in model.usable.values()), default=0.0) - UNKNOWN_COST
        self.out = [b"" for _ in range(self.size)]
        for i, (piece, kind) in enumerate(zip(model.pieces, model.kinds, strict=True)):
            if kind == BYTE:
                self.out[i] = bytes([int(piece[3:5], 16)])
            elif kind == UNKNOWN:
                self.out[i] = " ⁇ ".encode()
            elif kind != CONTROL:
                self.out[i] = piece.replace(MARK, " ").encode()

    def pack(self, ids: Iterable[int], word: str) -> bytes:
        """Ids as bytes; unknown signs as their bytes."""
        ids = list(ids)
        if min(ids) >= 0:
            return array("i", ids).tobytes()
        out, at = [], 0
        for i in ids:
            if i >= 0:
                out.append(i)
                at += len(self.model.pieces[i])
            else:
                out += [self.model.byte_ids[b] for b in word[at].encode()] if self.model.byte_ids else [self.model.unknown]
                at += 1
        return array("i", out).tobytes()

    def may_follow(self, a: int, b: int) -> bool:
        if a < 0 or b < 0:
            return True
        key = a * self.size + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            pieces = self.model.pieces
            known = self.pairs[key] = a in self.reached and b in self.reached and self.model.apart(pieces[a], pieces[b])
        return known

    def encode_sorted(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each of the sorted words with its ids: a depth-first walk of their trie."""
        model, scores, root, pairs, size = self.model, self.model.scores, self.model.trie, self.pairs, self.size
        sums, low = model.method == UNIGRAM, float("-inf")
        # By length of the prefix: forward score, last piece, where it begins, pieces still open.
        score, last, start, opened = [0.0], [-1], [0], [[]]
        before = ""
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del score[shared + 1:], last[shared + 1:], start[shared + 1:], opened[shared + 1:]
            for i in range(shared, len(word)):
                sign = word[i]
                best, piece, begin, still = low, -2, i, []
                for j, node in (*opened[i], (i, root)):
                    child = node.get(sign)
                    if child is None:
                        continue
                    p, more = child
                    if more:
                        still.append((j, more))
                    if p < 0 or score[j] == low:
                        continue
                    if sums:
                        reach = score[j] + scores[p]
                        if reach > best:
                            best, piece, begin = reach, p, j
                    elif piece == -2:  # one arc at most is admitted
                        fits = self.alone(p) if not j else pairs.get(last[j] * size + p) if last[j] >= 0 else True
                        if fits is None:
                            fits = self.may_follow(last[j], p)
                        if fits:
                            best, piece, begin = 0.0, p, j
                if score[i] != low and (sign not in root or root[sign][0] < 0):
                    if sums and score[i] + self.floor > best or not sums and piece == -2:
                        best, piece, begin = score[i] + self.floor if sums else 0.0, -1, i
                score.append(best)
                last.append(piece)
                start.append(begin)
                opened.append(still)
            before = word
            if score[-1] == low:
                yield word, self.pack([model.usable.get(p, -1) for p in model.merged(word)], word)
                continue
            path, i = [], len(word)
            while i:
                path.append(last[i])
                i = start[i]
            path.reverse()
            yield word, self.pack(path, word)

    def alone(self, p: int) -> bool:
        return p in self.reached

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of each text as little-endian 32-bit numbers."""
        cut = [self.model.words.findall(self.model.normal(t)) if t is not None else None for t in texts]
        needed = set().union(*(words for words in cut if words))
        if len(self.kept) + len(needed.difference(self.kept)) > KEPT_WORDS:
            self.older, self.kept = self.kept, {}  # words that no batch needs until the next turn go
        new = needed.difference(self.kept)
        known = {w: self.older[w] for w in new if w in self.older}
        self.kept.update(known)
        self.kept.update(self.encode_sorted(sorted(new.difference(known))))
        find = self.kept.__getitem__
        out = [b"".join(map(find, words)) if words is not None else None for words in cut]
        for w in [w for w in new if len(w) > LONG_WORD]:
            self.kept.pop(w, None)
        return out

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.out.__getitem__, np.frombuffer(ids, "<i4").tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


def encoder(spark: SparkSession, model_file: str):
    """What gives a task its encoder. The file is read by Spark, on any storage Spark knows."""
    data = spark.read.format("binaryFile").load(model_file).select("content").first()[0]
    shared = spark.sparkContext.broadcast(bytes(data))  # the size of the model file
    return lambda: Encoder(PieceModel.read(shared.value))


def batches_of(batch: pa.RecordBatch, rows: int = 2000, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text at most, one row at least."""
    step = max(1, min(rows, batch.num_rows * limit // max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def with_field(source: DataFrame, values: Column, name: str, kind: T.DataType, dropped: str, change) -> DataFrame:
    """The rows with a column that ``change`` makes of each batch of ``values``, in place of the ``dropped`` one.

    Inside the task columns go by number, so their names may be anything.
    """
    others = [c for c in source.columns if c not in (name, dropped)]
    numbered = source.select(*(named(c).alias(f"c{i}") for i, c in enumerate(others)), values.alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for column, batch in change(batches):
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(others))), column], [*(f"c{i}" for i in range(len(others))), "v"])

    schema = T.StructType([*(f for f in numbered.schema if f.name != "v"), T.StructField("v", kind)])
    return numbered.mapInArrow(run, schema).toDF(*others, name)


def encode(docs: DataFrame, model_file: str = MODEL_FILE, text: str = "text") -> DataFrame:
    """The rows with ``piece_ids`` (array of int) in place of the text."""
    make = encoder(docs.sparkSession, model_file)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.RecordBatch]]:
        own = make()
        for batch in (part for whole in batches for part in batches_of(whole)):
            ids = own.encode(batch.column("v").to_pylist())
            counts = np.array([len(x) // 4 if x is not None else 0 for x in ids], np.int64)
            flat = pa.array(np.frombuffer(b"".join(x or b"" for x in ids), "<i4"), pa.int32())
            bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.ListArray.from_arrays(bounds, flat, mask=pa.array([x is None for x in ids])), batch

    return with_field(docs, named(text).cast("string"), "piece_ids", T.ArrayType(T.IntegerType()), text, change)


def decode(encoded: DataFrame, model_file: str = MODEL_FILE, text: str = "text") -> DataFrame:
    """The rows with the text in place of ``piece_ids``."""
    make = encoder(encoded.sparkSession, model_file)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.RecordBatch]]:
        own = make()
        for batch in batches:
            texts = [own.decode(x.values.to_numpy().astype("<i4").tobytes()) if x.is_valid else None for x in batch.column("v")]
            yield pa.array(texts, pa.string()), batch

    return with_field(encoded, F.col("piece_ids"), text, T.StringType(), "piece_ids", change)


def round_trip(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (of little-endian 32-bit ids), text_sha256 of the decoded text, and whether it is the text."""
    make = encoder(docs.sparkSession, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        for batch in (part for whole in batches for part in batches_of(whole)):
            texts = batch.column("text").to_pylist()
            ids = own.encode(texts)
            back = [own.decode(x) if x is not None else None for x in ids]
            digest = lambda x: hashlib.sha256(x).hexdigest()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(x) // 4 if x is not None else 0 for x in ids], pa.int64()),
                pa.array([digest(x) if x is not None else None for x in ids], pa.string()),
                pa.array([digest(x.encode()) if x is not None else None for x in back], pa.string()),
                pa.array([x == t for x, t in zip(back, texts, strict=True)], pa.bool_())],
                ["doc_id", "n_pieces", "ids_sha256", "text_sha256", "same_text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_pieces long, ids_sha256 string, text_sha256 string, same_text boolean")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
