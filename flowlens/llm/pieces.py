"""SentencePiece encoding and decoding by a weighted finite-state transducer.

A model file is compiled into one machine: the normaliser (blank to U+2581, one put in front), the pieces, and for characters
no piece covers their UTF-8 bytes. Composed with an input, its paths are the ways to cut the input into pieces, and
the tropical shortest path is the encoding. In a unigram model a piece weighs minus its score. In a BPE model a state also
holds the last piece, and an arc weighs nothing if the merges, applied to the two pieces together, leave exactly these
two, else infinity: the one path of finite weight is what the merges make of the whole input.

No piece has a blank mark behind another character, so an input is composed in stretches that begin at blank marks or line ends, and
stretches seen lately are remembered (a bounded number).

Null and empty texts have no ids; null decodes to null. Any text decodes to itself, except that U+2581 comes back as a blank. Repeated
rows get equal ids. An empty table gives an empty result. A column named like the result is replaced. A model with
a character map of its own is refused.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.common import slices, small_batches, text_column

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BEFORE = " " + MARK
# Piece types and model types of the public model format.
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: Stretches remembered in each of two generations, and the longest of them.
REMEMBERED, REMEMBERED_LENGTH = 300_000, 48
_INF = float("inf")


class Machine:
    """A compiled model."""

    def __init__(self, path: str, kind: int | None = None):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that keep their characters and blanks")
        self.kind = kind or model.trainer_spec.model_type
        self.prefix = MARK if model.normalizer_spec.add_dummy_prefix else ""
        self.names = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)}
        self.scores = [p.score for p in model.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.unknown_weight = 10.0 - min(p.score for p in model.pieces if p.type == NORMAL)
        self.control = {i for i, p in enumerate(model.pieces) if p.type in (CONTROL, UNKNOWN)}
        if any(MARK in name.lstrip(MARK) for name in self.ids):
            raise ValueError("a piece holds a blank mark behind another character")
        self.longest: dict[str, int] = {}  # by the first four characters of longer pieces
        for name in self.ids:
            self.longest[name[:4]] = max(self.longest.get(name[:4], 0), len(name))
        apart = "" if any("\n" in name for name in self.ids) else "\n"
        self.stretch = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (f"|{apart}" if apart else ""))
        self.plain_lines = bool(apart)
        self.outputs = [self._output(i, p) for i, p in enumerate(model.pieces)]
        self.joins: dict[int, bool] = {}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _output(self, i: int, piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        if piece.type == CONTROL:
            return b""
        return piece.piece.replace(MARK, " ").encode("utf-8") if piece.type != UNKNOWN else " ⁇ ".encode()

    def merged(self, text: str) -> list[str]:
        """What the merges leave of a short text: the best-scored neighbours first, then the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -_INF, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and self.scores[found] > best:
                    best, at = self.scores[found], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands_beside(self, left: int, right: int) -> bool:
        """Whether the arc from state `left` by piece `right` has weight zero; left -1: a beginning."""
        key = left * 65536 + right
        known = self.joins.get(key)
        if known is None:
            a, b = "" if left < 0 else self.names[left], self.names[right]
            known = self.merged(a + b) == ([a, b] if a else [b])
            if len(self.joins) >= 400_000:
                self.joins.clear()
            self.joins[key] = known
        return known

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8")] if self.bytes else [self.unknown]

    def bpe_path(self, text: str) -> list[int]:
        """The path of finite weight, depth first; states found dead are not entered again."""
        ids, joins, longest, end = self.ids, self.joins, self.longest, len(text)
        path: list[tuple[int, int, int]] = []  # position, last piece, length still to try
        dead: set[tuple[int, int]] = set()
        at, last, size = 0, -1, longest.get(text[:4], 3)
        while at < end:
            while size > 0:
                piece = ids.get(text[at : at + size])
                if piece is not None and at + size <= end:
                    ok = joins.get(last * 65536 + piece)
                    if ok is None:
                        ok = self.stands_beside(last, piece)
                    if ok and (not dead or (at + size, piece) not in dead):
                        break
                size -= 1
            if size > 0:
                path.append((at, last, size))
                at, last = at + size, piece
            elif text[at] not in ids:
                path.append((at, last, 0))
                at, last = at + 1, -1
            else:
                dead.add((at, last))
                at, last, size = path.pop()
                while size == 0:  # an uncovered character leaves no choice
                    at, last, size = path.pop()
                size -= 1
                continue
            size = longest.get(text[at : at + 4], 3)
        found: list[int] = []
        for at, _, size in path:
            found += [ids[text[at : at + size]]] if size else self.fallback(text[at])
        return found

    def unigram_path(self, text: str) -> list[int]:
        """Forward relaxation over positions; the first best arc stays."""
        end = len(text)
        weight, back = [0.0] + [_INF] * end, [(0, -1)] * (end + 1)
        for at in range(end):
            for size in range(1, min(self.longest.get(text[at : at + 4], 3), end - at) + 1):
                piece = self.ids.get(text[at : at + size])
                if piece is not None and weight[at] - self.scores[piece] < weight[at + size]:
                    weight[at + size], back[at + size] = weight[at] - self.scores[piece], (at, piece)
            if text[at] not in self.ids and weight[at] + self.unknown_weight < weight[at + 1]:
                weight[at + 1], back[at + 1] = weight[at] + self.unknown_weight, (at, -1)
        arcs = []
        while end:
            at, piece = back[end]
            arcs.append([piece] if piece >= 0 else self.fallback(text[at]))
            end = at
        return [i for arc in reversed(arcs) for i in arc]

    def stretch_ids(self, text: str) -> bytes:
        """Ids of a stretch as 32-bit numbers."""
        found = self.old.get(text)
        if found is None:
            found = array("i", self.bpe_path(text) if self.kind == BPE else self.unigram_path(text)).tobytes()
        if len(text) <= REMEMBERED_LENGTH:
            if len(self.new) >= REMEMBERED:
                self.old, self.new = self.new, {}
            self.new[text] = found
        return found

    def stretches(self, text: str) -> list[str]:
        """The text, marked, in stretches. Single blanks between words, the usual case, need no pattern."""
        marked = self.prefix + text
        if not self.plain_lines or "  " in text or MARK in text or text[0] == " ":
            return self.stretch.findall(marked.replace(" ", MARK))
        found: list[str] = []
        for line in marked.split("\n"):
            words = line.replace(" ", BEFORE).split(" ")
            found += words if words[0] else words[1:]
            found.append("\n")
        found.pop()
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        known, make = self.new.get, self.stretch_ids
        return np.frombuffer(b"".join([known(s) or make(s) for s in self.stretches(text)]), np.int32)

    def decode(self, ids) -> str:
        whole = b"".join([self.outputs[i] for i in ids])
        text = whole.decode("utf-8", errors="replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@cache
def machine(path: str, kind: int | None = None) -> Machine:
    """One for each Python worker."""
    return Machine(path, kind)


def encode(
    df: DataFrame, text: str = "text", name: str = "ids", model: str = MODEL, check: bool = False, kind: int | None = None
) -> DataFrame:
    """The rows with the ids of the text (array of int), and with `check` whether they decode to it (round_trip)."""
    small_batches(df.sparkSession)
    rows = df.drop(name, *(["round_trip"] if check else []))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema = f"{fields}, `{name}` array<int>" + (", round_trip boolean" if check else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = machine(model, kind)
        for batch in slices(batches, text):
            texts = text_column(batch, text).to_pylist()
            ids = [own.encode(t) for t in texts]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            values = pa.array(np.concatenate(ids), pa.int32())
            arrays = [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), values)]
            names = [*batch.schema.names, name]
            if check:
                arrays.append(pa.array([own.decode(x.tolist()) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()))
                names.append("round_trip")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(work, schema)


def decode(df: DataFrame, ids: str = "ids", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """The rows with the text the ids stand for; null ids decode to null."""
    small_batches(df.sparkSession)
    rows = df.drop(name)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = machine(model)
        for batch in batches:
            found = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = pa.array([None if x is None else own.decode(x) for x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, name])

    return rows.mapInArrow(work, f"{fields}, `{name}` string")
