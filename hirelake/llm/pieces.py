"""SentencePiece encoding (merge type) and decoding, exact and without replaying merges.

The merges of a text end in one sequence of pieces, and a sequence is that one if every two
neighbours are compatible: merging their characters anew ends in the same two pieces. So pieces are
laid from left to right by backtracking: at each position the longest piece that fits (from an
Aho-Corasick automaton over the vocabulary) is tried first, then the ones that are its prefixes; a
piece that is not compatible with the one before is passed over, and a position where nothing fits
is marked in a bitfield, is never entered again, and takes back the piece that led there. The time
is proportional to the text's length. Pieces that their own characters do not merge to never occur in
a result and are left out.

Texts are cut where no piece can go across: before a space mark, and before signs that no piece has
behind what comes before them. The ids of a cut are kept for the next time it is seen, up to a number of cuts. Texts are
worked on by tasks, some at a time, and never gathered.

Decoding maps ids to their texts, reads runs of byte pieces as UTF-8 (U+FFFD for each byte that is
not), and takes away the one space that encoding puts in front.

Defined cases: a null or empty text has no pieces but the end id, and is decoded to an empty text;
bytes that are no UTF-8 are read as U+FFFD each; rows repeated are encoded each; null ids stay null;
other columns are not read.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import slices

SPACE = "▁"
# Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

KEPT_LENGTH = 64       # longer cuts are not kept
KEPT = 1 << 20         # as many cuts, or pairs of pieces, are kept at a time

_SIGNS = ".,;:!?$"
_GAP = "\x1f"
_LINE_END = f"{_GAP}\n{_GAP}"

codecs.register_error("byte-by-byte", lambda e: ("�", e.start + 1))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
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
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at:at + size]
        at += size


class _Cuts(dict):
    """The ids of cuts, four bytes each, kept for the next time."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, text: str) -> bytes:
        ids = array("i", self.model.cut_ids(text)).tobytes()
        if len(text) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.clear()
            self[text] = ids
        return ids


class _Pairs(dict):
    """Whether two pieces (left << 32 | right) stay as they are when their characters are merged anew."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, pair: int) -> bool:
        if len(self) >= KEPT:
            self.clear()
        a, b = self.model.texts[pair >> 32], self.model.texts[pair & 0xFFFFFFFF]
        known = self[pair] = self.model.merged(a + b) == [a, b]
        return known


@dataclass
class Model:
    """The vocabulary of a model of merge type with byte pieces, and an encoder over it."""
    texts: list[str]
    scores: list[float]
    kinds: list[int]

    def __post_init__(self):
        self.cuts, self.pairs = _Cuts(self), _Pairs(self)

    @classmethod
    def read(cls, path: str) -> Model:
        """A model file; anything that this encoder would not treat exactly is refused."""
        texts, scores, kinds = [], [], []
        normal: dict = {}
        trained: dict = {}
        for number, value in _fields(Path(path).read_bytes()):
            if number == 1:
                own = dict(_fields(value))
                texts.append(own[1].decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif number == 2:
                trained = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        plain = normal.get(1) == b"identity" and not normal.get(2) and normal.get(3, 1) and not normal.get(4, 1)
        if trained.get(3) != 2 or not trained.get(35) or not plain or {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError(f"{path} is not a plain merge model with byte pieces")
        return cls(texts, scores, kinds)

    # --- tables ---

    @cached_property
    def ranks(self) -> dict[str, float]:
        """Pieces that merges can make; the lowest rank is merged first."""
        return {t: -s for t, s, k in zip(self.texts, self.scores, self.kinds) if k == NORMAL}

    @cached_property
    def ids(self) -> dict[str, int]:
        return {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == NORMAL}

    @cached_property
    def bytes(self) -> list[int]:
        """The id of each byte."""
        own = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}
        return [own[f"<0x{b:02X}>"] for b in range(256)]

    @cached_property
    def sizes(self) -> list[int]:
        return [len(t) for t in self.texts]

    @cached_property
    def reachable(self) -> dict[str, int]:
        """Ids of the pieces that their characters merge to."""
        return {t: i for t, i in self.ids.items() if self.merged(t) == [t]}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for text, number in self.reachable.items():
            made.add_word(text, (len(text) - 1, number))
        made.make_automaton()
        return made

    @cached_property
    def shorter(self) -> list[int]:
        """For each piece the longest other one that it starts with; -1 if there is none."""
        out = [-1] * len(self.texts)
        for text, number in self.reachable.items():
            starts = (text[:n] for n in range(len(text) - 1, 0, -1))
            out[number] = next((self.reachable[s] for s in starts if s in self.reachable), -1)
        return out

    @cached_property
    def cutter(self) -> re.Pattern:
        """Cuts a text where no piece goes across."""
        return re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if self.simple else r"(?s).+")

    @cached_property
    def simple(self) -> bool:
        """No piece has a line end, or a space mark after another character."""
        return not any("\n" in t or SPACE in t.lstrip(SPACE) for t in self.ids)

    # --- encoding ---

    def merged(self, text: str) -> list[str]:
        """The merges themselves, one after the other: the lowest rank first, then the leftmost."""
        parts = list(text)
        ranks = self.ranks
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _known_part(self, text: str) -> list[int]:
        """Pieces of a text all of whose characters are pieces."""
        n = len(text)
        longest = [0] * n
        for end, (before, number) in self.automaton.iter(text):
            longest[end - before] = number  # ends grow, so the longest comes last
        sizes, shorter, pairs = self.sizes, self.shorter, self.pairs
        failed, failures = bytearray((n >> 3) + 1), False
        laid: list[int] = []
        at, number, last = 0, longest[0], -1
        while True:
            while number >= 0:
                if last < 0 or pairs[last << 32 | number]:
                    end = at + sizes[number]
                    if not (failures and failed[end >> 3] >> (end & 7) & 1):
                        break
                number = shorter[number]
            if number >= 0:
                laid.append(number)
                at, last = end, number
                if at == n:
                    return laid
                number = longest[at]
            else:
                failures = True
                failed[at >> 3] |= 1 << (at & 7)
                number = laid.pop()
                at -= sizes[number]
                last = laid[-1] if laid else -1

    def cut_ids(self, text: str) -> list[int]:
        """Ids of a cut: pieces, and bytes of the characters that are none.

        Signs at the end are cut off where no piece has both neighbours; parts are kept as cuts are.
        """
        at = len(text.rstrip(_SIGNS))
        if 0 < at < len(text) and text[at - 1:at + 1] not in self.inner:
            return np.frombuffer(self.cuts[text[:at]] + self.cuts[text[at:]], "<i4").tolist()
        if not self.foreign.search(text):
            return self._known_part(text) if text else []
        out: list[int] = []
        for n, part in enumerate(self.foreign.split(text)):
            if n % 2:
                out += [self.bytes[b] for b in part.encode()]
            elif part:
                out += self._known_part(part)
        return out

    @cached_property
    def inner(self) -> set[str]:
        """Every two neighbours that some piece has."""
        return {t[i:i + 2] for t in self.reachable for i in range(len(t) - 1)}

    @cached_property
    def foreign(self) -> re.Pattern:
        """Characters that are no pieces."""
        letters = "".join(re.escape(t) for t in self.reachable if len(t) == 1)
        return re.compile(f"([^{letters}]+)")

    def pack(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        if not text:
            return b""
        if self.simple and not (text[0] == " " or _GAP in text or SPACE in text or "  " in text):
            # Single spaces only: the text is cut before each, and around line ends.
            whole = f"{SPACE}{text}".replace(" ", _GAP + SPACE).replace("\n", _LINE_END)
            return b"".join(map(self.cuts.__getitem__, whole.split(_GAP)))
        whole = SPACE + text.replace(" ", SPACE)
        return b"".join(map(self.cuts.__getitem__, self.cutter.findall(whole)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.pack(text), "<i4").tolist()

    # --- decoding ---

    @cached_property
    def end_id(self) -> int:
        return self.texts.index("</s>")

    @cached_property
    def surfaces(self) -> list[str]:
        """What each id stands for; a byte above 7F is a lone surrogate until all are joined."""
        out = []
        for text, kind in zip(self.texts, self.kinds):
            if kind == BYTE:
                byte = int(text[3:5], 16)
                out.append(chr(byte if byte < 128 else 0xDC00 + byte))
            else:
                out.append({CONTROL: "", UNKNOWN: " ⁇ "}.get(kind, text.replace(SPACE, " ")))
        return out

    def decode(self, ids: list[int]) -> str:
        text = "".join(map(self.surfaces.__getitem__, ids))
        try:
            text.encode()
        except UnicodeEncodeError:  # bytes join up to characters, but not across a control id
            runs = groupby(ids, lambda i: self.kinds[i] == CONTROL)
            text = "".join(
                "".join(map(self.surfaces.__getitem__, run)).encode("utf-8", "surrogateescape")
                .decode("utf-8", "byte-by-byte") for control, run in runs if not control)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        spaced = first is not None and self.kinds[first] == NORMAL and text.startswith(" ")
        return text[1:] if spaced else text


_made: dict[str, Model] = {}


def _own(shared) -> Model:
    """The worker's own copy of a shared model, with what it has kept so far."""
    key, texts, scores, kinds = shared
    if key not in _made:
        _made.clear()
        _made[key] = Model(texts, scores, kinds)
    return _made[key]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  end: bool = True) -> DataFrame:
    """(id, ids, decoded): ids array<int> of each text, with the end id, and what they decode to.

    The model file is read on the driver; its vocabulary, which no data makes larger, goes to the
    tasks.
    """
    model = Model.read(model_path)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((model_path, model.texts, model.scores, model.kinds))

    def task(batches) -> Iterator[pa.RecordBatch]:
        own = _own(shared.value)
        last = np.array([own.end_id] if end else [], "<i4").tobytes()
        for batch in slices(batches):
            texts = (b.decode("utf-8", "byte-by-byte") for b in batch.column("text").to_pylist())
            ids = [np.frombuffer(own.pack(t) + last, "<i4") for t in texts]
            ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "ids": pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32())),
                "decoded": pa.array([own.decode(i.tolist()) for i in ids], pa.string())})

    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(docs[id_col].cast("long").alias("id"), text.alias("text"))
    return rows.mapInArrow(task, "id long, ids array<int>, decoded string").withColumnRenamed("id", id_col)
