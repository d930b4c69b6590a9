"""SentencePiece encoding that keeps where every piece comes from, and decoding.

A text is normalised here, by the model's compiled character map: at each place the longest entry
of the map is replaced, and for every byte written the place in the source where its entry began is
recorded. The normalised text is then encoded by the sentencepiece library with a copy of the model
that normalises nothing, and the lengths of its pieces, carried through the record, give the byte
span of each piece in the source text. Spans follow each other without gap: the piece before ends
where the next begins. Of the byte pieces of one character all but the last are empty spans.

Texts are cut at places over which no piece reaches, so that a worker encodes each different
segment once; a text for which that is not certain is encoded in one go, with the same result.
"""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from parityframe.llm.words import free_name
from parityframe.workspace import quoted

#: How the library writes a space within a piece.
SPACE_MARK = "▁"
#: Segments a worker remembers; as many that it had learnt before serve for a while longer.
REMEMBERED = 300_000
#: Longest segment remembered, in characters.
REMEMBERED_LETTERS = 80
#: Texts encoded at a time.
GROUP = 256

_BYTE, _USER_DEFINED = 6, 4  # types of pieces in a model file
_MARK = SPACE_MARK.encode()
_REPLACEMENT = "�".encode()


class CharacterMap:
    """The compiled character map of a model: a double-array trie, and what its entries become.

    The map starts with the size of the trie in bytes, followed by the trie (32-bit units) and by
    strings that end with a zero byte, to which the trie's values point. Of a unit, bit 8 tells
    that a key ends there, the low byte and the top bit are its label, bits 10 to 30 the offset of
    its children, to be shifted by 8 if bit 9 is set.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.strings = compiled[4 + size :]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _value(self, node: int) -> bytes:
        start = self.units[node] & 0x7FFFFFFF
        return self.strings[start : self.strings.index(b"\0", start)]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest entry that starts at ``at`` becomes, and its length."""
        if not self.units:
            return None
        units, found = self.units, None
        node = self._children(units[0])
        for place in range(at, len(text)):
            node ^= text[place]
            if node >= len(units) or units[node] & 0x800000FF != text[place]:
                break
            unit = units[node]
            node ^= self._children(unit)
            if unit & 0x100:
                found = node, place + 1 - at
        return found and (self._value(found[0]), found[1])

    def entries(self) -> Iterator[tuple[bytes, bytes]]:
        """All entries: key and what it becomes."""
        if not self.units:
            return
        stack = [(self._children(self.units[0]), b"")]
        while stack:
            base, key = stack.pop()
            for byte in range(1, 256):
                node = base ^ byte
                if node < len(self.units) and self.units[node] & 0x800000FF == byte:
                    unit, longer = self.units[node], key + bytes([byte])
                    below = node ^ self._children(unit)
                    if unit & 0x100:
                        yield longer, self._value(below)
                    stack.append((below, longer))


class Normaliser:
    """Normalises UTF-8 texts and records the source place of every byte written."""

    def __init__(self, model):
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.tidy = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.space = _MARK if spec.escape_whitespaces else b" "
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        own = sorted((p.piece.encode() for p in model.pieces if p.type == _USER_DEFINED), reverse=True)
        #: Pieces the user has defined are never changed; the longest at a place counts.
        self.own = re.compile(b"|".join(map(re.escape, own))) if own else None
        firsts = {key[0] for key, _ in self.map.entries()} | {piece[0] for piece in own}
        #: Where entries may begin; a text without such a byte changes in its spaces only.
        self.changing = re.compile(b"[" + re.escape(bytes(sorted(firsts))) + b"]") if firsts else None
        #: A run in which no entry begins and that holds neither spaces nor bytes beyond ASCII.
        plain = bytes(b for b in range(128) if b not in firsts and b != 0x20)
        self.plain = re.compile(b"[" + re.escape(plain) + b"]+") if plain else None

    def _unit(self, text: bytes, at: int) -> tuple[bytes, int]:
        """What comes of the place ``at``, and how many bytes of the source it uses."""
        own = self.own and self.own.match(text, at)
        if own:
            return own[0], len(own[0])
        found = self.map.longest(text, at)
        if found:
            return found
        byte = text[at]
        size = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
        return text[at : at + size], size

    def __call__(self, text: bytes, head: bool = True) -> tuple[bytes, list[int]]:
        """The normalised text, and for each of its bytes, and for its end, a place in ``text``.

        ``head`` tells that this is the start of a text and not a segment amid it.
        """
        out, places = bytearray(), []
        at = 0
        if head and self.tidy:
            while at < len(text):
                unit, size = self._unit(text, at)
                if unit != b" ":
                    break
                at += size
        if at == len(text):
            return b"", [at]
        if head and self.dummy and not self.suffix:
            out += self.space
            places += [at] * len(self.space)
        after_space = self.tidy and head
        while at < len(text):
            run = self.plain and self.plain.match(text, at)
            if run:
                out += run[0]
                places += range(at, run.end())
                at, after_space = run.end(), False
                continue
            unit, size = self._unit(text, at)
            if after_space:
                unit = unit.lstrip(b" ")
            if unit:
                written = unit.replace(b" ", self.space)
                out += written
                places += [at] * len(written)
                after_space = self.tidy and unit.endswith(b" ")
            at += size
        end = at
        if self.tidy and head:
            while out.endswith(self.space):
                end = places[len(out) - len(self.space)]
                del out[-len(self.space) :], places[len(out) :]
        if head and self.dummy and self.suffix:
            out += self.space
            places += [end] * len(self.space)
        return bytes(out), [*places, end]


class Encoder:
    """Encodes whole texts with a model, remembering the pieces of segments."""

    _shared: dict[str, Encoder] = {}

    def __init__(self, raw: bytes, remembered: int = REMEMBERED):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        model = ModelProto.FromString(raw)
        self.whole = SentencePieceProcessor(model_proto=raw)
        self.normalise = Normaliser(model)
        spec = model.normalizer_spec
        entries = list(self.normalise.map.entries())
        spec.precompiled_charsmap, spec.name = b"", "identity"
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.bare = SentencePieceProcessor(model_proto=model.SerializeToString())
        sizes = [1 if p.type == _BYTE else len(p.piece.encode()) for p in model.pieces]
        self.sizes = np.array(sizes, np.int64)
        self.unknown = self.whole.unk_id()
        # cutting before a space is safe if no piece holds one after another character, and no
        # entry reaches over one; cutting around a line break if no piece and no entry holds one
        inside = any(SPACE_MARK in p.piece.lstrip(SPACE_MARK) for p in model.pieces)
        bpe = model.trainer_spec.model_type == 2
        self.cuts = bpe and not inside and not self.normalise.suffix and self.normalise.space == _MARK
        self.cuts &= not any(b" " in key[1:] or b"\n" in key for key, _ in entries)
        self.cuts &= not any("\n" in p.piece or " " in p.piece for p in model.pieces)
        self.cuts &= model.trainer_spec.byte_fallback  # else unknown pieces on both sides are one
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        #: Segments that end in a space when normalised.
        self.spaced: set[str] = set()

    _segment = re.compile(r"\n| *[^ \n]+| +")

    @classmethod
    def shared(cls, raw: bytes) -> Encoder:
        """The worker's encoder for a model: what one task has learnt serves the next."""
        key = hashlib.sha256(raw).hexdigest()
        if key not in cls._shared:
            cls._shared[key] = cls(raw)
        return cls._shared[key]

    def _unchanged(self, text: bytes, head: bool) -> bool:
        """Whether normalising does no more than to write spaces in the library's way."""
        own = self.normalise
        if own.space != _MARK or own.suffix or (own.changing and own.changing.search(text)):
            return False
        if not own.tidy:
            return bool(text)
        edges = text.endswith((b" ", _MARK)) or (head and text.startswith(b" "))
        return bool(text) and b"  " not in text and not edges

    def _pieces(self, texts: list[str], head: bool) -> list[tuple[int, bytes, bool]]:
        """Of each text: where its first piece starts, ids with widths, whether it ends in a space."""
        sources = [t.encode() for t in texts]
        simple = [self._unchanged(t, head) for t in sources]
        front = " " if head and self.normalise.dummy else ""
        plain, places = [], []
        for text, source, same in zip(texts, sources, simple):
            if same:
                plain.append((front + text).replace(" ", SPACE_MARK))
            else:
                raw, at = self.normalise(source, head)
                plain.append(raw.decode())
                places.append(np.array(at, np.int64))
        lists = self.bare.encode(plain, num_threads=1)
        if self.unknown >= 0:
            for k, ids in enumerate(lists):
                if self.unknown in ids:
                    return self._with_unknown(texts, head, plain, simple, places)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum()))
        record, firsts = self._records(sources, simple, places, len(front))
        return self._cut(plain, ids, counts, np.cumsum(self.sizes[ids]), record, firsts)

    def _records(self, sources, simple, places, front: int) -> tuple[np.ndarray, np.ndarray]:
        """Source places of all normalised bytes and ends, text after text; where each begins."""
        # an unchanged text is written with its front space and a byte for its end
        body = b"".join(b" " * front + t + b"\0" for t, same in zip(sources, simple) if same)
        data = np.frombuffer(body, np.uint8)
        length = np.array([len(t) + front + 1 for t, same in zip(sources, simple) if same], np.int64)
        start = np.cumsum(length) - length
        index = np.arange(len(data))
        # a byte within a character has the place of the character's first
        index = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, index, 0)) if len(data) else index
        index = np.maximum(index - np.repeat(start + front, length), 0)
        wide = np.where(data == 0x20, len(_MARK), 1)
        written = np.add.reduceat(wide, start) if len(start) else np.zeros(0, np.int64)
        unchanged = np.repeat(index, wide)
        if not places:
            return unchanged, np.cumsum(written) - written
        cut = iter(np.split(unchanged, np.cumsum(written)[:-1]) if len(written) else [])
        rest = iter(places)
        parts = [next(cut) if same else next(rest) for same in simple]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.concatenate(parts), np.cumsum(sizes) - sizes

    def _cut(self, plain, ids, counts, ends, record, firsts) -> list[tuple[int, bytes, bool]]:
        """The pieces of every text, given where the pieces end in the joined normalised texts."""
        text = np.repeat(np.arange(len(counts)), counts)
        starts = np.r_[0, ends[:-1]] if len(ends) else ends
        # between two texts the record has one place more, that of the first one's end
        widths = record[ends + text] - record[starts + text]
        raw = np.stack([ids, widths], axis=1).astype(np.int32).tobytes()
        at = np.r_[0, np.cumsum(counts)] * 8
        heads = record[firsts].tolist()
        return [
            (heads[k], raw[at[k] : at[k + 1]], t.endswith(SPACE_MARK)) for k, t in enumerate(plain)
        ]

    def _with_unknown(self, texts, head, plain, simple, places) -> list[tuple[int, bytes, bool]]:
        """Like ``_pieces``: unknown pieces have no length of their own, the library tells theirs."""
        made = [self.bare.encode(t, out_type="offset_mapping") for t in plain]
        ids = np.array([i for m in made for i in m["ids"]], np.int64)
        counts = np.array([len(m["ids"]) for m in made], np.int64)
        before = np.cumsum([0, *(len(t.encode()) for t in plain)])
        ends = [
            before[k] + len(t[:end].encode())
            for k, (t, m) in enumerate(zip(plain, made))
            for _, end in m["offsets"]
        ]
        front = int(head and self.normalise.dummy)
        record, firsts = self._records([t.encode() for t in texts], simple, places, front)
        return self._cut(plain, ids, counts, np.array(ends, np.int64), record, firsts)

    def encode(self, texts: list[str]) -> list[tuple[int, np.ndarray]]:
        """Of each text: where its first piece starts, and an array of ids and widths in bytes."""
        if len(self.known) > self.remembered:
            self.known, self.earlier = {}, self.known
        cut = [self._segment.findall(t) if self.cuts and SPACE_MARK not in t else [t] for t in texts]
        heads = self._pieces([segments[0] if segments else "" for segments in cut], True)
        long = self._learn({s for segments in cut for s in segments[1:]})
        known = self.known if not long else collections.ChainMap(long, self.known)
        whole = [k for k, segments in enumerate(cut) if len(segments) > 1 and self._runs_on(segments, heads[k])]
        again = dict(zip(whole, self._pieces([texts[k] for k in whole], True)))
        out = []
        for k, segments in enumerate(cut):
            start, raw, _ = again.get(k, heads[k])
            if k not in again:
                raw += b"".join(map(known.__getitem__, segments[1:]))
            out.append((start, np.frombuffer(raw, np.int32).reshape(-1, 2)))
        return out

    def _runs_on(self, segments: list[str], head: tuple[int, bytes, bool]) -> bool:
        """Whether spaces run over a cut, or would be dropped at the end of the text."""
        if not head[1] or head[2]:
            return True
        inner = segments[1:] if self.normalise.tidy else segments[1:-1]
        return bool(self.spaced) and not self.spaced.isdisjoint(inner)

    def _learn(self, segments: set[str]) -> dict[str, bytes]:
        """Encode the segments not known yet; the long ones among them are returned, not kept."""
        missing = [s for s in segments if s not in self.known]
        self.known.update((s, self.earlier[s]) for s in missing if s in self.earlier)
        new = [s for s in missing if s not in self.known]
        long = {}
        for s, (_, raw, flag) in zip(new, self._pieces(new, False)):
            (self.known if len(s) <= REMEMBERED_LETTERS else long)[s] = raw
            if flag:
                self.spaced.add(s)
        return long

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode(ids, num_threads=1)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(v) for v in values])]
    flat = np.concatenate([np.zeros(0, np.int32), *values]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def read_model(path: str) -> bytes:
    """The model file, which goes to the tasks with their code: it need not lie on other machines."""
    with open(path, "rb") as source:
        return source.read()


def encode(docs: DataFrame, model: bytes, text: str = "text", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, ``starts`` and ``ends``: pieces of ``text`` and their byte spans in it.

    ``model`` is a model file's content. No begin or end ids, no sampling. A null text is an empty
    one, with empty arrays. Own columns of ``docs`` called like a result are not kept; others are,
    also repeated rows. ``decoded`` names a further column for the text that the ids decode to.
    Texts are encoded whole, in one pass without a shuffle.
    """
    results = ["ids", "starts", "ends", *([decoded] if decoded else [])]
    taken = {name.lower() for name in results}
    others = [c for c in docs.columns if c.lower() not in taken]
    copy = free_name(docs, "_text")
    body = docs.select(*map(quoted, others), F.col(quoted(text)).cast("string").alias(copy))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(model)
        for whole in batches:
            for at in range(0, whole.num_rows, GROUP):
                batch = whole.slice(at, GROUP)
                texts = [t or "" for t in batch.column(copy).to_pylist()]
                made = encoder.encode(texts)
                ids = [pieces[:, 0] for _, pieces in made]
                edges = [start + np.r_[0, np.cumsum(pieces[:, 1])] for start, pieces in made]
                arrays = [_lists(ids), _lists([e[:-1] for e in edges]), _lists([e[1:] for e in edges])]
                if decoded:
                    arrays.append(pa.array(encoder.decode([i.tolist() for i in ids]), pa.string()))
                columns = [*batch.columns[:-1], *arrays]
                yield pa.RecordBatch.from_arrays(columns, [*others, *results])

    schema = StructType(body.schema.fields[:-1])
    for name in results[:3]:
        schema = schema.add(name, ArrayType(IntegerType(), False))
    if decoded:
        schema = schema.add(decoded, StringType())
    return body.mapInArrow(run, schema)


def decode(rows: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text that their ids decode to in the column ``text``.

    A null list is an empty one. An own column called like the result is not kept.
    """
    others = [c for c in rows.columns if c.lower() != text.lower()]
    copy = free_name(rows, "_ids")
    body = rows.select(*map(quoted, others), F.col(quoted(ids)).cast("array<int>").alias(copy))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(model)
        for batch in batches:
            lists = [x or [] for x in batch.column(copy).to_pylist()]
            made = pa.array(encoder.decode(lists), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], [*others, text])

    return body.mapInArrow(run, StructType(body.schema.fields[:-1]).add(text, StringType()))
