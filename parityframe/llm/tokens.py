"""Token ids in binary files that allow reading single short documents.

A file holds a run of documents in ascending id order. Each document's ids are serialised as
little-endian integers and compressed on their own with zstandard, so that one document can be
read alone; a dictionary shared by all files, trained on serialised id arrays, makes short frames
small. A file:

    8 bytes   ``TOKENZ01``
    frames    one per document, one after the other
    index     start of every frame and the end of the last (uint64), number of ids of every
              document (uint64), document ids (int64), 1 where the id is null (uint8)
    footer    JSON: documents, ids, bytes per id, SHA-256 of the dictionary ("" without one)
    8 bytes   start of the index (uint64)
    8 bytes   start of the footer (uint64)

Beside the files lie ``dictionary`` and the Parquet table ``manifest`` (one row per file).
"""

from __future__ import annotations

import hashlib
import io
import json
import string
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityframe.llm.words import small_batches

MAGIC = b"TOKENZ01"
DICTIONARY_BYTES = 64 * 1024
#: Documents the dictionary is trained on, and the most characters of one: it serves short ones.
SAMPLE_DOCUMENTS = 400
SAMPLE_CHARACTERS = 4000
#: Bytes of text that one file holds.
FILE_BYTES = 40 << 20
#: Different pieces of text a worker remembers the ids of, about 150 bytes each; as many that it
#: had learnt before serve for a while longer.
REMEMBERED = 350_000

MANIFEST = (
    "file string, part bigint, first_doc bigint, last_doc bigint, n_docs bigint, n_ids bigint, "
    "n_bytes bigint"
)


_ENCODERS: dict[str, Encoder] = {}
#: How a byte-level vocabulary shows bytes: visible ones as themselves, the others, in order, as
#: the characters from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
_SHOWN_CODES = np.array([ord(_SHOWN.get(b, chr(b))) for b in range(256)], "<u2")
#: White space, of which none lies beyond 16 bits, but for the space and newline that part texts.
_OTHER_SPACES = [c for c in map(chr, range(1 << 16)) if c.isspace() and c not in " \n"]
#: Pieces that go to the library in one call, by its model and by the whole tokenizer.
MODEL_PIECES = 40
TEXT_PIECES = 1000


def _shown(text: str) -> str:
    return _SHOWN_CODES[np.frombuffer(text.encode(), "u1")].tobytes().decode("utf-16-le")


class Encoder:
    """Encodes whole texts with a byte-level BPE tokenizer, remembering the ids of pieces.

    The tokenizer's pattern always parts a text between a character that is no white space and
    a single space or newline followed by another such character. Texts in which all white space
    is of this kind are cut there, and each different piece is encoded once; all other texts are
    encoded in one go, also those with the string of a special token. Either way the ids are
    those of the whole text.

    New pieces are encoded many at a time, as one text: its ids are theirs, one after the other,
    and a piece's ids begin where a token begins with a space or newline, which pieces hold only
    in front. A call whose ids do not part into as many pieces is not used; its pieces are then
    encoded one by one.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the tokenizer takes for a single id wherever they stand in a text.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added]
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        if sys.byteorder != "little" or array(self.code).itemsize != self.kind.itemsize:
            raise RuntimeError("ids are serialised in the machine's order, which must be this one")
        self.bare = self.tokenizer.normalizer is None
        model = self.tokenizer.model
        #: Whether the model merges by pairs alone, so that words in a row do not change another.
        self.chained = isinstance(model, BPE) and not (
            model.dropout
            or model.ignore_merges
            or model.continuing_subword_prefix
            or model.end_of_word_suffix
        )
        vocabulary = self.tokenizer.get_vocab()
        #: By id: whether a token begins with a space or a newline.
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, k in vocabulary.items():
            self.begins[k] = token.startswith((_SHOWN[32], _SHOWN[10]))
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    @staticmethod
    def shared(path: str) -> Encoder:
        """The worker's encoder for a tokenizer: what one task has learnt serves the next."""
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]

    def _direct(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in made]

    def _one(self, piece: str) -> bytes:
        """The ids of a space and letters: the pattern leaves them whole, so the model suffices."""
        return array(self.code, self._model(piece)).tobytes()

    def _model(self, text: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(_shown(text))]

    def _parted(self, ids: list[int], n: int) -> list[bytes] | None:
        """The serialised ids of each of ``n`` pieces encoded in a row, if they part into these."""
        row = np.array(ids, self.kind)
        starts = np.flatnonzero(self.begins[row])
        if len(starts) != n or starts[0] != 0:
            return None
        raw, at = row.tobytes(), (starts * self.kind.itemsize).tolist()
        return [raw[i:j] for i, j in zip(at, [*at[1:], len(raw)])]

    def _letters(self, words: list[str]) -> None:
        """Learn words of letters, each with a space before it."""
        step = MODEL_PIECES if self.chained else 1
        for i in range(0, len(words), step):
            part = words[i : i + step]
            made = self._parted(self._model(" " + " ".join(part)), len(part))
            self.known.update(zip(part, made or [self._one(" " + u) for u in part]))

    def _others(self, pieces: list[str]) -> None:
        """Learn pieces of any kind, each with the space or newline before it."""
        step = TEXT_PIECES if self.bare else 1
        for i in range(0, len(pieces), step):
            part = pieces[i : i + step]
            spelled = [u if u[0] == "\n" else " " + u for u in part]
            made, text = None, "".join(spelled)
            if step > 1 and not any(s in text for s in self.special):
                [row] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
                made = self._parted(row.ids, len(part))
            self.known.update(zip(part, made or self._direct(spelled)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The serialised ids of every text."""
        # a text's first piece has no space before it and is encoded apart
        heads: list[str] = []
        tails: list[str] = []
        cut: list[int] = []
        for k, text in enumerate(texts):
            head = text
            if self._splittable(text):
                head, _, tail = text.replace("\n", " \n").partition(" ")
                if tail:
                    cut.append(k)
                    tails.append(tail)
            heads.append(head)
        made = self._direct(heads)
        if cut:
            for k, raw in zip(cut, self._pieced(tails)):
                made[k] += raw
        return made

    def _pieced(self, tails: list[str]) -> list[bytes]:
        """The serialised ids of texts made of pieces with a space between them."""
        if len(self.known) > self.remembered:
            self.known, self.earlier = {}, self.known
        lists = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = coded.indices.to_numpy()
        missing = [u for u in pieces if u not in self.known]
        if missing:
            self._learn(missing)
        raws = [self.known[u] for u in pieces]
        sizes = np.fromiter(map(len, raws), np.int64, len(raws)) // self.kind.itemsize
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(raws), self.kind)
        counts = sizes[which]
        ends = np.cumsum(counts)
        # from the place of an id in the texts to its place in ``ids``
        shift = np.repeat(starts[which] - (ends - counts), counts)
        raw = ids[shift + np.arange(len(shift))].tobytes()
        at = [0, *(ends[lists.offsets.to_numpy()[1:] - 1] * self.kind.itemsize).tolist()]
        return [raw[i:j] for i, j in zip(at, at[1:])]

    def _learn(self, missing: list[str]) -> None:
        """Encode new pieces; punctuation after letters only is a piece of its own."""
        known, earlier = self.known, self.earlier
        letters: set[str] = set()
        ended, rest = [], []
        for u in missing:
            if u in earlier:
                known[u] = earlier[u]
            elif u.isalpha():
                letters.add(u)
            else:
                stem = u.rstrip(string.punctuation)
                if len(stem) < len(u) and stem.isalpha():
                    ended.append((u, stem))
                else:
                    rest.append(u)
        for _, stem in ended:
            if stem not in known:
                if stem in earlier:
                    known[stem] = earlier[stem]
                else:
                    letters.add(stem)
        if self.bare:
            self._letters(list(letters))
        else:
            rest += letters
        self._others(rest)
        ends = list({u[len(stem) :] for u, stem in ended})
        spelled = dict(zip(ends, self._direct(ends)))
        for u, stem in ended:
            known[u] = known[stem] + spelled[u[len(stem) :]]

    def _splittable(self, text: str) -> bool:
        if any(s in text for s in self.special):
            return False
        if not text or text[0] in " \n" or text[-1] in " \n":
            return False
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return False
        return not any(c in text for c in _OTHER_SPACES)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there; a path without scheme is a local one."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def _dictionary(docs: DataFrame, doc_id: str, text: str, encoder: Encoder) -> bytes:
    """Trained on short documents among those whose ids have the smallest hashes."""
    mark = F.xxhash64(F.col(doc_id))
    low = docs.select(mark.alias("mark")).orderBy("mark").limit(2 * SAMPLE_DOCUMENTS)
    limit = low.agg(F.max("mark")).first()[0]
    if limit is None:
        return b""
    near = docs.filter(mark <= limit).select(F.col(text).cast("string").alias("t"))
    short = near.filter(f"length(t) BETWEEN 1 AND {SAMPLE_CHARACTERS}")
    samples = encoder.encode([row["t"] for row in short.limit(SAMPLE_DOCUMENTS).collect()])
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few for the training: their plain content serves as well
        return b"".join(samples)[-DICTIONARY_BYTES:]


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None,
    doc_id: str = "doc_id",
    text: str = "text",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the ids of every text below ``folder`` (new or empty); the manifest table.

    ``end_id`` is appended to every document. ``doc_id`` is an integer column; documents are
    ordered by it, nulls first, repeated ids by the hash of their text, and every row is a
    document of its own. A null text is an empty one: it holds the end id only. Other columns
    are not stored.

    The texts are shuffled once, into ranges of ids and hashes that split even a repeated id;
    each task encodes and writes one file, document by document, under a temporary name that
    takes its final name at the end, so that a task may run again or twice. The dictionary is
    trained on a sample of ``SAMPLE_DOCUMENTS`` short documents.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    encoder = Encoder(tokenizer)
    dictionary = _dictionary(docs, doc_id, text, encoder)
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/dictionary") as out:
        out.write(dictionary)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // file_bytes))
    ordered = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id"), "tie")
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        encoder = Encoder.shared(tokenizer)
        part = TaskContext.get().partitionId()
        name = f"part-{part:08d}.tok"
        fs, root = filesystem(folder)
        temporary = f"{root}/_{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(temporary) as out:
            made = _Writer(out, encoder.kind, dictionary)
            batch: pa.RecordBatch | None = first
            while batch is not None:
                ids = batch.column("doc_id").to_pylist()
                for key, raw in zip(ids, encoder.encode(batch.column("text").to_pylist())):
                    made.add(key, raw, end_id)
                batch = next(batches, None)
            made.close()
        fs.move(temporary, f"{root}/{name}")
        row = [name, part, made.doc_ids[0], made.doc_ids[-1], len(made.doc_ids)]
        row += [sum(made.counts), made.at]
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        types = [pa.string()] + [pa.int64()] * 6
        arrays = [pa.array([v], t) for v, t in zip(row, types)]
        yield pa.RecordBatch.from_arrays(arrays, names)

    ordered.select("doc_id", "text").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


class _Writer:
    def __init__(self, out, kind: np.dtype, dictionary: bytes):
        self.out, self.kind = out, kind
        self.dictionary = dictionary
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.codec = zstandard.ZstdCompressor(level=3, dict_data=shared)
        self.at = 0
        self.offsets: list[int] = []
        self.counts: list[int] = []
        self.doc_ids: list[int | None] = []
        self._put(MAGIC)

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def add(self, doc_id: int | None, raw: bytes, end_id: int | None) -> None:
        if end_id is not None:
            raw += np.array([end_id], self.kind).tobytes()
        self.offsets.append(self.at)
        self.counts.append(len(raw) // self.kind.itemsize)
        self.doc_ids.append(doc_id)
        self._put(self.codec.compress(raw))

    def close(self) -> None:
        index = self.at
        self._put(np.array([*self.offsets, index], "<u8").tobytes())
        self._put(np.array(self.counts, "<u8").tobytes())
        self._put(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self._put(np.array([d is None for d in self.doc_ids], "u1").tobytes())
        footer = self.at
        about = {
            "documents": len(self.counts),
            "ids": sum(self.counts),
            "id_bytes": self.kind.itemsize,
            "dictionary_sha256": _digest(self.dictionary),
        }
        self._put(json.dumps(about).encode())
        self._put(struct.pack("<QQ", index, footer))


def _digest(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest() if dictionary else ""


class Reader:
    """One token file, of which single documents can be read."""

    def __init__(self, source, size: int, dictionary: bytes):
        self.source = source
        if self._get(0, 8) != MAGIC:
            raise ValueError("not a token file")
        index, footer = struct.unpack("<QQ", self._get(size - 16, size))
        about = json.loads(self._get(footer, size - 16))
        if about["dictionary_sha256"] != _digest(dictionary):
            raise ValueError("the dictionary is not the one this file was written with")
        n = about["documents"]
        self.kind = np.dtype(f"<u{about['id_bytes']}")
        raw = io.BytesIO(self._get(index, footer))
        self.offsets = np.frombuffer(raw.read(8 * (n + 1)), "<u8")
        self.counts = np.frombuffer(raw.read(8 * n), "<u8")
        self.doc_ids = np.frombuffer(raw.read(8 * n), "<i8")
        self.nulls = np.frombuffer(raw.read(n), "u1").astype(bool)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.codec = zstandard.ZstdDecompressor(dict_data=shared)

    def _get(self, start: int, end: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(end) - int(start))

    def ids(self, k: int) -> np.ndarray:
        """The ids of the ``k``-th document."""
        frame = self._get(self.offsets[k], self.offsets[k + 1])
        ids = np.frombuffer(self.codec.decompress(frame), self.kind)
        if len(ids) != self.counts[k]:
            raise ValueError("a frame does not hold the ids the index states")
        return ids


def _opened(folder: str, name: str, dictionary: bytes) -> Reader:
    fs, root = filesystem(folder)
    path = f"{root}/{name}"
    return Reader(fs.open_input_file(path), fs.get_file_info(path).size, dictionary)


def _read_dictionary(folder: str) -> bytes:
    fs, root = filesystem(folder)
    with fs.open_input_stream(f"{root}/dictionary") as source:
        return source.read()


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of all documents of this id: a few small reads, no scan of a file."""
    rows = manifest(spark, folder).filter(F.lit(doc_id).between(F.col("first_doc"), F.col("last_doc")))
    dictionary, found = _read_dictionary(folder), []
    for row in rows.orderBy("part").toLocalIterator():
        file = _opened(folder, row["file"], dictionary)
        hits = np.flatnonzero((file.doc_ids == doc_id) & ~file.nulls)
        found += [file.ids(int(k)) for k in hits]
    return found


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document: id, ids of all documents before it, their number, their CRC.

    ``ids_crc32`` is taken over the ids as little-endian unsigned 32-bit integers. The files are
    read back, one task per file; only the manifest (a row per file) is put in one order to find
    where each file starts.
    """
    files = manifest(spark, folder).selectExpr(
        "file",
        "part",
        "coalesce(sum(n_ids) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS base",
    )
    dictionary = _read_dictionary(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(*(batch.column(c).to_pylist() for c in ("file", "base"))):
                file = _opened(folder, name, dictionary)
                n = len(file.counts)
                counts = file.counts.astype(np.int64)
                crc = [zlib.crc32(file.ids(k).astype("<u4").tobytes()) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids, pa.int64(), mask=file.nulls),
                        pa.array(base + np.cumsum(counts) - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    tasks = max(1, spark.sparkContext.defaultParallelism)
    spread = files.repartition(tasks, "part").select("file", "base")
    return spread.mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
