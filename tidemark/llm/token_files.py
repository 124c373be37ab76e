"""Token ids in seekable binary files.

One file holds the documents of one id range in ascending order:

    document frame, separator, document frame, separator, ...
    index frame, separator, seek table, separator

* Every document's ids (little-endian unsigned 32-bit) are independent
  zstandard frames of at most ``FRAME_IDS`` ids; a document without ids has none.
* The separator is an empty skippable frame. It is what the text writer of
  Spark puts behind each record, so files are written by Spark's own committed
  writers (retries and lost executors leave no torn file) on any file system,
  and stay valid zstandard streams.
* The index is a skippable frame with (doc_id, number of ids, number of
  frames) of every document.
* The trailing seek table has the layout of the public zstandard seekable
  format: compressed size, decompressed size and checksum (low 32 bits of
  XXH64 of the decompressed bytes) per frame, then the number of entries, a
  descriptor and a magic number. Sizes of separators are counted with the
  frame before them.

A reader fetches the end of the file, and then only the frames of the
documents that it was asked for.

Defined cases: a null text counts as empty; an empty text has only the end id;
null ids sort first; repeated rows are written once each; an empty table gives
no file.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Collection, Iterable, Iterator
from itertools import chain, filterfalse
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices_for, stage, staging_path

# Fixed values of the public zstandard frame and seekable formats.
SKIPPABLE_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x8F92EAB1
SEEK_DESCRIPTOR = 0x80  # entries carry checksums

SEPARATOR = struct.pack("<II", SKIPPABLE_MAGIC, 0)
INDEX_MAGIC = SKIPPABLE_MAGIC + 1
SEEK_FRAME_MAGIC = SKIPPABLE_MAGIC + 14
INDEX_ROW = np.dtype([("doc", "<i8"), ("known", "u1"), ("ids", "<u8"), ("frames", "<u4")])
SEEK_ROW = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
FRAME_IDS = 1 << 20
FILE_BYTES = 32 << 20  # text per file
BATCH_BYTES = 4 << 20  # text encoded at a time
REMEMBERED = 1_200_000  # words a worker keeps; beyond, only those of the present texts stay
LEVEL = 1

STOPS = ".,;:!?|"  # marks behind a word that are a piece of their own

# Marks that are in no UTF-8 text.
_CUT, _TEXT_END = b"\xff", b"\xfe"

_COMMON = re.compile(rb"( ?[A-Za-z]+)([.,;:!?|]*)")  # the form of most words
_WORD_STOP = re.compile(rb"[A-Za-z][.,;:!?|][ \n\xff]")
_LETTER, _STOP, _BEHIND = (np.isin(np.arange(256), list(x)) for x in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", STOPS.encode(), b" \n" + _CUT))

_ENCODERS: dict[str, WordEncoder] = {}


def split_words(text: str) -> list[str]:
    """Cuts before blanks and around single line breaks, where the pre-tokenizer starts a piece as well.

    It takes a run of white space as one piece, but for a last blank before a
    word, which goes to the word. So there is a cut before a blank after
    anything but white space, and before one with a word behind it.
    """
    if not text:
        return []
    lines = text.split("\n")
    if not all(line and not line[0].isspace() and not line[-1].isspace() for line in lines):
        return _blank_cut(text)
    out = _blank_cut(lines[0])
    for line in lines[1:]:
        out.append("\n")
        out += _blank_cut(line)
    return out


def _blank_cut(text: str) -> list[str]:
    """Cuts before blanks that have no white space before them, or none behind."""
    words = text.split(" ")
    if words == text.split():  # single blanks are its only white space, and inside
        return [words[0], *[" " + w for w in words[1:]]]
    out, begin, k = [], 0, text.find(" ")
    while k >= 0:
        behind = text[k + 1 : k + 2]
        if k > begin and (not text[k - 1].isspace() or (behind and not behind.isspace())):
            out.append(text[begin:k])
            begin = k
        k = text.find(" ", k + 1)
    out.append(text[begin:])
    return out


class WordEncoder:
    """Ids of words by the tokenizers library, each word's once.

    Most words are letters, perhaps behind a blank and before full stops: one
    piece each for the pre-tokenizer, so the library's model is asked directly.
    All others go through its whole pipeline, also those that hold an added
    token, which the library takes as one id.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Those that letters and stops alone can spell; no other can be in a word that the model is asked for.
        self.spelled = [t for t in self.added if all(c.isalpha() or c in STOPS or c == " " for c in t)]
        self.seen: dict[bytes, bytes] = {}  # by the word's UTF-8: known words need no decoding
        # The letters that stand for bytes, asked from the library: of ASCII, and of second and first bytes of pairs.
        ask = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.byte_letters = {b: ask(chr(b))[0][0] for b in range(0x80)}
        self.byte_letters |= {b: ask(chr(0xC0 | b & 0x3F))[0][0][1] for b in range(0x80, 0xC0)}
        self.byte_letters |= {b: ask(chr((b & 0x1F) << 6))[0][0][0] for b in range(0xC2, 0xE0)}
        self.blank = self.byte_letters[ord(" ")]
        self.direct = (
            self.library.normalizer is None
            and all(self.byte_letters[b] == chr(b) for b in range(0x80) if chr(b).isalpha())
            and all(
                self._model_ids(w) == self.library.encode(w, add_special_tokens=False).ids
                for w in ("the", " the", "Été", " über", "ñá"))
        )
        # A stop between a letter and white space is a piece of its own, unless an added token has it so.
        self.stops_apart = self.direct and not any(_WORD_STOP.search(t.encode() + _CUT) for t in self.added)

    def _model_ids(self, word: str) -> list[int]:
        if word.isascii():
            letters = word.replace(" ", self.blank)
        else:
            letters = word.encode().decode("latin-1").translate(self.byte_letters)
        return [t.id for t in self.library.model.tokenize(letters)]

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    @staticmethod
    def _letters(word: str) -> bool:
        """Latin, Greek and Cyrillic letters behind at most one blank."""
        return word.removeprefix(" ").isalpha() and (word.isascii() or max(word) < "\u0500")

    def _learn(self, words: list[bytes]) -> None:
        seen, rest, common = self.seen, [], _COMMON.fullmatch
        tokenize, blank, pack = self.library.model.tokenize, self.blank, struct.pack
        quick = self.direct and not self.spelled
        for raw in words:
            if quick and (found := common(raw)):
                begin, end = found.groups()
                if begin not in seen:
                    ids = [t.id for t in tokenize(begin.decode().replace(" ", blank))]
                    seen[begin] = pack(f"<{len(ids)}I", *ids)
            else:
                word = raw.decode()
                core = word.rstrip(STOPS)
                if not self.direct or not self._letters(core) or (self.spelled and any(t in word for t in self.spelled)):
                    rest.append(word)
                    continue
                stops = len(word) - len(core)  # stops are one byte each
                begin, end = raw[: len(raw) - stops], raw[len(raw) - stops :]
                if begin not in seen:
                    seen[begin] = self._packed(self._model_ids(core))
            if end:
                if end not in seen:
                    seen[end] = self._packed(self.library.encode(end.decode(), add_special_tokens=False).ids)
                seen[raw] = seen[begin] + seen[end]
        for k in range(0, len(rest), 20_000):
            part = rest[k : k + 20_000]
            for word, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                seen[word.encode()] = self._packed(e.ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        out: list[bytes] = [b""] * len(texts)
        plain = [k for k, t in enumerate(texts) if " ".join(t.split()) == t.replace("\n", " ")]
        if plain:
            for k, ids in zip(plain, self._encode_plain([texts[k] for k in plain]), strict=True):
                out[k] = ids
        odd = sorted(set(range(len(texts))).difference(plain))
        if odd:
            words = [[w.encode() for w in split_words(texts[k])] for k in odd]
            self._know(set(chain.from_iterable(words)))
            for k, w in zip(odd, words, strict=True):
                out[k] = b"".join(map(self.seen.__getitem__, w))
        return out

    def _know(self, present: Collection[bytes]) -> None:
        """``present``: different words."""
        new = list(filterfalse(self.seen.__contains__, present))
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen = {w: self.seen[w] for w in present if w in self.seen}
        self._learn(new)

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Texts with no white space but single blanks and line breaks between words: cut and coded as one column."""
        data = b"".join(t.encode() + _CUT + _TEXT_END + _CUT for t in texts)
        if self.stops_apart:
            raw = np.frombuffer(data, np.uint8)
            apart = np.flatnonzero(_LETTER[raw[:-2]] & _STOP[raw[1:-1]] & _BEHIND[raw[2:]]) + 1
            data = np.insert(raw, apart, _CUT[0]).tobytes()
        cut = data.replace(b" ", _CUT + b" ").replace(b"\n", _CUT + b"\n" + _CUT)
        pieces = pc.split_pattern(pa.array([cut], pa.large_binary()), _CUT).flatten().dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = pieces.indices.to_numpy(zero_copy_only=False)
        self.seen[b""] = self.seen[_TEXT_END] = b""
        self._know(distinct)
        coded = list(map(self.seen.__getitem__, distinct))
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        begins, length = np.cumsum(sizes) - sizes, sizes[at]
        ends = np.cumsum(length)
        ids = np.frombuffer(b"".join(coded), "<u4")
        flat = ids[np.repeat(begins[at] - ends + length, length) + np.arange(int(ends[-1]))]
        stops = ends[at == distinct.index(_TEXT_END)].tolist()
        return [flat[a:b].tobytes() for a, b in zip([0, *stops], stops, strict=False)]


def encode_texts(texts: list[str], tokenizer_file: str) -> list[bytes]:
    """Ids of each text as little-endian 32-bit bytes; a tokenizer is loaded once per worker."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file].encode(texts)


def document_frames(ids: bytes) -> Iterator[tuple[bytes, int, int]]:
    """(compressed frame, plain size, checksum) of a document."""
    packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    for k in range(0, len(ids), 4 * FRAME_IDS):
        part = ids[k : k + 4 * FRAME_IDS]
        yield packer.compress(part), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF


def trailer(index: list[tuple], seeks: list[tuple]) -> Iterator[bytes]:
    """The index frame and the seek table."""
    body = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(np.array(index, INDEX_ROW).tobytes())
    yield struct.pack("<II", INDEX_MAGIC, len(body)) + body
    table = np.array(seeks, SEEK_ROW).tobytes() + struct.pack("<IBI", len(seeks), SEEK_DESCRIPTOR, SEEK_MAGIC)
    yield struct.pack("<II", SEEK_FRAME_MAGIC, len(table)) + table


def _records(batches: Iterable[pa.RecordBatch], tokenizer_file: str, end_id: int) -> Iterator[bytes]:
    index: list[tuple] = []
    seeks: list[tuple] = []
    end = struct.pack("<I", end_id)
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begin = 0
        while begin < len(texts):
            stop, size = begin, 0
            while stop < len(texts) and (stop == begin or size < BATCH_BYTES):
                size += len(texts[stop] or "")
                stop += 1
            for doc, packed in zip(ids[begin:stop], encode_texts([t or "" for t in texts[begin:stop]], tokenizer_file), strict=True):
                frames = list(document_frames(packed + end))
                for frame, plain, check in frames:
                    seeks.append((len(frame) + len(SEPARATOR), plain, check))
                    yield frame
                index.append((doc or 0, doc is not None, len(packed) // 4 + 1, len(frames)))
            begin = stop
    if index:
        yield from trailer(index, seeks)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write the files below ``path``, in ascending id order over files and within them.

    One shuffle by id range, of text; each task then encodes and writes its
    range. The range sample reads only the source, never the encoder. Rows of
    one id are spread by their text and source position, so no id outgrows a file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    n = slices_for(spark, size, file_bytes)
    ordered = (
        rows.withColumn("h", F.xxhash64("t")).withColumn("at", F.monotonically_increasing_id())
        .repartitionByRange(n, "id", "h", "at").sortWithinPartitions("id", "h", "at").select("id", "t")
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for record in _records(batches, tokenizer_file, end_id):
            held.append(record)
            size += len(record)
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])

    (
        ordered.mapInArrow(records, "value binary").select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR.decode("latin-1")).mode("errorifexists").text(path)
    )


class TokenFile:
    """Random access to one file: ``source`` needs only ``seek`` and ``read``."""

    def __init__(self, source: BinaryIO):
        self.source = source
        skip = len(SEPARATOR)
        end = source.seek(0, os.SEEK_END)
        entries, _, magic = struct.unpack("<IBI", self._at(end - skip - 9, 9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table at the end of the file")
        size = entries * SEEK_ROW.itemsize
        self.seeks = np.frombuffer(self._at(end - skip - 9 - size, size), SEEK_ROW)
        self.begins = np.r_[0, np.cumsum(self.seeks["packed"], dtype=np.int64)]
        _, length = struct.unpack("<II", self._at(int(self.begins[-1]), 8))
        self.index = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(self._at(int(self.begins[-1]) + 8, length)), INDEX_ROW)
        self.first = np.r_[0, np.cumsum(self.index["frames"], dtype=np.int64)]

    def _at(self, begin: int, size: int) -> bytes:
        self.source.seek(begin)
        return self.source.read(size)

    def read(self, position: int) -> np.ndarray:
        """Ids of the document at a position of the index; only its own frames are read and decompressed."""
        parts = []
        unpacker = zstandard.ZstdDecompressor()
        for k in range(int(self.first[position]), int(self.first[position + 1])):
            frame = self._at(int(self.begins[k]), int(self.seeks["packed"][k]) - len(SEPARATOR))
            plain = unpacker.decompress(frame, max_output_size=int(self.seeks["plain"][k]))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != int(self.seeks["check"][k]):
                raise ValueError(f"checksum of frame {k} is wrong")
            parts.append(plain)
        return np.frombuffer(b"".join(parts), "<u4")

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, position of its first id in the file, ids) of the wanted documents, or of all."""
        starts = np.cumsum(self.index["ids"]) - self.index["ids"]
        for k, row in enumerate(self.index):
            doc = int(row["doc"]) if row["known"] else None
            if wanted is None or doc in wanted:
                yield doc, int(starts[k]), self.read(k)


def read_token_files(spark: SparkSession, path: str, wanted: set[int] | None = None) -> DataFrame:
    """doc_id, file, start in the file, n_tokens, crc32 of the ids; ``wanted`` limits it to a few documents."""
    import io

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, content = batch.column(0)[k].as_py(), batch.column(1)[k].as_buffer()
                found = [
                    (doc, name.rsplit("/", 1)[-1], start, len(ids), zlib.crc32(ids.tobytes()))
                    for doc, start, ids in TokenFile(io.BytesIO(content)).documents(wanted)
                ]
                columns = list(zip(*found, strict=True)) or [[]] * 5
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    ["doc_id", "file", "file_start", "n_tokens", "ids_crc32"])

    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
        .mapInArrow(parse, "doc_id bigint, file string, file_start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def file_number(name: str) -> Column:
    """The number of the task that wrote a file. Names are padded to five digits only, so they do not sort beyond."""
    return F.regexp_extract(name, r"^part-(\d+)", 1).cast("long")


def token_file_index(
    docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the files to the shared folder, read them back, and give every document's place among all ids.

    doc_id, start (ids of all documents before it), n_tokens, ids_crc32. Files
    are numbered in id order, so a running sum over one row per file is enough.
    """
    spark = docs.sparkSession
    path = staging_path(spark, "token-files")
    write_token_files(docs, path, tokenizer_file, end_id, id_col, text_col)
    found = stage(read_token_files(spark, path), "token-index")
    # One row per file of FILE_BYTES: a thousandth of a per cent of the rows.
    before = found.groupBy("file").agg(F.sum("n_tokens").alias("ids")).select(
        "file", (F.sum("ids").over(Window.orderBy(file_number("file"), "file")) - F.col("ids")).alias("before"))
    return found.join(before, "file").select(
        "doc_id", (F.col("before") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")
