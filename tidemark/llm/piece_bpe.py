"""SentencePiece encoding and decoding with an own merge agenda.

A merge-type (BPE) model is encoded by an agenda of adjacent symbol pairs: the
pair whose merged piece has the best score is merged first, the leftmost of
equals first, until no adjacent pair forms a piece. Two forms of the agenda:

* many short segments at once: one agenda row per segment, kept in flat numpy
  arrays; each round takes every segment's best pair;
* one long segment: a heap of scored pairs over a linked list of symbols.

Text is cut into segments where a character is followed by the blank symbol,
and at line breaks. No piece reaches across such a place (``MergeVocabulary`` proves this for the
loaded model and keeps the text whole otherwise), so segments are independent
and each distinct one is encoded once per worker.

Every distinct segment is compared, in Arrow batches, with the sentencepiece
library, and the library's ``decode`` turns the ids of each document back into
text. A difference stops the job.

Defined cases: a null text counts as empty, an empty text has no ids; null ids
and repeated rows pass through; characters outside the vocabulary become byte
pieces (or the unknown id where the model has none); further columns are kept
only where asked for.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_names, release_freed, worker_cache

BLANK = "▁"
BREAK = "\n"
SHORT = 60  # characters up to which segments share a batch agenda
REMEMBERED = 300_000  # segments a worker keeps; beyond, only those of the present texts stay
BATCH_BYTES = 1 << 20  # text taken from an Arrow batch at a time; its segments take some twenty times that
LEARNED = 5_000  # segments encoded at a time
NEVER = np.iinfo(np.int64).max


class MergeVocabulary:
    """Pieces, scores and pair table of a merge-type model, with the agenda."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = sp.get_piece_size()
        self.unknown = sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(self.size)]
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        normal = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not sp.is_byte(i) for i in self.byte_ids):
            self.byte_ids = None
        letters = sorted({c for p in normal for c in p} - set(normal))
        symbols = normal | {c: self.size + k for k, c in enumerate(letters)}
        self.outside = self.size + len(letters)  # the symbol of all other characters; it never merges
        self.symbol_of = np.full(0x110000, self.outside, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        self.width = self.outside + 1
        self.pairs = {
            symbols[p[:k]] * self.width + symbols[p[k:]]: i
            for p, i in normal.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols
        }
        scores = np.array([sp.get_score(i) for i in range(self.size)])
        self.order = np.unique(-scores, return_inverse=True)[1].astype(np.int64)  # 0: merged first
        self._build_table()
        self.cut = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in normal)
        # A line break that is in no piece never merges, so lines are independent too.
        self.lines = self.cut and self.byte_ids is not None and self.symbol_of[ord(BREAK)] == self.outside
        self.ints = np.arange(self.width, dtype=object)  # one object per id, shared by all lists
        self.texts = [str(i) for i in range(self.size)]

    def _build_table(self) -> None:
        """Pair -> merged symbol as an open hash table, at most an eighth full."""
        self.bits = max(8, int(np.ceil(np.log2(8 * max(1, len(self.pairs))))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, -1, np.int32)
        keys = np.fromiter(self.pairs.keys(), np.int64, len(self.pairs))
        values = np.fromiter(self.pairs.values(), np.int32, len(self.pairs))
        self.probes = 0
        slot = self._slot(keys)
        while keys.size:
            free = self.keys[slot] < 0
            first = np.zeros(keys.size, bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.merged[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged symbol of each pair, -1 where there is none."""
        keys = left.astype(np.int64) * self.width + right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.merged[slot], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        for _ in range(self.probes):
            if not open_.size:
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.merged[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def _ranks(self, merged: np.ndarray) -> np.ndarray:
        return np.where(merged >= 0, self.order[merged], NEVER >> 8)

    def encode_short(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments of at most ``SHORT`` characters, one merge of each per round."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        symbol, code = self.symbol_of[codes].astype(np.int64), codes
        owner = np.repeat(np.arange(len(segments)), sizes)
        merged = np.full(symbol.size, -1, np.int64)
        inner = np.flatnonzero(owner[1:] == owner[:-1]) if symbol.size else np.zeros(0, np.int64)
        merged[inner] = self._merge_of(symbol[inner], symbol[inner + 1])
        rank = self._ranks(merged)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while symbol.size:
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, symbol.size])
            place = np.arange(symbol.size) - np.repeat(starts, sizes)
            best = np.minimum.reduceat(rank * 64 + place, starts)
            alive = best < (NEVER >> 8) * 64
            if not alive.all():
                over = np.repeat(~alive, sizes)
                done.append((owner[over], symbol[over], code[over]))
                going = ~over
                owner, symbol, code, merged, rank = owner[going], symbol[going], code[going], merged[going], rank[going]
                sizes, best = sizes[alive], best[alive]
                starts = np.cumsum(sizes) - sizes
                if not symbol.size:
                    break
            at = starts + best % 64
            symbol[at] = merged[at]
            keep = np.ones(symbol.size, bool)
            keep[at + 1] = False
            owner, symbol, code, merged, rank = owner[keep], symbol[keep], code[keep], merged[keep], rank[keep]
            at -= np.arange(at.size)  # one symbol went from every earlier segment
            for k in (at - 1, at):  # the pairs that the new symbol forms
                k = k[(k >= 0) & (k + 1 < symbol.size)]
                same = owner[k] == owner[k + 1]
                k = k[same]
                merged[k] = self._merge_of(symbol[k], symbol[k + 1])
                rank[k] = self._ranks(merged[k])
            last = at[(at + 1 == symbol.size) | (owner[np.minimum(at + 1, symbol.size - 1)] != owner[at])]
            merged[last], rank[last] = -1, NEVER >> 8
        return self._gathered(done, len(segments))

    def _gathered(self, done: list, n: int) -> list[list[int]]:
        if not done:
            return [[] for _ in range(n)]
        owner, symbol, code = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        owner, symbol, code = owner[order], symbol[order], code[order]
        ends = np.searchsorted(owner, np.arange(n), side="right")
        odd = set(owner[symbol >= self.size].tolist())
        flat = self.ints[symbol].tolist()
        begins = [0, *ends[:-1].tolist()]
        out = [flat[b:e] for b, e in zip(begins, ends.tolist(), strict=True)]
        for i in odd:
            out[i] = [x for k in range(begins[i], ends[i]) for x in self._ids(flat[k], chr(int(code[k])))]
        return out

    def _ids(self, symbol: int, char: str) -> list[int]:
        """A symbol's ids: itself, or bytes for what is no piece."""
        if symbol < self.size:
            return [symbol]
        if self.byte_ids is None:
            return [self.unknown]
        return [self.byte_ids[b] for b in char.encode()]

    def encode_long(self, segment: str) -> list[int]:
        """Ids of one segment by a heap of scored pairs; n log n in its length."""
        symbol = self.symbol_of[np.frombuffer(segment.encode("utf-32-le"), np.uint32)].tolist()
        n = len(symbol)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            merged = self.pairs.get(symbol[left] * self.width + symbol[right])
            if merged is not None:
                heapq.heappush(agenda, (int(self.order[merged]), left, right, symbol[left], symbol[right]))

        for k in range(n - 1):
            offer(k, k + 1)
        while agenda:
            _, left, right, first, second = heapq.heappop(agenda)
            if symbol[left] != first or symbol[right] != second or after[left] != right:
                continue  # one of the two was merged meanwhile
            symbol[left] = self.pairs[first * self.width + second]
            symbol[right] = -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return list(chain.from_iterable(self._ids(s, segment[k]) for k, s in enumerate(symbol) if s >= 0))

    def encode(self, segments: list[str]) -> list[list[int]]:
        short = [s for s in segments if len(s) <= SHORT]
        found = dict(zip(short, self.encode_short(short), strict=True)) if short else {}
        return [found[s] if len(s) <= SHORT else self.encode_long(s) for s in segments]

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        text = BLANK + text.replace(" ", BLANK)
        if not self.cut:
            return [text]
        out: list[str] = []
        for n, line in enumerate(text.split(BREAK) if self.lines else [text]):
            if n:
                out.append(BREAK)
            if BLANK + BLANK in line:
                out += re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", line)
            else:
                head, *rest = line.split(BLANK)
                if head:
                    out.append(head)
                out += [BLANK + w for w in rest]
        return out

    def checked(self, segments: list[str]) -> list[list[int]]:
        """Encode and compare with the library."""
        own = self.encode(segments)
        # The library puts a blank in front. What starts a line is given to it behind a line break, and a lone
        # blank, the one segment that it can't be given, is the piece of that name.
        inner = [not s.startswith(BLANK) for s in segments]
        theirs = self.library.encode(
            [BREAK + s if i else s[1:] for s, i in zip(segments, inner, strict=True)], num_threads=1)
        for k, (s, i) in enumerate(zip(segments, inner, strict=True)):
            if i:
                theirs[k] = theirs[k][2:]
            elif s == BLANK:
                theirs[k] = [self.library.piece_to_id(s)]
        if own != theirs:
            s = next(s for s, a, b in zip(segments, own, theirs, strict=True) if a != b)
            raise ValueError(f"the merge agenda and the sentencepiece library disagree on {s!r}")
        return own


_LOADED: dict[str, MergeVocabulary] = {}


def vocabulary(model_file: str) -> MergeVocabulary:
    """The model, loaded once per worker process."""
    if model_file not in _LOADED:
        _LOADED[model_file] = MergeVocabulary(model_file)
        if _LOADED[model_file].library.normalize("a  b") != f"{BLANK}a{BLANK}{BLANK}b":
            raise ValueError("only models that keep the text as it is are supported")
    return _LOADED[model_file]


def _packed(texts: list[str], model_file: str) -> list[list[bytes]]:
    """Per text its segments' ids as 32-bit numbers: a fraction of what lists of them take."""
    model = vocabulary(model_file)
    seen: dict[str, bytes] = worker_cache(("pieces", model_file), dict)
    cut = [model.segments(t) for t in texts]
    present = set(chain.from_iterable(cut))
    new = list(present.difference(seen))
    if len(seen) + len(new) > REMEMBERED:
        kept = {s: seen[s] for s in present.intersection(seen)}
        seen.clear()
        seen.update(kept)
    for k in range(0, len(new), LEARNED):
        part = new[k : k + LEARNED]
        found = model.checked(part)
        flat = np.fromiter(chain.from_iterable(found), np.int32).tobytes()
        ends = (4 * np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))).tolist()
        seen.update((s, flat[b:e]) for s, b, e in zip(part, [0, *ends], ends, strict=False))
    return [list(map(seen.__getitem__, segments)) for segments in cut]


def encode_texts(texts: list[str], model_file: str) -> list[list[tuple[list[int], str]]]:
    """Per text its segments' (ids, ids joined by commas)."""
    text_of = vocabulary(model_file).texts.__getitem__
    found = [[np.frombuffer(p, np.int32).tolist() for p in parts] for parts in _packed(texts, model_file)]
    return [[(ids, ",".join(map(text_of, ids))) for ids in parts] for parts in found]


def _sliced(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of bounded text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    sizes = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
    begin, spent = 0, 0
    for k, size in enumerate(sizes):
        if size - spent > BATCH_BYTES and k > begin:
            yield batch.slice(begin, k - begin)
            begin, spent = k, sizes[k - 1]
    if batch.num_rows > begin:
        yield batch.slice(begin)


def _encoder(model_file: str, digests: bool, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(model_file)
        gc.disable()  # nothing here makes cycles, and the remembered segments would be walked again and again
        for whole in batches:
            for batch in _sliced(whole, column):
                packed = [b"".join(p) for p in _packed([t or "" for t in batch.column(column).to_pylist()], model_file)]
                flat = np.frombuffer(b"".join(packed), np.int32)
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
                numbers = model.ints[flat].tolist()
                ids = [numbers[b:e] for b, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                decoded = model.library.decode(ids, num_threads=1) if ids else []
                kept = list(batch.columns)
                if digests:
                    joined = (",".join(map(model.texts.__getitem__, i)) for i in ids)
                    new = [
                        pa.array(np.diff(ends), pa.int64()),
                        pa.array([hashlib.sha256(s.encode()).hexdigest() for s in joined], pa.string()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                    ]
                    kept.pop(column)
                else:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                    new = [lists, pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([*kept, *new], [f"c{k}" for k in range(len(kept) + len(new))])
        release_freed()

    return run


def encode_documents(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """All columns plus ``token_ids`` (array of int) and ``decoded`` (the ids turned back into text)."""
    ids, decoded = fresh_names(docs, "token_ids", "decoded")
    column = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    kinds = ", ".join(f"{c} {t}" for c, t in plain.dtypes)
    n = len(docs.columns)
    out = plain.mapInArrow(_encoder(model_file, False, column), f"{kinds}, c{n} array<int>, c{n + 1} string")
    return out.toDF(*docs.columns, ids, decoded)


def encoding_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, number of ids, SHA-256 of the ids joined by commas and of the decoded text."""
    rows = docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("t"))
    kind = dict(rows.dtypes)["c0"]
    out = rows.mapInArrow(_encoder(model_file, True, 1), f"c0 {kind}, c1 bigint, c2 string, c3 string")
    return out.toDF(id_col, "n_tokens", "ids_sha256", "decoded_sha256")
