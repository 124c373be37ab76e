"""SentencePiece agenda and token files against the libraries, byte for byte."""

import gc
import hashlib
import io
import itertools
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import common, near_dedup, piece_bpe, token_files

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab c  d▁\n\t\x00é漢😀' 　'll12,.<0x0A>zqthe "
ODD = ["", " ", "  ", "\n", "a\n\nb", " a", "a ", "<s></s><unk>", "<|endoftext|>", "the" * 3000, "a" * 5000, " " * 300, "\r\n x", "don't  stop\n  here"]
pytestmark = pytest.mark.filterwarnings("ignore")


def odd_texts(n=400):
    rng = random.Random(4)
    return ODD + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 120))) for _ in range(n)]


def test_agenda_equals_the_library():
    texts = odd_texts()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = [[i for ids, _ in parts for i in ids] for parts in piece_bpe.encode_texts(texts, MODEL)]
    assert own == library.encode(texts)


def test_heap_and_batch_agendas_agree():
    model = piece_bpe.vocabulary(MODEL)
    segments = [s for t in odd_texts(150) for s in model.segments(t) if len(s) <= piece_bpe.SHORT]
    assert model.encode_short(segments) == [model.encode_long(s) for s in segments]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=60))
def test_words_equal_the_tokenizers_library(text):
    encoder = token_files._ENCODERS.setdefault(TOKENIZER, token_files.WordEncoder(TOKENIZER))
    own = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
    assert own == encoder.library.encode(text, add_special_tokens=False).ids


def test_runs_of_white_space_equal_the_library():
    spaces = [" ", "\n", "\xa0", "\t", "\u3000", "\x1c", "\x85"]
    runs = ["".join(r) for n in range(1, 4) for r in itertools.product(spaces, repeat=n)]
    rng = random.Random(17)
    runs += ["".join(rng.choice([" ", " ", *spaces]) for _ in range(rng.randint(4, 6))) for _ in range(1500)]
    texts = [f"{a}{run}{b}" for run in runs for a, b in (("a", "b"), ("", "b."), ("1", ""))]
    library = Tokenizer.from_file(TOKENIZER)
    own = [np.frombuffer(b, "<u4").tolist() for b in token_files.encode_texts(texts, TOKENIZER)]
    assert own == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_files_are_numbered_beyond_five_digits(spark):
    names = ["part-99999-x.txt", "part-100000-x.txt", "part-00002-x.txt", "part-10000-x.txt", "part-1234567-x.txt"]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    assert [r["file"][5:-6] for r in df.orderBy(token_files.file_number("file")).collect()] == ["00002", "10000", "99999", "100000", "1234567"]


def test_added_tokens_are_those_of_a_fresh_tokenizer():
    library = Tokenizer.from_file(TOKENIZER)
    encoder = token_files.WordEncoder(TOKENIZER)
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    rng = random.Random(6)
    parts = ["<|endoftext|>", "<|endoftext", "|>", "a", "word.", " ", "  ", "\n", "é", "don't", "|", "\t"]
    texts = odd_texts(50) + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    own = [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)]
    assert own == [library.encode(t, add_special_tokens=False).ids for t in texts]


def frame(spark):
    rows = [(7, "b"), (3, None), (5, ""), (None, "null id"), (9, "x" * 20_000), (3, None), (1, "<|endoftext|>")]
    rows += [(10 + k, t) for k, t in enumerate(odd_texts(20))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_digests(spark):
    rows, docs = frame(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def digest(text):
        ids = library.encode(text or "")
        return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())

    found = sorted(map(tuple, piece_bpe.encoding_digests(docs, MODEL).collect()), key=repr)
    assert found == sorted(((d, *digest(t)) for d, t in rows), key=repr)
    assert piece_bpe.encoding_digests(docs.limit(0), MODEL).count() == 0


def test_ids_come_with_all_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "kept"), (2, None, None)], "doc_id long, text string, token_ids string")
    found = piece_bpe.encode_documents(docs, MODEL)
    assert found.columns == ["doc_id", "text", "token_ids", "_token_ids", "decoded"]
    assert [(r["token_ids"], len(r["_token_ids"]), r["decoded"]) for r in found.orderBy("doc_id").collect()] == [("kept", 2, "a b"), (None, 0, "")]


def test_files_read_back(spark):
    rows, docs = frame(spark)
    library = token_files.WordEncoder(TOKENIZER).library
    ids = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]
    found = token_files.token_file_index(docs, TOKENIZER, 2).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in found] == np.r_[0, np.cumsum([r["n_tokens"] for r in found])[:-1]].tolist()
    expected = sorted(((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids), key=repr)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found), key=repr) == expected
    assert token_files.token_file_index(docs.limit(0), TOKENIZER, 2).count() == 0


def packed(documents):
    index, seeks, out = [], [], []
    for doc, ids in documents:
        frames = list(token_files.document_frames(np.array(ids, "<u4").tobytes()))
        for data, plain, check in frames:
            seeks.append((len(data) + len(token_files.SEPARATOR), plain, check))
            out.append(data)
        index.append((doc, True, len(ids), len(frames)))
    return token_files.SEPARATOR.join([*out, *token_files.trailer(index, seeks), b""])


class Counting(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        self.taken += size
        return super().read(size)


def test_a_reader_takes_only_what_it_asks_for(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 1000)
    rng = np.random.default_rng(0)
    documents = [(k, rng.integers(0, 50_000, n)) for k, n in enumerate([5, 0, 1000, 2501, 70_000, 3])]
    content = packed(documents)
    source = Counting(content)
    reader = token_files.TokenFile(source)
    source.taken = 0
    assert [(d, s, i.tolist()) for d, s, i in reader.documents({3})] == [(3, 1005, documents[3][1].tolist())]
    assert source.taken < 12_000 < len(content)
    assert [i.tolist() for _, _, i in reader.documents()] == [i.tolist() for _, i in documents]
    # the whole is a plain zstandard stream too
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True)
    assert stream.read() == b"".join(np.array(i, "<u4").tobytes() for _, i in documents)


def test_a_damaged_frame_is_noticed():
    content = bytearray(packed([(1, range(100)), (2, range(50))]))
    reader = token_files.TokenFile(io.BytesIO(bytes(content)))
    reader.seeks = reader.seeks.copy()
    reader.seeks["check"][0] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        reader.read(0)
    assert reader.read(1).tolist() == list(range(50))


def test_known_words_are_kept_by_their_bytes():
    library = Tokenizer.from_file(TOKENIZER)
    encoder = token_files.WordEncoder(TOKENIZER)
    texts = ["The été, the été! Über... naïve", "one\ntwo;  three", "", "The été, the été! Über... naïve"]
    own = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert own == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.seen and all(type(w) is bytes for w in encoder.seen)
    encoder._learn = lambda new: pytest.fail("known words again") if new else None
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == own


def test_stops_behind_words_are_pieces_of_their_own():
    library = Tokenizer.from_file(TOKENIZER)
    encoder = token_files.WordEncoder(TOKENIZER)
    rng = random.Random(23)
    parts = ["end", "the", "It's", "é", "7", "naïve", ".", ",", "...", "!?", "|", '"', "$", "<|endoftext|>", "<|endoftext|"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(4000)]
    texts = ["The end, the end. The end; end|\nend!", "end.", ".", "a.", "a.b. c", "a.. b."]
    texts += [rng.choice(" \n").join(words[k : k + 8]) for k in range(0, len(words), 8)]
    own = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert own == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert {b" end", b",", b"."} <= set(encoder.seen)
    assert {b" end,", b" end.", b" end;", b" end|", b"end!"}.isdisjoint(encoder.seen)


def test_added_tokens_with_stops_stay_whole(tmp_path):
    for token in ("end.", "<x|", "#a,"):
        library = Tokenizer.from_file(TOKENIZER)
        library.add_tokens([token])
        library.save(str(tmp_path / "added.json"))
        encoder = token_files.WordEncoder(str(tmp_path / "added.json"))
        texts = [f"The {token} is the {token}\n{token} end. Then, {token}"]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [library.encode(texts[0], add_special_tokens=False).ids]


def test_a_worker_keeps_words_of_one_operator_at_a_time():
    pieces = common.worker_cache(("pieces", "model"), dict)
    pieces["word"] = 1
    assert common.worker_cache(("pieces", "model"), dict) is pieces
    near_dedup.word_codes(["some words"])
    assert set(common.worker_cache(("word codes",), dict)) == {"some", "words"} and len(common._KEPT) == 1
    assert common.worker_cache(("pieces", "model"), dict) == {}


def test_remembered_segments_are_small():
    words = ["".join(w) for w in itertools.product("bdlmnrst", "aeiou", "bdlmnrst", "aeiou", "xyz")]
    piece_bpe.encode_texts([" ".join(words)], MODEL)
    kept = common.worker_cache(("pieces", MODEL), dict)
    assert len(kept) >= len(words)
    assert sum(sys.getsizeof(v) for v in kept.values()) < 64 * len(kept)
    assert all(type(v) is bytes for v in kept.values())


def test_batches_are_taken_in_pieces_of_bounded_bytes():
    texts = ["é" * 200_000, None, "", "b" * 700_000, "c" * 900_000, "d" * 2_500_000, None, "e"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["c0", "t"])
    parts = list(piece_bpe._sliced(batch, 1))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 1 << 20 for p in parts)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [r for b in piece_bpe._encoder(MODEL, False, 1)(iter([batch])) for r in b.to_pylist()]
    gc.enable()
    assert [(r["c0"], r["c2"]) for r in rows] == [(k, library.encode(t or "")) for k, t in enumerate(texts)]


def test_verification_lets_go_of_words():
    near_dedup.word_codes(["some words"])
    assert common._KEPT
    codes = pa.array([np.arange(9, dtype=np.uint32).tobytes()], pa.binary())
    names = [pa.array([x]) for x in ("a", "b", "a", "b")]
    batch = pa.RecordBatch.from_arrays([*names, codes, codes], ["leader", "member", "own", "part", "w1", "w2"])
    (found,) = near_dedup._verifier(0.8)(iter([batch]))
    assert found.column(4).to_pylist() == [True] and not common._KEPT
