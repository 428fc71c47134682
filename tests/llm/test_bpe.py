import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tests.llm.helpers import frame, mixed_rows, prose
from tokenizers import Tokenizer
from tripmart.llm import bpe

PIECES = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "'s", "'ll", "12", " 3", "<|endoftext|>", "!!", "　", "日本", "🙂", "\x1c", "\r\n", ".", " <|endoftext|> "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def rows():
    rng = random.Random(5)
    shared = "".join(rng.choice(PIECES) for _ in range(2000))
    made = ["".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 5, 50, 3000]))) for _ in range(120)]
    made += [shared, "x " + shared, shared + " y", "a" * 50_000, " " * 20_000, "\n" * 5000 + "x", "ab " * 20_000]
    return mixed_rows() + [(100 + k, t) for k, t in enumerate(made)]


def test_round_trip_equals_the_library(spark, library):
    expected = []
    for doc_id, text in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    out = bpe.round_trip_report(frame(spark, rows()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_encode_and_decode_keep_the_text(spark):
    encoded = bpe.encode(frame(spark, rows()))
    back = sorted(((r.doc_id, r.text) for r in bpe.decode(encoded).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t in rows()), key=str)
    assert bpe.round_trip_report(frame(spark, [])).collect() == []


def test_shared_chunks_are_encoded_once():
    text = prose(random.Random(1), 2000).encode()
    tokenizer = bpe.ByteBpe(bpe._content(None))
    data = np.frombuffer(text * 20, np.uint8)
    offsets = np.arange(21) * len(text)
    ends = bpe.chunk_ends(data, offsets, mean_chunk=256)
    assert len({tuple(e) for e in ends}) == 1 and len(ends[0]) > 3
    first = tokenizer.encode(text, ends[0])
    once = tokenizer.encoded_bytes
    assert all(tokenizer.encode(text, e) == first for e in ends[1:])
    assert once >= len(text)
    assert tokenizer.encoded_bytes - once < 19 * 0.1 * len(text)  # 19 more documents cost their joins only


def test_the_library_of_the_encoder_agrees_on_every_vocabulary_entry(library):
    tokenizer = bpe.ByteBpe(bpe._content(None))
    for piece in tokenizer.pieces[:50_256:7]:
        try:
            text = piece.decode()
        except UnicodeDecodeError:
            continue
        assert np.frombuffer(tokenizer.plain(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
