"""Long words without spaces: cut, advanced alone, in small blocks, and with words forgotten in between."""

import random
import time

import numpy as np
import pytest

from tests.llm.test_operators import brute_viterbi
from tidemill.llm import pieces


@pytest.fixture(scope="module")
def model():
    from sentencepiece import sentencepiece_model_pb2 as messages

    model = messages.ModelProto()
    model.ParseFromString(open(pieces.MODEL, "rb").read())
    return model


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary()


BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def unspaced(seed):
    r = random.Random(seed)
    sorts = [
        [chr(c) for c in range(0x4E00, 0x9FFF)],
        [chr(c) for c in range(0x4E00, 0x4E80)],
        [chr(c) for c in range(0x3041, 0x30FF)],
        [chr(c) for c in range(0x0E01, 0x0E3A)],
        list(BASE64),
        list("abeinrst"),
        ["x"],
        list("ab日\U0001f9ff\x01"),
    ]
    texts = ["".join(r.choice(sort) for _ in range(r.choice([63, 64, 65, 200, 700]))) for sort in sorts for _ in range(4)]
    return texts + ["".join(texts[:9]), f"a {texts[0]} b  {texts[16]}", texts[0]]


def encode(encoder, texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    ids, places = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [ids[a:b].tolist() for a, b in zip(places[:-1], places[1:])]


@pytest.mark.parametrize(("long", "many", "block"), [(64, 32, 1 << 15), (64, 1000, 37), (8, 1, 37), (1 << 20, 32, 37)])
def test_long_words_equal_brute_force(model, vocabulary, monkeypatch, long, many, block):
    for name, value in {"LONG": long, "MANY": many, "BLOCK": block}.items():
        monkeypatch.setattr(pieces, name, value)
    texts = unspaced(long + many)
    assert encode(pieces.Encoder(vocabulary), texts) == [brute_viterbi(model, t) for t in texts]


def test_words_forgotten_between_slices(model, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 20)
    encoder, texts = pieces.Encoder(vocabulary), unspaced(5)
    wanted = [brute_viterbi(model, t) for t in texts]
    for k in range(0, len(texts), 3):
        assert encode(encoder, texts[k : k + 3]) == wanted[k : k + 3]
        assert len(encoder.known) == len(encoder.slots) == len(encoder.places) - 1
        assert len(encoder.pieces) == encoder.places[-1]
    assert encode(encoder, texts) == wanted


def test_unspaced_text_takes_no_step_of_all_words_per_byte(vocabulary):
    r = random.Random(3)
    for sort in ([chr(c) for c in range(0x4E00, 0x9FFF)], list(BASE64)):
        text = "".join(r.choice(sort) for _ in range(90_000 // len(sort[0].encode())))
        began = time.process_time()
        (ids,) = encode(pieces.Encoder(vocabulary), [text])
        assert time.process_time() - began < 2  # 0.1 s on an idle machine; byte by byte 5 to 9 s
        back, edges = pieces.Encoder(vocabulary).decode(np.array(ids, np.int32), np.array([0, len(ids)]))
        assert back.tobytes().decode() == text
