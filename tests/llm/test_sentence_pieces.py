"""SentencePiece encoding and decoding against the library itself."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as protos

from parityframe.llm import pieces

MODEL = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
ODD = [
    "", " ", "  a", "a  ", " a b ", "a\nb", "a \n b", "\n", "\n\n a", "▁", "a▁ b", "a ▁b ▁", "ﬁ x",
    "日本 鿿\U0001F600 z", "x" * 500, "　a　 b", "é á", "½ ｱ", "\x00 a\x00", "﻿hi",
    "a  b", "¨ ¨", "a\tb \t c", "<s> </s> <0x41> <unk>", "ab ab  ab",
]


def _rule_model() -> bytes:
    """The map of a normalisation rule that the library brings along."""
    made = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    return protos.ModelProto.FromString(made).normalizer_spec.precompiled_charsmap


def _variant(rule=False, fallback=True, user=False, **spec) -> bytes:
    model = protos.ModelProto.FromString(MODEL)
    if rule:
        model.normalizer_spec.precompiled_charsmap = _rule_model()
    if not fallback:
        model.trainer_spec.byte_fallback = False
        for piece in model.pieces:
            piece.type = 1 if piece.type == 6 else piece.type
    if user:
        model.pieces.add(piece="ab ", type=4, score=0)
    for name, value in spec.items():
        setattr(model.normalizer_spec, name, value)
    return model.SerializeToString()


def _texts(n: int) -> list[str]:
    rng = random.Random(3)
    letters = list(" \n▁ab ﬁ½éç日鿿́　¨​\t.,' ­")
    return ODD + ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize(
    "model",
    [
        dict(),
        dict(rule=True),
        dict(rule=True, remove_extra_whitespaces=True),
        dict(remove_extra_whitespaces=True, add_dummy_prefix=False),
        dict(fallback=False),
        dict(user=True, rule=True),
        dict(escape_whitespaces=False),
    ],
    ids=str,
)
def test_ids_and_spans_equal_the_library(model):
    raw = _variant(**model)
    library, encoder = sentencepiece.SentencePieceProcessor(model_proto=raw), pieces.Encoder(raw)
    texts = _texts(400)
    for at in range(0, len(texts), 64):
        part = texts[at : at + 64]
        for text, (start, made) in zip(part, encoder.encode(part)):
            want = library.encode(text, out_type="offset_mapping")
            edges = [int(e) for e in start + np.r_[0, np.cumsum(made[:, 1])]]
            # the library counts characters; every edge of a span lies between two characters
            spans = [
                tuple(len(text.encode()[:e].decode()) for e in pair) for pair in zip(edges, edges[1:])
            ]
            assert made[:, 0].tolist() == want["ids"], text
            assert spans == [tuple(o) for o in want["offsets"]], text


def test_longest_entries_of_the_map():
    rules = pieces.CharacterMap(_rule_model())
    entries = dict(rules.entries())
    assert len(entries) > 1000 and entries["ﬁ".encode()] == b"fi"
    keys = sorted(entries)[:: max(1, len(entries) // 500)]
    for key in keys:
        assert rules.longest(b"x" + key, 1) == (entries[key], len(key))
        longest = max((k for k in entries if (key + b"z").startswith(k)), key=len)
        assert rules.longest(key + b"z", 0) == (entries[longest], len(longest))
    assert rules.longest(b"q", 0) is None and pieces.CharacterMap(b"").longest(b"q", 0) is None


def test_remembered_segments_change_nothing():
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    encoder = pieces.Encoder(MODEL, remembered=3)
    for part in (_texts(50), ["one two three", "two  three four ", "w" * 200 + " one " + "w" * 200]):
        for _ in range(2):
            got = [made[:, 0].tolist() for _, made in encoder.encode(part)]
            assert got == library.encode(part)
    assert not any(len(s) > pieces.REMEMBERED_LETTERS for s in encoder.known)


def test_frames(spark):
    texts = [None, *ODD, "naïve " * 30_000]
    rows = [(k, t, "kept", 7) for k, t in enumerate(texts)] + [(None, "a b", "kept", 7)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text string, ids int").repartition(3)
    made = pieces.encode(docs, MODEL, decoded="decoded")
    assert made.columns == ["doc_id", "text", "_text", "ids", "starts", "ends", "decoded"]
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    found = made.collect()
    assert len(found) == len(rows)
    for r in found:
        ids = library.encode(r["text"] or "")
        assert r["ids"] == ids and r["decoded"] == library.decode(ids) and r["_text"] == "kept"
        raw = (r["text"] or "").encode()
        assert b"".join(raw[a:b] for a, b in zip(r["starts"], r["ends"])) == raw
    again = pieces.decode(made.select("doc_id", "ids", F.col("decoded").alias("want")), MODEL)
    assert again.filter("NOT decoded <=> want").isEmpty()
    nothing = pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), MODEL)
    assert nothing.first()["decoded"] == ""
    assert pieces.encode(docs.limit(0), MODEL).count() == 0
