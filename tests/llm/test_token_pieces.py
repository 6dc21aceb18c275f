"""The piece encoder against the whole tokenizer."""

import numpy as np

from sensorstream.llm import token_files as T

BLANKS = ["a\tb\nc\x0bd\x0ce\rf  g", "\t\n", "", " x ", "A\r\n\r\nB"]
OTHERS = ["x\x1cy\x85z\xa0w", "Été À'S don't İı ſ 12,345.6", "日本語 テ <|end|> q", "a­b ¡¿ÿĀ"]


def test_pieces_have_the_ids_of_the_whole_text():
    import public_tokenizers

    e = T.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"), "uint16")
    for text, got in zip(BLANKS + OTHERS, e.encode(BLANKS + OTHERS), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_every_blank_and_nothing_else_becomes_a_space():
    assert T._spaced("a\tb\nc\x0bd\x0ce\rf g") == "a b c d e f g"
    assert T._spaced("x\x1cy\x85z\xa0w") == "x\x1cy\x85z\xa0w"
