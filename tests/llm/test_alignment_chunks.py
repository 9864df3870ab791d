"""Chunks of texts are encoded once, and give the tokens of the whole text."""

import pyarrow as pa
import public_tokenizers
import pytest

from calforge.llm import alignment
from calforge.llm.queries import ALIGNED

MODELS = [alignment.model_of(public_tokenizers.path(name)) for name in ALIGNED]
ODD = ["a\n b", " lead", " two  blanks  inside ", " \n x", "tab\t y   z", "ideographic　 w", "a \x1c b", "it's  we'll 'll", "  ", "\n",
       "a ᠎ b", "É ü 漢字 漢 字", "👍🏽 ok 👍", "<|endoftext|> <s> </s> <0x0A> <unk>", "a\u0085 b", "﻿ mark", "1 22 333 a1 b-2 .5 ... ", "x\x00 y"]


class Sent:
    def __init__(self, value):
        self.value = value


def _rows(texts):
    batch = pa.RecordBatch.from_pydict({"row": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    return [r for out in alignment._aligner(*map(Sent, MODELS))([batch]) for r in out.to_pylist()]


def test_a_word_is_encoded_once_however_often_it_comes(monkeypatch):
    chars = []
    for name in ("_byte_level", "_pieces"):
        side = getattr(alignment, name).__wrapped__(MODELS[name == "_pieces"])

        def counted(texts, encode=side.encode):
            chars.extend(map(len, texts))
            return encode(texts)

        side.encode = counted
        monkeypatch.setattr(alignment, name, lambda model, side=side: side)
    text = " ".join(f"word{i} or" for i in range(300))
    rows = _rows([text] * 50)
    assert len({r["groups_sha256"] for r in rows}) == 1 and rows[0]["n_groups"] >= 600
    assert sum(chars) < 4 * len(text)


@pytest.mark.parametrize("text", ODD)
def test_chunks_give_the_tokens_of_the_whole_text(text):
    sides = alignment._byte_level(MODELS[0]), alignment._pieces(MODELS[1])
    whole, *got = alignment._both(alignment._Chunks(*sides), [text, "other words", text])
    assert whole.tolist() == [True] * 3
    for side, tokens in zip(sides, got, strict=True):
        ids = side.encode([text])[0]
        assert tokens.id[:len(ids)].tolist() == tokens.id[len(tokens.id) - len(ids):].tolist() == ids
        assert tokens.n.tolist()[::2] == [len(ids)] * 2


def test_only_the_text_that_does_not_come_back_has_no_tokens():
    rows = _rows(["plain words here", "plain ▁ words here", None, "", "▁", "plain words here"])
    assert [r["n_a"] > 0 for r in rows] == [True, False, False, False, False, True]
