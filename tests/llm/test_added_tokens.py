"""Strings of added tokens in a text, against a plain call of the library."""

from __future__ import annotations

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from helixframe.llm import tokenfile, tokens

TEXTS = ["a<|endoftext|>b", "<|endoftext|>", "x <|startoftext|> y's <|endoftext|><|endoftext|> 日", "<|ENDOFTEXT|> plain", "<|end", "", "nothing"]


@pytest.mark.parametrize(("name", "kind", "last"), [("byte_bpe_50k.json", tokens.ByteEncoder, 50256), ("word_bpe_49k.json", tokens.WordEncoder, 49407)])
def test_added_tokens_are_single_ids(name, kind, last):
    t = Tokenizer.from_file(P.path(name))
    got = [np.frombuffer(x, "<u4").tolist() for x in kind(P.path(name)).encode(TEXTS)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in TEXTS]
    assert got[1] == [last]


def test_token_file_holds_added_tokens(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in tokenfile.op7_token_file(spark, str(tmp_path)).collect()}
    counted = next(c for c in next(iter(rows.values())).asDict() if c in ("n_tokens", "length", "tokens"))
    own = len(t.encode("nothing", add_special_tokens=False).ids)
    for k, text in enumerate(TEXTS):
        assert rows[k][counted] - rows[6][counted] == len(t.encode(text, add_special_tokens=False).ids) - own
