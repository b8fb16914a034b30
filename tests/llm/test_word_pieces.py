"""Ids of texts by remembered words against the tokenizer on whole texts."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldwatch.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \t\n", "don't. it's' x'. É... ΟΔΟΣ. á. é, x̸= ×. 漢字、。 。. 3.14. 3.. x|y>. café's. 'tis! co-op- ». a».", "<|endoftext|>. <|endoftext|>x. a<|startoftext|>! <|endoftext|", "x\u00a0y. x\u2028y.",
    "ı. İ. ǅ, ﬁ. क़. ड़! e\u0301. e\u0301\u0323, \u0301. 한. 각.", "x" * 5000 + "...", "!!! ??? ... a!b!c! A.B.C.", "the, the. the! The, THE; the\tthe", "H\u0331 J\u030c W\u030a A\u0301 \u212a K", "<|ENDOFTEXT|> <|EndOfText|>", "ABC< |D|> E>, F|.",
]


@pytest.mark.parametrize("limit", [300_000, 3])
def test_ids_of_whole_texts(spark, sf_dir, monkeypatch, limit):
    """Also where what is remembered is soon forgotten."""
    monkeypatch.setattr(packing.WordIds, "LIMIT", limit)
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    whole, words = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    got = [ids for k in range(0, len(texts), 7) for ids in words.ids(texts[k : k + 7])]
    assert got == [np.asarray(whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert got == words.ids(texts)
