import hashlib
import random

import llm_brute as B
import numpy as np
import pytest
from tokenizers import Tokenizer

from wardline.llm import bpe
from wardline.llm.registry import WORD_BPE


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD_BPE)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(WORD_BPE)


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


HARD = ["", "  ", "don't I'LL we've 12345 ½²", "a" * 3000, "ab" * 2000 + "!!!" * 100, "_" * 400 + "=" * 900,
        "ΑΣ ΟΔΟΣ İstanbul ǅ ﬁ é é", "<|endoftext|>hi<|startoftext|>x<|end", "\x1ca\x1db\x85c d​e",
        "한국어 日本語テキスト 😀👩‍👩‍👧", "the" * 2000, "x\x00y �", "'s't're", "antidisestablishmentarianism" * 40]


def test_equals_the_library(codec, library):
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice("abetinor 's.,!#é") for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += ["".join(rng.choice("etaoin") for _ in range(rng.randrange(20, 400))) for _ in range(60)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(codec, text) == want, text[:50]
        assert codec.joined(want) == library.decode(want, skip_special_tokens=False)


def test_tokens_leave_before_the_word_ends(codec):
    rng = random.Random(2)
    word = "".join(rng.choice("etaoinshr") for _ in range(4000))
    t = bpe.Transducer(codec.m)
    pieces, held = [], 0
    for piece in t.word(word):
        pieces += piece
        held = max(held, len(t.text))
    assert len([p for p in pieces]) > 100 and held <= 4 * codec.m.lookahead
    assert pieces == ids(codec, word)


def test_text_decoder_is_incremental(codec):
    d = bpe.TextDecoder(codec)
    text = "".join(d.push(i) for i in ids(codec, "Héllo wörld 日本 😀 <|endoftext|>")) + d.finish()
    assert text == "héllo wörld 日本 😀 <|endoftext|>"


def test_table(spark, library):
    rows = B.EDGES + list(enumerate(HARD, 100))
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in bpe.encode(B.documents(spark, rows), WORD_BPE).collect()), key=str)
    want = []
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode(B.documents(spark, []), WORD_BPE).collect() == []
