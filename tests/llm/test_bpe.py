import random

import numpy as np
import pytest

from weftline.llm import bpe

PATH = bpe.default_path()
TEXTS = [
    None,
    "",
    "Hello   World's they've I'M 123 !!!??",
    "a<|endoftext|>B <|startoftext|><|endoftext|>x <|endof",
    "ΣΑΣ Σ İstanbul ǅ ﬁ é é  x y\x1cz\x85q 日本語テスト 😀😀",
    "aaaaaaaaaaaaa" * 3 + " " + "ab" * 400 + " " + "z" * 700,
    "\x00\x01 \x1f\x1e  \t\r\n",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check(texts, library):
    vocab = bpe.vocabulary(PATH)
    for text, packed in zip(texts, vocab.encode(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == want, text
        assert vocab.decode(packed) == library.decode(want, skip_special_tokens=False)


def test_equal_to_the_library(library):
    check(TEXTS, library)


def test_random_words(library):
    rng = random.Random(5)
    letters = "aaeeiinorstlé'’-09 .ß漢\n"
    check(["".join(rng.choice(letters) for _ in range(rng.randrange(400))) for _ in range(300)], library)


def test_letters_of_newer_unicode(library):
    check(["a\u1c89B \ua7cbx y", "x\u0558\U00010d50\U00010d70 <|endoftext|> z", "\U000323b0\U000323b1 1\uffff"], library)


def test_frames(spark):
    docs = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids binary")
    got = bpe.decode(bpe.encode(docs)).collect()
    vocab = bpe.vocabulary(PATH)
    assert {r.doc_id: bytes(r.ids) for r in got} == dict(enumerate(vocab.encode(TEXTS)))
    assert all(r.decoded == vocab.decode(bytes(r.ids)) for r in got)
    assert bpe.encode(docs.limit(0)).collect() == []
