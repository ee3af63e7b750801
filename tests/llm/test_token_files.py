import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scoreloom.llm import token_files as tf

WORDS = public_tokenizers.path("word_bpe_49k.json")


def expected(texts):
    return [c.ids + [1] for c in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]


def test_digest(docs):
    got = tf.token_digest(docs.select("doc_id", "text"), tf.corpus_folder(docs), WORDS).toPandas().sort_values("doc_id")
    pdf = docs.toPandas().sort_values("doc_id")
    ids = expected(pdf.text.fillna("").tolist())
    assert got.n_tokens.tolist() == [len(i) for i in ids]
    assert got.start.tolist() == np.cumsum([0] + [len(i) for i in ids])[:-1].tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(np.asarray(i, "<u4").tobytes()) for i in ids]


def test_words_equal_whole_texts():
    rnd = random.Random(1)
    parts = list("abAB '\n\r\t\x0b\x1c\x85\xa0　́é<|>Σςß12'sétreend!,.​\x00") + ["<|endoftext|>", "<|startoftext|>", "'s", "’"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    got = tf.WordEncoder(WORDS, "<u4").encode(texts)
    assert got == [np.asarray(i[:-1], "<u4").tobytes() for i in expected(texts)]


def test_known_words_are_looked_at_once():
    """Texts whose words are all known are joined straight from the table, without a set of their words held against it."""
    class Table(dict):
        def __iter__(self):
            raise AssertionError("went through the whole table")

    texts = [f"one two three word{i % 7} Éa x, <|y" for i in range(100)]
    encoder = tf.WordEncoder(WORDS, "<u4")
    want = encoder.encode(texts)
    encoder.known = Table(encoder.known)
    assert encoder.encode(texts) == want == [np.asarray(i[:-1], "<u4").tobytes() for i in expected(texts)]


def test_words_of_the_older_generation_are_looked_up():
    """New words are held against the older table one by one; the table, much larger, is not gone through for each call."""
    class Table(dict):
        def __iter__(self):
            raise AssertionError("went through the whole table")

    texts = [f"one two three word{i % 7} Éa x, <|y" for i in range(100)]
    encoder = tf.WordEncoder(WORDS, "<u4")
    want = encoder.encode(texts)
    encoder.older, encoder.known = Table(encoder.known), {"": b""}
    encoder._learn = lambda new: new and pytest.fail(f"learned again: {new}")
    assert encoder.encode(texts) == want


def test_plain_words_pass_by_the_normaliser():
    """Words of lower-case ASCII letters have the ids of the whole library, without its normaliser and pre-tokeniser."""
    class Library:
        def __init__(self, tokenizer):
            self.tokenizer, self.seen = tokenizer, []

        def encode_batch_fast(self, texts, **options):
            self.seen += texts
            return self.tokenizer.encode_batch_fast(texts, **options)

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzst") for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    texts = [" ".join(words[i: i + 50]) for i in range(0, 3000, 50)] + ["café été STRASSE straße ǆ ﬁ"]
    encoder = tf.WordEncoder(WORDS, "<u4")
    encoder.tokenizer = Library(encoder.tokenizer)
    assert encoder.encode(texts) == [np.asarray(i[:-1], "<u4").tobytes() for i in expected(texts)]
    assert not set(words) & {w for t in encoder.tokenizer.seen for w in t.split(" ")}


def test_awkward(awkward):
    rows = tf.token_digest(awkward, tf.corpus_folder(awkward), WORDS).orderBy("start").collect()
    assert len(rows) == 8 and [r.doc_id for r in rows][:2] == [None, None]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    empty = awkward.limit(0)
    assert tf.token_digest(empty, tf.corpus_folder(empty), WORDS).count() == 0
