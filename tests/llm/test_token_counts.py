import random

import public_tokenizers
import sentencepiece

from scoreloom.llm import token_counts as tc

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_transducer_equals_library():
    library, machine, rnd = sentencepiece.SentencePieceProcessor(model_file=MODEL), tc.machine(MODEL), random.Random(5)
    parts = list("abcdeéñ  ▁\n\t.,0123あ漢字🙂\x00<s>") + [library.id_to_piece(rnd.randrange(259, 32000)) for _ in range(200)] + [
        "<s>", "</s>", "<unk>", "<0x0A>", "   ", "ing", "tion"]
    for _ in range(2500):
        text, size = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))), rnd.randint(1, 9)
        chunks = [text[i: i + size] for i in range(0, len(text), size)]
        maps = [machine.chunk_map(tc.marked(c) if i == 0 else c.replace(" ", tc.SPACE), i == 0) for i, c in enumerate(chunks)]
        assert machine.run(machine.start, tc.marked(text))[1] == len(library.encode(text)) == machine.compose(maps)
        assert machine.count(tc.marked(text)) == len(library.encode(text)) or not text


def test_bounded_tables(monkeypatch):
    monkeypatch.setattr(tc, "MAX_TRANSITIONS", 50)
    monkeypatch.setattr(tc, "MAX_FACTS", 20)
    machine, library = tc.Transducer(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "The quick brown fox, überaus schnell — jumps over 12 lazy dogs. " * 5
    monkeypatch.setattr(tc, "MAX_UNITS", 3)
    assert machine.run(machine.start, tc.marked(text))[1] == len(library.encode(text)) == machine.count(tc.marked(text))


def test_documents(spark, docs, awkward):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df, chunk in ((docs.select("doc_id", "text"), 1 << 16), (docs.select("doc_id", "text"), 100), (awkward, 1000)):
        got = sorted((r.id is None, r.id, r.n_bytes, r.n_tokens) for r in tc.token_counts(df, MODEL, chunk=chunk).collect())
        want = sorted((r.doc_id is None, r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in df.collect())
        assert [x[2:] for x in got] == [x[2:] for x in want] and len(got) == len(want)
    assert tc.token_counts(awkward.limit(0), MODEL).count() == 0


def test_long_texts_without_word_starts(spark, monkeypatch):
    """Chunks that hold no word start have maps too, also where the guessed start is wrong, and are composed pairwise."""
    library, rnd = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(9)
    texts = ["".join(rnd.choice(kind) for _ in range(size)) for kind in ("ab", "aeinorst", "0123456789abcdef+/", "漢字あa", "e", " ", "\n a")
             for size in (1, 999, 1000, 1001, 7013)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for warm_up, chunk in ((tc.WARM_UP, 1000), (0, 37)):  # without a warm-up every chunk is entered in another state than guessed
        monkeypatch.setattr(tc, "WARM_UP", warm_up)
        got = {r.id: r.n_tokens for r in tc.token_counts(rows.limit(len(texts)), MODEL, chunk=chunk).collect()}
        assert got == {i: len(library.encode(t)) for i, t in enumerate(texts)}


def test_twenty_megabytes_without_a_space(spark):
    """A text of twenty million characters without a space is counted through its chunks as the library counts it."""
    library, text = sentencepiece.SentencePieceProcessor(model_file=MODEL), "abcdefghijklmnopqrstuvwxyz0123456789" * 555_556
    rows = spark.createDataFrame([(1, text[: 1 << 20])], "doc_id long, text string")
    twenty = rows.selectExpr("doc_id", "repeat(text, 20) as text")
    assert tc.token_counts(twenty, MODEL).first().n_tokens == len(library.encode(text[: 1 << 20] * 20))
