"""Language-model scoring with a sharded Elias-Fano bigram trie.

The model is a bigram with absolute discounting, interpolated with the unigram that the base score uses:
``p(w | v) = max(c(v, w) - D, 0) / c(v) + D * n(v) / c(v) * p(w)``; n(v) is the number of different words behind v. A text's first word follows a start mark, its last token is the end mark.

Shards. Texts are written once with a batch number. A batch asks shards about its words, then about its bigrams, in packed
arrays; a shard adds up what the training texts of all batches say and answers each batch. Only these arrays are shuffled.
Bigrams go to shards by their first word; a word with a large share of all tokens is split over several shards by the
second word, so no shard holds an unbounded part. A shard's bigrams are a trie of two levels in one file that is mapped into
memory: sorted context words with Elias-Fano coded pointers, and the successors of each context as an Elias-Fano coded
monotone sequence of vocabulary numbers relative to their context, with discounted probabilities quantised to 16 bits.
A shard's file is decoded once, when it has been mapped; the questions of all batches are then looked up together, each
distinct one once and in ascending order, so that a search goes on near the place where the one before it ended.

Words are told apart by 64-bit hashes, inside a shard by 48 bits of them, and successors of one context inside a shard by 32 bits;
a shard's share is bounded, so the chance to mix up two does not grow with the corpus. Null and empty texts have the end token alone.
Repeated rows are counted and scored each. Without training texts every token is unknown and the score is the base score.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import Words, mix, slices, text_bytes
from scoreloom.llm.token_files import local_copy, open_folder
from scoreloom.session import new_table_path

#: Text of one batch; its words and bigrams are asked for together.
BATCH_BYTES = 4 << 20
#: A shard's share of the work: what so many batches of texts hold.
BATCHES_PER_SHARD = 4.0
#: A context is split when it holds more than this part of a shard's tokens.
SPLIT_SHARE = 0.25
#: Steps of the quantised log2 probability.
STEPS = 1024

_START = np.uint64(0x5354415254)
_END = np.uint64(0x454E44)
_LOW32 = np.uint64((1 << 32) - 1)


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the place of each value among them; repeats are found by hash before the sort."""
    coded = pa.array(values).dictionary_encode()
    distinct = coded.dictionary.to_numpy()
    order = np.argsort(distinct)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], place[coded.indices.to_numpy()]


# --- Elias-Fano -----------------------------------------------------------------------------------------------------


def elias_fano(values: np.ndarray, universe: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(low bits, packed low parts, upper bits) of an ascending sequence below ``universe``."""
    n = max(1, len(values))
    low = max(0, int(universe // n).bit_length() - 1)
    values = values.astype(np.uint64)
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(len(values))
    upper = np.zeros(int(high[-1]) + 1 if len(high) else 0, np.uint8)
    upper[high] = 1
    kind = np.uint8 if low <= 8 else np.uint16 if low <= 16 else np.uint32 if low <= 32 else np.uint64
    return low, (values & np.uint64((1 << low) - 1)).astype(kind), np.packbits(upper)


def decode(low: int, lows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The ascending sequence: a one in the upper bits ends each element, zeros before it count its high part."""
    at = np.flatnonzero(np.unpackbits(upper))[: len(lows)]
    return ((at - np.arange(len(at))).astype(np.uint64) << np.uint64(low)) | lows.astype(np.uint64)


# --- trie of one shard ------------------------------------------------------------------------------------------------


def build_trie(contexts: np.ndarray, totals: np.ndarray, pointer: np.ndarray, words: np.ndarray, counts: np.ndarray,
               discount: float) -> dict[str, np.ndarray]:
    """Levels of a trie: ascending contexts, their successors words[pointer[i]:pointer[i + 1]] ascending."""
    vocabulary, number = np.unique(words, return_inverse=True)
    size = max(1, len(vocabulary))
    owner = np.repeat(np.arange(len(contexts)), np.diff(pointer))
    relative = number.astype(np.uint64) + owner.astype(np.uint64) * np.uint64(size)
    p_low, p_lows, p_upper = elias_fano(pointer, len(words) + 1)
    s_low, s_lows, s_upper = elias_fano(relative, size * max(1, len(contexts)))
    share = np.maximum(counts - discount, 1e-9) / np.maximum(totals[owner], 1)
    code = np.clip(np.round(-np.log2(share) * STEPS), 0, 65534).astype(np.uint16)
    return {"contexts": contexts, "vocabulary": vocabulary, "p_low": np.asarray([p_low]), "p_lows": p_lows, "p_upper": p_upper,
            "s_low": np.asarray([s_low]), "s_lows": s_lows, "s_upper": s_upper, "codes": code}


def write_levels(folder: str, name: str, levels: dict[str, np.ndarray]) -> None:
    disk, root = open_folder(folder)
    disk.create_dir(root, recursive=True)
    attempt = f"{root}/.{name}-{uuid.uuid4().hex[:12]}"
    with disk.open_output_stream(attempt) as out:
        names = list(levels)
        sizes = [len(names)]
        out.write(np.asarray(sizes, "<i8").tobytes())
        for x in names:
            kind = levels[x].dtype.str.encode().ljust(8)
            data = levels[x].tobytes()
            out.write(kind + np.asarray([len(data)], "<i8").tobytes() + data + b"\0" * (-len(data) % 8))
    disk.move(attempt, f"{root}/{name}")


LEVELS = ("contexts", "vocabulary", "p_low", "p_lows", "p_upper", "s_low", "s_lows", "s_upper", "codes")


def map_levels(folder: str, name: str) -> dict[str, np.ndarray]:
    """The levels of a file, mapped into memory."""
    import os

    disk, root = open_folder(folder)
    path, temporary = local_copy(disk, f"{root}/{name}")
    whole = np.memmap(path, np.uint8, "r")
    if temporary:
        os.unlink(path)
    out, at = {}, 8
    for x in LEVELS:
        kind, size = whole[at: at + 8].tobytes().strip().decode(), int(whole[at + 8: at + 16].view("<i8")[0])
        out[x] = whole[at + 16: at + 16 + size].view(kind)
        at += 16 + size + (-size % 8)
    return out


class Trie:
    def __init__(self, levels: dict[str, np.ndarray]):
        self.contexts, self.vocabulary, self.codes = levels["contexts"], levels["vocabulary"], levels["codes"]
        self.pointer = decode(int(levels["p_low"][0]), levels["p_lows"], levels["p_upper"]).astype(np.int64)
        self.successors = decode(int(levels["s_low"][0]), levels["s_lows"], levels["s_upper"])

    def look_up(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Quantised probabilities of (context, word) pairs, 65535 where a pair is not in the trie."""
        out = np.full(len(context), 65535, np.uint16)
        if not len(self.contexts) or not len(self.successors):
            return out
        c = np.searchsorted(self.contexts, context)
        w = np.searchsorted(self.vocabulary, word)
        c, w = np.minimum(c, len(self.contexts) - 1), np.minimum(w, len(self.vocabulary) - 1)
        real = (self.contexts[c] == context) & (self.vocabulary[w] == word)
        wanted = w.astype(np.uint64) + c.astype(np.uint64) * np.uint64(len(self.vocabulary))
        at = np.minimum(np.searchsorted(self.successors, wanted), len(self.successors) - 1)
        real &= (self.successors[at] == wanted) & (at >= self.pointer[c]) & (at < self.pointer[c + 1])
        out[real] = self.codes[at[real]]
        return out

    def followers(self, context: np.ndarray) -> np.ndarray:
        """Different successors of each context, 0 where it is not in the trie."""
        if not len(self.contexts):
            return np.zeros(len(context), np.int64)
        c = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        return np.where(self.contexts[c] == context, self.pointer[c + 1] - self.pointer[c], 0)


# --- batches ----------------------------------------------------------------------------------------------------------


class Tokens:
    """Tokens of a batch of texts: words in order with an end token behind each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = data.copy()
        data[(data >= 65) & (data <= 90)] += 32
        words = Words(data, offsets)
        n_texts = len(offsets) - 1
        sizes = np.bincount(words.text, minlength=n_texts) + 1
        self.text = np.repeat(np.arange(n_texts), sizes)
        ends = np.cumsum(sizes) - 1
        self.word = np.zeros(int(sizes.sum()), np.uint64)
        inner = np.ones(len(self.word), bool)
        inner[ends] = False
        self.word[inner], self.word[ends] = words.hashes(), _END
        #: The different words, ascending, and the number of each token among them.
        self.words, self.number = ranked(self.word)
        #: The number of the word before each token, one beyond the last word at a text's start.
        self.before = np.append(len(self.words), self.number[:-1])[: len(self.word)]
        self.before[ends[:-1] + 1] = len(self.words)
        self.sizes = sizes


def packed(docs: DataFrame, id_col: str, text: str, held_out: Column) -> DataFrame:
    """(batch, ids, held, texts): one row per batch of texts, written once, so that a batch is the same in every pass."""
    base = docs.select(F.col(f"`{id_col}`").alias("id"), held_out.alias("held"), F.col(f"`{text}`").alias("text"),
                       F.spark_partition_id().alias("part"))
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("ids", T.ArrayType(base.schema["id"].dataType)),
                           T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("texts", T.ArrayType(T.StringType()))])

    def pack(number: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        ends = pa.array([0, table.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, table.column(i).combine_chunks()) for i in range(3)]
        return pa.RecordBatch.from_arrays([pa.array([number]), *lists], names=["batch", "ids", "held", "texts"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, filled, number = [], 0, None
        for batch in batches:
            _, offsets = text_bytes(batch.column(2))
            for low, high in slices(offsets, BATCH_BYTES // 4):
                size = int(offsets[high] - offsets[low])
                if rows and filled + size > BATCH_BYTES:
                    yield pack(number, rows)
                    rows, filled, number = [], 0, number + 1
                if number is None:
                    number = batch.column(3)[0].as_py() << 24
                rows.append(batch.slice(low, high - low))
                filled += size
        if rows:
            yield pack(number, rows)

    path = new_table_path(docs.sparkSession, "lm-texts")
    base.mapInArrow(over, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


class Batch:
    """One row of ``packed``: its number, ids, training flags and tokens."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.number = batch.column("batch")[i].as_py()
        self.ids, self.held = batch.column("ids")[i].values, batch.column("held")[i].values
        self.tokens = Tokens(*text_bytes(batch.column("texts")[i].values))
        self.train = ~self.held.to_numpy(zero_copy_only=False).astype(bool)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Batch(batch, i)


def answers(df: DataFrame, name: str) -> str:
    """Write a shard's answers (batch, shard, ...) so that a batch finds its own in a folder of its number."""
    path = new_table_path(df.sparkSession, name)
    df.repartition("batch").write.partitionBy("batch").parquet(path)
    return path


def read_answers(path: str, batch: int, columns: list[str]) -> list[dict]:
    disk, root = open_folder(path)
    folder = f"{root}/batch={batch}"
    return pa.dataset.dataset(folder, filesystem=disk, format="parquet").to_table(columns=columns).to_pylist()


def squeeze(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def loosen(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def short(values: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each value."""
    return np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def full(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view("<u8").reshape(-1)


def code48(word: np.ndarray) -> np.ndarray:
    return mix(word) >> np.uint64(16)


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, its places in ascending order) from the shard of each place."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(shard[part[0]]), part


def shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows of one shard after another, from rows sorted by shard."""
    kept: list[dict] = []
    for row in (r for b in batches for r in b.to_pylist()):
        if kept and kept[0]["shard"] != row["shard"]:
            yield kept[0]["shard"], kept
            kept = []
        kept.append(row)
    if kept:
        yield kept[0]["shard"], kept


def _word_shards(word: np.ndarray, shards: int) -> np.ndarray:
    return (mix(word) % np.uint64(shards)).astype(np.int64)


def word_counts(texts: DataFrame, shards: int) -> tuple[str, int, int]:
    """(answers with the training counts of each batch's words, all training tokens, different training tokens)."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in each(batches):
            word, place = part.tokens.words, part.tokens.number
            count = np.bincount(place, part.train[part.tokens.text], minlength=len(word)).astype("<u4")
            for s, mine in by_shard(_word_shards(word, shards)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.number]), pa.array([s], pa.int32()), pa.array([short(code48(word[mine]), 6)], pa.binary()),
                     pa.array([squeeze(count[mine])], pa.binary())], names=["batch", "shard", "words", "counts"])

    asked = texts.mapInArrow(ask, "batch bigint, shard int, words binary, counts binary").repartition(shards, "shard").sortWithinPartitions("shard")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, mine in shard_rows(batches):
            words = [full(r["words"], 6) for r in mine]
            known, place = ranked(np.concatenate(words))
            counts = np.concatenate([loosen(r["counts"], "<u4") for r in mine])
            total = np.bincount(place, counts, minlength=len(known)).astype("<i8")
            n_all, n_known, at = int(total.sum()), int((total > 0).sum()), 0
            for r, w in zip(mine, words, strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["batch"]]), pa.array([s], pa.int32()), pa.array([squeeze(total[place[at: at + len(w)]])], pa.binary()),
                     pa.array([n_all]), pa.array([n_known])],
                    names=["batch", "shard", "counts", "shard_tokens", "shard_words"])
                at, n_all, n_known = at + len(w), 0, 0

    path = answers(asked.mapInArrow(answer, "batch bigint, shard int, counts binary, shard_tokens bigint, shard_words bigint"),
                   "lm-words")
    counted = texts.sparkSession.read.schema("batch bigint, shard_tokens bigint, shard_words bigint").parquet(path)
    found = counted.agg(F.sum("shard_tokens"), F.sum("shard_words")).first()
    return path, int(found[0] or 0), int(found[1] or 0)


def batch_words(path: str, part: Batch, shards: int) -> np.ndarray:
    """Counts of the batch's different words over all training texts."""
    word = part.tokens.words
    count = np.zeros(len(word), np.int64)
    told = {r["shard"]: r["counts"] for r in read_answers(path, part.number, ["shard", "counts"])}
    for s, mine in by_shard(_word_shards(word, shards)):
        count[mine] = loosen(told[s], "<i8")
    return count


def _bigrams(tokens: Tokens, count: np.ndarray, starts: int) -> tuple[np.ndarray, ...]:
    """Distinct bigrams of a batch in order of (context, 32 bits of the word): both, the place of each token, context totals."""
    second = (mix(tokens.words) & _LOW32)[tokens.number]
    pair, place = ranked(tokens.before.astype(np.uint64) << np.uint64(32) | second)
    context = (pair >> np.uint64(32)).astype(np.int64)
    return np.append(tokens.words, _START)[context], pair & _LOW32, place, np.append(count, starts)[context]


def _questions(v: np.ndarray, w: np.ndarray, total: np.ndarray, n_tokens: int, shards: int) -> Iterator[tuple]:
    """(shard, places of its bigrams, places of the first bigram of its contexts, bigrams of each context) of a batch.

    Bigrams go by their context, those of a context with a large part of all tokens also by their word. All parts of such a
    context are asked how many words follow it, also those in which the batch has no bigram: these contexts come last.
    """
    split = np.clip(np.ceil(total / max(1.0, SPLIT_SHARE * n_tokens / shards)), 1, shards).astype(np.uint64)
    shard = ((mix(v) + mix(w) % split) % np.uint64(shards)).astype(np.int64)
    head = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(v))))
    parts = split[head].astype(np.int64)
    shared = np.flatnonzero(parts > 1)
    which = np.repeat(shared, parts[shared])
    turn = np.arange(len(which)) - np.repeat(np.cumsum(parts[shared]) - parts[shared], parts[shared])
    asked = ((mix(v[head[which]]) + turn.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
    extra = {s: which[p] for s, p in by_shard(asked)}
    own = dict(by_shard(shard))
    for s in sorted(own.keys() | extra.keys()):
        mine = own.get(s, np.zeros(0, np.int64))
        g = group[mine]
        begin = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
        more = np.setdiff1d(extra[s], g[begin]) if s in extra else np.zeros(0, np.int64)
        sizes = np.append(np.diff(np.append(begin, len(mine))), np.zeros(len(more), np.int64))
        yield s, mine, head[np.append(g[begin], more).astype(np.int64)], sizes


def bigram_answers(texts: DataFrame, words: str, starts: int, n_tokens: int, shards: int, discount: float, folder: str) -> str:
    """Answers with each batch's bigrams: quantised probabilities, and per context its number of different successors."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in each(batches):
            v, w, place, total = _bigrams(part.tokens, batch_words(words, part, shards), starts)
            count = np.bincount(place, part.train[part.tokens.text], minlength=len(v)).astype("<u4")
            for s, mine, heads, sizes in _questions(v, w, total, n_tokens, shards):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.number]), pa.array([s], pa.int32()), pa.array([short(code48(v[heads]), 6)], pa.binary()),
                     pa.array([squeeze(total[heads].astype("<i8"))], pa.binary()), pa.array([squeeze(sizes.astype("<u4"))], pa.binary()),
                     pa.array([short(w[mine], 4)], pa.binary()),
                     pa.array([squeeze(count[mine])], pa.binary())],
                    names=["batch", "shard", "contexts", "totals", "sizes", "words", "counts"])

    asked = texts.mapInArrow(ask, "batch bigint, shard int, contexts binary, totals binary, sizes binary, words binary, "
                                  "counts binary").repartition(shards, "shard").sortWithinPartitions("shard")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, mine in shard_rows(batches):
            heads = [full(r["contexts"], 6) for r in mine]
            known, number = ranked(np.concatenate(heads))
            total = np.zeros(len(known), np.int64)
            total[number] = np.concatenate([loosen(r["totals"], "<i8") for r in mine])
            sizes = [loosen(r["sizes"], "<u4") for r in mine]
            word = np.concatenate([full(r["words"], 4) for r in mine])
            pair, place = ranked(np.repeat(number, np.concatenate(sizes)).astype(np.uint64) << np.uint64(32) | word)
            count = np.bincount(place, np.concatenate([loosen(r["counts"], "<u4") for r in mine]), minlength=len(pair)).astype(np.int64)
            write_levels(folder, f"shard-{s:06d}", build_trie(*_count_level(known, total, pair, count), discount))
            trie = Trie(map_levels(folder, f"shard-{s:06d}"))
            code = trie.look_up(known[(pair >> np.uint64(32)).astype(np.int64)], pair & _LOW32).astype("<u2")
            different = trie.followers(known).astype("<u4")
            first, head = 0, 0
            for r, c, n in zip(mine, heads, sizes, strict=True):
                last = first + int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["batch"]]), pa.array([s], pa.int32()), pa.array([squeeze(code[place[first: last]])], pa.binary()),
                     pa.array([squeeze(different[number[head: head + len(c)]])], pa.binary())],
                    names=["batch", "shard", "codes", "different"])
                first, head = last, head + len(c)

    return answers(asked.mapInArrow(answer, "batch bigint, shard int, codes binary, different binary"), "lm-bigrams")


def _count_level(known: np.ndarray, total: np.ndarray, pair: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts seen in training, their totals, pointers, successors and counts, from ascending pairs (context number, word)."""
    seen = count > 0
    pair, count = pair[seen], count[seen]
    owner = (pair >> np.uint64(32)).astype(np.int64)
    head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    return known[owner[head]], total[owner[head]], np.append(head, len(owner)), pair & _LOW32, count


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text", discount: float = 0.75) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark = docs.sparkSession
    texts = packed(docs, id_col, text, F.coalesce(held_out, F.lit(False)))
    facts = texts.agg(F.count("batch"), F.sum(F.size(F.filter("held", lambda x: ~x)))).first()
    shards, starts = max(1, int(facts[0] / BATCHES_PER_SHARD)), int(facts[1] or 0)
    words, n_tokens, n_words = word_counts(texts, shards)
    folder = new_table_path(spark, "lm-trie")
    bigrams = bigram_answers(texts, words, starts, n_tokens, shards, discount, folder)
    kind = texts.schema["ids"].dataType.elementType.simpleString()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in each(batches):
            tokens = part.tokens
            count = batch_words(words, part, shards)
            c = count[tokens.number]
            unigram = (c + 0.5) / (n_tokens + 0.5 * (n_words + 1))
            v, w, place, total = _bigrams(tokens, count, starts)
            told = {r["shard"]: r for r in read_answers(bigrams, part.number, ["shard", "codes", "different"])}
            share, different = np.zeros(len(v)), np.zeros(len(v))
            for s, mine, heads, _ in _questions(v, w, total, n_tokens, shards):
                code = loosen(told[s]["codes"], "<u2")
                share[mine] = np.where(code == 65535, 0.0, np.exp2(-code.astype(float) / STEPS))
                different[heads] += loosen(told[s]["different"], "<u4")
            first = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64)
            different = np.repeat(different[first], np.diff(np.append(first, len(v))))
            rest = np.where(total > 0, discount * different / np.maximum(total, 1), 1.0)
            p = share[place] + rest[place] * unigram
            n = len(tokens.sizes)
            add = lambda x: np.bincount(tokens.text, x, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [part.ids, part.held, pa.array(tokens.sizes.astype(np.int64)),
                 pa.array(add(c > 0).astype(np.int64)), pa.array(np.full(n, n_tokens)), pa.array(add(np.log10(unigram))),
                 pa.array(add(np.log10(p)))],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return texts.mapInArrow(finish, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                    "base_score double, score double")
