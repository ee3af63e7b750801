"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

Greedy BPE has a local structure: the encoding of a prefix ends in one last token, and a token can follow another exactly if
the two stay apart when encoded together. So a text can be read once, character by character, remembering only the pairs
(place in the token trie of what was read since a boundary, last token at that boundary) that may still become a token. This
is a finite set of facts: a state. The transducer's transitions carry how the number of tokens changes. States and
transitions are built when first met and kept by each Python worker up to a bound.

The state after the start of a word doesn't depend on what came before, as no token runs over a word's start. A text is cut
into chunks that are counted on their own: a chunk's map says what it adds and in which state it ends, given the state it
starts in. Chunks with a word start inside have a map that is constant behind it; only the piece before (the head) depends
on the start. A chunk without one is all head, and its map is a table of the few start states it may be entered in: the one
that the characters before it lead to, and, in rounds, every other one in which the map of the chunk before it ends. States
forget what lies far back, so the first guess is nearly always right; where it is not, only that chunk is read again.

Maps compose associatively: a prefix scan joins neighbours pairwise, (0, 1), (2, 3) and so on, in log2(chunks) rounds, each a
shuffle of rows of a few dozen bytes. No chunk's text leaves its task, and no text is put together again.

Null texts are empty and have no tokens. Repeated rows are counted alike. Texts may have any length, with or without spaces;
chunks bound the work. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import stored, text_bytes

CHUNK = 1 << 16
LIMIT = 4096
#: Characters before a chunk that are read to guess the state it starts in.
WARM_UP = 64
#: Transitions and compatibility facts a worker keeps; beyond it the tables are dropped and built anew.
MAX_TRANSITIONS = 500_000
MAX_FACTS = 500_000
#: Maps of words (their token counts) a worker keeps.
MAX_UNITS = 300_000
#: Below a trie node with up to so many tokens, states that differ only in what no longer matters are merged.
SMALL_TREE = 12

SPACE = "▁"
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_UNKNOWN = -1
_NONE = -2


class Transducer:
    """Counts the tokens of a sentencepiece BPE model (with byte fallback and no normalisation)."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.rank: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)):
                self.rank[model.id_to_piece(i)] = model.get_score(i)
        self.pieces = list(self.rank)
        number = {p: i for i, p in enumerate(self.pieces)}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a token runs over the start of a word: chunks can't be cut there")
        # The trie of tokens that encode to themselves: children of a node, and the token that ends there.
        self.children: list[dict[str, int]] = [{}]
        self.token = [_NONE]
        for piece in self.pieces:
            if len(self.encode(piece)) != 1:
                continue
            node = 0
            for c in piece:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.token.append(_NONE)
                node = self.children[node][c]
            self.token[node] = number[piece]
        #: A line end is a byte of its own that nothing runs over, so lines are cut there too.
        self.line_ends = not any("\n" in p for p in self.pieces)
        self.units: dict[str, int] = {}
        self.below: list[tuple[int, ...] | None] = [None] * len(self.children)
        self.facts: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, int], tuple[str, ...]] = {}
        self.forget()

    def encode(self, piece: str) -> list[str]:
        """Greedy merges of a short string: always the best ranked pair, the leftmost of equals."""
        parts = list(piece)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at: at + 2] = [parts[at] + parts[at + 1]]

    def _spine(self, token: int, side: int) -> tuple[str, ...]:
        """The parts that stand at a token's left (0) or right (-1) end while it is being merged."""
        key = (token, side)
        if key not in self.spines:
            parts = list(self.pieces[token])
            seen = {parts[side]}
            while len(parts) > 1:
                scores = [self.rank.get(parts[i] + parts[i + 1], -np.inf) for i in range(len(parts) - 1)]
                at = int(np.argmax(scores))
                parts[at: at + 2] = [parts[at] + parts[at + 1]]
                seen.add(parts[side])
            self.spines[key] = tuple(seen)
        return self.spines[key]

    def forget(self) -> None:
        """Drop all states but the start of a text."""
        self.states: dict[tuple, dict] = {}
        self.n_transitions = 0
        self.start = self._state(((0, _NONE, 0),))

    def _state(self, facts: tuple) -> dict:
        if facts not in self.states:
            self.states[facts] = {"": facts}  # the facts themselves stand under the empty string, transitions under characters
        return self.states[facts]

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens in a row stay apart."""
        if left < 0:
            return True
        if (left, right) not in self.facts:
            if len(self.facts) > MAX_FACTS:
                self.facts = {}
            a, b = self.pieces[left], self.pieces[right]
            # What may merge over the boundary is a part at a's right end with one at b's left end.
            touch = any(x + y in self.rank for x in self._spine(left, -1) for y in self._spine(right, 0))
            self.facts[left, right] = not touch or self.encode(a + b) == [a, b]
        return self.facts[left, right]

    def _tokens_below(self, node: int) -> tuple[int, ...]:
        """Tokens below a node (not at it), or () where there are more than SMALL_TREE."""
        if self.below[node] is None:
            found, open_nodes = [], list(self.children[node].values())
            while open_nodes and len(found) <= SMALL_TREE:
                n = open_nodes.pop()
                if self.token[n] != _NONE:
                    found.append(self.token[n])
                open_nodes.extend(self.children[n].values())
            self.below[node] = tuple(found) if len(found) <= SMALL_TREE else ()
        return self.below[node]

    def _merged(self, node: int, before: int) -> int | None:
        """The last token as far as it still matters: free if no token below is barred by it, None if all are."""
        tokens = self._tokens_below(node)
        if before < 0 or not tokens:
            return before
        apart = [self._apart(before, t) for t in tokens]
        return _UNKNOWN if all(apart) else before if any(apart) else None

    def step(self, state: dict, char: str) -> tuple[dict, int]:
        """Build a transition: the next state and the change in the number of tokens.

        Facts are (trie node, last token at the boundary, tokens before the boundary less those of the whole prefix).
        """
        moved, last, gain = [], None, 0
        for node, before, count in state[""]:
            child = self.children[node].get(char)
            if child is None:
                continue
            moved.append((child, before, count))
            token = self.token[child]
            if token != _NONE and last is None and self._apart(before, token):
                last, gain = token, count + 1
        if last is None:  # a character outside the vocabulary: its UTF-8 bytes, with nothing running over it
            last, gain, moved = _UNKNOWN, len(char.encode()), []
        kept = []
        for node, before, count in moved:
            if self.children[node]:
                matters = self._merged(node, before)
                if matters is not None:
                    kept.append((node, matters, count - gain))
        following = self._state((*kept, (0, last, 0)))
        if self.n_transitions > MAX_TRANSITIONS:
            facts = following[""]
            self.forget()
            return self._state(facts), gain
        self.n_transitions += 1
        state[char] = (following, gain)
        return following, gain

    def run(self, state: dict, text: str) -> tuple[dict, int]:
        """Read a text from a state: the state behind it and the tokens it adds."""
        count, step = 0, self.step
        for char in text:
            move = state.get(char)
            if move is None:
                move = step(state, char)
            state, gain = move
            count += gain
        return state, count

    def count(self, text: str) -> int:
        """Tokens of a text that starts a word: its words are chunks with constant maps, and maps met before are kept."""
        if SPACE + SPACE in text:
            return sum(self._unit(u) for u in _UNITS.findall(text))
        total, units = 0, self.units
        for i, line in enumerate(text.split("\n")) if self.line_ends else ((0, text),):
            first, *words = line.split(SPACE)
            if i:
                total += 1  # the line end, a byte of its own
            if first:
                total += self._unit(first)
            for word in words:
                n = units.get(word)
                if n is None:
                    n = units[word] = self._unit(SPACE + word)
                total += n
        if len(units) > MAX_UNITS:
            self.units = {}
        return total

    def _unit(self, unit: str) -> int:
        return self.run(self.word_start(), unit)[1]

    def word_start(self) -> dict:
        """The state in front of a word's first mark, whatever came before it."""
        return self._state(((0, _UNKNOWN, 0),))

    def chunk_map(self, text: str, first: bool) -> tuple[str | None, int, tuple]:
        """A chunk's map: (head, tokens behind the head, facts of the state at the end).

        The head is what stands before the first word start behind the chunk's first character and depends on the state the
        chunk starts in; None for a text's first chunk, which starts in the start state. Without a word start all is head.
        """
        if first:
            state, count = self.run(self.start, text)
            return None, count, state[""]
        at = _first_word(text)
        if at < 0:
            return text, 0, ()
        last = max(at, text.rfind(SPACE))
        while last > at and text[last - 1] == SPACE:
            last -= 1
        state, count = self.run(self.word_start(), text[last:])
        return text[:at], self.count(text[at:last]) + count, state[""]

    def follow(self, state: dict, chunk: tuple[str | None, int, tuple]) -> tuple[dict, int]:
        """Where a chunk's map leads from a state, and the tokens it adds."""
        head, count, facts = chunk
        more = 0
        if head:
            state, more = self.run(state, head)
        return self._state(tuple(tuple(f) for f in facts)) if facts else state, count + more

    def compose(self, maps: list[tuple[str | None, int, tuple]]) -> int:
        """Tokens of a text from its chunks' maps in order."""
        total, state = 0, self.start
        for chunk in maps:
            state, more = self.follow(state, chunk)
            total += more
        return total

    def entry(self, text: str, at: int, before: str, start: bytes | None) -> tuple[bytes, bytes, int]:
        """(start, end, tokens) of chunk number ``at`` from a packed start state, or from the guess that ``before`` leads to."""
        if start is not None:
            state = self._state(tuple(tuple(f) for f in np.frombuffer(start, "<i8").reshape(-1, 3).tolist()))
        else:
            state = self.run(self.word_start(), before)[0] if at else self.start
        begin = packed(state)
        end, count = self.follow(state, self.chunk_map(text, at == 0))
        return begin, packed(end), count


def packed(state: dict) -> bytes:
    """A state's facts as bytes, the same in every worker."""
    return np.asarray(state[""], "<i8").tobytes()


def _first_word(text: str) -> int:
    """The first place where a word mark follows another character."""
    at = text.find(SPACE, 1)
    while at > 0 and text[at - 1] == SPACE:
        at = text.find(SPACE, at + 1)
    return at


def marked(text: str) -> str:
    """The text as the model sees it: a word mark in front, and word marks for spaces."""
    return SPACE + text.replace(" ", SPACE) if text else ""


_machines: dict[str, Transducer] = {}


def machine(model_file: str) -> Transducer:
    if model_file not in _machines:
        _machines[model_file] = Transducer(model_file)
    return _machines[model_file]


def _entries(rows: DataFrame, model_file: str) -> DataFrame:
    """(row, at, start, end, n) of chunks (row, at, piece, before, start); a null start is guessed."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = machine(model_file)
        for batch in batches:
            found = [transducer.entry(marked(p) if at == 0 else p.replace(" ", SPACE), at, b.replace(" ", SPACE), s)
                     for at, p, b, s in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)),
                 pa.array([f[2] for f in found], pa.int64())], names=["row", "at", "start", "end", "n"])

    return (rows.select("row", "at", "piece", "before", "start")
            .mapInArrow(over, "row bigint, at int, start binary, end binary, n bigint"))


def _chunk_maps(pieces: DataFrame, model_file: str) -> DataFrame:
    """Maps of chunks as rows (row, at, start, end, n) that hold every state in which the chunk before ends."""
    maps = stored(_entries(pieces.withColumn("start", F.lit(None).cast("binary")), model_file), "count-maps")
    while True:
        asked = maps.select("row", (F.col("at") + 1).alias("at"), F.col("end").alias("start")).distinct()
        unknown = asked.join(maps, ["row", "at", "start"], "left_anti").join(pieces, ["row", "at"])
        more = stored(_entries(unknown, model_file), "count-more")
        if more.isEmpty():
            return maps
        maps = stored(maps.union(more), "count-maps")


def _scan(maps: DataFrame, chunks: int) -> DataFrame:
    """(row, n_tokens): the maps of a text's chunks composed pairwise until one is left, which is read at the start state."""
    level = maps.groupBy("row", "at").agg(F.collect_list(F.struct("start", "end", "n")).alias("map"))
    while chunks > 1:
        side = F.col("at") % 2
        level = (level.groupBy("row", F.floor(F.col("at") / 2).cast("int").alias("at"))
                 .agg(F.max(F.when(side == 0, F.col("map"))).alias("left"), F.max(F.when(side == 1, F.col("map"))).alias("right")))

        def joined(one):
            after = F.filter("right", lambda two: two["start"] == one["end"])[0]
            return F.struct(one["start"].alias("start"), after["end"].alias("end"), (one["n"] + after["n"]).alias("n"))

        level = level.select("row", "at", F.when(F.col("right").isNull(), F.col("left"))
                             .otherwise(F.transform("left", joined)).alias("map"))
        chunks = (chunks + 1) // 2
    return level.select("row", F.col("map")[0]["n"].alias("n_tokens"))  # a text's first chunk has one start


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8) and n_tokens.

    Texts of up to ``chunk`` characters are counted where they are read. Longer ones are cut, their chunks dealt to all
    tasks, and the maps (small rows) meet pairwise for the composition.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), whole.alias("text"))
    kind = base.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = machine(model_file)
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            n = [transducer.count(marked(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(n, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    short = base.where(F.length("text") <= chunk).mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint")

    # Rows that repeat an id stay apart by a number given once, in a written table.
    long = stored(base.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id()), "count-long")
    last = F.floor((F.length("text") - 1) / chunk).cast("int")
    begin = F.col("at") * chunk
    pieces = stored(long.select("row", "text", F.explode(F.sequence(F.lit(0), last)).alias("at"))
                    .select("row", "at", F.substring("text", begin + 1, chunk).alias("piece"),
                            F.substring("text", F.greatest(begin - WARM_UP, F.lit(0)) + 1, F.least(begin, F.lit(WARM_UP))).alias("before"))
                    .repartition("row", "at"), "count-pieces")
    chunks = int(pieces.agg(F.max("at")).first()[0] or 0) + 1
    totals = _scan(_chunk_maps(pieces, model_file), chunks)
    counted = (long.select("row", "id", F.octet_length("text").cast("long").alias("n_bytes")).join(totals, "row")
               .select("id", "n_bytes", "n_tokens"))
    return short.union(counted)
