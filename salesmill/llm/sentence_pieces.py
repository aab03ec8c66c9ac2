"""SentencePiece encoding and decoding over shared prefixes.

A text is marked (a mark for every space, one before the text) and cut into marked words:
no piece of the vocabulary holds a mark after another character, so words encode alone.
The distinct words of a batch are sorted, which lays out their trie, and walked depth
first: forward states of a prefix are computed once and reused by all words that share it.
The pieces that end at a character come from an automaton of the vocabulary (Aho-Corasick).

A forward state is the last piece of the best path to a prefix. In a vocabulary of byte
pairs the best path is the one its merges lead to; that path ends in piece ``p`` if, and
only if, ``p`` may follow the last piece of what precedes it, and two pieces may follow one
another if merging their joined characters gives just these two again. So each prefix has
exactly one admissible last piece, and the walk gives what merging gives.
Characters outside the vocabulary become bytes.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of

MARK = "▁"
# A run of marks and what follows it; a line end stands alone, as it is in no piece.
MARKED_WORD = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
NEVER = float("inf")
CACHED_CHARACTERS = 8_000_000
CACHED_PAIRS = 1_000_000
NO_PIECE = -1


class SharedPrefixEncoder:
    def __init__(self, model_file: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.outputs = [b""] * len(self.pieces)
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.outputs[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.rank[piece] = -model.get_score(i)
                self.outputs[i] = piece.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            raise ValueError("the vocabulary has pieces that cross words")
        # Only what its own merges lead to can end a path.
        self.reachable = {p: i for p, i in self.ids.items() if len(p) == 1 or self.merge(p) == [p]}
        self.sizes = list(map(len, self.pieces))
        self.steps, self.falls, self.ends = self._automaton()
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.held = 0

    def merge(self, text: str) -> list[str]:
        """Pieces of ``text`` by joining the best-ranked neighbours, leftmost first."""
        parts, rank = list(text), self.rank
        ranks = [rank.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            k = ranks.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get(parts[k - 1] + parts[k], NEVER)
            if k < len(ranks):
                ranks[k] = rank.get(parts[k] + parts[k + 1], NEVER)
        return parts

    def _automaton(self) -> tuple[list[dict[str, int]], list[int], list[tuple[tuple[int, int], ...]]]:
        """The trie of the reachable pieces: for each node its steps by character, the node of its longest proper
        suffix, and length and id of each piece that ends there, longest first."""
        steps: list[dict[str, int]] = [{}]
        ends: list[tuple[tuple[int, int], ...]] = [()]
        for piece, number in self.reachable.items():
            node = 0
            for character in piece:
                node = steps[node].setdefault(character, len(steps))
                if node == len(steps):
                    steps.append({})
                    ends.append(())
            ends[node] = ((len(piece), number),)
        falls = [0] * len(steps)
        row = list(steps[0].values())
        while row:
            for node in row:
                ends[node] += ends[falls[node]]
                for character, after in steps[node].items():
                    falls[after] = self._step(steps, falls, falls[node], character)
            row = [after for node in row for after in steps[node].values()]
        return steps, falls, ends

    @staticmethod
    def _step(steps: list[dict[str, int]], falls: list[int], node: int, character: str) -> int:
        after = steps[node].get(character)
        while after is None and node:
            node = falls[node]
            after = steps[node].get(character)
        return after or 0

    def _may_follow(self, last: str, piece: str) -> bool:
        return last + piece not in self.rank and self.merge(last + piece) == [last, piece]

    def _walk(self, word: str, states: list[int], nodes: list[int]) -> None:
        """Add to ``states``, for each prefix of ``word`` that they do not reach yet, the last piece of the best path
        to it, by its id, and to ``nodes`` where the automaton is; ``NO_PIECE`` for the start of the word and for a
        character of no piece."""
        steps, falls, ends, step = self.steps, self.falls, self.ends, self._step
        pairs, vocabulary, node = self.pairs, len(self.pieces), nodes[-1]
        for end in range(len(states), len(word) + 1):
            character = word[end - 1]
            node = steps[node].get(character) or step(steps, falls, node, character)
            for length, piece in ends[node]:
                last = states[end - length]
                if last == NO_PIECE:
                    break
                pair = last * vocabulary + piece
                follows = pairs.get(pair)
                if follows is None:
                    follows = pairs[pair] = self._may_follow(self.pieces[last], self.pieces[piece])
                if follows:
                    break
            else:
                piece = self.reachable.get(character, NO_PIECE)
            states.append(piece)
            nodes.append(node)

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct words, as little-endian 32-bit numbers."""
        out, sizes = {}, self.sizes
        previous, states, nodes = "", [NO_PIECE], [0]
        for word in sorted(words):
            shared, most = 0, min(len(previous), len(word))
            while shared < most and previous[shared] == word[shared]:
                shared += 1
            del states[shared + 1:], nodes[shared + 1:]
            self._walk(word, states, nodes)
            ids, at = [], len(word)
            while at:
                piece = states[at]
                if piece == NO_PIECE:
                    at -= 1
                    ids += [self.byte_ids[b] for b in reversed(word[at].encode("utf-8", "surrogatepass"))]
                else:
                    ids.append(piece)
                    at -= sizes[piece]
            out[word] = array("I", ids[::-1]).tobytes()
            previous = word
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text. Words seen are remembered up to a bound on their length in all."""
        if self.held > CACHED_CHARACTERS:
            self.known.clear()
            self.held = 0
        if len(self.pairs) > CACHED_PAIRS:
            self.pairs.clear()
        marked = [MARKED_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = set().union(*marked).difference(self.known)
        self.held += sum(map(len, new))
        self.known.update(self.encode_words(new))
        for words in marked:
            yield b"".join(map(self.known.__getitem__, words))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes joined, marks as spaces, the mark before the text dropped."""
        raw = b"".join(map(self.outputs.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=1)
def _encoder(model_file: str, size: int, changed: int) -> SharedPrefixEncoder:
    return SharedPrefixEncoder(model_file)


def encoder_of(model_file: str) -> SharedPrefixEncoder:
    """The encoder of a file, made once in a worker process: its tasks share what it has learned, within its bounds."""
    found = os.stat(model_file)
    return _encoder(model_file, found.st_size, found.st_mtime_ns)


def encode_pieces(docs: DataFrame, model_file: str) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_tokens, ids, ids_crc32, decoded_crc32,
    round_trip``.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit numbers, ``decoded_crc32``
    over the UTF-8 bytes of the text decoded from them; ``round_trip`` says whether that text
    is the given one. A text that holds the mark itself has it back as a space. A null or
    empty text has no ids. Repeated rows give repeated results; no rows give none. Other
    columns are not read.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(model_file)
        gc.disable()   # it would walk through millions of strings, again and again, and there are no cycles
        for batch in slices(batches, "text", 1 << 20):
            texts = texts_of(batch.column("text"))
            encoded = list(coder.encode(texts))
            decoded = [coder.decode(np.frombuffer(e, "<u4")) for e in encoded]
            lengths = [len(e) // 4 for e in encoded]
            offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
            flat = pa.array(np.frombuffer(b"".join(encoded), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.array([zlib.crc32(e) for e in encoded], pa.int64()),
                    pa.array([zlib.crc32(d.encode()) for d in decoded], pa.int64()),
                    pa.array([d == t for d, t in zip(decoded, texts)]),
                ],
                ["doc_id", "n_tokens", "ids", "ids_crc32", "decoded_crc32", "round_trip"],
            )
        gc.enable()

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run,
        "doc_id bigint, n_tokens bigint, ids array<int>, ids_crc32 bigint, decoded_crc32 bigint,"
        " round_trip boolean",
    )
