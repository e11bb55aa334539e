"""BPE encoding and decoding with a tokenization automaton.

The automaton reads token sequences and accepts those that BPE itself makes. It
is compiled by adding one gadget per merge, in order of rank: for the merge
(u, v) every state with an arc u into a state with an arc v gets an arc uv; uv
leads to a copy of v's state as it is then; and u's state loses its arc v. So a
state is known by the token last read, and has an arc for nearly every token:
written out, the table would have some 2.4 billion cells. It is kept as gadgets
(which arcs a state lost and when, whose copy it is and since when, from which
arc a new arc comes), and a cell is worked out from them once, when it is first
asked for.

Words are read by a second deterministic table, of the arcs' labels with failure
links, which names all labels that end at a symbol. BPE has exactly one path for
every prefix of a word, so exactly one of them continues the path that the prefix
before it has; nothing is ever taken back. Decoding emits the arcs' labels.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Words whose ids are remembered in a worker; beyond that it starts anew.
REMEMBERED = 200_000
#: Cells of the transition table that are kept in a worker; beyond that it starts anew.
REMEMBERED_CELLS = 200_000

_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
_NEVER = 1 << 40
_END = "\ue000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for b in range(256):
        out[b] = chr(b) if b in shown else chr(spare)
        spare += b not in shown
    return out


class Automaton:
    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end: str = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.label = [""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.label[i] = t
        self.made = [-1] * size  # rank of the merge that made an arc and its state
        self.left, self.right = [-1] * size, [-1] * size
        self.lost: dict[tuple[int, int], int] = {}  # (state, arc) -> rank of the merge that took it
        dead: set[int] = set()
        for rank, (a, b) in enumerate(model["merges"]):
            u, v, uv = vocab[a], vocab[b], vocab[a + b]
            self.made[uv], self.left[uv], self.right[uv] = rank, u, v
            if u in dead or v in dead or not self.allows(u, v):
                dead.add(uv)
                continue
            self.lost[u, v] = rank
        self.arcs = {t: i for t, i in vocab.items() if i not in dead}
        # labels by their symbols, with one symbol of its own for a word's end
        self.labels = ahocorasick.Automaton()
        for t, i in self.arcs.items():
            spelled = t.removesuffix(self.end) + _END if self.end and t.endswith(self.end) else t
            self.labels.add_word(spelled, (i, len(spelled)))
        self.labels.make_automaton()
        self.cells: dict[int, bool] = {}
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words: dict[str, bytes] = {}

    def allows(self, state: int, arc: int) -> bool:
        """Whether the state after token ``state`` has the arc ``arc``."""
        made, before = self.made, _NEVER
        while True:
            if self.lost.get((state, arc), _NEVER) < before:
                return False
            if made[arc] < 0 and made[state] < 0:
                return True
            if made[arc] >= made[state]:  # made from the arc of its left part, which that merge itself may have taken
                arc, before = self.left[arc], made[arc] + 1
            else:  # a copy of the state of its right part, from before that merge
                state, before = self.right[state], made[state]

    def has(self, state: int, arc: int) -> bool:
        """A cell of the transition table."""
        cell = state * len(self.label) + arc
        found = self.cells.get(cell)
        if found is None:
            if len(self.cells) >= REMEMBERED_CELLS:
                self.cells.clear()
            found = self.cells[cell] = self.allows(state, arc)
        return found

    def path(self, word: str) -> list[int]:
        """The accepted path that spells the word, given in byte symbols."""
        if self.end:
            word += _END
        state, size = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        known, width = self.cells.get, len(self.label)
        for last, (arc, n) in self.labels.iter(word):
            at = last + 1
            if state[at] >= 0:
                continue
            if at > n:
                before = state[at - n]
                if before < 0:
                    continue
                found = known(before * width + arc)
                if not (self.has(before, arc) if found is None else found):
                    continue
            state[at], size[at] = arc, n
        out, at = [], len(word)
        while at:
            out.append(state[at])
            at -= size[at]
        return out[::-1]

    def _word(self, word: str) -> bytes:
        # printable ASCII stands for itself
        spelled = word if word.isascii() and word.isprintable() else word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.symbols)
        path = self.path(spelled)
        found = struct.pack(f"<{len(path)}I", *path)
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        self.words[word] = found
        return found

    def _plain(self, text: str) -> bytes:
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        known = self.words.get
        return b"".join([known(w) or self._word(w) for w in _PIECES.findall(low)])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text as little-endian unsigned 32-bit integers; none for a null or empty one."""
        if not text:
            return np.zeros(0, "<u4")
        if self.split is None or not any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), "<u4")
        parts = [np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p) for p in self.split.split(text)]
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids) -> str:
        return " ".join(map(self.label.__getitem__, ids))


@lru_cache(1)
def automaton(path: str = VOCABULARY) -> Automaton:
    """Compiled once in each worker."""
    return Automaton(path)


def encode_column(text: Column | str, path: str = VOCABULARY) -> Column:
    @F.pandas_udf("array<long>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series([automaton(path).encode(t).astype("int64") for t in texts], dtype=object)

    return encode(text)


def decode_column(ids: Column | str, path: str = VOCABULARY) -> Column:
    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else automaton(path).decode(r) for r in rows], dtype=object)

    return decode(ids)


def digests(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes whole texts and decodes the ids.

    A null or empty text has no tokens and decodes to the empty text. Rows that
    repeat an id each get a row; other columns are ignored.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        model, rows = automaton(path), []
        for t in texts:
            ids = model.encode(t)
            text = model.decode(ids.tolist())
            rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digest("text").alias("d")).select("doc_id", "d.*")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    """``digests`` of whole ``documents``."""
    return digests(table(spark, sf_dir, "documents"))
