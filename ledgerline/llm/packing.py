"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every task of the scan packs its own documents.  A document's ids (and an end id) fill whole
windows first; the rest, of size s, goes to the fill level h for which the sum over levels of
the squared number of windows filled to that level grows least (h = 0 opens a window).  The
level array holds these numbers.  When the input of a task ends, the few windows still open
are cut anew: their pieces are laid end to end into full windows, and the last ids into windows
whose lengths are powers of two, which need no padding.

Open windows are all that a task holds: their ids, at most one window a fill level and item
size in practice.  Sequence ids are task number * 2**32 + a count, so tasks share nothing and
a repeated task gives the same rows.

Defined cases: null text counts as empty (one id, the end id); a null id is carried; repeated
rows are packed each on its own; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, held, per_batch, tokenizer_file

WINDOW = 2048
END_ID = 1
MEMO_WORDS = 1_000_000
LONG_WORD = 64
#: With these, lower case before composition may differ from lower case after it, or make an
#: added token of the text.
UNSAFE = re.compile("[\u0300-\u036f\u03a3]|<[|]")
DIGITS = frozenset("0123456789")
#: ASCII punctuation but the apostrophe, and what lies between.
PARTS = re.compile(r"[!-&(-/:-@\[-`{-~]+|[^!-&(-/:-@\[-`{-~]+")

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others for 256, 257, ..."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of whole texts by a word-level memo over a tokenizer that lower-cases and drops
    white space.  Runs of letters go to its model at once, all else through its whole chain."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.letters = byte_letters()
        self.words = Memo(MEMO_WORDS)

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        out = []
        for text in texts:
            if text and not UNSAFE.search(text):
                text = text.lower()
            words = text.replace("\n", " ").split(" ") if text else []
            found = list(map(self.words.get, words))
            if None in found:
                fresh = self.look_up({w for w, f in zip(words, found) if f is None})
                found = [fresh[w] if f is None else f for w, f in zip(words, found)]
            out.append(np.frombuffer(b"".join(found), "<u4"))
        return out

    def look_up(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words; ASCII punctuation beside letters or digits is a word of its own to the
        tokenizer, so what lies between comes from the memo too."""
        known: dict[str, bytes] = {}
        chain: set[str] = set()
        parts: dict[str, list[str]] = {}
        get = self.words.get
        for w in words:
            parts[w] = found = [w] if w.isalpha() else self.parts(w)
            for p in found:
                if p not in known:
                    ids = get(p)
                    if ids is None and p.isalpha() and p == p.lower() and (
                            p.isascii() or unicodedata.is_normalized("NFC", p)):
                        ids = self.letter_ids(p)
                    if ids is None:
                        chain.add(p)
                    else:
                        known[p] = ids
        if chain:
            order = sorted(chain)
            for p, e in zip(order, self.tok.encode_batch_fast(order, add_special_tokens=False)):
                known[p] = array("I", e.ids).tobytes()
        out = {}
        for w, ps in parts.items():
            out[w] = ids = known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps])
            if len(w) <= LONG_WORD:
                self.words.put(w, ids)
        for p, ids in known.items():
            if len(p) <= LONG_WORD:
                self.words.put(p, ids)
        return out

    def letter_ids(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    @staticmethod
    def parts(word: str) -> list[str]:
        found = PARTS.findall(word) if len(word) <= LONG_WORD and "<|" not in word else [word]
        for a, b in zip(found, found[1:]):
            if not (a[-1].isalpha() or a[-1] in DIGITS or b[0].isalpha() or b[0] in DIGITS):
                return [word]
        return found or [word]


@held
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


class Packer:
    """Level array and open windows of one task."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        self.level = np.zeros(window + 1, np.int64)
        self.open: list[list[tuple[int, list]]] = [[] for _ in range(window + 1)]
        self.rows: list[tuple] = []

    def emit(self, sequence: int, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset))
            offset += len(ids)

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, doc, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        whole = n // w * w
        for at in range(0, whole, w):
            self.emit(self.new(), [(doc, at, ids[at:at + w], n)])
        s = n - whole
        if s == 0:
            return
        h = self.choose(s)
        sequence, pieces = self.open[h].pop() if h else (self.new(), [])
        pieces.append((doc, whole, ids[whole:].copy(), n))
        self.level[h] -= h > 0
        if h + s == w:
            self.emit(sequence, pieces)
        else:
            self.level[h + s] += 1
            self.open[h + s].append((sequence, pieces))

    def choose(self, s: int) -> int:
        """The level whose use makes the sum of squares smallest, the fullest among equals."""
        w, level = self.window, self.level
        used = np.flatnonzero(level[1:w - s + 1]) + 1
        best, cost = 0, 2 * level[s] + 1
        if len(used):
            gain = 2 * (level[used + s] - level[used]) + 2
            if used[-1] + s == w:
                gain[-1] = 1 - 2 * level[used[-1]]
            k = len(gain) - 1 - int(np.argmin(gain[::-1]))
            if gain[k] <= cost:
                best = int(used[k])
        return best

    def flush(self) -> None:
        """Cut what is left in open windows into full ones, then into powers of two."""
        left = [p for level in reversed(self.open) for _, pieces in level for p in pieces]
        size = sum(len(p[2]) for p in left)
        room, pieces = 0, []
        for doc, start, ids, total in left:
            at = 0
            while at < len(ids):
                if room == 0:
                    if pieces:
                        self.emit(self.new(), pieces)
                    room, pieces = (self.window if size >= self.window else 1 << (size.bit_length() - 1)), []
                    size -= room
                take = min(room, len(ids) - at)
                pieces.append((doc, start + at, ids[at:at + take], total))
                at += take
                room -= take
        if pieces:
            self.emit(self.new(), pieces)
        self.open = [[] for _ in range(self.window + 1)]
        self.level[:] = 0

    def take(self) -> dict:
        cols = list(zip(*self.rows)) or [[] for _ in range(7)]
        self.rows = []
        return dict(zip("doc_id start length ids_crc32 doc_tokens sequence_id offset".split(), cols))


class _Task:
    def __init__(self, path: str, window: int, end_id: int):
        self.tok, self.end = word_tokenizer(path), np.array([end_id], "<u4")
        self.packer = Packer(window, TaskContext.get().partitionId() << 32)

    def __call__(self, batch: pa.RecordBatch) -> dict:
        docs, texts = batch.column(0).to_pylist(), batch.column(1)
        for i in range(0, len(docs), 256):
            for doc, ids in zip(docs[i:i + 256], self.tok.ids(texts[i:i + 256].to_pylist())):
                self.packer.add(doc, np.concatenate([ids, self.end]))
        return self.packer.take()

    def finish(self) -> dict:
        self.packer.flush()
        return self.packer.take()


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence."""
    path = path or tokenizer_file("word_bpe_49k.json")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return per_batch(src, SCHEMA, lambda: _Task(path, window, end_id), finish="finish")
