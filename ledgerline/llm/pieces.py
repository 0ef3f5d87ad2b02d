"""SentencePiece (BPE type) encoding and decoding by backtracking.

A text is encoded from longest Aho-Corasick matches.  A token may follow another only if the
two, joined and merged again from single characters, come apart at the same place.  When no
match fits, the last token is taken back and the position it began at is marked in a bitfield
of failed positions, so that no position is tried twice.  Adjacent compatibility of all tokens
is what makes a segmentation the merge order's own, so the result equals the library's.

Words repeat, hence a bounded memo by word: pieces hold the word mark only as a prefix and
characters of no piece (a line feed) stand alone, so a text falls apart at these places
without changing its ids.

Defined cases: a null or empty text has no ids and decodes to the empty text; rows with a
null id, repeated rows and extra columns are carried; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, held, per_batch, tokenizer_file

MARK = "▁"
MEMO_WORDS = 1_000_000
MEMO_PAIRS = 400_000
LONG_WORD = 64
PARTS = re.compile(f"{MARK}*[^\\W_]+|{MARK}*[^\\w{MARK}]+|{MARK}+|_+")


class PieceModel:
    """Vocabulary, merge scores and flags of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != 2 or proto.normalizer_spec.precompiled_charsmap:
            raise ValueError("a BPE model with identity normalisation is expected")
        self.dummy_prefix = proto.normalizer_spec.add_dummy_prefix
        if proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("a model that keeps white space is expected")
        kinds = proto.SentencePiece
        self.text = [p.piece for p in proto.pieces]
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.control: set[int] = set()
        self.unk = 0
        for i, p in enumerate(proto.pieces):
            if p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.ids[p.piece], self.score[p.piece] = i, p.score
            elif p.type == kinds.BYTE:
                b = int(p.piece[3:5], 16)
                self.byte_id[b], self.byte_of[i] = i, b
            elif p.type == kinds.UNKNOWN:
                self.unk = i
            else:
                self.control.add(i)
        self.unk_surface = proto.trainer_spec.unk_surface
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a model whose pieces hold the word mark as a prefix is expected")
        known = set("".join(self.ids))
        alone = "" if "\n" in known else "\n"
        self.line_alone = bool(alone)
        self.split = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + ("|\n" if alone else ""))
        self.matcher = ahocorasick.Automaton()
        for p in self.ids:
            self.matcher.add_word(p, (len(p) - 1, p))
        self.matcher.make_automaton()
        self.pairs = Memo(MEMO_PAIRS)
        self.shorter = Memo(MEMO_PAIRS)
        self.words = Memo(MEMO_WORDS)
        self.spaced = [p.replace(MARK, " ") for p in self.text]
        self.shown = {p: str(i) for p, i in self.ids.items()}
        self.surface_of = {str(i): p for i, p in enumerate(self.spaced)
                           if i != self.unk and i not in self.byte_of and i not in self.control}
        #: Neighbours inside some piece; between any others a word may be parted.
        self.within = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}

    def remerge(self, text: str) -> list[str]:
        """Merge single characters, best score first, leftmost among equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: str, b: str) -> bool:
        """Whether b may follow a (or, after nothing, whether merging makes b at all)."""
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        return self.pairs.put((a, b), self.remerge(a + b) == ([a, b] if a else [b]))

    def next_prefix(self, piece: str) -> str:
        """The longest shorter piece that begins it, a single character at least, or nothing."""
        n = len(piece) - 1
        while n > 1 and piece[:n] not in self.ids:
            n -= 1
        return self.shorter.put(piece, piece[:n]) if n else ""

    def segment(self, word: str) -> list[str]:
        """The pieces (or single characters outside the vocabulary) of one word."""
        n = len(word)
        if n == 1:
            return [word]
        if word.startswith(MARK * 2):  # white-space pieces share one score: merge them directly
            cut = n - len(word.lstrip(MARK))
            if cut <= LONG_WORD:
                tail = self.segment(word[cut - 1:]) if cut < n else [MARK]
                if cut == n or tail[0] != MARK:
                    return self.remerge(MARK * (cut - (cut < n))) + (tail if cut < n else [])
                return self.remerge(MARK * cut) + tail[1:]
            return self.merge_long(word)
        pairs, shorter = self.pairs, self.shorter
        last = ""
        out: list[str] = []
        for _, (_, piece) in self.matcher.iter_long(word):  # as long as longest matches fit
            if not pairs.get((last, piece)) and not self.fits(last, piece):
                break
            out.append(piece)
            last = piece
        else:
            if sum(map(len, out)) == n:
                return out
        longest: list[str | None] = [None] * n
        for end, (back, piece) in self.matcher.iter(word):
            longest[end - back] = piece  # of one start, longer pieces come later
        failed = bytearray(n + 1)
        out, pos, last = [], 0, ""
        piece = longest[0] or word[0]
        while True:
            end = pos + len(piece)
            if not failed[end]:
                if pairs.get((last, piece)) or self.fits(last, piece):
                    if end == n:
                        out.append(piece)
                        return out
                    out.append(piece)
                    last, pos = piece, end
                    piece = longest[pos] or word[pos]
                    continue
            piece = shorter.get(piece) or self.next_prefix(piece)
            while not piece:  # nothing fits here: take the last token back
                if not out:
                    return self.remerge(word)
                failed[pos] = 1
                piece = out.pop()
                pos -= len(piece)
                last = out[-1] if out else ""
                piece = shorter.get(piece) or self.next_prefix(piece)

    def merge_long(self, word: str) -> list[str]:
        """A long run of word marks, by a queue of merges: n log n steps."""
        import heapq

        parts: list[str | None] = list(word)
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n:
                s = self.score.get(parts[i] + parts[j])
                if s is not None:
                    heapq.heappush(heap, (-s, i, len(parts[i]), len(parts[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i] if parts[i] is not None else n
            if j >= n or parts[j] is None or len(parts[i]) != a or len(parts[j]) != b:
                continue
            parts[i] += parts[j]
            parts[j] = None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in parts if p is not None]

    def word_ids(self, word: str) -> list[int]:
        out: list[int] = []
        for piece in self.segment(word):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_id:
                out.extend(self.byte_id[b] for b in piece.encode("utf-8"))
            else:
                out.append(self.unk)
        return out

    def word(self, word: str) -> str:
        """Ids as decimal text of a word; that they decode to the word is checked here."""
        parts = self.parts(word) if len(word) <= LONG_WORD else ()
        if len(parts) > 1:
            get, make = self.words.get, self.word
            ids = ",".join([get(p) or make(p) for p in parts])
        else:
            found = list(map(self.shown.get, self.segment(word)))
            if None in found:  # characters outside the vocabulary, as bytes
                codes = self.word_ids(word)
                if self.surface(codes) != word.replace(MARK, " "):
                    raise ValueError("a word's ids do not decode to it")
                found = map(str, codes)
            ids = ",".join(found)
        return self.words.put(word, ids) if len(word) <= LONG_WORD else ids

    def parts(self, word: str) -> list[str]:
        """The word, parted beside punctuation where no piece holds both neighbours."""
        found = PARTS.findall(word)
        if len(found) > 1 and any(a[-1] + b[0] in self.within for a, b in zip(found, found[1:])):
            return [word]
        return found

    def cut(self, text: str) -> list[str]:
        """The words of a text, each encoded on its own."""
        if not self.dummy_prefix or MARK in text or "  " in text or text[0] == " " or not self.line_alone:
            return self.split.findall((MARK if self.dummy_prefix else "") + text.replace(" ", MARK))
        return list(filter(None, (MARK + text).replace(" ", " " + MARK).replace("\n", " \n ").split(" ")))

    def joined(self, text: str | None) -> str:
        """All ids of a text as decimal text."""
        if not text:
            return ""
        words = self.cut(text)
        found = list(map(self.words.get, words))
        if None in found:
            make = self.word
            found = [f or make(w) for f, w in zip(found, words)]
        return ",".join(found)

    def encode(self, text: str | None) -> list[int]:
        ids = self.joined(text)
        return [int(i) for i in ids.split(",")] if ids else []

    def surface(self, ids: list[int]) -> str:
        """Text of ids, word marks as blanks, the added prefix still there."""
        out: list[str] = []
        pending = bytearray()

        def flush() -> None:
            rest = bytes(pending)
            while rest:
                try:
                    out.append(rest.decode("utf-8"))
                    break
                except UnicodeDecodeError as e:
                    out.append(rest[:e.start].decode("utf-8") + "�")
                    rest = rest[e.start + 1:]
            pending.clear()

        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                pending.append(b)
                continue
            if pending:
                flush()
            if i == self.unk:
                out.append(self.unk_surface)
            elif i not in self.control:
                out.append(self.spaced[i])
        if pending:
            flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        return self.strip(self.surface(ids))

    def decode_joined(self, joined: str) -> str:
        """``decode`` of ids in decimal; runs without bytes go by a table of surfaces."""
        if not joined:
            return ""
        shown = joined.split(",")
        found = list(map(self.surface_of.get, shown))
        if None in found:
            return self.decode(list(map(int, shown)))
        return self.strip("".join(found))

    def strip(self, text: str) -> str:
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@held
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_table(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", ids: bool = True, digests: bool = False) -> DataFrame:
    """Per row: id, n_tokens, and on request the ids (array<int>) with the decoded text, or
    SHA-256 digests of the comma-joined ids and of the decoded text.  Rows stay in place: the
    work is one pass over the scan, without a shuffle."""
    path = path or tokenizer_file("piece_bpe_32k.model")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_tokens long" + (", ids array<int>, decoded string" if ids else "") + (
        ", ids_sha256 string, decoded_sha256 string" if digests else "")

    def make():
        m = model(path)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict = {"doc_id": batch.column(0), "n_tokens": [], "ids": [], "decoded": [],
                         "ids_sha256": [], "decoded_sha256": []}
            for value in batch.column(1):
                text = value.as_py()
                joined = m.joined(text)
                out["n_tokens"].append(joined.count(",") + 1 if joined else 0)
                found = np.array(joined.split(","), "<i4") if ids and joined else np.empty(0, "<i4")
                decoded = m.decode(found.tolist()) if ids else m.decode_joined(joined)
                if ids:
                    out["ids"].append(found)
                    out["decoded"].append(decoded)
                if digests:
                    out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            return out

        return work

    return per_batch(src, schema, make)
