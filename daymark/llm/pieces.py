"""The lattice of a SentencePiece vocabulary: weights of pieces, which pieces may follow each other, best paths.

A path is a row of pieces that spell a text; its weight is the sum of its pieces' weights, and minus infinity where two
neighbours may not meet. In a unigram vocabulary all may meet and weights are scores. In a BPE vocabulary weights are 0 and two pieces may
meet only if merging their joint text by rank gives these two again; a row of pieces with that property everywhere is what merging the
whole text gives, as no merge inside one pair ever depends on symbols outside of it, and there is exactly one such row.
"""

from __future__ import annotations

import gc
import re
from functools import lru_cache

import numpy as np

from daymark.llm.common import CACHES

SPACE = "▁"
#: Latin letters, as a character class; a vocabulary is asked whether its pieces mix them with other characters.
LETTERS = "A-Za-z\u00c0-\u024f"
MINUS = float("-inf")
#: Entries of each memo a Python worker keeps. Memos are cleared when full; that of words first lets go of those not met for a while.
MEMO = 200_000
#: Characters whose longest piece is looked up at once.
HEAD = 4


class Lattice:
    """Pieces with ids and scores. A character without a piece stands for its bytes, or for the unknown id."""

    def __init__(self, pieces: dict[str, tuple[int, float]], bytes_at: int | None, unknown: int, merges: bool, texts: list[str] | None = None):
        self.pieces, self.bytes_at, self.unknown, self.merges = pieces, bytes_at, unknown, merges
        self.longest = max(map(len, pieces), default=1)
        self.worst = min((s for _, s in pieces.values()), default=0.0) - 10.0
        self.texts = texts or []
        self._prefixes: dict[str, bool] = {}
        self._shorter: dict[str, str] = {}
        self._heads: dict[str, tuple[str, bool]] = {}
        self._after: dict[str | None, dict[str, bool]] = {}
        self._codes: dict[str, bytes] = {}
        self._whole: dict[str, bool] = {}
        self._words = _Words(self)
        met = lambda pattern: any(re.search(pattern, p) for p in pieces)
        spaced, lined = met(f"[^{SPACE}]{SPACE}"), met("\n.|.\n")
        lettered = met(f"[{LETTERS}][^{LETTERS}]") or met(f"[^{SPACE}{LETTERS}][{LETTERS}]")
        #: Texts fall apart at these places whatever the path, as no piece reaches across.
        words = f"{SPACE}*[^{SPACE}\n]+" if lettered else f"{SPACE}*[{LETTERS}]+|{SPACE}*[^{SPACE}\n{LETTERS}]+"
        self.cut = re.compile("(?s).+" if spaced or lined else f"\n|{words}|{SPACE}+")
        self.falls_apart = not (spaced or lined)

    def merged(self, text: str) -> list[str]:
        """Symbols after merging by score, of equal scores the leftmost first."""
        symbols = list(text)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                found = self.pieces.get(symbols[i] + symbols[i + 1])
                if found and (best is None or found[1] > best):
                    best, at = found[1], i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def weight(self, piece: str) -> float | None:
        """None if it is no piece that a path may hold."""
        found = self.pieces.get(piece)
        if found is None:
            return (0.0 if self.merges else self.worst) if len(piece) == 1 else None
        if not self.merges:
            return found[1]
        whole = self._whole.get(piece)
        if whole is None:
            whole = self._whole[piece] = len(self.merged(piece)) == 1
        return 0.0 if whole else None

    def meet(self, left: str | None, right: str) -> bool:
        return left is None or not self.merges or self.merged(left + right) == [left, right]

    def ids(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        if found:
            return [found[0]]
        if self.bytes_at is None:
            return [self.unknown]
        return [self.bytes_at + b for b in piece.encode("utf-8", "surrogatepass")]

    def forward(self, text: str, start: int, before: str | None, stop: int) -> dict[int, tuple[float, int, str | None]]:
        """Best path from ``start``, where ``before`` has just ended, to every place up to ``stop``: weight, where its last piece begins, that piece."""
        reached: dict[int, tuple[float, int, str | None]] = {start: (0.0, -1, before)}
        if self.merges:
            return self._merging(text, start, stop, reached)
        for end in range(start + 1, stop + 1):
            best, found = MINUS, None
            for begin in range(max(start, end - self.longest), end):
                last = reached.get(begin)
                if last is None:
                    continue
                piece = text[begin:end]
                weight = self.weight(piece)
                if weight is None or last[0] + weight <= best or not self.meet(last[2], piece):
                    continue
                best, found = last[0] + weight, (last[0] + weight, begin, piece)
            if found:
                reached[end] = found
        return reached

    def _merging(self, text: str, start: int, stop: int, reached: dict) -> dict:
        """The same where all weights are 0: the first row of pieces to a place is the only one."""
        begins, after = self._begins(), self._after
        for begin in range(start, stop):
            if begin not in reached:
                continue
            last = reached[begin][2]
            known = after.get(last)
            if known is None:
                known = self._followers(last)
            for end in range(begin + 1, stop + 1):
                piece = text[begin:end]
                kind = begins.get(piece)
                if kind is None:
                    if end > begin + 1:
                        break
                    kind = True  # a character without a piece
                if kind and end not in reached:
                    fits = known.get(piece)
                    if fits is None:
                        fits = known[piece] = self.meet(last, piece)
                    if fits:
                        reached[end] = (0.0, begin, piece)
        return reached

    def _begins(self) -> dict[str, bool]:
        """All beginnings of pieces, and whether they are pieces that a path may hold."""
        if not self._prefixes:
            for piece in self.pieces:
                for k in range(1, len(piece)):
                    self._prefixes.setdefault(piece[:k], False)
                self._prefixes[piece] = self.weight(piece) is not None
            for piece in self.pieces:
                ends = [k for k in range(1, len(piece)) if self._prefixes[piece[:k]]]
                if ends:
                    self._shorter[piece] = piece[: ends[-1]]
        return self._prefixes

    def _followers(self, last: str | None) -> dict[str, bool]:
        if len(self._after) >= MEMO // 8:
            self._after.clear()
        return self._after.setdefault(last, {})

    @staticmethod
    def back(reached: dict, end: int) -> list[str]:
        out = []
        while reached[end][1] >= 0:
            out.append(reached[end][2])
            end = reached[end][1]
        return out[::-1]

    def word(self, text: str) -> tuple[bytes, float]:
        """Ids (32 bits each) and weight of the best path through a text that stands by itself."""
        if self.merges and len(text) <= 64:
            return self._short_word(text), 0.0
        reached = self.forward(text, 0, None, len(text))
        return b"".join([self.coded(piece) for piece in self.back(reached, len(text))]), reached[len(text)][0]

    def _short_word(self, text: str) -> bytes:
        """The same for merges, depth first from the longest pieces: places where no row of pieces goes on are met once."""
        after, shorter, size = self._after, self._shorter, len(text)
        path: list[str] = []
        dead: set[tuple[int, str | None]] = set()
        begin, before, piece = 0, None, self._at(text, 0, size) if size else None
        while begin < size:
            known = after.get(before)
            if known is None:
                known = self._followers(before)
            while piece is not None:
                fits = known.get(piece)
                if fits is None:
                    fits = known[piece] = self.meet(before, piece)
                if fits and not (dead and (begin + len(piece), piece) in dead):
                    break
                piece = shorter.get(piece)
            else:
                dead.add((begin, before))
                begin -= len(path.pop())
                piece, before = shorter.get(before), path[-1] if path else None
                continue
            path.append(piece)
            begin += len(piece)
            before = piece
            if begin < size:
                piece = self._at(text, begin, size)
        codes = self._codes
        return b"".join([codes.get(piece) or self.coded(piece) for piece in path])

    def _at(self, text: str, begin: int, size: int) -> str:
        """The longest piece that begins at a place; a character without a piece stands for itself."""
        head = text[begin : begin + HEAD]
        found = self._heads.get(head)
        if found is None:
            if len(self._heads) >= MEMO // 2:
                self._heads.clear()
            found = self._heads[head] = self._head(head)
        piece, more = found
        if more:
            begins = self._begins()
            for end in range(begin + HEAD + 1, size + 1):
                longer = text[begin:end]
                kind = begins.get(longer)
                if kind is None:
                    break
                if kind:
                    piece = longer
        return piece

    def _head(self, head: str) -> tuple[str, bool]:
        """The longest piece that a few characters begin with, and whether longer pieces may begin with all of them."""
        begins, piece = self._begins(), head[0]
        for end in range(1, len(head) + 1):
            kind = begins.get(head[:end])
            if kind is None:
                return piece, False
            if kind:
                piece = head[:end]
        return piece, len(head) == HEAD

    def coded(self, piece: str) -> bytes:
        """Ids of a piece, 32 bits each."""
        found = self._codes.get(piece)
        if found is None:
            found = np.array(self.ids(piece), dtype="<i4").tobytes()
            if len(self._codes) < MEMO:
                self._codes[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text in which nothing stands before or behind."""
        return b"".join(map(self._words.__getitem__, self.cut.findall(text)))

    def measure(self, text: str) -> float:
        """Weight of the best path of such a text."""
        return 0.0 if self.merges else sum(self.word(w)[1] for w in self.cut.findall(text))


class _Words(dict):
    """Ids by word, up to a bound in two halves: a full half becomes the older one, whose words come back when they are met again and go if not."""

    def __init__(self, lattice: Lattice):
        super().__init__()
        self.lattice = lattice
        self.older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        out = self.older.get(text)
        if out is None:
            out = self.lattice.word(text)[0]
        if len(text) <= 64:
            if len(self) >= MEMO // 2:
                self.older = dict(self)
                self.clear()
            self[text] = out
        return out


@lru_cache(maxsize=4)
def load(model: bytes) -> Lattice:
    """The lattice of a SentencePiece model file's content."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces, texts, bytes_at = {}, [], None
    for i in range(sp.vocab_size()):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(name[3:5], 16)
            bytes_at = i if value == 0 else bytes_at
            texts.append(chr(value) if value < 128 else chr(0xDC00 + value))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            texts.append(" ⁇ " if sp.is_unknown(i) else "")
        else:
            pieces[name] = (i, sp.get_score(i))
            texts.append(name.replace(SPACE, " "))
    # the kind of the model shows in what it does to a text: merging gives scores that are ranks
    ranks = [s for _, s in pieces.values()]
    return Lattice(pieces, bytes_at, sp.unk_id(), all(s == int(s) for s in ranks), texts)


def drop_models() -> None:
    """A lattice and its words know each other, so without a collection the memory of a dropped one is freed late or never."""
    if load.cache_info().currsize:
        load.cache_clear()
        gc.collect()


# models and their memos outlive the step that needs them, see common.trim
CACHES.append(drop_models)
