"""Byte-level BPE token ids from the tokenizers library, whole texts, bounded memory.

The library encodes about 1 MB a second. Its pre-tokenizer never lets a token
cross certain places, so a text can be cut there and the pieces encoded apart
with the same ids; most pieces are frequent words, which a bounded memo keeps.
"""

from __future__ import annotations

import os
import re

import numpy as np

# A piece ends only before an ASCII space that follows a non-space, or around
# a single line break between non-spaces. There the pre-tokenizer always
# starts a new token: words take at most one leading space, and runs of spaces
# are tokens of their own. Other Unicode spaces never end a piece.
_TAIL = r"(?:[^\S \t\n\r\f\v]\s*\S*)*"
PIECE = re.compile(rf" ?\S+{_TAIL}|\n(?=\S)|\s+\S*{_TAIL}")
#: Letters, then ASCII punctuation without the apostrophe: two pre-tokens whose cut is certain.
WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")

MEMO_PIECES = 1_000_000    # bound of the memo of one Python worker, about 250 MB when full
MEMO_CHARS = 64            # longer pieces are not kept
RUN_PIECES = 100_000       # pieces of a text held at a time
LONG_TEXT = 1 << 24        # longer texts are taken piece by piece, never split whole


def _byte_signs() -> list[str]:
    """Sign of each byte in the vocabulary: printable Latin-1 signs stand for
    themselves, the others follow from U+0100 on in byte order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Encoder:
    """``ids(text) -> bytes``: the text's token ids, little-endian unsigned,
    ``width`` bytes each (2 if the vocabulary has at most 65,536 ids, else 4)."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.signs = _byte_signs()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.codes = [i.to_bytes(self.width, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.memo: dict[str, bytes] = {}
        self.mid: dict[str, bytes] = {}            # words after a blank, kept without it
        self.after: dict[str, bytes] = {}          # signs that follow a word

    def _whole(self, piece: str) -> bytes:
        return np.asarray(self.tokenizer.encode(piece, add_special_tokens=False).ids, f"<u{self.width}").tobytes()

    def _pretoken(self, s: str) -> bytes:
        mapped = s.replace(" ", self.signs[32]) if s.isascii() else "".join([self.signs[b] for b in s.encode()])
        return b"".join([self.codes[t.id] for t in self.model.tokenize(mapped)])

    def _signs(self, s: str) -> bytes:
        got = self.after.get(s)
        if got is None:
            if len(self.after) >= 10_000:
                self.after.clear()
            got = self.after[s] = self._pretoken(s)
        return got

    def piece(self, piece: str) -> bytes:
        got = self.memo.get(piece)
        if got is None:
            got = self._encode(piece, "", self.piece)
            self._keep(self.memo, piece, got)
        return got

    def inner(self, word: str) -> bytes:
        """Ids of a blank and the word after it."""
        got = self.mid.get(word)
        if got is None:
            got = self._encode(word, " ", self.inner)
            self._keep(self.mid, word, got)
        return got

    def _encode(self, piece: str, blank: str, again) -> bytes:
        bare = piece[1:] if not blank and piece[:1] == " " else piece
        if bare and (m := WORD.fullmatch(bare)):
            word, signs = m.groups()
            if word and signs:                     # a word is encoded once for all signs after it
                return again(piece[:len(piece) - len(signs)]) + self._signs(signs)
            return self._pretoken(blank + piece)
        return self._whole(blank + piece)

    def _keep(self, memo: dict[str, bytes], key: str, ids: bytes) -> None:
        if len(key) <= MEMO_CHARS:
            if len(self.memo) + len(self.mid) >= MEMO_PIECES:
                self.memo.clear()
                self.mid.clear()
            memo[key] = ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        piece, out = self.piece, []
        # unless words are parted by one blank or line break each and by nothing else
        if len(text) > LONG_TEXT or text.split() != text.replace("\n", " ").split(" "):
            run = []
            for m in PIECE.finditer(text):
                run.append(piece(m.group()))
                if len(run) >= RUN_PIECES:
                    out.append(b"".join(run))
                    run = []
            out += run
            return b"".join(out)
        line_end, get, inner = piece("\n"), self.mid.get, self.inner
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(line_end)
            first, *rest = line.split(" ")
            out.append(piece(first))
            out += [get(p) or inner(p) for p in rest]
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """One encoder (and memo) per Python worker."""
    if spec not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[spec] = Encoder(spec)
    return _ENCODERS[spec]


def read_spec(path: str | None = None) -> str:
    """Content of a tokenizer file (a few MB; it is sent to the tasks)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()
