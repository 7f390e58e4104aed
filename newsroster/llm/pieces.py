"""Piece vocabularies, pre-tokens, and the trie of pre-tokens that lattices share."""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass

import numpy as np

LINE_TOKEN = re.compile(r" *[^ ]+| +")


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as strings with plain blanks, and what single bytes cost.

    Merge-based models store no probabilities, only the rank of each piece. By Zipf's law the
    piece of rank r gets a probability proportional to 1 / (r + 1); a byte as probable as the
    last piece. The vocabulary is a constant of bounded size and travels with the tasks.
    """

    ids: dict[str, int]
    log_p: dict[str, float]
    byte_ids: tuple[int, ...]
    byte_log_p: float
    size: int

    @staticmethod
    def load(path: str | None = None) -> Vocabulary:
        """Read a sentencepiece model on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or default_model_path())
        n = model.get_piece_size()
        byte_ids = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
        own = [(model.id_to_piece(i).replace("▁", " "), i) for i in range(n)
               if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                       or model.is_unused(i))]
        if len(byte_ids) != 256 or any(" " in p.lstrip(" ") for p, _ in own):
            raise ValueError("needs byte pieces, and no piece with a blank after other characters")
        whole = math.log(sum(1 / (r + 1) for r in range(len(own))))
        log_p = {p: -math.log(r + 1) - whole for r, (p, _) in enumerate(own)}
        return Vocabulary(
            dict(own), log_p, tuple(byte_ids[f"<0x{b:02X}>"] for b in range(256)),
            -math.log(len(own)) - whole, n)

    def bytes_of(self) -> list[bytes]:
        """What each id stands for; control ids stand for nothing."""
        table = [b""] * self.size
        for piece, i in self.ids.items():
            table[i] = piece.encode()
        for b, i in enumerate(self.byte_ids):
            table[i] = bytes([b])
        return table

    def by_suffix(self) -> dict[str, float | None]:
        """Log probabilities of pieces, and None for what only ends a piece."""
        return {p[i:]: self.log_p.get(p[i:]) for p in self.ids for i in range(len(p))}


class _Numbers(dict):
    """Numbers strings as they come; new ones are noted in ``fresh``."""

    def __init__(self, owner: TokenNumbers, lead: str):
        super().__init__()
        self.owner, self.lead = owner, lead

    def __missing__(self, token: str) -> int:
        number = self[token] = self.owner.count
        self.owner.count += 1
        self.owner.fresh.append(self.lead + token)
        return number


class TokenNumbers:
    """Cuts texts into pre-tokens and numbers the distinct ones.

    A text gets one blank in front. A pre-token is a run of blanks and what follows it up to the
    next blank or line break, or a line break alone (always number 0). No piece reaches over the
    start of a pre-token, so they can be segmented one by one.
    """

    def __init__(self):
        self.clear()

    def clear(self):
        self.count, self.fresh = 1, ["\n"]
        self.spaced, self.bare = _Numbers(self, " "), _Numbers(self, "")

    def take_fresh(self) -> list[str]:
        """The pre-tokens numbered since the last call, by rising number."""
        fresh, self.fresh = self.fresh, []
        return fresh

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pre-tokens of all texts in a row, and how many each text has."""
        found, sizes = array("i"), []
        spaced, bare = self.spaced.__getitem__, self.bare
        for text in texts:
            before = len(found)
            for k, line in enumerate((" " + text).split("\n") if text else ()):
                if k:
                    found.append(0)
                if "  " in line or line[-1:] == " ":
                    tokens = LINE_TOKEN.findall(line)
                    first = tokens.pop(0) if tokens[0][0] != " " else ""
                    rest = [t[1:] for t in tokens]
                else:
                    first, *rest = line.split(" ")
                if first:
                    found.append(bare[first])
                found.extend(map(spaced, rest))
            sizes.append(len(found) - before)
        return np.array(found, np.int64), np.array(sizes, np.int64)


def new_depth(previous: str, token: str) -> int:
    """Length of the prefix that two strings share."""
    most = min(len(previous), len(token))
    for k in range(most):
        if previous[k] != token[k]:
            return k
    return most


def slices(sizes, most_chars: int = 500_000):
    """Ranges of neighbouring rows with at most ``most_chars`` characters, or one row."""
    begin, total = 0, 0
    for k, n in enumerate(sizes):
        if k > begin and total + n > most_chars:
            yield begin, k
            begin, total = k, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)
