"""Pieces of a SentencePiece model file, as plain tables for workers."""
from __future__ import annotations

import re
from dataclasses import dataclass

import sentencepiece

SPACE = "▁"


@dataclass(frozen=True)
class Pieces:
    """``text`` -> (id, score) of the ordinary pieces, and the ids of the 256 byte pieces.

    Made for models without text normalisation, with a space put before each text and bytes for
    unknown characters; ``load`` refuses others where it can tell.
    """

    name: str
    ids: dict[str, int]
    scores: dict[int, float]
    byte_ids: dict[int, int]

    def names(self) -> dict[int, str]:
        return {i: p for p, i in self.ids.items()}


def load(path: str) -> Pieces:
    """Read on the driver; the tables (about 1 MB) go to the workers with the function."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    special = [i for i in every if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
    byte_ids = {int(model.id_to_piece(i)[3:-1], 16): i for i in special if model.is_byte(i)}
    if len(byte_ids) != 256:
        raise ValueError(f"{path}: no byte pieces")
    if "".join(model.encode("ﬁ  x", out_type=str)) != f"{SPACE}ﬁ{SPACE}{SPACE}x" and model.piece_to_id("ﬁ") != model.unk_id():
        raise ValueError(f"{path}: the model normalises texts")
    left = set(every) - set(special)
    ids = {model.id_to_piece(i): i for i in sorted(left)}
    return Pieces(path, ids, {i: model.get_score(i) for i in left}, byte_ids)


def pretokens(pieces: Pieces):
    """A function that cuts a text where no piece can lie across.

    The cuts are before a space that follows another character and, if no piece has them, around
    line ends.
    """
    if any(SPACE in p.lstrip(SPACE) for p in pieces.ids):
        raise ValueError("a piece has a space after another character")
    if any("\n" in p for p in pieces.ids):
        find = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
    else:
        find = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall

    def cut(text: str | None) -> list[str]:
        return find(SPACE + text.replace(" ", SPACE)) if text else []

    return cut
