"""Whole texts to token ids through a bounded cache of text pieces.

A byte-level BPE works inside pre-tokens. A single blank in front of a word always opens one, and
a single line end between words is one by itself. So where all white space of a text is of that
kind, its words are encoded once each and the ids strung together: same ids, a fraction of the
work. Any other text is encoded in one piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

CACHED_PIECES = 500_000
CUT = "\0"
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TOGETHER = ("  ", " \n", "\n ", "\n\n", CUT)


class PieceEncoder:
    """Ids of texts as bytes. ``encode_pieces`` gives the id bytes of each of a list of texts."""

    def __init__(self, encode_pieces: Callable[[list[str]], Iterable[bytes]], cached: int = CACHED_PIECES):
        self.encode_pieces, self.cached = encode_pieces, cached
        self.fixed = {"": b"", "\n": next(iter(encode_pieces(["\n"])))}
        self.known = dict(self.fixed)
        self.signs = dict(zip(_SIGNS, encode_pieces(list(_SIGNS)), strict=True))

    @staticmethod
    def cut(text: str) -> list[str] | None:
        """Words with their leading blank, and line ends; None if the text cannot be cut so."""
        for pair in _TOGETHER:
            if pair in text:
                return None
        if "\n" in text:
            text = text.replace("\n", "\0\n\0")
        return text.replace(" ", "\0 ").split(CUT)

    def forget(self) -> None:
        self.known.clear()
        self.known.update(self.fixed)

    def _learn(self, words: list[str]) -> None:
        """Encode words that are not known. A single sign behind letters is a pre-token of its own."""
        known, signs = self.known, self.signs
        signed = [w for w in words if w[-1] in signs and w[:-1].lstrip(" ").isalpha()]
        whole = {*words}.difference(signed)
        whole.update(b for b in {w[:-1] for w in signed} if b not in known)
        fresh = list(whole)
        if fresh:
            known.update(zip(fresh, self.encode_pieces(fresh), strict=True))
        known.update((w, known[w[:-1]] + signs[w[-1]]) for w in signed)

    def encode(self, texts: list[str]) -> list[bytes]:
        known, get = self.known, self.known.get
        cuts = [self.cut(text) for text in texts]
        found = [None if cut is None else list(map(get, cut)) for cut in cuts]
        gaps = [[] if ids is None else [k for k, x in enumerate(ids) if x is None] for ids in found]
        new = {cut[k] for cut, own in zip(cuts, gaps, strict=True) for k in own}
        # A piece with white space of another kind is not kept, and its texts are encoded as a whole.
        self._learn([p for p in new if len(p.split()) == 1 and not p[-1].isspace() and not p.lstrip(" ")[0].isspace()])
        for i, own in enumerate(gaps):
            for k in own:
                ids = get(cuts[i][k])
                if ids is None:
                    found[i] = None
                    break
                found[i][k] = ids
        out = [next(iter(self.encode_pieces([text]))) if ids is None else b"".join(ids) for text, ids in zip(texts, found, strict=True)]
        if len(known) > self.cached:
            self.forget()
        return out
