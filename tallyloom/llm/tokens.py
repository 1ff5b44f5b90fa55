"""Token ids of whole texts by a public tokenizer file, with a bounded memory of parts already seen.

The tokenizer drops white space and never joins text across it, and cuts what is left into letters, single digits and
runs of other characters before it looks for tokens. Texts of ASCII and precomposed Latin-1 letters are cut in the same
way here, in one search, and their new parts are encoded in a few calls, told apart by the tokens that end a part or, for
vocabularies without such tokens, by a special token between them. Words with other characters go to the tokenizer as they are.
"""

from __future__ import annotations

import re

import numpy as np

_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \t-\r]+")
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ \t-\r]*").fullmatch
_GAPS = re.compile(r"[ \t-\r]+")
_ODD_GAPS = "\x1c\x1d\x1e\x1f"  # white space to str.split(), characters to the tokenizer
_MARK = "<|endoftext|>"
_END = "</w>"  # of tokens that end a part
_WHOLE = "\0"  # before a word that is not cut


class WordTokenizer:
    """Encodes texts to little-endian unsigned 32-bit ids.

    `literal` reads the names of special tokens in a text as ordinary text. About `most_parts` parts are kept; from a
    fuller memory go those that have not been met since it was last full, which changes the time and not the ids.
    """

    def __init__(self, path: str, literal: bool = False, most_parts: int = 1_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marked = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.mark = self.marked.token_to_id(_MARK)
        vocabulary = self.marked.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_END)]] = True
        self.most_parts = most_parts
        self.parts: dict[str, bytes] = {}
        self.met: set[str] = set()

    def _learn(self, new: list[str]) -> None:
        cut = [p for p in new if p[0] != _WHOLE]
        blocks = [cut[i : i + 500] for i in range(0, len(cut), 500)]
        for block, found in zip(blocks, self.marked.encode_batch_fast([" ".join(b) for b in blocks], add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)]) + 1
            if len(ends) != len(block) or ends[-1] != len(ids):
                ids, ends = self._marked(block)
            data, cuts = ids.tobytes(), (4 * ends).tolist()
            for part, a, b in zip(block, [0, *cuts], cuts):
                self.parts[part] = data[a:b]
        whole = [p for p in new if p[0] == _WHOLE]
        for part, found in zip(whole, self.tokenizer.encode_batch([p[1:] for p in whole], add_special_tokens=False) if whole else ()):
            self.parts[part] = np.array(found.ids, dtype="<u4").tobytes()

    def _marked(self, block: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, end of each part) with a special token between the parts, which is taken out again."""
        ids = np.array(self.marked.encode(_MARK.join(block), add_special_tokens=False).ids, dtype="<u4")
        marks = np.flatnonzero(ids == self.mark)
        return np.delete(ids, marks), np.append(marks - np.arange(len(marks)), len(ids) - len(marks))

    @staticmethod
    def _split(text: str) -> list[str]:
        if "<|" not in text and _PLAIN(text):
            return _PARTS.findall(text.lower())
        odd = any(c in text for c in _ODD_GAPS)
        out: list[str] = []
        for word in _GAPS.split(text) if odd else text.split():
            if "<|" not in word and _PLAIN(word):
                out += _PARTS.findall(word.lower())
            else:
                out.append(_WHOLE + word)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if len(self.parts) > self.most_parts:
            self.parts = {p: self.parts[p] for p in self.met}
            self.met = set()
        split = [self._split(t) for t in texts]
        used: set[str] = set()
        for parts in split:
            used.update(parts)
        new = used.difference(self.parts)
        if new:
            self._learn(list(new))
        self.met |= used
        ids = self.parts.__getitem__
        return [b"".join(map(ids, parts)) for parts in split]


_made: dict[tuple[str, bool], WordTokenizer] = {}


def tokenizer(path: str, literal: bool = False) -> WordTokenizer:
    """One tokenizer for each worker process."""
    if (path, literal) not in _made:
        _made[path, literal] = WordTokenizer(path, literal)
    return _made[path, literal]
