"""Token ids of whole texts by a public tokenizer file, with a memo of white-space chunks.

The word tokenizer drops white space, so a text's ids are those of its white-space
chunks in order. Chunks recur, so each worker keeps a bounded memo of their ids.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

import numpy as np

END_OF_WORD_TOKENIZER = "word_bpe_49k.json"
MEMO_CHUNKS = 400_000
_LOADED: dict[str, "ChunkEncoder"] = {}


def tokenizer_path(name: str = END_OF_WORD_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_MARKS = b".,;:!?"
_LAST_SIMPLE = "\u024f"  # up to here composed letters are stable and lower case goes letter by letter


class ChunkEncoder:
    """Encodes texts with a tokenizer whose ids don't depend on white space between chunks, nor
    on the case of ASCII letters.

    ``memo`` bounds the chunks whose ids are kept; the memo starts anew when it is full,
    which changes speed, not ids.
    """

    def __init__(self, path: str, memo: int = MEMO_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # for words of simple lower-case letters the rest of the normalizer and the splitting have nothing to do
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.memo, self.known = memo, {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            self.ends_word[i] = token.endswith("</w>")
        self.marks = dict(zip(_MARKS, (x.tobytes() for x in self._encode(self.tokenizer, [chr(m) for m in _MARKS]))))

    @staticmethod
    def _encode(tokenizer, texts: list[str]) -> list[np.ndarray]:
        found = []
        for i in range(0, len(texts), 1_000):
            for e in tokenizer.encode_batch_fast(texts[i : i + 1_000], add_special_tokens=False):
                found.append(np.array(e.ids, dtype="<u4"))
        return found

    @staticmethod
    def _simple(chunk: bytes) -> bool:
        if chunk.isascii():
            return chunk.isalpha()
        s = chunk.decode("utf-8", "replace")
        return s.isalpha() and max(s) <= _LAST_SIMPLE and s.lower().isalpha()

    def _learn(self, chunks: set[bytes]) -> None:
        """Puts the ids of new chunks into the memo.

        A chunk of simple letters is one word to the tokenizer; such words are encoded many at
        once and cut at the ends of words. One more mark behind a word is a word of its own.
        """
        known, simple, words, marked, single = self.known, self._simple, set(), [], []
        for c in chunks:
            if simple(c):
                words.add(c)
            elif c[-1] in self.marks and simple(c[:-1]):
                marked.append(c)
                if c[:-1] not in known:
                    words.add(c[:-1])
            else:
                single.append(c)
        ordered = list(words)
        groups = [ordered[i : i + 200] for i in range(0, len(ordered), 200)]
        joined = [b" ".join(g).decode("utf-8").lower() for g in groups]
        for group, ids in zip(groups, self._encode(self.bare, joined)):
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(group) or ends[-1] != len(ids):
                single.extend(group)
                continue
            raw, at = ids.tobytes(), 0
            for c, end in zip(group, (ends * 4).tolist()):
                known[c] = raw[at:end]
                at = end
        for c, ids in zip(single, self._encode(self.tokenizer, [c.decode("utf-8", "replace") for c in single])):
            known[c] = ids.tobytes()
        for c in marked:
            known[c] = known[c[:-1]] + self.marks[c[-1]]

    def encode(self, texts: Iterable[bytes]) -> list[np.ndarray]:
        """The ids of each UTF-8 text, as little-endian unsigned 32-bit integers."""
        # special tokens of the vocabulary, which are told by case, begin so
        chunked = [(t if b"<|" in t else t.lower()).split() for t in texts]
        distinct: set[bytes] = set()
        for chunks in chunked:
            distinct.update(chunks)
        new = distinct.difference(self.known)
        if new and len(self.known) + len(new) > self.memo:
            self.known, new = {}, distinct
        self._learn(new)
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, chunks)), dtype="<u4") for chunks in chunked]


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker and tokenizer."""
    if path not in _LOADED:
        _LOADED[path] = ChunkEncoder(path)
    return _LOADED[path]
