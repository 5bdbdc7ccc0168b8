"""Token ids of whole texts, with a bounded cache of the vocabulary's own pre-tokens."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The pre-token pattern of the lower-casing word vocabulary, for Latin text. Only texts within
#: _LATIN take the cached path: there, lower-casing and composing cannot change what a pre-token is.
_LETTER = "a-zªµºß-öø-ſ"
_NUMBER = "0-9²³¹¼-¾"
_PRE_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^ \t\n\x0b\x0c\r{_LETTER}{_NUMBER}]+")
_OTHER = re.compile("[^\t\n\x0b\x0c\r -~\xa1-įı-ſ]")


class Encoder:
    """Encodes with a vocabulary that lower-cases, drops white space and marks the ends of words.

    Merges never cross a pre-token, so a text's ids are those of its pre-tokens, joined. New pre-tokens are
    encoded together and told apart by their last token's end mark. Texts beyond Latin letters go to the
    tokenizer whole, and so do texts with the string of a special token, which it turns into that token."""

    def __init__(self, vocabulary: str, cached: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)", re.IGNORECASE)
        self.cached = cached
        self.known: dict[str, bytes] = {}
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, dtype=bool)
        self.ends[[i for t, i in names.items() if t.endswith("</w>")]] = True

    def _learn(self, new: list[str]) -> None:
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            lines = [" ".join(part[i : i + 500]) for i in range(0, len(part), 500)]
            ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
            cuts = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
            assert len(cuts) == len(part) + 1
            raw = ids.tobytes()
            self.known.update(zip(part, (raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:]))))

    def encode(self, texts: pa.Array, step: int = 256) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; none for null."""
        for i in range(0, len(texts), step):
            whole: dict[int, str] = {}
            docs: list[list[str]] = []
            for k, t in enumerate(texts.slice(i, step)):
                t = t.as_py() or ""
                if _OTHER.search(t) or self.special.search(t):
                    whole[k] = t
                    t = ""
                docs.append(_PRE_TOKEN.findall(t.lower()))
            new = {c for doc in docs for c in doc}.difference(self.known)
            if len(self.known) + len(new) > self.cached:
                self.known.clear()
                new = {c for doc in docs for c in doc}
            if new:
                self._learn(list(new))
            look = self.known.__getitem__
            for k, doc in enumerate(docs):
                if k in whole:
                    yield np.array(self.tokenizer.encode(whole[k], add_special_tokens=False).ids, dtype="<u4").tobytes()
                else:
                    yield b"".join(map(look, doc))
