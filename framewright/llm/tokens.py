"""Byte-level BPE of whole texts with the tokenizers library, at the cost of each distinct chunk once."""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import SparkSession

#: A file that public_tokenizers.path() finds, or a full path.
TOKENIZER = "byte_bpe_50k.json"
#: Chunks kept in a worker's cache; it starts anew beyond that.
CACHE_CHUNKS = 800_000
#: Pieces that the library encodes in one call.
CALL = 512

# A space before a character that isn't white space starts a new piece of the byte-level pattern whatever
# stands before it, so the ids of a text are those of the chunks between such places.
_CUT = re.compile(r"(?= \S)")
_ODD = r" (?:\s|$)"
#: Marks that are a piece of their own after a word.
_STOPS = frozenset(".,;:!?")
#: Fixed value: the pattern that byte-level BPE cuts text with.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte: itself where it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(other)}


class ChunkEncoder:
    """Ids of texts, equal to those of Tokenizer.encode(text, add_special_tokens=False): a special string in a text is its token.

    A text that has such a string is left to the library as it is; others are encoded by their distinct chunks.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # its input is pieces
        # pieces are cut and spelt in the byte alphabet here, each once; in it, a line feed is no letter
        self.tokenizer.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.size[i] = len(token)
        self.alphabet = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        self.cache: dict[str, bytes] = {"": b""}

    def _learn_pieces(self, pieces: list[str]) -> None:
        k = self.dtype.itemsize
        for i in range(0, len(pieces), CALL):
            some = pieces[i : i + CALL]
            spelt = ["\u0120" + p[1:] if p[0] == " " and p.isascii() and p[1:].isalpha() else p.encode().decode("latin-1").translate(self.alphabet) for p in some]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(spelt)], add_special_tokens=False)[0].ids, self.dtype)
            ends = k * (np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(s) for s in spelt]), side="left") + 1)
            raw, at = ids.tobytes(), 0
            for p, end in zip(some, ends.tolist(), strict=True):
                self.cache[p] = raw[at:end]
                at = end

    def _learn(self, chunks: list[str]) -> None:
        cut = {c: (c[:-1], c[-1]) if c[-1] in _STOPS and c[0] == " " and c[1:-1].isalpha() else _PIECE.findall(c) for c in chunks if not (c[0] == " " and c[1:].isalpha())}
        cache = self.cache
        self._learn_pieces([*{p for p in (*(c for c in chunks if c not in cut), *(p for ps in cut.values() for p in ps)) if p not in cache}])
        for c, ps in cut.items():
            cache[c] = b"".join(cache[p] for p in ps)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as views of one array."""
        column = pa.array(texts, pa.large_string())
        own = {i for x in self.special for i in np.flatnonzero(pc.match_substring(column, x).to_numpy(zero_copy_only=False)).tolist()}
        if own:
            out = self(["" if i in own else t for i, t in enumerate(texts)])
            for i in own:
                out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, self.dtype)
            return out
        odd = np.flatnonzero(pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False))
        split = pc.split_pattern(column, " ")
        offsets = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # the first fragment of a text has no space before it: it is a chunk of its own
        first, at = offsets[:-1], len(words)
        heads = dict.fromkeys(words[k] for k in code[first].tolist())
        place = {w: at + k for k, w in enumerate(heads)}
        code = code.copy()
        code[first] = [place[words[k]] for k in code[first].tolist()]
        chunks = [" " + w for w in words] + [*heads]
        parts = {}
        for i in odd.tolist():
            parts[i] = _CUT.split(texts[i])
        if len(self.cache) > CACHE_CHUNKS:
            self.cache = {"": b""}
        cache = self.cache
        self._learn([c for c in chunks if c not in cache])
        self._learn([c for c in {c for p in parts.values() for c in p} if c not in cache])
        spelt = [cache[c] for c in chunks]
        size = np.fromiter(map(len, spelt), np.int64, len(spelt)) // self.dtype.itemsize
        flat, start = np.frombuffer(b"".join(spelt), self.dtype), np.cumsum(size) - size
        n = size[code]
        end = np.cumsum(n)
        ids = flat[np.arange(int(end[-1]) if len(end) else 0) + np.repeat(start[code] - (end - n), n)]
        bounds = np.concatenate([[0], end])[offsets - offsets[0]].tolist()
        out = [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        for i, p in parts.items():
            out[i] = np.frombuffer(b"".join(cache[c] for c in p), self.dtype)
        return out


def tokenizer_path(name: str = TOKENIZER) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def encoder(name: str = TOKENIZER) -> ChunkEncoder:
    """One encoder for each worker process; every machine has the vocabulary file of its own."""
    return ChunkEncoder(tokenizer_path(name))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
