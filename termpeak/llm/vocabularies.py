"""Public tokenizers as broadcast values; their files are never copied or trained."""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np

FOLDER = "/opt/tokenizers"
MAX_BYTES = 64 << 20

# Fixed value: how the byte-level vocabulary cuts text before merging.
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Fixed value: what the pattern's ``\s`` takes. Its look-ahead goes back over a run of
# white space one character at a time, and a run of about a million ends the process.
# So longer runs than this are taken out before the pattern sees them.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONGEST_RUN = 10_000


@dataclass(frozen=True)
class VocabularyFile:
    """The bytes of a vocabulary, small enough to be broadcast; read on the driver."""

    name: str
    content: bytes

    @staticmethod
    def read(path: str) -> VocabularyFile:
        content = Path(path).read_bytes()
        if len(content) > MAX_BYTES:
            raise ValueError(f"{path} has {len(content)} bytes; at most {MAX_BYTES}")
        return VocabularyFile(Path(path).name, content)

    def load(self) -> Vocabulary:
        """The tokenizer, built once in each Python process."""
        return _load(hashlib.sha256(self.content).hexdigest(), self)

    def __hash__(self) -> int:
        return hash(self.name)


class Vocabulary:
    """Ids of a text, and of each id whether it stands for a bare byte."""

    bare_byte: np.ndarray

    def ids(self, text: str) -> np.ndarray:
        raise NotImplementedError


class BytePairs(Vocabulary):
    """A byte-level vocabulary; its tokens laid end to end are the text's bytes."""

    def __init__(self, content: bytes) -> None:
        import tiktoken

        pairs = (line.split() for line in content.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._encoding = tiktoken.Encoding(
            "public", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        size = max(ranks.values()) + 1
        self.width = np.zeros(size, np.int64)
        self.bare_byte = np.zeros(size, bool)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
            self.bare_byte[rank] = len(token) == 1 and token[0] >= 128

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._tokens(text, LONGEST_RUN), np.int64)

    def _tokens(self, text: str, longest: int) -> list[int]:
        """As the pattern cuts the text, runs of ``longest`` spaces and more by hand.

        The pattern takes a run in one, but for its last character if more follows:
        that one may be the space before a word.
        """
        encode, out, at = self._encoding.encode_ordinary, [], 0
        for run in re.finditer(f"[{SPACES}]{{{longest},}}", text):
            stop = run.end() - (run.end() < len(text))
            out += encode(text[at : run.start()])
            out += self._encoding._encode_single_piece(text[run.start() : stop])
            at = stop
        return out + encode(text[at:])


class Pieces(Vocabulary):
    """A vocabulary of pieces that spells unknown characters as bytes."""

    def __init__(self, content: bytes) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=content)
        size = self._model.vocab_size()
        self.bare_byte = np.array([self._model.is_byte(k) for k in range(size)])

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._model.encode(text, num_threads=1), np.int64)


@lru_cache(maxsize=4)
def _load(digest: str, file: VocabularyFile) -> Vocabulary:
    return BytePairs(file.content) if file.name.endswith(".tiktoken") else Pieces(file.content)
