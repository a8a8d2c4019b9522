"""Vocabulary files of public tokenizers, carried to the tasks as bytes.

The driver reads a file once; tasks get its bytes (under 2 MB) with their
code, so executors need no folder of their own.
"""

from __future__ import annotations

import os
import re
from itertools import chain

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Fixed value: how the byte-level vocabulary cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer texts are encoded in parts of about so many code points.
PART = 1 << 18
_PLACE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_RUN = re.compile(r"\s{1000}")


def file_bytes(folder: str, name: str) -> bytes:
    with open(os.path.join(folder, name), "rb") as f:
        return f.read()


def parts(text: str, size: int | None = None) -> list[str]:
    """A long text cut before single spaces between ASCII letters.  Both
    kinds of tokenizer always end a token there (one by its pattern, the other
    because no piece has a space mark after another character), so the parts'
    ids laid end to end are the whole text's.  A text without such a place
    stays whole."""
    out, at, size = [], 0, size or PART
    while len(text) - at > size:
        place = _PLACE.search(text, at + size)
        if place is None:
            break
        out.append(text[at:place.start()])
        at = place.start()
    out.append(text[at:])
    return out


def _joined(texts: list[str], encode_batch) -> list[list[int]]:
    cut = [parts(t) for t in texts]
    found = iter(encode_batch(list(chain.from_iterable(cut))))
    return [next(found) if len(c) == 1 else list(chain.from_iterable(next(found) for _ in c)) for c in cut]


def byte_bpe(data: bytes, special_as_text: bool = False):
    """A byte-level encoder from a ``tokenizers`` file: texts -> one list of
    ids per text.  The file's vocabulary is run by tiktoken (ids in merge
    order are its ranks), four times as fast; parts with very long runs of
    white space, which its pattern engine cannot take, by ``tokenizers``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    coder = Tokenizer.from_str(data.decode("utf-8"))
    coder.encode_special_tokens = special_as_text
    special = {t.content: i for i, t in coder.get_added_tokens_decoder().items()}
    ranks = {t: i for i, t in enumerate(byte_bpe_tokens(coder)) if i not in special.values()}
    fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens={} if special_as_text else special)

    def ids(text: str) -> list[int]:
        if _RUN.search(text):
            return coder.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text) if special_as_text else fast.encode(text, allowed_special="all")

    return coder, lambda texts: _joined(texts, lambda cut: list(map(ids, cut)))


def piece_bpe(model: bytes):
    """A sentencepiece encoder: space + text -> one list of ids per text (the
    tokenizer puts that space itself)."""
    import sentencepiece

    coder = sentencepiece.SentencePieceProcessor(model_proto=model)
    return coder, lambda texts: _joined(texts, lambda cut: coder.encode([t[1:] for t in cut], num_threads=1))


def byte_level_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 characters are themselves, the other bytes follow from
    code point 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_bpe_tokens(coder) -> list[bytes]:
    """The bytes of each id."""
    to_byte = byte_level_bytes()
    out = [b""] * coder.get_vocab_size()
    for token, i in coder.get_vocab().items():
        out[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
    return out


def piece_bpe_tokens(coder) -> list[bytes]:
    """The bytes of each id; control and unknown ids have none."""
    def of(i: int) -> bytes:
        if coder.is_byte(i):
            return bytes([int(coder.id_to_piece(i)[3:5], 16)])
        if coder.is_control(i) or coder.is_unknown(i):
            return b""
        return coder.id_to_piece(i).replace("▁", " ").encode()

    return [of(i) for i in range(coder.get_piece_size())]
